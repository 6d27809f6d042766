"""SimHash and embedding near-duplicates against all pairs."""

import itertools
import random

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from riskframe.llm import buckets, embed_dedup, simhash

NO = float("nan")


def roots(nodes, links):
    up = {n: n for n in nodes}

    def find(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def slow_fingerprint(text, shingle=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    runs = [b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aBé \n\t\x1f\x85 ", max_size=40), min_size=1, max_size=5))
def test_fingerprint_by_definition(texts):
    found = [simhash.shingle_hashes(t.encode()) for t in texts]
    flat = np.array([h for f in found for h in f], np.uint64)
    got = simhash.fingerprint(flat, np.array([len(f) for f in found]))
    assert got.tolist() == [slow_fingerprint(t) for t in texts]


def test_fingerprint_of_a_long_text():
    rng = np.random.default_rng(1)
    counts = np.array([5, 0, 300_000, 1, 40])
    hashes = rng.integers(0, 2**63, counts.sum()).astype(np.uint64) * np.uint64(2)
    got, at = simhash.fingerprint(hashes, counts), 0
    for fp, n in zip(got.tolist(), counts):
        own = hashes[at : at + n]
        at += n
        assert fp == sum(1 << b for b in range(64) if 2 * int(((own >> np.uint64(b)) & np.uint64(1)).sum()) > n)


@pytest.mark.parametrize("segments,bits", [(1, 2), (2, 3), (3, 4), (4, 4), (5, 4)])
def test_segments_reach_every_ball(segments, bits):
    plan = simhash.segment_plan(segments, bits)
    rng = random.Random(segments)
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), bits):
            b ^= 1 << bit
        assert any((b >> shift & mask) ^ flip == a >> shift & mask for shift, mask, flips in plan for flip in flips)


@pytest.mark.parametrize("segments,group", [(None, 2_000), (3, 2_000), (4, 3), (2, 5)])
def test_links_hold_components_together(spark, monkeypatch, segments, group):
    rng = random.Random(3)
    values = set()
    for _ in range(30):
        base = rng.getrandbits(64)
        for _ in range(rng.choice([1, 2, 40])):
            for bit in rng.sample(range(64), rng.choice([1, 2, 4])):
                base ^= 1 << bit
            values.add(base if base < 1 << 63 else base - (1 << 64))
    values |= {0, 1, -1}
    monkeypatch.setattr(buckets, "PAIRS", 50)
    monkeypatch.setattr(buckets.gridded, "__defaults__", (group,))
    links = simhash.linked(spark.createDataFrame([(v,) for v in values], "fp long"), 4, segments)
    got = {r.node: r.component for r in buckets.components(links).collect()}
    near = [(a, b) for a, b in itertools.combinations(values, 2) if ((a ^ b) & (1 << 64) - 1).bit_count() <= 4]
    want = roots(values, near)
    assert {v: got.get(v, v) for v in values} == want


def test_simhash_of_odd_rows(spark, documents):
    rows = simhash.simhash_components(documents).collect()
    docs = documents.collect()
    prints = {(r.doc_id, r.text): slow_fingerprint(r.text) for r in docs}
    near = [(a, b) for a, b in itertools.combinations(sorted(set(prints.values())), 2) if (a ^ b).bit_count() <= 4]
    group = roots(set(prints.values()), near)
    first = {}
    for (doc, _), fp in prints.items():
        if doc is not None:
            first[group[fp]] = min(first.get(group[fp], doc), doc)
    want = sorted((str(r.doc_id), f"{prints[r.doc_id, r.text]:016x}", str(first.get(group[prints[r.doc_id, r.text]]))) for r in docs)
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in rows) == want
    assert simhash.simhash_components(documents.limit(0)).count() == 0


def test_simhash_of_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    prints = {r.doc_id: slow_fingerprint(r.text) for r in docs.collect()}
    near = [(a, b) for a, b in itertools.combinations(prints, 2) if (prints[a] ^ prints[b]).bit_count() <= 4]
    want = roots(prints, near)
    got = simhash.simhash_components(docs).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {d: (f"{p:016x}", want[d]) for d, p in prints.items()}


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 12), st.lists(st.tuples(st.integers(0, 11), st.integers(0, 11)), max_size=20))
def test_local_roots(n, links):
    links = [(a % n, b % n) for a, b in links]
    a, b = (np.array([x[k] for x in links], np.int64) for k in (0, 1))
    assert dict(enumerate(buckets.local_roots(n, a, b).tolist())) == roots(range(n), links)


def test_components_of_chains_and_stars(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(0, 60)] + [(1000, i) for i in range(1001, 1100)] + [(rng.randrange(2000, 2100), rng.randrange(2000, 2100)) for _ in range(70)]
    got = {r.node: r.component for r in buckets.components(spark.createDataFrame(links, "a long, b long")).collect()}
    nodes = {n for link in links if link[0] != link[1] for n in link}
    assert got == {n: r for n, r in roots(nodes, [x for x in links if x[0] != x[1]]).items()}
    assert buckets.components(spark.createDataFrame([], "a long, b long")).count() == 0


def cosine_of(a, b):
    a, b = (np.array(x, np.float64) / np.abs(x).max() for x in (a, b))  # 1e200 squared has no double
    return a @ b / np.sqrt(a @ a) / np.sqrt(b @ b)


def check_vectors(rows, got):
    good = [k for k, (_, v) in enumerate(rows) if v and None not in v and np.isfinite(v).all() and any(v)]
    near = [(a, b) for a, b in itertools.combinations(good, 2) if len(rows[a][1]) == len(rows[b][1]) and (rows[a][1] == rows[b][1] or cosine_of(rows[a][1], rows[b][1]) >= 0.95)]
    group = roots(range(len(rows)), near)
    first = {}
    for k, (vec_id, _) in enumerate(rows):
        if vec_id is not None:
            first[group[k]] = min(first.get(group[k], vec_id), vec_id)
    want = []
    for k, (vec_id, _) in enumerate(rows):
        part = first.get(group[k])
        want.append((str(vec_id), sum(k in x for x in near), str(part), vec_id is not None and vec_id == part))
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in got) == sorted(want)


@pytest.mark.parametrize("group", [2_000, 4])
def test_clusters_of_vectors(spark, monkeypatch, group):
    monkeypatch.setattr(buckets.gridded, "__defaults__", (group,))
    monkeypatch.setattr(buckets, "PAIRS", 100)
    rng = np.random.default_rng(5)
    rows = []
    for size, noise in [(40, 0.1), (3, 0.2), (25, 0.02), (1, 0), (1, 0), (12, 0.25)]:
        centre = rng.normal(size=24)
        rows += [(len(rows) + k, (centre + noise * rng.normal(size=24)).tolist()) for k in range(size)]
    rows += [(200 + k, rows[0][1]) for k in range(5)]
    check_vectors(rows, embed_dedup.embedding_components(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect())


def test_odd_vectors(spark):
    one, two = [1.0, 2.0, 3.0], [3.0, -1.0, 0.5, 2.0]
    rows = [
        (1, one), (2, [x * 1e200 for x in one]), (3, [x * 1e-200 for x in one]), (4, two), (4, two), (5, None), (6, []), (7, [0.0] * 3), (7, [0.0] * 3),
        (8, [1.0, None, 3.0]), (9, [1.0, NO, 3.0]), (10, [float("inf"), 1.0, 1.0]), (None, two), (None, [9.0, -9.0, 1.0]), (11, [1.0, 2.0, 3.0, 0.0]), (12, [-1.0, -2.0, -3.0]),
        (13, [0.0, 1.0, 0.0]), (14, [-0.0, 1.0, -0.0]), (4, one),
    ]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("node", F.lit(5)).withColumn("key1", F.lit("x"))
    check_vectors(rows, embed_dedup.embedding_components(table).collect())
    assert embed_dedup.embedding_components(table.limit(0)).count() == 0


def test_all_embeddings(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in table.collect()]
    check_vectors(rows, embed_dedup.embedding_components(table).collect())
