"""Removed bytes against every pair of window starts."""

import collections
import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from riskframe.llm import repeats

SCHEMA = "doc_id long, text string, kind string"


def by_definition(texts, window=200):
    data = [(t or "").encode() for t in texts]
    seen = collections.Counter(d[i : i + window] for d in data for i in range(len(d) - window + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d) + 1, bool)
        for i in range(len(d) - window + 1):
            if seen[d[i : i + window]] > 1:
                gone[i : i + window] = True
        kept = bytes(c for c, g in zip(d, gone) if not g)
        out.append((len(d), int(gone.sum()), int((gone[:-1] & ~gone[1:]).sum()), hashlib.sha256(kept).hexdigest(), kept))
    return out


def check(spark, rows, partitions=3):
    table = spark.createDataFrame(rows, SCHEMA).repartition(partitions)
    got = repeats.remove_repeats(table, with_text=True).collect()
    want = by_definition([r[1] for r in rows])
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == sorted(
        (str(row[0]), *w[:4]) for row, w in zip(rows, want)
    )
    assert sorted(r.kept_text or "" for r in got) == sorted(w[4].decode("utf-8", "ignore") for w in want)


def words(rng, n):
    return " ".join("".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 9))) for _ in range(n))


def corpus(seed):
    rng = random.Random(seed)
    shared = [words(rng, k) for k in (20, 45, 60, 150)] + ["=" * 230, "ab" * 150]
    texts = []
    for _ in range(60):
        parts = [words(rng, rng.randint(0, 60)) for _ in range(3)]
        for _ in range(rng.randint(0, 3)):
            piece = rng.choice(shared)
            cut = rng.randint(0, 40)
            parts.insert(rng.randint(0, len(parts)), piece[cut : len(piece) - rng.randint(0, 40)])
        texts.append("\n".join(parts))
    texts += [texts[0], texts[0], texts[1][:-3] + "xyz", "x" + texts[2], texts[3][5:250], "a" * 199, "a" * 200, "c" * 201, None, "", "é" * 100, "é" * 101]
    texts.append(words(rng, 9000) + texts[4])
    return texts


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_by_definition(spark, monkeypatch, seed):
    if seed == 2:
        monkeypatch.setattr(repeats, "CHUNK", 300)
        monkeypatch.setattr(repeats.anchors, "__defaults__", (300,))
    if seed == 3:  # every bucket split, and tiny Arrow batches, so that spans go on from batch to batch
        monkeypatch.setattr(repeats, "HOT_ROWS", 0)
        monkeypatch.setattr(repeats, "SAMPLED", 1)
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        check(spark, [(i, t, "x") for i, t in enumerate(corpus(seed))], 5)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_odd_rows(spark):
    long = words(random.Random(9), 80)
    rows = [(1, long, None), (1, long, None), (None, long + "tail", "k"), (2, None, "k"), (2, "", None), (3, "short", "k"), (None, None, None)]
    check(spark, rows)
    assert repeats.remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0
    check(spark, [(7, "z" * 200, None)], 1)
    check(spark, [(7, "z" * 600, None), (8, "q" * 200, None), (8, "q" * 200, None)], 1)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 500), min_size=1, max_size=6), st.integers(0, 2**32), st.sampled_from([64, 700]))
def test_every_window_has_one_anchor(sizes, seed, chunk):
    rng = np.random.default_rng(seed)
    data = rng.integers(0, 3, sum(sizes)).astype(np.uint8)
    ends = np.cumsum(sizes)
    gram, span, at, first, last = repeats.anchors(data, ends, chunk)
    starts = sorted(s for a, b in zip(first, last) for s in range(a, b + 1))
    begins = ends - np.array(sizes)
    assert starts == [s for a, b in zip(begins, ends) for s in range(a, b - repeats.WINDOW + 1)]
    assert all(a <= p <= f + repeats.STARTS - 1 and p >= b for a, p, f, b in zip(first, at, first, last))


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(200)
    check(spark, [(r.doc_id, r.text, r.lang) for r in docs.collect()])
