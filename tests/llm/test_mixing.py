"""Targets against the stated loop, permutations against their definition, the mix against its promises."""

import collections
import re

import pytest
from pyspark.sql import functions as F

from riskframe.llm import mixing


def targets_by_loop(sizes):
    """Share by weight; those above twice their size stop there and the rest is shared anew."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    full, left = {}, 1.5 * sum(sizes.values())
    while True:
        free = [s for s in order if s not in full]
        total = sum(weight[s] for s in free)
        level = left / total if free else 0
        over = [s for s in free if level * weight[s] > 2 * sizes[s]]
        if not over:
            return full | {s: level * weight[s] for s in free}
        for s in over:
            full[s] = 2.0 * sizes[s]
            left -= full[s]


@pytest.mark.parametrize(
    "sizes",
    [{"a": 10, "b": 10, "c": 10}, {"a": 1000, "b": 1, "é": 5, "z": 70, None: 3}, {None: 0}, {"a": 0, "b": 7}, {"x": 4}, {"a": 5, "b": 900, "c": 5, "d": 900}],
)
def test_targets(spark, sizes):
    rows = mixing.source_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()
    want = targets_by_loop(sizes)
    assert {r.source for r in rows} == set(want)
    for r in rows:
        assert r.target == pytest.approx(want[r.source], rel=1e-9)


@pytest.mark.parametrize("n", [1, 2, 7, 1000])
def test_permutation(spark, n):
    df = spark.range(n).withColumn("n", F.lit(n).cast("long"))
    out = [r.p for r in mixing.permuted(df, "p", "id", "n", F.lit(3), seed=5).orderBy("id").collect()]
    assert sorted(out) == list(range(n))
    if n > 100:
        assert out != list(range(n)) and sum(abs(p - i) for i, p in enumerate(out)) > n * n / 6


def check_mix(docs, got):
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = collections.Counter()
    for r in docs:
        sizes[r.source] += words(r.text)
    want = targets_by_loop(dict(sizes))
    assert sorted((str(r.doc_id), r.size) for r in got) == sorted((str(r.doc_id), words(r.text)) for r in docs)
    taken = collections.Counter()
    for r in got:
        assert 0 <= r.taken <= 2 * r.size and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source], rel=1e-9)
        taken[r.source] += r.taken
    for s in sizes:
        assert taken[s] == int(want[s] + 1e-6), s


@pytest.mark.parametrize("block,shard", [(64, 16_384), (3, 5), (1, 1000)])
def test_mix_of_odd_rows(spark, documents, block, shard, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 2)
    first = mixing.mix_sources(documents, block_words=block, shard_slots=shard).collect()
    check_mix(documents.collect(), first)
    again = mixing.mix_sources(documents.repartition(5), block_words=block, shard_slots=shard).collect()
    assert sorted(map(str, first)) == sorted(map(str, again))


def test_mix_of_nothing(spark, documents):
    assert mixing.mix_sources(documents.limit(0)).count() == 0
    assert {r.taken for r in mixing.mix_sources(documents.filter("doc_id in (2, 3)")).collect()} == {0}


def test_mix_of_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    check_mix(docs.collect(), mixing.mix_sources(docs, shard_slots=50).collect())


def test_slots_meet_blocks(spark):
    """Whole epochs take every block, the rest distinct blocks, and shards differ."""
    sources = spark.createDataFrame([("a", 100, 0, 250.0 - 50), ("b", 101, 1, 150.0), ("c", 64, 2, 30.0)], "source string, source_size long, nth long, target double")
    slots = mixing.plan_slots(sources, 10, 7, 1).collect()
    by = {n: [s for s in slots if s.nth == n] for n in (0, 1, 2)}
    assert collections.Counter(s.block for s in by[0]) == {b: 2 for b in range(10)}
    assert len(by[1]) == 11 + 5 and [s.words for s in by[1] if s.words] == [9]
    assert len({s.block for s in by[2]}) == 3 and not any(s.words for s in by[2])
    assert all(sorted(s.slot for s in v) == list(range(len(v))) for v in by.values())
    assert len({s.shard for s in slots}) == 6


def test_spans_are_the_mix(spark, documents):
    """Spans lie in their documents, no epoch takes a word twice, and the counts are their sums."""
    spans = mixing.mix_spans(documents, block_words=3, shard_slots=5).collect()
    taken, seen = collections.Counter(), set()
    for r in spans:
        assert 0 <= r.a < r.b <= r.size and r.b - r.a <= 3 and r.shard is not None
        key = (r.doc_id, r.source, r.text_hash, r.copy, r.epoch)
        for w in range(r.a, r.b):
            assert (key, w) not in seen
            seen.add((key, w))
        taken[r.doc_id, r.source, r.text_hash] += r.b - r.a
    want = collections.Counter()
    for r in mixing.mix_sources(documents, block_words=3, shard_slots=5).collect():
        want[r.doc_id, r.source, r.text_hash] += r.taken
    assert taken == +want
