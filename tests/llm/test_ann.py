"""Neighbours against brute force: recall, exact scores, and the defined odd cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.llm import ann


def by_hand(rows, query_ids, k):
    ids = np.array([r[0] for r in rows])
    vectors = np.array([r[1] for r in rows], np.float64)
    out = {}
    for q in query_ids:
        d = np.sqrt(((vectors - vectors[list(ids).index(q)]) ** 2).sum(1))
        order = [x for x in np.lexsort((ids, d)) if ids[x] != q][:k]
        out[q] = [(int(ids[x]), float(d[x])) for x in order]
    return out


def listed(found):
    out = {}
    for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
        assert r.rank == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


@pytest.mark.parametrize("block_rows", [300, 4096])
def test_recall(spark, block_rows):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    got = listed(ann.nearest_neighbours(table, F.col("vec_id") % 20 == 0, block_rows=block_rows).collect())
    want = by_hand(rows, [r[0] for r in rows if r[0] % 20 == 0], 10)
    assert set(got) == set(want)
    hits = sum(len({v for v, _ in got[q]} & {v for v, _ in want[q]}) for q in want)
    assert hits >= 0.95 * 10 * len(want)
    vectors = {i: np.array(v, np.float64) for i, v in rows}
    for q, found in got.items():
        assert len(found) == 10 and found == sorted(found, key=lambda x: (x[1], x[0]))
        assert all(s == pytest.approx(np.linalg.norm(vectors[q] - vectors[v]), abs=1e-12) for v, s in found)


def test_every_code_within_the_radius():
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 2**63, 3000).astype(np.uint64)
    codes[:500] = codes[0] ^ (np.uint64(1) << rng.integers(0, 64, 500).astype(np.uint64))
    block = ann.Block(np.arange(3000), np.zeros((3000, 2)), codes)
    for radius in (0, 1, 3, 9, 20, 28, 64):
        assert block.within(codes[0], radius).tolist() == np.flatnonzero(np.bitwise_count(codes ^ codes[0]) <= radius).tolist()


def test_odd_rows(spark):
    rows = [(0, [1.0, 0.0, 0.0]), (1, [1.0, 0.0, 0.0]), (2, [1.0, 0.0, 0.0]), (2, [1.0, 0.0, 0.0]), (3, [2.0, 0.0, 1.0]), (4, [0.0, 5.0, 0.0])]
    bad = [(5, None), (6, []), (7, [0.0, 0.0, 0.0]), (8, [1.0, None, 0.0]), (9, [float("nan"), 1.0, 1.0]), (10, [1.0, 2.0]), (None, [1.0, 0.0, 0.0]), (100, None)]
    table = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>").withColumn("block", F.lit("x")).withColumn("radius", F.lit(3))
    got = listed(ann.nearest_neighbours(table, F.col("vec_id") % 2 == 0).collect())
    clean = [r for k, r in enumerate(rows) if k != 3]
    assert got == by_hand(clean, [0, 2, 4], 10)
    assert ann.nearest_neighbours(table.limit(0), F.lit(True)).count() == 0
    assert ann.nearest_neighbours(table, F.lit(False)).count() == 0
    assert listed(ann.nearest_neighbours(table, F.col("vec_id") == 0, k=2).collect()) == {0: [(1, 0.0), (2, 0.0)]}


def test_rows_that_share_an_id_are_all_candidates(spark):
    """Different vectors under one vec_id: none is lost, and as queries each has neighbours of its own."""
    rows = [(4, [0.0, 5.0, 0.0]), (4, [9.0, 5.0, 0.0]), (4, [9.0, 5.0, 0.0]), (1, [1.0, 5.0, 0.0]), (2, [9.0, 4.0, 0.0]), (3, [0.0, 0.0, 7.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    different = sorted(set((i, tuple(v)) for i, v in rows))
    want = []
    for q, v in different:
        if q == 4:
            near = sorted((float(np.linalg.norm(np.subtract(v, w))), i) for i, w in different if (i, w) != (q, v))
            want.append([(rank, i, round(d, 12)) for rank, (d, i) in enumerate(near, 1)])
    got = [(r.rank, r.vec_id, round(r.score, 12)) for r in ann.nearest_neighbours(table, F.col("vec_id") == 4).collect()]
    assert sorted(got) == sorted(sum(want, [])) and len(got) == 8
    ones = listed(ann.nearest_neighbours(table, F.col("vec_id") == 1, k=3).collect())
    assert [v for v, _ in ones[1]] == [4, 4, 2]
