"""Bucket joins for near-duplicate search: index rows and probing rows meet per bucket, in streams of bounded memory.

Rows of a bucket arrive sorted, index rows first. Buckets with many index rows are cut into a grid: index rows into g
parts, probing rows into g parts, each part pair a group of its own, so no group holds more than a few thousand index
rows, and every pair of rows still meets exactly once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskframe.llm.common import stored

#: Index rows of a bucket that one group holds.
GROUP_ROWS = 2_000
#: Hot buckets that are broadcast at most (16 bytes each); beyond, they are joined by a shuffle.
BROADCAST_BUCKETS = 200_000
#: Row pairs that are compared at once.
PAIRS = 2_000_000


def gridded(rows: DataFrame, index_buckets: DataFrame, row_id: str, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``rows`` (bucket, role 0 for index rows, ...) with the grid cell (i, j) of their group, dealt out and sorted."""
    hot = stored(
        index_buckets.groupBy("bucket").count().filter(F.col("count") > group_rows).select(
            "bucket", F.ceil(F.col("count") / group_rows).cast("int").alias("g")
        ),
        "hot_buckets",
    )
    n_hot = hot.limit(BROADCAST_BUCKETS + 1).count()
    if n_hot:
        split = rows.join(F.broadcast(hot) if n_hot <= BROADCAST_BUCKETS else hot, "bucket", "left")
        own = F.pmod(F.xxhash64(row_id), F.coalesce("g", F.lit(1))).cast("int")
        every = F.sequence(F.lit(0), F.coalesce("g", F.lit(1)) - 1)
        split = split.withColumn("own", own).withColumn("other", F.explode(every))
        index = F.col("role") == 0
        rows = (
            split.withColumn("i", F.when(index, F.col("own")).otherwise(F.col("other")))
            .withColumn("j", F.when(index, F.col("other")).otherwise(F.col("own")))
            .drop("g", "own", "other")
        )
    else:
        rows = rows.withColumn("i", F.lit(0)).withColumn("j", F.lit(0))
    return rows.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "role")


def pair_streams(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, index row numbers, probing row numbers) of all pairs within groups, ``PAIRS`` or so at a time.

    Index rows of a group that goes on in the next batch are carried over; they are at most a group's index rows.
    """
    carry = None
    for batch in batches:
        table = pa.Table.from_batches([carry, batch] if carry is not None else [batch]).combine_chunks()
        rows = table.to_batches()[0] if table.num_rows else batch
        n = rows.num_rows
        if not n:
            continue
        keys = [rows.column(c).to_numpy() for c in ("bucket", "i", "j")]
        new = np.ones(n, bool)
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
        group = np.cumsum(new) - 1
        start = np.flatnonzero(new)
        is_index = rows.column("role").to_numpy() == 0
        n_index = np.bincount(group[is_index], minlength=len(start))
        probes = np.flatnonzero(~is_index & (n_index[group] > 0))
        widths = n_index[group[probes]]
        chunk = np.cumsum(widths) // PAIRS
        cuts = [0, *(np.flatnonzero(np.diff(chunk)) + 1), len(probes)]
        for a, b in zip(cuts, cuts[1:]):
            p, w = probes[a:b], widths[a:b]
            if len(p):
                ends = np.cumsum(w)
                nth = np.arange(ends[-1]) - np.repeat(ends - w, w)
                yield rows, np.repeat(start[group[p]], w) + nth, np.repeat(p, w)
        last = start[-1]
        carry = rows.slice(last, int(n_index[-1])) if n_index[-1] else None
        if carry is not None:
            carry = carry.take(pa.array(np.arange(carry.num_rows)))  # a copy: a slice would keep the whole batch


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For nodes 0 .. n-1 with links a-b, the smallest node of each one's component."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        np.minimum.at(root, before[a], low)
        np.minimum.at(root, before[b], low)
        root = root[root]
        if np.array_equal(root, before):
            return root


def components(edges: DataFrame) -> DataFrame:
    """(node, component): every node of ``edges`` (a long, b long) with the smallest node it can reach.

    Alternating large-star and small-star rounds: each round replaces links by links to a smaller node, so the number
    of links never grows; it ends when a round changes none, after about log n rounds. Rounds are written tables.
    """
    at = stored(
        edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )

    def mark(df):
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    seen = mark(at)
    while seen[0]:
        both = at.unionByName(at.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        at = stored(small.unionByName(low.select("a", F.col("m").alias("b"))).distinct(), "links")
        now = mark(at)
        if now == seen:
            break
        seen = now
    return at.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component")).unionByName(
        at.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
