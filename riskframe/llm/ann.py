"""Nearest neighbours by multi-index hashing over learned binary codes.

Learning, on a bounded sample: rotations that make the signs of rotated coordinates keep distances (principal axes, then
alternating signs and rotation), and a table from distance to the Hamming radius that holds nearly all pairs so near.

Search: codes are cut into substrings. Blocks of vectors keep, per substring, a table from its values to rows. A code
within radius R of a query agrees with it in some substring up to R // substrings bits, so probing the values in those
small balls retrieves every such code; complete Hamming distances are verified and the floats of what is left reranked.
Every row is indexed; a query meets every block, in streams: a task holds one block's tables and a batch of queries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from riskframe.llm.common import stored
from riskframe.llm.embed_dedup import usable, vectors_of

BITS = 64
SUBSTRINGS = 4
#: Rows the codes and radii are learned on at most.
SAMPLE_ROWS = 20_000
#: Sample rows that serve as queries when radii are learned.
SAMPLE_QUERIES = 400
#: Share of the pairs of a distance that its radius holds.
HELD = 0.98
BLOCK_ROWS = 4_096
SEED = 23


class Codes:
    """The learned model: 64-bit codes of vectors, and a query's radius from the sample."""

    def __init__(self, sample: np.ndarray, ids: np.ndarray, k: int, seed: int = SEED):
        rng = np.random.default_rng(seed)
        dim = sample.shape[1]
        self.mean = sample.mean(axis=0)
        centred = sample - self.mean
        _, axes = np.linalg.eigh(centred.T @ centred)
        parts = []
        for _ in range(-(-BITS // dim)):
            z = centred @ axes
            turn = np.linalg.qr(rng.normal(size=(dim, dim)))[0]
            for _ in range(30):
                u, _, vt = np.linalg.svd(np.where(z @ turn >= 0, 1.0, -1.0).T @ z)
                turn = (u @ vt).T
            parts.append(axes @ turn)
        self.projection = np.concatenate(parts, axis=1)[:, :BITS]
        self.sample, self.ids, self.k = sample, ids, k
        self._learn_radii(rng)

    @classmethod
    def restored(cls, state: dict) -> "Codes":
        """The model from its arrays: a broadcast of plain arrays needs no import before a worker's paths are set."""
        model = object.__new__(cls)
        model.__dict__.update(state)
        return model

    def encode(self, vectors: np.ndarray) -> np.ndarray:
        bits = (vectors - self.mean) @ self.projection >= 0
        return np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel()

    def _learn_radii(self, rng) -> None:
        """Edges of distance bins among near pairs of the sample, and the radius that holds HELD of each bin."""
        codes = self.encode(self.sample)
        at = rng.permutation(len(self.sample))[:SAMPLE_QUERIES]
        far, bits = [], []
        for q in at:
            d = distances(self.sample[q], self.sample)
            near = np.argsort(d, kind="stable")[1 : 1 + max(50, 5 * self.k)]
            far.append(d[near])
            bits.append(np.bitwise_count(codes[near] ^ codes[q]))
        far, bits = (np.concatenate(x) if x else np.empty(0) for x in (far, bits))
        if len(far) < 200:
            self.edges, self.radii = np.array([np.inf]), np.array([BITS])
            return
        order = np.argsort(far, kind="stable")
        bins = np.array_split(order, min(40, len(far) // 100))
        self.edges = np.array([far[b[-1]] for b in bins])
        held = [int(np.quantile(bits[b], HELD, method="higher")) for b in bins]
        self.radii = np.append(np.maximum.accumulate(held), BITS)

    def radius(self, vector: np.ndarray, vec_id: int) -> int:
        """The k-th nearest of the sample is no nearer than the k-th nearest of all: its distance's radius is enough."""
        d = distances(vector, self.sample)
        d = d[(self.ids != vec_id) | (d > 0)]
        if len(d) < self.k:
            return BITS
        return int(self.radii[np.searchsorted(self.edges, np.partition(d, self.k - 1)[self.k - 1])])


def distances(vector: np.ndarray, others: np.ndarray) -> np.ndarray:
    gaps = others - vector
    return np.sqrt((gaps * gaps).sum(axis=1))


class Block:
    """The tables of one block: per substring its different values and the rows of each."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, codes: np.ndarray):
        self.ids, self.vectors, self.codes = ids, vectors, codes
        self.tables = []
        for s in range(SUBSTRINGS):
            part = self.part(codes, s)
            order = np.argsort(part, kind="stable")
            values, first = np.unique(part[order], return_index=True)
            self.tables.append((values, first, np.append(first[1:], len(part)), order))

    @staticmethod
    def part(codes, s: int):
        width = BITS // SUBSTRINGS
        return (codes >> np.uint64(s * width)) & np.uint64((1 << width) - 1)

    def within(self, code: np.uint64, radius: int) -> np.ndarray:
        """All rows whose codes differ from ``code`` in at most ``radius`` bits."""
        found = np.zeros(len(self.codes), bool)
        for s, (values, first, end, order) in enumerate(self.tables):
            hit = np.flatnonzero(np.bitwise_count(values ^ self.part(code, s)) <= radius // SUBSTRINGS)
            sizes = end[hit] - first[hit]
            upto = np.cumsum(sizes)
            if len(upto):
                found[order[np.repeat(first[hit] - (upto - sizes), sizes) + np.arange(upto[-1])]] = True
        rows = np.flatnonzero(found)
        return rows[np.bitwise_count(self.codes[rows] ^ code) <= radius]

    def nearest(self, vector: np.ndarray, code: np.uint64, vec_id: int, radius: int, k: int):
        """(vec_id, distance) of the k nearest rows retrieved, but for the query's own row: the one with its id and its vector.

        The radius grows where it holds fewer than k rows, so a query always gets k if there are as many.
        """
        while True:
            rows = self.within(code, radius)
            d = distances(vector, self.vectors[rows])
            other = (self.ids[rows] != vec_id) | (d > 0)
            rows, d = rows[other], d[other]
            if len(rows) >= k or radius >= BITS:
                break
            radius = min(BITS, radius + SUBSTRINGS)
        best = np.lexsort((self.ids[rows], d))[:k]
        return self.ids[rows[best]], d[best]


def nearest_neighbours(rows: DataFrame, queries: Column, k: int = 10, sample_rows: int = SAMPLE_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``rows`` (vec_id, embedding) that ``queries`` chooses, the ``k``
    nearest other rows found by Euclidean distance, ties to the smaller vec_id; all rows, if there are fewer.

    Vectors that are null, all zero or hold null or non-finite components, vectors of another length than most, and rows
    without a vec_id take no part. Rows that repeat both vec_id and vector are one row; rows that share a vec_id with different
    vectors are rows of their own, each a candidate of the others, and as queries each has its own ``k`` rows under that
    query_id. An empty table, or one without queries, gives no row.
    """
    clean = rows.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).filter(usable()).filter("vec_id is not null")
    table = stored(clean.distinct().withColumn("dim", F.size("embedding")), "vectors")
    sizes = table.groupBy("dim").count().orderBy(F.desc("count"), "dim").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if sizes is None:
        return rows.sparkSession.createDataFrame([], schema)
    dim, n = sizes
    table = table.filter(F.col("dim") == dim).select("vec_id", "embedding")
    sample = table.orderBy(F.xxhash64(F.lit(SEED), "vec_id"), "vec_id", "embedding").limit(sample_rows).toPandas()
    model = Codes(np.stack(sample["embedding"].to_numpy()), sample["vec_id"].to_numpy(), k)
    shared = rows.sparkSession.sparkContext.broadcast(vars(model))  # sample_rows vectors at most

    def with_radius(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Codes.restored(shared.value)
        for batch in batches:
            ids = batch.column("vec_id").to_numpy()
            radii = [model.radius(v, i) for v, i in zip(vectors_of(batch.column("embedding")), ids)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("embedding"), pa.array(radii, pa.int32())], names=["vec_id", "embedding", "radius"]
            )

    n_blocks = max(1, -(-n // block_rows))
    asked = table.filter(queries).repartition(n_blocks).mapInArrow(with_radius, "vec_id long, embedding array<double>, radius int")
    indexed = table.withColumn("radius", F.lit(-1)).withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)))
    everywhere = asked.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long"))))
    dealt = indexed.unionByName(everywhere).repartition(2 * n_blocks, "block")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Codes.restored(shared.value)
        current, parts, block = None, [], None
        for batch in batches:
            blocks = batch.column("block").to_numpy()
            radii = batch.column("radius").to_numpy()
            cuts = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(radii < 0) != 0)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(blocks)]):
                if a == b:
                    continue
                ids, vectors = batch.column("vec_id").to_numpy()[a:b], vectors_of(batch.column("embedding").slice(a, b - a))
                if blocks[a] != current:
                    current, parts, block = blocks[a], [], None
                if radii[a] < 0:
                    parts.append((ids, vectors))
                    continue
                if block is None and parts:
                    all_ids, all_vectors = (np.concatenate(x) for x in zip(*parts))
                    block, parts = Block(all_ids, all_vectors, model.encode(all_vectors)), []
                if block is None:  # a block that no row fell into
                    continue
                codes = model.encode(vectors)
                out = [block.nearest(v, c, i, r, k) for i, v, c, r in zip(ids, vectors, codes, radii[a:b])]
                own = pa.array(np.repeat(np.arange(a, b), [len(x[0]) for x in out]))
                found = [pa.array(np.concatenate([x[c] for x in out])) for c in (0, 1)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id").take(own), batch.column("row").take(own), *found], names=["query_id", "row", "vec_id", "score"]
                )

    dealt = dealt.withColumn("row", F.xxhash64("embedding"))
    found = dealt.sortWithinPartitions("block", F.col("radius") >= 0).mapInArrow(search, "query_id long, row long, vec_id long, score double")
    order = Window.partitionBy("query_id", "row").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
