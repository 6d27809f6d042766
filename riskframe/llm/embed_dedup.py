"""Embedding near-duplicates by cross-polytope hashing.

A vector is rotated by random signs and Hadamard transforms (three times each); its hash is the largest coordinate and
that coordinate's sign. Two rotations make a bucket of a table. A vector also probes the buckets that its next largest
coordinates would choose, cheapest first. Pairs that meet are verified by cosine in double precision.

A pair can meet in several tables, so it counts only at the first place where it meets; numbers of links then add up
over groups without any list of pairs. Equal vectors are merged first and carry their number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskframe.llm.buckets import components, gridded, local_roots, pair_streams
from riskframe.llm.common import stored, text_key

COSINE = 0.95
TABLES = 8
PROBES = 2
SEED = 11


def usable(vector: str = "embedding"):
    """Not null, not all zero, and without null or non-finite components."""
    v = F.col(vector)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(v, lambda x: x != 0)


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the last axis, whose length is a power of two."""
    n, h = x.shape[-1], 1
    while h < n:
        y = x.reshape(*x.shape[:-1], n // (2 * h), 2, h)
        x = np.stack([y[..., 0, :] + y[..., 1, :], y[..., 0, :] - y[..., 1, :]], -2).reshape(x.shape)
        h *= 2
    return x / np.sqrt(n)


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 in double precision, without overflow for very large or small components."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


class CrossPolytope:
    """Buckets of unit vectors of one dimension: (rows, tables, 1 + probes), the own bucket first."""

    def __init__(self, dim: int, tables: int = TABLES, probes: int = PROBES, seed: int = SEED):
        self.size = 1 << max(2, (dim - 1).bit_length())
        self.dim, self.tables, self.probes = dim, tables, probes
        rng = np.random.default_rng([seed, dim])
        self.signs = rng.choice(np.array([-1.0, 1.0]), (tables, 2, 3, self.size))

    def buckets(self, vectors: np.ndarray) -> np.ndarray:
        padded = np.zeros((len(vectors), self.size))
        padded[:, : self.dim] = vectors
        out = np.empty((len(vectors), self.tables, 1 + self.probes), np.int64)
        pairs = [(i, j) for i in range(3) for j in range(3)]
        for t in range(self.tables):
            codes, gaps = [], []
            for k in range(2):
                y = padded
                for sign in self.signs[t, k]:
                    y = hadamard(y * sign)
                size = np.abs(y)
                top = np.argsort(-size, axis=1, kind="stable")[:, :3]
                height = np.take_along_axis(size, top, 1)
                codes.append(2 * top + (np.take_along_axis(y, top, 1) < 0))
                gaps.append((height[:, :1] - height) ** 2)
            choices = np.stack([codes[0][:, i] * (2 * self.size) + codes[1][:, j] for i, j in pairs], 1)
            cost = np.stack([gaps[0][:, i] + gaps[1][:, j] for i, j in pairs], 1)
            cost[:, 0] = -1.0
            order = np.argsort(cost, axis=1, kind="stable")[:, : 1 + self.probes]
            out[:, t] = np.take_along_axis(choices, order, 1)
        return out


def vectors_of(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)


def by_dimension(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch's rows by the length of their vectors: vectors of different lengths have no cosine."""
    dims = batch.column("dim").to_numpy()
    for dim in np.unique(dims):
        at = np.flatnonzero(dims == dim)
        yield batch if len(at) == len(dims) else batch.take(pa.array(at))


def links(vectors: DataFrame, cosine: float = COSINE, tables: int = TABLES, probes: int = PROBES, seed: int = SEED) -> DataFrame:
    """(node, n_links, root) contributions from different vectors (node, copies, dim, embedding).

    Vectors travel in the type they have, array<float> or array<double>, and are computed with as doubles.

    n_links counts linked vectors, copies included, and is to be summed by node; root ties the node to its group.
    """
    hashers: dict[int, CrossPolytope] = {}

    def hasher(dim: int) -> CrossPolytope:
        if dim not in hashers:
            hashers[dim] = CrossPolytope(dim, tables, probes, seed)
        return hashers[dim]

    def spread(full: bool):
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for a in range(0, batch.num_rows, 2_000):
                    for rows in by_dimension(batch.slice(a, 2_000)):
                        dim = rows.column("dim")[0].as_py()
                        found = hasher(dim).buckets(unit(vectors_of(rows.column("embedding"))))
                        n = rows.num_rows
                        for t in range(tables):
                            name = np.int64((dim << 40) + (t << 32))
                            # Role 0 is the table's entry; the others look up their own bucket and the probed ones.
                            for role, c in [(0, 0), *((1, c) for c in range(1 + probes))] if full else [(0, 0)]:
                                bucket = pa.array(name + found[:, t, c])
                                columns = [bucket, pa.array(np.full(n, role, np.int8)), rows.column("node")]
                                names = ["bucket", "role", "node"]
                                if full:
                                    columns += [rows.column("copies"), rows.column("dim"), rows.column("embedding")]
                                    names += ["copies", "dim", "embedding"]
                                yield pa.RecordBatch.from_arrays(columns, names=names)

        return work

    index = vectors.mapInArrow(spread(False), "bucket long, role byte, node long")
    schema = f"bucket long, role byte, node long, copies long, dim int, embedding {vectors.schema['embedding'].dataType.simpleString()}"
    rows = gridded(vectors.mapInArrow(spread(True), schema), index, "node")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, unit_rows = None, None
        for found, i, p in pair_streams(batches):
            if found is not held:
                held = found
                nodes, copies = found.column("node").to_numpy(), found.column("copies").to_numpy()
                buckets, dims = found.column("bucket").to_numpy(), found.column("dim").to_numpy()
                flat = found.column("embedding")
                first = np.concatenate([[0], np.cumsum(dims)]).astype(np.int64)
                values = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                lengths = np.unique(dims)
                unit_rows = {d: (np.cumsum(dims == d) - 1, unit(values[first[:-1][dims == d][:, None] + np.arange(d)])) for d in lengths}
            keep = nodes[i] != nodes[p]
            i, p = i[keep], p[keep]
            near = np.zeros(len(i), bool)
            for d, (at, vectors_) in unit_rows.items():
                same = np.flatnonzero(dims[i] == d)
                for a in range(0, len(same), 200_000):
                    s = same[a : a + 200_000]
                    near[s] = np.einsum("ij,ij->i", vectors_[at[i[s]]], vectors_[at[p[s]]]) >= cosine
            i, p = i[near], p[near]
            if not len(i):
                continue
            involved, where = np.unique(np.concatenate([i, p]), return_inverse=True)
            half = len(i)
            own = np.empty((len(involved), tables, 1 + probes), np.int64)
            for d, (at, vectors_) in unit_rows.items():
                sel = np.flatnonzero(dims[involved] == d)
                if len(sel):
                    own[sel] = hasher(int(d)).buckets(vectors_[at[involved[sel]]])
            wi, wp = where[:half], where[half:]
            here = buckets[i]
            table = (here >> 32) & 255
            first_time = np.ones(half, bool)
            low_is_index = nodes[i] < nodes[p]
            for t in range(tables):
                a, b = own[wi, t], own[wp, t]
                same = a[:, 0] == b[:, 0]
                at_index = (b[:, 1:] == a[:, :1]).any(1)  # the probing row's probes reach the entry's bucket
                at_probe = (a[:, 1:] == b[:, :1]).any(1)
                meet = same | at_index | at_probe
                first_time &= ~(meet & (t < table))
                # In one table: equal own buckets count for the smaller node's entry; else probes into the smaller
                # node's bucket count before probes into the larger one's.
                own_entry = (here & 0xFFFFFFFF) == a[:, 0]
                counts = np.where(same, low_is_index & own_entry, np.where(low_is_index, at_index, at_index & ~at_probe))
                first_time &= np.where(t == table, counts, True)
            names, to = np.unique(nodes[involved], return_inverse=True)
            ni, np_ = to[wi], to[wp]
            n_links = np.bincount(ni[first_time], copies[p[first_time]], len(names)) + np.bincount(
                np_[first_time], copies[i[first_time]], len(names)
            )
            root = local_roots(len(names), ni, np_)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names), pa.array(n_links.astype(np.int64)), pa.array(names[root])], names=["node", "n_links", "root"]
            )

    columns = ["bucket", "i", "j", "role", "node", "copies", "dim", "embedding"]
    return rows.select(*columns).mapInArrow(verify, "node long, n_links long, root long")


def embedding_components(
    rows: DataFrame, cosine: float = COSINE, tables: int = TABLES, probes: int = PROBES, seed: int = SEED
) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of ``rows`` (vec_id, embedding).

    Null, zero and non-finite vectors link with nothing, vectors of different lengths not with each other. Rows without a
    vec_id take part as vectors; their component is the smallest vec_id among those linked, null if there is none. Equal
    vectors always link, repeated rows too. An empty table gives no row.
    """
    # A float is a double of half the bytes.
    element = "float" if rows.schema["embedding"].dataType.simpleString() == "array<float>" else "double"
    plain = rows.select("vec_id", F.col("embedding").cast(f"array<{element}>").alias("embedding"))
    # -0.0 is 0.0: the same vector must have one name.
    plain = plain.withColumn("embedding", F.transform("embedding", lambda x: x + F.lit(0.0).cast(element)))
    key1, key2 = text_key(F.col("embedding"))
    keyed = stored(plain.withColumn("usable", usable()).select("vec_id", "embedding", "usable", key1, key2), "vectors")
    classes = stored(
        keyed.filter("usable")
        .groupBy("key1", "key2")
        .agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("first_id"), F.first("embedding").alias("embedding"))
        .withColumn("dim", F.size("embedding")),
        "vector_classes",
    )
    # A class goes by its smallest vec_id; classes without one, or with one they share, go by their key.
    shared = classes.groupBy("first_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 or first_id is null")
    odd = shared.limit(1).count() > 0
    node = F.col("key1") if odd else F.col("first_id")
    nodes = classes.withColumn("node", node)
    found = stored(
        links(nodes.select("node", "copies", "dim", "embedding"), cosine, tables, probes, seed).groupBy("node", "root").agg(F.sum("n_links").alias("n_links")),
        "vector_links",
    )
    parts = stored(components(found.select(F.col("node").alias("a"), F.col("root").alias("b"))), "vector_parts")
    smallest = (
        parts.join(nodes.select("node", "first_id"), "node").groupBy("component").agg(F.min("first_id").alias("component_id"))
    )
    joined = parts.join(smallest, "component").select("node", "component_id", F.lit(True).alias("linked"))
    degree = found.groupBy("node").agg(F.sum("n_links").alias("n"))
    labels = (
        nodes.join(degree, "node", "left").join(joined, "node", "left").select(
            "key1", "key2", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("first_id")).alias("component_id"),
            F.lit(True).alias("found"),
        )
    )
    plain = keyed.select("vec_id", "key1", "key2", "usable")
    component = F.when(F.col("found"), F.col("component_id")).otherwise(F.col("vec_id"))
    return (
        plain.join(labels.withColumn("usable", F.lit(True)), ["key1", "key2", "usable"], "left")
        .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
    )
