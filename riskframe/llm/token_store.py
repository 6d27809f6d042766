"""Token files with directly addressable codes.

A shard holds the ids of consecutive documents. Each id is split into chunks of eight bits: all first chunks form
level 0, the second chunks of ids above 255 level 1, and so on. A bitmap beside each level marks the ids that continue
on the next one, and a rank directory counts the marks before every 512 bits, so any id is found by one rank per level,
without decoding its neighbours.

Shards are rows of a Parquet table, because Spark's committer is what makes a file complete exactly once on any store:
``codes`` is the byte layout of ``encode_codes``, ``doc_ids`` and ``doc_ends`` are the directory of its documents.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from riskframe.llm.packing import partition_bases, with_end
from riskframe.llm.tokens import default_tokenizer, encoder, slices

END_ID = 1
#: A shard is closed once it holds so many ids; a longer document still is one shard.
SHARD_TOKENS = 1 << 20
#: Rows of the table per task and file.
ROWS_PER_TASK = 20_000
RANK_BITS = 512
MAGIC = b"DAC1"

_SHARDS = "part int, shard int, local_start long, n_tokens long, doc_ids array<bigint>, doc_ends array<bigint>, codes binary"


def encode_codes(ids: np.ndarray) -> bytes:
    """MAGIC, n ids, n levels; then per level: n chunks, chunks, bitmap (little-endian bits), rank directory (uint32).

    All counts are little-endian unsigned 64-bit; the last level's bitmap is all zero bits.
    """
    out, rest = [MAGIC], np.asarray(ids, np.uint32)
    levels = []
    while True:
        more = rest >> 8
        goes_on = more > 0
        bits = np.packbits(goes_on, bitorder="little")
        padded = np.zeros(-(-len(goes_on) // RANK_BITS) * RANK_BITS, bool)
        padded[: len(goes_on)] = goes_on
        marks = padded.reshape(-1, RANK_BITS).sum(1)
        rank = (np.cumsum(marks) - marks).astype("<u4")
        levels.append(struct.pack("<Q", len(rest)) + (rest & 255).astype(np.uint8).tobytes() + bits.tobytes() + rank.tobytes())
        rest = more[goes_on]
        if not len(rest):
            break
    out.append(struct.pack("<QQ", len(ids), len(levels)))
    return b"".join(out + levels)


class Codes:
    """One shard's ids: ``codes[i]`` by ranks, ``decode()`` all of them."""

    def __init__(self, blob):
        blob = memoryview(blob)
        if bytes(blob[:4]) != MAGIC:
            raise ValueError("not a shard of token codes")
        self.n, n_levels = struct.unpack_from("<QQ", blob, 4)
        self.levels, at = [], 20
        for _ in range(n_levels):
            (n,) = struct.unpack_from("<Q", blob, at)
            at += 8
            chunks = np.frombuffer(blob, np.uint8, n, at)
            at += n
            bits = np.frombuffer(blob, np.uint8, -(-n // 8), at)
            at += len(bits)
            rank = np.frombuffer(blob, "<u4", -(-n // RANK_BITS), at)
            at += 4 * len(rank)
            self.levels.append((chunks, bits, rank))

    def __len__(self) -> int:
        return self.n

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = shift = 0
        for chunks, bits, rank in self.levels:
            value |= int(chunks[i]) << shift
            if not bits[i >> 3] >> (i & 7) & 1:
                break
            block = i // RANK_BITS
            before = bits[block * RANK_BITS // 8 : i >> 3]
            below = int(bits[i >> 3]) & ((1 << (i & 7)) - 1)
            i = int(rank[block]) + int(np.bitwise_count(before).sum()) + below.bit_count()
            shift += 8
        return value

    def decode(self) -> np.ndarray:
        ids = np.zeros(0, np.uint32)
        for chunks, bits, _ in reversed(self.levels):
            goes_on = np.unpackbits(bits, count=len(chunks), bitorder="little").astype(bool)
            level = chunks.astype(np.uint32)
            level[goes_on] |= ids << np.uint32(8)
            ids = level
        return ids


def write_shards(docs: DataFrame, path: str, tokenizer_path: str | None = None, end_id: int = END_ID, tasks: int | None = None) -> None:
    """Writes ``docs`` (doc_id, text) to ``path`` as shards in ascending doc_id order (null first).

    Rows of one doc_id are put in the order of their texts' hashes and then of reading, so a doc_id that holds a third
    of all rows is still spread over tasks. Null and empty texts are the end id alone; an empty table writes no shard.
    """
    vocabulary = tokenizer_path or default_tokenizer()
    if tasks is None:
        tasks = max(docs.sparkSession.sparkContext.defaultParallelism, -(-docs.count() // ROWS_PER_TASK))
    ordered = docs.select(
        "doc_id", "text", F.xxhash64("text").alias("order1"), F.monotonically_increasing_id().alias("order2")
    )
    keys = ["doc_id", "order1", "order2"]

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, nth, at = TaskContext.get().partitionId(), 0, 0
        doc_ids, counts, ids, held = [], [], [], 0

        def flush():
            nonlocal nth, at, held
            row = pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()),
                    pa.array([nth], pa.int32()),
                    pa.array([at], pa.int64()),
                    pa.array([held], pa.int64()),
                    pa.array([sum(doc_ids, [])], pa.list_(pa.int64())),
                    pa.array([np.cumsum(np.concatenate(counts))], pa.list_(pa.int64())),
                    pa.array([encode_codes(np.concatenate(ids))], pa.binary()),
                ],
                names=["part", "shard", "local_start", "n_tokens", "doc_ids", "doc_ends", "codes"],
            )
            nth, at, held = nth + 1, at + held, 0
            doc_ids.clear(), counts.clear(), ids.clear()
            return row

        for batch in batches:
            for rows in slices(batch, "text"):
                found, n = with_end(*encoder(vocabulary).encode(rows.column("text")), end_id)
                ends = np.cumsum(n)
                first = 0
                while first < len(n):
                    before = int(ends[first - 1]) if first else 0
                    last = min(int(np.searchsorted(ends, before + SHARD_TOKENS - held)), len(n) - 1)
                    doc_ids.append(rows.column("doc_id").slice(first, last + 1 - first).to_pylist())
                    counts.append(n[first : last + 1])
                    ids.append(found[before : int(ends[last])])
                    held += int(ends[last]) - before
                    first = last + 1
                    if held >= SHARD_TOKENS:
                        yield flush()
        if held:
            yield flush()

    ranged = ordered.repartitionByRange(tasks, *keys).sortWithinPartitions(*keys)
    # The codes are addressed as they are, so nothing is packed around them.
    ranged.mapInArrow(shard, _SHARDS).write.option("compression", "none").parquet(path)


def read_documents(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of every document, decoded from the shards at ``path``."""
    shards = spark.read.schema(_SHARDS).parquet(path)
    bases = partition_bases(shards.select("part", "n_tokens"), "n_tokens")
    placed = shards.join(F.broadcast(bases), "part").select(
        (F.col("base") + F.col("local_start")).alias("first"), "doc_ids", "doc_ends", "codes"
    )
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids binary" if with_ids else "")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                ids = Codes(batch.column("codes")[row].as_buffer()).decode().astype("<u4")
                ends = batch.column("doc_ends")[row].values.to_numpy()
                starts = np.concatenate([[0], ends[:-1]])
                view = memoryview(ids.tobytes())
                parts = [view[4 * a : 4 * b] for a, b in zip(starts.tolist(), ends.tolist())]
                columns = [
                    batch.column("doc_ids")[row].values,
                    pa.array(batch.column("first")[row].as_py() + starts, pa.int64()),
                    pa.array(ends - starts, pa.int64()),
                    pa.array([zlib.crc32(p) for p in parts], pa.int64()),
                ]
                if with_ids:
                    columns.append(pa.array([bytes(p) for p in parts], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in schema.split(", ")])

    return placed.mapInArrow(decode, schema)


def tokens_at(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """(doc_id, at, id): the ids at places ``at`` (from 0) of documents, by rank from the files' codes.

    ``wanted`` is (doc_id, at). Directories say in which shard a place lies; only those shards' codes are read, and of them
    only the chunks of the ids asked for. A place behind a document's end id, or of an unknown doc_id, gives no row; of
    documents that share a doc_id, or have none, each one that is long enough gives a row; repeated places count once.
    """
    shards = spark.read.schema(_SHARDS).parquet(path)
    ends = F.transform("doc_ends", lambda e, i: F.struct(F.get("doc_ids", i).alias("doc_id"), F.coalesce(F.get("doc_ends", i - 1), F.lit(0)).alias("first"), e.alias("stop")))
    directory = shards.select("part", "shard", F.explode(ends).alias("d")).select("part", "shard", "d.*").alias("d")
    asked = wanted.select("doc_id", "at").filter("at >= 0").distinct().alias("w")
    placed = directory.join(asked, F.expr("d.doc_id <=> w.doc_id and w.at < d.stop - d.first"))
    place = F.struct("w.doc_id", "w.at", (F.col("d.first") + F.col("w.at")).alias("place"))
    # A shard holds so many ids at most, and so many places.
    places = placed.select("part", "shard", place.alias("p")).groupBy("part", "shard").agg(F.collect_list("p").alias("places"))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                codes = Codes(batch.column("codes")[row].as_buffer())
                found = batch.column("places")[row].values
                doc_ids, at, place = found.flatten()
                ids = pa.array([codes[i] for i in place.to_pylist()], pa.int64())
                yield pa.RecordBatch.from_arrays([doc_ids, at, ids], names=["doc_id", "at", "id"])

    codes = shards.select("part", "shard", "codes").join(places, ["part", "shard"]).select("codes", "places")
    return codes.mapInArrow(look_up, "doc_id long, at long, id long")


def token_at(spark: SparkSession, path: str, doc_id: int, at: int) -> int:
    """One token of one document."""
    found = tokens_at(spark, path, spark.createDataFrame([(doc_id, at)], "doc_id long, at long")).limit(1).collect()
    if not found:
        raise IndexError(at)
    return found[0]["id"]
