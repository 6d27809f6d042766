"""Concatenate and cut: documents become one token stream that is cut into windows of a fixed length.

Pass one encodes every document once, writes its ids and notes where it starts within its task's output. The tasks'
token totals - one row per partition - are summed up to global offsets. Pass two cuts each document at the window
borders; a document that crosses borders leaves one boundary record per window, so pieces never need their
neighbours and the pass has no shuffle. Only the last window can be short.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from riskframe.llm.common import stored
from riskframe.llm.tokens import default_tokenizer, encoder, slices

LENGTH = 4096
END_ID = 2

_ENCODED = "doc_id long, ids binary, doc_tokens long, part int, local_start long"
_PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "begins_document boolean, ends_document boolean"
)


def with_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Every text's ids followed by the end id."""
    out = np.empty(len(ids) + len(counts), np.uint32)
    ends = np.cumsum(counts + 1) - 1
    is_end = np.zeros(len(out), bool)
    is_end[ends] = True
    out[is_end] = end_id
    out[~is_end] = ids
    return out, counts + 1


def encode_documents(docs: DataFrame, tokenizer_path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """(doc_id, ids, doc_tokens, part, local_start): little-endian unsigned 32-bit ids with the end id behind them.

    ``part`` and ``local_start`` are fixed by the writing task, so use the result through ``stored``. Null and empty
    texts are one end id; repeated rows are separate documents; columns other than doc_id and text are not read.
    """
    path = tokenizer_path or default_tokenizer()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            for rows in slices(batch, "text"):
                ids, counts = with_end(*encoder(path).encode(rows.column("text")), end_id)
                ends = np.cumsum(counts)
                blob = pa.py_buffer(ids.astype("<u4"))
                offsets = pa.py_buffer(np.concatenate([[0], ends * 4]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("doc_id"),
                        pa.Array.from_buffers(pa.binary(), rows.num_rows, [None, offsets, blob]),
                        pa.array(counts, pa.int64()),
                        pa.array(np.full(rows.num_rows, part, np.int32)),
                        pa.array(at + ends - counts, pa.int64()),
                    ],
                    names=["doc_id", "ids", "doc_tokens", "part", "local_start"],
                )
                at += int(ends[-1])

    return docs.select("doc_id", "text").mapInArrow(encode, _ENCODED)


def partition_bases(table: DataFrame, tokens: str = "doc_tokens") -> DataFrame:
    """(part, base, total): the tokens before each partition. One row per partition, however many rows there are."""
    totals = table.groupBy("part").agg(F.sum(tokens).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return totals.select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"), F.sum("n").over(everything).alias("total")
    )


def pack_documents(
    docs: DataFrame, length: int = LENGTH, tokenizer_path: str | None = None, end_id: int = END_ID, with_ids: bool = False
) -> DataFrame:
    """Pieces of ``docs`` (doc_id, text), one row per document and window, ``ids`` on request.

    Each id lies in exactly one piece and offsets are gapless in every sequence. Null and empty texts hold the end id
    only, so they are pieces too; equal or null doc_ids are separate documents; long texts are cut as often as
    needed; an empty table gives no piece. ``padded_to`` is the stored size of the piece's sequence: ``length``, or
    the filled size itself where that is a power of two.
    """
    encoded = stored(encode_documents(docs, tokenizer_path, end_id), "packed_ids")
    bases = partition_bases(encoded)
    placed = encoded.join(F.broadcast(bases), "part").select(
        "doc_id", "ids", "doc_tokens", (F.col("base") + F.col("local_start")).alias("first"), "total"
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first = batch.column("first").to_numpy()
            tokens = batch.column("doc_tokens").to_numpy()
            windows = (first + tokens - 1) // length - first // length + 1
            row = np.repeat(np.arange(len(first)), windows)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(windows) - windows, windows)
            sequence = first[row] // length + nth
            start = np.maximum(sequence * length - first[row], 0)
            stop = np.minimum((sequence + 1) * length - first[row], tokens[row])
            blobs = [memoryview(x.as_buffer()) for x in batch.column("ids")]
            pieces = [blobs[r][4 * a : 4 * b] for r, a, b in zip(row.tolist(), start.tolist(), stop.tolist())]
            columns = [
                batch.column("doc_id").take(pa.array(row)),
                pa.array(start),
                pa.array(stop - start),
                pa.array([zlib.crc32(p) for p in pieces], pa.int64()),
                pa.array(tokens[row]),
                pa.array(sequence),
                pa.array(first[row] + start - sequence * length),
                pa.array(start == 0),
                pa.array(stop == tokens[row]),
                batch.column("total").take(pa.array(row)),
            ]
            names = [*(c.split()[0] for c in _PIECES.split(", ")), "total"]
            if with_ids:
                columns.append(pa.array([bytes(p) for p in pieces], pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    pieces = placed.mapInArrow(cut, _PIECES + ", total long" + (", ids binary" if with_ids else ""))
    filled = F.least(F.lit(length), F.col("total") - F.col("sequence_id") * length)
    power = (filled.bitwiseAND(filled - 1)) == 0
    return pieces.withColumn("padded_to", F.when(power, filled).otherwise(F.lit(length)).cast("long")).drop("total")


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids, padded_to) from pieces that carry ids: at most ``length`` tokens meet in a row."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda out, piece: F.concat(out, piece["ids"]))
    return pieces.groupBy("sequence_id").agg(joined.alias("ids"), F.first("padded_to").alias("padded_to"))
