"""SimHash near-duplicates by multi-index hashing.

A fingerprint is cut into segments, each with a table from its values to fingerprints. If two fingerprints differ in
at most d bits, then for radii that sum up to d - segments + 1 some segment differs by no more than its radius. So each
fingerprint enumerates a small Hamming ball around each of its segments, fetches the tables' matches, and complete
distances are verified. Equal fingerprints are merged first, and a group's links leave a task as links to the group's
smallest member, so copies never become pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from riskframe.llm.buckets import components, gridded, local_roots, pair_streams
from riskframe.llm.common import stored
from riskframe.llm.tokens import slices

SHINGLE = 4
MAX_BITS = 4
SEED = 42
#: Text bytes whose shingles are held at once.
CHUNK_BYTES = 4_000_000
#: Up to so many fingerprints four segments are cheaper (fewer probes), beyond that three (emptier buckets). Both find everything.
FOUR_SEGMENTS = 1 << 24


def shingle_hashes(text: bytes, shingle: int = SHINGLE) -> list[int]:
    """XXH64 of every run of ``shingle`` words of a lower-cased text, repeats included; a shorter text is one run."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()  # bytes: A-Z only, and white space is space and \t..\r
    if not words:
        return []
    line = b" ".join(words)
    if len(words) <= shingle:
        return [xxh64_intdigest(line, SEED)]
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    return [xxh64_intdigest(line[a:b], SEED) for a, b in zip(starts[: 1 - shingle or None].tolist(), ends[shingle - 1 :].tolist())]


def fingerprint(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Per text a 64-bit value: a bit is set if more than half of its hashes set it. No hashes: zero."""
    ones = np.zeros((len(counts), 64), np.int64)
    ends = np.cumsum(counts)
    some = counts > 0
    if some.any():
        first = (ends - counts)[some]
        step = 1 << 18
        if len(hashes) <= step:
            bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones[some] = np.add.reduceat(bits, first, axis=0, dtype=np.int32)
        else:  # many shingles: a block at a time, so that long texts need no memory of their size times 64
            owner = np.repeat(np.flatnonzero(some), counts[some])
            for a in range(0, len(hashes), step):
                block, own = hashes[a : a + step], owner[a : a + step]
                bits = np.unpackbits(block.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                cut = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
                ones[own[cut]] += np.add.reduceat(bits, cut, axis=0, dtype=np.int32)
    set_bits = (2 * ones > counts[:, None]).astype(np.uint8)
    return np.packbits(set_bits, axis=1, bitorder="little").view("<u8").ravel().astype(np.uint64)


def with_fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, text_hash, fp): fingerprints of whole texts as signed longs. Null, empty and blank texts have 0."""
    plain = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "text", CHUNK_BYTES):
                texts = pc.fill_null(rows.column("text").cast(pa.binary()), b"").to_pylist()
                found = [shingle_hashes(t, shingle) for t in texts]
                counts = np.fromiter(map(len, found), np.int64, len(found))
                hashes = np.fromiter((h for f in found for h in f), np.uint64, int(counts.sum()))
                fp = pa.array(fingerprint(hashes, counts).view(np.int64))
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("text_hash"), fp], names=["doc_id", "text_hash", "fp"])

    return plain.mapInArrow(work, "doc_id long, text_hash long, fp long")


def segment_plan(segments: int, bits: int) -> list[tuple[int, int, list[int]]]:
    """Per segment (shift, mask, flips): the ball of its radius as the bit patterns to flip, 0 first."""
    spare, width, plan, at = max(bits - segments + 1, 0), 64 / segments, [], 0
    if bits < segments - 1:
        raise ValueError("more segments than bits + 1 gain nothing")
    for s in range(segments):
        end = round(width * (s + 1))
        radius = spare // segments + (s < spare % segments)
        size = end - at
        flips = [sum(1 << b for b in c) for r in range(radius + 1) for c in combinations(range(size), r)]
        plan.append((at, (1 << size) - 1, flips))
        at = end
    return plan


def linked(fingerprints: DataFrame, bits: int = MAX_BITS, segments: int | None = None) -> DataFrame:
    """(a, b): links between different values of ``fp`` that hold their components together.

    All pairs at ``bits`` or fewer differing bits are found and verified; of the pairs found at once, each member is
    returned with the smallest member of its connected part.
    """
    n = fingerprints.count()
    segments = min(segments or (4 if n <= FOUR_SEGMENTS else 3), bits + 1)
    plan = segment_plan(segments, bits)

    def keyed(fp: np.ndarray, with_probes: bool):
        for s, (shift, mask, flips) in enumerate(plan):
            value = (fp >> np.uint64(shift)) & np.uint64(mask)
            yield (np.uint64(s << 58) | value), 0
            for flip in flips if with_probes else []:
                yield (np.uint64(s << 58) | (value ^ np.uint64(flip))), 1

    def rows_of(with_probes: bool):
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                fp = batch.column("fp").to_numpy()
                for bucket, role in keyed(fp.view(np.uint64), with_probes):
                    roles = pa.array(np.full(len(fp), role, np.int8))
                    yield pa.RecordBatch.from_arrays([pa.array(bucket.view(np.int64)), roles, pa.array(fp)], names=["bucket", "role", "fp"])

        return work

    schema = "bucket long, role byte, fp long"
    index = fingerprints.select("fp").mapInArrow(rows_of(False), schema)
    rows = gridded(fingerprints.select("fp").mapInArrow(rows_of(True), schema), index, "fp")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found, i, p in pair_streams(batches):
            fp = found.column("fp").to_numpy()
            far = np.bitwise_count(fp[i].view(np.uint64) ^ fp[p].view(np.uint64))
            near = (far > 0) & (far <= bits)
            if not near.any():
                continue
            values, where = np.unique(np.concatenate([fp[i[near]], fp[p[near]]]), return_inverse=True)
            half = len(where) // 2
            root = local_roots(len(values), where[:half], where[half:])
            moved = root != np.arange(len(values))
            yield pa.RecordBatch.from_arrays([pa.array(values[moved]), pa.array(values[root[moved]])], names=["a", "b"])

    return rows.select("bucket", "i", "j", "role", "fp").mapInArrow(verify, "a long, b long").distinct()


def simhash_components(docs: DataFrame, shingle: int = SHINGLE, bits: int = MAX_BITS, segments: int | None = None) -> DataFrame:
    """(doc_id, fingerprint, component_id, text_hash), one row per row of ``docs`` (doc_id, text).

    component_id is the smallest doc_id that links of ``bits`` or fewer differing bits reach, the row's own included; null
    doc_ids are the smallest only where there is no other. Null, empty and blank texts have fingerprint zero, which links like any
    other. Repeated rows share their component; an empty table gives no row.
    """
    marked = stored(with_fingerprints(docs, shingle), "fingerprints")
    values = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "fingerprint_values")
    parts = stored(components(linked(values, bits, segments)), "fingerprint_parts")
    named = parts.join(values, parts["node"] == values["fp"]).groupBy("component").agg(F.min("first_id").alias("component_id"))
    grouped = parts.join(named, "component").select(F.col("node").alias("fp"), "component_id")
    labels = values.join(grouped, "fp", "left").select("fp", F.coalesce("component_id", "first_id").alias("component_id"))
    return marked.join(labels, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "text_hash"
    )
