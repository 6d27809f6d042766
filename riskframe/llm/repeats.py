"""Removal of repeated byte strings by bucket-pointer refinement of a sparse suffix array.

Names. The identifier of a string of 2k bytes is made from the identifiers of its two halves, so one pass names the
strings of 8, 16, .. 128 bytes at every offset, each level reusing the last, and any longer string is named by the
identifiers at a few later offsets. Identifiers are 64-bit hashes rather than ranks: every task computes the same ones.

Suffixes. Of the 200-byte windows at every offset, each has one anchor: its smallest q-gram by identifier (the leftmost
of equals). Equal windows have equal anchors at the same distance, so only anchors - one suffix in about 85 - are
sorted; windows that share an anchor are one row, its span.

Buckets. Rows are dealt out by their anchor's q-gram bucket and sorted by the identifier of the whole span. Equal spans
settle all their windows at once. Only buckets with several different spans go on, one row per different span: runs
of 13 windows are compared by the identifiers of the bytes that they share and of the bytes that they cover; runs that
neither settles are compared window by window.

Buckets that hold many rows are split by span (equal spans stay together), and equal spans within a batch are merged
before the shuffle, so no key gathers its rows in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from riskframe.llm.common import stored
from riskframe.llm.tokens import slices

WINDOW = 200
GRAM = 32
STARTS = WINDOW - GRAM + 1
#: Window starts worked on at once: the arrays then fit a core's cache.
CHUNK = 1 << 16
RUN = 13
#: Buckets above this number of rows are split, by a count over every 64th document (it moves work, not results).
HOT_ROWS = 50_000
SAMPLED = 64
PARTS = 64

_C = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)]


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The identifier of two identifiers in order."""
    h = a * _C[0] + (b ^ (b >> np.uint64(29))) * _C[1]
    h ^= h >> np.uint64(32)
    h *= _C[2]
    h ^= h >> np.uint64(29)
    return h


def names(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Identifiers of the 32-byte and 128-byte strings at every offset (strings past the end hold zero bytes)."""
    n = len(data)
    padded = np.zeros(n + 264, np.uint8)
    padded[:n] = data
    h = np.empty(n + 256, np.uint64)
    for k in range(8):
        part = h[k::8]
        part[:] = padded[k : k + 8 * len(part)].view("<u8")
    h = mixed(h, h)
    h = mixed(h[:-8], h[8:])
    gram = mixed(h[:-16], h[16:])
    h = mixed(gram[:-32], gram[32:])
    return gram, mixed(h[:-64], h[64:])


def string_name(long: np.ndarray, start: np.ndarray, length) -> np.ndarray:
    """Identifier of strings of 128 to 384 bytes from the identifiers of the 128 bytes at three offsets."""
    middle = start + (length - 128) // 2
    return mixed(mixed(long[start], long[middle]), long[start + length - 128])


def anchors(data: np.ndarray, ends: np.ndarray, chunk: int = CHUNK):
    """(gram, span, anchor offset, first and last window start) of all windows that lie within a text.

    ``ends`` are the ends of the texts in ``data``.
    """
    out = []
    begins = np.concatenate([[0], ends[:-1]])
    inside = np.zeros(len(data) + 1, np.int32)
    fits = ends - begins >= WINDOW
    inside[begins[fits]] += 1
    np.add.at(inside, ends[fits] - WINDOW + 1, -1)
    inside = np.cumsum(inside)[:-1] > 0
    a, chunk = 0, max(chunk, 2 * STARTS)  # more than one anchor's windows, so every chunk ends further on
    while a < len(data):
        starts = inside[a : a + chunk]
        if not starts.any():
            a += len(starts)
            continue
        gram, long = names(data[a : a + len(starts) + WINDOW])
        place = np.arange(len(starts) + STARTS - 1, dtype=np.uint64)
        low = (gram[: len(place)] >> np.uint64(24) << np.uint64(24)) | place
        width = 1
        while 2 * width <= STARTS:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        low = np.minimum(low[: len(starts)], low[STARTS - width : STARTS - width + len(starts)])
        at = (low & np.uint64((1 << 24) - 1)).astype(np.int64)
        cut = np.ones(len(at), bool)
        cut[1:] = (at[1:] != at[:-1]) | (starts[1:] != starts[:-1])
        first = np.flatnonzero(cut)
        last = np.append(first[1:], len(at)) - 1
        here, a = a, a + len(starts)
        if a < len(data):  # the last anchor's windows may go on: the next chunk begins with all of them
            a = here + int(first[-1])
            first, last = first[:-1], last[:-1]
        first, last = first[starts[first]], last[starts[first]]
        if len(first):
            # Texts that touch can share an anchor only through windows outside both, which `inside` cuts away.
            p = at[first]
            distance = ((p - first) << 16 | (p - last)).astype(np.uint64)
            span = mixed(string_name(long, first, last - first + WINDOW), distance)
            out.append((gram[p], span, p + here, first + here, last + here))
    if not out:
        return tuple(np.empty(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64))
    return tuple(np.concatenate(x) for x in zip(*out))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of an Arrow string array one after another, and where each text ends. Null is empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, 8 * column.offset)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets[1:] - offsets[0]


def merged(owner: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Intervals a .. b of each owner, those that touch or overlap made one."""
    order = np.lexsort((a, owner))
    owner, a, b = owner[order], a[order], b[order]
    if not len(a):
        return owner, a, b
    reach = np.maximum.accumulate(owner * (b.max() + 1) + b) - owner * (b.max() + 1)
    new = np.ones(len(a), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (a[1:] > reach[:-1])
    first = np.flatnonzero(new)
    return owner[first], a[first], np.maximum.reduceat(b, first)


#: kind 0: a span (a: anchor, b: its distances from the last and first window); kind 1: bytes a .. b are repeated.
_ROWS = "kind byte, gram long, span long, doc_id long, uid long, a long, b long, twice boolean"
_NAMES = [f.split()[0] for f in _ROWS.split(", ")]


def _batch(kind, gram, span, doc_id, uid, a, b, twice) -> pa.RecordBatch:
    n = len(a)
    columns = [
        pa.array(np.full(n, kind, np.int8)), pa.array(gram.view(np.int64)), pa.array(span.view(np.int64)), doc_id, uid,
        pa.array(a), pa.array(b), pa.array(twice) if len(twice) else pa.array([], pa.bool_()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=_NAMES)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of every text; those that a batch holds more than once are settled here and leave one row."""
    for batch in batches:
        for rows in slices(batch, "text"):
            data, ends = text_bytes(rows.column("text"))
            gram, span, at, first, last = anchors(data, ends)
            if not len(gram):
                continue
            text = np.searchsorted(ends, first, side="right")
            begin = np.concatenate([[0], ends])[text]
            order = np.lexsort((span, gram))
            new = np.ones(len(order), bool)
            new[1:] = (gram[order][1:] != gram[order][:-1]) | (span[order][1:] != span[order][:-1])
            run = np.cumsum(new) - 1
            twice = np.bincount(run)[run] > 1
            head = order[new]
            many = order[twice]
            doc_id, uid = rows.column("doc_id"), rows.column("uid")
            distances = ((at - last) << 16) | (at - first)
            t = pa.array(text[head])
            yield _batch(0, gram[head], span[head], doc_id.take(t), uid.take(t), (at - begin)[head], distances[head], twice[new])
            if len(many):
                owner, a, b = merged(text[many], (first - begin)[many], (last - begin)[many] + WINDOW)
                t, spread = pa.array(owner), mixed(a.astype(np.uint64), owner.astype(np.uint64))
                yield _batch(1, spread, spread, doc_id.take(t), uid.take(t), a, b, np.zeros(len(a), bool))


def _refine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of buckets: equal spans become intervals; one row per span stays if its bucket has several.

    Only the last span of a batch is held until the next one shows what follows it.
    """
    held = None

    def work(table: pa.RecordBatch, final: bool):
        nonlocal held
        gram, span = table.column("gram").to_numpy(), table.column("span").to_numpy()
        part, kind = table.column("part").to_numpy(), table.column("kind").to_numpy()
        n = len(gram)
        bucket_new = np.ones(n, bool)
        bucket_new[1:] = (gram[1:] != gram[:-1]) | (part[1:] != part[:-1]) | (kind[1:] != kind[:-1])
        new = bucket_new.copy()
        new[1:] |= span[1:] != span[:-1]
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, n))
        done = len(first) if final else len(first) - 1
        flag = table.column("twice").to_numpy(zero_copy_only=False)
        more = table.column("several").to_numpy(zero_copy_only=False)
        bucket = np.cumsum(bucket_new) - 1
        spans_in = np.bincount(bucket[first])
        any_twice = np.maximum.reduceat(flag, first) | (size > 1)
        several = (spans_in > 1)[bucket[first]] | np.maximum.reduceat(more, first) | (part[first] >= 0)
        equal = np.repeat(any_twice, size) & (kind == 0)
        if not final:  # rows of the span that may go on: known to repeat or not once it has ended
            equal[first[done] :] = False
        hits = np.flatnonzero(equal | ((kind == 1) & (np.arange(n) < (first[done] if not final else n))))
        a, b = table.column("a").to_numpy(), table.column("b").to_numpy()
        if len(hits):
            is_span = kind[hits] == 0
            begin = np.where(is_span, a[hits] - (b[hits] & 0xFFFF), a[hits])
            end = np.where(is_span, a[hits] - (b[hits] >> 16) + WINDOW, b[hits])
            t = pa.array(hits)
            zero = np.zeros(len(hits), np.int64)
            yield _batch(1, zero, zero, table.column("doc_id").take(t), table.column("uid").take(t), begin, end, np.zeros(len(hits), bool))
        heads = first[:done][(several & (kind[first] == 0))[:done]]
        if len(heads):
            t = pa.array(heads)
            twice = any_twice[:done][(several & (kind[first] == 0))[:done]]
            yield _batch(0, gram[heads], span[heads], table.column("doc_id").take(t), table.column("uid").take(t), a[heads], b[heads], twice)
        if final:
            held = None
            return
        # The open span goes on as one row per pair of rows at most: a repeated one is settled now, but for its head.
        rest = np.arange(first[done], n)
        if len(rest) > 1 and kind[rest[0]] == 0:
            t = pa.array(rest[1:])
            zero = np.zeros(len(rest) - 1, np.int64)
            yield _batch(1, zero, zero, table.column("doc_id").take(t), table.column("uid").take(t), a[rest[1:]] - (b[rest[1:]] & 0xFFFF), a[rest[1:]] - (b[rest[1:]] >> 16) + WINDOW, np.zeros(len(rest) - 1, bool))
            flag = flag.copy()
            flag[rest[0]] = True
        if kind[rest[0]] == 0:
            rest = rest[:1]
        held = table.take(pa.array(rest))
        held = held.set_column(held.schema.get_field_index("twice"), "twice", pa.array(flag[rest]))
        held = held.set_column(held.schema.get_field_index("several"), "several", pa.array(np.full(len(rest), several[done])))

    for batch in batches:
        batch = batch.append_column("several", pa.array(np.zeros(batch.num_rows, bool)))
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        if batch.num_rows:
            yield from work(batch, False)
    if held is not None:
        yield from work(held, True)


_SPANS = "gram long, span long, doc_id long, uid long, a long, b long, twice boolean, bytes_before int, bytes binary"


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes around the anchors that each text lists: all that its windows can cover."""
    names_ = [f.split()[0] for f in _SPANS.split(", ")]
    for batch in batches:
        texts = pc.fill_null(batch.column("text").cast(pa.large_binary()), b"")
        lists = batch.column("spans")
        for row in range(batch.num_rows):
            spans = lists[row].values
            view = memoryview(texts[row].as_buffer())
            anchor = spans.field("a").to_numpy()
            before = np.minimum(anchor, STARTS - 1)
            found = [bytes(view[p - k : p + WINDOW]) for p, k in zip(anchor.tolist(), before.tolist())]
            n = len(found)
            ids = [pa.array([batch.column(c)[row].as_py()] * n, pa.int64()) for c in ("doc_id", "uid")]
            columns = [spans.field("gram"), spans.field("span"), *ids, spans.field("a"), spans.field("b"), spans.field("twice")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(before, pa.int32()), pa.array(found, pa.binary())], names=names_)


def _placed(batch: pa.RecordBatch):
    """Of the spans in a batch: long identifiers of their bytes, where each anchor is in them, bytes before and after it."""
    data, ends = text_bytes(batch.column("bytes"))
    begin = np.concatenate([[0], ends[:-1]])
    before = batch.column("bytes_before").to_numpy().astype(np.int64)
    return names(data)[1], begin + before, before, ends - begin - before


def _small(batches: Iterator[pa.RecordBatch], rows: int = 2_000) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a in range(0, batch.num_rows, rows):
            yield batch.slice(a, rows)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, cover, gram, span, run): per run of window distances the identifier of the shared and the covered bytes."""
    for batch in _small(batches):
        long, anchor, before, after = _placed(batch)
        b = batch.column("b").to_numpy()
        lowest, highest = (b >> 16) // RUN, (b & 0xFFFF) // RUN
        count = highest - lowest + 1
        row = np.repeat(np.arange(len(b)), count)
        run = np.repeat(lowest, count) + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        near, far = run * RUN, run * RUN + RUN - 1
        fits = (near <= before[row]) & (WINDOW - far <= after[row])
        row, run, near, far = row[fits], run[fits], near[fits], far[fits]
        gram = batch.column("gram").to_numpy().view(np.uint64)
        shared = string_name(long, anchor[row] - near, WINDOW - RUN + 1)
        key = mixed(mixed(shared, run.astype(np.uint64)), gram[row])
        whole = (far <= before[row]) & (WINDOW - near <= after[row])
        cover = np.zeros(len(row), np.uint64)
        cover[whole] = string_name(long, anchor[row[whole]] - far[whole], WINDOW + RUN - 1)
        t = pa.array(row)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(key.view(np.int64)),
                pa.array(cover.view(np.int64), mask=~whole),
                batch.column("gram").take(t),
                batch.column("span").take(t),
                pa.array(run.astype(np.int32)),
            ],
            names=["key", "cover", "gram", "span", "run"],
        )


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, doc_id, uid, a, twice): the identifier of every window in the runs that are still open; a: its start."""
    for batch in _small(batches, 500):
        long, anchor, before, after = _placed(batch)
        b = batch.column("b").to_numpy()
        runs = batch.column("runs")
        row = np.repeat(np.arange(len(b)), pc.list_value_length(runs).to_numpy())
        run = runs.flatten().to_numpy().astype(np.int64)
        distance = (run[:, None] * RUN + np.arange(RUN)).ravel()
        row = np.repeat(row, RUN)
        keep = (distance >= b[row] >> 16) & (distance <= b[row] & 0xFFFF) & (distance <= before[row]) & (WINDOW - distance <= after[row])
        row, distance = row[keep], distance[keep]
        gram = batch.column("gram").to_numpy().view(np.uint64)
        key = mixed(mixed(string_name(long, anchor[row] - distance, WINDOW), distance.astype(np.uint64)), gram[row])
        t = pa.array(row)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(key.view(np.int64)),
                *(batch.column(c).take(t) for c in ("doc_id", "uid")),
                pa.array(batch.column("a").to_numpy()[row] - distance),
                batch.column("twice").take(t),
            ],
            names=["key", "doc_id", "uid", "a", "twice"],
        )


def _identified(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("uid"))


def repeated_bytes(docs: DataFrame) -> DataFrame:
    """(doc_id, uid, a, b): byte intervals that hold all repeated windows of ``docs``; uid is xxhash64(doc_id, text)."""
    texts = _identified(docs)
    hot = stored(
        texts.filter(F.pmod("uid", F.lit(SAMPLED)) == 0)
        .mapInArrow(_scan, _ROWS)
        .filter("kind = 0")
        .groupBy("gram")
        .count()
        .filter(F.col("count") * SAMPLED > HOT_ROWS)
        .select("gram", F.lit(True).alias("hot")),
        "hot_grams",
        1,
    )
    spans = texts.mapInArrow(_scan, _ROWS)
    part = F.lit(-1)
    if hot.limit(1).count():  # at most one in HOT_ROWS rows
        spans = spans.join(F.broadcast(hot), "gram", "left")
        part = F.when(F.col("hot"), F.pmod("span", F.lit(PARTS))).otherwise(F.lit(-1))
    sorted_ = (
        spans.withColumn("part", part.cast("int"))
        .repartition("gram", "part")
        .sortWithinPartitions("kind", "gram", "part", "span")
        .select(*_NAMES, "part")
    )
    refined = stored(sorted_.mapInArrow(_refine, _ROWS), "spans")
    listed = (
        refined.filter("kind = 0")
        .groupBy("doc_id", "uid")
        .agg(F.collect_list(F.struct("gram", "span", "a", "b", "twice")).alias("spans"))
    )
    same = F.expr("t.doc_id <=> l.doc_id and t.uid = l.uid")
    found = texts.alias("t").join(listed.hint("shuffle_hash").alias("l"), same).select("t.doc_id", "t.uid", "text", "spans")
    # A text that is there several times has its spans marked as repeated already; one of each is enough.
    contexts = stored(found.mapInArrow(_contexts, _SPANS), "span_contexts")

    runs = contexts.mapInArrow(_runs, "key long, cover long, gram long, span long, run int")
    groups = runs.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.count("cover").alias("covers"), F.min("cover").alias("low"), F.max("cover").alias("high")
    )
    # Bytes shared with nobody: no window is. Covered bytes all the same: every window is. Else: window by window.
    shared = groups.filter("n > 1").select("key", F.expr("n = covers and low = high").alias("whole"))
    open_runs = (
        runs.join(shared, "key")
        .groupBy("gram", "span")
        .agg(
            F.collect_set(F.when(~F.col("whole"), F.col("run"))).alias("runs"),
            F.collect_set(F.when(F.col("whole"), F.col("run"))).alias("whole"),
        )
    )
    judged = stored(contexts.join(open_runs, ["gram", "span"]), "span_runs")
    whole = (
        judged.filter("not twice")
        .select("doc_id", "uid", "a", "b", F.explode("whole").alias("run"))
        .select(
            "doc_id", "uid",
            (F.col("a") - F.least(F.col("run") * RUN + RUN - 1, F.col("b").bitwiseAND(F.lit(0xFFFF).cast("long")))).alias("a"),
            (F.col("a") - F.greatest(F.col("run") * RUN, F.shiftright("b", 16)) + WINDOW).alias("b"),
        )
    )
    windows = judged.filter(F.size("runs") > 0).mapInArrow(_windows, "key long, doc_id long, uid long, a long, twice boolean")
    again = windows.groupBy("key").count().filter("count > 1").select("key")
    single = (
        windows.filter("not twice").join(again, "key", "left_semi").select("doc_id", "uid", "a", (F.col("a") + WINDOW).alias("b"))
    )
    return refined.filter("kind = 1").select("doc_id", "uid", "a", "b").unionByName(whole).unionByName(single)


def _remove(with_text: bool, with_row: bool):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "text"):
                texts = pc.fill_null(rows.column("text").cast(pa.large_binary()), b"")
                lists = rows.column("intervals")
                removed, runs, digests, kept_texts = [], [], [], []
                for row in range(rows.num_rows):
                    view = memoryview(texts[row].as_buffer())
                    kept = bytes(view)
                    n_runs = 0
                    if lists[row].is_valid:
                        pairs = lists[row].values
                        a, b = pairs.field("a").to_numpy(), pairs.field("b").to_numpy()
                        _, a, b = merged(np.zeros(len(a), np.int64), a, b)
                        n_runs = len(a)
                        edges = [0, *np.stack([a, b], 1).ravel().tolist(), len(view)]
                        kept = b"".join(view[x:y] for x, y in zip(edges[::2], edges[1::2]))
                    removed.append(len(view) - len(kept))
                    runs.append(n_runs)
                    digests.append(hashlib.sha256(kept).hexdigest())
                    if with_text:
                        # A cut can fall within a character; its bytes left and right of it are no text.
                        kept_texts.append(kept.decode("utf-8", "ignore") if n_runs else rows.column("text")[row].as_py())
                columns = [
                    rows.column("doc_id"),
                    rows.column("uid"),
                    pc.binary_length(texts).cast(pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(runs, pa.int64()),
                    pa.array(digests, pa.string()),
                ]
                names_ = ["doc_id", "uid", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
                if with_text:
                    columns.append(pa.array(kept_texts, pa.string()))
                    names_.append("kept_text")
                if with_row:
                    columns.append(rows.column("row"))
                    names_.append("row")
                yield pa.RecordBatch.from_arrays(columns, names=names_)

    return work


def remove_repeats(docs: DataFrame, with_text: bool = False, with_row: bool = False) -> DataFrame:
    """(doc_id, uid, n_bytes, n_removed, n_spans, kept_sha256[, kept_text][, row]), one row per row of ``docs`` (doc_id, text).

    Every byte that lies in a 200-byte string which starts anywhere else too, in the same document or another, goes;
    strings are judged on the input. Null and empty texts and texts under 200 bytes lose nothing. Repeated rows are repeats of each
    other and lose all windows, the first one too. Null doc_ids are values like any other; an empty table gives no row.
    ``row`` holds all columns but the text, whatever they are called.
    """
    found = [T.StructField(n, T.LongType()) for n in ("doc_id", "uid", "n_bytes", "n_removed", "n_spans")]
    found += [T.StructField(n, T.StringType()) for n in ("kept_sha256", *(["kept_text"] if with_text else []))]
    left = _identified(docs)
    if with_row:
        rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])
        left = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("uid"), rest.alias("row"))
        found.append(left.schema["row"])
    intervals = repeated_bytes(docs).groupBy("doc_id", "uid").agg(F.collect_set(F.struct("a", "b")).alias("intervals"))
    same = F.expr("t.doc_id <=> l.doc_id and t.uid = l.uid")
    joined = left.alias("t").join(intervals.hint("shuffle_hash").alias("l"), same, "left")
    columns = ["t.doc_id", "t.uid", "text", "intervals", *(["row"] if with_row else [])]
    return joined.select(*columns).mapInArrow(_remove(with_text, with_row), T.StructType(found))
