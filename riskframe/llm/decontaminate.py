"""Benchmark passages in documents, by Wu-Manber multi-pattern search.

Documents and test items become streams of lower-case words with one space around each. The patterns are the items'
windows of ten words. Patterns of similar length share a table: ``shift`` says for each block of the last bytes read
how far the search may jump because no pattern can end sooner; where it says zero, the hash of a longer suffix selects
the patterns of a bucket, and those are compared byte by byte. A batch of documents is searched in many lanes at once,
so a step is a few array operations and not a loop in Python.

Tables are built for groups of windows of bounded size, one pass over the documents for each group, so a benchmark of
any size is searched whole; the usual one is a single group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from riskframe.llm.common import stored
from riskframe.llm.tokens import slices

#: Words of a window, by the contract.
WINDOW = 10
#: What a word is, after A-Z became a-z.
ITEM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bytes of windows and item ids that one group of tables is built from.
GROUP_BYTES = 32_000_000
#: Positions that a lane walks through.
LANE = 2048
#: Bytes behind and before a stream, so that every load of eight bytes stays inside.
PAD = 16

_IS_WORD = [0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80 for b in range(256)]
_PLAIN = bytes((b + 32 if 0x41 <= b <= 0x5A else b) if _IS_WORD[b] else 0x20 for b in range(256))
_SPACE, _END = 0x20, 0x0A
_MIX = np.uint64(0x9E3779B97F4A7C15)

_FOUND = "n_words long, spans array<struct<start:long,stop:long>>, items array<string>"


class Stream:
    """Texts as one byte stream: words with single spaces around them, and a line feed behind each text."""

    def __init__(self, texts: list[bytes]):
        raw = np.frombuffer(b" " + b" \n ".join([t.translate(_PLAIN) for t in texts]) + b" \n ", np.uint8)
        keep = raw != _SPACE
        keep[1:] |= raw[:-1] != _SPACE
        keep[0] = True
        self.size = int(keep.sum())
        self.padded = np.zeros(self.size + 2 * PAD, np.uint8)
        self.padded[PAD : PAD + self.size] = raw[keep]
        self.bytes = self.padded[PAD : PAD + self.size]
        inside = self.bytes > _SPACE
        self.word_starts = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
        self.text_ends = np.flatnonzero(self.bytes == _END)

    def load(self, at: np.ndarray, kind: str) -> np.ndarray:
        """Little-endian integers that begin at positions of the stream."""
        width = np.dtype(kind).itemsize
        return np.ndarray((len(self.padded) - width + 1,), kind, self.padded, 0, (1,))[at + PAD]


class Table:
    """Shift and bucket tables of patterns whose lengths differ by less than a factor of two."""

    def __init__(self, patterns: list[bytes], numbers: np.ndarray):
        self.m = min(map(len, patterns))
        self.block = 4 if self.m >= 8 else 2
        heads = np.frombuffer(b"".join([p[: self.m] for p in patterns]), np.uint8).reshape(len(patterns), self.m)
        self.bits = int(np.clip(np.ceil(np.log2(len(patterns) * self.m)), 12, 22))
        self.shift = np.full(1 << self.bits, min(self.m - self.block + 1, 65_535), np.uint16)
        for end in range(self.block, self.m + 1):  # shifts fall with the end, so later ones stay
            value = np.zeros(len(heads), np.uint32)
            for k in range(self.block):
                value |= heads[:, end - self.block + k].astype(np.uint32) << np.uint32(8 * k)
            self.shift[self._slot(value)] = min(self.m - end, 65_535)
        stream = Stream([])
        stream.padded = np.concatenate([np.zeros(PAD, np.uint8), heads.reshape(-1), np.zeros(PAD, np.uint8)])
        keys = self._suffix(stream, (np.arange(len(heads)) + 1) * self.m)
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.patterns = [patterns[i] for i in order]
        self.numbers = numbers[order]
        self.lengths = np.array([len(p) for p in self.patterns], np.int64)

    def _slot(self, blocks: np.ndarray) -> np.ndarray:
        return (blocks * np.uint32(0x9E3779B1)) >> np.uint32(32 - self.bits)

    def _suffix(self, stream: Stream, ends: np.ndarray) -> np.ndarray:
        """A hash of the last bytes, 16 at most, of the m bytes before each end."""
        if self.m >= 8:
            parts = [stream.load(ends - 8, "<u8"), stream.load(ends - min(self.m, 16), "<u8")]
        else:
            parts = [stream.load(ends - k, "u1").astype(np.uint64) for k in range(1, self.m + 1)]
        key = np.zeros(len(ends), np.uint64)
        for part in parts:
            key = (key ^ part) * _MIX
            key ^= key >> np.uint64(29)
        return key

    def _stops(self, stream: Stream) -> np.ndarray:
        """Ends of m bytes at which the shift is zero."""
        at = np.arange(self.m, stream.size + 1, LANE)
        until = np.minimum(at + LANE, stream.size + 1)
        found = []
        kind = "<u4" if self.block == 4 else "<u2"
        while len(at):
            shift = self.shift[self._slot(stream.load(at - self.block, kind).astype(np.uint32))]
            stop = shift == 0
            if stop.any():
                found.append(at[stop])
            at = at + np.maximum(shift, 1)
            going = at < until
            if not going.all():
                at, until = at[going], until[going]
        return np.concatenate(found) if found else np.empty(0, np.int64)

    def search(self, stream: Stream) -> tuple[np.ndarray, np.ndarray]:
        """(pattern numbers, positions of their first byte) of all occurrences."""
        ends = self._stops(stream)
        keys = self._suffix(stream, ends)
        low, high = np.searchsorted(self.keys, keys, "left"), np.searchsorted(self.keys, keys, "right")
        hit = np.flatnonzero(high > low)
        widths = (high - low)[hit]
        row = np.repeat(hit, widths)
        which = np.arange(len(row)) - np.repeat(np.cumsum(widths) - widths, widths) + low[row]
        first = ends[row] - self.m
        fits = first + self.lengths[which] <= stream.size
        first, which = first[fits], which[fits]
        whole = memoryview(stream.bytes)
        patterns, lengths = self.patterns, self.lengths
        same = np.fromiter(
            (whole[a : a + n] == patterns[w] for a, n, w in zip(first.tolist(), lengths[which].tolist(), which.tolist())),
            bool,
            len(first),
        )
        return self.numbers[which[same]], first[same]


class Searcher:
    """All tables of a group of windows: (window text, its items' ids)."""

    def __init__(self, windows: list[tuple[str, list[str]]]):
        patterns = [f" {text} ".encode() for text, _ in windows]
        self.words = np.array([p.count(b" ") - 1 for p in patterns], np.int64)
        kinds = np.array([len(p).bit_length() for p in patterns], np.int64)
        self.tables = []
        for kind in np.unique(kinds):
            numbers = np.flatnonzero(kinds == kind)
            self.tables.append(Table([patterns[i] for i in numbers], numbers))
        names, coded = np.unique(np.array([i for _, ids in windows for i in ids], object).astype(str), return_inverse=True)
        self.item_names = pa.array(names.tolist(), pa.string())
        self.items = coded.astype(np.int64)
        self.item_ends = np.cumsum([len(ids) for _, ids in windows], dtype=np.int64)

    def occurrences(self, stream: Stream) -> tuple[np.ndarray, np.ndarray]:
        """(window numbers, numbers of their first words in the stream)."""
        found = [t.search(stream) for t in self.tables]
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        window = np.concatenate([f[0] for f in found])
        return window, np.searchsorted(stream.word_starts, np.concatenate([f[1] for f in found]))

    def items_of(self, text: np.ndarray, window: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (text, item) pairs of (text, window) pairs, sorted."""
        if not len(text) or not len(self.items):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        pair = np.unique(np.stack([text, window]), axis=1)
        starts = np.concatenate([[0], self.item_ends[:-1]])
        widths = (self.item_ends - starts)[pair[1]]
        row = np.repeat(np.arange(pair.shape[1]), widths)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(widths) - widths, widths)
        both = np.unique(np.stack([pair[0][row], self.items[starts[pair[1][row]] + nth]]), axis=1)
        return both[0], both[1]


def _offsets(owner: np.ndarray, rows: int) -> pa.Array:
    return pa.array(np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=rows))]), pa.int32())


def search_batch(searcher: Searcher, rows: pa.RecordBatch) -> list[pa.Array]:
    """n_words, spans and items of a batch (text, spans, items): what earlier groups found is kept."""
    texts = pc.fill_null(rows.column("text").cast(pa.large_binary()), b"").to_pylist()
    stream = Stream(texts)
    n = len(texts)
    text_stop = np.searchsorted(stream.word_starts, stream.text_ends)  # words up to each text's end
    text_start = np.concatenate([[0], text_stop[:-1]])
    window, word = searcher.occurrences(stream)
    text = np.searchsorted(text_stop, word, "right")

    old = rows.column("spans")
    owner = np.repeat(np.arange(n), pc.list_value_length(old).to_numpy(zero_copy_only=False).astype(np.int64))
    runs = old.flatten()
    begins = np.concatenate([word, pc.struct_field(runs, "start").to_numpy(zero_copy_only=False).astype(np.int64) + text_start[owner]])
    stops = np.concatenate([word + searcher.words[window], pc.struct_field(runs, "stop").to_numpy(zero_copy_only=False).astype(np.int64) + text_start[owner]])
    # Runs of covered words; none goes on from one text into the next.
    order = np.argsort(begins, kind="stable")
    begins, stops = begins[order], stops[order]
    of_text = np.searchsorted(text_stop, begins, "right")
    reach = np.maximum.accumulate(stops) if len(stops) else stops
    fresh = np.ones(len(begins), bool)
    fresh[1:] = (begins[1:] > reach[:-1]) | (of_text[1:] != of_text[:-1])
    first = np.flatnonzero(fresh)
    last = np.concatenate([first[1:], [len(begins)]])[: len(first)] - 1
    of_text = of_text[first]
    spans = pa.StructArray.from_arrays(
        [pa.array(begins[first] - text_start[of_text], pa.int64()), pa.array(reach[last] - text_start[of_text], pa.int64())],
        fields=[pa.field("start", pa.int64()), pa.field("stop", pa.int64())],
    )

    item_text, item = searcher.items_of(text, window)
    names = searcher.item_names.take(pa.array(item, pa.int64()))
    earlier = rows.column("items")
    if len(earlier.flatten()):
        of_old = np.repeat(np.arange(n), pc.list_value_length(earlier).to_numpy(zero_copy_only=False).astype(np.int64))
        both = sorted({*zip(of_old.tolist(), earlier.flatten().to_pylist()), *zip(item_text.tolist(), names.to_pylist())})
        item_text = np.array([t for t, _ in both], np.int64)
        names = pa.array([i for _, i in both], pa.string())
    return [
        pa.array(text_stop - text_start, pa.int64()),
        pa.ListArray.from_arrays(_offsets(of_text, n), spans),
        pa.ListArray.from_arrays(_offsets(item_text, n), names),
    ]


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(window, items, weight): every different window with the ids of the items that have it."""
    words = F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(f"({ITEM_WORD})"))
    n = F.size("words")
    starts = F.sequence(F.lit(0), F.greatest(n - window, F.lit(0)))
    return (
        benchmark.select(F.col("item_id").cast("string").alias("item_id"), words.alias("words"))
        .filter(n > 0)
        .withColumn("start", F.explode(starts))
        .select("item_id", F.array_join(F.slice("words", F.col("start") + 1, F.lit(window)), " ").alias("window"))
        .groupBy("window")
        .agg(F.collect_set("item_id").alias("items"))
        .withColumn("weight", F.octet_length("window") + 16 * F.size("items") + 32)
    )


def find_windows(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """(doc_id, n_words, spans, items), one row per row of ``docs`` (doc_id, text): where windows of ``benchmark`` occur.

    ``benchmark`` is (item_id, text). An item's windows are all runs of ``window`` words, or its whole text if that has
    fewer. ``spans`` are the maximal runs of words inside occurrences, ``items`` the ids, as text and sorted, of the
    items with an occurring window. Null and empty texts and texts without words have no words, no spans and no items;
    an item of that kind has no window. Equal windows of several items name all of them; repeated item ids count once;
    the windows of an item without an id are found but name no item. Equal or null doc_ids are rows of their own, other
    columns are not read, an empty benchmark finds nothing, an empty table gives no row.
    """
    spark = docs.sparkSession
    windows = stored(item_windows(benchmark, window), "benchmark_windows")
    total = windows.agg(F.sum("weight")).first()[0] or 0
    groups = max(1, -(-total // group_bytes))
    none = [F.expr("cast(array() as array<struct<start:long,stop:long>>) spans"), F.expr("cast(array() as array<string>) items")]
    found = docs.select("doc_id", "text", *none)
    for g in range(groups):
        part = windows.filter(F.pmod(F.xxhash64("window"), F.lit(groups)) == g).select("window", "items").toArrow()
        searcher = Searcher(list(zip(part.column(0).to_pylist(), part.column(1).to_pylist())))
        # As bytes by value: executors need no installed copy of the package.
        tables = spark.sparkContext.broadcast(cloudpickle.dumps(searcher))
        more = g + 1 < groups

        def search(batches: Iterator[pa.RecordBatch], tables=tables, more=more) -> Iterator[pa.RecordBatch]:
            searcher = cloudpickle.loads(tables.value)
            for batch in batches:
                for rows in slices(batch, "text"):
                    kept = [rows.column("doc_id"), *([rows.column("text")] if more else [])]
                    names = ["doc_id", *(["text"] if more else []), "n_words", "spans", "items"]
                    yield pa.RecordBatch.from_arrays([*kept, *search_batch(searcher, rows)], names=names)

        id_type = docs.schema["doc_id"].dataType.simpleString()
        found = found.mapInArrow(search, f"doc_id {id_type}, " + ("text string, " if more else "") + _FOUND)
        if more:
            found = stored(found, "searched")
    return found


def contamination(found: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of the rows of ``find_windows``."""
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, r: n + r["stop"] - r["start"])
    listed = F.array_join(F.array_sort("items"), ",")
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(listed, 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )
