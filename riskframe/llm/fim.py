"""Fill-in-the-middle documents over seekable compressed frames.

Every text is stored as independent zstandard frames of whole lines, with a directory of what lies up to each frame's
end: lines, code points and bytes. A cut after so many lines is found in the directory; only the frame that holds it is
decompressed to learn its byte. The parts of an output are then read frame by frame in order, so a digest never needs
more than a frame at a time. Outputs are stored in the same kind of frames, and restoring a text reads them likewise.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame

from riskframe.llm.common import stored
from riskframe.llm.tokens import slices

#: Bytes of text after which a frame ends; a longer line is cut into several frames.
FRAME_BYTES = 64 * 1024
#: The sentinels in front of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SEED = 7
#: Of 100 documents, how many are transformed, and how many of those put the suffix first.
FIM_PERCENT, SPM_PERCENT = 100, 50

_DIRECTORY = "frames array<binary>, lines array<long>, chars array<long>, bytes array<long>"
_MADE = "n long, form string, prefix_chars long, middle_chars long"


class Codec:
    """The zstandard contexts of one process; a task function takes none along, but makes its own."""

    def __init__(self):
        self.compress = zstandard.ZstdCompressor(level=3).compress
        self.decompress = zstandard.ZstdDecompressor().decompress

    def __reduce__(self):
        return Codec, ()


CODEC = Codec()


class Frames(NamedTuple):
    """A text's frames, and the lines, code points and bytes up to the end of each."""

    frames: list[bytes]
    lines: list[int]
    chars: list[int]
    bytes: list[int]


def code_points(text: bytes) -> int:
    """Code points of UTF-8 bytes: all but the continuation bytes."""
    data = np.frombuffer(text, np.uint8)
    return len(data) - int(np.count_nonzero((data & 0xC0) == 0x80))


def compress(pieces: Iterable[bytes], frame_bytes: int = FRAME_BYTES) -> Frames:
    """Frames of the pieces' bytes in order. A frame ends behind its last line feed, or, where a line is longer than a
    frame, between two of its code points; lines count where they end, an unfinished last line with the text's end."""
    out = Frames([], [], [], [])
    lines = chars = size = 0
    open_line = False

    def add(block: bytes) -> None:
        nonlocal lines, chars, size, open_line
        lines, chars, size = lines + block.count(b"\n"), chars + code_points(block), size + len(block)
        open_line = not block.endswith(b"\n")
        out.frames.append(CODEC.compress(block))
        out.lines.append(lines)
        out.chars.append(chars)
        out.bytes.append(size)

    rest = b""
    for piece in pieces:
        rest = rest + piece if rest else piece
        at = 0
        while len(rest) - at > frame_bytes:
            stop = rest.rfind(b"\n", at, at + frame_bytes) + 1
            if stop <= at:
                stop = at + frame_bytes
                while stop > at + 1 and rest[stop] & 0xC0 == 0x80:
                    stop -= 1
            add(rest[at:stop])
            at = stop
        rest = rest[at:]
    if rest:
        add(rest)
    if open_line:
        out.lines[-1] += 1
    return out


def read(store: Frames, start: int, stop: int) -> Iterator[bytes]:
    """The bytes start .. stop of a text, a frame at a time; other frames stay compressed."""
    k = bisect_left(store.bytes, start + 1)
    while start < stop:
        base = store.bytes[k - 1] if k else 0
        block = CODEC.decompress(store.frames[k])
        yield block[start - base : stop - base] if start > base or stop < store.bytes[k] else block
        start, k = store.bytes[k], k + 1


def cut_at(store: Frames, line: int) -> tuple[int, int]:
    """(byte, code point) behind the first ``line`` lines: the directory names the frame, its line feeds the place."""
    if line <= 0 or not store.frames:
        return 0, 0
    k = bisect_left(store.lines, line)
    base_bytes, base_chars, before = (store.bytes[k - 1], store.chars[k - 1], store.lines[k - 1]) if k else (0, 0, 0)
    if line == store.lines[-1]:
        return store.bytes[-1], store.chars[-1]
    block = CODEC.decompress(store.frames[k])
    feeds = np.flatnonzero(np.frombuffer(block, np.uint8) == 0x0A)
    stop = int(feeds[line - before - 1]) + 1
    return base_bytes + stop, base_chars + code_points(block[:stop])


def holds_sentinel(store: Frames) -> bool:
    """Whether a text has one of the sentinels, frame borders included."""
    tail = b""
    for block in read(store, 0, store.bytes[-1] if store.bytes else 0):
        seen = tail + block
        if PREFIX in seen or SUFFIX in seen or MIDDLE in seen:
            return True
        tail = seen[-2:]
    return False


def draws(doc_id: int | None, seed: int) -> list[int]:
    """The four numbers of a document: 32 bits each of the sha256 of seed and id. A null id counts as an empty one."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[4 * k : 4 * k + 4], "big") for k in range(4)]


def arrange(store: Frames, doc_id: int | None, seed: int, fim_percent: int, spm_percent: int):
    """(form, parts, prefix code points, middle code points): parts are sentinels and byte ranges of the text in order."""
    n = store.lines[-1] if store.lines else 0
    size = store.bytes[-1] if store.bytes else 0
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not size or h3 % 100 >= fim_percent or holds_sentinel(store):
        return "plain", [(0, size)], None, None
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    (a, a_chars), (b, b_chars) = cut_at(store, low), cut_at(store, high)
    if h4 % 100 < spm_percent:
        return "spm", [SUFFIX, (b, size), PREFIX, (0, a), MIDDLE, (a, b)], a_chars, b_chars - a_chars
    return "psm", [PREFIX, (0, a), SUFFIX, (b, size), MIDDLE, (a, b)], a_chars, b_chars - a_chars


def stream(store: Frames, parts: list) -> Iterator[bytes]:
    """The output's bytes in order, a sentinel or a frame's share at a time."""
    for part in parts:
        if isinstance(part, bytes):
            yield part
        else:
            yield from read(store, *part)


def find(store: Frames, mark: bytes, start: int) -> int:
    """The first byte of ``mark`` at or behind ``start``."""
    tail, at = b"", start
    for block in read(store, start, store.bytes[-1]):
        seen = tail + block
        k = seen.find(mark)
        if k >= 0:
            return at - len(tail) + k
        at += len(block)
        tail = seen[-(len(mark) - 1) :]
    raise ValueError(f"an output without {mark.decode()}")


def restore(output: Frames, form: str) -> Iterator[bytes]:
    """The text that an output was made from, by its sentinels alone. None can begin inside a part, because the text has
    none and their first letter occurs in them only once."""
    size = output.bytes[-1] if output.bytes else 0
    if form == "plain":
        yield from read(output, 0, size)
        return
    first, second = (SUFFIX, PREFIX) if form == "spm" else (PREFIX, SUFFIX)
    a = find(output, second, len(first))
    b = find(output, MIDDLE, a + len(second))
    one, two, middle = (len(first), a), (a + len(second), b), (b + len(MIDDLE), size)
    for part in (two, middle, one) if form == "spm" else (one, middle, two):
        yield from read(output, *part)


def sha256_of(pieces: Iterable[bytes]) -> str:
    digest = hashlib.sha256()
    for piece in pieces:
        digest.update(piece)
    return digest.hexdigest()


def _directory(stores: list[Frames]) -> list[pa.Array]:
    longs = pa.list_(pa.int64())
    return [pa.array([s.frames for s in stores], pa.list_(pa.binary())), *(pa.array([s[k] for s in stores], longs) for k in (1, 2, 3))]


def _stores(rows: pa.RecordBatch) -> Iterator[Frames]:
    columns = [rows.column(c) for c in ("frames", "lines", "chars", "bytes")]
    return (Frames(*(c[i].as_py() for c in columns)) for i in range(rows.num_rows))


def frame_documents(docs: DataFrame, frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """(doc_id, frames, lines, chars, bytes): each text of ``docs`` (doc_id, text) as frames with their directory.

    Null and empty texts have no frames. Rows with equal or null doc_ids stay rows of their own; other columns are not
    read; an empty table gives no row.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "text"):
                texts = pc.fill_null(rows.column("text").cast(pa.large_binary()), b"")
                stores = [compress([t.as_py()], frame_bytes) for t in texts]
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), *_directory(stores)], names=["doc_id", "frames", "lines", "chars", "bytes"])

    return docs.select("doc_id", "text").mapInArrow(pack, f"doc_id {_id_type(docs)}, {_DIRECTORY}")


def _id_type(df: DataFrame) -> str:
    return df.schema["doc_id"].dataType.simpleString()


def fim_documents(
    framed: DataFrame, seed: int = SEED, fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT, frame_bytes: int = FRAME_BYTES
) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, frames, lines, chars, bytes): the outputs of framed documents, framed.

    ``n`` counts the text's lines. A document is cut after two hashed numbers of lines; the form is ``psm`` or ``spm`` by
    a hash, and ``plain``, the text as it is, where it is empty, has a sentinel, or is not drawn. A null doc_id draws as
    an empty one. Equal doc_ids with different texts are cut by the same numbers, each within its own lines.
    """

    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, made, stores = batch.column("doc_id"), [], []
            for doc_id, store in zip(ids.to_pylist(), _stores(batch)):
                form, parts, prefix, middle = arrange(store, doc_id, seed, fim_percent, spm_percent)
                made.append((store.lines[-1] if store.lines else 0, form, prefix, middle))
                stores.append(store if form == "plain" else compress(stream(store, parts), frame_bytes))
            n, form, prefix, middle = zip(*made) if made else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()), *_directory(stores)],
                names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "frames", "lines", "chars", "bytes"],
            )

    return framed.mapInArrow(transform, f"doc_id {_id_type(framed)}, {_MADE}, {_DIRECTORY}")


def output_texts(outputs: DataFrame) -> DataFrame:
    """(doc_id, form, output): the outputs' texts."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [b"".join(read(s, 0, s.bytes[-1] if s.bytes else 0)) for s in _stores(batch)]
            output = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("form"), output], names=["doc_id", "form", "output"])

    return outputs.mapInArrow(unpack, f"doc_id {_id_type(outputs)}, form string, output string")


def digests(outputs: DataFrame) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256) of ``fim_documents``: the digest of
    each output, and of the text that its frames and form give back."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n", "form", "prefix_chars", "middle_chars"]
        for batch in batches:
            output, restored = [], []
            for form, store in zip(batch.column("form").to_pylist(), _stores(batch)):
                output.append(sha256_of(read(store, 0, store.bytes[-1] if store.bytes else 0)))
                restored.append(sha256_of(restore(store, form)))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(output, pa.string()), pa.array(restored, pa.string())],
                names=[*names, "output_sha256", "restored_sha256"],
            )

    return outputs.mapInArrow(hashed, f"doc_id {_id_type(outputs)}, {_MADE}, output_sha256 string, restored_sha256 string")


def transform_documents(docs: DataFrame, **options) -> DataFrame:
    """The framed outputs of ``docs`` (see ``fim_documents``), made from frames that are written once."""
    return fim_documents(stored(frame_documents(docs), "text_frames"), **options)
