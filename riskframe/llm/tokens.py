"""Token ids of whole texts, by the ``tokenizers`` library, with a bounded word cache inside each worker.

Where a vocabulary drops white space and never merges across it, as the default one does, the ids of a text are the
ids of its space-separated pieces in order. Each Arrow batch is then cut into pieces and dictionary-encoded in native
code; only pieces that the worker hasn't met yet go to the tokenizer. The cache holds ``MAX_PIECES`` pieces and is
emptied when it is full: it changes the speed, never the ids. Probes at load tell whether a vocabulary is of that
kind; with any other one whole texts go to the tokenizer.
"""

from __future__ import annotations

import sys
from itertools import chain, repeat
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pieces kept by a worker: about 150 bytes each.
MAX_PIECES = 550_000
#: Texts longer than this are still encoded whole, but in a batch of their own.
BATCH_CHARS = 6_000_000
#: Stops behind an ASCII letter are a token of their own, so a space between them changes no id.
STOPS = r"([A-Za-z])([.,]+)(\s)"

#: Pairs of pieces that a vocabulary must encode alike together, with any white space between them, and apart.
PROBES = [("the", "Cats"), ("don't", "'s"), ("12", "34,"), ("a", "a"), ("...", ".x"), ("É", "日本"), ("", "word"), ("word", "")]
#: Signs that may stand between pieces that are encoded together, and how many pieces are.
SIGNS = "|~^#"
JOINED = 1_000

#: What a process keeps from task to task: a task's function brings globals of its own, a module by name is the process's.
KEPT = "riskframe_kept"


def default_tokenizer() -> str:
    """The vocabulary file that the queries use; every operator takes another path as a parameter."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def kept(kind: str, name: str, make):
    """The process's one object of a kind, made anew when another name is asked for."""
    objects = vars(sys.modules.setdefault(KEPT, ModuleType(KEPT))).setdefault("objects", {})
    if objects.get(kind, (None,))[0] != name:
        objects[kind] = (name, make())
    return objects[kind][1]


def encoder(path: str) -> "PieceEncoder":
    """The worker's encoder for a vocabulary file, made once per process and used by all of its tasks."""
    return kept("encoder", path, lambda: PieceEncoder(path))


class PieceEncoder:
    def __init__(self, path: str, max_pieces: int = MAX_PIECES):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.max_pieces = max_pieces
        self.apart = all(self._ids(a + gap + b) == self._ids(a) + self._ids(b) for a, b in PROBES for gap in (" ", "\n", "  "))
        self.plain = self._ids("A.,. B") == self._ids("a .,. b")  # lower-cases, and cuts stops from letters
        marks = [(sign.encode(), ids[0]) for sign in SIGNS if len(ids := self._ids(sign)) == 1]
        self.mark = marks[0] if marks else None
        self._reset()

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _reset(self) -> None:
        self.slots: dict[bytes, int] = {}
        self.starts = np.empty(0, np.int64)
        self.lens = np.empty(0, np.int64)
        self.ids = np.empty(0, np.uint32)

    def _learn(self, pieces: list[bytes]) -> None:
        """Encode pieces that are new: many in one text, with marks between them, as a text costs more than a piece."""
        ids, counts = self._whole([p.decode() for p in pieces]) if self.mark is None else self._marked(pieces)
        self.slots.update(zip(pieces, range(len(self.starts), len(self.starts) + len(pieces))))
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(counts) - counts])
        self.lens = np.concatenate([self.lens, counts])
        self.ids = np.concatenate([self.ids, ids])

    def _marked(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        sign, mark = self.mark
        # A piece with the sign in it must not be taken for a mark: it stands by itself, and nothing in its place.
        odd = [k for k, p in enumerate(pieces) if sign in p]
        if odd:
            own = self._whole([pieces[k].decode() for k in odd])
            pieces = pieces.copy()
            for k in odd:
                pieces[k] = b""
        gap = b" " + sign + b" "
        texts = [gap.join(pieces[k : k + JOINED]).decode() + gap.decode() for k in range(0, len(pieces), JOINED)]
        ids = self._whole(texts)[0]
        ends = np.flatnonzero(ids == mark)
        counts = np.diff(ends, prepend=-1) - 1
        ids = np.delete(ids, ends)
        if odd:
            at = (np.cumsum(counts) - counts)[odd]
            ids = np.insert(ids, np.repeat(at, own[1]), own[0])
            counts[odd] = own[1]
        return ids, counts

    def _whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        rows = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        counts = np.fromiter(map(len, rows), np.int64, len(rows))
        return np.fromiter(chain.from_iterable(rows), np.uint32, int(counts.sum())), counts

    def _slots_of(self, pieces: list[bytes]) -> np.ndarray:
        """The pieces' places in the cache; those it hasn't are learned."""
        found = np.fromiter(map(self.slots.get, pieces, repeat(-1)), np.int64, len(pieces))
        new = np.flatnonzero(found < 0)
        if len(new) and len(self.slots) + len(new) > self.max_pieces:
            self._reset()
            new = np.arange(len(pieces))
        if len(new):
            found[new] = len(self.slots) + np.arange(len(new))
            self._learn([pieces[k] for k in new.tolist()])
        return found

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of an Arrow string array one after another, and how many each text has. Null: none."""
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        if not self.apart:
            return self._whole(texts.to_pylist())
        if self.plain:  # in this order: ascii_lower misreads the offsets of a sliced large array
            texts = pc.ascii_lower(pc.replace_substring_regex(texts, STOPS, r"\1 \2\3"))
        lists = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        per_text = np.diff(lists.offsets.to_numpy())
        coded = lists.flatten().dictionary_encode()
        slots = self._slots_of(coded.dictionary.cast(pa.large_binary()).to_pylist())
        at = slots[coded.indices.to_numpy()]
        lens = self.lens[at]
        ends = np.cumsum(lens)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.ids[np.repeat(self.starts[at] - (ends - lens), lens) + np.arange(total)]
        sums = np.concatenate([[0], ends])
        last = np.cumsum(per_text)
        return ids, sums[last] - sums[last - per_text]


def slices(batch: pa.RecordBatch, column: str, chars: int = BATCH_CHARS):
    """The batch in runs of rows whose texts hold about ``chars`` bytes, so that a worker's memory is bounded."""
    if batch.num_rows == 0:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(sizes) // chars
    cuts = np.flatnonzero(np.diff(group)) + 1
    for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
        yield batch.slice(a, b - a)
    # Workers live on for other stages; what Arrow has set aside here would add up.
    pa.default_memory_pool().release_unused()
