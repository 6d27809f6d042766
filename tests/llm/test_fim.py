"""Fill-in-the-middle against plain string operations, and the frames against whole texts."""

import hashlib
import re

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from riskframe.llm import fim

LINE = re.compile(r"[^\n]*\n|[^\n]+")


def plain(doc_id, text, seed=7, fim_percent=100, spm_percent=50):
    """(n, form, prefix characters, middle characters, output) by definition."""
    text = text or ""
    units = LINE.findall(text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= fim_percent:
        return n, "plain", None, None, text
    if h[3] % 100 < spm_percent:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


TEXTS = [
    None, "", "\n", "one line", "one line\n", "a\n\n\nb", "\n\n", "É日本😀\nnaïve\n" * 40, "<P", "S>\n<", "x<P>y", "a\n<M>", "<\nS>", "\r\nwin\r\n",
    "<" * 50 + "\n" + "M>" * 9, "long " * 30_000, ("line of text\n" * 9_000) + "end", "😀" * 40_000 + "\n" + "é" * 40_000,
]


def test_rows_equal_the_definition(spark):
    rows = [(k, t) for k, t in enumerate(TEXTS)] + [(None, "no id\nat all\n"), (3, "same id\nother text"), (3, "one line")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("frames", F.lit("clash")).withColumn("n", F.lit(0))
    for options in ({}, {"fim_percent": 50, "seed": 11}, {"spm_percent": 100}, {"spm_percent": 0}):
        want = sorted(
            (str(d), n, form, str(p), str(m), sha(out), sha(t or ""))
            for d, t in rows
            for n, form, p, m, out in [plain(d, t, **options)]
        )
        made = fim.transform_documents(docs, **options)
        got = sorted((str(r[0]), r[1], r[2], str(r[3]), str(r[4]), r[5], r[6]) for r in fim.digests(made).collect())
        assert got == want
        texts = sorted((str(r.doc_id), r.form, r.output) for r in fim.output_texts(made).collect())
        assert texts == sorted((str(d), x[1], x[4]) for d, t in rows for x in [plain(d, t, **options)])
    assert fim.digests(fim.transform_documents(docs.limit(0))).collect() == []


PIECES = st.lists(st.sampled_from(["a", "\n", "é", "日", "😀", "<", "S>", "M>", "P>", "<P", "<S>", "bc\n"]), max_size=40).map("".join)


@settings(max_examples=300, deadline=None)
@given(PIECES, st.integers(1, 9), st.integers(0, 99))
def test_tiny_frames(text, frame_bytes, doc_id):
    """Frames of a few bytes: cuts, marks and code points on every border."""
    store = fim.compress([text.encode()], frame_bytes)
    size = len(text.encode())
    assert b"".join(fim.read(store, 0, size)) == text.encode()
    assert (store.lines[-1] if store.lines else 0) == len(LINE.findall(text))
    units = LINE.findall(text)
    for k in range(len(units) + 1):
        head = "".join(units[:k])
        assert fim.cut_at(store, k) == (len(head.encode()), len(head))
    for a in range(0, size, 3):
        for b in range(a, size + 1, 4):
            assert b"".join(fim.read(store, a, b)) == text.encode()[a:b]
    form, parts, p, m = fim.arrange(store, doc_id, 7, 100, 50)
    n, want_form, want_p, want_m, output = plain(doc_id, text)
    assert (form, p, m) == (want_form, want_p, want_m)
    made = store if form == "plain" else fim.compress(fim.stream(store, parts), frame_bytes)
    assert b"".join(fim.read(made, 0, made.bytes[-1] if made.bytes else 0)).decode() == output
    assert b"".join(fim.restore(made, form)).decode() == text


def test_only_cut_frames_are_opened(monkeypatch):
    """A cut deep in a long text decompresses one frame."""
    store = fim.compress([b"some line\n" * 100_000])
    assert len(store.frames) > 10
    opened = []

    class Spy:
        def decompress(self, frame):
            opened.append(frame)
            return fim.Codec().decompress(frame)

    monkeypatch.setattr(fim, "CODEC", Spy())
    assert fim.cut_at(store, 77_777) == (777_770, 777_770) and len(opened) == 1
    assert b"".join(fim.read(store, 500_000, 500_010)) == b"some line\n" and len(opened) == 2
