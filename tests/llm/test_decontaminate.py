"""Benchmark windows in documents against a plain search of word lists."""

import hashlib
import random
import re

import numpy as np
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from riskframe.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans(D.UPPER, D.LOWER)


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def windows_of(items, size):
    found = {}
    for item_id, text in items:
        w = words(text)
        for i in range(max(1, len(w) - size + 1)) if w else ():
            found.setdefault(" ".join(w[i : i + size]), set()).update(() if item_id is None else (str(item_id),))
    return found


def plain(text, windows):
    w = words(text)
    covered, items = set(), set()
    for k in {len(x.split(" ")) for x in windows}:
        for i in range(len(w) - k + 1):
            found = windows.get(" ".join(w[i : i + k]))
            if found is not None:
                covered.update(range(i, i + k))
                items |= found
    return len(w), covered, sorted(items)


def same(rows, docs, items, size):
    windows = windows_of(items, size)
    got = sorted((str(r.doc_id), r.n_words, [tuple(s) for s in r.spans], r.items) for r in rows)
    want = []
    for doc_id, text in docs:
        n, covered, names = plain(text, windows)
        spans = []
        for k in sorted(covered):
            if spans and spans[-1][1] == k:
                spans[-1] = (spans[-1][0], k + 1)
            else:
                spans.append((k, k + 1))
        want.append((str(doc_id), n, spans, names))
    assert got == sorted(want)


def cases(seed, vocabulary):
    rng = random.Random(seed)
    gaps = [" ", "  ", ", ", "\n", "-", " (", "' "]

    def text(n):
        return "".join(rng.choice(vocabulary) + rng.choice(gaps) for _ in range(n))

    items = [(k, text(rng.choice([0, 1, 2, 5, 9, 10, 11, 30]))) for k in range(25)]
    items += [(3, items[7][1]), (None, items[8][1]), (99, None), (100, "..."), (None, text(12))]
    docs = [(k, text(rng.randrange(60))) for k in range(60)]
    docs += [(200 + k, text(7) + (t or "").upper() + text(5) + (t or "").replace(" ", " -- ")) for k, (_, t) in enumerate(items)]
    docs += [(1, docs[0][1]), (None, items[9][1]), (None, None), (400, ""), (401, "?!"), (402, text(20_000))]
    return docs, items


def test_rows_equal_a_plain_search(spark):
    for seed, vocabulary in ((1, ["a", "b", "Ab", "aB", "É", "9"]), (2, ["Straße", "naïve", "word", "words", "日本", "x1", "I"])):
        docs, items = cases(seed, vocabulary)
        d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("items", F.lit("clash")).withColumn("spans", F.lit(1))
        b = spark.createDataFrame(items, "item_id long, text string").withColumn("window", F.lit(0))
        for size in (10, 3):
            same(D.find_windows(d, b, size).collect(), docs, items, size)
        # Many small groups of tables find the same.
        same(D.find_windows(d, b, 10, group_bytes=3_000).collect(), docs, items, 10)


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "some words here"), (2, None)], "doc_id long, text string")
    b = spark.createDataFrame([(1, "some words")], "item_id long, text string")
    assert D.find_windows(d.limit(0), b).collect() == []
    assert [(r.doc_id, r.n_words, r.spans, r.items) for r in D.find_windows(d, b.limit(0)).orderBy("doc_id").collect()] == [(1, 3, [], []), (2, 0, [], [])]
    rows = {r.doc_id: r for r in D.contamination(D.find_windows(d, b)).collect()}
    assert rows[1].n_hit == 2 and rows[1].n_items == 1 and rows[1].contaminated
    assert rows[1].items_sha256 == hashlib.sha256(b"1").hexdigest()
    assert rows[2].n_hit == 0 and not rows[2].contaminated and rows[2].items_sha256 == hashlib.sha256(b"").hexdigest()


def test_ids_sort_as_text(spark):
    b = spark.createDataFrame([(k, "one two three") for k in (2, 10, 9, 100)], "item_id long, text string")
    d = spark.createDataFrame([("k", "ONE, two. three!")], "doc_id string, text string")
    r = D.contamination(D.find_windows(d, b)).first()
    assert r.n_items == 4 and r.items_sha256 == hashlib.sha256(b"10,100,2,9").hexdigest()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("ab ", max_size=40), min_size=1, max_size=5), st.lists(st.text("ab ", min_size=1, max_size=12), min_size=1, max_size=6))
def test_every_occurrence_of_every_pattern(texts, items):
    windows = windows_of(enumerate(items), 10)
    searcher = D.Searcher([(w, sorted(ids)) for w, ids in windows.items()])
    stream = D.Stream([t.encode() for t in texts])
    names = list(windows)
    found, first = searcher.occurrences(stream)
    got = sorted((names[w], int(f)) for w, f in zip(found, first))
    want, ahead = [], 0
    for t in texts:
        w = words(t)
        for name in names:
            k = len(name.split(" "))
            want += [(name, ahead + i) for i in range(len(w) - k + 1) if " ".join(w[i : i + k]) == name]
        ahead += len(w)
    assert got == sorted(want)


def test_long_shifts_skip_and_lanes_meet():
    """A passage at every lane border is found, in a text of many lanes."""
    passage = " ".join(f"benchmark{k}" for k in range(10))
    for shift in range(0, 150, 7):
        text = "x" * (D.LANE - 60 + shift) + " " + passage + " " + "y" * D.LANE + " " + passage
        searcher = D.Searcher([(passage, ["1"])])
        assert sorted(searcher.occurrences(D.Stream([text.encode()]))[1].tolist()) == [1, 12]
        assert np.median(searcher.tables[0].shift) > 50
