"""Automata against edit distance, quotation, and held-out accuracy."""

import random
import zlib

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from riskframe.llm import toxicity

WORDS = ["stupid", "moron", "scum", "worthless", "clown"]


def distance(a, b):
    """Edits with swaps of neighbours, by the plain table."""
    d = {(i, j): i + j for i in range(len(a) + 1) for j in range(len(b) + 1) if i * j == 0}
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]


@settings(max_examples=300, deadline=None)
@given(st.sampled_from(WORDS), st.integers(0, 2**32), st.integers(0, 2))
def test_automaton_is_edit_distance(word, seed, edits):
    rng = random.Random(seed)
    for _ in range(edits):
        at, kind = rng.randrange(len(word)), rng.randrange(4)
        c = rng.choice("aomst")
        word = [word[:at] + word[at + 1 :], word[:at] + c + word[at:], word[:at] + c + word[at + 1 :], word[:at] + word[at : at + 2][::-1] + word[at + 2 :]][kind]
        word = word or "x"
    trie = toxicity.Trie(WORDS, [])
    assert sorted(trie.near(word)) == sorted(t for t in WORDS if distance(word, t) <= trie.edits(t))


def test_hits_and_quotation():
    trie = toxicity.Trie(WORDS, ["lowei"])
    texts = ["You MORON, loweian!", 'He said "you are a moron" and left.', "st0pid stupit w0rthless", "scun is not near", "a moron", "", None, "«moron»", "the clwon\tagain"]
    got = toxicity.features(pa.array(texts), trie, {})
    assert got.tolist() == [[2, 0, 0], [0, 0, 1], [0, 3, 0], [0, 0, 0], [1, 0, 0], [0, 0, 0], [0, 0, 0], [0, 0, 1], [0, 1, 0]]
    assert toxicity.features(pa.array([], pa.string()), trie, {}).shape == (0, 3)


def test_weights():
    assert np.allclose(toxicity.fit_weights(np.zeros((0, 3)), np.zeros(0)), toxicity.PRIOR)
    hits = np.array([[3, 0, 0], [0, 0, 0], [2, 1, 0], [0, 0, 3]] * 50)
    w = toxicity.fit_weights(hits, np.array([1, 0, 1, 0] * 50))
    score = lambda *h: np.log1p(h) @ w[:3] + w[3]
    assert score(3, 0, 0) > 0 > score(0, 0, 3) and (w[:3] >= 0).all()


def test_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = {r.doc_id: r for r in toxicity.score_toxicity(docs, labels).collect()}
    assert len(rows) == docs.count()
    import zlib

    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in rows.items())
    held = [(rows[r.doc_id].predicted, r.toxic) for r in labels.collect() if rows[r.doc_id].held_out]
    # Some labelled rows hold no abuse at all (runs of one word, shuffled signs), so not all can be found.
    assert sum(t for _, t in held) > 30 and not any(p > t for p, t in held)
    assert sum(p for p, _ in held) >= 0.85 * sum(t for _, t in held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows.values())


def test_odd_rows(spark, documents):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 1, 0), (6, None, 1), (77, 1, 1), (5, 0, 1)], "doc_id long, toxic int, text int")
    rows = toxicity.score_toxicity(documents, labels).collect()
    assert len(rows) == documents.count() and all(0 <= r.score < 0.5 for r in rows)
    assert toxicity.score_toxicity(documents, labels.limit(0)).count() == documents.count()
    assert toxicity.score_toxicity(documents.limit(0), labels).count() == 0


def test_different_texts_all_count(spark):
    """Texts that share a long word are no copies: the lexicon learns from all of them, from near copies once."""
    rng = random.Random(5)
    made = lambda n: " ".join("".join(rng.choices("bcdfgaeio", k=6)) for _ in range(n))
    ids = [d for d in range(1, 200) if zlib.crc32(str(d).encode()) % 5]
    toxic = [(d, f"extraordinary {made(40)} moron {made(40)}") for d in ids[:12]]
    clean = [(d, f"extraordinary {made(80)}") for d in ids[12:40]]
    copied = [(d, f"{toxic[0][1]} onlycopied") for d in ids[40:50]]
    docs = spark.createDataFrame(toxic + clean + copied, "doc_id long, text string")
    labels = spark.createDataFrame([(d, int("moron" in t)) for d, t in toxic + clean + copied], "doc_id long, toxic int")
    train = toxicity.labelled(docs, labels)
    assert sorted(r.doc_id for r in train.collect()) == sorted(d for d, _ in toxic + clean + copied)
    trie = toxicity.learn_lexicon(train)
    assert trie.exact("moron") and not trie.exact("onlycopied") and not trie.exact("extraordinary")


def test_words_joined_by_signs():
    trie = toxicity.Trie(WORDS, [])
    texts = ["a moron/scum", "you,moron", "so\u2014scum\u2026clown", "a\u00a0moron\fscum\vyes", "m0ron/scum moron!scum", "\u201cyou,moron\u201d", "well-known and/or 3/4", "m*ron"]
    got = toxicity.features(pa.array(texts), trie, {})
    assert got.tolist() == [[2, 0, 0], [1, 0, 0], [2, 0, 0], [2, 0, 0], [3, 1, 0], [0, 0, 1], [0, 0, 0], [0, 1, 0]]
