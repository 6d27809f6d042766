"""Packing, token files and token counts against direct use of the tokenizer."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from riskframe.llm import packing, rollups, token_store
from riskframe.llm.tokens import PieceEncoder, default_tokenizer
from riskframe.session import scratch_path

ENCODER = PieceEncoder(default_tokenizer())


def ids_of(text):
    return ENCODER.tokenizer.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


TRICKY = st.lists(
    st.sampled_from(["a", "B.", "don't", " ", "\n", " ", "\x1c", "É", "é", "İ", "ΑΣ", "...", ".,x", "<|endoftext|>", "日本", "😀", "'S", "1.5", "a,\tb"]),
    max_size=12,
).map("".join)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(TRICKY, st.text(max_size=20)), min_size=1, max_size=6))
def test_pieces_give_the_ids_of_whole_texts(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    ids, counts = ENCODER.encode(pa.array(texts, pa.string()))
    want = [ids_of(t) for t in texts]
    assert counts.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]


def test_a_full_cache_changes_nothing():
    small = PieceEncoder(default_tokenizer(), max_pieces=5)
    texts = pa.array(["one two three four", None, "five six seven", "one, two."]).slice(1)
    got, want = small.encode(texts), ENCODER.encode(texts)
    assert got[0].tolist() == want[0].tolist() and got[1].tolist() == want[1].tolist()


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_any_vocabulary_gives_the_ids_of_whole_texts(name):
    import public_tokenizers

    made = PieceEncoder(public_tokenizers.path(name))
    assert made.apart == name.startswith("word")
    texts = ["two words", "", " lead and trail ", "line\none, don't.  Two", "É 日本 x"]
    ids, counts = made.encode(pa.array(texts))
    want = [made.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def test_pieces_hold_every_id_once(spark, documents):
    length = 64
    pieces = packing.pack_documents(documents.repartition(3), length=length, with_ids=True)
    rows = sorted(pieces.collect(), key=lambda r: (r.sequence_id, r.offset))
    at = 0
    for r in rows:
        assert r.sequence_id * length + r.offset == at and 0 < r.length <= length - r.offset
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
        assert r.begins_document == (r.start == 0) and r.ends_document == (r.start + r.length == r.doc_tokens)
        at += r.length
    stream, want = [], sorted(tuple(ids_of(r.text) + [2]) for r in documents.collect())
    got = []
    for r in rows:
        if r.start == 0:
            stream = []
        assert len(stream) == r.start
        stream += np.frombuffer(r.ids, "<u4").tolist()
        if r.ends_document:
            got.append(tuple(stream))
    assert sorted(got) == want
    last = at - (at - 1) // length * length
    assert {r.padded_to for r in rows if r.sequence_id < (at - 1) // length} == {length}
    assert {r.padded_to for r in rows if r.sequence_id == (at - 1) // length} == {last if last & (last - 1) == 0 else length}
    joined = packing.sequences(pieces).orderBy("sequence_id").collect()
    assert b"".join(bytes(r.ids) for r in joined) == b"".join(bytes(r.ids) for r in rows)


def test_empty_tables(spark, documents):
    none = documents.limit(0)
    assert packing.pack_documents(none).count() == 0
    path = scratch_path(spark, "none")
    token_store.write_shards(none, path)
    assert token_store.read_documents(spark, path).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=1500))
def test_codes_round_trip_and_random_access(values):
    codes = token_store.Codes(token_store.encode_codes(np.array(values, np.uint32)))
    assert codes.decode().tolist() == values
    assert [codes[i] for i in range(0, len(values), 7)] == values[::7]


def test_codes_across_rank_blocks():
    values = np.random.default_rng(1).integers(0, 70_000, 20_000).astype(np.uint32)
    codes = token_store.Codes(token_store.encode_codes(values))
    assert all(codes[i] == values[i] for i in random.Random(2).sample(range(len(values)), 500))
    with pytest.raises(IndexError):
        codes[len(values)]
    with pytest.raises(ValueError):
        token_store.Codes(b"nothing like it.....")


@pytest.mark.parametrize("shard_tokens", [50, 1 << 20])
def test_token_files(spark, documents, monkeypatch, shard_tokens):
    monkeypatch.setattr(token_store, "SHARD_TOKENS", shard_tokens)
    path = scratch_path(spark, "shards")
    token_store.write_shards(documents, path, tasks=3)
    rows = sorted(token_store.read_documents(spark, path).collect(), key=lambda r: r.start)
    at = 0
    for r in rows:
        assert r.start == at
        at += r.n_tokens
    keys = [(r.doc_id is not None, r.doc_id or 0) for r in rows]
    assert keys == sorted(keys)
    want = sorted((str(r.doc_id), len(ids_of(r.text)) + 1, crc(ids_of(r.text) + [1])) for r in documents.collect())
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in rows) == want


def test_rollup_of_signed_changes(spark, documents):
    counted = rollups.count_tokens(documents)
    rows = counted.collect()
    assert sorted(r.tokens for r in rows) == sorted(len(ids_of(r.text)) for r in documents.collect())
    rollup = rollups.TokenRollup(spark, scratch_path(spark, "rollup"))
    rollup.commit("1", rollups.changes_of(counted, 1, "v1"))
    removed = rollups.changes_of(counted.filter("source = 'c'"), -1, "v1")
    rollup.commit("2", removed)
    rollup.commit("2", removed)
    # Written, but its commit was never reached.
    removed.groupBy(*rollups.KEYS).agg(F.lit(5).cast("long").alias("documents"), F.lit(5).cast("long").alias("tokens")).write.parquet(
        f"{rollup.path}/deltas/attempt=lost"
    )
    got = {(r.source, r.lang, r.tokenizer_version): (r.documents, r.tokens) for r in rollup.totals().collect()}
    want = {}
    for r in rows:
        for version, n in (("words", r.words), ("v1", r.tokens)):
            if r.source != "c":
                d, t = want.get((r.source, r.lang, version), (0, 0))
                want[r.source, r.lang, version] = (d + 1, t + n)
    assert got == want


def test_revision_replaces_a_count(spark):
    rollup = rollups.TokenRollup(spark, scratch_path(spark, "rollup"))
    schema = "source string, lang string, tokenizer_version string, tokens long, sign int"
    rollup.commit("1", spark.createDataFrame([("a", None, "v", 5, 1), (None, None, None, None, 1), ("z", "z", "z", 9, None)], schema))
    rollup.commit("2", spark.createDataFrame([("a", None, "v", 5, -1), ("a", None, "v", 7, 1)], schema))
    got = {tuple(r) for r in rollup.totals().collect()}
    assert got == {("a", None, "v", 1, 7), (None, None, None, 1, 0)}


def test_compacted_totals_are_the_same(spark):
    """Totals over many batches, before and after compactions, with replays of batches that only a compacted table knows."""
    rollup = rollups.TokenRollup(spark, scratch_path(spark, "rollup"))
    assert rollup.totals().count() == 0
    schema = "source string, lang string, tokenizer_version string, tokens long, sign int"
    batch = lambda k: spark.createDataFrame([("a", "x", "v", k, 1), (None, "x", "v", 2 * k, 1)], schema)
    want = {}
    for k in range(1, 10):
        rollup.commit(f"b{k}", batch(k))
        want = {("a", "x", "v"): (k, k * (k + 1) // 2), (None, "x", "v"): (k, k * (k + 1))}
        if k % 3 == 0:
            rollup.compact()
            for old in (1, k):
                rollup.commit(f"b{old}", batch(999))
        assert {(r.source, r.lang, r.tokenizer_version): (r.documents, r.tokens) for r in rollup.totals().collect()} == want
    # What the table before the last one listed has no files of its own any more.
    assert len(rollups.files.names(spark, f"{rollup.path}/commits")) == 3
    assert len([n for n in rollups.files.names(spark, f"{rollup.path}/deltas") if n.startswith("attempt=")]) == 3


def test_a_compaction_that_died_is_not_read(spark, monkeypatch):
    rollup = rollups.TokenRollup(spark, scratch_path(spark, "rollup"))
    schema = "source string, lang string, tokenizer_version string, tokens long, sign int"
    for k in range(3):
        rollup.commit(f"b{k}", spark.createDataFrame([("a", "x", "v", 5, 1)], schema))

    def dies(*_):
        raise SystemExit

    monkeypatch.setattr(rollups.files, "put_once", dies)
    with pytest.raises(SystemExit):
        rollup.compact()
    with pytest.raises(SystemExit):
        rollup.commit("b9", spark.createDataFrame([("a", "x", "v", 7, 1)], schema))
    monkeypatch.undo()
    assert tuple(rollup.totals().first()) == ("a", "x", "v", 3, 15)
    rollup.compact()
    rollup.commit("b9", spark.createDataFrame([("a", "x", "v", 7, 1)], schema))
    assert tuple(rollup.totals().first()) == ("a", "x", "v", 4, 22)


@pytest.mark.parametrize("shard_tokens", [50, 1 << 20])
def test_tokens_of_the_files_by_their_place(spark, documents, monkeypatch, shard_tokens):
    """Any token of any document, straight from the files; places that aren't there give no row."""
    monkeypatch.setattr(token_store, "SHARD_TOKENS", shard_tokens)
    path = scratch_path(spark, "shards")
    token_store.write_shards(documents, path, tasks=3)
    want = {}
    for r in documents.collect():
        for i, v in enumerate([*ids_of(r.text), 1]):
            want.setdefault((r.doc_id, i), set()).add(v)
    rng = random.Random(4)
    places = rng.sample(sorted(want, key=str), 60) + [(1, 10_000), (1, -1), (999, 0), (3, 0), (None, 0)]
    asked = spark.createDataFrame([(d, i, "clash") for d, i in places], "doc_id long, at long, codes string")
    got = {}
    for r in token_store.tokens_at(spark, path, asked).collect():
        got.setdefault((r.doc_id, r.at), set()).add(r.id)
    assert got == {p: want[p] for p in places if p in want}
    assert token_store.token_at(spark, path, 1, 0) == ids_of("plain text of five words")[0]
    with pytest.raises(IndexError):
        token_store.token_at(spark, path, 1, 10_000)
    assert token_store.tokens_at(spark, path, asked.limit(0)).count() == 0
