"""Each stage on its own input, and the whole run."""

import collections
import hashlib

from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from riskframe.llm import simhash, toxicity
from riskframe.session import scratch_path
from test_near_duplicates import roots, slow_fingerprint
from test_repeats import by_definition

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def words(text):
    return (text or "").encode().split()


def test_stages_in_order(spark):
    assert [s for s, _ in pipeline.STAGES] == ["toxicity", "simhash_dedup", "suffix_array_dedup", "source_mixing", "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = {r.doc_id: r for r in docs.collect()}

    clean = pipeline.drop_toxic(spark, docs, SF)
    assert clean.columns == COLUMNS
    bad = {r.doc_id for r in toxicity.score_toxicity(docs, labels).collect() if r.predicted}
    assert {r.doc_id: r for r in clean.collect()} == {d: r for d, r in rows.items() if d not in bad}

    single = pipeline.drop_near_copies(spark, docs, SF)
    assert single.columns == COLUMNS
    prints = {d: slow_fingerprint(r.text) for d, r in rows.items()}
    ids = sorted(prints)
    near = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if (prints[a] ^ prints[b]).bit_count() <= 4]
    first = roots(ids, near)
    assert {r.doc_id: r for r in single.collect()} == {d: rows[d] for d in ids if first[d] == d}

    unique = pipeline.drop_repeats(spark, docs, SF)
    assert unique.columns == COLUMNS
    want = dict(zip(ids, by_definition([rows[d].text for d in ids])))
    left = {d: w[4].decode("utf-8", "ignore") for d, w in want.items() if not w[1] or w[4].decode("utf-8", "ignore").strip(" ")}
    got = {r.doc_id: r for r in unique.collect()}
    assert {d: r.text for d, r in got.items()} == left
    assert all(r.n_chars == (len(r.text) if want[d][1] else rows[d].n_chars) and r.lang == rows[d].lang for d, r in got.items())

    mixed = pipeline.mix_sources(spark, docs, SF)
    assert mixed.columns == COLUMNS
    drawn, written = collections.Counter(), collections.Counter()
    for r in pipeline.mixing.mix_spans(docs).collect():
        drawn.update((r.doc_id, w) for w in words(rows[r.doc_id].text)[r.a : r.b])
    for r in mixed.collect():
        assert r.source == rows[r.doc_id].source and r.lang == rows[r.doc_id].lang
        written.update((r.doc_id, w) for w in words(r.text))
    assert written == drawn
    taken = {r.doc_id: r.taken for r in pipeline.mixing.mix_sources(docs).collect()}
    of_document = collections.Counter()
    for (d, _), n in written.items():
        of_document[d] += n
    assert dict(of_document) == {d: t for d, t in taken.items() if t}


def test_odd_rows_pass(spark, documents):
    """Nulls, empty texts, repeated rows and clashing columns go through the stages that return documents."""
    rows = documents.collect()
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, documents, SF)
        assert out.columns == documents.columns, name
        got = out.collect()
        assert {r.doc_id for r in got} <= {r.doc_id for r in rows}, name
        assert stage(spark, documents.limit(0), SF).count() == 0, name
    assert sorted(map(str, pipeline.drop_toxic(spark, documents, SF).collect())) == sorted(map(str, rows))
    kept = pipeline.drop_near_copies(spark, documents, SF).collect()
    groups = {r.component_id for r in simhash.simhash_components(documents).collect()}
    assert sorted(str(r.doc_id) for r in kept) == sorted(str(g) for g in groups)


CLASHES = ["copy", "text_hash", "_part", "_rows", "_hash", "_id", "row", "rows", "runs", "size", "piece", "doc_tokens", "source_size", "toxic"]


def test_clashing_columns_pass_through(spark, documents):
    """Columns called like anything inside the stages come out as they went in."""
    clashing = documents
    for k, name in enumerate(CLASHES):
        clashing = clashing.withColumn(name, F.concat(F.lit(f"{name} of "), F.coalesce("doc_id", F.lit(-1)).cast("string")) if k % 2 else F.lit(k))
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, clashing, SF)
        assert out.columns == clashing.columns, name
        plain = stage(spark, documents, SF)
        key = lambda r: (str(r.doc_id), str(r.text), str(r.source))
        assert sorted(map(key, out.collect())) == sorted(map(key, plain.collect())), name
        for r in out.collect():
            for k, c in enumerate(CLASHES):
                assert r[c] == (f"{c} of {-1 if r.doc_id is None else r.doc_id}" if k % 2 else k), (name, c)
    assert pipeline.pack(spark, clashing, SF).count() == pipeline.pack(spark, documents, SF).count()


def test_mix_is_written_in_the_order_of_its_draws(spark):
    """The rows of a file lie in the order of their first slots, so documents of all sources stand mixed, and packing keeps that order."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    shards_of = collections.defaultdict(set)
    for r in pipeline.mixing.mix_spans(docs, shard_slots=64).collect():
        shards_of[r.doc_id].add(r.shard)
    path = scratch_path(spark, "mixed")
    pipeline.mixing.mixed_documents(docs, shard_slots=64).write.parquet(path)
    files = spark.read.parquet(path).select("*", F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("at")).orderBy("at").collect()
    by_file = collections.defaultdict(list)
    for r in files:
        by_file[r.file].append(r)
    changes = 0
    for rows in by_file.values():
        # Shards can be chosen to rise: each row has a span in a shard not below that of the row before it.
        at = 0
        for r in rows:
            later = [s for s in shards_of[r.doc_id] if s >= at]
            assert later, r.doc_id
            at = min(later)
        changes += sum(a.source != b.source for a, b in zip(rows, rows[1:]))
    assert changes > len(files) / 3


def test_run(spark):
    pieces = pipeline.run(spark, SF).collect()
    length = collections.Counter()
    for r in pieces:
        length[r.sequence_id] += r.length
    assert all(n == 4096 for s, n in length.items() if s != max(length))
    ids = {r.doc_id for r in pieces}
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert ids and ids <= set(docs)
    digests = collections.Counter(hashlib.sha256((docs[d] or "").encode()).digest() for d in ids)
    assert max(digests.values()) == 1


def test_mix_writes_the_drawn_spans(spark):
    """The words of the stage are those of the mix's spans, tails of documents included, and its text is cut from theirs."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    drawn = collections.Counter()
    tails = 0
    for r in pipeline.mixing.mix_spans(docs).collect():
        drawn.update((r.doc_id, w) for w in words(rows[r.doc_id].text)[r.a : r.b])
        tails += r.b == r.size and r.a > 0
    written = collections.Counter()
    for r in pipeline.mix_sources(spark, docs, SF).collect():
        assert r.text in rows[r.doc_id].text
        written.update((r.doc_id, w) for w in words(r.text))
    assert written == drawn and tails
