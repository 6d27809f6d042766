"""The registered queries of the subpackage: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskframe.llm import ann, decontaminate, embed_dedup, fim, html_text, mixing, packing, repeats, rollups, simhash, token_store, toxicity, whitening
from riskframe.llm.common import stored
from riskframe.session import scratch_path


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_documents(spark, sf_dir))


def op2_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest_neighbours(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 100 == 0)


def op3_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token_shards")
    token_store.write_shards(_documents(spark, sf_dir), path)
    return token_store.read_documents(spark, path)


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(_documents(spark, sf_dir)).select("doc_id", "fingerprint", "component_id")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.embedding_components(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op8_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(_documents(spark, sf_dir)).drop("uid")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after two batches: all documents come in, then exact copies go (the smallest doc_id of a text stays).

    The second batch is committed twice, as after a driver that died behind its commit.
    """
    counted = stored(rollups.count_tokens(_documents(spark, sf_dir)), "token_counts")
    rollup = rollups.TokenRollup(spark, scratch_path(spark, "rollup"))
    version = "word_bpe_49k"
    rollup.commit("load", rollups.changes_of(counted, 1, version))
    names = [c for c in counted.columns if c not in ("doc_id", "key1", "key2")]
    kept = counted.groupBy("key1", "key2").agg(F.min(F.struct("doc_id", *names)).alias("row")).select("row.*")
    revised = rollups.changes_of(counted, -1, version).unionByName(rollups.changes_of(kept, 1, version))
    for _ in range(2):
        rollup.commit("copies", revised)
    return rollup.totals()


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(_documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken", "source")


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.contamination(decontaminate.find_windows(_documents(spark, sf_dir), benchmark))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return rows.withColumn("deviation", F.expr("try_cast(deviation as bigint)"))


def op13_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digests(fim.transform_documents(_documents(spark, sf_dir)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_ann": op2_ann,
    "op3_token_store": op3_token_store,
    "op4_html_text": op4_html_text,
    "op5_simhash": op5_simhash,
    "op6_toxicity": op6_toxicity,
    "op7_embedding_dedup": op7_embedding_dedup,
    "op8_suffix_array": op8_suffix_array,
    "op9_token_counts": op9_token_counts,
    "op10_mixing": op10_mixing,
    "op11_decontamination": op11_decontamination,
    "op12_whitening": op12_whitening,
    "op13_fim": op13_fim,
}
#: Every pair compared, and every 200-byte string and every window written out: small tables only. The other operators need
#: a tokenizer, a hash, a learned model, eigenvectors or a seeded draw that SQL hasn't, and are tested against brute force.
ORACLES: dict[str, str] = {
    "op7_embedding_dedup": """WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95::DOUBLE),
reach(vec_id, root) AS (SELECT vec_id, vec_id FROM embeddings
  UNION SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.vec_id WHERE r.root < l.b),
named AS (SELECT vec_id, min(root) AS component_id FROM reach GROUP BY vec_id)
SELECT n.vec_id, (SELECT count(*) FROM links l WHERE l.a = n.vec_id) AS n_links, component_id, n.vec_id = component_id AS kept FROM named n""",
    "op8_suffix_array": """WITH t AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b FROM documents),
w AS MATERIALIZED (SELECT r, p, md5(b[p + 1 : p + 200]) AS k FROM (SELECT r, b, unnest(range(octet_length(b) - 199)) AS p FROM t)),
twice AS (SELECT k FROM w GROUP BY k HAVING count(*) > 1),
starts AS (SELECT r, p, p > lag(p, 1, -1000) OVER (PARTITION BY r ORDER BY p) + 200 AS fresh FROM w SEMI JOIN twice USING (k)),
runs AS (SELECT r, min(p) AS a, max(p) + 200 AS z
  FROM (SELECT r, p, sum(fresh::INT) OVER (PARTITION BY r ORDER BY p) AS g FROM starts) GROUP BY r, g),
gaps AS (SELECT r, a, z, lag(z, 1, 0) OVER (PARTITION BY r ORDER BY a) AS since FROM runs),
cut AS (SELECT r, sum(z - a)::BIGINT AS n_removed, count(*) AS n_spans, max(z) AS last,
  string_agg(CASE WHEN a > since THEN hex(b[since + 1 : a]) ELSE '' END, '' ORDER BY a) AS head FROM gaps JOIN t USING (r) GROUP BY r)
SELECT doc_id, octet_length(b) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(
  coalesce(head, '') || CASE WHEN octet_length(b) > coalesce(last, 0) THEN hex(b[coalesce(last, 0) + 1 : octet_length(b)]) ELSE '' END)) AS kept_sha256
FROM t LEFT JOIN cut USING (r)""",
    "op11_decontamination": r"""WITH w AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
s AS (SELECT item_id, w, unnest(range(greatest(len(w) - 9, 1))) AS i FROM b WHERE len(w) > 0),
p AS MATERIALIZED (SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i + 1 : i + 10], ' ') AS t FROM s),
c AS (SELECT r, w, k, unnest(range(len(w) - k + 1)) AS i FROM w, (SELECT DISTINCT k FROM p)),
hits AS MATERIALIZED (SELECT r, i, c.k, item_id FROM c JOIN p ON p.k = c.k AND p.t = array_to_string(c.w[i + 1 : i + c.k], ' ')),
words AS (SELECT r, count(DISTINCT i + j) AS n FROM (SELECT r, i, unnest(range(k)) AS j FROM hits) GROUP BY r),
items AS (SELECT r, count(*) AS n, string_agg(t, ',' ORDER BY t) AS t FROM (SELECT DISTINCT r, item_id::VARCHAR AS t FROM hits WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, len(w.w) AS n_words, coalesce(words.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items, sha256(coalesce(items.t, '')) AS items_sha256,
  words.n IS NOT NULL AS contaminated FROM w LEFT JOIN words USING (r) LEFT JOIN items USING (r)""",
    "op13_fim": r"""WITH t AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
  sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
d AS (SELECT doc_id, t, u, len(u) AS n, ('0x' || h[1:8])::BIGINT % (len(u) + 1) AS c1, ('0x' || h[9:16])::BIGINT % (len(u) + 1) AS c2,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR ('0x' || h[17:24])::BIGINT % 100 >= 100 THEN 'plain'
    WHEN ('0x' || h[25:32])::BIGINT % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM t),
p AS (SELECT doc_id, n, t, form, coalesce(array_to_string(u[1 : least(c1, c2)], ''), '') AS p,
  coalesce(array_to_string(u[least(c1, c2) + 1 : greatest(c1, c2)], ''), '') AS m, coalesce(array_to_string(u[greatest(c1, c2) + 1 : n], ''), '') AS s FROM d)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256 FROM p""",
}
