"""Split, sample and rebalancing queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.operators import sampling
from riskframe.plans.registry import query, table
from riskframe.plans.views import CREDIT_SQL, LINE_KEY, credit, sql_uniform
from riskframe.session import written

_KEYS = ", ".join(LINE_KEY)
_U = sql_uniform("42", *LINE_KEY)
_RANKED = f"""ranked AS (SELECT {_KEYS}, y, count(*) OVER (PARTITION BY y) AS n_c, count(*) OVER () AS n,
  row_number() OVER (PARTITION BY y ORDER BY {_U}, concat_ws('|', {_KEYS})) AS r FROM credit)"""


@query(
    "stratified_split",
    f"""WITH {CREDIT_SQL}, {_RANKED},
classes AS (SELECT DISTINCT y, n_c, n, n - ceil(0.3::DOUBLE * n)::BIGINT AS n_train FROM ranked),
exact AS (SELECT *, n_train * n_c / n::DOUBLE AS share, floor(n_train * n_c / n::DOUBLE)::BIGINT AS base FROM classes),
given AS (SELECT y, base + CASE WHEN row_number() OVER (ORDER BY share - base DESC, y::VARCHAR) <= n_train - sum(base) OVER () THEN 1 ELSE 0 END AS train FROM exact)
SELECT {_KEYS}, ranked.y, r <= n_c - train AS is_test FROM ranked JOIN given USING (y)""",
)
def stratified_split(spark, sf_dir):
    return sampling.stratified_flag(credit(spark, sf_dir).select(*LINE_KEY, "y"), "y", LINE_KEY, cache_input=True)


@query(
    "fold_assignment",
    f"""WITH {CREDIT_SQL}, {_RANKED}
SELECT {_KEYS}, y, (CASE WHEN r > n_c // 3 + least(1, n_c % 3) THEN 1 ELSE 0 END
  + CASE WHEN r > 2 * (n_c // 3) + least(2, n_c % 3) THEN 1 ELSE 0 END)::INT AS fold FROM ranked""",
)
def fold_assignment(spark, sf_dir):
    return sampling.assign_folds(credit(spark, sf_dir).select(*LINE_KEY, "y"), "y", LINE_KEY, cache_input=True)


@query("hash_sample", f"SELECT {_KEYS} FROM lineitem ORDER BY {_U}, {_KEYS} LIMIT 250")
def hash_sample(spark, sf_dir):
    return sampling.hash_sample(table(spark, sf_dir, "lineitem").select(*LINE_KEY), 250, LINE_KEY)


@query("plain_split", f"SELECT {_KEYS} FROM lineitem WHERE {_U} < 0.3::DOUBLE")
def plain_split(spark, sf_dir):
    return sampling.plain_split(table(spark, sf_dir, "lineitem").select(*LINE_KEY), LINE_KEY)[1]


def labelled_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    spaces = F.length("text") - F.length(F.replace("text", F.lit(" "), F.lit("")))
    return docs.select("doc_id", "n_chars", spaces.cast("long").alias("spaces"), F.col("quality").cast("long").alias("quality"))


_PICK = sql_uniform("42", "'neighbour'", "i")
_STEP = sql_uniform("42", "'step'", "i")
_BASE = sql_uniform("42", "'base'", "i")


@query(
    "smote_balance",
    f"""WITH d AS (SELECT doc_id, n_chars, (length(text) - length(replace(text, ' ', '')))::BIGINT AS spaces, quality::BIGINT AS quality
  FROM documents JOIN labels USING (doc_id)),
m AS (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS idx, n_chars::DOUBLE AS a, spaces::DOUBLE AS b FROM d WHERE quality = 0),
near AS (SELECT x.idx, y.a, y.b, row_number() OVER (PARTITION BY x.idx ORDER BY (x.a - y.a) * (x.a - y.a) + (x.b - y.b) * (x.b - y.b), y.idx) AS k
  FROM m x JOIN m y ON x.idx <> y.idx),
draws AS (SELECT floor({_BASE} * (SELECT count(*) FROM m))::BIGINT AS idx, floor({_PICK} * 5)::INT + 1 AS k, {_STEP} AS s
  FROM (SELECT unnest(range((SELECT count(*) FILTER (WHERE quality = 1) - count(*) FILTER (WHERE quality = 0) FROM d))) AS i))
SELECT doc_id, n_chars, spaces, quality, 'original' AS origin, NULL::BIGINT AS base_idx FROM d
UNION ALL
SELECT NULL, trunc(m.a + s * (near.a - m.a))::BIGINT, trunc(m.b + s * (near.b - m.b))::BIGINT, 0, 'synthetic', idx
FROM draws JOIN m USING (idx) JOIN near USING (idx, k)""",
)
def smote_balance(spark, sf_dir):
    smote = sampling.SmoteResampler("quality", key=["doc_id"], tag="origin")
    return smote.fit_resample_combined(labelled_documents(spark, sf_dir))


@query(
    "smote_credit",
    f"""WITH {CREDIT_SQL}, m AS MATERIALIZED (SELECT row_number() OVER (ORDER BY {_KEYS}) - 1 AS idx, l_quantity::DOUBLE AS a, l_extendedprice::DOUBLE AS b, l_discount::DOUBLE AS c
  FROM credit WHERE y = 1),
near AS (SELECT x.idx, min({{'d': sqrt((x.a - y.a) * (x.a - y.a) + (x.b - y.b) * (x.b - y.b) + (x.c - y.c) * (x.c - y.c)), 'i': y.idx}}, 5) AS n
  FROM m x JOIN m y ON x.idx <> y.idx GROUP BY x.idx),
draws AS (SELECT floor({_BASE} * (SELECT count(*) FROM m))::BIGINT AS idx, floor({_PICK} * 5)::INT + 1 AS k, {_STEP} AS s
  FROM (SELECT unnest(range((SELECT count(*) - 2 * sum(y) FROM credit)::BIGINT)) AS i))
SELECT {_KEYS}, l_quantity::DOUBLE AS l_quantity, l_extendedprice, l_discount, y, 'original' AS origin FROM credit
UNION ALL
SELECT NULL, NULL, NULL, NULL, m.a + s * (o.a - m.a), m.b + s * (o.b - m.b), m.c + s * (o.c - m.c), 1, 'synthetic'
FROM draws JOIN m USING (idx) JOIN near USING (idx) JOIN m o ON o.idx = near.n[k].i""",
)
def smote_credit(spark, sf_dir):
    """The minority of the whole credit table."""
    # The target is a hash of the key; oversampling reads the rows several times.
    data = written(credit(spark, sf_dir).select(*LINE_KEY, "l_quantity", "l_extendedprice", "l_discount", "y"), "credit")
    rows = sampling.SmoteResampler("y", key=LINE_KEY, tag="origin").fit_resample_combined(data)
    return rows.select(*LINE_KEY, "l_quantity", "l_extendedprice", "l_discount", "y", "origin")
