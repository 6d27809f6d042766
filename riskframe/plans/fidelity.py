"""Synthetic-data fidelity and privacy queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.operators.neighbors import calculate_dcr
from riskframe.operators.orderstats import mean_inverted_ks, population_ks
from riskframe.operators.profile import population_quality
from riskframe.plans.registry import query, round_columns, table
from riskframe.plans.views import EARLY_SQL, LATE_SQL, SPLIT_DAY, early, late

NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
QUALITY_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount"]
QUALITY_TEXT = ["l_returnflag", "l_linestatus"]


def sql_ks(feature: str, union: str) -> str:
    """KS distance of ``v`` between populations ``p`` 0 and 1 of a subquery."""
    return f"""SELECT '{feature}' AS feature, max(abs(r / n_r - s / n_s)) AS ks FROM (
    SELECT v, sum(sum(1 - p)) OVER (ORDER BY v) AS r, sum(sum(p)) OVER (ORDER BY v) AS s,
      sum(sum(1 - p)) OVER () AS n_r, sum(sum(p)) OVER () AS n_s FROM ({union}) GROUP BY v)"""


def _lines(f: str) -> str:
    return f"SELECT {f} AS v, CASE WHEN {EARLY_SQL} THEN 0 ELSE 1 END AS p FROM lineitem"


_BALANCES = "SELECT c_acctbal AS v, 0 AS p FROM customer UNION ALL SELECT s_acctbal, 1 FROM supplier"


def _halves(spark, sf_dir, columns):
    lines = table(spark, sf_dir, "lineitem").select(*columns, "l_shipdate")
    return early(lines).drop("l_shipdate"), late(lines).drop("l_shipdate")


def _marked(spark, sf_dir, columns):
    """Both halves in one scan, told apart by ``population``."""
    lines = table(spark, sf_dir, "lineitem").where("l_shipdate is not null")
    return lines.select(*columns, (F.col("l_shipdate") >= F.lit(SPLIT_DAY).cast("timestamp_ntz")).cast("int").alias("population"))


@query(
    "inverted_ks",
    " UNION ALL ".join(f"SELECT feature, round(ks, 6) AS ks, round(1 - ks, 6) AS inverted_ks FROM ({sql_ks(f, _lines(f))})" for f in NUMERIC),
)
def inverted_ks_lines(spark, sf_dir):
    return round_columns(population_ks(_marked(spark, sf_dir, NUMERIC), NUMERIC), ["ks", "inverted_ks"])


@query("inverted_ks_balance", f"SELECT round(1 - ks, 6) AS inverted_ks, 1::BIGINT AS n_columns FROM ({sql_ks('acctbal', _BALANCES)})")
def inverted_ks_balance(spark, sf_dir):
    real = table(spark, sf_dir, "customer").select(F.col("c_acctbal").alias("acctbal"))
    synthetic = table(spark, sf_dir, "supplier").select(F.col("s_acctbal").alias("acctbal"))
    return round_columns(mean_inverted_ks(real, synthetic), ["inverted_ks"])


def sql_dcr(real: str, synthetic: str, columns) -> str:
    """Brute force over scaled columns; equal records are merged first."""
    scale = ", ".join(f"avg({c}) AS m_{c}, CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END AS d_{c}" for c in columns)
    cells = ", ".join(f"({c} - m_{c}) / d_{c} AS {c}" for c in columns)
    gap = " + ".join(f"(s.{c} - r.{c}) * (s.{c} - r.{c})" for c in columns)
    return f"""WITH real AS ({real}), syn AS ({synthetic}), scale AS (SELECT {scale} FROM real),
r AS (SELECT DISTINCT {cells} FROM real, scale), s AS (SELECT {cells}, count(*) AS n FROM syn, scale GROUP BY ALL),
d AS (SELECT s.n, sqrt(min({gap})) AS dist FROM s, r GROUP BY s.n, {', '.join('s.' + c for c in columns)})
SELECT round(sum(n * dist) / sum(n), 6) AS mean_dcr, round(min(dist), 6) AS min_dcr,
  round(sum(CASE WHEN dist < 1e-6 THEN n ELSE 0 END) / sum(n), 6) AS perfectly_copied_fraction FROM d"""


_DCR = ["mean_dcr", "min_dcr", "perfectly_copied_fraction"]


@query(
    "dcr_summary",
    sql_dcr(
        "SELECT c_nationkey AS nation, c_acctbal AS balance FROM customer",
        "SELECT s_nationkey AS nation, s_acctbal AS balance FROM supplier",
        ["nation", "balance"],
    ),
)
def dcr_summary(spark, sf_dir):
    real = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance"))
    synthetic = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("balance"))
    return round_columns(calculate_dcr(real, synthetic), _DCR)


@query(
    "dcr_embeddings",
    """WITH d AS (SELECT s.vec_id, min(list_distance(s.embedding::DOUBLE[], r.embedding::DOUBLE[])) AS dist
  FROM embeddings s, embeddings r WHERE s.label = 0 AND r.label <> 0 GROUP BY s.vec_id)
SELECT round(avg(dist), 6) AS mean_dcr, round(min(dist), 6) AS min_dcr,
  round(avg(CASE WHEN dist < 1e-6 THEN 1.0 ELSE 0.0 END), 6) AS perfectly_copied_fraction FROM d""",
)
def dcr_embeddings(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    real, synthetic = vectors.where("label <> 0"), vectors.where("label = 0")
    return round_columns(calculate_dcr(real, synthetic, vector_col="embedding", scale=False), _DCR)


@query(
    "dcr_copies",
    sql_dcr("SELECT l_quantity, l_discount, l_tax FROM lineitem WHERE " + EARLY_SQL,
            "SELECT l_quantity, l_discount, l_tax FROM lineitem WHERE " + LATE_SQL, ["l_quantity", "l_discount", "l_tax"]),
)
def dcr_copies(spark, sf_dir):
    """Nearly every record of a table with few distinct values is a copy."""
    return round_columns(calculate_dcr(*_halves(spark, sf_dir, ["l_quantity", "l_discount", "l_tax"])), _DCR)


@query(
    "dcr_orders",
    sql_dcr("SELECT o_totalprice AS price, o_custkey AS cust FROM orders WHERE o_orderstatus <> 'F'",
            "SELECT o_totalprice AS price, o_custkey AS cust FROM orders WHERE o_orderstatus = 'F'", ["price", "cust"]),
)
def dcr_orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_totalprice").alias("price"), F.col("o_custkey").alias("cust"), "o_orderstatus")
    real = orders.where("o_orderstatus <> 'F'").drop("o_orderstatus")
    return round_columns(calculate_dcr(real, orders.where("o_orderstatus = 'F'"), ["price", "cust"]), _DCR)


def _quality_sql() -> str:
    side = f"CASE WHEN {EARLY_SQL} THEN 0 ELSE 1 END AS p"
    spans = ", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in QUALITY_NUMERIC)
    codes = ", ".join(
        f"least(floor(({c} - lo_{c}) / ((hi_{c} - lo_{c}) / 10))::INT, 9)::VARCHAR AS b_{c}" for c in QUALITY_NUMERIC
    )
    parts = [f"SELECT 'column_shape' AS kind, feature AS name, 1 - ks AS score FROM ({sql_ks(c, _lines(c))})" for c in QUALITY_NUMERIC]

    def overlap(kind: str, name: str, *cols: str) -> str:
        return f"""SELECT '{kind}' AS kind, '{name}' AS name, 1 - 0.5::DOUBLE * sum(abs(r / n_r - s / n_s)) AS score FROM (
    SELECT sum(1 - p) AS r, sum(p) AS s, sum(sum(1 - p)) OVER () AS n_r, sum(sum(p)) OVER () AS n_s FROM coded GROUP BY {', '.join(cols)})"""

    parts += [overlap("column_shape", c, c) for c in QUALITY_TEXT]
    for i, a in enumerate(QUALITY_NUMERIC):
        for b in QUALITY_NUMERIC[i + 1 :]:
            parts.append(f"""SELECT 'pair_trend' AS kind, '{a}|{b}' AS name,
    1 - abs((SELECT corr({a}, {b}) FROM coded WHERE p = 0) - (SELECT corr({a}, {b}) FROM coded WHERE p = 1)) / 2 AS score""")
    for i, a in enumerate(QUALITY_TEXT):
        parts += [overlap("pair_trend", f"{a}|{b}", a, b) for b in QUALITY_TEXT[i + 1 :]]
    parts += [overlap("pair_trend", f"{a}|{b}", f"b_{a}", b) for a in QUALITY_NUMERIC for b in QUALITY_TEXT]
    return f"""WITH span AS (SELECT {spans} FROM lineitem WHERE {EARLY_SQL}),
coded AS (SELECT *, {side}, {codes} FROM lineitem, span)
SELECT kind, name, round(score, 6) AS score FROM ({' UNION ALL '.join(parts)})"""


@query("quality_score", _quality_sql())
def quality(spark, sf_dir):
    both = _marked(spark, sf_dir, QUALITY_NUMERIC + QUALITY_TEXT)
    return round_columns(population_quality(both, QUALITY_NUMERIC, QUALITY_TEXT), ["score"])
