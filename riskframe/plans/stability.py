"""Drift queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.operators.drift import DriftMonitor, drift_trigger
from riskframe.plans.encoding import DECILES
from riskframe.plans.registry import big, query, r6, table
from riskframe.plans.views import EARLY_SQL, LATE_SQL, early, late

FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
SHIFTED_SQL = f"{LATE_SQL} AND l_quantity > 10"

SQL_LABEL = """CASE WHEN {v} IS NULL THEN 'Insufficient data' WHEN {v} < 0.1 THEN 'No significant shift'
    WHEN {v} < 0.25 THEN 'Moderate shift – investigate' ELSE 'Major shift – action required' END"""


def sql_parts(features, current: str) -> str:
    """CTEs that end in ``parts``: the bins of each feature with their shares and contributions."""
    ctes, parts = [], []
    for f in features:
        ctes.append(f"""bins_{f} AS (
  SELECT (i - 1)::INT AS bin_id, CASE WHEN i = 1 THEN '-infinity'::DOUBLE ELSE e[i] END AS lo,
    CASE WHEN i = len(e) - 1 THEN 'infinity'::DOUBLE ELSE e[i + 1] END AS hi
  FROM (SELECT e, unnest(range(1, len(e))) AS i
        FROM (SELECT list_sort(list_distinct(quantile_cont({f}, {DECILES}))) AS e FROM lineitem WHERE {EARLY_SQL})))""")
        parts.append(f"""SELECT '{f}' AS feature, b.bin_id, b.lo, b.hi,
    count(*) FILTER (WHERE {EARLY_SQL}) AS n_ref, count(*) FILTER (WHERE {current}) AS n_cur
  FROM bins_{f} b LEFT JOIN lineitem l ON l.{f} >= b.lo AND l.{f} < b.hi GROUP BY ALL""")
    ctes.append("binned AS (" + " UNION ALL ".join(parts) + ")")
    ctes.append("""shared AS (
  SELECT *, CASE WHEN n_ref = 0 THEN 0.0001::DOUBLE ELSE n_ref / sum(n_ref) OVER (PARTITION BY feature) END AS ref_pct,
    CASE WHEN n_cur = 0 THEN 0.0001::DOUBLE ELSE n_cur / sum(n_cur) OVER (PARTITION BY feature) END AS cur_pct FROM binned),
parts AS (SELECT *, (cur_pct - ref_pct) * ln(cur_pct / ref_pct) AS psi_component FROM shared)""")
    return "WITH " + ",\n".join(ctes)


def _sides(spark, sf_dir, shifted: bool):
    lines = table(spark, sf_dir, "lineitem").select(*FEATURES, "l_shipdate")
    current = late(lines)
    return early(lines).drop("l_shipdate"), (current.where("l_quantity > 10") if shifted else current).drop("l_shipdate")


@query(
    "psi_score",
    sql_parts(["l_quantity"], SHIFTED_SQL)
    + f""" SELECT feature, round(sum(psi_component), 6) AS psi, {SQL_LABEL.format(v='sum(psi_component)')} AS interpretation
FROM parts GROUP BY feature""",
)
def psi_score(spark, sf_dir):
    psi = DriftMonitor().calculate_psi(*_sides(spark, sf_dir, True), "l_quantity")
    return psi.select("feature", r6("psi").alias("psi"), "interpretation")


@query(
    "psi_bin_detail",
    sql_parts(["l_quantity"], SHIFTED_SQL)
    + """ SELECT bin_id, CASE WHEN isinf(lo) THEN NULL ELSE round(lo, 6) END AS lo, CASE WHEN isinf(hi) THEN NULL ELSE round(hi, 6) END AS hi,
  n_ref::BIGINT AS n_ref, n_cur::BIGINT AS n_cur, round(ref_pct, 6) AS ref_pct, round(cur_pct, 6) AS cur_pct,
  round(psi_component, 6) + 0 AS psi_component,
  '(' || CASE WHEN isinf(lo) THEN '-inf' ELSE printf('%.4f', lo) END || ', ' || CASE WHEN isinf(hi) THEN 'inf' ELSE printf('%.4f', hi) END || ']' AS bin
FROM parts""",
)
def psi_bin_detail(spark, sf_dir):
    detail = DriftMonitor().psi_bin_detail(*_sides(spark, sf_dir, True), "l_quantity").drop("label")
    finite = {c: F.when(F.abs(F.col(c)) != F.lit(float("inf")), r6(c)) for c in ("lo", "hi")}
    return detail.withColumns({**finite, "n_ref": big("n_ref"), "n_cur": big("n_cur")})


@query(
    "csi_report",
    sql_parts(FEATURES, LATE_SQL)
    + f""" SELECT feature, round(sum(psi_component), 6) AS csi, {SQL_LABEL.format(v='sum(psi_component)')} AS interpretation
FROM parts GROUP BY feature""",
)
def csi_report(spark, sf_dir):
    return DriftMonitor().calculate_csi(*_sides(spark, sf_dir, False))


@query(
    "drift_trigger",
    sql_parts(FEATURES, SHIFTED_SQL)
    + """, report AS (SELECT feature, sum(psi_component) AS v, round(sum(psi_component), 6) AS csi FROM parts GROUP BY feature),
found AS (SELECT v FROM report WHERE feature = 'l_quantity' UNION ALL SELECT csi FROM report)
SELECT bool_or(v > 0.25) AS triggered, round(max(v), 6) AS max_drift, count(*) FILTER (WHERE v > 0.25) AS n_over FROM found""",
)
def drift_decision(spark, sf_dir):
    ref, cur = _sides(spark, sf_dir, True)
    monitor = DriftMonitor()
    found = drift_trigger(monitor.calculate_psi(ref, cur, "l_quantity"), monitor.calculate_csi(ref, cur))
    return found.withColumn("max_drift", r6("max_drift"))
