"""Distribution and model-quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.operators import profile
from riskframe.operators.orderstats import auc, roc_points
from riskframe.operators.scorecard import LinearScorecard
from riskframe.plans.registry import big, query, round_columns, table
from riskframe.plans.views import CREDIT_SQL, credit



def score():
    return F.lit(0.05) + F.lit(0.004) * F.col("l_quantity") + F.col("l_discount")


SCORE_SQL = "0.05::DOUBLE + 0.004::DOUBLE * l_quantity + l_discount"
CARD = LinearScorecard(["l_quantity", "l_discount", "is_returned"], [0.02, 6.0, 0.8], -2.2, [0.0, 0.0, 0.0])
CARD_SQL = """1::DOUBLE / (1::DOUBLE + exp(-(-2.2::DOUBLE + 0.02::DOUBLE * l_quantity + 6::DOUBLE * l_discount
    + 0.8::DOUBLE * CASE WHEN l_returnflag = 'R' THEN 1::DOUBLE ELSE 0::DOUBLE END)))"""
SCORED_SQL = f"{CREDIT_SQL}, scored AS (SELECT *, {SCORE_SQL} AS s, {CARD_SQL} AS p FROM credit)"


def scored(spark, sf_dir):
    data = credit(spark, sf_dir).withColumn("is_returned", (F.col("l_returnflag") == "R").cast("double"))
    return data.withColumns({"s": score(), "p": CARD.probability()})


@query("class_distribution", f"WITH {CREDIT_SQL} SELECT y::BIGINT AS y, count(*) AS n, round(count(*) / sum(count(*)) OVER () * 100, 6) AS pct FROM credit GROUP BY y")
def class_distribution(spark, sf_dir):
    return round_columns(profile.class_distribution(credit(spark, sf_dir), "y"), ["pct"]).withColumn("y", big("y"))


@query("event_rate", f"WITH {CREDIT_SQL} SELECT l_discount, count(y) AS n, round(avg(y), 6) AS event_rate FROM credit GROUP BY l_discount")
def event_rate(spark, sf_dir):
    return round_columns(profile.event_rate(credit(spark, sf_dir), "l_discount", "y"), ["event_rate"])


@query(
    "grouped_histogram",
    """WITH span AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders),
binned AS (SELECT o_orderpriority, lo, (hi - lo) / 50 AS w, least(floor((o_totalprice - lo) / ((hi - lo) / 50))::INT, 49) AS bin_id FROM orders, span)
SELECT o_orderpriority, bin_id, round(lo + bin_id * w, 6) AS lo, round(lo + (bin_id + 1) * w, 6) AS hi, count(*) AS n
FROM binned GROUP BY o_orderpriority, bin_id, lo, w""",
)
def grouped_histogram(spark, sf_dir):
    return round_columns(profile.grouped_histogram(table(spark, sf_dir, "orders"), "o_totalprice", "o_orderpriority", 50), ["lo", "hi"])


@query(
    "kde_grid",
    """WITH v AS (SELECT event_type, value, count(*) AS n FROM events GROUP BY ALL),
st AS (SELECT event_type, count(*) AS n, min(value) AS lo, max(value) AS hi,
  stddev_samp(value) * power(count(*)::DOUBLE, -0.2::DOUBLE) AS h FROM events GROUP BY event_type HAVING stddev_samp(value) > 0),
grid AS (SELECT event_type, st.n, h, g.i AS grid_id, lo + g.i * ((hi - lo) / 199) AS x FROM st, (SELECT unnest(range(200)) AS i) g)
SELECT grid.event_type, grid_id::INT AS grid_id, round(x, 6) AS x,
  round(sum(v.n * exp(-0.5::DOUBLE * ((x - v.value) / h) * ((x - v.value) / h))) / ((SELECT sum(n) FROM st) * h * sqrt(2 * pi())), 6) AS density
FROM grid JOIN v USING (event_type) GROUP BY grid.event_type, grid_id, x, h""",
)
def kde_grid(spark, sf_dir):
    return round_columns(profile.density_grid(table(spark, sf_dir, "events"), "value", "event_type"), ["x", "density"])


@query(
    "box_stats",
    """WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3
  FROM events GROUP BY event_type)
SELECT event_type, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3, count(*) AS n,
  min(value) FILTER (WHERE value >= q1 - 1.5::DOUBLE * (q3 - q1) AND value <= q3 + 1.5::DOUBLE * (q3 - q1)) AS whisker_low,
  max(value) FILTER (WHERE value >= q1 - 1.5::DOUBLE * (q3 - q1) AND value <= q3 + 1.5::DOUBLE * (q3 - q1)) AS whisker_high,
  count(*) FILTER (WHERE NOT (value >= q1 - 1.5::DOUBLE * (q3 - q1) AND value <= q3 + 1.5::DOUBLE * (q3 - q1))) AS n_outliers
FROM events JOIN q USING (event_type) GROUP BY event_type, q1, median, q3""",
)
def box_stats(spark, sf_dir):
    return round_columns(profile.box_stats(table(spark, sf_dir, "events"), "value", "event_type"), ["q1", "median", "q3"])


def _sql_auc(score: str, expr: str) -> str:
    return f"""SELECT '{score}' AS score, sum(pos)::BIGINT AS n_pos, sum(neg)::BIGINT AS n_neg,
  round(sum(pos * (upto - neg / 2)) / (sum(pos)::DOUBLE * sum(neg)), 6) AS auc FROM (
    SELECT sum(y) AS pos, sum(1 - y) AS neg, sum(sum(1 - y)) OVER (ORDER BY {expr}) AS upto FROM scored GROUP BY {expr})"""


@query("auc_exact", f"WITH {SCORED_SQL} {_sql_auc('s', 's')} UNION ALL {_sql_auc('l_extendedprice', 'l_extendedprice')}")
def auc_exact(spark, sf_dir):
    return round_columns(auc(scored(spark, sf_dir), "y", ["s", "l_extendedprice"]), ["auc"])


@query(
    "roc_points",
    f"""WITH {SCORED_SQL}, g AS (SELECT s, sum(y) AS pos, sum(1 - y) AS neg FROM scored GROUP BY s),
points AS (SELECT s AS threshold, sum(pos) OVER (ORDER BY s DESC) AS tp, sum(neg) OVER (ORDER BY s DESC) AS fp FROM g
  UNION ALL SELECT NULL, 0, 0)
SELECT 's' AS score, round(threshold, 6) AS threshold, tp::BIGINT AS tp, fp::BIGINT AS fp,
  round(fp / (SELECT sum(neg) FROM g), 6) AS fpr, round(tp / (SELECT sum(pos) FROM g), 6) AS tpr FROM points""",
)
def roc(spark, sf_dir):
    points = roc_points(scored(spark, sf_dir), "y", "s")
    finite = F.when(F.col("threshold") != F.lit(float("inf")), F.col("threshold"))
    return round_columns(points.withColumn("threshold", finite), ["threshold", "fpr", "tpr"])


@query(
    "confusion_f1",
    f"""WITH {SCORED_SQL}, m AS (SELECT count(*) FILTER (WHERE y = 1 AND p > 0.5) AS tp, count(*) FILTER (WHERE y = 0 AND p > 0.5) AS fp,
  count(*) FILTER (WHERE y = 1 AND p <= 0.5) AS fn, count(*) FILTER (WHERE y = 0 AND p <= 0.5) AS tn FROM scored)
SELECT *, round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END, 6) AS f1 FROM m""",
)
def confusion_f1(spark, sf_dir):
    return round_columns(profile.f1_score(scored(spark, sf_dir), "y", "p"), ["f1"])


@query(
    "confusion_matrix",
    f"""WITH {SCORED_SQL}, c AS (SELECT y AS actual, (p > 0.9)::INT AS predicted, count(*) AS n FROM scored GROUP BY ALL),
spine AS (SELECT a.i AS actual, b.i AS predicted FROM (SELECT unnest([0, 1]) AS i) a, (SELECT unnest([0, 1]) AS i) b)
SELECT spine.actual::INT AS actual, spine.predicted::INT AS predicted, coalesce(n, 0)::BIGINT AS n FROM spine LEFT JOIN c USING (actual, predicted)""",
)
def confusion_matrix(spark, sf_dir):
    """A threshold nothing reaches: the empty cells stay in the table."""
    return profile.confusion_matrix(scored(spark, sf_dir), "y", "p", 0.9)


@query("log_loss", f"WITH {SCORED_SQL} SELECT round(avg(CASE WHEN y = 1 THEN -ln(p) ELSE -ln(1 - p) END), 6) AS log_loss, count(*) AS n FROM scored")
def log_loss(spark, sf_dir):
    return round_columns(profile.log_loss(scored(spark, sf_dir), "y", "p"), ["log_loss"])


@query("alert_counters", f"WITH {SCORED_SQL} SELECT count(*) AS total, count(*) FILTER (WHERE p > 0.5) AS alerts, count(*) FILTER (WHERE NOT p > 0.5) AS approvals FROM scored")
def alert_counters(spark, sf_dir):
    return profile.alert_counters(scored(spark, sf_dir), "p")
