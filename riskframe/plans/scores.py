"""Scoring, attribution, what-if and source queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.functions import binning
from riskframe.operators import scoring
from riskframe.operators.profile import attribution_summary
from riskframe.operators.rows import REASONS
from riskframe.operators.scorecard import LinearScorecard
from riskframe.operators.woe import WoETransformer
from riskframe.plans.encoding import sql_evidence, sql_in_bin
from riskframe.plans.registry import big, query, r6, round_columns, table
from riskframe.plans.views import CREDIT_SQL, LINE_KEY, PD_SQL, credit, sql_uniform, with_pd
from riskframe.session import scratch_path
from riskframe.sources import tables

ATTR_FEATURES = ["l_quantity", "l_discount", "l_tax", "l_extendedprice"]
ATTR_COEFFICIENTS = [0.02, 6.0, -3.0, 0.000004]
_KEYS = ", ".join(LINE_KEY)


def attributed(spark, sf_dir):
    data = credit(spark, sf_dir)
    means = data.agg(*[F.avg(c).alias(c) for c in ATTR_FEATURES]).first()
    card = LinearScorecard(ATTR_FEATURES, ATTR_COEFFICIENTS, -2.2, [means[c] for c in ATTR_FEATURES])
    return card.score(data.select(*LINE_KEY, *ATTR_FEATURES))


_MEANS_SQL = "m AS (SELECT " + ", ".join(f"avg({c}) AS m_{c}" for c in ATTR_FEATURES) + " FROM lineitem)"
_VALUE_SQL = {c: f"({w}::DOUBLE * ({c} - m_{c}))" for c, w in zip(ATTR_FEATURES, ATTR_COEFFICIENTS)}
_ROWS_SQL = "li AS (SELECT *, row_number() OVER () AS rid FROM lineitem)"
_LONG_SQL = " UNION ALL ".join(
    f"SELECT {_KEYS}, rid, {i} AS i, '{c}' AS feature, {v} AS value FROM li, m" for i, (c, v) in enumerate(_VALUE_SQL.items())
)


@query("linear_attribution", f"""WITH {_MEANS_SQL} SELECT {_KEYS}, {', '.join(f'round({v}, 6) + 0 AS a_{c}' for c, v in _VALUE_SQL.items())},
  round(1::DOUBLE / (1::DOUBLE + exp(-(-2.2::DOUBLE + {' + '.join(f'{w}::DOUBLE * {c}' for c, w in zip(ATTR_FEATURES, ATTR_COEFFICIENTS))}))), 6) AS probability
FROM lineitem, m""")
def linear_attribution(spark, sf_dir):
    cells = [r6(F.col("attributions")[i]["value"]).alias(f"a_{c}") for i, c in enumerate(ATTR_FEATURES)]
    return attributed(spark, sf_dir).select(*LINE_KEY, *cells, r6("probability").alias("probability"))


@query("top_attribution", f"""WITH {_MEANS_SQL}, {_ROWS_SQL}, long AS ({_LONG_SQL}),
r AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY abs(value) DESC, i) AS k FROM long)
SELECT {_KEYS}, max(feature) FILTER (WHERE k = 1) AS first, max(feature) FILTER (WHERE k = 2) AS second,
  round(max(value) FILTER (WHERE k = 1), 6) + 0 AS first_value FROM r GROUP BY rid, {_KEYS}""")
def top_attribution(spark, sf_dir):
    top = scoring.top_attributions(F.col("attributions"), 2)
    ranked = attributed(spark, sf_dir).select(*LINE_KEY, top.alias("t"))
    return ranked.select(
        *LINE_KEY, F.col("t")[0]["feature"].alias("first"), F.col("t")[1]["feature"].alias("second"), r6(F.col("t")[0]["value"]).alias("first_value")
    )


@query("attribution_summary", f"""WITH {_MEANS_SQL}, {_ROWS_SQL}, long AS ({_LONG_SQL})
SELECT feature, count(*) AS n, round(avg(abs(value)), 6) AS mean_abs, round(avg(value), 6) + 0 AS mean, round(min(value), 6) AS min, round(max(value), 6) AS max
FROM long GROUP BY feature""")
def attribution_table(spark, sf_dir):
    return round_columns(attribution_summary(attributed(spark, sf_dir), "attributions"), ["mean_abs", "mean", "min", "max"])


# --- batch scoring ---------------------------------------------------------------------------------

RECORD_COLUMNS = ["l_returnflag", "l_quantity", "l_discount"]


def scorer(spark, sf_dir) -> scoring.Scorer:
    """Encoder fitted on the record's credit fields, scorecard with weight -1 per WoE."""
    fitted = WoETransformer("y", iv_threshold=0.0, cache_input=True).fit(credit(spark, sf_dir).select(*RECORD_COLUMNS, "y"))
    names = fitted.get_selected_features()
    return scoring.Scorer(fitted, LinearScorecard(names, [-1.0] * len(names), -1.1, [0.0] * len(names)))


def records(spark, sf_dir):
    """Scoring requests: the credit fields with an applicant's age, income, amount and term."""
    key = F.col("l_orderkey")
    return table(spark, sf_dir, "lineitem").select(
        *LINE_KEY, *RECORD_COLUMNS, (F.lit(16) + F.col("l_partkey") % 60).cast("int").alias("age"),
        F.col("l_extendedprice").alias("loan_amount"), ((key % 9) * F.lit(12)).cast("int").alias("term_months"),
        (F.col("l_suppkey") - 1).alias("monthly_income"),
    )


_SCORE_SQL = sql_evidence(CREDIT_SQL, "credit", ["l_quantity"], ["l_returnflag", "l_discount"]) + f""",
coded AS (SELECT {', '.join('c.' + k for k in LINE_KEY)}, f.woe AS wf, q.woe AS wq, d.woe AS wd,
    1::DOUBLE / (1::DOUBLE + exp(-(-1.1::DOUBLE - f.woe - q.woe - d.woe))) AS p,
    concat_ws('; ', CASE WHEN 16 + l_partkey % 60 < 18 THEN 'Invalid age' END, CASE WHEN l_suppkey - 1 < 0 THEN 'Negative monthly income' END,
      CASE WHEN l_extendedprice <= 0 THEN 'Invalid loan amount' END,
      CASE WHEN 16 + l_partkey % 60 + (l_orderkey % 9) > 80 THEN 'Usia saat pelunasan melebihi batas (80 tahun)' END) AS reasons
  FROM credit c JOIN evidence f ON f.feature = 'l_returnflag' AND f.category = c.l_returnflag
  JOIN evidence d ON d.feature = 'l_discount' AND d.category = c.l_discount::VARCHAR
  JOIN (SELECT * FROM evidence WHERE feature = 'l_quantity') q ON {sql_in_bin('c.l_quantity', 'q')})
SELECT {_KEYS}, round(p, 6) AS probability, CASE WHEN reasons <> '' THEN 'Undefined' WHEN p < 0.25 THEN 'A' WHEN p < 0.5 THEN 'B'
    WHEN p < 0.75 THEN 'C' ELSE 'D' END AS grade, nullif(reasons, '') AS reasons,
  CASE WHEN reasons <> '' THEN 0 ELSE 3 END AS n_values,
  CASE WHEN reasons <> '' THEN NULL ELSE round(greatest(abs(wf), abs(wq), abs(wd)), 6) END AS top_size FROM coded"""


@query("batch_scores", _SCORE_SQL)
def batch_scores(spark, sf_dir):
    return _flat_scores(scorer(spark, sf_dir).score(records(spark, sf_dir)))


_COUNTERS = {
    "total": "TRUE", "alerts": "probability > 0.5", "approvals": "NOT probability > 0.5", "undefined": "reasons IS NOT NULL",
    **{r: f"contains(coalesce(reasons, ''), '{r}')" for r in REASONS},
}


@query("observed_counters", f"WITH s AS ({_SCORE_SQL}) " + " UNION ALL ".join(f"SELECT '{n}' AS counter, count(*) FILTER (WHERE {c}) AS n FROM s" for n, c in _COUNTERS.items()))
def observed_counters(spark, sf_dir):
    """Alerts, approvals and violations of every rule, counted while the scores are written."""
    return scoring.write_scores(scorer(spark, sf_dir), records(spark, sf_dir), scratch_path(spark, "scores"))


def _flat_scores(scored):
    return scored.select(
        *LINE_KEY, r6("probability").alias("probability"), "grade", F.array_join("anomaly_reasons", "; ").alias("reasons"),
        F.size("shap_values").alias("n_values"), r6(F.abs(F.get(F.col("shap_values"), 0)["value"])).alias("top_size"),
    )


@query("nested_predictions", f"""WITH s AS ({_SCORE_SQL}) SELECT grade, count(*) AS n, count(*) FILTER (WHERE reasons IS NOT NULL) AS with_reasons,
  sum(n_values)::BIGINT AS n_values FROM s GROUP BY grade""")
def nested_predictions(spark, sf_dir):
    """Results written as JSON objects and read back; absent reasons leave no key."""
    scored = scorer(spark, sf_dir).score(records(spark, sf_dir))
    as_json = scored.select(F.to_json(scoring.prediction()).alias("j"))
    schema = "grade string, probability double, anomaly_reasons array<string>, shap_values array<struct<feature:string,value:double>>"
    back = tables.parse_records(as_json, "j", schema)
    return back.groupBy("grade").agg(
        F.count("*").alias("n"), F.count_if(F.col("j").contains("anomaly_reasons")).alias("with_reasons"), big(F.sum(F.size("shap_values"))).alias("n_values")
    )


# --- what-if and scenarios -------------------------------------------------------------------------


@query("what_if_sweep", f"""WITH base AS (SELECT c_custkey, c_acctbal, unnest(range(20, 71)) AS age FROM customer),
p AS (SELECT c_custkey, age, 1::DOUBLE / (1::DOUBLE + exp(-(-3::DOUBLE + 0.05::DOUBLE * age - 0.0002::DOUBLE * c_acctbal))) AS p FROM base)
SELECT c_custkey, age::INT AS age, round(p, 6) AS probability, round(0.05::DOUBLE * (age - 40), 6) + 0 AS age_attribution,
  CASE WHEN p < 0.25 THEN 'A' WHEN p < 0.5 THEN 'B' WHEN p < 0.75 THEN 'C' ELSE 'D' END AS grade FROM p""")
def what_if_sweep(spark, sf_dir):
    """Probability of every customer over the ages 20 to 70."""
    card = LinearScorecard(["age", "c_acctbal"], [0.05, -0.0002], -3.0, [40.0, 0.0])
    base = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    swept = card.score(scoring.sweep(base, "age", list(range(20, 71))))
    return swept.select(
        "c_custkey", "age", r6("probability").alias("probability"), r6(F.col("attributions")[0]["value"]).alias("age_attribution"),
        binning.score_grade(F.col("probability")).alias("grade"),
    )


# The options each scenario field draws from.
SCENARIO_OPTIONS = {
    "bureau_score": [300, 400, 500, 600, 700, 800, 850],
    "age": [25, 30, 40, 50, 60],
    "past_due_months": [0, 1, 2, 3, 4, 5],
    "marital_status": ["Menikah", "Belum menikah", "Cerai"],
    "employment_type": ["Pensiunan", "ASN aktif", "ASN kontrak", "PNS Purna Bakti", "Pegawai BUMN"],
    "salary_source": ["Taspen", "Pemerintah Daerah", "Kementerian"],
    "stability": ["Pemasukan stabil per bulan", "Pemasukan tidak stabil per bulan"],
    "credit_history_length": [1, 5, 10, 15, 20],
    "collateral_flag": ["1", "0"],
    "life_insurance_coverage": [0, 5000000, 50000000],
    "insurance_premium_monthly": [0, 150000, 500000],
    "insurance_status": ["Ada", "Lapsed", "Tidak ada"],
    "health_risk_score": [0.1, 0.5, 0.9],
    "medical_expense_ratio": [0.1, 0.3, 0.5],
    "loan_amount": [5000000, 10000000, 50000000, 100000000],
    "term_months": [6, 12, 24, 36, 48, 60],
}


def _sql_scenarios() -> str:
    fields = []
    for name, choices in SCENARIO_OPTIONS.items():
        items = ", ".join(f"'{c}'" if isinstance(c, str) else f"{c}::DOUBLE" if isinstance(c, float) else str(c) for c in choices)
        pick = sql_uniform("42", f"'{name}'", "o_orderkey")
        fields.append(f"([{items}])[floor({pick} * {len(choices)})::INT + 1] AS {name}")
    return f"SELECT o_orderkey, {', '.join(fields)}, 0.3::DOUBLE AS \"DTI\" FROM orders"


@query("grade_exemplars", f"""WITH sc AS ({_sql_scenarios()}), p AS (SELECT *, {PD_SQL} AS p FROM sc),
g AS (SELECT *, CASE WHEN age + term_months::DOUBLE / 12 > 80 OR age < 18 THEN 'Undefined' WHEN p < 0.25 THEN 'A' WHEN p < 0.5 THEN 'B'
  WHEN p < 0.75 THEN 'C' ELSE 'D' END AS grade FROM p)
SELECT grade, o_orderkey, round(p, 6) AS probability, bureau_score, age, marital_status, loan_amount FROM g
QUALIFY row_number() OVER (PARTITION BY grade ORDER BY o_orderkey) = 1""")
def grade_exemplars(spark, sf_dir):
    """One scenario per order; the first of every grade."""
    from riskframe.operators.rows import anomaly_reasons

    drawn = scoring.scenarios(table(spark, sf_dir, "orders"), "o_orderkey", SCENARIO_OPTIONS).withColumn("DTI", F.lit(0.3))
    scored = with_pd(drawn)
    grade = binning.score_grade(F.col("PD"), anomaly_reasons([c for c in scored.columns if c != "monthly_income"]))
    graded = scored.withColumns({"grade": grade, "probability": r6("PD")})
    return scoring.grade_exemplars(graded, "o_orderkey").select(
        "grade", "o_orderkey", "probability", "bureau_score", "age", "marital_status", "loan_amount"
    )


# --- sources and sinks -----------------------------------------------------------------------------


@query("json_records", """SELECT event_id, (props->>'$.k')::DOUBLE AS k, NULL::VARCHAR AS absent, event_id % 10 = 0 AS broken FROM events
WHERE event_id % 10 <> 0 UNION ALL SELECT event_id, NULL, NULL, TRUE FROM events WHERE event_id % 10 = 0""")
def json_records(spark, sf_dir):
    """Every tenth record is cut short: it keeps its row and is flagged."""
    text = F.when(F.col("event_id") % 10 == 0, F.substring("props", 1, 4)).otherwise(F.col("props"))
    parsed = tables.parse_records(table(spark, sf_dir, "events").select("event_id", text.alias("r")), "r", "k double, absent string")
    return parsed.select("event_id", "k", "absent", F.col("errors").isNotNull().alias("broken"))


@query("csv_roundtrip", """SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_brand END AS p_brand,
  CASE WHEN p_size % 3 = 0 THEN 'N/A' ELSE p_type END AS p_type, p_retailprice FROM part""")
def csv_roundtrip(spark, sf_dir):
    """'N/A' is missing in one column and a category in the other."""
    odd = F.col("p_size") % 3 == 0
    data = table(spark, sf_dir, "part").select(
        "p_partkey", F.when(odd, F.lit("N/A")).otherwise(F.col("p_brand")).alias("p_brand"),
        F.when(odd, F.lit("N/A")).otherwise(F.col("p_type")).alias("p_type"), "p_retailprice",
    )
    path = scratch_path(spark, "part_csv")
    tables.write_table(data, path, "csv")
    return tables.read_csv(spark, path, "p_partkey long, p_brand string, p_type string, p_retailprice double", keep_tokens={"p_type": ["N/A"]})


@query("run_metrics", f"""WITH c AS (SELECT l_returnflag, count(*) AS n, avg(l_discount) AS d FROM lineitem GROUP BY l_returnflag)
SELECT 'run-' || l_returnflag AS run_id, 'metric' AS kind, 'rows' AS key, n::DOUBLE AS num_value, NULL::VARCHAR AS str_value FROM c
UNION ALL SELECT 'run-' || l_returnflag, 'metric', 'mean_discount', round(d, 6), NULL FROM c
UNION ALL SELECT 'run-' || l_returnflag, 'param', 'flag', NULL, l_returnflag FROM c""")
def run_metrics(spark, sf_dir):
    """One run per return flag, appended to the long metrics table."""
    path = scratch_path(spark, "run_metrics")
    groups = table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(F.count("*").alias("n"), F.avg("l_discount").alias("d"))
    for r in groups.collect():
        rows = tables.metric_rows(spark, f"run-{r['l_returnflag']}", {"rows": r["n"], "mean_discount": round(r["d"], 6)}, {"flag": r["l_returnflag"]})
        tables.append_metrics(rows, path)
    return tables.read_metrics(spark, path).drop("ts")
