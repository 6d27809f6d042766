"""Row rules, risk formulas, triggers and gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.functions import binning, risk, text
from riskframe.operators import drift, gates, rows, triggers
from riskframe.operators.orderstats import auc
from riskframe.plans.encoding import DECILES
from riskframe.plans.profiles import SCORED_SQL, scored
from riskframe.plans.registry import big, query, r6, round_columns, table
from riskframe.plans.stability import SQL_LABEL
from riskframe.plans.views import (
    APPLICATIONS_SQL, EMPLOYER_RISK_SQL, PD_SQL, applications, sql_clip, with_pd,
)
from riskframe.session import scratch_path
from riskframe.sources.runs import RunRegistry

_LGD_SQL = sql_clip(
    """0.4::DOUBLE + 0.1::DOUBLE * CASE WHEN product_type = 'Vehicle Loan' THEN 0::DOUBLE ELSE 1::DOUBLE END
      - 0.15::DOUBLE * CASE WHEN insurance_status = 'Ada' THEN 1::DOUBLE ELSE 0::DOUBLE END""", 0.1, 0.8)
_LOSS_SQL = f"""{APPLICATIONS_SQL}, priced AS (SELECT *, {PD_SQL} AS "PD", {_LGD_SQL} AS "LGD", loan_amount * utilisation AS "EAD" FROM applications),
losses AS (SELECT *, "PD" * "LGD" * "EAD" AS expected_loss,
  CASE WHEN "PD" < 0 THEN NULL WHEN "PD" < 0.03 THEN 'A' WHEN "PD" < 0.07 THEN 'B' WHEN "PD" < 0.15 THEN 'C' WHEN "PD" < 1 THEN 'D' END AS risk_grade FROM priced)"""


def losses(spark, sf_dir):
    data = with_pd(applications(spark, sf_dir))
    data = data.withColumn("LGD", risk.loss_given_default(risk.collateral_flag(F.col("product_type")), F.col("insurance_status")))
    data = data.withColumn("EAD", risk.exposure_at_default(F.col("loan_amount"), F.col("utilisation")))
    return data.withColumns(
        {"expected_loss": risk.expected_loss(F.col("PD"), F.col("LGD"), F.col("EAD")), "risk_grade": binning.pd_grade(F.col("PD"))}
    )


@query("pd_lgd_ead", f"""WITH {_LOSS_SQL} SELECT o_orderkey, round("PD", 6) AS "PD", round("LGD", 6) AS "LGD", round("EAD", 4) AS "EAD",
  round(expected_loss, 4) AS expected_loss, risk_grade FROM losses""")
def pd_lgd_ead(spark, sf_dir):
    return losses(spark, sf_dir).select(
        "o_orderkey", r6("PD").alias("PD"), r6("LGD").alias("LGD"), F.round("EAD", 4).alias("EAD"),
        F.round("expected_loss", 4).alias("expected_loss"), "risk_grade",
    )


_KEPT = ["o_orderkey", "c_custkey", "age", "marital_status", "employment_type", "insurance_status", "product_type", "bureau_score", "DTI",
         "health_risk_score", "past_due_months", "term_months", "monthly_income", "loan_amount", "utilisation", "missed_payment_flag"]
_NO_TARGET = f"Target column 'Default' not found in DataFrame. Available columns: {_KEPT}"


@query("training_frame", f"""WITH {_LOSS_SQL}, flagged AS (SELECT *, (past_due_months > 1)::INT AS missed_payment_flag FROM losses)
SELECT {', '.join(f'"{c}"' for c in _KEPT)}, '{_NO_TARGET.replace("'", "''")}' AS without_target FROM flagged""")
def training_frame(spark, sf_dir):
    """What training reads: identifiers and outcomes dropped where they are there, the target checked; and what a missing one says."""
    data = losses(spark, sf_dir).withColumns({"customer_id": risk.padded_id("CUST", F.col("c_custkey")), "missed_payment_flag": (F.col("past_due_months") > 1).cast("int")})
    kept = rows.require_target(rows.drop_if_present(data), "missed_payment_flag")
    try:
        rows.require_target(kept, "Default")
    except KeyError as error:
        return kept.withColumn("without_target", F.lit(error.args[0]))


@query("expected_loss_by_grade", f"""WITH {_LOSS_SQL} SELECT risk_grade, product_type, count(*) AS n, round(sum("EAD"), 2) AS exposure,
  round(sum(expected_loss), 2) AS expected_loss FROM losses GROUP BY risk_grade, product_type""")
def expected_loss_by_grade(spark, sf_dir):
    return losses(spark, sf_dir).groupBy("risk_grade", "product_type").agg(
        F.count("*").alias("n"), F.round(F.sum("EAD"), 2).alias("exposure"), F.round(F.sum("expected_loss"), 2).alias("expected_loss")
    )


@query("grade_histogram", f"""WITH {_LOSS_SQL}, span AS (SELECT min(bureau_score) AS lo, max(bureau_score) AS hi FROM losses)
SELECT risk_grade, least(floor((bureau_score - lo) / ((hi - lo)::DOUBLE / 20))::INT, 19) AS bin_id, count(*) AS n
FROM losses, span GROUP BY 1, 2""")
def grade_histogram(spark, sf_dir):
    """Score distribution stacked by risk grade."""
    from riskframe.operators.profile import grouped_histogram

    return grouped_histogram(losses(spark, sf_dir), "bureau_score", "risk_grade", 20).select("risk_grade", "bin_id", "n")


@query("derived_ratios", f"""WITH {APPLICATIONS_SQL} SELECT o_orderkey,
  CASE WHEN employment_type = 'Pensiunan' THEN round_even(monthly_income * 0.8::DOUBLE, 0) ELSE 0::DOUBLE END AS pension_amount,
  round({EMPLOYER_RISK_SQL}, 6) AS employer_risk_score,
  round({sql_clip('0.1::DOUBLE + (age - 40) * 0.01::DOUBLE', 0.05, 0.45)}, 6) AS medical_expense_ratio,
  round({sql_clip('0.1::DOUBLE + (1::DOUBLE - utilisation) * 0.5::DOUBLE', 0.05, 0.5)}, 6) AS salary_volatility,
  round({sql_clip('past_due_months * 0.05::DOUBLE + monthly_income * 0.000005::DOUBLE * utilisation', 0.1, 0.6)}, 6) AS "DTI",
  round({sql_clip('0.2::DOUBLE + (age - 40) * 0.015::DOUBLE', 0.0, 1.0)}, 6) AS health_risk_score,
  round(CASE WHEN insurance_status = 'Ada' THEN monthly_income * 20::DOUBLE ELSE 0::DOUBLE END, 4) AS life_insurance_coverage,
  round({sql_clip('0.08::DOUBLE + loan_amount / 1e9::DOUBLE * 0.05::DOUBLE', 0.05, 0.2)}, 6) AS interest_rate,
  CASE WHEN product_type = 'Vehicle Loan' THEN 1 ELSE 0 END AS collateral_flag,
  round(CASE WHEN product_type = 'Vehicle Loan' THEN utilisation ELSE 0::DOUBLE END, 6) AS ltv,
  round_even(loan_amount, 0)::BIGINT AS loan_amount, printf('CUST%05d', c_custkey) AS customer_id,
  strftime(DATE '2024-01-01' + (o_orderkey % 365)::INT, '%Y-%m-%d') AS issue_date,
  round(monthly_income * (1::DOUBLE + 0.5::DOUBLE * CASE WHEN age < 55 THEN 1::DOUBLE ELSE 0::DOUBLE END), 4) AS monthly_income
FROM applications""")
def derived_ratios(spark, sf_dir):
    c = F.col
    return applications(spark, sf_dir).select(
        "o_orderkey",
        risk.pension_amount(c("employment_type"), c("monthly_income")).alias("pension_amount"),
        r6(risk.employer_risk_score(c("employment_type"))).alias("employer_risk_score"),
        r6(risk.medical_expense_ratio(c("age"))).alias("medical_expense_ratio"),
        r6(risk.salary_volatility(c("utilisation"))).alias("salary_volatility"),
        r6(risk.debt_to_income(c("past_due_months"), c("monthly_income"), c("utilisation"))).alias("DTI"),
        r6(risk.health_risk_score(c("age"))).alias("health_risk_score"),
        F.round(risk.if_insured(c("insurance_status"), c("monthly_income") * F.lit(20.0)), 4).alias("life_insurance_coverage"),
        r6(risk.interest_rate(c("loan_amount"))).alias("interest_rate"),
        risk.collateral_flag(c("product_type")).alias("collateral_flag"),
        r6(risk.loan_to_value(risk.collateral_flag(c("product_type")), c("utilisation"))).alias("ltv"),
        risk.round_to_long(c("loan_amount")).alias("loan_amount"),
        risk.padded_id("CUST", c("c_custkey")).alias("customer_id"),
        risk.date_from_offset("2024-01-01", c("o_orderkey") % 365).cast("string").alias("issue_date"),
        F.round(risk.monthly_income(c("monthly_income"), c("age")), 4).alias("monthly_income"),
    )


def odd_applications(spark, sf_dir):
    """Applications with fields out of bounds, and some missing."""
    key = F.col("o_orderkey")
    return applications(spark, sf_dir).select(
        "o_orderkey",
        F.when(key % 17 != 0, (F.col("c_custkey") % 110).cast("int")).alias("age"),
        "monthly_income",
        F.when(key % 13 == 0, F.lit(0.0)).otherwise(F.col("loan_amount")).alias("loan_amount"),
        F.when(key % 7 != 0, (key % 30 - 2) / F.lit(10.0)).alias("ltv"),
        "term_months",
    )


_ODD_SQL = f"""{APPLICATIONS_SQL}, odd AS (SELECT o_orderkey, CASE WHEN o_orderkey % 17 <> 0 THEN c_custkey % 110 END AS age, monthly_income,
  CASE WHEN o_orderkey % 13 = 0 THEN 0::DOUBLE ELSE loan_amount END AS loan_amount,
  CASE WHEN o_orderkey % 7 <> 0 THEN (o_orderkey % 30 - 2)::DOUBLE / 10::DOUBLE END AS ltv, term_months FROM applications)"""
_REASONS_SQL = """concat_ws('; ', CASE WHEN age < 18 OR age > 100 THEN 'Invalid age' END,
    CASE WHEN monthly_income < 0 THEN 'Negative monthly income' END, CASE WHEN loan_amount <= 0 THEN 'Invalid loan amount' END,
    CASE WHEN ltv < 0 OR ltv > 2 THEN 'LTV out of bounds' END,
    CASE WHEN age + term_months::DOUBLE / 12::DOUBLE > 80 THEN 'Usia saat pelunasan melebihi batas (80 tahun)' END)"""


@query("anomaly_rules", f"WITH {_ODD_SQL} SELECT o_orderkey, {_REASONS_SQL} AS reasons FROM odd")
def anomaly_rules(spark, sf_dir):
    data = odd_applications(spark, sf_dir)
    return data.select("o_orderkey", F.array_join(rows.anomaly_reasons(data.columns), "; ").alias("reasons"))


@query("score_grades", f"""WITH {_ODD_SQL}, p AS (SELECT o_orderkey, {PD_SQL} AS p FROM applications)
SELECT o_orderkey, round(p, 6) AS probability, CASE WHEN {_REASONS_SQL} <> '' THEN 'Undefined' WHEN p < 0.25 THEN 'A' WHEN p < 0.5 THEN 'B'
  WHEN p < 0.75 THEN 'C' ELSE 'D' END AS grade FROM odd JOIN p USING (o_orderkey)""")
def score_grades(spark, sf_dir):
    odd = odd_applications(spark, sf_dir)
    odd = odd.select("o_orderkey", rows.anomaly_reasons(odd.columns).alias("reasons"))
    data = with_pd(applications(spark, sf_dir)).select("o_orderkey", "PD").join(odd, "o_orderkey")
    return data.select("o_orderkey", r6("PD").alias("probability"), binning.score_grade(F.col("PD"), F.col("reasons")).alias("grade"))


@query("default_fill", f"""WITH {_ODD_SQL} SELECT o_orderkey, age::BIGINT AS age, 2816651.0::DOUBLE AS avg_account_balance,
  'Hijau' AS medical_check_grade, 0::BIGINT AS unknown_feature FROM odd""")
def default_fill(spark, sf_dir):
    """Absent columns are added; the nulls of ``age`` stay null."""
    required = ["age", "avg_account_balance", "medical_check_grade", "unknown_feature"]
    filled = rows.fill_missing_columns(odd_applications(spark, sf_dir).select("o_orderkey", "age"), required)
    return filled.withColumns({"age": big("age"), "unknown_feature": big("unknown_feature")})


@query("constraint_check", f"""WITH {APPLICATIONS_SQL} SELECT 'age_minus_employed' AS rule, count(*) AS n_rows,
  count(*) FILTER (WHERE NOT (age - (o_orderkey % 40) >= 18)) AS n_violations FROM applications
UNION ALL SELECT 'income_positive', count(*), count(*) FILTER (WHERE NOT monthly_income > 0) FROM applications""")
def constraint_check(spark, sf_dir):
    data = applications(spark, sf_dir).withColumn("years_employed", F.col("o_orderkey") % 40)
    rules = {"age_minus_employed": rows.inequality("years_employed", "age", 18), "income_positive": F.col("monthly_income") > 0}
    return rows.constraint_violations(data, rules)


@query("field_remap", """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 1.0::DOUBLE WHEN 'O' THEN 0.0::DOUBLE END AS income_stability,
  CASE WHEN o_orderstatus = 'P' THEN NULL ELSE substr(o_orderpriority, 1, 1)::DOUBLE END AS priority FROM orders""")
def field_remap(spark, sf_dir):
    stable = F.when(F.col("o_orderstatus") == "F", F.lit(text.STABLE_INCOME)).when(
        F.col("o_orderstatus") == "O", F.lit("Pemasukan tidak stabil per bulan")
    ).otherwise(F.lit(""))
    typed = F.when(F.col("o_orderstatus") == "P", F.lit("")).otherwise(F.substring("o_orderpriority", 1, 1))
    data = table(spark, sf_dir, "orders").select("o_orderkey", stable.alias("stability"), text.numeric_text(typed).alias("priority"))
    return text.remap_stability(data)


@query("label_format", """SELECT p_partkey, 'DTI ' || upper(p_name[1]) || split_part(p_name, ' ', 1)[2:] || ' ' ||
  upper(split_part(p_name, ' ', 2)[1]) || split_part(p_name, ' ', 2)[2:] AS label,
  CASE WHEN p_retailprice > 1000 THEN '+' ELSE '' END || printf('%.3f', p_retailprice - 1000::DOUBLE) AS value
FROM part""")
def label_format(spark, sf_dir):
    name = F.concat(F.lit("DTI_"), F.replace("p_name", F.lit(" "), F.lit("_")), F.lit("_woe"))
    value = F.col("p_retailprice") - F.lit(1000.0)
    return table(spark, sf_dir, "part").select(
        "p_partkey", text.display_label(text.display_feature(name)).alias("label"), text.signed_value(value).alias("value")
    )


@query("ordinal_encode", """WITH v AS (SELECT p_partkey, coalesce(CASE WHEN p_brand <> 'Brand#1' THEN p_brand END, 'Missing') AS b, p_type AS t FROM part)
SELECT p_partkey, (dense_rank() OVER (ORDER BY b) - 1)::DOUBLE AS p_brand, (dense_rank() OVER (ORDER BY t) - 1)::DOUBLE AS p_type FROM v""")
def ordinal_encode(spark, sf_dir):
    brand = F.when(F.col("p_brand") != "Brand#1", F.col("p_brand")).alias("p_brand")
    return rows.ordinal_encode(table(spark, sf_dir, "part").select("p_partkey", brand, "p_type"), ["p_brand", "p_type"])


# --- model versions: every order is a version of its customer's model -----------------------

AS_OF_DAY = 10_592  # 1999-01-01
_STAGES = {"F": "Production", "O": "Staging", "P": "Archived"}


def versions(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    stage = F.lit("None")
    for status, name in _STAGES.items():
        stage = F.when(F.col("o_orderstatus") == status, F.lit(name)).otherwise(stage)
    days = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1970-01-01").cast("date"))
    return orders.select(
        F.concat(F.lit("model_"), F.col("o_custkey")).alias("name"), F.col("o_orderkey").cast("string").alias("version"),
        stage.alias("stage"), F.concat(F.lit("run-"), F.col("o_orderkey")).alias("run_id"),
        (days.cast("long") * F.lit(triggers.MS_PER_DAY)).alias("creation_timestamp"),
    )


_VERSIONS_SQL = """versions AS (SELECT 'model_' || o_custkey AS name, o_orderkey::VARCHAR AS version, 'run-' || o_orderkey AS run_id,
  CASE o_orderstatus WHEN 'F' THEN 'Production' WHEN 'O' THEN 'Staging' WHEN 'P' THEN 'Archived' ELSE 'None' END AS stage,
  date_diff('day', DATE '1970-01-01', o_orderdate::DATE)::BIGINT * 86400000 AS creation_timestamp FROM orders),
latest AS (SELECT * FROM versions QUALIFY row_number() OVER (PARTITION BY name ORDER BY (stage = 'Production')::INT DESC, version::BIGINT DESC) = 1)"""


@query("latest_version", f"WITH {_VERSIONS_SQL} SELECT name, version, stage, run_id, creation_timestamp FROM latest")
def latest_version(spark, sf_dir):
    return triggers.latest_versions(versions(spark, sf_dir))


@query("promotion", f"""WITH {_VERSIONS_SQL}, top AS (SELECT name, max(version::BIGINT)::VARCHAR AS new FROM versions GROUP BY name)
SELECT name, version, CASE WHEN version = new THEN 'Production' WHEN stage = 'Production' THEN 'Archived' ELSE stage END AS stage
FROM versions JOIN top USING (name)""")
def promotion(spark, sf_dir):
    """The newest version of every model goes to production, the former one to the archive."""
    all_versions = versions(spark, sf_dir)
    newest = all_versions.groupBy("name").agg(F.max(F.col("version").cast("long")).cast("string").alias("version"))
    return triggers.promote(all_versions, newest).select("name", "version", "stage")


# --- drift of a portfolio against the reference of the model version in production ------------------

PORTFOLIO_MODEL = "portfolio_model"
_PORTFOLIO_DAY = "1998-07-01"
#: Recent orders of this segment are dearer than they were.
_DEARER, _FACTOR = "BUILDING", 1.6


def _portfolio_orders(spark, sf_dir):
    """Orders with their customer's segment and whether they are recent; the prices of one segment have risen."""
    orders = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    recent = F.col("o_orderdate") >= F.lit(_PORTFOLIO_DAY).cast("timestamp_ntz")
    price = F.col("o_totalprice")
    risen = F.when(recent & (F.col("c_mktsegment") == _DEARER), price * F.lit(_FACTOR)).otherwise(price)
    return orders.select("c_mktsegment", recent.alias("recent"), risen.alias("o_totalprice"), F.col("c_acctbal"))


def portfolio_registry(spark, sf_dir):
    """A registry whose version in production keeps the drift reference of its training time, per segment."""
    registry = RunRegistry(spark, scratch_path(spark, "portfolio_registry"))
    past = _portfolio_orders(spark, sf_dir).where("not recent")
    run = registry.begin("portfolio-1")
    run.write("drift_reference", drift.fit_reference(past, ["o_totalprice", "c_acctbal"], "c_mktsegment").coalesce(1))
    run.commit(PORTFOLIO_MODEL)
    return registry


def current_drift(spark, sf_dir):
    """Recent orders against the reference that is kept with the version in production."""
    registry = portfolio_registry(spark, sf_dir)
    reference = registry.read(registry.production_run(PORTFOLIO_MODEL), "drift_reference")
    return drift.reference_drift(reference, _portfolio_orders(spark, sf_dir).where("recent"), "c_mktsegment")


def _sql_drift() -> str:
    parts = [f"""SELECT c_mktsegment AS portfolio, '{f}' AS feature, {f} AS v, recent FROM po WHERE {f} IS NOT NULL""" for f in ("o_totalprice", "c_acctbal")]
    return f"""po AS (SELECT c_mktsegment, c_acctbal, o_orderdate >= TIMESTAMP '{_PORTFOLIO_DAY}' AS recent,
    CASE WHEN o_orderdate >= TIMESTAMP '{_PORTFOLIO_DAY}' AND c_mktsegment = '{_DEARER}' THEN o_totalprice * {_FACTOR}::DOUBLE ELSE o_totalprice END AS o_totalprice
  FROM orders JOIN customer ON o_custkey = c_custkey),
vals AS ({' UNION ALL '.join(parts)}),
qs AS (SELECT portfolio, feature, list_sort(list_distinct(quantile_cont(v, {DECILES}))) AS e FROM vals WHERE NOT recent GROUP BY ALL),
dbins AS (SELECT portfolio, feature, (i - 1)::INT AS bin_id, CASE WHEN i = 1 THEN '-infinity'::DOUBLE ELSE e[i] END AS lo,
    CASE WHEN i = len(e) - 1 THEN 'infinity'::DOUBLE ELSE e[i + 1] END AS hi FROM (SELECT *, unnest(range(1, len(e))) AS i FROM qs)),
dn AS (SELECT b.portfolio, b.feature, b.bin_id, lo, count(*) FILTER (WHERE NOT recent) AS n_ref, count(*) FILTER (WHERE recent) AS n_cur
  FROM dbins b LEFT JOIN vals v ON v.portfolio = b.portfolio AND v.feature = b.feature AND v.v >= b.lo AND v.v < b.hi GROUP BY ALL),
dshare AS (SELECT *, CASE WHEN n_ref = 0 THEN 0.0001::DOUBLE ELSE n_ref / sum(n_ref) OVER w END AS r,
    CASE WHEN n_cur = 0 THEN 0.0001::DOUBLE ELSE n_cur / sum(n_cur) OVER w END AS c FROM dn WINDOW w AS (PARTITION BY portfolio, feature)),
drift AS (SELECT portfolio, feature, sum(n_cur)::BIGINT AS n_cur, sum((c - r) * ln(c / r)) AS psi FROM dshare GROUP BY portfolio, feature)"""


@query("portfolio_reference", f"""WITH {_sql_drift()} SELECT portfolio, feature, bin_id, CASE WHEN isinf(lo) THEN NULL ELSE round(lo, 6) END AS lo, n_ref,
  round(n_ref / sum(n_ref) OVER (PARTITION BY portfolio, feature), 6) AS share FROM dn""")
def portfolio_reference(spark, sf_dir):
    """The reference as a reader finds it in the registry: edges and shares per segment and feature."""
    registry = portfolio_registry(spark, sf_dir)
    rows = registry.read(registry.production_run(PORTFOLIO_MODEL), "drift_reference")
    low = F.when(F.col("lo") != F.lit(float("-inf")), r6("lo"))
    return rows.select("portfolio", "feature", "bin_id", low.alias("lo"), "n_ref", r6("share").alias("share"))


@query("portfolio_drift", f"WITH {_sql_drift()} SELECT portfolio, feature, n_cur, round(psi, 6) AS psi, {SQL_LABEL.format(v='psi')} AS interpretation FROM drift")
def portfolio_drift(spark, sf_dir):
    return current_drift(spark, sf_dir).withColumn("psi", r6("psi"))


@query("retrain_decision", f"""WITH {_VERSIONS_SQL}, {_sql_drift()}, m AS (SELECT 'model_' || c_custkey AS name, c_mktsegment AS portfolio,
    3::DOUBLE + (c_custkey % 30)::DOUBLE / 10::DOUBLE AS u, 6::DOUBLE + (c_custkey % 25)::DOUBLE / 10::DOUBLE AS i FROM customer),
over AS (SELECT portfolio, string_agg(feature, ', ' ORDER BY feature) AS names FROM drift WHERE round(psi, 6) > 0.25 GROUP BY portfolio),
j AS (SELECT m.name, u, i, version, names, floor(({AS_OF_DAY}::BIGINT * 86400000 - creation_timestamp) / 86400000)::BIGINT AS days
  FROM m LEFT JOIN latest USING (name) LEFT JOIN over USING (portfolio)),
reasons AS (SELECT name, concat_ws(' | ', CASE WHEN version IS NULL THEN 'No model named ' || name || ' found in MLflow.'
    WHEN days > 90 THEN 'Model is ' || days || ' days old (Threshold: 90).' END,
  CASE WHEN u > 5 THEN 'Unemployment spiked to ' || u || '%' WHEN i > 8 THEN 'Inflation spiked to ' || i || '%' END,
  CASE WHEN names IS NOT NULL THEN 'Drift above 0.25 in ' || names || '.' END) AS r FROM j)
SELECT name, r <> '' AS should_retrain, CASE WHEN r <> '' THEN r ELSE 'All checks pass. Model is stable.' END AS reason,
  json_object('should_retrain', r <> '', 'reason', CASE WHEN r <> '' THEN r ELSE 'All checks pass. Model is stable.' END)::VARCHAR AS decision FROM reasons""")
def retrain_decision(spark, sf_dir):
    """Age, macro figures and drift of the customer's segment; any of them alone starts a retrain."""
    from riskframe.sources.tables import decision_json

    key = F.col("c_custkey")
    models = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("model_"), key).alias("name"), F.col("c_mktsegment").alias("portfolio"),
        (F.lit(3.0) + (key % 30) / F.lit(10.0)).alias("u"), (F.lit(6.0) + (key % 25) / F.lit(10.0)).alias("i"),
    )
    age = triggers.model_age_trigger(models, versions(spark, sf_dir), AS_OF_DAY * triggers.MS_PER_DAY)
    drifted = drift.portfolio_triggers(current_drift(spark, sf_dir)).select("portfolio", F.struct("triggered", "reason").alias("drift"))
    joined = models.join(age.select("name", F.struct("triggered", "reason").alias("age")), "name").join(drifted, "portfolio", "left")
    unknown = F.struct(F.lit(False).alias("triggered"), F.lit(drift.NO_DRIFT).alias("reason"))
    macro = triggers.macro_trigger(F.col("u"), F.col("i"))
    legs = [F.col("age"), macro, F.coalesce("drift", unknown)]
    decided = joined.select("name", triggers.decision(legs).alias("d")).select("name", "d.*")
    return decided.withColumn("decision", decision_json(should_retrain=F.col("should_retrain"), reason=F.col("reason")))


# --- gates over scores of the credit view ----------------------------------------------------------

_GATE_SCORES = ["p6", "s", "l_quantity", "l_extendedprice"]


def _gate_sql() -> str:
    parts = [f"""SELECT '{c}' AS score, sum(pos * (upto - neg / 2)) / (sum(pos)::DOUBLE * sum(neg)) AS auc FROM (
    SELECT sum(y) AS pos, sum(1 - y) AS neg, sum(sum(1 - y)) OVER (ORDER BY {c}) AS upto FROM scored GROUP BY {c})""" for c in _GATE_SCORES]
    return f"""WITH {SCORED_SQL.replace("AS p FROM credit", "AS p, round(p, 6) AS p6 FROM credit")}, a AS ({' UNION ALL '.join(parts)}), b AS (SELECT auc AS base FROM a WHERE score = 'p6')
SELECT score, round(auc, 6) AS auc, round((base - auc) / base, 6) + 0 AS auc_drop,
  CASE WHEN (base - auc) / base > 0.1 THEN 'Low Utility' ELSE 'Pass' END AS utility_status, auc > 0.7 AS registers, auc >= 0.75 AS promotes
FROM a, b"""


@query("utility_gate", _gate_sql())
def utility_gate(spark, sf_dir):
    """Every score of the credit view against the scorecard's AUC."""
    found = auc(scored(spark, sf_dir).withColumn("p6", r6("p")), "y", _GATE_SCORES)
    base = found.where("score = 'p6'").first()["auc"]
    trtr, tstr = F.lit(base), F.col("auc")
    gated = found.select(
        "score", r6("auc").alias("auc"), r6(gates.auc_drop(trtr, tstr)).alias("auc_drop"),
        gates.utility_status(trtr, tstr).alias("utility_status"), gates.registers(tstr).alias("registers"), gates.promotes(tstr).alias("promotes"),
    )
    return round_columns(gated, ["auc"])
