"""WoE and IV queries."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from riskframe.operators.woe import WoETransformer
from riskframe.operators.woe_stage import WoEEncoder
from riskframe.plans.registry import big, query, r6, table
from riskframe.plans.views import (
    CREDIT_CATEGORIES, CREDIT_NUMERIC, CREDIT_SQL, EARLY_SQL, LATE_SQL, LINE_KEY, credit, early, late,
)
from riskframe.session import scratch_path

FEATURES = CREDIT_NUMERIC + CREDIT_CATEGORIES
DECILES = "[0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]"


# --- SQL twins -------------------------------------------------------------------------------------


def sql_bins(name: str, feature: str, source: str) -> str:
    """Right-closed decile bins of one feature as ``name(bin_id, lo, hi)``."""
    return f"""{name} AS (
  SELECT (i - 1)::INT AS bin_id, e[i] AS lo, e[i + 1] AS hi
  FROM (SELECT e, unnest(range(1, len(e))) AS i
        FROM (SELECT list_sort(list_distinct(quantile_cont({feature}, {DECILES}))) AS e FROM {source})))"""


def sql_in_bin(value: str, bins: str = "b") -> str:
    return f"({value} > {bins}.lo OR ({bins}.bin_id = 0 AND {value} = {bins}.lo)) AND {value} <= {bins}.hi"


def sql_numeric_counts(feature: str, bins: str, source: str) -> str:
    return f"""SELECT '{feature}' AS feature, b.bin_id, NULL::VARCHAR AS category, b.lo, b.hi,
    coalesce(sum(s.y), 0)::BIGINT AS events, count(s.y)::BIGINT AS total
  FROM {bins} b LEFT JOIN {source} s ON {sql_in_bin('s.' + feature)} GROUP BY ALL"""


def sql_category_counts(feature: str, source: str) -> str:
    return f"""SELECT '{feature}' AS feature, NULL::INT AS bin_id, {feature}::VARCHAR AS category, NULL::DOUBLE AS lo,
    NULL::DOUBLE AS hi, coalesce(sum(y), 0)::BIGINT AS events, count(y)::BIGINT AS total
  FROM {source} WHERE {feature} IS NOT NULL GROUP BY {feature}"""


SQL_EVIDENCE = """shares AS (
  SELECT *, total - events AS non_events,
    (events + 0.0001::DOUBLE) / (sum(events) OVER (PARTITION BY feature) + 0.0001::DOUBLE) AS pct_events,
    (total - events + 0.0001::DOUBLE) / (sum(total - events) OVER (PARTITION BY feature) + 0.0001::DOUBLE) AS pct_non_events
  FROM counts),
evidence AS (
  SELECT *, ln(pct_non_events / pct_events) AS woe,
    (pct_non_events - pct_events) * ln(pct_non_events / pct_events) AS iv_component FROM shares)"""


def sql_evidence(ctes: str, source: str, numeric, categories) -> str:
    """CTEs that end in ``evidence`` over the given features of ``source``."""
    bins = [sql_bins(f"bins_{c}", c, source) for c in numeric]
    counts = [sql_numeric_counts(c, f"bins_{c}", source) for c in numeric]
    counts += [sql_category_counts(c, source) for c in categories]
    head = [ctes, *bins] if ctes else bins
    return "WITH " + ",\n".join([*head, "counts AS (" + "\n  UNION ALL\n".join(counts) + ")", SQL_EVIDENCE])


SQL_ROUNDED = """round(pct_events, 6) AS pct_events, round(pct_non_events, 6) AS pct_non_events,
  round(woe, 6) + 0 AS woe, round(iv_component, 6) + 0 AS iv_component"""

SQL_BAND = """CASE WHEN iv >= 0.5 THEN 'Suspicious / Over-predicting' WHEN iv >= 0.3 THEN 'Strong Predictor'
    WHEN iv >= 0.1 THEN 'Medium Predictor' WHEN iv >= 0.02 THEN 'Weak Predictor'
    WHEN iv >= 0 THEN 'Not Predictive' ELSE 'Unknown' END"""

SQL_IV = """iv AS (SELECT feature, sum(iv_component) AS iv FROM evidence GROUP BY feature),
ranked AS (SELECT *, row_number() OVER (ORDER BY iv DESC, feature)::INT AS iv_rank FROM iv)"""


# --- queries ---------------------------------------------------------------------------------------


def _fit(spark, sf_dir, features, **options) -> WoETransformer:
    return WoETransformer("y", cache_input=True, **options).fit(credit(spark, sf_dir).select(*features, "y"))


def _rounded(woe_table):
    cols = ["pct_events", "pct_non_events", "woe", "iv_component"]
    return woe_table.withColumns({c: r6(c) for c in cols})


@query(
    "woe_table_numeric",
    sql_evidence(CREDIT_SQL, "credit", CREDIT_NUMERIC, [])
    + f" SELECT feature, bin_id, round(lo, 6) AS lo, round(hi, 6) AS hi, events, total, non_events, {SQL_ROUNDED} FROM evidence",
)
def woe_table_numeric(spark, sf_dir):
    rows = _rounded(_fit(spark, sf_dir, CREDIT_NUMERIC).woe_table).drop("category")
    return rows.withColumns({"lo": r6("lo"), "hi": r6("hi")})


@query(
    "woe_table_categorical",
    sql_evidence(CREDIT_SQL, "credit", [], CREDIT_CATEGORIES)
    + f" SELECT feature, category, events, total, non_events, {SQL_ROUNDED} FROM evidence",
)
def woe_table_categorical(spark, sf_dir):
    return _rounded(_fit(spark, sf_dir, CREDIT_CATEGORIES).woe_table).drop("bin_id", "lo", "hi")


@query(
    "iv_summary",
    sql_evidence(CREDIT_SQL, "credit", CREDIT_NUMERIC, CREDIT_CATEGORIES)
    + f", {SQL_IV} SELECT feature, round(iv, 6) AS iv, {SQL_BAND} AS interpretation, iv_rank FROM ranked",
)
def iv_summary(spark, sf_dir):
    return _fit(spark, sf_dir, FEATURES).get_iv_summary().withColumn("iv", r6("iv"))


@query(
    "selected_features",
    sql_evidence(CREDIT_SQL, "credit", CREDIT_NUMERIC, CREDIT_CATEGORIES)
    + f", {SQL_IV} SELECT feature, round(iv, 6) AS iv, iv_rank FROM ranked WHERE iv >= 0.02 AND iv_rank <= 2",
)
def selected_features(spark, sf_dir):
    fitted = _fit(spark, sf_dir, FEATURES, iv_threshold=0.02, top_k=2)
    summary = fitted.get_iv_summary().where(F.col("feature").isin(fitted.get_selected_features()))
    return summary.select("feature", r6("iv").alias("iv"), "iv_rank")


def _transform_sql() -> str:
    """Every feature: bins by range, categories by equality; the names of the encoded columns are the features'."""
    columns, joins = [], []
    for f in FEATURES:
        columns.append(f"round(coalesce(w_{f}.woe, 0), 6) + 0 AS {f}")
        match = sql_in_bin(f"c.{f}", f"w_{f}") if f in CREDIT_NUMERIC else f"w_{f}.category = c.{f}::VARCHAR"
        joins.append(f"LEFT JOIN (SELECT * FROM evidence WHERE feature = '{f}') w_{f} ON {match}")
    head = sql_evidence(f"{CREDIT_SQL}, train AS (SELECT * FROM credit WHERE {EARLY_SQL})", "train", CREDIT_NUMERIC, CREDIT_CATEGORIES)
    return f"{head} SELECT {', '.join('c.' + k for k in LINE_KEY)}, c.y, {', '.join(columns)} FROM credit c {' '.join(joins)} WHERE {LATE_SQL}"


_TRANSFORM_SQL = _transform_sql()


def _encoder(spark, sf_dir) -> WoETransformer:
    """All features, whatever their information value, so that the columns do not depend on the data."""
    train = early(credit(spark, sf_dir)).select(*FEATURES, "y")
    return WoETransformer("y", iv_threshold=0.0, cache_input=True).fit(train)


def _apply(fitted, spark, sf_dir):
    rows = fitted.transform(late(credit(spark, sf_dir)), keep_target=True, keep_cols=LINE_KEY)
    return rows.withColumns({c: r6(c) for c in fitted.get_selected_features()})


@query("woe_transform", _TRANSFORM_SQL)
def woe_transform(spark, sf_dir):
    return _apply(_encoder(spark, sf_dir), spark, sf_dir)


@query("encoder_roundtrip", _TRANSFORM_SQL)
def encoder_roundtrip(spark, sf_dir):
    """The saved and reloaded encoder gives what the fitted one gives."""
    path = scratch_path(spark, "encoder")
    _encoder(spark, sf_dir).save(path)
    return _apply(WoETransformer.load(spark, path), spark, sf_dir)


@query("woe_stage", _TRANSFORM_SQL)
def woe_stage(spark, sf_dir):
    """The encoder as a stage of a fitted pipeline that was saved and loaded."""
    train = early(credit(spark, sf_dir)).select(*FEATURES, "y")
    path = scratch_path(spark, "woe_pipeline")
    Pipeline(stages=[WoEEncoder(inputCols=FEATURES, labelCol="y", ivThreshold=0.0)]).fit(train).save(path)
    encoded = PipelineModel.load(path).transform(late(credit(spark, sf_dir)))
    return encoded.select(*LINE_KEY, "y", *[r6(f"{c}_woe").alias(c) for c in FEATURES])


_LABELS_SQL = """labelled AS (
  SELECT CASE WHEN lang <> 'fr' THEN lang END AS lang, source, n_chars, 1 - quality AS y
  FROM documents LEFT JOIN labels USING (doc_id))"""


@query(
    "woe_labels",
    sql_evidence(_LABELS_SQL, "labelled", ["n_chars"], ["lang", "source"])
    + f" SELECT feature, bin_id, category, round(lo, 6) AS lo, round(hi, 6) AS hi, events, total, non_events, {SQL_ROUNDED} FROM evidence",
)
def woe_labels(spark, sf_dir):
    """Missing targets and a missing category: both stay out of the totals."""
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    data = docs.select(
        F.when(F.col("lang") != "fr", F.col("lang")).alias("lang"), "source", "n_chars", (F.lit(1) - F.col("quality")).alias("y")
    )
    rows = _rounded(WoETransformer("y", cache_input=True).fit(data).woe_table)
    return rows.withColumns({"lo": r6("lo"), "hi": r6("hi")})


@query(
    "equal_width_bins",
    f"""WITH {CREDIT_SQL}, span AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM credit),
binned AS (SELECT y, CASE WHEN l_extendedprice = lo THEN 0
    ELSE least(ceil((l_extendedprice - lo) / ((hi - lo) / 10))::INT, 10) - 1 END AS bin_id FROM credit, span)
SELECT bin_id::INT AS bin_id, count(*)::BIGINT AS n, sum(y)::BIGINT AS events FROM binned GROUP BY bin_id""",
)
def equal_width_bins(spark, sf_dir):
    from riskframe.functions.binning import equal_width_edges, right_closed_bin
    from riskframe.operators.profile import value_range

    data = credit(spark, sf_dir)
    edges = equal_width_edges(*value_range(data, "l_extendedprice"), 10)
    binned = data.select(right_closed_bin("l_extendedprice", edges).alias("bin_id"), "y")
    return binned.groupBy("bin_id").agg(F.count("*").alias("n"), big(F.sum("y")).alias("events"))
