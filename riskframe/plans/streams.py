"""Streams over the events table, checked against the batch form of the same result."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from riskframe.operators import drift
from riskframe.operators.scorecard import LinearScorecard
from riskframe.operators.scoring import Scorer
from riskframe.operators.woe import WoETransformer
from riskframe.plans.encoding import DECILES, sql_evidence, sql_in_bin
from riskframe.plans.registry import query, r6, table
from riskframe.session import scratch_path
from riskframe.streaming import streams

# Events of the first half of the month are the reference of the drift.
REFERENCE_SQL = "ts < TIMESTAMP '2024-01-16'"


def _stream(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    raw = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return streams.with_event_time(raw)


def _reference(spark, sf_dir):
    """The reference of the stream is one that was written as a table, as a batch check would read it."""
    past = table(spark, sf_dir, "events").where(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz"))
    path = scratch_path(spark, "stream_reference")
    drift.fit_reference(past, ["value"]).coalesce(1).write.parquet(path)
    return streams.DriftReference.of_table(spark.read.parquet(path), "value")


def _paths(spark, name):
    return scratch_path(spark, name), scratch_path(spark, f"{name}_checkpoint")


_PSI_SQL = f"""WITH bins AS (SELECT (i - 1)::INT AS bin_id, CASE WHEN i = 1 THEN '-infinity'::DOUBLE ELSE e[i] END AS lo,
    CASE WHEN i = len(e) - 1 THEN 'infinity'::DOUBLE ELSE e[i + 1] END AS hi
  FROM (SELECT e, unnest(range(1, len(e))) AS i
        FROM (SELECT list_sort(list_distinct(quantile_cont(value, {DECILES}))) AS e FROM events WHERE {REFERENCE_SQL}))),
b AS (SELECT date_trunc('day', ts) AS d, bin_id, {REFERENCE_SQL} AS is_ref FROM events JOIN bins ON value >= lo AND value < hi),
ref AS (SELECT bin_id, CASE WHEN count(*) FILTER (WHERE is_ref) = 0 THEN 0.0001::DOUBLE
    ELSE count(*) FILTER (WHERE is_ref) / sum(count(*) FILTER (WHERE is_ref)) OVER () END AS r FROM bins LEFT JOIN b USING (bin_id) GROUP BY bin_id),
days AS (SELECT d, count(*) AS n FROM b GROUP BY d),
cells AS (SELECT days.d, days.n, r, (SELECT count(*) FROM b WHERE b.d = days.d AND b.bin_id = ref.bin_id) AS c FROM days, ref),
psi AS (SELECT d, n, sum((s - r) * ln(s / r)) AS psi FROM (SELECT *, CASE WHEN c = 0 THEN 0.0001::DOUBLE ELSE c / n END AS s FROM cells) GROUP BY d, n)"""


@query("stream_psi", f"{_PSI_SQL} SELECT strftime(d, '%Y-%m-%d') AS day, n::BIGINT AS n, round(psi, 6) AS psi FROM psi")
def stream_psi(spark, sf_dir):
    """PSI of every day against the first half of the month, the open last day included."""
    path, checkpoint = _paths(spark, "stream_psi")
    reference = _reference(spark, sf_dir)
    streams.start_window_counts(_stream(spark, sf_dir), reference, path, checkpoint).awaitTermination()
    found = streams.window_psi(streams.latest_counts(spark, path), reference)
    return found.select(streams.utc_day("window_start").alias("day"), "n", r6("psi").alias("psi"))


@query("stream_alerts", f"""{_PSI_SQL} SELECT strftime(d, '%Y-%m-%d') AS day, n::BIGINT AS n, round(psi, 6) AS psi FROM psi
WHERE psi > 0.01 AND d + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""")
def stream_alerts(spark, sf_dir):
    """Closed days above a low threshold, each written once."""
    path, checkpoint = _paths(spark, "stream_alerts")
    reference = _reference(spark, sf_dir)
    streams.start_alerts(_stream(spark, sf_dir), reference, path, checkpoint, threshold=0.01).awaitTermination()
    found = spark.read.parquet(path)
    return found.select(streams.utc_day("window_start").alias("day"), "n", r6("psi").alias("psi"))


CARD = LinearScorecard(["value"], [0.01], -1.0, [0.0])


@query("stream_counters", """WITH p AS (SELECT 1::DOUBLE / (1::DOUBLE + exp(-(-1::DOUBLE + 0.01::DOUBLE * value))) AS p FROM events)
SELECT count(*) AS total, count(*) FILTER (WHERE p > 0.5) AS alerts, count(*) FILTER (WHERE NOT p > 0.5) AS approvals FROM p""")
def stream_counters(spark, sf_dir):
    path, checkpoint = _paths(spark, "stream_counters")
    streams.start_counters(CARD.score(_stream(spark, sf_dir)), "probability", path, checkpoint).awaitTermination()
    return streams.latest_counters(spark, path)


def _event_target(df):
    """Events with a target: errors and large values are bad."""
    return df.select("event_id", "event_type", "value", F.when((F.col("event_type") == "error") | (F.col("value") > 200), 1).otherwise(0).alias("y"))


_SCORES_SQL = sql_evidence(
    "e AS (SELECT event_id, event_type, value, CASE WHEN event_type = 'error' OR value > 200 THEN 1 ELSE 0 END AS y FROM events)", "e", ["value"], ["event_type"]
) + f""", coded AS (SELECT event_id, 1::DOUBLE / (1::DOUBLE + exp(-(-1::DOUBLE - 0.5::DOUBLE * (t.woe + v.woe)))) AS p
  FROM e JOIN evidence t ON t.feature = 'event_type' AND t.category = e.event_type
  JOIN (SELECT * FROM evidence WHERE feature = 'value') v ON {sql_in_bin('e.value', 'v')})
SELECT event_id, round(p, 6) AS probability, CASE WHEN p < 0.25 THEN 'A' WHEN p < 0.5 THEN 'B' WHEN p < 0.75 THEN 'C' ELSE 'D' END AS grade FROM coded"""


@query("stream_scores", _SCORES_SQL)
def stream_scores(spark, sf_dir):
    """Records of a stream through the scorer of the batch."""
    train = _event_target(table(spark, sf_dir, "events"))
    encoder = WoETransformer("y", iv_threshold=0.0, exclude_cols=("event_id",), cache_input=True).fit(train)
    names = encoder.get_selected_features()
    scorer = Scorer(encoder, LinearScorecard(names, [-0.5] * len(names), -1.0, [0.0] * len(names)))
    path, checkpoint = _paths(spark, "stream_scores")
    # The requests carry an applicant for the validity rules.
    requests = _stream(spark, sf_dir).select("event_id", "event_type", "value", F.lit(40).alias("age"), F.lit(1.0).alias("loan_amount"))
    streams.start_scoring(requests, scorer, path, checkpoint).awaitTermination()
    return spark.read.parquet(path).select("event_id", r6("probability").alias("probability"), "grade")


@query("stream_late_rows", """WITH late AS (SELECT * FROM events WHERE event_id % 7 = 0),
n AS (SELECT (SELECT count(value) FROM events) + (SELECT count(value) FROM events WHERE event_id = (SELECT max(event_id) FROM events)) AS in_time,
  (SELECT count(value) FROM late WHERE date_trunc('day', ts) + INTERVAL 1 DAY > (SELECT max(ts) FROM events) - INTERVAL 1 HOUR) AS still_open,
  (SELECT count(value) FROM late WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR) AS closed)
SELECT in_time + still_open + closed AS n_input, in_time + still_open AS n_counted, closed AS n_late FROM n""")
def stream_late_rows(spark, sf_dir):
    """Every seventh event arrives a second time behind all others: those of closed days are late, those of the last day aren't.

    A batch drops what is late by the time of the batch before its predecessor, so one event comes again in between.
    """
    events = table(spark, sf_dir, "events").select("event_id", "ts", "value")
    newest = events.agg(F.max("event_id")).first()[0]
    folder = scratch_path(spark, "late_events")
    for part in (events, events.where(F.col("event_id") == newest), events.where("event_id % 7 = 0")):
        part.coalesce(1).write.mode("append").parquet(folder)
    stream = streams.with_event_time(spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(folder))
    path, checkpoint = _paths(spark, "late_counts")
    reports = streams.InputReports(spark, f"late_{uuid.uuid4().hex}", scratch_path(spark, "late_reports"))
    spark.streams.addListener(reports)
    try:
        query = streams.start_window_counts(stream, _reference(spark, sf_dir), path, checkpoint, name=reports.name)
        query.awaitTermination()
        reports.wait(query)
    finally:
        spark.streams.removeListener(reports)
    return streams.late_rows(spark, path, reports.path)
