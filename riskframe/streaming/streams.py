"""The batch operators on streams: scoring, windowed drift, alerts and running counters.

Drift is counted in the stream and divided afterwards: per window and bin a running count, whose state
is a few rows per open window. Sinks write one folder per micro-batch, so a repeated batch overwrites
its own output. Sinks of running values are merged every ``MERGE_EVERY`` batches into one table of the last values, and a
pointer names it: readers read that table and the few folders behind it, however long the stream has run.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from riskframe.functions.binning import left_closed_bin, quoted
from riskframe.operators.drift import RETRAIN_ABOVE, WHOLE, drift_edges
from riskframe.operators.orderstats import as_value
from riskframe.operators.profile import alert_counters
from riskframe.sources import files

# Batches whose running values are merged into one table.
MERGE_EVERY = 20
MERGED = "_merged"  # readers of the whole folder skip names with an underscore in front
WINDOW_KEYS = ("window_start", "window_end", "bin_id")
WINDOW_COUNTS = "window_start timestamp, window_end timestamp, bin_id int, n long"
COUNTERS = "total long, alerts long, approvals long"
# The observed number of rows that enter windows.
INPUT_ROWS = "input_rows"
INPUT_TOTALS = "rows long"


def with_event_time(df: DataFrame, column: str = "ts") -> DataFrame:
    """Watermarks need an instant; a stored local time is read as UTC, whatever the session's zone."""
    if not isinstance(df.schema[column].dataType, T.TimestampNTZType):
        return df.withColumn(column, F.col(column).cast("timestamp"))
    name = quoted(column)
    micros = (
        f"unix_date(CAST({name} AS DATE)) * 86400000000L + (hour({name}) * 3600L + minute({name}) * 60L) * 1000000L"
        f" + CAST(extract(SECOND FROM {name}) * 1000000 AS BIGINT)"
    )
    return df.withColumn(column, F.expr(f"timestamp_micros({micros})"))


def utc_day(instant: str) -> Column:
    """The UTC calendar day of an instant, as text."""
    return F.date_add(F.lit("1970-01-01").cast("date"), F.floor(F.unix_seconds(instant) / 86400).cast("int")).cast("string")


@dataclass
class DriftReference:
    """Edges and bin shares of the reference population of one column."""

    column: str
    edges: list[float]
    shares: list[float]
    epsilon: float = 0.0001

    @classmethod
    def fit(cls, df: DataFrame, column: str, bins: int = 10, epsilon: float = 0.0001) -> "DriftReference":
        edges = drift_edges(df, [column], bins)[column]
        named = df.select(as_value(column).alias(column))
        counted = named.groupBy(left_closed_bin(column, edges).alias("b")).count().where("b is not null").collect()
        counts = {r["b"]: r["count"] for r in counted}
        total = sum(counts.values())
        if not total:
            raise ValueError(f"the reference population of '{column}' is empty or constant")
        return cls(column, edges, [counts.get(b, 0) / total for b in range(len(edges) - 1)], epsilon)

    @classmethod
    def of_table(cls, reference: DataFrame, column: str, portfolio: str = WHOLE, epsilon: float = 0.0001) -> "DriftReference":
        """One column of a kept reference (``drift.fit_reference``), such as a model version's."""
        rows = reference.where((F.col("feature") == column) & (F.col("portfolio") == portfolio)).orderBy("bin_id").collect()  # at most `bins`
        if not rows:
            raise ValueError(f"the reference has no bins of '{column}' in portfolio '{portfolio}'")
        return cls(column, [*(r["lo"] for r in rows), rows[-1]["hi"]], [r["share"] for r in rows], epsilon)

    def with_bin(self, df: DataFrame) -> DataFrame:
        return df.withColumn("__value", as_value(self.column)).withColumn("bin_id", left_closed_bin("__value", self.edges))

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(b, s) for b, s in enumerate(self.shares)], "bin_id int, ref_share double")


def window_counts(
    stream: DataFrame, reference: DriftReference, ts: str = "ts", width: str = "1 day", slide: str | None = None, delay: str = "1 hour"
) -> DataFrame:
    """``(window_start, window_end, bin_id, n)``; works on a stream and on a table. A stream also observes how many rows
    enter windows, as ``INPUT_ROWS``; a row in several windows counts in each."""
    timed = stream.withWatermark(ts, delay) if stream.isStreaming else stream
    entered = reference.with_bin(timed).where(F.col("bin_id").isNotNull()).withColumn("window", F.window(ts, width, slide))
    if stream.isStreaming:
        entered = entered.observe(INPUT_ROWS, F.count(F.lit(1)).alias("rows"))
    counted = entered.groupBy("window", "bin_id").agg(F.count("*").alias("n"))
    return counted.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "bin_id", "n")


def window_psi(counts: DataFrame, reference: DriftReference) -> DataFrame:
    """``(window_start, window_end, n, psi)`` from counts per window and bin.

    Bins a window never filled count too: each window carries the list of its shares, completed with
    the bins that are missing from it.
    """
    bins = len(reference.shares)
    filled = F.map_from_entries(F.collect_list(F.struct("bin_id", "n")))  # at most one entry per bin
    per_window = counts.groupBy("window_start", "window_end").agg(F.sum("n").alias("n"), filled.alias("m"))
    eps = F.lit(float(reference.epsilon))
    total = F.lit(0.0)
    for b in range(bins):
        r = reference.shares[b] or reference.epsilon
        share = F.coalesce(F.col("m")[F.lit(b)], F.lit(0)) / F.col("n")
        cur = F.when(share == 0, eps).otherwise(share)
        total = total + (cur - F.lit(float(r))) * F.ln(cur / F.lit(float(r)))
    return per_window.select("window_start", "window_end", "n", total.alias("psi"))


# --- sinks -----------------------------------------------------------------------------------------


def _folder(path: str, batch_id: int) -> str:
    return f"{path}/batch_id={batch_id}"


def _pointers(spark: SparkSession, path: str) -> list[int]:
    """Batches up to which there is a merged table, in order."""
    return [int(n.removesuffix(".json")) for n in files.names(spark, f"{path}/{MERGED}/pointers") if n.endswith(".json")]


def last_values(spark: SparkSession, path: str, keys: Sequence[str], schema: str | T.StructType) -> DataFrame:
    """The last written row of every key: of the newest merged table and of the folders behind it.

    ``schema`` is that of the written rows. A stream that has written nothing gives no row.
    """
    fields = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    stamped = T.StructType([*fields.fields, T.StructField("batch_id", T.LongType())])
    upto = max(_pointers(spark, path), default=-1)
    batches = sorted(int(n.split("=")[1]) for n in files.names(spark, path) if n.startswith("batch_id="))
    behind = [b for b in batches if b > upto]
    found = spark.read.schema(stamped).parquet(f"{path}/{MERGED}/upto={upto}") if upto >= 0 else spark.createDataFrame([], stamped)
    if behind:
        found = found.unionByName(spark.read.schema(stamped).option("basePath", path).parquet(*[_folder(path, b) for b in behind]))
    return _latest(found, keys, fields.names)


def _latest(rows: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    values = [c for c in names if c not in keys]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*values, "batch_id"), "batch_id").alias("v"))
    return last.where("v is not null").select(*keys, "v.*")


def merge_batches(spark: SparkSession, path: str, keys: Sequence[str], schema: T.StructType, batch_id: int) -> None:
    """Write the last values up to ``batch_id`` as one table, point to it, and drop what the pointer before covered.

    Doing it again gives the same: the table is written over and the pointer stays. What the last pointer before this one
    needs stays too, for readers that have just looked at it.
    """
    before = [p for p in _pointers(spark, path) if p < batch_id]
    merged = last_values(spark, path, keys, schema)
    if batch_id not in _pointers(spark, path):
        merged.write.mode("overwrite").parquet(f"{path}/{MERGED}/upto={batch_id}")
        files.put_once(spark, f"{path}/{MERGED}/pointers/{batch_id:012d}.json", "{}")
    for old in before[:-1]:
        files.delete(spark, f"{path}/{MERGED}/upto={old}")
        files.delete(spark, f"{path}/{MERGED}/pointers/{old:012d}.json")
    if before:
        for name in files.names(spark, path):
            if name.startswith("batch_id=") and int(name.split("=")[1]) <= before[-1]:
                files.delete(spark, f"{path}/{name}")


def _write_batch(path: str, transform=None, keys: Sequence[str] | None = None, merge_every: int = MERGE_EVERY):
    def write(batch: DataFrame, batch_id: int) -> None:
        frame = batch if transform is None else transform(batch)
        frame.write.mode("overwrite").parquet(_folder(path, batch_id))
        if keys is not None and (batch_id + 1) % merge_every == 0:
            merge_batches(batch.sparkSession, path, keys, frame.schema, batch_id)

    return write


def start(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    output_mode: str = "append",
    transform=None,
    available_now: bool = True,
    interval: str = "1 minute",
    keys: Sequence[str] | None = None,
    merge_every: int = MERGE_EVERY,
    name: str | None = None,
) -> StreamingQuery:
    """Write every micro-batch below ``path``; a repeated batch replaces its own folder.

    With ``keys`` the rows are running values, and folders are merged; read them with :func:`last_values`.
    """
    writer = stream.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    writer = writer.foreachBatch(_write_batch(path, transform, keys, merge_every))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return (writer.queryName(name) if name else writer).start()


def start_scoring(stream: DataFrame, scorer, path: str, checkpoint: str, **options) -> StreamingQuery:
    """Stateless scoring with the transform of the batch."""
    return start(scorer.score(stream), path, checkpoint, "append", **options)


def start_window_counts(stream: DataFrame, reference: DriftReference, path: str, checkpoint: str, ts: str = "ts", width: str = "1 day", slide: str | None = None, delay: str = "1 hour", **options) -> StreamingQuery:
    """Counts of windows that changed, open ones included; read them with :func:`latest_counts`."""
    return start(window_counts(stream, reference, ts, width, slide, delay), path, checkpoint, "update", keys=WINDOW_KEYS, **options)


def latest_counts(spark: SparkSession, path: str) -> DataFrame:
    """The last written count of every window and bin."""
    return last_values(spark, path, WINDOW_KEYS, WINDOW_COUNTS).drop("batch_id")


def start_alerts(stream: DataFrame, reference: DriftReference, path: str, checkpoint: str, ts: str = "ts", width: str = "1 day", slide: str | None = None, delay: str = "1 hour", threshold: float = RETRAIN_ABOVE, **options) -> StreamingQuery:
    """Closed windows whose index is above the threshold, each written once.

    All bins of a window close together, so a micro-batch holds whole windows.
    """

    def alerts(batch: DataFrame) -> DataFrame:
        return window_psi(batch, reference).where(F.col("psi") > F.lit(threshold))

    return start(window_counts(stream, reference, ts, width, slide, delay), path, checkpoint, "append", alerts, **options)


def start_counters(scored: DataFrame, probability: str, path: str, checkpoint: str, **options) -> StreamingQuery:
    """Running totals, alerts and approvals; the last batch holds the current values."""
    return start(alert_counters(scored, probability), path, checkpoint, "update", keys=(), **options)


def latest_counters(spark: SparkSession, path: str) -> DataFrame:
    return last_values(spark, path, (), COUNTERS).drop("batch_id")


# --- late rows -------------------------------------------------------------------------------------


class InputReports(StreamingQueryListener):
    """Writes how many rows entered windows, per batch of the streams by one name, as running totals below ``path``.

    Add it with ``spark.streams.addListener`` before the stream starts. Reports come a moment after their batch, see
    :meth:`wait`; the report of a batch whose driver died in that moment is lost, and then too few late rows are counted.
    """

    def __init__(self, spark: SparkSession, name: str, path: str, merge_every: int = MERGE_EVERY):
        self.spark, self.name, self.path, self.merge_every = spark, name, path, merge_every
        row = self._last()
        self.total, self.batch = (row["rows"], row["batch_id"]) if row else (0, -1)

    def _last(self):
        return last_values(self.spark, self.path, (), INPUT_TOTALS).first()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        seen = progress.observedMetrics.get(INPUT_ROWS)
        if progress.name != self.name or seen is None or progress.batchId <= self.batch:
            return
        self.total += seen["rows"]
        row = self.spark.createDataFrame([(self.total,)], INPUT_TOTALS)
        row.coalesce(1).write.mode("overwrite").parquet(_folder(self.path, progress.batchId))
        if (progress.batchId + 1) % self.merge_every == 0:
            merge_batches(self.spark, self.path, (), row.schema, progress.batchId)
        self.batch = progress.batchId

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def wait(self, query: StreamingQuery, seconds: float = 60.0) -> None:
        """Until the last batch of a stream that has ended is reported."""
        last = max((p["batchId"] for p in query.recentProgress if INPUT_ROWS in (p["observedMetrics"] or {})), default=-1)
        until = time.monotonic() + seconds
        while self.batch < last:
            if time.monotonic() > until:
                raise TimeoutError(f"batch {last} of '{self.name}' was not reported")
            time.sleep(0.05)


def late_rows(spark: SparkSession, counts_path: str, reports_path: str) -> DataFrame:
    """``(n_input, n_counted, n_late)``: rows that came when their window had closed were left out of its count, so they
    are the difference. Exact between two batches, when no batch is under way."""
    seen = last_values(spark, reports_path, (), INPUT_TOTALS).select(F.col("rows").alias("n_input"))
    counted = latest_counts(spark, counts_path).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_counted"))
    both = [r[0] for r in (*seen.collect(), *counted.collect())]  # one number each
    n_input, n_counted = both if len(both) == 2 else (0, both[0])
    return spark.createDataFrame([(n_input, n_counted, n_input - n_counted)], "n_input long, n_counted long, n_late long")
