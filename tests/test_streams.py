"""Streams equal their batch form; late rows are dropped; repeated batches do not double."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from riskframe.session import scratch_path
from riskframe.streaming import streams as S

START = dt.datetime(2024, 1, 1)
SCHEMA = "ts timestamp, value double"


def write(spark, path, rows):
    spark.createDataFrame([(START + dt.timedelta(hours=h), float(v)) for h, v in rows], SCHEMA).coalesce(1).write.mode("append").parquet(path)


@pytest.fixture()
def source(spark):
    return scratch_path(spark, "source")


def reference(spark):
    return S.DriftReference.fit(spark.createDataFrame([(float(i),) for i in range(100)], "value double"), "value", 4)


def stream(spark, source):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)


def run(spark, source, starter, *args, name="out", **kwargs):
    path, checkpoint = kwargs.pop("path", None) or scratch_path(spark, name), kwargs.pop("checkpoint", None) or scratch_path(spark, "cp")
    starter(stream(spark, source), *args, path, checkpoint, **kwargs).awaitTermination()
    return path, checkpoint


def test_windows_equal_the_batch(spark, source):
    for day in range(4):
        write(spark, source, [(24 * day + h, (h * 7 + day * 13) % 100) for h in range(24)])
    ref = reference(spark)
    path, _ = run(spark, source, S.start_window_counts, ref)
    got = S.window_psi(S.latest_counts(spark, path), ref)
    want = S.window_psi(S.window_counts(spark.read.parquet(source), ref), ref)
    rows = lambda df: sorted((r["window_start"], r["n"], round(r["psi"], 9)) for r in df.collect())
    assert rows(got) == rows(want) and len(rows(got)) == 4


def test_sliding_windows(spark, source):
    write(spark, source, [(h, h % 100) for h in range(48)])
    ref = reference(spark)
    counts = S.window_counts(spark.read.parquet(source), ref, width="1 day", slide="12 hours")
    assert counts.agg(F.sum("n")).first()[0] == 96


def test_alerts_are_for_closed_windows_only_and_written_once(spark, source):
    for day in range(3):
        write(spark, source, [(24 * day + h, 1.0) for h in range(24)])
    ref = reference(spark)
    path, checkpoint = run(spark, source, S.start_alerts, ref)
    days = lambda: sorted(r["window_start"].day for r in spark.read.parquet(path).collect())
    assert days() == [1, 2]
    write(spark, source, [(24 * 5, 1.0)])
    run(spark, source, S.start_alerts, ref, path=path, checkpoint=checkpoint)
    assert days() == [1, 2, 3]


def test_late_rows_are_dropped(spark, source):
    write(spark, source, [(0, 1.0), (30, 1.0)])
    ref = reference(spark)
    path, checkpoint = run(spark, source, S.start_window_counts, ref)
    write(spark, source, [(100, 1.0)])
    run(spark, source, S.start_window_counts, ref, path=path, checkpoint=checkpoint)
    write(spark, source, [(1, 1.0)])  # its day closed long ago
    run(spark, source, S.start_window_counts, ref, path=path, checkpoint=checkpoint)
    first = [r["n"] for r in S.latest_counts(spark, path).orderBy("window_start").collect()]
    assert first == [1, 1, 1]


def test_counters(spark, source):
    for part in range(3):
        write(spark, source, [(part, v) for v in (0.2, 0.5, 0.9)])
    path, checkpoint = scratch_path(spark, "counters"), scratch_path(spark, "cp")
    S.start_counters(stream(spark, source), "value", path, checkpoint).awaitTermination()
    assert tuple(S.latest_counters(spark, path).first()) == (9, 3, 6)


def test_a_repeated_batch_replaces_itself(spark):
    path = scratch_path(spark, "sink")
    sink = S._write_batch(path)
    for _ in range(2):
        sink(spark.range(5), 7)
    assert spark.read.parquet(path).count() == 5


# --- merging ---------------------------------------------------------------------------------------


def files_read(df):
    return len(df.inputFiles())


def test_a_hundred_batches_are_read_from_a_few_files(spark):
    """Running counts of keys that come and go: always the last values, from no more files than two merges' worth."""
    path = scratch_path(spark, "state")
    write_batch = S._write_batch(path, keys=["k"], merge_every=10)
    want, seen = {}, []
    for batch in range(100):
        rows = [(k, 1000 * batch + k) for k in range(batch % 3, 12, 3)]
        want.update(rows)
        write_batch(spark.createDataFrame(rows, "k long, n long").coalesce(1), batch)
        if batch % 7 == 0 or batch == 99:
            now = S.last_values(spark, path, ["k"], "k long, n long")
            assert {r["k"]: r["n"] for r in now.collect()} == want
            seen.append(files_read(now))
    assert max(seen[3:]) <= 9 + 8 and max(seen[7:]) <= max(seen[3:7])
    assert len([n for n in S.files.names(spark, path) if n.startswith("batch_id=")]) <= 20
    assert len(S.files.names(spark, f"{path}/{S.MERGED}/pointers")) <= 2


def test_merging_again_changes_nothing(spark):
    """A batch that is repeated after its merge, as after a driver that died between the two."""
    path = scratch_path(spark, "state")
    write_batch = S._write_batch(path, keys=["k"], merge_every=3)
    for batch in range(6):
        write_batch(spark.createDataFrame([(batch % 2, batch)], "k long, n long"), batch)
    before = sorted(map(tuple, S.last_values(spark, path, ["k"], "k long, n long").collect()))
    write_batch(spark.createDataFrame([(1, 5)], "k long, n long"), 5)
    assert sorted(map(tuple, S.last_values(spark, path, ["k"], "k long, n long").collect())) == before == [(0, 4, 4), (1, 5, 5)]


def test_a_merge_that_died_before_its_pointer_is_not_read(spark, monkeypatch):
    path = scratch_path(spark, "state")
    write_batch = S._write_batch(path, keys=["k"], merge_every=2)
    write_batch(spark.createDataFrame([(1, 10)], "k long, n long"), 0)

    def dies(*_):
        raise SystemExit

    monkeypatch.setattr(S.files, "put_once", dies)
    with pytest.raises(SystemExit):
        write_batch(spark.createDataFrame([(1, 11)], "k long, n long"), 1)
    monkeypatch.undo()
    assert S.last_values(spark, path, ["k"], "k long, n long").first()["n"] == 11
    write_batch(spark.createDataFrame([(1, 12)], "k long, n long"), 1)
    assert [tuple(r) for r in S.last_values(spark, path, ["k"], "k long, n long").collect()] == [(1, 12, 1)]


def test_nothing_written_yet(spark):
    path = scratch_path(spark, "state")
    assert S.last_values(spark, path, ["k"], "k long, n long").count() == 0
    assert S.latest_counters(spark, path).count() == 0 and S.latest_counts(spark, path).count() == 0


# --- late rows -------------------------------------------------------------------------------------


def test_late_rows_are_counted(spark, source):
    """Three late rows among seven parts, over a restart of the stream."""
    ref = reference(spark)
    counts, checkpoint, reports = (scratch_path(spark, n) for n in ("counts", "cp", "reports"))

    def go(name):
        listener = S.InputReports(spark, name, reports, merge_every=2)
        spark.streams.addListener(listener)
        try:
            query = S.start_window_counts(stream(spark, source), ref, counts, checkpoint, name=name, merge_every=2)
            query.awaitTermination()
            listener.wait(query)
        finally:
            spark.streams.removeListener(listener)
        return tuple(S.late_rows(spark, counts, reports).first())

    for h in (0, 30, 100):
        write(spark, source, [(h, 1.0), (h + 1, 2.0)])
    assert go("first") == (6, 6, 0)
    write(spark, source, [(1, 1.0), (2, 5.0), (101, 3.0)])  # two of a closed day, one of the open one
    write(spark, source, [(31, 1.0)])
    assert go("second") == (10, 7, 3)


def test_late_rows_of_a_stream_that_has_not_run(spark):
    assert tuple(S.late_rows(spark, scratch_path(spark, "a"), scratch_path(spark, "b")).first()) == (0, 0, 0)
