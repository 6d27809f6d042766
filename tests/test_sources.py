"""CSV, JSON, metrics and the shared folder."""

import pytest
from pyspark.sql import functions as F

from riskframe import session
from riskframe.sources import tables


def test_csv_null_tokens(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("id,company,note,x\n1,N/A,N/A,1.5\n2,A,null,NaN\n3,,ok,\n")
    df = tables.read_csv(spark, str(path), "id int, company string, note string, x double", keep_tokens={"company": ["N/A"]})
    assert [tuple(r) for r in df.orderBy("id").collect()] == [(1, "N/A", None, 1.5), (2, "A", None, None), (3, None, "ok", None)]
    inferred = tables.read_csv(spark, str(path))
    assert inferred.where("company is null").count() == 2


def test_records(spark, tmp_path):
    path = tmp_path / "r.json"
    path.write_text('{"age": 40, "extra": 1}\n{"loan_amount": 5.5}\n')
    df = tables.read_records(spark, str(path), "age int, loan_amount double")
    assert {tuple(r) for r in df.collect()} == {(40, None), (None, 5.5)}


def test_broken_records_keep_their_row(spark):
    df = spark.createDataFrame([(1, '{"a": 1}'), (2, '{"a": '), (3, None)], "id int, r string")
    rows = {r["id"]: r for r in tables.parse_records(df, "r", "a int, b string").collect()}
    assert rows[1]["a"] == 1 and rows[1]["errors"] is None
    assert rows[2]["a"] is None and rows[2]["errors"] == '{"a": '
    assert rows[3]["errors"] is None


def test_metrics_append(spark, tmp_path):
    path = str(tmp_path / "metrics")
    for run in ("a", "b"):
        tables.append_metrics(tables.metric_rows(spark, run, {"AUC": 0.7, "none": None}, {"depth": 3}), path)
    assert tables.read_metrics(spark, path).count() == 6


def test_snapshot(spark, tmp_path):
    path = str(tmp_path / "snap")
    tables.snapshot_features(spark.createDataFrame([(1, 0)], "x int, y int"), "y", path)
    assert spark.read.parquet(path).columns == ["x"]


def test_decision_json(spark):
    row = spark.range(1).select(tables.decision_json(status=F.lit("success"), auc_score=F.round(F.lit(0.123456), 4), model_registered=F.lit(False)).alias("j")).first()
    assert row["j"] == '{"status":"success","auc_score":0.1235,"model_registered":false}'


class FakeSession:
    def __init__(self, master, folder=None):
        self.settings = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = type("C", (), {"master": master})()
        self.conf = self

    def get(self, key, default=None):
        return self.settings.get(key, default)

    def set(self, key, value):
        self.settings[key] = value


def test_checkpoints_go_to_the_folder_of_the_cluster():
    assert session.checkpoint_root(FakeSession("yarn", "hdfs://shared/x")) == "hdfs://shared/x"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(FakeSession("yarn"))
    local = FakeSession("local[2]")
    assert session.checkpoint_root(local) == session.checkpoint_root(local)


def test_scratch_is_cleared(spark, tmp_path, monkeypatch):
    from riskframe.sources import files

    monkeypatch.setattr(session, "checkpoint_root", lambda _: str(tmp_path / "shared"))
    path = session.scratch_path(spark, "table")
    spark.range(3).write.parquet(path)
    assert spark.read.parquet(path).count() == 3 and files.exists(spark, path)
    session.clear_scratch(spark)
    assert not files.exists(spark, path) and files.exists(spark, str(tmp_path / "shared"))
