"""Exact order statistics: bucketed forms equal the simple ones whatever the bucket size."""

import numpy as np
import pytest
from pyspark.sql import Window, functions as F

from riskframe.operators import orderstats as O


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(5)
    values = np.concatenate([np.full(700, 3.5), rng.normal(0, 10, 900).round(3), rng.exponential(50, 400)])
    labels = (rng.random(2000) < 0.3).astype(int)
    rows = [(i, float(v), int(y)) for i, (v, y) in enumerate(zip(values, labels))]
    return spark.createDataFrame(rows + [(2000, None, 1), (2001, float("nan"), 0)], "id long, v double, y int").cache()


def values_of(df):
    return np.array([r["v"] for r in df.where("v is not null and not isnan(v)").select("v").collect()])


@pytest.mark.parametrize("distinct_per_task, buckets", [(10**6, 64), (50, 8), (5, 4)])
def test_quantiles_are_exact(skewed, distinct_per_task, buckets):
    shares = [0.0, 0.01, 0.25, 0.333, 0.5, 0.9, 1.0]
    found = O.linear_quantiles(skewed, [O.as_value("v")], shares, distinct_per_task=distinct_per_task, buckets=buckets)[0]
    assert found == pytest.approx(list(np.percentile(values_of(skewed), [s * 100 for s in shares])), abs=0, rel=1e-15)


@pytest.mark.parametrize("rows_per_bucket", [10**6, 100, 7])
def test_running_counts_equal_the_plain_window(skewed, rows_per_bucket):
    running, totals = O.running_counts(skewed, [O.as_value("v")], {"n": F.lit(1), "pos": F.col("y")}, rows_per_bucket)
    got = {r["value"]: (r["n"], r["pos"], r["upto_n"], r["upto_pos"]) for r in running.collect()}
    plain = skewed.where("v is not null and not isnan(v)").groupBy("v").agg(F.count("*").alias("n"), F.sum("y").alias("pos"))
    w = Window.orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    want = {r["v"]: (r["n"], r["pos"], r["a"], r["b"]) for r in plain.select("*", F.sum("n").over(w).alias("a"), F.sum("pos").over(w).alias("b")).collect()}
    assert got == want
    assert totals[0]["n"] == 2000


def test_bucketed_metrics_equal_single_bucket_metrics(spark, skewed):
    other = skewed.withColumn("v", F.col("v") + 1)
    for size in (20, 10**6):
        ks = O.inverted_ks(skewed, other, ["v"], rows_per_bucket=size).first()["ks"]
        a, b = np.sort(values_of(skewed)), np.sort(values_of(other))
        grid = np.concatenate([a, b])
        want = np.abs(np.searchsorted(a, grid, "right") / len(a) - np.searchsorted(b, grid, "right") / len(b)).max()
        assert ks == pytest.approx(want, abs=1e-12)


def test_auc_with_ties(spark):
    df = spark.createDataFrame([(0.1, 0), (0.4, 0), (0.4, 1), (0.8, 1), (0.8, 0), (0.9, 1)], "s double, y int")
    pairs = [(p, n) for p in (0.4, 0.8, 0.9) for n in (0.1, 0.4, 0.8)]
    want = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in pairs) / len(pairs)
    for size in (1, 10**6):
        assert O.auc(df, "y", "s", rows_per_bucket=size).first()["auc"] == pytest.approx(want)


def test_auc_of_one_class_is_missing(spark):
    df = spark.createDataFrame([(0.1, 1), (0.4, 1)], "s double, y int")
    assert O.auc(df, "y", "s").first()["auc"] is None


def test_roc_ends(spark, skewed):
    points = O.roc_points(skewed, "y", "v").orderBy("fp", "tp").collect()
    assert (points[0]["fpr"], points[0]["tpr"]) == (0.0, 0.0)
    assert (points[-1]["fpr"], points[-1]["tpr"]) == (1.0, 1.0)


def test_ks_properties(spark, skewed):
    same = O.inverted_ks(skewed, skewed, ["v"]).first()
    assert same["ks"] == 0.0 and same["inverted_ks"] == 1.0
    apart = skewed.withColumn("v", F.col("v") + 1e6)
    assert O.inverted_ks(skewed, apart, ["v"]).first()["ks"] == 1.0


def test_no_shared_column_gives_zero(spark, skewed):
    other = spark.createDataFrame([(1.0,)], "w double")
    row = O.mean_inverted_ks(skewed.select("v"), other).first()
    assert (row["inverted_ks"], row["n_columns"]) == (0.0, 0)


@pytest.mark.parametrize("rows_per_bucket", [10**6, 50])
def test_dense_index(skewed, rows_per_bucket):
    got = sorted((r["idx"], r["id"]) for r in O.dense_index(skewed, ["id"], "idx", rows_per_bucket).collect())
    assert got == [(i, i) for i in range(2002)]


def test_dense_index_of_text(spark):
    words = spark.range(500).select(F.concat(F.lit("w"), F.col("id")).alias("k"))
    got = [r["k"] for r in O.dense_index(words, ["k"], "idx", 40).orderBy("idx").collect()]
    assert got == sorted(got) and len(got) == 500


@pytest.mark.parametrize("rows_per_bucket", [10**6, 50])
def test_group_quantiles(spark, skewed, rows_per_bucket):
    data = skewed.where("v is not null and not isnan(v)").withColumn("g", F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.concat(F.lit("g"), F.col("id") % 7)))
    got = {r["g"]: r for r in O.group_quantiles(data, "v", "g", {"q1": 0.25, "m": 0.5, "top": 1.0}, rows_per_bucket).collect()}
    pdf = data.toPandas()
    assert set(got) == set(pdf.g)
    for g, part in pdf.groupby("g"):
        want = np.percentile(part.v, [25, 50, 100])
        assert got[g]["n"] == len(part)
        assert [got[g]["q1"], got[g]["m"], got[g]["top"]] == pytest.approx(list(want), rel=1e-12)
