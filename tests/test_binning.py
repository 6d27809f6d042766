"""The two binning rules, labels and edges."""

import math

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from riskframe.functions import binning
from riskframe.operators.woe import quantile_edges


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "v double").select(column("v").alias("r")).first()["r"]


@pytest.mark.parametrize("value, right, left", [(1.0, 0, 0), (2.0, 0, 1), (2.5, 1, 1), (4.0, 1, 1), (0.9, None, None), (4.1, None, None), (None, None, None)])
def test_edges_of_both_rules(spark, value, right, left):
    edges = [1.0, 2.0, 4.0]
    assert one(spark, value, lambda v: binning.right_closed_bin(v, edges)) == right
    assert one(spark, value, lambda v: binning.left_closed_bin(v, edges)) == left


def test_left_closed_counts_like_a_histogram(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 6)], "v double")
    bins = df.groupBy(binning.left_closed_bin("v", [-math.inf, 2.0, 4.0, math.inf]).alias("b")).count()
    assert {r["b"]: r["count"] for r in bins.collect()} == {0: 1, 1: 2, 2: 2}


def test_wide_cut_lists_agree_with_the_tree(spark):
    cuts = [float(i) for i in range(0, 500, 2)]
    df = spark.range(-3, 510).select((F.col("id") / 1.0).alias("v"))
    wide = binning.add_cut_index(binning.add_cut_index(df, "v", cuts, "r", True), "v", cuts, "l", False)
    for row in wide.collect():
        assert row["r"] == sum(c < row["v"] for c in cuts)
        assert row["l"] == sum(c <= row["v"] for c in cuts)


def test_duplicate_edges_collapse(spark):
    values = [0.0] * 80 + [float(i) for i in range(1, 21)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    edges = quantile_edges(df, ["v"], 10)["v"]
    assert edges == pytest.approx([0.0, 0.2, 10.1, 20.0])


def test_equal_width_edges():
    assert binning.equal_width_edges(0.0, 10.0, 5) == [-0.01, 2.0, 4.0, 6.0, 8.0, 10.0]
    with pytest.raises(ValueError):
        binning.equal_width_edges(0.0, math.inf, 5)


@pytest.mark.parametrize("iv, label", [(0.0, "Not Predictive"), (0.02, "Weak Predictor"), (0.1, "Medium Predictor"), (0.3, "Strong Predictor"), (0.5, "Suspicious / Over-predicting"), (math.nan, "Unknown")])
def test_iv_bands(spark, iv, label):
    assert one(spark, iv, lambda v: binning.interpret_iv(F.col(v))) == label


@pytest.mark.parametrize("value, label", [(0.0999, "No significant shift"), (0.1, "Moderate shift – investigate"), (0.25, "Major shift – action required"), (None, "Insufficient data"), (math.nan, "Insufficient data")])
def test_stability_labels(spark, value, label):
    assert one(spark, value, lambda v: binning.interpret_stability(F.col(v))) == label


@pytest.mark.parametrize("p, grade", [(0.0, "A"), (0.03, "B"), (0.07, "C"), (0.15, "D"), (0.999, "D"), (1.0, None), (-0.1, None)])
def test_pd_grades(spark, p, grade):
    assert one(spark, p, lambda v: binning.pd_grade(F.col(v))) == grade


@pytest.mark.parametrize("p, grade", [(0.2499, "A"), (0.25, "B"), (0.5, "C"), (0.75, "D")])
def test_score_grades(spark, p, grade):
    assert one(spark, p, lambda v: binning.score_grade(F.col(v))) == grade


@settings(max_examples=10, deadline=None)
@given(st.lists(st.floats(-1e6, 1e6), min_size=2, max_size=60))
def test_every_value_has_a_bin(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    edges = quantile_edges(df, ["v"], 4)["v"]
    if len(edges) > 1:
        assert df.where(binning.right_closed_bin("v", edges).isNull()).count() == 0
