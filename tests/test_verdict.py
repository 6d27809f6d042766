"""Ordinary input that once crashed or gave wrong rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.operators.drift import DriftMonitor
from riskframe.operators.lookup import lookup
from riskframe.operators import models, profile, sampling
from riskframe.operators.profile import class_distribution, density_grid, quality_report
from riskframe.operators.sampling import SmoteResampler
from riskframe.operators.scorecard import LinearScorecard
from riskframe.operators.scoring import Scorer
from riskframe.operators.woe import WoETransformer


@pytest.mark.parametrize("values", [[3.0, 3.0], [3.0, None], [None, None]])
def test_bin_detail_of_a_constant_reference_is_empty(spark, values):
    table = lambda v: spark.createDataFrame([(x,) for x in v], "x double")
    detail = DriftMonitor().psi_bin_detail(table(values), table([1.0, 2.0]), "x")
    assert detail.count() == 0 and "psi_component" in detail.columns


def test_quality_of_many_columns_with_a_constant_one(spark):
    names = [f"n{i}" for i in range(12)]
    rows = spark.range(300).select(
        *[F.rand(i).alias(c) for i, c in enumerate(names)], F.lit(5.0).alias("fixed"), *[(F.col("id") % (k + 2)).cast("string").alias(f"t{k}") for k in range(4)]
    )
    scores = {(r.kind, r.name): r.score for r in quality_report(rows, rows).collect()}
    assert len(scores) == 17 + 17 * 16 // 2
    assert all(s is None if "fixed" in n and "|n" in n or n.endswith("|fixed") else s == pytest.approx(1.0) for (k, n), s in scores.items() if k == "pair_trend" and "t" not in n.replace("fixed", ""))
    assert quality_report(rows.select("n0"), rows.select("n1")).count() == 0


def test_a_null_key_meets_no_table_key(spark):
    table = spark.createDataFrame([(f"\u0000{i}", 1) for i in range(4096)], "key string, v int")
    rows = spark.createDataFrame([(i, None) for i in range(50)], "id long, k string")
    got = lookup(rows, table, F.col("k"), ["v"], broadcast_rows=10).collect()
    assert len(got) == 50 and all(r.v is None for r in got)


def test_no_feature_left_is_named(spark):
    table = spark.createDataFrame([(1, 0), (2, 1)], "id long, y int")
    with pytest.raises(ValueError, match="feature"):
        WoETransformer("y", exclude_cols=("id",)).fit(table)


def test_class_distribution(spark):
    table = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "label string")
    assert [tuple(r) for r in class_distribution(table, "label").collect()] == [(None, 1, 25.0), ("a", 2, 50.0), ("b", 1, 25.0)]
    assert class_distribution(table.limit(0), "label").count() == 0


def test_densities_of_many_groups_and_a_hot_one(spark, monkeypatch):
    monkeypatch.setattr(profile, "DENSITY_ROWS", 100)
    table = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("g"), F.col("id") % 1501)).alias("g"),
        F.when(F.col("id") > 5, F.sqrt("id")).alias("v"),
    )
    grid = density_grid(table, "v", "g", 5).cache()
    assert grid.count() == 1502 * 5 and density_grid(table.limit(0), "v", "g").count() == 0
    values = np.array([r.v for r in table.where("g = 'hot' and v is not null").collect()])
    n = table.where("v is not null").count()
    width = values.std(ddof=1) * len(values) ** -0.2
    for r in grid.where("g = 'hot'").collect():
        assert r.x == pytest.approx(values.min() + r.grid_id * (values.max() - values.min()) / 4)
        want = np.exp(-0.5 * ((r.x - values) / width) ** 2).sum() / (n * width * np.sqrt(2 * np.pi))
        assert r.density == pytest.approx(want)


def test_smote_refuses_a_key_of_several_rows(spark):
    rows = spark.createDataFrame([(7, float(i), int(i < 20)) for i in range(60)], "key long, a double, y int")
    with pytest.raises(ValueError, match="several rows"):
        SmoteResampler("y", key=["key"]).fit_resample_combined(rows)


def test_a_key_is_no_class_label(spark, monkeypatch):
    monkeypatch.setattr(sampling, "MAX_CLASSES", 20)
    assert len(sampling.class_counts(spark.range(20), "id")) == 20
    with pytest.raises(ValueError, match="class label"):
        sampling.class_counts(spark.range(21), "id")


@pytest.mark.parametrize("linear", [True, False])
def test_a_scorer_comes_back_from_its_files(spark, tmp_path, linear):
    rows = spark.createDataFrame([(float(i % 50), float(i % 7), int(i % 50 + i % 3 > 25)) for i in range(400)], "age double, income double, y int")
    encoder = WoETransformer("y").fit(rows)
    names = encoder.get_selected_features()
    model = LinearScorecard(names, [-1.0] * len(names), 0.1, [0.0] * len(names))
    if not linear:
        model = models.train_gbt(encoder.transform(rows, keep_target=True), names, "y", {"maxIter": 2, "maxDepth": 2})
    scorer = Scorer(encoder, model, {"age": 40.0, "income": 5.0})
    scorer.save(spark, str(tmp_path))
    again = Scorer.load(spark, str(tmp_path))
    assert again.defaults == scorer.defaults
    key = lambda df: sorted((r.age, r.income, r.probability, r.grade, str(r.shap_values)) for r in df.collect())
    assert key(again.score(rows)) == key(scorer.score(rows))
