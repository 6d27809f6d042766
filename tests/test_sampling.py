"""Splits, folds and oversampling."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.functions.hashing import uniform
from riskframe.operators import sampling as S


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(4)
    rows = [(i, float(a), float(b), int(i % 10 < 2)) for i, (a, b) in enumerate(rng.normal(0, 1, (503, 2)))]
    return spark.createDataFrame(rows, "key long, a double, b double, y int").cache()


def test_uniform_is_spread_and_stable(spark):
    df = spark.range(4000).select(uniform(42, "id").alias("u"))
    row = df.agg(F.min("u"), F.max("u"), F.avg("u"), F.countDistinct("u")).first()
    assert 0 <= row[0] < 0.01 and 0.99 < row[1] < 1 and abs(row[2] - 0.5) < 0.02 and row[3] == 4000


def test_split_sizes_and_shares(labelled):
    train, test = S.stratified_split(labelled, "y", ["key"])
    assert test.count() == math.ceil(0.3 * 503) and train.count() + test.count() == 503
    # 401 and 102 rows: of 352 training rows 280.6 and 71.4 are due, the larger remainder gets the last one.
    assert {r["y"]: r["count"] for r in test.groupBy("y").count().collect()} == {0: 401 - 281, 1: 102 - 71}
    assert train.join(test, "key").count() == 0


def test_split_ignores_partitioning(labelled):
    one = {r["key"] for r in S.stratified_split(labelled, "y", ["key"])[1].collect()}
    two = {r["key"] for r in S.stratified_split(labelled.repartition(7, "a"), "y", ["key"])[1].collect()}
    assert one == two


def test_equal_hashes_are_cut_by_key(spark):
    df = spark.createDataFrame([(i, i % 2) for i in range(40)], "key long, y int")
    flagged = S._first_rows(df, "y", F.lit(0.5), F.lpad(F.col("key").cast("string"), 3, "0"), [{0: 7, 1: 3}], ["first"], {0: 20, 1: 20})
    assert {r["key"] for r in flagged.where("first").collect()} == {0, 2, 4, 6, 8, 10, 12, 1, 3, 5}


def test_allocation_gives_leftovers_to_large_remainders():
    assert S.allocate({"a": 5, "b": 3, "c": 2}, 7) == {"a": 4, "b": 2, "c": 1}
    assert sum(S.allocate({0: 341, 1: 58}, 279).values()) == 279


def test_folds_are_balanced(labelled):
    sizes = S.assign_folds(labelled, "y", ["key"], 3).groupBy("y", "fold").count().collect()
    for y in (0, 1):
        counts = [r["count"] for r in sizes if r["y"] == y]
        assert len(counts) == 3 and max(counts) - min(counts) <= 1


def test_sample_has_its_size(labelled):
    assert S.hash_sample(labelled, 50, ["key"]).count() == 50
    assert S.hash_sample(labelled, 50, ["key"]).collect() == S.hash_sample(labelled.repartition(5), 50, ["key"]).collect()


def test_parameter_draw():
    grid = {"a": [1, 2, 3], "b": [1, 2]}
    drawn = S.draw_parameters(grid, 4)
    assert len(drawn) == 4 and len({tuple(d.items()) for d in drawn}) == 4 and drawn == S.draw_parameters(grid, 4)
    assert len(S.draw_parameters(grid, 100)) == 6


@pytest.mark.parametrize("strategy, want", [("auto", 401), (0.5, 102 + int(401 * 0.5 - 102))])
def test_smote_reaches_the_target(labelled, strategy, want):
    out = S.SmoteResampler("y", strategy, key=["key"]).fit_resample_combined(labelled)
    assert out.columns == ["key", "a", "b", "y"]
    assert {r["y"]: r["count"] for r in out.groupBy("y").count().collect()} == {0: 401, 1: want}


def test_new_points_lie_between_a_row_and_one_of_its_neighbours(labelled):
    out = S.SmoteResampler("y", key=["key"], tag="origin").fit_resample_combined(labelled).toPandas()
    base = out[(out.origin == "original") & (out.y == 1)].sort_values("key")[["a", "b"]].to_numpy()
    for r in out[out.origin == "synthetic"].itertuples():
        start = base[int(r.base_idx)]
        d = np.sqrt(((base - start) ** 2).sum(axis=1))
        near = [j for j in np.lexsort((np.arange(len(base)), d)) if j != int(r.base_idx)][:5]
        point = np.array([r.a, r.b])

        def off(j):
            line = base[j] - start
            s = np.dot(point - start, line) / np.dot(line, line)
            return np.abs(point - (start + s * line)).max() if -1e-9 <= s < 1 else 1.0

        assert min(off(j) for j in near) < 1e-9


def test_copies_of_one_row_are_no_hot_spot(spark):
    rows = [(i, 1.0, 2.0, 1) for i in range(300)] + [(300 + i, float(i), 0.0, 1) for i in range(10)] + [(1000 + i, 0.0, 0.0, 0) for i in range(400)]
    df = spark.createDataFrame(rows, "key long, a double, b double, y int")
    out = S.SmoteResampler("y", key=["key"], tag="origin").fit_resample_combined(df)
    assert out.where("origin = 'synthetic'").count() == 90
    # A copy's nearest rows are its copies: the new row is one more of them.
    new = out.where("origin = 'synthetic' and base_idx < 300").select("a", "b").distinct().collect()
    assert [tuple(r) for r in new] == [(1.0, 2.0)]


def test_integer_features_stay_integers(spark):
    df = spark.createDataFrame([(i, i * 3, int(i < 8)) for i in range(40)], "key long, n int, y int")
    out = S.SmoteResampler("y", key=["key"]).fit_resample_combined(df)
    assert out.schema["n"].dataType.simpleString() == "int" and out.count() == 64


def test_smote_guards(spark, labelled):
    smote = S.SmoteResampler("y", key=["key"])
    with pytest.raises(KeyError):
        S.SmoteResampler("nope", key=["key"]).fit_resample_combined(labelled)
    with pytest.raises(ValueError, match="too few"):
        smote.fit_resample_combined(labelled.where("y = 0 or key < 12"))
    with pytest.raises(ValueError, match="missing"):
        smote.fit_resample_combined(labelled.withColumn("a", F.when(F.col("key") > 3, F.col("a"))))
    with pytest.raises(ValueError, match="numeric"):
        smote.fit_resample_combined(labelled.withColumn("a", F.lit("x")))
    with pytest.raises(ValueError, match="below"):
        S.SmoteResampler("y", 0.01, key=["key"]).fit_resample_combined(labelled)
    with pytest.raises(ValueError, match="two classes"):
        smote.fit_resample_combined(labelled.where("y = 0"))


def test_folds_of_a_training_part_look_at_few_rows(spark, monkeypatch):
    """A training part lacks the smallest hashes, so its cuts don't lie at their shares; only the bins that hold them are read."""
    train, _ = S.stratified_split(spark.range(20_000).select(F.col("id").alias("key"), (F.col("id") % 4 % 2).alias("y")), "y", ["key"])
    looked, exact = [], S._exact_tests
    monkeypatch.setattr(S, "_exact_tests", lambda df, *rest: (looked.append(df.count()), exact(df, *rest))[1])
    folded = S.assign_folds(train, "y", ["key"], 3)
    assert looked and sum(looked) < 100
    got = folded.toPandas().merge(train.withColumn("u", S.uniform(42, "key")).toPandas())
    for _, part in got.groupby("y"):
        folds = part.sort_values("u").fold.to_numpy()
        assert (np.diff(folds) >= 0).all() and np.ptp(np.bincount(folds)) <= 1
