"""Scoring, attribution and model helpers."""

import itertools
import math

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from riskframe.operators import models as M, profile as P, scoring as S
from riskframe.operators.rows import REASONS
from riskframe.operators.scorecard import LinearScorecard, sort_attributions
from riskframe.operators.woe import WoETransformer
from riskframe.session import scratch_path


@pytest.fixture(scope="module")
def training(spark):
    rng = np.random.default_rng(8)
    rows = []
    for i in range(1200):
        age, income, kind = float(rng.integers(20, 70)), float(rng.normal(5, 2)), str(rng.choice(["a", "b"]))
        p = 1 / (1 + math.exp(-(0.08 * (age - 45) - 0.6 * (income - 5) + (0.5 if kind == "a" else -0.5))))
        rows.append((i, age, income, kind, int(rng.random() < p)))
    return spark.createDataFrame(rows, "key long, age double, monthly_income double, kind string, y int").cache()


@pytest.fixture(scope="module")
def scorer(training):
    encoder = WoETransformer("y", exclude_cols=("key",)).fit(training)
    names = encoder.get_selected_features()
    assert set(names) == {"age", "monthly_income", "kind"}
    return S.Scorer(encoder, LinearScorecard(names, [-1.0] * 3, 0.1, [0.0] * 3), {"age": 40.0, "monthly_income": 5.0, "kind": "a"})


def test_scoring(spark, scorer):
    records = spark.createDataFrame([(1, 30.0, 9.0, 5.0), (2, 130.0, 1.0, 5.0), (3, 60.0, 1.0, 0.0)], "id int, age double, monthly_income double, loan_amount double")
    rows = {r["id"]: r for r in scorer.score(records).collect()}
    assert rows[1]["grade"] == "A" and rows[1]["anomaly_reasons"] is None and len(rows[1]["shap_values"]) == 3
    sizes = [abs(v["value"]) for v in rows[1]["shap_values"]]
    assert sizes == sorted(sizes, reverse=True)
    assert 0.1 + sum(v["value"] for v in rows[1]["shap_values"]) == pytest.approx(math.log(rows[1]["probability"] / (1 - rows[1]["probability"])))
    assert rows[2]["grade"] == "Undefined" and rows[2]["shap_values"] == [] and rows[2]["probability"] > 0
    assert rows[3]["anomaly_reasons"] == ["Invalid loan amount"]


def test_sort_is_stable_and_cut(spark):
    values = F.array(*[F.struct(F.lit(n).alias("feature"), F.lit(v).alias("value")) for n, v in (("a_woe", 1.0), ("b", -2.0), ("c", -1.0))])
    out = spark.range(1).select(sort_attributions(values).alias("s"), S.top_attributions(values, 2).alias("t")).first()
    assert [v["feature"] for v in out["s"]] == ["b", "a", "c"] and len(out["t"]) == 2


def test_sweep_and_exemplars(spark):
    base = spark.createDataFrame([(1, 40.0), (2, 10.0)], "id int, age double")
    assert S.sweep(base, "age", [20.0, 30.0, 40.0]).count() == 6
    scored = spark.createDataFrame([(3, "A"), (1, "A"), (2, "Undefined"), (4, "D")], "id int, grade string")
    assert {(r["grade"], r["id"]) for r in S.grade_exemplars(scored, "id").collect()} == {("A", 1), ("D", 4)}


def test_scenarios_use_every_option(spark):
    drawn = S.scenarios(spark.range(300), "id", {"a": [1, 2, 3], "b": ["x", "y"]})
    assert drawn.select("a", "b").distinct().count() == 6


@pytest.fixture(scope="module")
def trees(training):
    return M.train_gbt(training, ["age", "monthly_income"], "y", {"maxIter": 4, "maxDepth": 3})


def test_tree_attributions_add_up(training, trees):
    out = M.tree_attributions(trees, M.predict(trees, training))
    total = F.aggregate("attributions", F.col("base_value"), lambda s, a: s + a["value"])
    gap = out.select(F.max(F.abs(total - F.ln(F.col("probability") / (1 - F.col("probability")))))).first()[0]
    assert gap < 1e-9


def _made_up_tree():
    """Splits: f0 at 0 (60 of 100 rows left); left of it f1 at 0 (half), then f0 again at -2; right of it f2 at 1 (a quarter)."""
    feature = np.array([0, 1, 2, 0, -1, -1, -1, -1, -1])
    cut = np.array([0.0, 0.0, 1.0, -2.0] + [math.nan] * 5)
    left, right = np.array([1, 3, 5, 7] + [-1] * 5), np.array([2, 4, 6, 8] + [-1] * 5)
    value = np.array([0.0, 0.0, 0.0, 0.0, -2.0, 3.0, 0.5, 1.0, -4.0])
    return M._Tree(feature, cut, left, right, value, np.array([100.0, 60.0, 40.0, 30.0, 30.0, 10.0, 30.0, 12.0, 18.0]))


@pytest.mark.parametrize("copies", [1, 20])
def test_tree_attributions_equal_the_definition(copies):
    """Shapley values by enumeration of coalitions, few rows (by combination) and many (by table)."""
    tree = _made_up_tree()
    x = np.array([[-1.0, 2.0, 0.0], [1.0, -3.0, 0.5], [2.0, 0.0, 4.0], [-3.0, -1.0, 1.0], [-1.0, -1.0, 9.0]])

    def value(row, known, node=0):
        f = tree.feature[node]
        if f < 0:
            return tree.value[node]
        sides = [(tree.left[node], row[f] <= tree.cut[node]), (tree.right[node], row[f] > tree.cut[node])]
        return sum((float(goes) if f in known else tree.rows[c] / tree.rows[node]) * value(row, known, c) for c, goes in sides)

    got = np.zeros((3, len(x) * copies))
    M._add_tree(tree, np.repeat(x, copies, axis=0).T, got)
    assert M.base_value([tree]) == pytest.approx(value(x[0], set()))
    for r, row in enumerate(x):
        for f in range(3):
            others = [g for g in range(3) if g != f]
            want = sum(
                math.factorial(n) * math.factorial(2 - n) / 6 * (value(row, set(c) | {f}) - value(row, set(c)))
                for n in range(3) for c in itertools.combinations(others, n)
            )
            assert got[f, r * copies] == pytest.approx(want, abs=1e-12)


def test_learning_curve_ends_at_the_log_loss(training, trees):
    curve = M.learning_curve(trees, {"train": training}, "y").orderBy("round").collect()
    losses = [r["log_loss"] for r in curve]
    assert len(losses) == 4 and losses == sorted(losses, reverse=True)
    assert losses[-1] == pytest.approx(P.log_loss(M.predict(trees, training), "y", "probability").first()["log_loss"], abs=1e-9)


def test_monotone_scorecard(training):
    assert M.monotone_directions(["Monthly_Income", "pendapatan_x", "age"]) == {"Monthly_Income": -1, "pendapatan_x": -1, "age": 0}
    card = M.train_scorecard(training.withColumn("income", -F.col("monthly_income")), ["income", "age"], "y")
    # Unconstrained the weight would be positive; the bound holds it at zero.
    assert card.coefficients[0] == pytest.approx(0.0, abs=1e-6) and card.coefficients[1] > 0
    scored = card.score(S.sweep(training.withColumn("income", F.lit(0.0)), "age", [20.0, 40.0, 60.0]))
    audit = M.monotonicity_audit(scored, ["key"], "age").first()
    assert (audit["n_steps"], audit["n_violations"]) == (2400, 2400)


def test_no_predicted_positive_gives_zero_f1(spark):
    df = spark.createDataFrame([(1, 0.2), (0, 0.1)], "y int, p double")
    assert P.f1_score(df, "y", "p").first()["f1"] == 0.0
    assert P.f1_score(df.where("y = 0"), "y", "p").first()["f1"] == 0.0
    assert {(r["actual"], r["predicted"]): r["n"] for r in P.confusion_matrix(df, "y", "p").collect()} == {(0, 0): 1, (0, 1): 0, (1, 0): 1, (1, 1): 0}


def test_threshold_is_strict(spark):
    df = spark.createDataFrame([(1, 0.5), (1, 0.51), (0, None)], "y int, p double")
    assert tuple(P.alert_counters(df, "p").first()) == (3, 1, 2)


def test_log_loss_is_finite_at_the_ends(spark):
    df = spark.createDataFrame([(1, 0.0), (0, 1.0)], "y int, p double")
    assert math.isfinite(P.log_loss(df, "y", "p").first()["log_loss"])


def test_quality_of_identical_tables_is_one(training):
    row = P.quality_score(training.drop("key"), training.drop("key")).first()
    assert tuple(row) == pytest.approx((1.0, 1.0, 1.0))


def test_histogram_holds_every_row(training):
    assert P.grouped_histogram(training, "age", "kind", 25).agg(F.sum("n")).first()[0] == 1200
    flat = P.grouped_histogram(training.withColumn("age", F.lit(3.0)), "age", "kind", 25)
    assert {r["bin_id"] for r in flat.collect()} == {0}


def test_density_matches_a_plain_loop(training):
    got = P.density_grid(training, "monthly_income", "kind", 50).orderBy("kind", "grid_id").toPandas()
    pdf = training.toPandas()
    for kind, part in pdf.groupby("kind"):
        v = part.monthly_income.to_numpy()
        h = v.std(ddof=1) * len(v) ** -0.2
        grid = np.linspace(v.min(), v.max(), 50)
        want = np.exp(-0.5 * ((grid[:, None] - v) / h) ** 2).sum(axis=1) / (len(pdf) * h * math.sqrt(2 * math.pi))
        assert got[got.kind == kind].density.to_numpy() == pytest.approx(want)


def test_tree_scorer_equals_its_parts(spark, training):
    encoder = WoETransformer("y", exclude_cols=("key",)).fit(training)
    model = M.train_gbt(encoder.transform(training, keep_target=True), encoder.get_selected_features(), "y", {"maxIter": 3, "maxDepth": 3})
    records = training.drop("y").withColumn("loan_amount", F.lit(1.0))
    rows = {r["key"]: r for r in S.Scorer(encoder, model).score(records).collect()}
    plain = M.predict(model, encoder.transform(training, keep_cols=["key"]))
    for r in plain.collect():
        assert rows[r["key"]]["probability"] == r["probability"]
    one = rows[0]
    assert len(one["shap_values"]) == 3 and set(records.columns) < set(one.asDict())


def test_counters_beside_the_write_cost_no_scan(spark, scorer):
    """Each input row is read once, and the counters equal those of a scan of their own."""
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    schema = "id int, age double, monthly_income double, loan_amount double"
    rows = [(i, 10.0 + i % 110, float(i % 9) - 1, float(i % 5)) for i in range(500)]
    records = spark.createDataFrame(rows, schema).repartition(4)
    path = scratch_path(spark, "scores")
    got = {r["counter"]: r["n"] for r in S.write_scores(scorer, records.mapInPandas(count, schema), path).collect()}
    assert read.value == 500
    written = spark.read.parquet(path)
    plain = P.alert_counters(written, "probability").first()
    assert (got["total"], got["alerts"], got["approvals"]) == tuple(plain)
    assert got["undefined"] == written.where("grade = 'Undefined'").count()
    for reason in REASONS:
        assert got[reason] == written.where(F.array_contains("anomaly_reasons", reason)).count()
    assert got["Invalid age"] > 0 and got["Invalid loan amount"] == 100
    # The session can still send fitted logistic models to its tasks.
    data = VectorAssembler(inputCols=["age"], outputCol="features").transform(records.withColumn("y", (F.col("age") > 50).cast("int")))
    assert LogisticRegression(labelCol="y").fit(data).transform(data).where("prediction = 1").count() > 0
