"""Gate, tuning, ablation, folds and the training run, on a table whose risk is known."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.functions.hashing import uniform
from riskframe.operators import evaluation as E, models as M, profile as P, scoring as S
from riskframe.operators.gates import PASS
from riskframe.operators.orderstats import auc
from riskframe.operators.sampling import SmoteResampler, assign_folds
from riskframe.operators.woe import WoETransformer
from riskframe.session import scratch_path

SMALL = {"maxIter": 3, "maxDepth": 2}


def people(spark, rows, seed, flipped=False):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(rows):
        age, income, kind = float(rng.integers(20, 70)), float(rng.normal(5, 2)), str(rng.choice(["a", "b"]))
        odds = 0.08 * (age - 60) - 0.6 * (income - 5) + (0.5 if kind == "a" else -0.5)
        out.append((i, age, income, kind, int(rng.random() < 1 / (1 + math.exp(odds if flipped else -odds)))))
    return spark.createDataFrame(out, "key long, age double, income double, kind string, y int")


@pytest.fixture(scope="module")
def table(spark):
    return people(spark, 900, 5).cache()


@pytest.fixture(scope="module")
def encoded(table):
    encoder = WoETransformer("y", exclude_cols=("key",)).fit(table)
    return encoder.transform(table, keep_target=True, keep_cols=["key"]).cache()


def gate(spark, table, synthetic):
    rows = E.evaluate_tstr(table, synthetic.drop("key"), "y", ["key"], params=SMALL).collect()
    return {r["metric"]: (r["value"], r["status"]) for r in rows}


def test_gate_of_a_twin_population(spark, table):
    got = gate(spark, table, people(spark, 900, 6))
    trtr, tstr = got["TRTR_AUC"][0], got["TSTR_AUC"][0]
    assert trtr > 0.65 and tstr > 0.65 and got["AUC_Drop_Absolute"][0] == pytest.approx(trtr - tstr)
    assert got["AUC_Drop_Percentage"][0] == pytest.approx((trtr - tstr) / trtr)
    assert (got["Utility_Status"][1] == PASS) == (got["AUC_Drop_Percentage"][0] <= got["Quality_Gate_Threshold"][0])
    assert got["Inverted_KS_Statistic"][0] > 0.9 and got["DCR_Mean"][0] > 0


def test_gate_of_a_turned_population(spark, table):
    got = gate(spark, table, people(spark, 900, 6, flipped=True))
    assert got["TSTR_AUC"][0] < 0.5 < got["TRTR_AUC"][0] and got["Utility_Status"][1] != PASS


def test_tuning_keeps_the_best_draw(encoded):
    features = [c for c in encoded.columns if c not in ("key", "y")]
    folded = assign_folds(encoded, "y", ["key"])
    grid = {"maxDepth": [1, 3], "maxIter": [2]}
    model, best, scores = M.tune_gbt(folded, features, "y", "fold", grid, draws=2)
    assert [p for p, _ in scores if p == best] and dict(best)["maxDepth"] == model.stages[1].getOrDefault("maxDepth")
    assert max(a for _, a in scores) == next(a for p, a in scores if p == best) and all(0.5 < a < 1 for _, a in scores)


def test_cross_validated_auc_is_the_mean_over_folds(encoded):
    features = [c for c in encoded.columns if c not in ("key", "y")]
    folded = assign_folds(encoded, "y", ["key"]).cache()
    _, _, [(_, found)] = M.tune_gbt(folded, features, "y", "fold", {"maxDepth": [2], "maxIter": [2]}, draws=1)
    scores = []
    for k in range(3):
        model = M.train_gbt(folded.where(F.col("fold") != k), features, "y", {"maxDepth": 2, "maxIter": 2})
        scores.append(auc(M.predict(model, folded.where(F.col("fold") == k)), "y", "probability").first()["auc"])
    assert found == pytest.approx(np.mean(scores), abs=0.02)


def test_ablation_scores_the_same_test_rows_twice(table):
    scored = E.ablation(table, "y", ["key"], SMALL).cache()
    assert scored.count() == 270 and scored.select("key").distinct().count() == 270
    found = {r["score"]: r["auc"] for r in auc(scored, "y", ["p_raw", "p_woe"]).collect()}
    assert found["p_raw"] > 0.6 and found["p_woe"] > 0.6


@pytest.mark.parametrize("leaky", [False, True])
def test_new_rows_join_the_fold_of_their_base_row(encoded, leaky):
    balanced = SmoteResampler("y", key=["key"], tag="origin").fit_resample_combined(encoded).cache()
    folded = E.training_folds(balanced, encoded, "y", ["key"], 3, 42, leaky).toPandas()
    assert len(folded) == balanced.count() and set(folded.fold) == {0, 1, 2}
    sizes = folded[folded.origin == "original"].groupby(["y", "fold"]).size().unstack()
    if leaky:
        assert (folded.groupby(["y", "fold"]).size().unstack().pipe(lambda s: s.max(axis=1) - s.min(axis=1)) <= 1).all()
        return
    assert (sizes.max(axis=1) - sizes.min(axis=1) <= 1).all()
    new = folded[folded.origin == "synthetic"]
    minority = new.y.iloc[0]
    real = folded[(folded.origin == "original") & (folded.y == minority)].sort_values("key")
    base = real.fold.to_numpy()
    assert (base[new.base_idx.astype(int)] == new.fold).all()


def test_training_run(table):
    row, encoder, model, best = E.train_credit_model(
        table, "y", ["key"], "run", "model", grid={"maxDepth": [2], "maxIter": [3]}, draws=1
    )
    r = row.first()
    assert (r["status"], r["run_id"], r["model_name"]) == ("success", "run", "model") and best == {"maxDepth": 2, "maxIter": 3}
    assert 0.6 < r["auc_score"] < 1 and 0 < r["f1_score"] < 1 and r["model_registered"] == (r["auc_score"] > E.REGISTER_ABOVE)
    assert M.feature_names(model) == encoder.get_selected_features()


def test_early_stopping_ends_before_the_last_round(encoded):
    features = [c for c in encoded.columns if c not in ("key", "y")]
    marked = encoded.withColumn("held", F.col("key") % 4 == 0)
    params = {"maxIter": 60, "maxDepth": 4, "stepSize": 0.3, "validationTol": 0.0001}
    model = M.train_gbt(marked, features, "y", params, validation_col="held")
    rounds = len(model.stages[1].trees)
    assert rounds < 60
    curve = M.learning_curve(model, {"held": marked.where("held")}, "y")
    held = P.log_loss(M.predict(model, marked.where("held")), "y", "probability").first()["log_loss"]
    assert curve.where(F.col("round") == rounds - 1).first()["log_loss"] == pytest.approx(held, abs=1e-9)


# --- early stopping and directions -----------------------------------------------------------------


def test_stopping_round():
    assert M.stopping_round([3, 2, 1, 1, 1, 1], 3) == (2, 5)
    assert M.stopping_round([3, 2, 1, 0], 2) == (3, 3)
    assert M.stopping_round([1, 2, 3, 0], 2) == (0, 2)
    assert M.stopping_round([1], 1) == (0, 0)


def test_staged_margins_end_in_the_probability(encoded):
    features = [c for c in encoded.columns if c not in ("key", "y")]
    model = M.train_gbt(encoded, features, "y", {"maxIter": 5, "maxDepth": 3})
    rows = M.staged_margins(model, M.predict(model, encoded)).collect()
    assert all(len(r["margins"]) == 5 and r["probability"] == pytest.approx(1 / (1 + math.exp(-r["margins"][-1]))) for r in rows)
    curve = {r["round"]: r["log_loss"] for r in M.staged_log_loss(M.staged_margins(model, encoded), "y").collect()}
    library = {r["round"]: r["log_loss"] for r in M.learning_curve(model, {"a": encoded}, "y").collect()}
    assert curve == pytest.approx(library)


def test_early_stopped_training(spark, encoded):
    """The curve is recomputed in SQL from the written margins; the kept model is that of the best round."""
    import duckdb

    features = [c for c in encoded.columns if c not in ("key", "y")]
    params = {"maxIter": 40, "maxDepth": 4, "stepSize": 0.4}
    model, curve = M.train_early_stopped(encoded, features, "y", ["key"], params, patience=3)
    rows = curve.collect()
    held = {r["round"]: r["log_loss"] for r in rows if r["dataset"] == "validation"}
    best = min(held, key=lambda i: (held[i], i))
    assert max(held) == best + 3 < 39 and {r["round"] for r in rows if r["best"]} == {best}
    assert len(model.stages[1].trees) == best + 1
    marked = encoded.withColumn("held", uniform(42, F.lit("validation"), "key") < 0.3).cache()
    whole = M.train_gbt(marked.where("not held"), features, "y", params)
    path = scratch_path(spark, "margins")
    M.staged_margins(whole, marked).select("held", "y", "margins").write.parquet(path)
    sql = f"""SELECT held, round, avg(ln(1 + exp(CASE WHEN y = 1 THEN -m ELSE m END))) FROM (
      SELECT held, y, unnest(margins) AS m, unnest(range(len(margins))) AS round FROM read_parquet('{path}/*.parquet')) GROUP BY ALL"""
    want = {("validation" if h else "train", r): loss for h, r, loss in duckdb.sql(sql).fetchall()}
    assert {(r["dataset"], r["round"]): r["log_loss"] for r in rows} == pytest.approx({k: v for k, v in want.items() if k[1] <= best + 3}, abs=1e-9)
    # The kept model scores as the whole one does after its best round.
    kept = {r["key"]: r["p"] for r in M.predict(model, encoded, "p").collect()}
    for r in M.staged_margins(whole, encoded).collect():
        assert kept[r["key"]] == pytest.approx(1 / (1 + math.exp(-r["margins"][best])), abs=1e-9)


def test_directed_scorecard_never_goes_the_wrong_way(spark):
    """A feature whose WoE raises the risk in the training rows is held at zero; without a direction it isn't, and the audit sees it."""
    rng = np.random.default_rng(3)
    rows = [(i, float(rng.normal()), float(rng.normal())) for i in range(400)]
    data = spark.createDataFrame([(i, a, b, int(a + b + rng.normal() > 0)) for i, a, b in rows], "key long, a double, b double, y int").cache()
    card, audit = E.directed_scorecard(data, data, ["a", "b"], "y", ["key"], {"a": -1})
    assert [tuple(r) for r in audit.collect()] == [("a", 1600, 0)] and card.coefficients[0] == pytest.approx(0, abs=1e-9) and card.coefficients[1] > 0
    free = M.train_scorecard(data, ["a", "b"], "y", {})
    swept = free.score(S.sweep(data, "a", list(E.SWEEP)))
    assert M.monotonicity_audit(swept, ["key"], "a").first()["n_violations"] == 1600
    _, none = E.directed_scorecard(data, data, ["a", "b"], "y", ["key"])
    assert none.count() == 0
    _, named = E.directed_scorecard(data.withColumnRenamed("a", "monthly_income"), data.withColumnRenamed("a", "monthly_income"), ["monthly_income", "b"], "y", ["key"])
    assert [tuple(r) for r in named.collect()] == [("monthly_income", 1600, 0)]


def test_gate_lists_its_directions(spark, table):
    got = gate(spark, table, people(spark, 900, 6))
    for side in ("TRTR", "TSTR"):
        assert got[f"{side}_Direction_Steps"][0] == 4 * 270 and got[f"{side}_Direction_Violations"][0] == 0
        assert got[f"{side}_Scorecard_AUC"][0] > 0.65


def test_halving_keeps_what_does_best(encoded):
    """Nine draws, three, one; each trial equals the plain cross-validation with as many rounds."""
    features = [c for c in encoded.columns if c not in ("key", "y")]
    folded = assign_folds(encoded, "y", ["key"]).cache()
    grid = {"maxDepth": [1, 2, 3], "stepSize": [0.05, 0.1, 0.3], "maxIter": [12]}
    model, best, trials = M.tune_gbt_by_rounds(folded, features, "y", "fold", grid, draws=9, first_rounds=1)
    assert [sum(r == n for _, r, _ in trials) for n in (1, 3)] == [9, 3]
    first = sorted((t for t in trials if t[1] == 1), key=lambda t: -t[2])
    second = [t for t in trials if t[1] == 3]
    assert sorted(a for _, _, a in first)[-3:] == pytest.approx(sorted(next(a for p, _, a in first if p == q) for q, _, _ in second))
    assert best == max(second, key=lambda t: t[2])[0] and len(model.stages[1].trees) == 12
    _, _, [(_, plain)] = M.tune_gbt(folded, features, "y", "fold", {k: [v] for k, v in {**second[0][0], "maxIter": 3}.items()}, draws=1)
    assert second[0][2] == pytest.approx(plain, abs=0.02)
    none, only, trials = M.tune_gbt_by_rounds(folded, features, "y", "fold", {"maxDepth": [2], "maxIter": [2]}, draws=1, refit=False)
    assert none is None and only == {"maxDepth": 2, "maxIter": 2} and [r for _, r, _ in trials] == [2]


# --- rows that are equal ---------------------------------------------------------------------------


@pytest.fixture(scope="module")
def repeated(spark):
    """12 different rows, 1,800 in all, of uneven numbers."""
    return spark.range(1800).select(
        F.col("id").alias("key"), (F.col("id") % 3).cast("double").alias("a"), (F.col("id") % 4 % 2).cast("double").alias("b"),
        F.when(F.col("id") % 7 < 2 + F.col("id") % 3, 1).otherwise(0).alias("y"),
    )


def test_equal_rows_are_one_point_of_training(spark, repeated):
    model = M.train_gbt(repeated, ["a", "b"], "y", {"maxIter": 3, "maxDepth": 2})
    path = scratch_path(spark, "points")
    model.stages[1].save(path)
    roots = spark.read.parquet(f"{path}/data").where("nodeData.id = 0").select("nodeData.rawCount", "nodeData.impurityStats").collect()
    assert {r["rawCount"] for r in roots} == {12} and {r["impurityStats"][0] for r in roots} == {1800.0}
    assert {t.rows[0] for t in M.tree_arrays(model.stages[1])} == {1800.0}
    _, curve = M.train_early_stopped(repeated, ["a", "b"], "y", ["key"], {"maxIter": 3, "maxDepth": 2})
    whole = repeated.withColumn("held", uniform(42, F.lit("validation"), "key") < 0.3)
    fitted = M.train_gbt(whole.where("not held"), ["a", "b"], "y", {"maxIter": 3, "maxDepth": 2})
    want = M.staged_log_loss(M.staged_margins(fitted, whole), "y", by=["held"]).collect()
    got = {(r["dataset"] == "validation", r["round"]): r["log_loss"] for r in curve.collect()}
    assert got == pytest.approx({(r["held"], r["round"]): r["log_loss"] for r in want if (r["held"], r["round"]) in got})


def test_points_that_rounds_draw_from_hold_every_row_once(repeated):
    points = M.merged_rows(repeated, ["a", "b", "y"], 64).collect()
    sizes = {}
    for r in points:
        sizes.setdefault((r["a"], r["b"], r["y"]), []).append(r[M.WEIGHT])
    want = {(r["a"], r["b"], r["y"]): r["count"] for r in repeated.groupBy("a", "b", "y").count().collect()}
    assert {k: sum(v) for k, v in sizes.items()} == want
    assert all(len(v) == min(64, want[k]) and max(v) - min(v) <= 1 for k, v in sizes.items())
    few = M.merged_rows(repeated.where("key < 30"), ["a", "b", "y"], 64)
    assert few.count() == 30 and few.agg(F.max(M.WEIGHT)).first()[0] == 1.0


def test_audit_of_merged_rows_is_the_audit_of_all_rows(repeated):
    """Rows that share a key, null keys among them, are one row of the audit, as a window over the key sees them."""
    rows = repeated.withColumn("key", F.when(F.col("key") < 1700, F.col("key"))).unionByName(repeated.where("key < 40"))
    card = M.LinearScorecard(["a", "b"], [0.7, -0.4], 0.1, [0.0, 0.0])
    got = {r["feature"]: (r["n_steps"], r["n_violations"]) for r in E.sweep_audit(card, rows, ["key"], {"a": -1, "b": -1}).collect()}
    for f in ("a", "b"):
        want = M.monotonicity_audit(card.score(S.sweep(rows, f, list(E.SWEEP))), ["key"], f).first()
        assert got[f][0] == want["n_steps"]
    once = E.sweep_audit(card, repeated, ["key"], {"a": -1, "b": -1}).collect()
    assert {r["feature"]: (r["n_steps"], r["n_violations"]) for r in once} == {"a": (7200, 7200), "b": (7200, 0)}


# --- the whole search ------------------------------------------------------------------------------


def test_every_draw_is_fitted_with_all_of_its_rounds(encoded, monkeypatch):
    features = [c for c in encoded.columns if c not in ("key", "y")]
    folded = assign_folds(encoded, "y", ["key"])
    fitted, make = [], M._classifier
    monkeypatch.setattr(M, "_classifier", lambda *a, **k: (fitted.append(dict(a[2])), make(*a, **k))[1])
    grid = {"maxDepth": [1, 2], "maxIter": [2, 3], "subsamplingRate": [0.8, 1.0]}
    model, best, scores = M.tune_gbt(folded, features, "y", "fold", grid, draws=8)
    assert len(scores) == 8 and len(fitted) == 3 * 8 + 1
    assert all(fitted.count(p) == 3 + (p == best) for p, _ in scores)
    assert len(model.stages[1].trees) == best["maxIter"]


def test_the_registered_training_run_searches_the_whole_grid(spark, tmp_path, monkeypatch):
    """Ten draws of the library's grid, as many rounds as they ask for."""
    from riskframe.plans import QUERIES

    rng = np.random.default_rng(8)
    rows = [
        (i, i % 7, i % 11, 1 + i % 3, float(rng.integers(1, 51)), float(rng.normal(9000, 2000)), float(rng.integers(0, 11) / 100), float(rng.integers(0, 9) / 100), "RAN"[i % 3], "OF"[i % 2])
        for i in range(600)
    ]
    columns = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string"
    table = spark.createDataFrame(rows, columns).withColumn("l_shipdate", F.lit("1998-01-01").cast("timestamp_ntz"))
    table.coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    asked, search = [], E.tune_gbt

    def small(df, features, label, fold, grid, draws, folds, *rest):
        asked.append((grid, draws, folds))
        return search(df, features, label, fold, {"maxDepth": [2], "maxIter": [2]}, 1, folds, *rest)

    monkeypatch.setattr(E, "tune_gbt", small)
    assert QUERIES["credit_training"](spark, str(tmp_path)).count() == 1
    assert asked == [(M.TUNING_GRID, 10, 3)] and max(M.TUNING_GRID["maxIter"]) == 500


# --- passes over the rows --------------------------------------------------------------------------


def raw_rows(spark, rows=3000):
    return spark.range(rows).select(
        F.col("id").alias("key"), (uniform(1, "id") * 1000).alias("price"), (F.col("id") % 7).cast("double").alias("few"),
        F.when(uniform(2, "id") < 0.2 + 0.6 * uniform(1, "id"), 1).otherwise(0).alias("y"),
    )


def test_candidate_splits_are_quantiles_of_all_rows(spark):
    rows = raw_rows(spark).withColumn("hot", F.when(F.col("key") % 3 == 0, F.lit(500.0)).otherwise(F.col("price"))).cache()
    cuts = M.split_candidates(rows, ["price", "few", "hot"])
    assert set(cuts) == {"price", "hot"} and len(cuts["price"]) == 31 and len(cuts["hot"]) <= 31
    prices = sorted(r["price"] for r in rows.collect())
    assert cuts["price"] == [prices[math.ceil(j * 3000 / 32) - 1] for j in range(1, 32)]
    # The value of every third row lies in a bin of its own.
    coded = M.binned(rows, ["hot"], cuts, "__bin").where("hot = 500 or (hot > 499 and hot < 501)")
    assert coded.where("hot = 500").select("hot__bin").distinct().count() == 1
    own = coded.where("hot = 500").first()["hot__bin"]
    assert M.binned(rows, ["hot"], cuts, "__bin").where((F.col("hot__bin") == own) & (F.col("hot") != 500)).count() == 0


def test_bins_keep_missing_values_missing(spark):
    rows = spark.createDataFrame([(None,), (float("nan"),), (1.0,), (2.0,), (9.0,)], "x double")
    found = [r["b"] for r in M.binned(rows, ["x"], {"x": [1.0, 3.0]}, "__b").select(F.col("x__b").alias("b")).collect()]
    assert found[0] is None and math.isnan(found[1]) and found[2:] == [0.0, 1.0, 2.0]


def test_ablation_of_many_rows_trains_on_bins(spark, monkeypatch):
    """Training points on raw values are no more than there are combinations of bins, and both forms judge alike."""
    rows, points, train = raw_rows(spark).cache(), [], E.train_gbt

    def counted(df, features, label, *rest):
        points.append(df.select(*features, label).distinct().count())
        return train(df, features, label, *rest)

    monkeypatch.setattr(E, "train_gbt", counted)
    params = {"maxIter": 3, "maxDepth": 3}
    plain = {r["key"]: r["p_raw"] for r in E.ablation(rows, "y", ["key"], params).collect()}
    monkeypatch.setattr(E, "FEW_POINTS", 100)
    scored = E.ablation(rows, "y", ["key"], params).cache()
    assert scored.columns == ["key", "y", "p_raw", "p_woe"]
    found = {r["key"]: r["p_raw"] for r in scored.collect()}
    assert points[0] == 2100 and points[2] <= 32 * 7 * 2 and points[1] == points[3]
    assert found.keys() == plain.keys() and np.mean([abs(found[k] - plain[k]) for k in found]) < 0.02
    assert auc(scored, "y", "p_raw").first()["auc"] > 0.6


def test_scores_are_judged_once_for_each_different_row(repeated):
    """As every row by itself would be, from as many rows as there are different ones; a row without a label counts nowhere."""
    rows = repeated.withColumn("y", F.when(F.col("key") % 50 > 0, F.col("y")))
    seen = []

    def score(df):
        seen.append(df.count())
        return df.withColumn("probability", 0.3 * F.col("a") + 0.1 * F.col("b"))

    got = M.judge(score, rows, ["a", "b"], "y")
    assert seen == [rows.select("a", "b", "y").distinct().count()] and got == pytest.approx(M.evaluate(score(rows), "y"))
    assert got["f1"] > 0


def test_gate_scores_no_row_twice(spark, table, monkeypatch):
    sizes, predict = [], E.predict
    monkeypatch.setattr(E, "predict", lambda model, df, *rest: (sizes.append(M.WEIGHT in df.columns), predict(model, df, *rest))[1])
    copies = table.unionByName(table.withColumn("key", F.col("key") + 1000))
    got = gate(spark, copies, people(spark, 300, 6))
    assert sizes == [True, True] and got["TRTR_AUC"][0] > 0.6
