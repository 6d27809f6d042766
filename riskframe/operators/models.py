"""Training on MLlib: boosted trees, the monotone scorecard, tuning, ablation and tree attribution."""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseMatrix
from pyspark.sql import DataFrame, SparkSession, functions as F

from riskframe.functions.binning import cut_index
from riskframe.functions.hashing import uniform
from riskframe.operators.orderstats import as_value, auc, quantile_cuts, sketch
from riskframe.operators.passes import SMALL_PARTITIONS, spread_small
from riskframe.operators.profile import f1_score
from riskframe.operators.sampling import draw_parameters
from riskframe.operators.scorecard import LinearScorecard
from riskframe.session import checkpoint_root, cut_lineage, scratch_path

FEATURES = "__features"
#: How many rows a point of a merged training table stands for.
WEIGHT = "__rows"
#: Equal rows are dealt to so many points where rounds draw rows: a group of as many rows or fewer is drawn row by row, of a
#: larger one every round takes close to the wanted share.
DRAWN_POINTS = 64
#: Points up to which a table is dealt to ``SMALL_PARTITIONS`` tasks.
FEW_POINTS = 1_000_000
#: Bins of a feature among whose bounds MLlib's trees choose, if ``maxBins`` says nothing else.
TREE_BINS = 32
#: Points that one task of a fit is given where many fits run side by side.
POINTS_PER_TASK = 50_000
# Settings of the gate model and the grid of the tuned one.
GATE_PARAMS = {"maxIter": 100, "stepSize": 0.1}
TUNING_GRID = {
    "maxDepth": [3, 5, 8, 10],
    "stepSize": [0.01, 0.05, 0.1],
    "subsamplingRate": [0.8, 1.0],
    "featureSubsetStrategy": ["0.8", "1.0"],
    "maxIter": [200, 500],
}
TUNING_DRAWS = 10
TUNING_FOLDS = 3
#: Fits of a search that run side by side.
TUNING_PARALLELISM = 8
# The run that shows the learning curve.
EARLY_STOPPING_PARAMS = {"maxIter": 100, "maxDepth": 4, "stepSize": 0.05}
PATIENCE = 10
# Words that mark a feature whose rise must not raise the risk.
MONOTONE_WORDS = ["income", "pendapatan"]


def _classifier(label: str, seed: int, params: Mapping, validation_col: str | None = None) -> GBTClassifier:
    gbt = GBTClassifier(featuresCol=FEATURES, labelCol=label, weightCol=WEIGHT, seed=seed, checkpointInterval=10, cacheNodeIds=False)
    if validation_col:
        gbt = gbt.setValidationIndicatorCol(validation_col)
    return gbt.setParams(**params)


def _assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=FEATURES)


def _labelled(df: DataFrame, label: str) -> DataFrame:
    return df.withColumn(label, F.col(label).cast("double"))


def _prepare(df: DataFrame, label: str) -> DataFrame:
    # Boosting cuts the lineage of its running errors in the shared folder.
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(checkpoint_root(df.sparkSession))
    return spread_small(_labelled(df, label))


def merged_rows(
    df: DataFrame, columns: Sequence[str], points: int = 1, weight: str | None = None, per_task: int | None = None
) -> DataFrame:
    """``(*columns, WEIGHT)``: rows that are equal in ``columns`` as one point, or as up to ``points`` of nearly equal weight.

    Encoded rows repeat, so a table of any length has as many points as there are combinations of bins and categories, and
    a boosting round costs the same for all of them. The weights add up to the number of rows, or to the sum of whole
    numbers in ``weight``. With ``per_task`` few points are dealt to fewer tasks, of that many points each.
    """
    merged = df.groupBy(*columns).agg((F.count("*") if weight is None else F.sum(weight).cast("long")).alias(WEIGHT))
    order = list(columns)
    if points > 1:
        merged = merged.withColumn("__points", F.least(F.col(WEIGHT), F.lit(points)))
        merged = merged.withColumn("__point", F.explode(F.sequence(F.lit(1), F.col("__points").cast("int"))))
        left = F.when(F.col("__point") <= F.col(WEIGHT) % F.col("__points"), F.lit(1)).otherwise(F.lit(0))
        merged = merged.withColumn(WEIGHT, F.floor(F.col(WEIGHT) / F.col("__points")) + left).drop("__points")
        order.append("__point")
    merged = cut_lineage(merged.withColumn(WEIGHT, F.col(WEIGHT).cast("double")))
    size = merged.count()
    if size <= FEW_POINTS:
        # What is drawn or summed per partition must not depend on how the rows came.
        tasks = SMALL_PARTITIONS if per_task is None else min(SMALL_PARTITIONS, max(1, math.ceil(size / per_task)))
        merged = merged.repartition(tasks, *order).sortWithinPartitions(*order)
    return merged.select(*columns, WEIGHT)


def split_candidates(df: DataFrame, features: Sequence[str], bins: int = TREE_BINS) -> dict[str, list[float]]:
    """Cuts of the features with more than ``bins`` values, at exact quantiles of all rows.

    Trees only ever split at such cuts, so a row may enter training with the numbers of its bins (see :func:`binned`), and
    rows of the same bins are one point. MLlib would take the cuts from some 10,000 rows.
    """
    values = [as_value(c) for c in features]
    sketches = sketch(df, values)
    # Near the limit the sketch can't tell.
    near = [i for i, s in enumerate(sketches) if 0.75 * bins <= s.distinct <= 1.25 * bins]
    exact = df.agg(*[F.count_distinct(values[i]).alias(str(i)) for i in near]).first().asDict() if near else {}
    wide = [i for i, s in enumerate(sketches) if exact.get(str(i), s.distinct) > bins]
    cuts = quantile_cuts(df, [values[i] for i in wide], bins, [sketches[i] for i in wide]) if wide else []
    return {features[i]: c for i, c in zip(wide, cuts)}


def binned(df: DataFrame, features: Sequence[str], cuts: Mapping[str, Sequence[float]], suffix: str = "") -> DataFrame:
    """``df`` with ``<feature><suffix>``: the number of its bin where a feature has ``cuts``, else its value. Missing stays missing."""
    value = lambda c: F.col(c).cast("double")
    code = lambda c: F.when(F.isnan(value(c)), value(c)).otherwise(cut_index(c, cuts[c]).cast("double"))
    return df.withColumns({f"{c}{suffix}": code(c) if c in cuts else F.col(c) for c in features})


def _points(params: Mapping) -> int:
    return DRAWN_POINTS if params.get("subsamplingRate", 1.0) < 1.0 else 1


def train_gbt(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    params: Mapping = GATE_PARAMS,
    seed: int = 42,
    validation_col: str | None = None,
    weight: str | None = None,
) -> PipelineModel:
    """Boosted trees on numeric columns. ``validation_col`` (boolean) marks rows for early stopping. A row counts ``weight`` times."""
    marks = [validation_col] if validation_col else []
    points = merged_rows(_labelled(df, label), [*features, label, *marks], _points(params), weight)
    return Pipeline(stages=[_assembler(features), _classifier(label, seed, params, validation_col)]).fit(points)


def feature_names(model: PipelineModel) -> list[str]:
    return list(model.stages[0].getInputCols())


def predict(model: PipelineModel, df: DataFrame, name: str = "probability", suffix: str = "") -> DataFrame:
    """``df`` with the probability of class 1. The features are read from ``<feature><suffix>``."""
    keep = [F.col(c) for c in df.columns]
    out = model.stages[1].transform(_assembler([f + suffix for f in feature_names(model)]).transform(df))
    return out.select(*keep, vector_to_array(F.col("probability")).getItem(1).alias("__p")).withColumnRenamed("__p", name)


def evaluate(scored: DataFrame, label: str, probability: str = "probability", weight: str | None = None) -> dict[str, float]:
    """Exact AUC, and F1 of class 1 at 0.5. A row counts ``weight`` times."""
    return {
        "auc": auc(scored, label, probability, weight=weight).first()["auc"],
        "f1": f1_score(scored, label, probability, weight=weight).first()["f1"],
    }


def judge(score: Callable[[DataFrame], DataFrame], rows: DataFrame, features: Sequence[str], label: str) -> dict[str, float]:
    """:func:`evaluate` of a score that reads ``features`` alone: each different row is scored once and counts as often as it occurs."""
    scored = cut_lineage(score(merged_rows(rows, [*features, label])).select(label, WEIGHT, "probability"))
    return evaluate(scored, label, weight=WEIGHT)


def learning_curve(model: PipelineModel, frames: Mapping[str, DataFrame], label: str) -> DataFrame:
    """``(dataset, round, log_loss)`` of a boosted model after every round."""
    assembler, gbt = model.stages
    gbt = gbt.copy({gbt.weightCol: WEIGHT})
    rows = []
    for name, df in frames.items():
        data = assembler.transform(merged_rows(_labelled(df, label), [*feature_names(model), label]))
        # The library's loss is 2 * log(1 + exp(-2 y F)), twice the log loss.
        rows += [(name, i, e / 2.0) for i, e in enumerate(gbt.evaluateEachIteration(data))]
    return df.sparkSession.createDataFrame(rows, "dataset string, round int, log_loss double")


def _margins(trees: Sequence[_Tree], x: np.ndarray) -> np.ndarray:
    """Log-odds after every tree: one row per row of ``x``, one column per tree."""
    total = np.zeros((len(x), len(trees)))
    rows = np.arange(len(x))
    for t, tree in enumerate(trees):
        node = np.zeros(len(x), dtype=np.int64)
        while True:
            f = tree.feature[node]
            inner = f >= 0
            if not inner.any():
                break
            left = x[rows, np.maximum(f, 0)] <= tree.cut[node]
            node = np.where(inner, np.where(left, tree.left[node], tree.right[node]), node)
        total[:, t] = tree.value[node]
    return total.cumsum(axis=1)


def staged_margins(model: PipelineModel, df: DataFrame, name: str = "margins", suffix: str = "") -> DataFrame:
    """``df`` with the log-odds of each row after every boosting round, as one array."""
    trees = tree_arrays(model.stages[1])

    @F.pandas_udf("array<double>")
    def margins(vectors: pd.Series) -> pd.Series:
        # Encoded rows repeat; each different one goes through the trees once.
        x, at = np.unique(np.stack(vectors.to_numpy()), axis=0, return_inverse=True)
        return pd.Series(list(_margins(trees, x)[at.ravel()]))

    return df.withColumn(name, margins(F.array(*[F.col(f + suffix).cast("double") for f in feature_names(model)])))


def staged_log_loss(df: DataFrame, label: str, margins: str = "margins", by: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """``(*by, round, log_loss)`` from arrays of log-odds; rows without a label are left out. A row counts ``weight`` times."""
    times = F.lit(1.0) if weight is None else F.col(weight)
    long = df.where(F.col(label).isNotNull()).select(
        *by, F.col(label).alias("__y"), times.alias("__times"), F.posexplode(margins).alias("round", "__m")
    )
    wrong = F.when(F.col("__y") == 1, -F.col("__m")).otherwise(F.col("__m"))
    loss = F.greatest(wrong, F.lit(0.0)) + F.log1p(F.exp(-F.abs(wrong)))
    return long.groupBy(*by, "round").agg((F.sum(loss * F.col("__times")) / F.sum("__times")).alias("log_loss"))


def stopping_round(losses: Sequence[float], patience: int) -> tuple[int, int]:
    """(best, last): the round with the lowest loss, and the one where ``patience`` rounds had brought nothing lower."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        if i - best >= patience:
            return best, i
    return best, len(losses) - 1


def first_rounds(model: PipelineModel, rounds: int) -> PipelineModel:
    """The model of the first ``rounds`` trees: its saved form with the later trees left out."""
    assembler, gbt = model.stages
    spark = SparkSession.getActiveSession()
    whole, cut = scratch_path(spark, "trees"), scratch_path(spark, "first_trees")
    gbt.save(whole)
    for part in ("data", "treesMetadata"):
        table = spark.read.parquet(f"{whole}/{part}")
        number = "treeID" if "treeID" in table.columns else table.columns[0]  # the saved columns may have no names
        table.where(F.col(number) < rounds).write.parquet(f"{cut}/{part}")
    state = json.loads(spark.read.text(f"{whole}/metadata").first()[0])
    state["numTrees"] = rounds
    spark.createDataFrame([(json.dumps(state),)], "value string").coalesce(1).write.text(f"{cut}/metadata")
    return PipelineModel([assembler, GBTClassificationModel.load(cut)])


def train_early_stopped(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    key: Sequence[str],
    params: Mapping = EARLY_STOPPING_PARAMS,
    patience: int = PATIENCE,
    validation_share: float = 0.3,
    seed: int = 42,
) -> tuple[PipelineModel, DataFrame]:
    """Boosted trees that end where the validation rows gain nothing more: the model of the best round, and the curve.

    A row is a validation row by a hash of its ``key``. The curve is ``(dataset, round, log_loss, best)`` of both parts up to
    the round at which ``patience`` rounds had passed without a lower validation loss. All rounds are fitted first; margins
    of every round are written once for each different row, and both the choice and the curve are read from them.
    """
    held = uniform(seed, F.lit("validation"), *key) < F.lit(validation_share)
    # Equal rows go through training and curve as one, with their number.
    marked = cut_lineage(merged_rows(_labelled(df.withColumn("__held", held), label), [*features, label, "__held"]))
    model = train_gbt(marked.where("not __held"), features, label, params, seed, weight=WEIGHT)
    path = scratch_path(df.sparkSession, "margins")
    dataset = F.when(F.col("__held"), F.lit("validation")).otherwise(F.lit("train"))
    staged_margins(model, marked).select(dataset.alias("dataset"), F.col(label).alias("label"), WEIGHT, "margins").write.parquet(path)
    curve = cut_lineage(staged_log_loss(df.sparkSession.read.parquet(path), "label", by=["dataset"], weight=WEIGHT))
    losses = [r["log_loss"] for r in curve.where("dataset = 'validation'").orderBy("round").collect()]  # one per round
    if not losses:
        raise ValueError("no validation row: the table is empty or its share too small")
    best, last = stopping_round(losses, patience)
    shown = curve.where(F.col("round") <= last).withColumn("best", F.col("round") == best)
    return first_rounds(model, best + 1), shown


# --- monotone scorecard ----------------------------------------------------------------------------


def monotone_directions(features: Sequence[str]) -> dict[str, int]:
    """-1 where a higher value must not raise the risk, 0 where any direction is allowed."""
    return {f: -1 if any(w in f.lower() for w in MONOTONE_WORDS) else 0 for f in features}


def train_scorecard(
    df: DataFrame, features: Sequence[str], label: str, directions: Mapping[str, int] | None = None, reg_param: float = 0.0, weight: str | None = None
) -> LinearScorecard:
    """Logistic regression whose coefficients obey ``directions`` (-1: at most 0, 1: at least 0). A row counts ``weight`` times."""
    directions = monotone_directions(features) if directions is None else directions
    lr = LogisticRegression(featuresCol=FEATURES, labelCol=label, regParam=reg_param, maxIter=100, family="binomial")
    upper = [0.0 if directions.get(f, 0) < 0 else math.inf for f in features]
    lower = [0.0 if directions.get(f, 0) > 0 else -math.inf for f in features]
    if any(u == 0.0 for u in upper):
        lr = lr.setUpperBoundsOnCoefficients(DenseMatrix(1, len(features), upper))
    if any(v == 0.0 for v in lower):
        lr = lr.setLowerBoundsOnCoefficients(DenseMatrix(1, len(features), lower))
    if weight is not None:
        lr = lr.setWeightCol(weight)
    data = _assembler(features).transform(_prepare(df, label))
    model = lr.fit(data)
    mean = F.avg if weight is None else lambda f: F.sum(F.col(f) * F.col(weight)) / F.sum(F.when(F.col(f).isNotNull(), F.col(weight)))
    means = df.agg(*[mean(f).alias(f) for f in features]).first()
    return LinearScorecard(list(features), [float(c) for c in model.coefficients], float(model.intercept), [float(means[f]) for f in features])


def naive_scorecard(encoded: DataFrame, features: Sequence[str], label: str) -> LinearScorecard:
    """Log-odds of the whole population minus the sum of the WoE values: features taken as independent, nothing to fit."""
    positive = F.col(label).cast("double")
    row = encoded.agg(F.sum(positive).alias("__pos"), F.count(positive).alias("__n"), *[F.avg(f).alias(f) for f in features]).first()
    events, others = row["__pos"] or 0.0, row["__n"] - (row["__pos"] or 0.0)
    if not events or not others:
        raise ValueError(f"'{label}' needs rows of both classes")
    return LinearScorecard(list(features), [-1.0] * len(features), math.log(events / others), [float(row[f]) for f in features])


def monotonicity_audit(
    scored: DataFrame, row_key: Sequence[str], feature: str, probability: str = "probability", direction: int = -1, weight: str | None = None
) -> DataFrame:
    """One row ``(n_steps, n_violations)`` over a sweep: steps of one row's feature that move the wrong way. A step counts
    ``weight`` times."""
    from pyspark.sql import Window

    # The window holds the sweep of one row: as many rows as swept values.
    w = Window.partitionBy(*row_key).orderBy(feature)
    step = (F.col(probability) - F.lag(probability).over(w)) * F.lit(float(direction))
    times = F.lit(1) if weight is None else F.col(weight)
    steps = scored.select(step.alias("s"), times.cast("long").alias("n"))
    total = lambda test: F.coalesce(F.sum(F.when(test, F.col("n"))), F.lit(0)).cast("long")
    return steps.agg(total(F.col("s").isNotNull()).alias("n_steps"), total(F.col("s") < -1e-12).alias("n_violations"))


# --- tuning ----------------------------------------------------------------------------------------


class _Trials:
    """Boosted trees fitted without one fold and judged on it. All trials read merged rows, which are kept in memory."""

    def __init__(
        self, df: DataFrame, features: Sequence[str], label: str, fold_col: str, draws: Sequence[Mapping], folds: int, seed: int,
        parallelism: int, per_task: int | None = None,
    ) -> None:
        self.assembler, self.label, self.seed, self.folds, self.parallelism = _assembler(features), label, seed, folds, parallelism
        columns = [*features, label, fold_col]
        merged = cut_lineage(merged_rows(_labelled(df, label), columns, per_task=per_task))
        self.data = {}
        for n in {1, *map(_points, draws)}:
            points = merged if n == 1 else merged_rows(merged, columns, n, WEIGHT, per_task)
            self.data[n] = cut_lineage(self.assembler.transform(points).select(FEATURES, label, fold_col, WEIGHT))
        self.evaluator = BinaryClassificationEvaluator(labelCol=label, weightCol=WEIGHT, metricName="areaUnderROC", numBins=0)
        self.train = {(n, k): d.where(F.col(fold_col) != k).persist() for n, d in self.data.items() for k in range(folds)}
        self.test = [self.data[1].where(F.col(fold_col) == k).persist() for k in range(folds)]

    def __enter__(self) -> _Trials:
        return self

    def __exit__(self, *_) -> None:
        for part in (*self.train.values(), *self.test):
            part.unpersist()

    def _one(self, job: tuple[Mapping, int, int]) -> float:
        params, rounds, fold = job
        model = _classifier(self.label, self.seed, {**params, "maxIter": rounds}).fit(self.train[_points(params), fold])
        return self.evaluator.evaluate(model.transform(self.test[fold]))

    def means(self, draws: Sequence[Mapping], rounds: Sequence[int]) -> list[float]:
        """The mean AUC over the folds of every draw with its number of rounds. Long fits begin first."""
        jobs = [(p, r, k) for p, r in zip(draws, rounds) for k in range(self.folds)]
        order = sorted(range(len(jobs)), key=lambda i: -jobs[i][1] * jobs[i][0].get("maxDepth", 5))
        with ThreadPool(self.parallelism) as pool:
            found = dict(zip(order, pool.map(self._one, [jobs[i] for i in order], chunksize=1)))
        return [sum(found[i * self.folds + k] for k in range(self.folds)) / self.folds for i in range(len(draws))]

    def refit(self, params: Mapping) -> PipelineModel:
        return PipelineModel([self.assembler, _classifier(self.label, self.seed, params).fit(self.data[_points(params)])])


def tune_gbt(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    fold_col: str,
    grid: Mapping[str, Sequence] = TUNING_GRID,
    draws: int = TUNING_DRAWS,
    folds: int = TUNING_FOLDS,
    seed: int = 42,
    parallelism: int = TUNING_PARALLELISM,
) -> tuple[PipelineModel, dict, list[tuple[dict, float]]]:
    """Random search by cross-validated AUC over the folds in ``fold_col``; refits the best on all rows.

    Every draw is fitted on every fold with all of its own rounds. ``parallelism`` fits run side by side; few points go to few
    tasks, because a round of a small table costs mostly what its tasks cost to start.
    """
    chosen = draw_parameters(grid, draws, seed)
    default = GBTClassifier().getOrDefault("maxIter")
    with _Trials(df, features, label, fold_col, chosen, folds, seed, parallelism, POINTS_PER_TASK) as trials:
        scores = list(zip(chosen, trials.means(chosen, [p.get("maxIter", default) for p in chosen])))
        best = max(range(len(scores)), key=lambda i: scores[i][1])
        return trials.refit(chosen[best]), chosen[best], scores


def tune_gbt_by_rounds(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    fold_col: str,
    grid: Mapping[str, Sequence] = TUNING_GRID,
    draws: int = TUNING_DRAWS,
    folds: int = TUNING_FOLDS,
    seed: int = 42,
    parallelism: int = 4,
    first_rounds: int = 5,
    factor: int = 3,
    refit: bool = True,
) -> tuple[PipelineModel | None, dict, list[tuple[dict, int, float]]]:
    """Random search by successive halving: every draw is cross-validated with a few rounds, the best 1 / ``factor`` of them
    with ``factor`` times as many, until one is left or all have their own number of rounds.

    Returns the best draw refitted on all rows with its own number of rounds (None without ``refit``), the draw, and
    ``(draw, rounds, mean AUC)`` of every trial. All rows are used in every trial; what a draw that is dropped early would
    have reached with all its rounds isn't known.
    """
    alive, rounds, found = draw_parameters(grid, draws, seed), first_rounds, []
    with _Trials(df, features, label, fold_col, alive, folds, seed, parallelism) as trials:
        while True:
            own = [min(rounds, p.get("maxIter", rounds)) for p in alive]
            means = trials.means(alive, own)
            found += list(zip(alive, own, means))
            ranked = sorted(range(len(alive)), key=lambda i: (-means[i], i))
            done = len(alive) == 1 or all(r < rounds for r in own)
            alive = [alive[i] for i in ranked[: 1 if done else math.ceil(len(alive) / factor)]]
            if done or len(alive) == 1:
                break
            rounds *= factor
        return trials.refit(alive[0]) if refit else None, alive[0], found


# --- tree attribution ------------------------------------------------------------------------------


@dataclass
class _Tree:
    """A tree as arrays over its nodes, the root first; leaves have feature -1. ``rows`` counts training rows."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    rows: np.ndarray


def _leaf_values(value: float, shares: Sequence[float], known: np.ndarray) -> np.ndarray:
    """Shapley values of one leaf, one row per path feature and one column per entry of ``known``.

    Bit j of an entry tells whether the row goes the leaf's way on path feature j. A feature outside the coalition keeps
    the leaf with its training share, a feature inside with its bit. The weighted sum over coalitions is the integral over
    [0, 1] of the product of share * (1 - t) + bit * t of the other features; Gauss nodes make it exact.
    """
    m = len(shares)
    share = np.array(shares)[:, None]
    bits = ((known[None, :] >> np.arange(m)[:, None]) & 1).astype(float)
    nodes, weights = np.polynomial.legendre.leggauss((m + 1) // 2)
    total = np.zeros_like(bits)
    for t, w in zip((nodes + 1.0) / 2.0, weights / 2.0):
        factors = share * (1.0 - t) + bits * t
        total += w * factors.prod(axis=0) / factors
    return value * (bits - share) * total


def _add_tree(tree: _Tree, x: np.ndarray, out: np.ndarray) -> None:
    """Add the Shapley values of one tree for the columns of ``x`` (features, rows) to ``out``.

    One walk down the tree: each node holds, per row, a bit for every feature of its path. A leaf depends on these bits
    alone, so it is worked out once per combination and looked up by row.
    """
    todo = [(0, np.zeros(x.shape[1], dtype=np.int32), [], [])]
    while todo:
        node, known, path, shares = todo.pop()
        f = tree.feature[node]
        if f < 0:
            if path:
                if 1 << len(path) <= len(known):
                    found, at = np.arange(1 << len(path)), known.astype(np.intp)
                else:
                    found, at = np.unique(known, return_inverse=True)
                for j, phi in zip(path, _leaf_values(tree.value[node], shares, found)):
                    out[j] += phi.take(at)
            continue
        goes_left = x[f] <= tree.cut[node]
        for child, goes in ((tree.left[node], goes_left), (tree.right[node], ~goes_left)):
            kept = tree.rows[child] / tree.rows[node]
            if f in path:
                j = path.index(f)
                below = known & ~((~goes).astype(np.int32) << j)
                todo.append((child, below, path, [*shares[:j], shares[j] * kept, *shares[j + 1 :]]))
            else:
                todo.append((child, known | (goes.astype(np.int32) << len(path)), [*path, f], [*shares, kept]))


def tree_attributions(
    model: PipelineModel, df: DataFrame, name: str = "attributions", base: str = "base_value", suffix: str = ""
) -> DataFrame:
    """``df`` with the log-odds contribution of every feature and the base value, exact along tree paths.

    Attributions plus base value equal the log-odds of the row. The trees are small and travel with the
    task; rows are handled in Arrow batches.
    """
    features = feature_names(model)
    trees = tree_arrays(model.stages[1])

    @F.pandas_udf("array<double>")
    def explain(vectors: pd.Series) -> pd.Series:
        # Encoded rows repeat; each different one is explained once.
        x, at = np.unique(np.stack(vectors.to_numpy()), axis=0, return_inverse=True)
        columns = np.ascontiguousarray(x.T)
        values = np.zeros_like(columns)
        for tree in trees:
            _add_tree(tree, columns, values)
        return pd.Series(list(np.ascontiguousarray(values.T)[at.ravel()]))

    # Only the model's inputs travel to the batch and only numbers come back; names are added by Spark.
    inputs = F.array(*[F.col(f + suffix).cast("double") for f in features])
    cells = [F.struct(F.lit(f).alias("feature"), F.col("__phi")[i].alias("value")) for i, f in enumerate(features)]
    explained = df.withColumn("__phi", explain(inputs)).withColumns({name: F.array(*cells), base: F.lit(base_value(trees))})
    return explained.drop("__phi")


def base_value(trees: Sequence[_Tree]) -> float:
    """The expected log-odds when no feature is known."""
    return float(sum((t.value * t.rows)[t.feature < 0].sum() / t.rows[0] for t in trees))


def tree_arrays(gbt: GBTClassificationModel) -> list[_Tree]:
    """All trees in log-odds: the margin F gives p = 1 / (1 + exp(-2 F)), hence the factor 2.

    The nodes are read from the saved model, as one table instead of one call per node.
    """
    spark = SparkSession.getActiveSession()
    path = scratch_path(spark, "trees")
    gbt.save(path)
    nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    split = [F.col("split.featureIndex").alias("feature"), F.get("split.leftCategoriesOrThreshold", 0).alias("cut")]
    table = nodes.select(
        "treeID", "id", "leftChild", "rightChild", "prediction", F.col("impurityStats")[0].alias("rows"), *split
    ).toPandas()
    out = []
    for tree, part in table.sort_values(["treeID", "id"]).groupby("treeID"):
        place = pd.Series(np.arange(len(part)), index=part["id"])
        inner = part["leftChild"].to_numpy() >= 0
        child = lambda c: place.reindex(part[c]).fillna(-1).to_numpy(dtype=np.int64)
        out.append(
            _Tree(
                np.where(inner, part["feature"], -1).astype(np.int64), np.where(inner, part["cut"], np.nan).astype(float), child("leftChild"),
                child("rightChild"), 2.0 * gbt.treeWeights[tree] * part["prediction"].to_numpy(dtype=float), part["rows"].to_numpy(dtype=float),
            )
        )
    return out
