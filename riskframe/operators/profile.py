"""Distribution profiles and model-quality aggregates."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from riskframe.functions.binning import histogram_bin
from riskframe.operators.lookup import lookup
from riskframe.operators.orderstats import as_value, group_quantiles, population_ks, population_union
from riskframe.operators.rows import numeric_columns, string_columns
from riskframe.session import cut_lineage

GRID_POINTS = 200
# Different values of one group that a task adds up at a time.
DENSITY_ROWS = 100_000
# Equal ranges a numeric column is cut into when it is compared with a category column.
PAIR_BINS = 10
LOG_CLIP = 2.0**-52
_REPORT = "kind string, name string, score double"
# Sums over the rows that hold both sides of a pair, about the columns' means.
_MOMENTS = ["n", "sx", "sy", "sxx", "syy", "sxy"]


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    """``(label, n, pct)`` per class, in class order."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    total = F.lit(counts.agg(F.sum("n")).first()[0])
    return counts.select(label, "n", (F.col("n") / total * 100.0).alias("pct")).orderBy(label)


def event_rate(df: DataFrame, category: str, label: str) -> DataFrame:
    return df.groupBy(category).agg(F.count(label).alias("n"), F.avg(label).alias("event_rate")).orderBy(category)


def value_range(df: DataFrame, column: str) -> tuple[float, float] | None:
    row = df.agg(F.min(as_value(column)), F.max(as_value(column))).first()
    return None if row[0] is None else (row[0], row[1])


def grouped_histogram(df: DataFrame, column: str, group: str, bins: int = 50) -> DataFrame:
    """``(group, bin_id, lo, hi, n)``: equal-width bins over the whole column, counted per group."""
    span = value_range(df, column)
    if span is None:
        return df.sparkSession.createDataFrame([], f"{group} string, bin_id int, lo double, hi double, n long")
    low, high = span
    width = (high - low) / bins
    counted = (
        df.select(group, histogram_bin(as_value(column), low, high, bins).alias("bin_id"))
        .where(F.col("bin_id").isNotNull())
        .groupBy(group, "bin_id")
        .agg(F.count("*").alias("n"))
    )
    return counted.select(
        group, "bin_id", (F.lit(low) + F.col("bin_id") * F.lit(width)).alias("lo"),
        (F.lit(low) + (F.col("bin_id") + 1) * F.lit(width)).alias("hi"), "n",
    )


def density_grid(df: DataFrame, column: str, group: str, points: int = GRID_POINTS) -> DataFrame:
    """Gaussian kernel density of each group on its own grid: ``(group, grid_id, x, density)``.

    Bandwidth by Scott's rule; densities are scaled by the group's share of all rows. Groups of one value have none.
    Equal values are merged, and a group's values are dealt out in parts of bounded size, each of which sends one row
    per grid point: neither many groups nor a hot one gather in a task or on the driver.
    """
    data = df.select(group, as_value(column).alias("v")).where(F.col("v").isNotNull() & F.col(group).isNotNull())
    moments = data.groupBy(group).agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"), F.stddev_samp("v").alias("sd"))
    stats = cut_lineage(moments.where((F.col("sd") > 0) & ~F.isnan("sd")))
    total = stats.agg(F.sum("n")).first()[0] or 0
    stats = stats.withColumns({"step": (F.col("hi") - F.col("lo")) / F.lit(points - 1), "width": F.col("sd") * F.pow("n", F.lit(-0.2))})
    key = stats.select(F.col(group).cast("string").alias("key"), "lo", "step", "width", "n")
    values = data.groupBy(group, "v").agg(F.count("*").alias("times"))
    placed = lookup(values, key, F.col(group).cast("string"), ["lo", "step", "width", "n"], weight="n").where("width is not null")
    part = F.pmod(F.xxhash64("v"), F.ceil(F.col("n") / F.lit(DENSITY_ROWS))).alias("part")
    group_type = df.schema[group].dataType.simpleString()

    def kernels(rows: pd.DataFrame) -> pd.DataFrame:
        low, step, width = (rows[c].iloc[0] for c in ("lo", "step", "width"))
        grid = low + np.arange(points) * step
        found, times = rows["v"].to_numpy(), rows["times"].to_numpy()
        sums = np.zeros(points)
        for at in range(0, len(found), 4096):
            z = (grid[None, :] - found[at : at + 4096, None]) / width
            sums += times[at : at + 4096] @ np.exp(-0.5 * z * z)
        scale = 1.0 / (total * width * math.sqrt(2 * math.pi))
        return pd.DataFrame({"g": rows["g"].iloc[0], "grid_id": np.arange(points, dtype=np.int32), "x": grid, "density": sums * scale})

    parts = placed.select(F.col(group).alias("g"), part, "v", "times", "lo", "step", "width").groupBy("g", "part")
    summed = parts.applyInPandas(kernels, f"g {group_type}, grid_id int, x double, density double")
    return summed.groupBy(F.col("g").alias(group), "grid_id", "x").agg(F.sum("density").alias("density"))


def box_stats(df: DataFrame, column: str, group: str) -> DataFrame:
    """Quartiles, whiskers (last points inside 1.5 IQR) and outlier count per group."""
    data = df.select(group, as_value(column).alias("v")).where(F.col("v").isNotNull() & F.col(group).isNotNull())
    frame = cut_lineage(group_quantiles(data, "v", group, {"q1": 0.25, "median": 0.5, "q3": 0.75}))
    key = frame.select(F.col(group).cast("string").alias("key"), "q1", "median", "q3", "n")
    joined = lookup(data, key, F.col(group).cast("string"), ["q1", "median", "q3"], weight="n")
    fence = F.lit(1.5) * (F.col("q3") - F.col("q1"))
    inside = (F.col("v") >= F.col("q1") - fence) & (F.col("v") <= F.col("q3") + fence)
    return joined.groupBy(group, "q1", "median", "q3").agg(
        F.count("*").alias("n"),
        F.min(F.when(inside, F.col("v"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("v"))).alias("whisker_high"),
        F.count_if(~inside).alias("n_outliers"),
    )


def confusion_matrix(df: DataFrame, label: str, probability: str, threshold: float = 0.5) -> DataFrame:
    """Four rows ``(actual, predicted, n)``, also where a cell is empty. Predicted 1 is strictly above."""
    predicted = (F.col(probability) > F.lit(threshold)).cast("int")
    counted = (
        df.where(F.col(label).isNotNull() & F.col(probability).isNotNull())
        .groupBy(F.col(label).cast("int").alias("actual"), predicted.alias("predicted"))
        .agg(F.count("*").alias("n"))
    )
    spine = df.sparkSession.createDataFrame([(a, p) for a in (0, 1) for p in (0, 1)], "actual int, predicted int")
    return spine.join(F.broadcast(counted), ["actual", "predicted"], "left").na.fill(0, subset=["n"])


def f1_score(df: DataFrame, label: str, probability: str, threshold: float = 0.5, weight: str | None = None) -> DataFrame:
    """One row ``(tp, fp, fn, tn, f1)``: F1 of class 1, 0 when nothing is positive. A row counts ``weight`` times."""
    times = F.lit(1) if weight is None else F.col(weight)
    count_if = lambda test: F.coalesce(F.sum(F.when(test, times.cast("long"))), F.lit(0))
    actual, predicted = F.col(label) == 1, F.col(probability) > F.lit(threshold)
    counted = df.where(F.col(label).isNotNull() & F.col(probability).isNotNull()).agg(
        count_if(actual & predicted).alias("tp"),
        count_if(~actual & predicted).alias("fp"),
        count_if(actual & ~predicted).alias("fn"),
        count_if(~actual & ~predicted).alias("tn"),
    )
    bottom = 2 * F.col("tp") + F.col("fp") + F.col("fn")
    return counted.withColumn("f1", F.when(bottom > 0, 2 * F.col("tp") / bottom).otherwise(F.lit(0.0)))


def log_loss(df: DataFrame, label: str, probability: str) -> DataFrame:
    p = F.greatest(F.least(F.col(probability), F.lit(1.0 - LOG_CLIP)), F.lit(LOG_CLIP))
    loss = F.when(F.col(label) == 1, -F.ln(p)).otherwise(-F.ln(F.lit(1.0) - p))
    valid = df.where(F.col(label).isNotNull() & F.col(probability).isNotNull())
    return valid.agg(F.avg(loss).alias("log_loss"), F.count("*").alias("n"))


def alert_counters(df: DataFrame, probability: str, threshold: float = 0.5) -> DataFrame:
    """One row ``(total, alerts, approvals)``; anomalous rows count like the others."""
    alert = F.coalesce(F.col(probability) > F.lit(threshold), F.lit(False))
    return df.agg(F.count("*").alias("total"), F.count_if(alert).alias("alerts"), F.count_if(~alert).alias("approvals"))


def attribution_summary(df: DataFrame, attributions: str) -> DataFrame:
    """``(feature, n, mean_abs, mean, min, max)`` of an array of (feature, value) structs."""
    value = F.col("a.value")
    return (
        df.select(F.explode(attributions).alias("a"))
        .groupBy(F.col("a.feature").alias("feature"))
        .agg(
            F.count("*").alias("n"), F.avg(F.abs(value)).alias("mean_abs"), F.avg(value).alias("mean"),
            F.min(value).alias("min"), F.max(value).alias("max"),
        )
    )


# --- synthetic quality -----------------------------------------------------------------------------


def quality_report(real: DataFrame, synthetic: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(kind, name, score)``: column shapes, then pair trends.

    Shapes: KS complement of numeric columns, total-variation complement of category columns. Trends:
    correlation similarity of numeric pairs, contingency similarity of the others (numeric sides cut
    into equal ranges of the real data). A pair with a constant side and a column empty on a side score null or are left out.
    """
    names = [c for c in (columns or real.columns) if c in synthetic.columns]
    numeric = [c for c in numeric_columns(real) if c in names]
    categories = [c for c in string_columns(real) if c in names]
    return population_quality(population_union(real, synthetic, numeric + categories), numeric, categories)


def population_quality(both: DataFrame, numeric: Sequence[str], categories: Sequence[str]) -> DataFrame:
    """:func:`quality_report` of one table whose column ``population`` is 0 (real) or 1.

    Any number of columns takes five scans: two for the KS distances, one for sizes and spans, one for all correlations
    and one for all categories and their pairs.
    """
    if not numeric and not categories:
        return both.sparkSession.createDataFrame([], _REPORT)
    is_real = F.col("population") == 0
    spans = both.agg(
        F.count_if(is_real).alias("n_r"), F.count_if(~is_real).alias("n_s"),
        *[
            f.alias(f"{n}{i}") for i, c in enumerate(numeric)
            for n, f in (("lo", F.min(F.when(is_real, as_value(c)))), ("hi", F.max(F.when(is_real, as_value(c)))), ("mean", F.avg(as_value(c))))
        ],
    ).first()
    parts = []
    if numeric:
        shapes = population_ks(both, numeric)
        parts.append(shapes.select(F.lit("column_shape").alias("kind"), F.col("feature").alias("name"), F.col("inverted_ks").alias("score")))
    if len(numeric) > 1:
        parts.append(_correlation_gaps(both, numeric, [spans[f"mean{i}"] or 0.0 for i in range(len(numeric))]))
    if categories:
        parts.append(_overlaps(both, numeric, categories, spans))
    return reduce(DataFrame.unionByName, parts)


def _overlaps(both: DataFrame, numeric: Sequence[str], categories: Sequence[str], spans) -> DataFrame:
    """1 - total variation distance between the populations, per category column and per pair with one."""
    # Missing values are a category of their own, so every combination covers all rows.
    coded = [_text(F.col(c).cast("string")) for c in categories]
    binned = [i for i in range(len(numeric)) if spans[f"lo{i}"] is not None]
    coded += [_text(histogram_bin(as_value(numeric[i]), spans[f"lo{i}"], spans[f"hi{i}"], PAIR_BINS).cast("string")) for i in binned]
    labels = [*categories, *[numeric[i] for i in binned]]
    k = len(categories)
    cells = [(i, i) for i in range(k)] + [(i, j) for i in range(k) for j in range(i + 1, k)] + [(j, i) for j in range(k, len(labels)) for i in range(k)]
    names = [labels[i] if i == j else f"{labels[i]}|{labels[j]}" for i, j in cells]
    kinds = ["column_shape" if i == j else "pair_trend" for i, j in cells]
    width = len(coded)

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            synthetic = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            columns = [batch.column(1 + i).dictionary_encode() for i in range(width)]
            codes = [c.indices.to_numpy(zero_copy_only=False).astype(np.int64) for c in columns]
            found = []
            for cell, (i, j) in enumerate(cells):
                size = len(columns[j].dictionary)
                # Population, then both codes: one number per row, counted within the batch.
                key, n = np.unique((codes[i] * size + codes[j]) * 2 + synthetic, return_counts=True)
                pair = key >> 1
                taken = [columns[i].dictionary.take(pa.array(pair // size)), columns[j].dictionary.take(pa.array(pair % size))]
                found.append((np.full(len(key), cell, np.int32), *taken, np.where(key & 1, 0, n), np.where(key & 1, n, 0)))
            arrays = [pa.array(np.concatenate([f[0] for f in found])), *[pa.concat_arrays([f[k] for f in found]) for k in (1, 2)]]
            arrays += [pa.array(np.concatenate([f[k] for f in found])) for k in (3, 4)]
            yield pa.RecordBatch.from_arrays(arrays, names=["cell", "a", "b", "r", "s"])

    counted = (
        both.select(F.col("population").cast("int"), *[c.alias(f"c{i}") for i, c in enumerate(coded)])
        .mapInArrow(counts, "cell int, a string, b string, r long, s long")
        .groupBy("cell", "a", "b")
        .agg(F.sum("r").alias("r"), F.sum("s").alias("s"))
    )
    if spans["n_r"] and spans["n_s"]:
        gap = F.abs(F.col("r") / F.lit(float(spans["n_r"])) - F.col("s") / F.lit(float(spans["n_s"])))
        score = F.lit(1.0) - F.lit(0.5) * F.sum(gap)
    else:
        score = F.first(F.lit(None).cast("double"))
    found = counted.groupBy("cell").agg(score.alias("score"))
    return found.select(F.get(F.lit(kinds), "cell").alias("kind"), F.get(F.lit(names), "cell").alias("name"), "score")


def _text(code: Column) -> Column:
    return F.coalesce(code, F.lit("\u0000null"))


def _correlation_gaps(both: DataFrame, numeric: Sequence[str], means: Sequence[float]) -> DataFrame:
    """Correlation similarity of every numeric pair over the rows that hold both; null where a side is constant.

    Every task adds up the moments of all pairs and sends one row per population and pair.
    """
    width = len(numeric)
    first, second = np.triu_indices(width, 1)
    centre = np.array(means, dtype=float)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, 6, len(first)))
        for batch in batches:
            population = batch.column(0).to_numpy(zero_copy_only=False)
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, width)
            for p in (0, 1):
                part = x[population == p]
                held = ~np.isnan(part)
                part, held = np.where(held, part - centre, 0.0), held.astype(float)
                squares = part * part
                found = (held.T @ held, part.T @ held, held.T @ part, squares.T @ held, held.T @ squares, part.T @ part)
                sums[p] += np.stack([f[first, second] for f in found])
        for p in (0, 1):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(first), p, np.int32)), pa.array(np.arange(len(first), dtype=np.int32)), *[pa.array(s) for s in sums[p]]],
                names=["population", "pair", *_MOMENTS],
            )

    schema = "population int, pair int, " + ", ".join(f"{m} double" for m in _MOMENTS)
    values = both.select(F.col("population").cast("int"), F.array(*[as_value(c) for c in numeric]).alias("x"))
    totals = values.mapInArrow(moments, schema).groupBy("population", "pair").agg(*[F.sum(m).alias(m) for m in _MOMENTS])
    spread = [_variance("sx", "sxx"), _variance("sy", "syy")]
    covariance = F.col("sxy") / F.col("n") - F.col("sx") / F.col("n") * F.col("sy") / F.col("n")
    both_vary = (F.col("n") > 0) & (spread[0] > 0) & (spread[1] > 0)
    each = totals.select("population", "pair", F.when(both_vary, covariance / F.sqrt(spread[0] * spread[1])).alias("corr"))
    gap = F.abs(F.max(F.when(F.col("population") == 0, F.col("corr"))) - F.max(F.when(F.col("population") == 1, F.col("corr"))))
    names = F.lit([f"{numeric[i]}|{numeric[j]}" for i, j in zip(first, second)])
    scored = each.groupBy("pair").agg((F.lit(1.0) - gap / 2.0).alias("score"))
    return scored.select(F.lit("pair_trend").alias("kind"), F.get(names, "pair").alias("name"), "score")


def _variance(total: str, squares: str) -> Column:
    """Zero where rounding is all there is."""
    mean_square = F.try_divide(F.col(squares), F.col("n"))
    mean = F.try_divide(F.col(total), F.col("n"))
    found = mean_square - mean * mean
    return F.when(found > mean_square * F.lit(1e-13), found).otherwise(F.lit(0.0))


def quality_score(real: DataFrame, synthetic: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row ``(column_shapes, pair_trends, score)``; the score is the mean of the two averages."""
    by_kind = quality_report(real, synthetic, columns).agg(
        F.avg(F.when(F.col("kind") == "column_shape", F.col("score"))).alias("column_shapes"),
        F.avg(F.when(F.col("kind") == "pair_trend", F.col("score"))).alias("pair_trends"),
    )
    both = F.array_compact(F.array("column_shapes", "pair_trends"))
    mean = F.aggregate(both, F.lit(0.0), lambda s, x: s + x) / F.greatest(F.size(both), F.lit(1))
    return by_kind.withColumn("score", F.when(F.size(both) > 0, mean))
