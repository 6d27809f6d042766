"""Exact order statistics and running counts without a single-task sort.

``Window.orderBy`` without a partition sends every row to one task. The helpers here cut the value
range into buckets (cut points from a bounded sketch, written into the plan as literals so that a
retried task assigns the same bucket), count per bucket with map-side partial aggregation, and only
sort inside buckets. The result is exact wherever the cut points fall.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from riskframe.functions.binning import add_cut_index

# Distinct values a single sort task is given before its range is cut further.
DISTINCT_PER_TASK = 1_000_000
# Rows per bucket of a running count, and the largest number of buckets written into a plan.
ROWS_PER_BUCKET = 200_000
MAX_BUCKETS = 4_096
SKETCH_BUCKETS = 64
SKETCH_ACCURACY = 1_000
DISTINCT_RSD = 0.05


def as_value(column: Column | str) -> Column:
    """A double without NaN; NaN is missing data here."""
    col = (F.col(column) if isinstance(column, str) else column).cast("double")
    return F.when(~F.isnan(col), col)


@dataclass
class Sketch:
    """Bounded summary of one numeric column."""

    rows: int
    distinct: int
    low: float | None
    high: float | None
    cuts: list[float]


def _approximate_cuts(column: str, buckets: int) -> Column:
    shares = ", ".join(f"{i / buckets!r}D" for i in range(1, buckets))
    return F.expr(f"percentile_approx(`{column}`, array({shares}), {max(SKETCH_ACCURACY, 10 * buckets)})")


def _cut_points(quantiles: Sequence[float]) -> list[float]:
    """Distinct cut points; a value the sketch repeats is hot and gets a bucket of its own."""
    cuts = set(quantiles)
    cuts |= {math.nextafter(a, -math.inf) for a, b in zip(quantiles, quantiles[1:]) if a == b and math.isfinite(a)}
    return sorted(c for c in cuts if c != math.inf)


def named_values(df: DataFrame, values: Sequence[Column], keep: Sequence[Column] = ()) -> tuple[DataFrame, list[str]]:
    """Compute the values once per row, as columns.

    A search tree mentions its value at every node; over a plain column that costs a comparison, over
    an expression (a hash, say) it would repeat the expression in the plan and in the generated code.
    """
    named = df.select(*keep, *[v.alias(f"__v{i}") for i, v in enumerate(values)])
    return named, [f"__v{i}" for i in range(len(values))]


def sketch(df: DataFrame, values: Sequence[Column], buckets: int = SKETCH_BUCKETS) -> list[Sketch]:
    """Count, approximate distinct count, range and approximate cut points of every column in one scan."""
    named = df.select(*[v.alias(f"v{i}") for i, v in enumerate(values)])
    aggs = []
    for i in range(len(values)):
        c = F.col(f"v{i}")
        aggs += [
            F.count(c).alias(f"n{i}"),
            F.approx_count_distinct(c, DISTINCT_RSD).alias(f"d{i}"),
            F.min(c).alias(f"lo{i}"),
            F.max(c).alias(f"hi{i}"),
            _approximate_cuts(f"v{i}", buckets).alias(f"q{i}"),
        ]
    row = named.agg(*aggs).first()
    return [
        Sketch(row[f"n{i}"], row[f"d{i}"], row[f"lo{i}"], row[f"hi{i}"], _cut_points(row[f"q{i}"] or []))
        for i in range(len(values))
    ]


@dataclass
class _Range:
    """Values in ``(low, high]`` of one feature; ``before`` counts the rows below."""

    feature: int
    low: float
    high: float
    before: int
    rows: int
    distinct: int
    settled: bool = False


def select_ranks(
    df: DataFrame,
    values: Sequence[Column],
    ranks: Sequence[Sequence[int]],
    sketches: Sequence[Sketch] | None = None,
    distinct_per_task: int = DISTINCT_PER_TASK,
    buckets: int = SKETCH_BUCKETS,
) -> list[dict[int, float]]:
    """The values at the given 0-based ranks of each column, nulls left out. Exact.

    Ranges that hold a wanted rank are cut again until they are small enough for one task; each round
    reads the columns once and shuffles one row per (feature, bucket). The last round groups equal
    values first, so one value that fills a third of the table is one row.
    """
    if sketches is None:
        sketches = sketch(df, values, buckets)
    df, values = named_values(df, values)
    ranges = [
        _Range(i, -math.inf, math.inf, 0, s.rows, s.distinct) for i, s in enumerate(sketches) if s.rows and ranks[i]
    ]
    cuts = {i: s.cuts for i, s in enumerate(sketches)}
    wanted = {i: sorted({r for r in ranks[i] if 0 <= r < sketches[i].rows}) for i in range(len(values))}
    while True:
        big = [r for r in ranges if r.distinct > distinct_per_task and not r.settled]
        if not big:
            break
        small = [r for r in ranges if not (r.distinct > distinct_per_task and not r.settled)]
        ranges = small + _split(df, values, big, cuts, wanted)
        # A range that could not be cut further would loop for ever.
        again = [r for r in ranges if r.distinct > distinct_per_task and not r.settled]
        if again:
            cuts = _range_cuts(df, values, again, buckets)
    return _pick(df, values, ranges, wanted)


def _in_range(name: str, r: _Range) -> Column:
    value = F.col(name)
    test = value.isNotNull()
    if r.low != -math.inf:
        test = test & (value > F.lit(r.low))
    if r.high != math.inf:
        test = test & (value <= F.lit(r.high))
    return test


def _range_id(values: Sequence[str], ranges: Sequence[_Range], feature: int) -> Column:
    out = F.lit(None).cast("int")
    for i, r in enumerate(ranges):
        if r.feature == feature:
            out = F.when(_in_range(values[feature], r), F.lit(i)).otherwise(out)
    return out


def _long(df: DataFrame, values: Sequence[str], ranges: Sequence[_Range], cuts: Mapping[int, Sequence[float]] | None = None) -> DataFrame:
    """Rows of the given ranges only, as (range_id, value) and, with ``cuts``, their bucket."""
    features = sorted({r.feature for r in ranges})
    cells = []
    for f in features:
        cell = {"range_id": _range_id(values, ranges, f), "value": F.col(values[f])}
        if cuts is not None:
            df = add_cut_index(df, values[f], cuts[f], f"__b{f}")
            cell["bucket"] = F.col(f"__b{f}")
        cells.append(F.struct(*[c.alias(n) for n, c in cell.items()]))
    return (
        df.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*").where(F.col("range_id").isNotNull())
    )


def _split(df, values, ranges, cuts, wanted) -> list[_Range]:
    rows = (
        _long(df, values, ranges, cuts)
        .groupBy("range_id", "bucket")
        .agg(F.count("*").alias("n"), F.approx_count_distinct("value", 0.05).alias("d"))
        .collect()
    )
    out = []
    for i, r in enumerate(ranges):
        before = r.before
        edges = [-math.inf, *cuts[r.feature], math.inf]
        for row in sorted((x for x in rows if x["range_id"] == i), key=lambda x: x["bucket"]):
            if any(before <= w < before + row["n"] for w in wanted[r.feature]):
                low, high = max(r.low, edges[row["bucket"]]), min(r.high, edges[row["bucket"] + 1])
                stuck = row["n"] == r.rows
                out.append(_Range(r.feature, low, high, before, row["n"], row["d"], stuck))
            before += row["n"]
    return out


def _range_cuts(df, values, ranges, buckets) -> dict[int, list[float]]:
    rows = (
        _long(df, values, ranges)
        .groupBy("range_id")
        .agg(_approximate_cuts("value", buckets).alias("q"))
        .collect()
    )
    cuts: dict[int, set[float]] = {}
    for row in rows:
        cuts.setdefault(ranges[row["range_id"]].feature, set()).update(_cut_points(row["q"]))
    return {f: sorted(c) for f, c in cuts.items()}


def _pick(df, values, ranges, wanted) -> list[dict[int, float]]:
    found: list[dict[int, float]] = [{} for _ in values]
    if not ranges:
        return found
    targets = []
    for i, r in enumerate(ranges):
        targets += [(i, w - r.before) for w in wanted[r.feature] if r.before <= w < r.before + r.rows]
    spark = df.sparkSession
    window = Window.partitionBy("range_id").orderBy("value")
    counts = (
        _long(df, values, ranges)
        .groupBy("range_id", "value")
        .agg(F.count("*").alias("n"))
        .withColumn("upto", F.sum("n").over(window.rowsBetween(Window.unboundedPreceding, 0)))
    )
    # At most two ranks per requested quantile and feature: small by construction.
    want = F.broadcast(spark.createDataFrame(targets, "range_id int, rank long"))
    hits = counts.join(
        want, (counts.range_id == want.range_id) & (want["rank"] < counts.upto) & (want["rank"] >= counts.upto - counts.n)
    ).select(counts.range_id, want["rank"], counts.value)
    for row in hits.collect():
        r = ranges[row["range_id"]]
        found[r.feature][row["rank"] + r.before] = row["value"]
    return found


def linear_quantiles(
    df: DataFrame,
    values: Sequence[Column],
    shares: Sequence[float],
    sketches: Sequence[Sketch] | None = None,
    **options,
) -> list[list[float]]:
    """Exact quantiles with linear interpolation between neighbouring order statistics."""
    if sketches is None:
        sketches = sketch(df, values, options.get("buckets", SKETCH_BUCKETS))
    places = [[(s.rows - 1) * p for p in shares] if s.rows else [] for s in sketches]
    ranks = [sorted({k for at in p for k in (math.floor(at), math.ceil(at))}) for p in places]
    found = select_ranks(df, values, ranks, sketches, **options)
    out = []
    for i, at_list in enumerate(places):
        out.append([_lerp(found[i][math.floor(at)], found[i][math.ceil(at)], at - math.floor(at)) for at in at_list])
    return out


def quantile_cuts(df: DataFrame, values: Sequence[Column], buckets: int, sketches: Sequence[Sketch] | None = None) -> list[list[float]]:
    """At most ``buckets - 1`` right-closed cuts of each column at its exact quantiles, none behind its last value. A value that
    holds several quantiles lies between cuts of its own."""
    if sketches is None:
        sketches = sketch(df, values)
    ranks = [sorted({math.ceil(j * s.rows / buckets) - 1 for j in range(1, buckets)} - {-1}) if s.rows else [] for s in sketches]
    found = select_ranks(df, values, ranks, sketches)
    return [[c for c in _cut_points([f[r] for r in at]) if c < s.high] if at else [] for f, at, s in zip(found, ranks, sketches)]


def _lerp(a: float, b: float, t: float) -> float:
    if a == b:
        return a
    # Interpolating from the nearer end keeps the result inside [a, b].
    return b - (b - a) * (1 - t) if t >= 0.5 else a + (b - a) * t


def group_quantiles(
    df: DataFrame, value: str, group: str, shares: Mapping[str, float], rows_per_bucket: int = ROWS_PER_BUCKET
) -> DataFrame:
    """Exact linear quantiles per group: ``(group, n, <name>...)``, for any number of groups.

    Groups are cut by value, so a group that holds a third of the rows is many (group, bucket) parts;
    equal values are merged before they move. Nothing is collected but the cut points.
    """
    summary = sketch(df, [F.col(value)])
    cuts = _bucket_cuts(df, [F.col(value)], summary, rows_per_bucket)[0]
    slim = df.where(F.col(value).isNotNull()).select(group, F.col(value).alias("__x"))
    counts = add_cut_index(slim, "__x", cuts, "__bucket").groupBy(group, "__bucket", "__x").agg(F.count("*").alias("__n"))
    part = Window.partitionBy(group, "__bucket")
    upto = part.orderBy("__x").rowsBetween(Window.unboundedPreceding, 0)
    local = counts.withColumn("__upto", F.sum("__n").over(upto))
    if cuts:
        # One row per (group, bucket): a group's window holds at most MAX_BUCKETS rows.
        totals = counts.groupBy(group, "__bucket").agg(F.sum("__n").alias("__t"))
        before = Window.partitionBy(group).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
        totals = totals.withColumn("__off", F.coalesce(F.sum("__t").over(before), F.lit(0))).withColumn(
            "__size", F.sum("__t").over(Window.partitionBy(group))
        )
        totals = totals.withColumnsRenamed({group: "__g", "__bucket": "__b"})
        same = F.col(group).eqNullSafe(F.col("__g")) & (F.col("__bucket") == F.col("__b"))
        local = local.join(totals, same).withColumn("__upto", F.col("__upto") + F.col("__off"))
    else:
        local = local.withColumn("__size", F.sum("__n").over(Window.partitionBy(group)))
    aggs = []
    for i, (name, share) in enumerate(shares.items()):
        place = (F.col("__size") - 1) * F.lit(float(share))
        for end, rank in (("a", F.floor(place)), ("b", F.ceil(place))):
            holds = (rank < F.col("__upto")) & (rank >= F.col("__upto") - F.col("__n"))
            aggs.append(F.max(F.when(holds, F.col("__x"))).alias(f"__{end}{i}"))
    ends = local.groupBy(group).agg(F.max("__size").alias("n"), *aggs)
    out = []
    for i, (name, share) in enumerate(shares.items()):
        place = (F.col("n") - 1) * F.lit(float(share))
        a, b, t = F.col(f"__a{i}"), F.col(f"__b{i}"), place - F.floor(place)
        near_b = b - (b - a) * (F.lit(1.0) - t)
        out.append(F.when(a == b, a).when(t >= 0.5, near_b).otherwise(a + (b - a) * t).alias(name))
    return ends.select(group, "n", *out)


def bucket_count(rows: int, rows_per_bucket: int = ROWS_PER_BUCKET) -> int:
    return max(1, min(MAX_BUCKETS, math.ceil(rows / rows_per_bucket)))


def running_table(
    df: DataFrame,
    values: Sequence[Column],
    measures: Mapping[str, Column],
    rows_per_bucket: int = ROWS_PER_BUCKET,
    sketches: Sequence[Sketch] | None = None,
) -> DataFrame:
    """Running totals of ``measures`` in value order, one row per (feature_id, distinct value).

    Columns: ``feature_id, value``, each measure (its total at the value), ``upto_<measure>`` (total at and below
    the value) and ``all_<measure>`` (the feature's total). One scan for the cut points and one for the counts:
    bucket totals come from the counts per value, whose shuffle Spark uses twice.
    """
    names = list(measures)
    if sketches is None:
        sketches = sketch(df, values)
    cuts = _bucket_cuts(df, values, sketches, rows_per_bucket)
    df, values = named_values(df, values, [m.alias(n) for n, m in measures.items()])
    for i, v in enumerate(values):
        df = add_cut_index(df, v, cuts[i], f"__b{i}")
    cells = [
        F.struct(F.lit(i).alias("feature_id"), F.col(f"__b{i}").alias("bucket"), F.col(v).alias("value")) for i, v in enumerate(values)
    ]
    counted = (
        df.select(*names, F.explode(F.array(*cells)).alias("cell"))
        .select("cell.*", *names)
        .where(F.col("value").isNotNull())
        .groupBy("feature_id", "bucket", "value")
        .agg(*[F.sum(n).alias(n) for n in names])
    )
    window = Window.partitionBy("feature_id", "bucket").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    local = counted.select("*", *[F.sum(n).over(window).alias(f"upto_{n}") for n in names])
    # One row per (feature, bucket): bounded by MAX_BUCKETS per feature.
    totals = counted.groupBy("feature_id", "bucket").agg(*[F.sum(n).alias(n) for n in names])
    whole = Window.partitionBy("feature_id")
    below = whole.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "feature_id", "bucket", *[F.coalesce(F.sum(n).over(below), F.lit(0)).alias(f"off_{n}") for n in names],
        *[F.sum(n).over(whole).alias(f"all_{n}") for n in names],
    )
    return local.join(F.broadcast(offsets), ["feature_id", "bucket"]).select(
        "feature_id", "value", *names, *[(F.col(f"upto_{n}") + F.col(f"off_{n}")).alias(f"upto_{n}") for n in names],
        *[f"all_{n}" for n in names],
    )


def running_counts(
    df: DataFrame,
    values: Sequence[Column],
    measures: Mapping[str, Column],
    rows_per_bucket: int = ROWS_PER_BUCKET,
    sketches: Sequence[Sketch] | None = None,
) -> tuple[DataFrame, list[dict[str, float]]]:
    """:func:`running_table` without the totals, and the totals per feature on the driver."""
    table = running_table(df, values, measures, rows_per_bucket, sketches)
    totals = {r["feature_id"]: r for r in table.groupBy("feature_id").agg(*[F.first(f"all_{n}").alias(n) for n in measures]).collect()}
    sums = [{n: totals[i][n] if i in totals else 0 for n in measures} for i in range(len(values))]
    return table.drop(*[f"all_{n}" for n in measures]), sums


def _bucket_cuts(df, values, sketches, rows_per_bucket) -> list[list[float]]:
    """Cut points for buckets of about ``rows_per_bucket`` distinct values; none where one is enough."""
    need = [bucket_count(s.distinct, rows_per_bucket) for s in sketches]
    if max(need, default=1) > SKETCH_BUCKETS:
        sketches = sketch(df, values, max(need))
    return [[] if k == 1 else s.cuts[:: max(1, len(s.cuts) // k)] for k, s in zip(need, sketches)]


def dense_index(df: DataFrame, order: Sequence[str], name: str = "idx", rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """0-based position of each row in the order of its key columns.

    Buckets follow the first column; its values should be close to unique (a key).
    """
    if isinstance(df.schema[order[0]].dataType, T.StringType):
        first = F.col(order[0])
        # Cut points of a text key: the values with the smallest hashes, a fixed-size sample.
        k = bucket_count(df.count(), rows_per_bucket)
        sample = df.select(first.alias("k")).where("k is not null").orderBy(F.xxhash64("k"), "k").limit(k - 1)
        cuts = sorted({r["k"] for r in sample.collect()}) if k > 1 else []
    else:
        first = as_value(order[0])
        cuts = _bucket_cuts(df, [first], sketch(df, [first]), rows_per_bucket)[0]
    bucketed = add_cut_index(df.withColumn("__first", first), "__first", cuts, "__bucket").drop("__first")
    bucketed = bucketed.withColumn("__bucket", F.coalesce("__bucket", F.lit(-1)))
    window = Window.partitionBy("__bucket").orderBy(*order)
    numbered = bucketed.withColumn(name, F.row_number().over(window).cast("long") - 1)
    if not cuts:
        return numbered.drop("__bucket")
    rows = sorted(bucketed.groupBy("__bucket").count().collect())
    offsets, total = [], 0
    for bucket, n in rows:
        offsets.append((bucket, total))
        total += n
    small = F.broadcast(df.sparkSession.createDataFrame(offsets, "__bucket int, __off long"))
    return numbered.join(small, "__bucket").withColumn(name, F.col(name) + F.col("__off")).drop("__bucket", "__off")


# --- metrics built on running counts ---------------------------------------------------------------


def inverted_ks(
    real: DataFrame, synthetic: DataFrame, columns: Sequence[str] | None = None, rows_per_bucket: int = ROWS_PER_BUCKET
) -> DataFrame:
    """1 - KS distance per column: ``(feature, ks, inverted_ks)``. Columns absent in synthetic are skipped."""
    from riskframe.operators.rows import numeric_columns

    names = [c for c in (columns or numeric_columns(real)) if c in synthetic.columns]
    spark = real.sparkSession
    if not names:
        return spark.createDataFrame([], "feature string, ks double, inverted_ks double")
    return population_ks(population_union(real, synthetic, names), names, rows_per_bucket)


def population_ks(both: DataFrame, columns: Sequence[str], rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """:func:`inverted_ks` of one table whose column ``population`` is 0 (reference) or 1; columns empty on a side are left out."""
    names = list(columns)
    measures = {"r": (F.col("population") == 0).cast("long"), "s": (F.col("population") == 1).cast("long")}
    running = running_table(both, [as_value(n) for n in names], measures, rows_per_bucket)
    gap = F.abs(F.col("upto_r") / F.col("all_r") - F.col("upto_s") / F.col("all_s"))
    feature = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("feature_id") + 1)
    return (
        running.where("all_r > 0 and all_s > 0")
        .groupBy("feature_id")
        .agg(F.max(gap).alias("ks"))
        .select(feature.alias("feature"), "ks", (F.lit(1.0) - F.col("ks")).alias("inverted_ks"))
    )


def mean_inverted_ks(real: DataFrame, synthetic: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: the mean over columns, 0.0 when no column is shared."""
    per_column = inverted_ks(real, synthetic, columns)
    return per_column.agg(
        F.coalesce(F.avg("inverted_ks"), F.lit(0.0)).alias("inverted_ks"), F.count("*").alias("n_columns")
    )


def population_union(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Both populations in one table: 0 is the reference, 1 the current one."""
    left = reference.select(*[F.col(c) for c in columns], F.lit(0).alias("population"))
    right = current.select(*[F.col(c) for c in columns], F.lit(1).alias("population"))
    return left.unionByName(right)


def _score_counts(df: DataFrame, label: str, scores: Sequence[str], rows_per_bucket: int, weight: str | None = None):
    valid = df.where(F.col(label).isNotNull())
    times = F.lit(1) if weight is None else F.col(weight).cast("long")
    return running_table(
        valid,
        [as_value(s) for s in scores],
        {"pos": (F.col(label) == 1).cast("long") * times, "neg": (F.col(label) != 1).cast("long") * times},
        rows_per_bucket,
    )


def auc(
    df: DataFrame, label: str, scores: Sequence[str] | str, rows_per_bucket: int = ROWS_PER_BUCKET, weight: str | None = None
) -> DataFrame:
    """Exact ROC AUC of each score, ties at half weight: ``(score, n_pos, n_neg, auc)``. A row counts ``weight`` times."""
    scores = [scores] if isinstance(scores, str) else list(scores)
    running = _score_counts(df, label, scores, rows_per_bucket, weight)
    pairs = F.col("pos") * (F.col("upto_neg") - F.col("neg") / F.lit(2.0))
    names = F.element_at(F.array(*[F.lit(s) for s in scores]), F.col("feature_id") + 1)
    both = F.col("n_pos").cast("double") * F.col("n_neg")
    return (
        running.groupBy("feature_id")
        .agg(F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"), F.sum(pairs).alias("wins"))
        .select(names.alias("score"), "n_pos", "n_neg", F.when(both > 0, F.col("wins") / both).alias("auc"))
    )


def roc_points(df: DataFrame, label: str, scores: Sequence[str] | str, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """ROC curve: one point per distinct threshold (score >= threshold is positive) and the origin."""
    scores = [scores] if isinstance(scores, str) else list(scores)
    running = _score_counts(df, label, scores, rows_per_bucket)
    # One row per score, also for one without any value.
    spine = df.sparkSession.createDataFrame(list(enumerate(scores)), "feature_id int, score string")
    sizes = running.groupBy("feature_id").agg(F.first("all_pos").alias("n_pos"), F.first("all_neg").alias("n_neg"))
    sizes = spine.join(F.broadcast(sizes), "feature_id", "left").na.fill(0, ["n_pos", "n_neg"])
    points = running.join(F.broadcast(spine), "feature_id").withColumnsRenamed({"all_pos": "n_pos", "all_neg": "n_neg"}).select(
        "score",
        F.col("value").alias("threshold"),
        (F.col("n_pos") - F.col("upto_pos") + F.col("pos")).alias("tp"),
        (F.col("n_neg") - F.col("upto_neg") + F.col("neg")).alias("fp"),
        "n_pos",
        "n_neg",
    )
    origin = sizes.select(
        "score", F.lit(math.inf).alias("threshold"), F.lit(0).cast("long").alias("tp"), F.lit(0).cast("long").alias("fp"), "n_pos", "n_neg"
    )
    return points.unionByName(origin).select(
        "score",
        "threshold",
        "tp",
        "fp",
        F.when(F.col("n_neg") > 0, F.col("fp") / F.col("n_neg")).alias("fpr"),
        F.when(F.col("n_pos") > 0, F.col("tp") / F.col("n_pos")).alias("tpr"),
    )
