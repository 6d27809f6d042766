"""Splits, folds, samples and minority oversampling, all decided by hashes of a key."""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from riskframe.functions.hashing import uniform
from riskframe.operators.lookup import lookup
from riskframe.operators.neighbors import distinct_vectors, nearest
from riskframe.operators.orderstats import as_value, dense_index, select_ranks
from riskframe.operators.passes import several_passes
from riskframe.operators.rows import require_target
from riskframe.session import cut_lineage, written


# Classes that counts on the driver may have.
MAX_CLASSES = 10_000
# Bins of the hash, per class, in which the cuts of splits and folds are sought; a power of two, so bins have exact bounds.
HASH_BINS = 4_096


def _key_text(key: Sequence[str]) -> Column:
    return F.concat_ws("|", *[F.col(c).cast("string") for c in key])


def class_counts(df: DataFrame, label: str, rows: Column | None = None) -> dict:
    """Rows per class, or ``rows`` of it. A column with more than ``MAX_CLASSES`` values is no class label and is refused."""
    rows = F.count("*") if rows is None else rows
    counted = df.where(F.col(label).isNotNull()).groupBy(label).agg(rows.alias("n")).limit(MAX_CLASSES + 1).collect()
    if len(counted) > MAX_CLASSES:
        raise ValueError(f"'{label}' has more than {MAX_CLASSES} values; it is no class label")
    return {r[label]: r["n"] for r in counted}


def allocate(counts: Mapping, total: int) -> dict:
    """``total`` units over classes in proportion to their counts, leftovers to the largest remainders."""
    size = sum(counts.values())
    exact = {c: (total * n) / size for c, n in counts.items()}
    given = {c: math.floor(x) for c, x in exact.items()}
    left = total - sum(given.values())
    order = sorted(counts, key=lambda c: (-(exact[c] - given[c]), str(c)))
    for c in order[:left]:
        given[c] += 1
    return given


def _first_rows(
    df: DataFrame,
    label: str,
    u: Column,
    key: Column,
    plans: Sequence[Mapping] | Callable[[Mapping], Sequence[Mapping]],
    name: Sequence[str],
    counts: Mapping | None = None,
    cache_input: bool = False,
) -> DataFrame:
    """``df`` with one flag per plan: true for the ``plan[c]`` rows of each class ``c`` that come first by (u, key).

    ``plans`` may be a function of the rows per class, which are counted with the hash if ``counts`` doesn't tell them.
    """
    hashed = df.withColumns({"__u": u, "__key": key})
    # A filter on the hash would be pushed below it and repeat it for every comparison; the generator
    # keeps it computed once per row.
    cell = F.explode(F.array(F.struct(label, "__u", "__key"))).alias("__r")
    with several_passes(hashed.select(cell).select("__r.*"), cache_input) as slim:
        at = F.floor(F.col("__u") * F.lit(HASH_BINS)).cast("long").alias("at")
        bins = cut_lineage(slim.where(F.col(label).isNotNull()).groupBy(label, at).agg(F.count("*").alias("n")))
        if callable(plans):
            plans = plans(class_counts(bins, label, F.sum("n")) if counts is None else counts)
        tests = _first_tests(slim, label, plans, bins)
    return hashed.withColumns(dict(zip(name, tests))).drop("__u", "__key")


@dataclass
class _Cut:
    """The ``wanted`` first rows of a class; the last of them lies in [low, high], which ``before`` rows precede."""

    label: object
    wanted: int
    low: float
    high: float
    before: int


def _first_tests(df: DataFrame, label: str, plans: Sequence[Mapping], bins: DataFrame) -> list[Column]:
    """One test per plan. The bin of the hash that holds a cut is known from the counts per bin, whatever values the hash
    takes (those of a training part lack the test part's), so only the rows of these bins are looked at again."""
    wanted = list({(c, p[c]) for p in plans for c in p if p[c] > 0})
    schema = T.StructType([T.StructField("c", bins.schema[label].dataType), T.StructField("wanted", T.LongType())])
    upto = F.sum("n").over(Window.partitionBy(label).orderBy("at"))
    placed = bins.withColumn("upto", upto).join(F.broadcast(df.sparkSession.createDataFrame(wanted, schema)), F.col(label) == F.col("c"))
    placed = placed.where((F.col("wanted") <= F.col("upto")) & (F.col("wanted") > F.col("upto") - F.col("n")))
    rows = placed.select("c", "wanted", "at", (F.col("upto") - F.col("n")).alias("before")).collect()  # one per cut
    cuts = [_Cut(r["c"], r["wanted"], r["at"] / HASH_BINS, (r["at"] + 1) / HASH_BINS, r["before"]) for r in rows]
    strip = F.lit(False)
    for cut in cuts:
        strip = strip | ((F.col(label) == cut.label) & (F.col("__u") >= F.lit(cut.low)) & (F.col("__u") <= F.lit(cut.high)))
    tests = _exact_tests(cut_lineage(df.where(strip)), label, cuts) if cuts else {}
    out = []
    for p in plans:
        test = F.lit(False)
        for c, n in p.items():
            if n > 0:
                test = test | tests[c, n]
        out.append(F.coalesce(test, F.lit(False)))
    return out


def _exact_tests(df: DataFrame, label: str, cuts: Sequence[_Cut]) -> dict:
    u, key = F.col("__u"), F.col("__key")
    inside = [(F.col(label) == c.label) & (u >= F.lit(c.low)) & (u <= F.lit(c.high)) for c in cuts]
    ranks = [[c.wanted - c.before - 1] for c in cuts]
    found = [f[r[0]] for f, r in zip(select_ranks(df, [F.when(i, u) for i in inside], ranks), ranks)]
    # Rows that share the hash of a cut are next to none for a unique key.
    aggs = []
    for j, at in enumerate(found):
        tied = inside[j] & (u == F.lit(at))
        aggs += [
            F.count_if(inside[j] & (u < F.lit(at))).alias(f"below{j}"),
            F.count_if(tied).alias(f"tied{j}"),
            F.max(F.when(tied, key)).alias(f"last{j}"),
        ]
    row = df.agg(*aggs).first()
    tests = {}
    for j, (c, at) in enumerate(zip(cuts, found)):
        rest, last = c.wanted - c.before - row[f"below{j}"], row[f"last{j}"]
        if row[f"tied{j}"] > rest:
            tied = df.where(inside[j] & (u == F.lit(at))).select(key.alias("k")).orderBy("k").limit(rest)
            last = tied.agg(F.max("k")).first()[0]
        first = (u < F.lit(at)) | ((u == F.lit(at)) & (key <= F.lit(last)))
        tests[c.label, c.wanted] = (F.col(label) == c.label) & first
    return tests


def stratified_flag(
    df: DataFrame, label: str, key: Sequence[str], test_share: float = 0.3, seed: int = 42, cache_input: bool = False, u: Column | None = None
) -> DataFrame:
    """``df`` with ``is_test``: exactly ceil(test_share * n) rows, class shares kept.

    ``u`` is the hash where it is known already. The cut is an exact order statistic of the hash per class, found without sorting the table, so the
    result is a narrow projection: no shuffle of rows, the same rows in every run.
    """
    require_target(df, label)

    def plan(counts: Mapping) -> list[Mapping]:
        size = sum(counts.values())
        train = allocate(counts, size - math.ceil(test_share * size))
        return [{c: n - train[c] for c, n in counts.items()}]

    return _first_rows(df, label, uniform(seed, *key) if u is None else u, _key_text(key), plan, ["is_test"], cache_input=cache_input)


def stratified_split(
    df: DataFrame, label: str, key: Sequence[str], test_share: float = 0.3, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """The two parts of :func:`stratified_flag`, read from one written copy of the rows."""
    require_target(df, label)
    # The rows and their hash are worked out once; the passes that seek the cut read two columns and the key.
    hashed = written(df.withColumn("__hash", uniform(seed, *key)), "split")
    flagged = stratified_flag(hashed, label, key, test_share, seed, u=F.col("__hash")).drop("__hash")
    return flagged.where(~F.col("is_test")).drop("is_test"), flagged.where("is_test").drop("is_test")


def plain_split(df: DataFrame, key: Sequence[str], test_share: float = 0.3, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Not stratified, sizes close to the share."""
    u = uniform(seed, *key)
    return df.where(u >= F.lit(test_share)), df.where(u < F.lit(test_share))


def assign_folds(
    df: DataFrame, label: str, key: Sequence[str], folds: int = 3, seed: int = 42, name: str = "fold", cache_input: bool = False
) -> DataFrame:
    """Stratified folds: per class, ranks of the hash cut into ``folds`` runs whose sizes differ by at most one."""
    starts = lambda counts: [{c: _fold_start(n, folds, f) for c, n in counts.items()} for f in range(1, folds)]
    flags = [f"__before{f}" for f in range(1, folds)]
    flagged = _first_rows(df, label, uniform(seed, *key), _key_text(key), starts, flags, cache_input=cache_input)
    fold = F.lit(0)
    for flag in flags:
        fold = fold + F.when(F.col(flag), F.lit(0)).otherwise(F.lit(1))
    return flagged.withColumn(name, fold).drop(*flags)


def _fold_start(rows: int, folds: int, fold: int) -> int:
    return fold * (rows // folds) + min(fold, rows % folds)


def hash_sample(df: DataFrame, rows: int, key: Sequence[str], seed: int = 42) -> DataFrame:
    """A fixed-size sample: the rows with the smallest hashes (a top-k, not a full sort)."""
    return df.orderBy(uniform(seed, *key), *key).limit(rows)


def draw_parameters(grid: Mapping[str, Sequence], count: int, seed: int = 42) -> list[dict]:
    """``count`` different combinations of a parameter grid, seeded; all of them if there are fewer."""
    combos = [dict(zip(grid, values)) for values in product(*grid.values())]
    return combos if count >= len(combos) else random.Random(seed).sample(combos, count)


class SmoteResampler:
    """Oversamples the minority class of a binary target with points between neighbours.

    ``strategy`` is ``"auto"`` (up to the majority) or the minority/majority ratio to reach. ``key``
    names the columns that identify a row; they order the minority rows and are null in new rows.
    Base row, neighbour and step of new row i are hashes of i, so any partitioning gives the same rows.
    """

    def __init__(
        self,
        target_col: str = "Default",
        strategy: float | str = "auto",
        k_neighbors: int = 5,
        random_state: int = 42,
        key: Sequence[str] = ("key",),
        tag: str | None = None,
    ) -> None:
        self.target_col = target_col
        self.strategy = strategy
        self.k_neighbors = k_neighbors
        self.random_state = random_state
        self.key = list(key)
        self.tag = tag

    def new_rows(self, counts: Mapping) -> tuple[object, int]:
        """The minority class and how many rows it lacks."""
        if len(counts) != 2:
            raise ValueError(f"the target needs exactly two classes, found {len(counts)}")
        minority, majority = sorted(counts, key=lambda c: (counts[c], str(c)))
        if self.strategy == "auto":
            return minority, counts[majority] - counts[minority]
        missing = int(counts[majority] * float(self.strategy) - counts[minority])
        if missing < 0:
            raise ValueError("the ratio is below the current one; oversampling cannot remove rows")
        return minority, missing

    def fit_resample_combined(self, df: DataFrame) -> DataFrame:
        """Original rows first, then synthetic ones, in one table."""
        require_target(df, self.target_col)
        features = [c for c in df.columns if c != self.target_col and c not in self.key]
        self._check(df, features)
        counts = class_counts(df, self.target_col)
        minority, missing = self.new_rows(counts)
        repeated = df.where(F.col(self.target_col) == minority).groupBy(*self.key).count().where("count > 1").limit(1).collect()
        if repeated:
            raise ValueError(f"key {self.key} names several rows, {repeated[0].asDict()} for one")
        if counts[minority] <= self.k_neighbors:
            raise ValueError(f"{counts[minority]} minority rows are too few for {self.k_neighbors} neighbours")
        original = df
        synthetic = self.synthesize(df, features, minority, counts[minority], missing)
        if self.tag:
            original = original.withColumn(self.tag, F.lit("original"))
            synthetic = synthetic.withColumn(self.tag, F.lit("synthetic"))
        else:
            synthetic = synthetic.drop("base_idx")
        return original.unionByName(synthetic, allowMissingColumns=True)

    def fit_resample(self, df: DataFrame) -> DataFrame:
        return self.fit_resample_combined(df)

    def _check(self, df: DataFrame, features: Sequence[str]) -> None:
        for c in features:
            if not isinstance(df.schema[c].dataType, T.NumericType):
                raise ValueError(f"feature '{c}' is not numeric; encode it first")
        nulls = df.agg(*[F.count_if(as_value(c).isNull()).alias(c) for c in features]).first()
        bad = [c for c in features if nulls[c]]
        if bad:
            raise ValueError(f"features with missing values: {bad}")

    def synthesize(self, df: DataFrame, features: Sequence[str], minority, rows: int, missing: int) -> DataFrame:
        """The ``missing`` new rows, with ``base_idx``: the position of the row each one starts from."""
        k, seed, spark = self.k_neighbors, self.random_state, df.sparkSession
        vec = F.array(*[as_value(c) for c in features]).alias("vec")
        base = cut_lineage(
            dense_index(df.where(F.col(self.target_col) == minority).select(*self.key, vec), self.key, "idx").select("idx", "vec")
        )
        # One neighbour more than needed: a row is among the nearest to its own vector.
        groups = cut_lineage(distinct_vectors(base, "idx", "vec", k + 1))
        queries = groups.select(F.element_at("ids", 1).alias("qid"), "vec")
        found = nearest(queries, groups, k + 1)
        lists = found.groupBy("qid").agg(
            F.sort_array(F.collect_list(F.struct("rank", "tid", "tvec"))).alias("near")
        )  # k + 1 entries each
        table = groups.select(F.element_at("ids", 1).alias("qid"), F.col("vec").alias("key"), "n")
        table = table.join(lists, "qid").select("key", "near", "n")
        draws = spark.range(missing).select(
            F.col("id"),
            F.floor(uniform(seed, F.lit("base"), F.col("id")) * F.lit(rows)).cast("long").alias("idx"),
            (F.floor(uniform(seed, F.lit("neighbour"), F.col("id")) * F.lit(k)).cast("int") + 1).alias("pick"),
            uniform(seed, F.lit("step"), F.col("id")).alias("step"),
        )
        started = draws.join(base, "idx")
        paired = lookup(started, cut_lineage(table), F.col("vec"), ["near"], weight="n")
        others = F.filter("near", lambda x: x["tid"] != F.col("idx"))
        chosen = F.element_at(others, F.col("pick"))["tvec"]
        moved = paired.select(
            F.col("idx").alias("base_idx"),
            F.zip_with("vec", chosen, lambda a, b: a + F.col("step") * (b - a)).alias("new"),
        )
        label_type = df.schema[self.target_col].dataType
        cells = [F.col("new")[i].cast(df.schema[c].dataType).alias(c) for i, c in enumerate(features)]
        return moved.select("base_idx", *cells, F.lit(minority).cast(label_type).alias(self.target_col))
