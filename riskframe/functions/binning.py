"""Discretisation as generated comparisons, and the label rules that use fixed cuts."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Information-value bands, lower bound inclusive.
IV_BANDS = [
    (0.00, 0.02, "Not Predictive"),
    (0.02, 0.10, "Weak Predictor"),
    (0.10, 0.30, "Medium Predictor"),
    (0.30, 0.50, "Strong Predictor"),
    (0.50, float("inf"), "Suspicious / Over-predicting"),
]
# Stability labels by upper bound.
STABILITY_LABELS = [
    (0.10, "No significant shift"),
    (0.25, "Moderate shift – investigate"),
    (float("inf"), "Major shift – action required"),
]
NO_STABILITY = "Insufficient data"
# Grade cuts on the probability of default, and on the model score.
PD_GRADES = [(0.03, "A"), (0.07, "B"), (0.15, "C"), (1.0, "D")]
SCORE_GRADES = [(0.25, "A"), (0.50, "B"), (0.75, "C")]
TOP_SCORE_GRADE = "D"
ANOMALY_GRADE = "Undefined"

# Above this many cuts the comparison tree would outgrow what the JIT compiles well.
TREE_CUTS = 64


def literal(number: float) -> str:
    """A double literal of SQL text."""
    if math.isinf(number):
        return f"double('{'-' if number < 0 else ''}Infinity')"
    return f"{float(number)!r}D"


def quoted(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def text_literal(value: float | str) -> str:
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return literal(value)


def _tree(name: str, cuts: Sequence[str], leaves: Sequence[str], test: str) -> str:
    """Balanced tree of comparisons as SQL text: one parse instead of a call per node."""
    if not cuts:
        return leaves[0]
    mid = len(cuts) // 2
    low = _tree(name, cuts[:mid], leaves[: mid + 1], test)
    high = _tree(name, cuts[mid + 1 :], leaves[mid + 1 :], test)
    return f"CASE WHEN {name} {test} {cuts[mid]} THEN {low} ELSE {high} END"


def cut_index(column: str, cuts: Sequence[float], right_closed: bool = True) -> Column:
    """How many ``cuts`` lie below a column (or at it, when bins are left-closed); null stays null."""
    name, test = quoted(column), "<=" if right_closed else "<"
    index = _tree(name, [text_literal(c) for c in cuts], [str(i) for i in range(len(cuts) + 1)], test)
    return F.expr(f"CASE WHEN {name} IS NOT NULL THEN {index} END")


def add_cut_index(df: DataFrame, column: str, cuts: Sequence[float], name: str, right_closed: bool = True) -> DataFrame:
    """:func:`cut_index` as a column ``name``, for any number of cuts.

    Up to TREE_CUTS comparisons become a tree in generated code; longer lists go through MLlib's
    Bucketizer, a binary search, so that bucket counts can follow the size of the data.
    """
    if len(cuts) <= TREE_CUTS or isinstance(cuts[0], str):
        return df.withColumn(name, cut_index(column, cuts, right_closed))
    from pyspark.ml.feature import Bucketizer

    # The Bucketizer is left-closed: the next larger double turns `above the cut` into `at or above`.
    inner = [math.nextafter(c, math.inf) if right_closed else c for c in cuts]
    splits = [-math.inf, *inner, math.inf]
    found = Bucketizer(splits=splits, inputCol=column, outputCol=name, handleInvalid="keep").transform(df)
    return found.withColumn(name, F.when(F.col(column).isNotNull(), F.col(name).cast("int")))


def _within(column: str, edges: Sequence[float]) -> Column:
    name = quoted(column)
    return F.expr(f"{name} >= {literal(edges[0])} AND {name} <= {literal(edges[-1])}")


def right_closed_bin(column: str, edges: Sequence[float]) -> Column:
    """0-based bin of ``(edges[i], edges[i+1]]``; the first bin holds its left edge; outside is null."""
    return F.when(_within(column, edges), cut_index(column, edges[1:-1], right_closed=True))


def left_closed_bin(column: str, edges: Sequence[float]) -> Column:
    """0-based bin of ``[edges[i], edges[i+1])``; the last bin holds its right edge; outside is null."""
    return F.when(_within(column, edges), cut_index(column, edges[1:-1], right_closed=False))


def map_right_closed(column: str, edges: Sequence[float], results: Sequence[float]) -> Column:
    """The result of the right-closed bin of a column without an intermediate bin id."""
    found = _tree(quoted(column), [literal(e) for e in edges[1:-1]], [literal(r) for r in results], "<=")
    return F.when(_within(column, edges), F.expr(found))


def equal_width_edges(low: float, high: float, bins: int) -> list[float]:
    """``bins`` equal ranges, the lowest one widened by 0.1 % of the span to hold the minimum."""
    if not (math.isfinite(low) and math.isfinite(high)):
        raise ValueError("equal-width bins need finite values")
    if low == high:
        pad = 0.001 * abs(low) if low else 0.001
        low, high = low - pad, high + pad
        return [low + (high - low) * i / bins for i in range(bins)] + [high]
    edges = [low + (high - low) * i / bins for i in range(bins)] + [high]
    edges[0] -= (high - low) * 0.001
    return edges


def histogram_bin(value: Column, low: float, high: float, bins: int) -> Column:
    """0-based equal-width histogram bin, the last one closed."""
    if high == low:
        return F.when(value.isNotNull(), F.lit(0))
    width = (high - low) / bins
    raw = F.floor((value - F.lit(float(low))) / F.lit(width)).cast("int")
    return F.when(value.isNotNull(), F.greatest(F.lit(0), F.least(raw, F.lit(bins - 1))))


def interpret_iv(iv: Column) -> Column:
    label = F.lit(None).cast("string")
    for low, high, text in reversed(IV_BANDS):
        label = F.when((iv >= F.lit(low)) & (iv < F.lit(high)), F.lit(text)).otherwise(label)
    # Spark orders NaN above infinity, so NaN falls through every band just like a missing value.
    return F.coalesce(label, F.lit("Unknown"))


def interpret_stability(value: Column) -> Column:
    """Label of an unrounded PSI/CSI; missing values have no label of their own."""
    label = F.lit(STABILITY_LABELS[-1][1])
    for bound, text in reversed(STABILITY_LABELS[:-1]):
        label = F.when(value < F.lit(bound), F.lit(text)).otherwise(label)
    return F.when(value.isNull() | F.isnan(value), F.lit(NO_STABILITY)).otherwise(label)


def pd_grade(pd: Column) -> Column:
    """Risk grade of a probability of default in [0, 1); outside is null."""
    grade = F.lit(None).cast("string")
    for bound, text in reversed(PD_GRADES):
        grade = F.when(pd < F.lit(bound), F.lit(text)).otherwise(grade)
    return F.when(pd >= F.lit(0.0), grade)


def score_grade(probability: Column, anomalies: Column | None = None) -> Column:
    """Decision grade of a model score; any anomaly makes it Undefined."""
    grade = F.lit(TOP_SCORE_GRADE)
    for bound, text in reversed(SCORE_GRADES):
        grade = F.when(probability < F.lit(bound), F.lit(text)).otherwise(grade)
    grade = F.when(probability.isNotNull(), grade)
    if anomalies is None:
        return grade
    return F.when(F.size(anomalies) > 0, F.lit(ANOMALY_GRADE)).otherwise(grade)
