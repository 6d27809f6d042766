"""A linear log-odds scorecard with exact per-row attribution, as plain columns."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskframe.functions.text import display_feature

ATTRIBUTION = "array<struct<feature:string,value:double>>"


@dataclass
class LinearScorecard:
    """Probability 1 / (1 + exp(-(intercept + sum coef * x))) over named columns.

    ``means`` are the feature means of the training table: the attribution of a feature is
    ``coef * (x - mean)``, so attributions plus the mean log-odds give the log-odds of the row.
    """

    features: list[str]
    coefficients: list[float]
    intercept: float
    means: list[float]

    def _terms(self, suffix: str) -> list[Column]:
        return [F.lit(float(c)) * F.col(f + suffix).cast("double") for f, c in zip(self.features, self.coefficients)]

    def log_odds(self, suffix: str = "") -> Column:
        total = F.lit(float(self.intercept))
        for term in self._terms(suffix):
            total = total + term
        return total

    def probability(self, suffix: str = "") -> Column:
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-self.log_odds(suffix)))

    def attributions(self, suffix: str = "") -> Column:
        """Unsorted array of (feature, value), in feature order."""
        cells = [
            F.struct(F.lit(f).alias("feature"), (F.lit(float(c)) * (F.col(f + suffix).cast("double") - F.lit(float(m)))).alias("value"))
            for f, c, m in zip(self.features, self.coefficients, self.means)
        ]
        return F.array(*cells)

    def score(self, df: DataFrame, suffix: str = "", probability: str = "probability", attributions: str = "attributions") -> DataFrame:
        return df.withColumns({probability: self.probability(suffix), attributions: self.attributions(suffix)})

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame([(json.dumps(asdict(self)),)], "state string").coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "LinearScorecard":
        return cls(**json.loads(spark.read.parquet(path).first()["state"]))


def sort_attributions(attributions: Column, top: int | None = None) -> Column:
    """By absolute value, largest first, ties in the given order; display names; the first ``top`` only."""
    keyed = F.transform(
        attributions, lambda a, i: F.struct((-F.abs(a["value"])).alias("size"), i.alias("i"), a["feature"].alias("feature"), a["value"].alias("value"))
    )
    ordered = F.sort_array(keyed)
    if top is not None:
        ordered = F.slice(ordered, 1, top)
    return F.transform(ordered, lambda a: F.struct(display_feature(a["feature"]).alias("feature"), a["value"].alias("value")))
