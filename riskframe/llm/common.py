"""Helpers shared by the operators: written intermediate tables, counted broadcasts, words, components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from riskframe.session import scratch_path

#: A word, as the contracts define it: a run of anything but space and \t..\r.
WORD = r"[^\x20\x09-\x0D]+"


def stored(df: DataFrame, name: str, partitions: int | None = None) -> DataFrame:
    """``df`` written once as Parquet below the shared folder and read back: later passes neither recompute it nor
    depend on an executor that has gone."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    (df.coalesce(partitions) if partitions else df).write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def n_words(text: Column) -> Column:
    """Number of words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def text_key(*columns: Column) -> list[Column]:
    """128 bits that name a value: two seeded hashes, nulls included."""
    return [F.xxhash64(*columns).alias("key1"), F.xxhash64(F.lit("second"), *columns).alias("key2")]
