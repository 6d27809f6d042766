"""Left lookup into a table with one row per key, safe for hot keys and for large tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Rows and bytes a lookup table may have to be sent to every executor.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 32 * 1024 * 1024
# So few rows of a key and a few values are sent without being weighed.
FEW_ROWS = 1_000
# A key is hot when it holds at least this share of the weight, so there are at most 1/share of them.
HOT_SHARE = 0.001
SPREAD = 4_096


def lookup(
    df: DataFrame,
    table: DataFrame,
    key: Column,
    values: Sequence[str],
    table_key: str = "key",
    table_rows: int | None = None,
    weight: str | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``df`` with the ``values`` columns of the row of ``table`` whose key equals ``key``, else null.

    ``table_rows`` is the counted size of the table. A table within ``broadcast_rows`` and ``broadcast_bytes``, as JSON text,
    is broadcast. A larger one is shuffled, except for its hot keys (by the ``weight`` column), of which there are at
    most ``1 / HOT_SHARE``: those are broadcast, and rows already answered, like rows without a key,
    are spread over the shuffle instead of meeting in one task.
    """
    if table_rows is None:
        table_rows = table.count()
    keyed = df.withColumn("__key", key)
    row_bytes = F.octet_length(F.to_json(F.struct(F.col(table_key).alias("k"), *[F.col(v).alias(f"v{i}") for i, v in enumerate(values)])))
    if table_rows <= broadcast_rows and (table_rows <= FEW_ROWS or (table.agg(F.sum(row_bytes)).first()[0] or 0) <= broadcast_bytes):
        small = F.broadcast(table.select(F.col(table_key).alias("__key"), *values))
        return keyed.join(small, "__key", "left").drop("__key")
    hot_names = {v: f"__hot_{v}" for v in values}
    if weight is not None:
        total = table.agg(F.sum(weight)).first()[0] or 0
        hot = table.where(F.col(weight) >= F.lit(total * HOT_SHARE))
        hot = hot.select(
            F.col(table_key).alias("__key"), F.lit(True).alias("__is_hot"), *[F.col(v).alias(n) for v, n in hot_names.items()]
        )
        keyed = keyed.join(F.broadcast(hot), "__key", "left")
    else:
        keyed = keyed.withColumns({"__is_hot": F.lit(None).cast("boolean"), **{n: F.lit(None) for n in hot_names.values()}})
    plain = [c for c in df.columns if not df.schema[c].dataType.simpleString().startswith(("map", "variant"))]
    spread = F.concat(F.lit("\u0000"), F.pmod(F.xxhash64(*plain), F.lit(SPREAD)).cast("string"))
    cold_key = F.when(F.col("__is_hot").isNull() & F.col("__key").isNotNull(), F.concat(F.lit("k"), F.col("__key").cast("string"))).otherwise(spread)
    cold = table.select(F.concat(F.lit("k"), F.col(table_key).cast("string")).alias("__cold"), *[F.col(v).alias(f"__c_{v}") for v in values])
    joined = keyed.withColumn("__cold", cold_key).join(cold, "__cold", "left")
    return joined.select(
        *[F.col(c) for c in df.columns],
        *[F.when(F.col("__is_hot"), F.col(hot_names[v])).otherwise(F.col(f"__c_{v}")).alias(v) for v in values],
    )
