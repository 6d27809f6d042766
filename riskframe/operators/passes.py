"""Reading one input several times."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame

# Inputs below this planned size may sit in a single file split; they get so many partitions on any machine, because what is
# drawn or summed per partition must not depend on the number of its cores.
SMALL_BYTES = 32 * 1024 * 1024
SMALL_PARTITIONS = 8


def spread_small(df: DataFrame) -> DataFrame:
    """Give a small input ``SMALL_PARTITIONS``; a large input keeps its file splits (no shuffle)."""
    if int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) > SMALL_BYTES:
        return df
    return df.repartition(SMALL_PARTITIONS)


@contextmanager
def several_passes(df: DataFrame, cache: bool) -> Iterator[DataFrame]:
    """Keep ``df`` for the passes of one eager operator and release it afterwards.

    Worth it where the input is an expensive plan; a plain column-pruned scan is as cheap to repeat.
    The kept copy may spill to disk, and lost parts are computed again.
    """
    if not cache:
        yield df
        return
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()
