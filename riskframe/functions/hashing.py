"""Seeded uniforms that do not depend on partitioning, retries or row order."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# 13 hex digits are 52 bits: the largest whole number of digits a double holds exactly.
HEX_DIGITS = 13


def uniform(seed: int | str, *keys: Column | str, digits: int = HEX_DIGITS) -> Column:
    """u in [0, 1) from md5 of ``seed|key|key...``; the same value in every run."""
    parts = [F.col(k) if isinstance(k, str) else k for k in keys]
    text = F.concat_ws("|", F.lit(str(seed)), *[p.cast("string") for p in parts])
    found = F.conv(F.substring(F.md5(text.cast("binary")), 1, digits), 16, 10)
    return found.cast("double") / F.lit(float(16**digits))
