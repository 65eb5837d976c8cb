"""Deterministic pseudo-random numbers that other engines can reproduce."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_RANGE = 1 << 32


def hash32(seed: int | str, *key: Column | str) -> Column:
    """Uniform number in [0, 2**32) from the first 8 hex digits of md5(seed|key...)."""
    parts = [F.col(k) if isinstance(k, str) else k for k in key]
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[p.cast("string") for p in parts]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def hash_fraction(seed: int | str, *key: Column | str) -> Column:
    """Uniform number in [0, 1)."""
    return hash32(seed, *key) / F.lit(float(HASH_RANGE))
