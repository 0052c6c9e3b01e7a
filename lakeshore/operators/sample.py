"""Repeatable sampling.

``hash_fraction`` keeps a row when a hash of its key falls under the fraction:
map-side filter, no shuffle, same rows on every run and every engine that can
compute the hash.  ``hash_sample_n`` is n rows without replacement: the n
smallest hashes, a distributed top-k (each task keeps n, the driver merges).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ARITH_MOD = 1000003     # prime; keys are reduced first so products fit in bigint
ARITH_MULT = 7919


def arith_hash(key: str, seed: int) -> Column:
    """Integer hash in [0, ARITH_MOD) of a numeric key, reproducible in plain SQL."""
    k = F.pmod(F.col(key).cast("bigint"), F.lit(ARITH_MOD))
    return F.pmod(k * ARITH_MULT + seed, F.lit(ARITH_MOD))


def xx_hash(keys: Sequence[str], seed: int) -> Column:
    return F.xxhash64(F.lit(seed), *[F.col(k) for k in keys])


def hash_fraction(df: DataFrame, fraction: float, keys: Sequence[str], seed: int = 42,
                  method: str = "xxhash64") -> DataFrame:
    """Bernoulli-like sample of about ``fraction`` of the rows, decided per key."""
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must be in [0, 1]")
    if method == "arith":
        if len(keys) != 1:
            raise ValueError("arith hash takes one numeric key")
        return df.where(arith_hash(keys[0], seed) < int(fraction * ARITH_MOD))
    # xxhash64 spans the signed 64-bit range; compare in [0, 1).
    u = (F.pmod(xx_hash(keys, seed), F.lit(1 << 62)).cast("double") / float(1 << 62))
    return df.where(u < fraction)


def hash_sample_n(df: DataFrame, n: int, keys: Sequence[str], seed: int = 42,
                  method: str = "xxhash64") -> DataFrame:
    """Exactly ``min(n, rows)`` rows without replacement, the same ones each run."""
    h = arith_hash(keys[0], seed) if method == "arith" else xx_hash(keys, seed)
    return (df.withColumn("_h", h).orderBy(F.col("_h"), *[F.col(k) for k in keys])
              .limit(n).drop("_h"))


def bernoulli(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """Spark's own row sample (``df.sample``), seeded."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)
