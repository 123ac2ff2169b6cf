"""Joins whose small side is checked before it is broadcast."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000
SALTS = 32


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Give every core work when the input has fewer splits than there are cores.

    Meant for steps that cost much more than the shuffle of their input, such as
    text rules or model calls.  A large input has splits enough and stays as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *keys)


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """True if ``df`` has at most ``max_rows`` rows; reads no more than it must."""
    return df.limit(max_rows + 1).count() <= max_rows


def semi_or_anti(big: DataFrame, keys: DataFrame, on: Sequence[str], how: str,
                 small: bool | None = None) -> DataFrame:
    """Keep (``left_semi``) or drop (``left_anti``) rows whose key is listed.

    A short list of narrow keys is broadcast, so the big side is not shuffled;
    a long one is left to Spark's own join choice.  ``small`` passes on a size
    check already made.
    """
    keys = keys.select(*on).distinct()
    if is_small(keys) if small is None else small:
        keys = F.broadcast(keys)
    return big.join(keys, list(on), how)


def join_hot_key(big: DataFrame, other: DataFrame, on: str, spread: str,
                 small: bool | None = None, salts: int = SALTS) -> DataFrame:
    """Inner join where single keys may hold a large share of ``big``.

    ``other`` is broadcast when its size allows.  Beyond that both sides get a
    salt: rows of ``big`` by the hash of ``spread``, rows of ``other`` once per
    salt value.  Every pair still meets exactly once, and no key sits in a
    single task.  Spark does not count the rows that ``explode`` adds, so it would take the
    copies for small and broadcast them; the hint keeps them from the driver.
    """
    if is_small(other) if small is None else small:
        return big.join(F.broadcast(other), on)
    salted = big.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    copies = other.withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    )
    return salted.join(copies.hint("merge"), [on, "_salt"]).drop("_salt")
