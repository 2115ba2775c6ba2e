"""Hot keys for salted joins, found in one pass without a shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hot_keys(df: DataFrame, column: str, hot_share: int = 64) -> list:
    """Keys of ``column`` that may hold at least 1/hot_share of the rows of ``df``.

    One scan and no shuffle of the key: Spark's frequent-items aggregate keeps at
    most ``hot_share`` counters per task and merges them (Karp, Schenker and
    Papadimitriou), so the result holds at most ``hot_share`` values (a proven
    bound, it is the only thing that reaches the driver) and contains every key
    above the share. It may also name a few colder keys; those are salted
    needlessly but harmlessly (results never depend on the salt).
    """
    row = df.where(F.col(column).isNotNull()).stat.freqItems([column], support=1.0 / hot_share).first()
    return list(row[0] or []) if row is not None else []


def is_hot(key: Column, keys: list) -> Column:
    """``key`` is one of ``keys`` (false when there are none)."""
    return key.isin(keys) if keys else F.lit(False)
