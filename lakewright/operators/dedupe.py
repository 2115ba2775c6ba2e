"""Keep-first / keep-last de-duplication (G1-G5) and top-N per group (H2).

Keep-first is an aggregate (``min`` over a struct that leads with the order
columns), not a window: every task reduces its share of a key to one row before
the shuffle, so a key holding a third of all rows costs one row per task, not a
third of the data in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _keys(keys) -> list[Column]:
    return [F.col(k) if isinstance(k, str) else k for k in keys]


def first_wins(df: DataFrame, keys, order, *, last: bool = False, payload: list[str] | None = None) -> DataFrame:
    """One row per key: the row with the smallest (or, ``last``, largest) ``order`` tuple.

    ``keys`` may be names or aliased Columns (e.g. ``lower(name).alias('k')``).
    Ties on the order tuple are broken by the payload values, so the result is deterministic.
    """
    key_cols = _keys(keys)
    key_names = [c if isinstance(c, str) else None for c in keys]
    order = [order] if isinstance(order, str) else list(order)
    if payload is None:
        payload = [c for c in df.columns if c not in key_names]
    s = F.struct(*[F.col(o).alias(f"__o{i}") for i, o in enumerate(order)], *[F.col(f"`{c}`") for c in payload])
    agg = (F.max(s) if last else F.min(s)).alias("__w")
    g = df.groupBy(*key_cols).agg(agg)
    out_keys = [c for c in g.columns if c != "__w"]
    return g.select(*[F.col(f"`{k}`") for k in out_keys], *[F.col(f"__w.`{c}`").alias(c) for c in payload
                                                         if c not in out_keys])


def first_wins_casefold(df: DataFrame, name_col: str, order, group: list[str] | None = None) -> DataFrame:
    """First spelling wins, names compared case-insensitively."""
    keys = [*(group or []), F.lower(F.col(name_col)).alias("__fold")]
    return first_wins(df, keys, order).drop("__fold")


def top_n_per_group(df: DataFrame, keys, order: list[Column], n: int, rank_col: str = "rank") -> DataFrame:
    """H2: first ``n`` rows per group under ``order`` (e.g. newest first).

    ``row_number() <= n`` lets Spark insert a partial per-group limit before the
    shuffle (WindowGroupLimit), so a hot group ships at most n rows per task.
    """
    w = Window.partitionBy(*_keys(keys)).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= n)
