"""One-pass column profiles.

``profile_row`` runs a single global aggregate (partial aggregation on every
task, one tiny final merge), so the cost is one scan whatever the number of
columns. ``column_profile`` returns the same kind of facts as a table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TEMPORAL = (T.DateType, T.TimestampType, T.TimestampNTZType)


def profile_row(df: DataFrame, aggs: dict[str, Column]) -> dict:
    """Evaluate named aggregate expressions over ``df`` in one job; returns a dict."""
    if not aggs:
        return {}
    row = df.agg(*[c.alias(k) for k, c in aggs.items()]).first()
    return row.asDict() if row is not None else {}


#: How a fact of ``coerce_table`` merges with that of other rows, by the letters of its name; a null fact (no value seen) merges as nothing.
MERGES = {"b": F.bool_or, "m": F.bool_and, "mid": F.bool_and, "lo": F.min, "hi": F.max}


def merged(states: DataFrame, names: list[str]) -> dict:
    """Facts over the union of the rows behind ``states``, which has a map ``facts`` of integers per part of them."""
    def one(name: str) -> Column:
        how = MERGES[name.rstrip("0123456789")]
        fact = F.col("facts")[name]
        return how(fact == 1) if how in (F.bool_or, F.bool_and) else how(fact)
    return profile_row(states, {n: one(n) for n in names})


def is_midnight(c: Column, dt: T.DataType) -> Column:
    """F4 per value: hour, minute and second all zero (fraction ignored)."""
    if isinstance(dt, T.DateType):
        return F.lit(True)
    return (F.hour(c) == 0) & (F.minute(c) == 0) & (F.second(c) == 0)


def column_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Per column: type, rows, nulls, non-nulls and (temporal only) whether all values are at midnight.

    One aggregate over all columns, then the single result row is unpivoted with
    ``stack`` - no driver round trip.
    """
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for i, f in enumerate(fields):
        c = F.col(f"`{f.name}`")
        aggs.append(F.count_if(c.isNull()).alias(f"n{i}"))
        if isinstance(f.dataType, TEMPORAL):
            aggs.append(F.coalesce(F.bool_and(F.when(c.isNotNull(), is_midnight(c, f.dataType))), F.lit(False)).alias(f"m{i}"))
        else:
            aggs.append(F.lit(None).cast("boolean").alias(f"m{i}"))
    one = df.agg(*aggs)
    parts = []
    for i, f in enumerate(fields):
        name = f.name.replace("'", "\\'")
        parts.append(f"'{name}', '{f.dataType.simpleString()}', __rows, n{i}, m{i}")
    stacked = one.select(F.expr(f"stack({len(fields)}, {', '.join(parts)})")
                         .alias("column_name", "data_type", "n_rows", "n_nulls", "all_midnight"))
    return stacked.select("column_name", "data_type", "n_rows", "n_nulls",
                          (F.col("n_rows") - F.col("n_nulls")).alias("n_non_null"), "all_midnight")
