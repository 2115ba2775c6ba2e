"""Source vs registered catalogs.

``catalog_diff`` does added / removed / kept in one aggregation: both lists are
tagged, unioned and grouped by (group keys, folded name) - one shuffle, partial
aggregation on both sides, no join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def catalog_diff(source: DataFrame, registered: DataFrame, name_col: str = "table_name",
                 group: list[str] | None = None, fold_case: bool = True) -> DataFrame:
    """Rows (group..., table_name, change) with change in added / removed / kept.

    Name matching folds case by default (the Spark catalog is case-insensitive);
    the spelling reported is the source's when present.
    """
    group = list(group or [])

    def tag(df, s, r):
        return df.select(*group, F.col(name_col).alias("table_name"),
                         F.lit(s).alias("in_source"), F.lit(r).alias("in_registered"))

    u = tag(source, True, False).unionByName(tag(registered, False, True)).where(F.col("table_name").isNotNull())
    k = F.lower("table_name") if fold_case else F.col("table_name")
    g = u.groupBy(*group, k.alias("__k")).agg(
        F.min(F.when(F.col("in_source"), F.col("table_name"))).alias("source_name"),
        F.min(F.when(F.col("in_registered"), F.col("table_name"))).alias("registered_name"),
        F.bool_or("in_source").alias("s"), F.bool_or("in_registered").alias("r"))
    change = F.when(F.col("s") & F.col("r"), "kept").when(F.col("s"), "added").otherwise("removed")
    return g.select(*group, F.coalesce("source_name", "registered_name").alias("table_name"),
                    change.alias("change"))


def current_tables(diff: DataFrame, table_filter: list[str] | None = None) -> DataFrame:
    """The tables to refresh = source list; ours also keeps a stored include-filter."""
    cur = diff.where(F.col("change") != "removed")
    if table_filter:
        cur = cur.where(F.col("table_name").isin(*table_filter))
    return cur


def registered_only(catalog: DataFrame, registered: DataFrame, name_col: str = "clean_name",
                    registered_col: str = "table_name") -> DataFrame:
    """Keep catalog rows whose table is registered (exact name), as a left-semi join."""
    return catalog.join(registered.select(F.col(registered_col).alias("__reg")),
                        F.col(name_col) == F.col("__reg"), "left_semi")


def schema_table(schema: T.StructType) -> list[tuple[str, str, int]]:
    return [(f.name, f.dataType.simpleString(), i) for i, f in enumerate(schema.fields)]


def column_diff(before: T.StructType, after: T.StructType) -> list[dict]:
    """Per column name (case-folded): added / removed / retyped / same, with both types."""
    b = {f.name.lower(): (f.name, f.dataType.simpleString()) for f in before.fields}
    a = {f.name.lower(): (f.name, f.dataType.simpleString()) for f in after.fields}
    out = []
    for k in list(b) + [k for k in a if k not in b]:
        tb, ta = b.get(k, (None, None))[1], a.get(k, (None, None))[1]
        name = (a.get(k) or b.get(k))[0]
        change = "added" if tb is None else "removed" if ta is None else "same" if ta == tb else "retyped"
        out.append({"column": name, "type_before": tb, "type_after": ta, "change": change})
    return out
