"""Order-independent fingerprints of tables and partitions, and what two of them say has changed.

A row's hash covers every value and which of them are null. A fingerprint is the number of rows, the sums of three pieces of
the hashes and their exclusive or: all of them merge, so every task reduces its rows to one line a partition before
anything is shuffled, and the order of rows, files and tasks does not matter.
"""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bits of a piece: a sum of pieces holds 2**42 rows.
PIECE = 21


def _hashable(field: T.StructField) -> Column:
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.MapType):
        c = F.array_sort(F.map_entries(c))
    if isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(c, {"ignoreNullFields": "false"})
    return c


def row_hash(schema: T.StructType) -> Column:
    """64-bit hash of a row of ``schema``; a null differs from every value and from a null elsewhere."""
    names = [f"`{f.name}`" for f in schema.fields]
    masks = [reduce(lambda a, b: a.bitwiseOR(b), [F.when(F.col(n).isNull(), F.lit(1 << i)).otherwise(F.lit(0)) for i, n in enumerate(names[at:at + 62])])
             for at in range(0, len(names), 62)]
    return F.xxhash64(*masks, *[_hashable(f) for f in schema.fields]) if names else F.lit(0).cast("long")


def print_aggregates(h: Column) -> dict[str, Column]:
    """The mergeable parts of a fingerprint over the row hash ``h``."""
    low = F.lit((1 << PIECE) - 1)
    pieces = {f"s{i}": F.coalesce(F.sum(F.shiftrightunsigned(h, PIECE * i).bitwiseAND(low)), F.lit(0)) for i in range(2)}
    return {"rows": F.count(F.lit(1)), **pieces, "s2": F.coalesce(F.sum(F.shiftrightunsigned(h, 2 * PIECE)), F.lit(0)), "x": F.coalesce(F.bit_xor(h), F.lit(0))}


def print_text(parts: dict) -> str:
    """A fingerprint's parts, as collected or observed, as one text."""
    return ":".join(str(int(parts[k] or 0)) for k in ("rows", "s0", "s1", "s2", "x"))


def settings_text(*settings) -> str:
    """A short digest of what else decides a target's content: schema, types, partitioning."""
    return hashlib.sha256(repr(settings).encode()).hexdigest()[:16]


def table_print(df: DataFrame) -> str:
    """The fingerprint of all rows of ``df``: one scan, one row to the driver."""
    aggs = print_aggregates(F.col("__h"))
    return print_text(df.select(row_hash(df.schema).alias("__h")).agg(*[c.alias(k) for k, c in aggs.items()]).first().asDict())


def partition_prints(df: DataFrame, by: list[str]) -> DataFrame:
    """(by..., rows, print): one row a partition; a partition of any size is one line a task before the shuffle."""
    keys = [F.col(f"`{b}`") for b in by]
    aggs = print_aggregates(F.col("__h"))
    found = df.select(*keys, row_hash(df.schema).alias("__h")).groupBy(*keys).agg(*[c.alias(f"__{k}") for k, c in aggs.items()])
    return found.select(*keys, F.col("__rows").alias("rows"), F.concat_ws(":", *[F.col(f"__{k}").cast("string") for k in aggs]).alias("print"))


def partition_changes(before: DataFrame, after: DataFrame, by: list[str]) -> DataFrame:
    """(by..., change) with change in added / changed / removed / kept, from the fingerprints of two states. Null partitions compare as equal."""
    keys = [F.col(f"`{b}`") for b in by]

    def tagged(df: DataFrame, side: str) -> DataFrame:
        return df.select(*keys, *[(F.col("print") if side == s else F.lit(None).cast("string")).alias(f"__{s}") for s in ("before", "after")])
    both = tagged(before, "before").unionByName(tagged(after, "after")).groupBy(*keys).agg(F.max("__before").alias("__before"), F.max("__after").alias("__after"))
    change = (F.when(F.col("__before").isNull(), "added").when(F.col("__after").isNull(), "removed")
              .when(F.col("__before") == F.col("__after"), "kept").otherwise("changed"))
    return both.select(*keys, change.alias("change"))


def snapshot_changes(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """The rows that lead from one snapshot to the next: the columns of ``after`` and ``change`` (insert / update / delete).

    ``keys`` name a row; null keys compare as equal. Old rows travel as key and hash only. Of a deleted row the keys are known and the rest is null.
    One shuffle, no join: both sides are tagged, united and grouped by key. A key that repeats in a snapshot is refused by ``upsert``, not here.
    """
    if [(f.name, f.dataType) for f in before.schema] != [(f.name, f.dataType) for f in after.schema]:
        raise ValueError("snapshots differ in schema")
    names = [F.col(f"`{k}`") for k in keys]
    row = F.struct(*[F.col(f"`{c}`") for c in after.columns])
    old = before.select(*names, row_hash(before.schema).alias("__old"), F.lit(None).cast("long").alias("__new"), F.lit(None).cast(after.select(row.alias("r")).schema["r"].dataType).alias("__row"))
    new = after.select(*names, F.lit(None).cast("long").alias("__old"), row_hash(after.schema).alias("__new"), row.alias("__row"))
    both = old.unionByName(new).groupBy(*names).agg(F.max("__old").alias("__old"), F.max("__new").alias("__new"), F.max_by("__row", "__new").alias("__row"))
    change = F.when(F.col("__old").isNull(), "insert").when(F.col("__new").isNull(), "delete").when(F.col("__old") != F.col("__new"), "update")
    out = both.withColumn("change", change).where("change IS NOT NULL")
    return out.select(*[(F.col(f"`{c}`") if c in keys else F.col(f"__row.`{c}`")).alias(c) for c in after.columns], "change")
