"""Writes that touch only what has changed: partitions whose fingerprint moved (L2, L4, B1) and keyed upserts (K1 on a target).

Both replace whole partitions of a partitioned target by Spark's dynamic partition overwrite, which writes beside the
target and moves files in when the job commits; partitions that hold no rows any more are dropped. Other partitions keep their files.
A reader that runs during the commit may see a partition's old and new state change under it; a write of the whole table
(``sinks.tables.write_table``) does not have that window.
"""

from __future__ import annotations

import time
import uuid
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakewright.operators.fingerprint import partition_changes, partition_prints
from lakewright.operators.typing import TypedTable
from lakewright.session import remove_path, scratch_path
from lakewright.sinks.tables import delete_path, ident, sql_text, table_exists, table_location, write_table

#: Partitions that a filter names one by one, so that the scan is pruned before it starts; beyond, a semi join does it.
NAMED = 1000
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def partition_columns(spark: SparkSession, db: str, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(ident(db, table)) if c.isPartition]


def _same(df: DataFrame, other: DataFrame, by: list[str], how: str) -> DataFrame:
    """Semi or anti join on ``by``, nulls equal."""
    named = other.select(*[F.col(f"`{b}`").alias(f"__k{i}") for i, b in enumerate(by)])
    return df.join(named, reduce(lambda a, c: a & c, [F.col(f"`{b}`").eqNullSafe(F.col(f"__k{i}")) for i, b in enumerate(by)]), how)


def _within(df: DataFrame, parts: DataFrame, by: list[str]) -> DataFrame:
    """Rows of ``df`` in the partitions ``parts``."""
    few = parts.select(*[F.col(f"`{b}`") for b in by]).limit(NAMED + 1).collect()
    if len(few) > NAMED:
        return _same(df, parts, by, "left_semi")
    if not few:
        return df.where(F.lit(False))
    each = [reduce(lambda a, c: a & c, [F.col(f"`{b}`").isNull() if r[i] is None else F.col(f"`{b}`") == F.lit(r[i]) for i, b in enumerate(by)]) for r in few]
    return df.where(reduce(lambda a, c: a | c, each))


def _spec(spark: SparkSession, by: list[str], row) -> str:
    """A partition in SQL; dates and numbers as Spark writes them in a partition path."""
    shown = [NULL_PARTITION if v is None else v if isinstance(v, str) else str(v).lower() if isinstance(v, bool) else str(v) for v in row]
    return ", ".join(f"{ident(b)} = '{sql_text(v)}'" for b, v in zip(by, shown))


def drop_partitions(spark: SparkSession, db: str, table: str, by: list[str], parts: DataFrame) -> int:
    """Drop the named partitions with their files; ``parts`` has a row a partition of one table."""
    target, root, n = ident(db, table), table_location(spark, db, table), 0
    for row in parts.select(*[F.col(f"`{b}`") for b in by]).collect():
        spec = _spec(spark, by, row)
        shown = spark.sql(f"DESCRIBE TABLE EXTENDED {target} PARTITION ({spec})").collect()
        # the partition's own location comes first, the table's after it
        at = next((r["data_type"].rstrip("/") for r in shown if r["col_name"] == "Location"), None)
        spark.sql(f"ALTER TABLE {target} DROP IF EXISTS PARTITION ({spec})")
        if at and at != root and at.startswith(f"{root}/"):
            delete_path(spark, at)
        n += 1
    return n


def _overwrite_partitions(frame: DataFrame, db: str, table: str) -> dict:
    """Replace the partitions that ``frame`` has rows for; returns its observed row count."""
    spark = frame.sparkSession
    obs = Observation(f"partitions_{uuid.uuid4().hex}")
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        target = spark.table(ident(db, table)).columns
        frame.select(*[F.col(f"`{c}`") for c in target]).observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").insertInto(ident(db, table))
    finally:
        spark.conf.set(key, before)
    spark.catalog.refreshTable(ident(db, table))
    return obs.get


def _staged(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    path = scratch_path(df.sparkSession, "incremental", label, unique=True)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def _fits(spark: SparkSession, db: str, table: str, frame: DataFrame, by: list[str]) -> bool:
    """Whether the target exists with these columns (in any order) and this partitioning."""
    if not table_exists(spark, db, table) or partition_columns(spark, db, table) != list(by):
        return False
    have = {f.name: f.dataType for f in spark.table(ident(db, table)).schema}
    return have == {f.name: f.dataType for f in frame.schema}


def write_changed(spark: SparkSession, data, db: str, table: str, by: list[str], known: DataFrame | None) -> tuple[dict, DataFrame, str]:
    """Write the partitions of ``data`` (DataFrame or TypedTable) whose fingerprint is not that of ``known``, drop those that are gone.

    Without ``known`` fingerprints, or where the target has other columns or another partitioning, the whole table is written. Returns the
    metrics row of ``write_table`` with partitions_written / partitions_kept / partitions_dropped, the new fingerprints, and the scratch folder
    they are in. An empty frame leaves the target as it is (B4).
    """
    started, t0 = datetime.now(timezone.utc), time.time()
    frame = data.df if isinstance(data, TypedTable) else data
    prints, path = _staged(partition_prints(frame, by), "prints")
    total = prints.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("parts")).first()
    if known is None or not total["rows"] or not _fits(spark, db, table, frame, by):
        res = write_table(spark, data, db, table, partition_by=by)
        res.update(partitions_written=total.parts if res["status"] == "success" else 0, partitions_kept=0, partitions_dropped=0)
        return res, prints, path
    changes, change_path = _staged(partition_changes(known, prints, by), "changes")
    counts = {r.change: r["count"] for r in changes.groupBy("change").count().collect()}
    moved = counts.get("added", 0) + counts.get("changed", 0)
    if moved:
        _overwrite_partitions(_within(frame, changes.where("change IN ('added', 'changed')"), by), db, table)
    dropped = drop_partitions(spark, db, table, by, changes.where("change = 'removed'")) if counts.get("removed") else 0
    remove_path(spark, change_path)
    return {"table_name": table, "rows": int(total["rows"]), "columns": len(frame.columns), "status": "success" if moved or dropped else "unchanged", "new_nulls": {},
            "started_at": started, "duration_seconds": round(time.time() - t0, 2), "partitions_written": moved,
            "partitions_kept": counts.get("kept", 0), "partitions_dropped": dropped}, prints, path


def upsert(spark: SparkSession, changes: DataFrame, db: str, table: str, keys: list[str], *, order: str | None = None,
           deleted: str | None = None, partition_by: list[str] | None = None) -> dict:
    """Merge ``changes`` into ``db.table`` by ``keys``: rows of known keys are replaced, new ones added, those marked ``deleted`` removed.

    ``changes`` has the target's columns, and may have a boolean column ``deleted`` and a column ``order``; of several
    rows of one key that with the largest ``order`` counts, and without ``order`` a repeated key is an error. Null keys compare as equal.
    A semi join of the target's keys finds the partitions that hold changed rows; those, and the ones that new rows go to, are rewritten as a
    whole and no others are read beyond their keys. A row that moves to another partition leaves its old one. A target
    without partitions is rewritten into a new version. A missing target is created with ``partition_by``.
    Returns inserted, updated, deleted, partitions_written, partitions_dropped.
    """
    flag = F.coalesce(F.col(f"`{deleted}`"), F.lit(False)) if deleted else F.lit(False)
    extra = {x for x in (order, deleted) if x}
    columns = [c for c in changes.columns if c not in extra]
    names = [F.col(f"`{k}`") for k in keys]
    row = F.struct(*[F.col(f"`{c}`") for c in columns], flag.alias("__gone"))
    if order:
        latest = changes.groupBy(*[n.alias(f"__g{i}") for i, n in enumerate(names)]).agg(F.max_by(row, F.struct(F.col(f"`{order}`"), F.xxhash64(row))).alias("__row"))
        latest = latest.select("__row.*")
    else:
        latest = changes.select(*[F.col(f"`{c}`") for c in columns], flag.alias("__gone"))
    latest, path = _staged(latest, "changes")
    held_path = None
    try:
        if not order and latest.groupBy(*names).count().where("count > 1").limit(1).count():
            raise ValueError(f"several changes of one key of {keys}: name an order column")
        live = latest.where("NOT __gone").drop("__gone")
        if not table_exists(spark, db, table):
            res = write_table(spark, live, db, table, partition_by=partition_by)
            return {"inserted": res["rows"], "updated": 0, "deleted": 0, "partitions_written": None, "partitions_dropped": 0}
        target = spark.table(ident(db, table))
        if {f.name: f.dataType for f in target.schema} != {f.name: f.dataType for f in live.schema}:
            raise ValueError(f"upsert into {db}.{table}: schema differs from the target")
        by = partition_columns(spark, db, table)
        held, held_path = _staged(_same(target.select(*dict.fromkeys(keys + by)), latest, keys, "left_semi"), "held")
        seen = held.select(*names).distinct()
        counts = latest.agg(F.count(F.lit(1)).alias("all"), F.count_if("__gone").alias("gone")).first()
        updated = _same(live, seen, keys, "left_semi").count()
        removed = _same(latest.where("__gone"), seen, keys, "left_semi").count()
        out = {"inserted": counts["all"] - counts["gone"] - updated, "updated": updated, "deleted": removed, "partitions_written": 0, "partitions_dropped": 0}
        if not out["inserted"] + updated + removed:
            return out
        if not by:
            kept = _same(target, latest, keys, "left_anti")
            write_table(spark, kept.unionByName(live), db, table, truncate_on_empty=True)
            return out | {"partitions_written": None}
        cols = [F.col(f"`{b}`") for b in by]
        touched = held.select(*cols).unionByName(live.select(*cols)).distinct()
        own = _within(target, touched, by)
        # rows that stay, rows that come: a partition with neither is dropped
        sizes = own.select(*cols, F.lit(1).alias("n")).unionByName(held.select(*cols, F.lit(-1).alias("n"))).unionByName(live.select(*cols, F.lit(1).alias("n")))
        sizes, size_path = _staged(sizes.groupBy(*cols).agg(F.sum("n").alias("n")), "sizes")
        full = sizes.agg(F.count_if(F.col("n") > 0)).first()[0]
        if full:
            _overwrite_partitions(_same(own, latest, keys, "left_anti").unionByName(live), db, table)
        dropped = drop_partitions(spark, db, table, by, sizes.where("n = 0"))
        remove_path(spark, size_path)
        return out | {"partitions_written": full, "partitions_dropped": dropped}
    finally:
        remove_path(spark, path)
        if held_path:
            remove_path(spark, held_path)
