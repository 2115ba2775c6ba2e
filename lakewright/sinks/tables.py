"""Target tables: staged overwrite with row metrics (B1-B5), drop (B6), list (B7),
get-or-create namespace (B8).

Overwrite safety (Spark refuses to overwrite a table it reads, and a plain
Parquet overwrite is not atomic): the frame is written to a fresh version
folder ``<namespace>/_versions/<table>/<id>`` first, with an ``Observation``
counting rows and new nulls during that same write. Only a non-empty version
replaces the target, and the swap is catalog metadata only. Where the schema stays, the
table entry is pointed at the new folder. Otherwise a new entry is made and checked under another
name, and the two entries change names; an error on the way puts the old one back.
The version before the current one is kept until the next write, so queries that run during a
swap finish; a failed write leaves no folder behind. No data is renamed or copied (a directory
rename is a full copy on object stores). Versions live in the target namespace, i.e. on the
shared lakehouse storage, so a lost executor only re-runs its tasks.
"""

from __future__ import annotations

import time
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakewright.operators.typing import TypedTable

VERSIONS_DIR = "_versions"


def ident(*parts: str) -> str:
    return ".".join("`" + p.replace("`", "``") + "`" for p in parts)


def ensure_namespace(spark: SparkSession, name: str) -> dict:
    """Get-or-create; catalog names are case-insensitive. Reports ``created``."""
    existed = spark.catalog.databaseExists(name)
    if not existed:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {ident(name)}")
    return {"namespace": name, "created": not existed}


def list_tables(spark: SparkSession, db: str) -> list[str]:
    """Permanent tables of a namespace; any failure -> empty list."""
    try:
        return sorted(t.name for t in spark.catalog.listTables(db) if not t.isTemporary)
    except Exception:
        return []


def table_exists(spark: SparkSession, db: str, table: str) -> bool:
    try:
        return spark.catalog.tableExists(f"{ident(db, table)}")
    except Exception:
        return False


def _fs_path(spark: SparkSession, uri: str):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(uri)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def namespace_location(spark: SparkSession, db: str) -> str:
    return spark.catalog.getDatabase(db).locationUri.rstrip("/")


def versions_root(spark: SparkSession, db: str, table: str) -> str:
    """Folder holding the written versions of ``db.table``."""
    return f"{namespace_location(spark, db)}/{VERSIONS_DIR}/{table.lower()}"


def table_location(spark: SparkSession, db: str, table: str) -> str | None:
    """Storage location of a catalog table, or None when there is no such table."""
    if not table_exists(spark, db, table):
        return None
    # a command result is local: filtering it on the driver starts no job
    rows = [r for r in spark.sql(f"DESCRIBE TABLE EXTENDED {ident(db, table)}").collect() if r["col_name"] == "Location"]
    return rows[0]["data_type"].rstrip("/") if rows else None


def delete_path(spark: SparkSession, uri: str) -> None:
    path, fs = _fs_path(spark, uri)
    if fs.exists(path):
        fs.delete(path, True)


def _delete_other_versions(spark: SparkSession, db: str, table: str, *keep: str) -> None:
    """Remove version folders of ``db.table`` other than ``keep`` (retired ones, or left by a session whose
    catalog is gone or by a write that died before the swap)."""
    root, fs = _fs_path(spark, versions_root(spark, db, table))
    if not fs.exists(root):
        return
    kept = {_qualified(spark, k) for k in keep}
    for st in fs.listStatus(root):
        p = st.getPath()
        if str(p.toString()).rstrip("/") not in kept:
            fs.delete(p, True)


def _qualified(spark: SparkSession, uri: str) -> str:
    path, fs = _fs_path(spark, uri)
    return str(fs.makeQualified(path).toString()).rstrip("/")


def _is_version_of(spark: SparkSession, location: str | None, db: str, table: str) -> bool:
    """Whether ``location`` is one of our version folders of ``db.table`` (else it is not ours to delete)."""
    if not location:
        return False
    return _qualified(spark, location).startswith(_qualified(spark, versions_root(spark, db, table)) + "/")


def clear_orphan_location(spark: SparkSession, db: str, table: str) -> bool:
    """Remove the default directory of ``db.table`` when the catalog has no such table.

    Such a directory is left by a session whose (in-memory) catalog is gone or by a
    write that died before registering the table; it is not a table, and it would
    block creating one. Returns whether something was removed."""
    if table_exists(spark, db, table):
        return False
    path, fs = _fs_path(spark, f"{namespace_location(spark, db)}/{table.lower()}")
    if fs.exists(path):
        fs.delete(path, True)
        return True
    return False


def write_batch_partition(df: DataFrame, db: str, table: str, batch_column: str) -> None:
    """Idempotent micro-batch write: replace only the partition(s) present in ``df``.

    Uses the frame's own session (streams run batches on a cloned session), so the
    dynamic overwrite setting applies to this write; a retried batch overwrites its
    earlier attempt and an empty batch touches nothing."""
    spark = df.sparkSession
    prev = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        if table_exists(spark, db, table):
            df.write.mode("overwrite").insertInto(ident(db, table))
        else:
            clear_orphan_location(spark, db, table)
            df.write.mode("overwrite").format("parquet").partitionBy(batch_column).saveAsTable(ident(db, table))
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", prev)


def drop_tables(spark: SparkSession, db: str, names) -> list[dict]:
    """Drop in sorted order; a missing table counts as dropped; failures are reported, not raised."""
    out = []
    for n in sorted(set(names)):
        try:
            loc = table_location(spark, db, n)
            spark.sql(f"DROP TABLE IF EXISTS {ident(db, n)}")
            if _is_version_of(spark, loc, db, n):      # our version folders are external: remove the data too
                delete_path(spark, versions_root(spark, db, n))
            out.append({"table_name": n, "status": "dropped", "error": None})
        except Exception as e:  # noqa: BLE001 - isolation per table
            out.append({"table_name": n, "status": "failed", "error": str(e)})
    return out


def _ddl(spark: SparkSession, schema) -> str:
    return spark._jvm.org.apache.spark.sql.types.DataType.fromJson(schema.json()).toDDL()


def _plain(schema) -> list:
    return [(f.name, f.dataType.simpleString()) for f in schema]


def _swap(spark: SparkSession, db: str, table: str, version: str, schema, fmt: str, partition_by) -> str | None:
    """Point ``db.table`` at ``version``; returns the location it had. Readers find the old or the new table, and
    an error leaves the old one."""
    target = ident(db, table)
    old = table_location(spark, db, table)
    if old is not None and not partition_by and _is_version_of(spark, old, db, table):
        info = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {target}").collect()}
        if "# Partition Information" not in info and info.get("Provider", "").lower() == fmt.lower() \
                and _plain(spark.table(target).schema) == _plain(schema):
            spark.sql(f"ALTER TABLE {target} SET LOCATION '{sql_text(version)}'")
            return old
    fresh = ident(db, f"__new_{uuid.uuid4().hex}")
    create_entry(spark, fresh, schema, fmt, version, partition_by)
    try:
        if partition_by:
            spark.catalog.recoverPartitions(fresh)
        spark.table(fresh).limit(1).collect()
        exchange_entry(spark, db, table, fresh)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {fresh}")
        raise
    return old


def create_entry(spark: SparkSession, name: str, schema, fmt: str, location: str, partition_by=None) -> None:
    """An external table entry with an explicit schema (so an empty one has it too)."""
    parts = f" PARTITIONED BY ({', '.join(ident(p) for p in partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE {name} ({_ddl(spark, schema)}) USING {fmt}{parts} LOCATION '{sql_text(location)}'")


def exchange_entry(spark: SparkSession, db: str, table: str, fresh: str) -> None:
    """Give the entry ``fresh`` the name ``db.table``; an error puts the old entry back."""
    target, spare = ident(db, table), ident(db, f"__old_{uuid.uuid4().hex}")
    old = table_exists(spark, db, table)
    if old:
        spark.sql(f"ALTER TABLE {target} RENAME TO {spare}")
    try:
        spark.sql(f"ALTER TABLE {fresh} RENAME TO {target}")
    except Exception:
        if old:
            spark.sql(f"ALTER TABLE {spare} RENAME TO {target}")
        raise
    if old:
        spark.sql(f"DROP TABLE IF EXISTS {spare}")   # a managed target takes its folder with it


def sql_text(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def write_table(spark: SparkSession, data, db: str, table: str, *, mode: str = "overwrite",
                fmt: str = "parquet", truncate_on_empty: bool = False, partition_by=None) -> dict:
    """Write ``data`` (DataFrame or TypedTable) into ``db.table``.

    overwrite: staged, schema replaced (B2); empty result -> ``skipped_empty`` and the
    old rows stay (B4) unless ``truncate_on_empty``.
    append: requires the target's schema to equal the frame's (no silent schema change).
    Returns the metrics row: table_name, rows, columns, status, new_nulls, started_at, duration_seconds.
    """
    started = datetime.now(timezone.utc)
    t0 = time.time()
    obs = Observation(f"write_{uuid.uuid4().hex}")
    if isinstance(data, TypedTable):
        frame = data.observed(obs)
    else:
        frame = data.observe(obs, F.count(F.lit(1)).alias("rows"))
    ncols = len(frame.columns)
    target = ident(db, table)

    if mode == "append":
        if table_exists(spark, db, table):
            have = spark.table(target).schema
            if [(f.name.lower(), f.dataType) for f in have] != [(f.name.lower(), f.dataType) for f in frame.schema]:
                raise ValueError(f"append to {db}.{table}: schema differs from the target")
        else:
            clear_orphan_location(spark, db, table)
        w = frame.write.mode("append").format(fmt)
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.saveAsTable(target)
        m = obs.get
        rows = int(m.get("rows", 0) or 0)
        status = "success" if rows else "skipped_empty"
    elif mode == "overwrite":
        version = f"{versions_root(spark, db, table)}/{uuid.uuid4().hex}"
        w = frame.write.mode("overwrite").format(fmt)
        if partition_by:
            w = w.partitionBy(*partition_by)
        try:
            w.save(version)
            m = obs.get
            rows = int(m.get("rows", 0) or 0)
            if rows == 0 and not truncate_on_empty:
                delete_path(spark, version)
                status = "skipped_empty"
            else:
                clear_orphan_location(spark, db, table)
                old = _swap(spark, db, table, version, frame.schema, fmt, partition_by)
                _delete_other_versions(spark, db, table, version, *([old] if old else []))
                status = "success" if rows else "skipped_empty"
        except Exception:
            delete_path(spark, version)
            raise
    else:
        raise ValueError(f"unsupported write mode {mode!r}")

    new_nulls = {k[len("new_nulls__"):]: int(v or 0) for k, v in m.items() if k.startswith("new_nulls__")}
    return {
        "table_name": table,
        "rows": rows,
        "columns": ncols,
        "status": status,
        "new_nulls": new_nulls,
        "started_at": started,
        "duration_seconds": round(time.time() - t0, 2),
    }
