"""The control log table behind registry state.

Writes are single small appends from the driver (one event row each); reads are
the fold in ``operators.control.registry_state``. Secrets are never written -
only a flag that the caller supplied one.
"""

from __future__ import annotations

import json
import threading
import time
import uuid
from datetime import datetime, timezone
from urllib.parse import quote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakewright.operators.control import check_schedule, fold, public_view, registry_state
from lakewright.sinks.tables import ensure_namespace, list_tables, namespace_location

LOG_SCHEMA = T.StructType([
    T.StructField("workbook_name", T.StringType()),
    T.StructField("seq", T.LongType()),
    T.StructField("op", T.StringType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("file_name", T.StringType()),
    T.StructField("container_name", T.StringType()),
    T.StructField("workspace_id", T.StringType()),
    T.StructField("namespace", T.StringType()),
    T.StructField("data_mode", T.StringType()),
    T.StructField("source_type", T.StringType()),
    T.StructField("tables", T.ArrayType(T.StringType())),
    T.StructField("table_filter", T.ArrayType(T.StringType())),
    T.StructField("declared_types", T.MapType(T.StringType(), T.StringType())),
    T.StructField("declared_by_table", T.MapType(T.StringType(), T.MapType(T.StringType(), T.StringType()))),
    T.StructField("sniff", T.StringType()),
    T.StructField("collapse_midnight", T.BooleanType()),
    T.StructField("partitioning", T.StringType()),
    T.StructField("partition_by", T.MapType(T.StringType(), T.ArrayType(T.StringType()))),
    T.StructField("track_changes", T.BooleanType()),
    T.StructField("connection_details", T.MapType(T.StringType(), T.StringType())),
    T.StructField("enable_scheduled_refresh", T.BooleanType()),
    T.StructField("refresh_interval_minutes", T.IntegerType()),
    T.StructField("downstream_id", T.StringType()),
    T.StructField("migration_type", T.StringType()),
    T.StructField("has_secret", T.BooleanType()),
    T.StructField("status", T.StringType()),
    T.StructField("error", T.StringType()),
    # of a ``snapshot``, the fold of all earlier events of its workbook
    T.StructField("reg_seq", T.LongType()),
    T.StructField("reg_ts", T.TimestampType()),
    T.StructField("del_seq", T.LongType()),
    T.StructField("refresh_count", T.LongType()),
    T.StructField("last_refreshed_at", T.TimestampType()),
    T.StructField("last_refresh_status", T.StringType()),
    T.StructField("last_refresh_error", T.StringType()),
])
REGISTER_ATTRS = ["file_name", "container_name", "workspace_id", "namespace", "data_mode", "source_type",
                  "tables", "table_filter", "declared_types", "declared_by_table", "sniff", "collapse_midnight",
                  "partitioning", "partition_by", "track_changes", "connection_details",
                  "enable_scheduled_refresh", "refresh_interval_minutes", "downstream_id",
                  "migration_type", "has_secret"]
PATCH_ATTRS = ["tables", "enable_scheduled_refresh", "refresh_interval_minutes", "downstream_id"]

RUN_LOG_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("workbook_name", T.StringType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("pos", T.IntegerType()),
    T.StructField("rows", T.LongType()),
    T.StructField("columns", T.IntegerType()),
    T.StructField("status", T.StringType()),
    T.StructField("error", T.StringType()),
    T.StructField("new_nulls", T.MapType(T.StringType(), T.LongType())),
    T.StructField("started_at", T.TimestampType()),
    T.StructField("duration_seconds", T.DoubleType()),
    T.StructField("fingerprint", T.StringType()),
    T.StructField("partitions_written", T.LongType()),
    T.StructField("partitions_kept", T.LongType()),
    T.StructField("partitions_dropped", T.LongType()),
])


#: Files of a log (one an append) beyond which the flows compact it.
COMPACT_FILES = 200


def _folder(name: str) -> str:
    """A folder name for any workbook or table name."""
    return quote(name, safe="") or "_"


class _Versions:
    """A folder of numbered versions ``v00000, v00001, ...`` of one Parquet dataset.

    Appends go to the newest version; ``replace`` writes the next version in full and
    then removes the older ones, so readers (who take the newest complete version)
    never see a half-written state."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")

    def _fs(self):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(self.base)
        return p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _versions(self) -> list[int]:
        path, fs = self._fs()
        if not fs.exists(path):
            return []
        out = []
        for st in fs.listStatus(path):
            name = st.getPath().getName()
            if st.isDirectory() and name.startswith("v") and name[1:].isdigit() \
                    and fs.exists(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
                out.append(int(name[1:]))
        return sorted(out)

    def current(self) -> str | None:
        v = self._versions()
        return f"{self.base}/v{v[-1]:05d}" if v else None

    def files(self) -> int:
        """Data files of the newest version (one listing, no job)."""
        if self.current() is None:
            return 0
        _, fs = self._fs()
        return sum(st.getPath().getName().startswith("part-") for st in fs.listStatus(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.current())))

    def append(self, df: DataFrame) -> None:
        v = self._versions()
        df.write.mode("append").parquet(f"{self.base}/v{(v[-1] if v else 0):05d}")

    def replace(self, df: DataFrame) -> None:
        v = self._versions()
        nxt = (v[-1] + 1) if v else 0
        df.write.mode("overwrite").parquet(f"{self.base}/v{nxt:05d}")
        _, fs = self._fs()
        jvm = self.spark.sparkContext._jvm
        for old in v:
            fs.delete(jvm.org.apache.hadoop.fs.Path(f"{self.base}/v{old:05d}"), True)


class ControlLog:
    """Registry for one control namespace. Single writer per driver (a lock orders ``seq``)."""

    _lock = threading.Lock()
    _last_seq = 0

    def __init__(self, spark: SparkSession, db: str = "lakewright_control", location: str | None = None):
        """The log lives in Parquet folders (``location`` or the namespace's folder), read and
        appended by path, so it outlives any one session or catalog."""
        self.spark, self.db = spark, db
        ensure_namespace(spark, db)
        root = (location or namespace_location(spark, db)).rstrip("/")
        self.root = root
        self.log = _Versions(spark, f"{root}/control_log_events")
        self.run_log = _Versions(spark, f"{root}/run_log_events")

    # ---------------------------------------------------------------- writes
    def _next_seq(self) -> int:
        with ControlLog._lock:
            s = max(time.time_ns() // 1000, ControlLog._last_seq + 1)
            ControlLog._last_seq = s
            return s

    def _append(self, workbook: str, op: str, **fields) -> None:
        row = {f.name: None for f in LOG_SCHEMA.fields}
        row.update(fields)
        row.update(workbook_name=workbook, seq=self._next_seq(), op=op, ts=datetime.now(timezone.utc))
        with ControlLog._lock:
            self.log.append(self.spark.createDataFrame([row], LOG_SCHEMA))

    def register(self, workbook: str, *, secret_supplied: bool = False, **attrs) -> None:
        """K1: upsert; refresh counters restart."""
        unknown = set(attrs) - set(REGISTER_ATTRS)
        if unknown:
            raise ValueError(f"unknown registry fields: {sorted(unknown)}")
        check_schedule(attrs.get("enable_scheduled_refresh"), attrs.get("refresh_interval_minutes"))
        attrs.setdefault("migration_type", "workbook")
        self._append(workbook, "register", has_secret=bool(secret_supplied), **attrs)

    def record_refresh(self, workbook: str, status: str, error: str | None = None) -> None:
        """K3: unknown workbooks are ignored by the state fold."""
        self._append(workbook, "refresh", status=status, error=error)

    def patch(self, workbook: str, *, known: bool = False, **attrs) -> None:
        """K4: set attributes of a registered workbook; unknown workbook -> error.
        ``known``: the caller has just read the record, so the existence check is skipped."""
        bad = set(attrs) - set(PATCH_ATTRS)
        if bad:
            raise ValueError(f"not patchable: {sorted(bad)}")
        schedule = ("enable_scheduled_refresh", "refresh_interval_minutes")
        record = self.get(workbook) if not known or set(schedule) & set(attrs) else {}
        if record is None:
            raise KeyError(f"'{workbook}' is not registered")
        if set(schedule) & set(attrs):
            check_schedule(*[attrs[a] if attrs.get(a) is not None else record.get(a) for a in schedule])
        self._append(workbook, "patch", **attrs)

    def delete(self, workbook: str) -> bool:
        """K5: tombstone; returns whether the record existed. Target tables stay."""
        existed = self.get(workbook) is not None
        if existed:
            self._append(workbook, "delete")
        return existed

    def log_runs(self, rows: list[dict]) -> None:
        if rows:
            names = RUN_LOG_SCHEMA.fieldNames()
            with ControlLog._lock:
                self.run_log.append(self.spark.createDataFrame([{n: r.get(n) for n in names} for r in rows], RUN_LOG_SCHEMA))

    # ---------------------------------------------------------------- reads
    def _read(self, versions: _Versions, schema) -> DataFrame:
        path = versions.current()
        if path is None:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def events(self) -> DataFrame:
        return self._read(self.log, LOG_SCHEMA)

    def runs(self) -> DataFrame:
        return self._read(self.run_log, RUN_LOG_SCHEMA)

    def compact_if_many(self, most: int = COMPACT_FILES) -> dict | None:
        """Compact when the logs have more than ``most`` files; called by the flows after their last event."""
        return self.compact() if max(self.log.files(), self.run_log.files()) > most else None

    def compact(self) -> dict:
        """Fold the log into one ``snapshot`` event a registered workbook, in a new version, so its size follows the workbooks and not
        the refreshes; the state before and after is identical. The run log is rewritten in as many files as its size asks for."""
        with ControlLog._lock:
            ev = self.events()
            before = ev.count()
            obs = Observation(f"compact_{uuid.uuid4().hex}")
            folded = fold(ev, REGISTER_ATTRS, PATCH_ATTRS).observe(obs, F.count(F.lit(1)).alias("after"))
            # the new version is written in full before the old one is removed
            self.log.replace(folded.select(*[F.col(f.name).cast(f.dataType).alias(f.name) if f.name in folded.columns else F.lit(None).cast(f.dataType).alias(f.name)
                                             for f in LOG_SCHEMA.fields]))
            # rebalanced by size: many small files become few, a long log stays in parallel
            self.run_log.replace(self.runs().hint("rebalance"))
            m = obs.get
        return {"events_before": before, "events_after": int(m.get("after") or 0)}

    def prints(self, workbook: str) -> dict[str, dict]:
        """By table: fingerprint, rows and columns of the last run that left one (one row a table reaches the driver)."""
        last = self.runs().where((F.col("workbook_name") == workbook) & F.col("fingerprint").isNotNull()) \
            .groupBy("table_name").agg(F.max_by(F.struct("fingerprint", "rows", "columns"), "started_at").alias("r"))
        return {r["table_name"]: r["r"].asDict() for r in last.collect()}

    def profile_store(self, workbook: str, table: str) -> _Versions:
        """Where the profiles of a source table's files are kept."""
        return _Versions(self.spark, f"{self.root}/file_profiles/{_folder(workbook)}/{_folder(table)}")

    def partition_store(self, workbook: str, table: str) -> _Versions:
        """Where the fingerprints of a target's partitions are kept."""
        return _Versions(self.spark, f"{self.root}/partition_prints/{_folder(workbook)}/{_folder(table)}")

    def state(self, include_deleted: bool = False) -> DataFrame:
        """K2: current records."""
        return registry_state(self.events(), REGISTER_ATTRS, PATCH_ATTRS, include_deleted=include_deleted)

    def get(self, workbook: str) -> dict | None:
        """One record: the fold runs on that workbook's events only."""
        ev = self.events().where(F.col("workbook_name") == workbook)
        rows = registry_state(ev, REGISTER_ATTRS, PATCH_ATTRS, skew_safe=False).collect()
        return rows[0].asDict(recursive=True) if rows else None

    def status(self, workbook: str | None = None) -> DataFrame:
        """K6: public view with live table list and table count."""
        st = public_view(self.state(), descriptor="connection_details")
        if workbook is not None:
            st = st.where(F.col("workbook_name") == workbook)
        # one catalog listing per distinct namespace (namespaces are few; no data moves)
        names = [r["namespace"] for r in st.select("namespace").where(F.col("namespace").isNotNull())
                 .distinct().collect()]
        live_df = self.spark.createDataFrame([(n, list_tables(self.spark, n)) for n in names],
                                             "namespace string, live_tables array<string>")
        cols = st.columns
        st = st.join(live_df, "namespace", "left").select(
            *cols, F.coalesce("live_tables", F.array().cast("array<string>")).alias("live_tables"))
        return st.withColumn("table_count", F.when(F.size("live_tables") > 0, F.size("live_tables"))
                             .otherwise(F.coalesce(F.size("tables"), F.lit(0))))

    def export_json(self) -> str:
        """The state as one JSON object keyed by workbook (inverse of ``load_registry_json``), for a registry that a person would read; see ``write_json``."""
        rows = self.state().collect()
        return json.dumps({r["workbook_name"]: r.asDict(recursive=True) for r in rows}, default=str)

    def write_json(self, path: str) -> None:
        """The state as JSON lines, one record a line, written by the executors: a registry of any size."""
        self.state().write.mode("overwrite").option("ignoreNullFields", "false").json(path)
