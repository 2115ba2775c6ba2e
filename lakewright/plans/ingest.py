"""Ingest flow (L1, L6): catalog -> filter -> read -> land -> profile -> typed write -> record.

Per table, one landing job (but for directories of table files), one profile job and one write job. Tables are isolated: one failing
table is reported and the rest continue.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakewright.operators.control import check_schedule
from lakewright.operators.fingerprint import print_aggregates, print_text, row_hash, settings_text, table_print
from lakewright.operators.typing import coerce_table
from lakewright.plans.incremental import write_changed
from lakewright.plans.profiles import FileProfiles
from lakewright.plans.registry import RUN_LOG_SCHEMA
from lakewright.session import in_pool, remove_path, scratch_path
from lakewright.sinks.tables import ensure_namespace, table_exists, write_table
from lakewright.sources.catalog import DirectorySource
from lakewright.sources.jdbc import LiveSource


def select_tables(available: list[str], requested: list[str] | None) -> list[str]:
    """Exact, case-sensitive include list; None = all; an empty list or nothing left = error."""
    if requested is None:
        return list(available)
    keep = [t for t in available if t in set(requested)]
    if not keep:
        raise ValueError(f"none of the requested tables exist at the source: {requested}")
    return keep


#: Row groups of a landed copy, so that later reads split it whatever the source's partitions were.
LANDED_ROW_GROUP = 16 << 20


def land(spark: SparkSession, df: DataFrame, label: str, path: str | None = None, observation: Observation | None = None) -> DataFrame:
    """Write the raw source once to the shared scratch folder and read it back.

    Cuts lineage (a lost executor re-reads landed files, not the source) and
    makes the profile and the write see exactly the same rows. The caller removes ``path`` when done. ``observation``
    gets the parts of the table's fingerprint, taken while it is written."""
    path = path or scratch_path(spark, "landing", label, unique=True)
    out = df
    if observation is not None:
        aggs = [c.alias(k) for k, c in print_aggregates(F.col("__h")).items()]
        out = df.withColumn("__h", row_hash(df.schema)).observe(observation, *aggs).drop("__h")
    out.write.mode("overwrite").option("parquet.block.size", str(LANDED_ROW_GROUP)).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: What a pinned frame's plan may hold above its files: one pass over rows, no more than a projection or filter a row.
PASSES = {"Project", "Filter", "Union", "SubqueryAlias", "LogicalRelation"}


def pinned(df: DataFrame) -> bool:
    """Whether ``df`` reads the same rows each time: projections and filters, deterministic ones, over files that were listed when the
    frame was made. Such a source needs no copy; its files must not be replaced under a running flow."""
    plan = df._jdf.queryExecution().optimizedPlan()
    names = re.findall(r"^[\s:|+-]*(\w+)", plan.toString(), re.M)
    leaves = plan.collectLeaves()
    kinds = [leaves.apply(i) for i in range(leaves.size())]

    def listed(leaf) -> bool:
        if leaf.getClass().getSimpleName() != "LogicalRelation" or leaf.relation().getClass().getSimpleName() != "HadoopFsRelation":
            return False
        return leaf.relation().location().getClass().getSimpleName() == "InMemoryFileIndex"
    return plan.deterministic() and bool(kinds) and all(listed(x) for x in kinds) and set(names) <= PASSES | {"Relation"}


def prepare_source(spark: SparkSession, source, df: DataFrame, land_mode, label: str, observation: Observation | None = None):
    """The one snapshot that both the profile and the write read. Returns (frame, release, landed).

    ``auto`` lands every source but files whose listing is fixed (``pinned``), also those behind a ``FrameSource``;
    ``True`` lands those too, for files that may be replaced meanwhile; ``False`` lands nothing.
    """
    if land_mode is True or (land_mode == "auto" and not isinstance(source, DirectorySource) and not pinned(df)):
        path = scratch_path(spark, "landing", label, unique=True)
        try:
            landed = land(spark, df, label, path=path, observation=observation)
        except Exception:
            remove_path(spark, path)
            raise
        # the landed copy is removed once the table is written (or has failed)
        return landed, lambda: remove_path(spark, path), True
    return df, None, False


class Tracker:
    """What the last run left of a workbook's targets: fingerprints of tables, and of partitions where a target has them."""

    def __init__(self, control, workbook: str):
        self.control, self.workbook = control, workbook
        self.last = control.prints(workbook)

    def known(self, table: str) -> dict | None:
        """The last run's row of ``table``, unless that run failed (its fingerprint is empty)."""
        row = self.last.get(table)
        return row if row and row["fingerprint"] else None

    def parts(self, table: str) -> DataFrame | None:
        path = self.control.partition_store(self.workbook, table).current()
        return None if path is None or self.known(table) is None else self.control.spark.read.parquet(path)

    def keep(self, table: str, prints: DataFrame) -> None:
        self.control.partition_store(self.workbook, table).replace(prints)


def _declared_for(declared, table: str) -> dict:
    if not declared:
        return {}
    if all(isinstance(v, dict) for v in declared.values()):
        return declared.get(table, {})
    return declared        # one map per workbook, applied by column name


def _columns_for(partition_by, table: str) -> list[str] | None:
    if not partition_by:
        return None
    return partition_by.get(table) if isinstance(partition_by, dict) else list(partition_by)


def load_one(spark, source, table: str, db: str, *, declared=None, sniff="undeclared", land_mode="auto",
             collapse_midnight=False, partition_by=None, tracker: Tracker | None = None, pos: int = 0, run_id: str = "") -> dict:
    """L6 for one table; never raises - failures come back as a ``failed`` row.

    With a ``tracker``, a table whose rows, types and settings are those of the last run is not written at all (``unchanged``), and
    of a partitioned target only the partitions whose rows changed are; of a directory source only new files are profiled. The fingerprint of landed rows is taken in the landing write, that of
    others by one scan, unless a directory source lists the very files of the last run.
    """
    t0 = time.time()
    started = datetime.now(timezone.utc)
    try:
        obs = Observation(f"land_{uuid.uuid4().hex}") if tracker else None
        df, release, landed = prepare_source(spark, source, source.read(table), land_mode, table, obs)
        by = _columns_for(partition_by, table)
        types = _declared_for(declared, table)
        try:
            mark = None
            if tracker:
                last, there = tracker.known(table), table_exists(spark, db, table)
                settings = settings_text(df.schema.json(), sorted(types.items()), sniff, collapse_midnight, by)
                listing = settings_text(source.files(table)) if not landed and isinstance(source, DirectorySource) else ""
                same = bool(last) and there and bool(listing) and last["fingerprint"].endswith(f"/{settings}@{listing}")  # the very files: nothing is read
                mark = last["fingerprint"] if same else f"{print_text(obs.get) if landed else table_print(df)}/{settings}@{listing}"
                if same or last and there and last["fingerprint"].split("@")[0] == mark.split("@")[0]:
                    return {"table_name": table, "rows": last["rows"], "columns": last["columns"], "status": "unchanged", "error": None, "new_nulls": {},
                            "started_at": started, "duration_seconds": round(time.time() - t0, 2), "fingerprint": mark, "run_id": run_id, "pos": pos}
            profiler = None
            if tracker and not landed and isinstance(source, DirectorySource):
                profiler = FileProfiles(source, table, tracker.control.profile_store(tracker.workbook, table),
                                        settings_text(df.schema.json(), sorted(types.items()), sniff, collapse_midnight))
            typed = coerce_table(df, types, sniff=sniff, collapse_midnight=collapse_midnight, profiler=profiler)
            if tracker and by:
                res, prints, path = write_changed(spark, typed, db, table, by, tracker.parts(table))
                if res["status"] != "skipped_empty":
                    tracker.keep(table, prints)
                remove_path(spark, path)
            else:
                res = write_table(spark, typed, db, table, partition_by=by)
        finally:
            if release is not None:
                release()
        res.update(error=None, files_profiled=profiler.profiled if profiler else None, fingerprint=mark if res["status"] != "skipped_empty" else "" if tracker else None)
    except Exception as e:  # noqa: BLE001 - isolation per table
        res = {"table_name": table, "rows": 0, "columns": 0, "status": "failed", "error": str(e).split("\n")[0],
               "new_nulls": {}, "started_at": started, "duration_seconds": round(time.time() - t0, 2),
               "fingerprint": "" if tracker else None}     # what the target holds now is not known
    res.update(run_id=run_id, pos=pos)
    return res


def load_many(spark, source, tables: list[str], db: str, *, parallel: int = 1, **kw) -> list[dict]:
    """Write many tables; ``parallel`` > 1 submits several table jobs at once (FAIR pools)."""
    run_id = kw.pop("run_id", None) or uuid.uuid4().hex
    args = [(t, i) for i, t in enumerate(tables)]
    if parallel <= 1:
        return [load_one(spark, source, t, db, pos=i, run_id=run_id, **kw) for t, i in args]
    def one(a):
        in_pool(spark, f"table-{a[1] % parallel}")
        return load_one(spark, source, a[0], db, pos=a[1], run_id=run_id, **kw)

    with ThreadPoolExecutor(max_workers=parallel) as ex:
        return list(ex.map(one, args))


def run_log_frame(spark: SparkSession, results: list[dict], workbook: str = "") -> DataFrame:
    rows = [{**{f.name: None for f in RUN_LOG_SCHEMA.fields}, **r, "workbook_name": workbook,
             "rows": int(r.get("rows") or 0), "columns": int(r.get("columns") or 0),
             "duration_seconds": float(r.get("duration_seconds") or 0.0)} for r in results]
    rows = [{k: v for k, v in r.items() if k in RUN_LOG_SCHEMA.fieldNames()} for r in rows]
    return spark.createDataFrame(rows, RUN_LOG_SCHEMA)


def summarize(results: list[dict], flow: str = "migrate") -> dict:
    """totals and overall status (ours: all failed -> failed, for both flows)."""
    ok = [r for r in results if r["status"] != "failed"]
    bad = [r for r in results if r["status"] == "failed"]
    status = "success" if not bad else ("partial" if ok else "failed")
    msg = f"'{{wb}}' {'migrated' if flow == 'migrate' else 'refreshed'} - {len(ok)} table(s)."
    if bad:
        msg += f" {len(bad)} failed."
    return {
        "status": status,
        "message_template": msg,
        "total_migrated": len(ok),
        "total_failed": len(bad),
        "total_rows": sum(int(r.get("rows") or 0) for r in ok),
        "error_summary": "; ".join(f"{r['table_name']}: {r['error']}" for r in sorted(bad, key=lambda r: r["pos"]))
        or None,
    }


def ingest(spark: SparkSession, source, db: str, *, workbook: str | None = None, tables: list[str] | None = None,
           declared=None, sniff: str = "undeclared", collapse_midnight: bool = False, land_mode="auto", parallel: int = 1,
           partition_by: dict | None = None, track_changes: bool = False, control=None, register: dict | None = None, secret_supplied: bool = False, user_filter: list[str] | None = None) -> dict:
    """L1: migrate the tables of ``source`` into namespace ``db``.

    ``tables`` names what to load now (None = all; an empty list is an error). ``user_filter`` is what the user asked
    for, stored for refreshes; it defaults to ``tables``. Types, sniffing and midnight rule are stored as given, so a
    refresh types the tables the same way. Only tables that did not fail are registered. ``partition_by`` names partition columns by
    table. With ``track_changes`` (which needs a ``control`` log) fingerprints are kept, and refreshes write only what changed.
    Returns ``{"status", "summary", "tables": [...], "namespace": ...}``. With a
    ``control`` log the workbook is registered (K1) and per-table rows appended
    to the run log.
    """
    started = time.time()
    if control is not None:
        check_schedule((register or {}).get("enable_scheduled_refresh"), (register or {}).get("refresh_interval_minutes"))
    ns = ensure_namespace(spark, db)
    chosen = select_tables(source.list_tables(), tables)
    wb = workbook or db
    if track_changes and control is None:
        raise ValueError("track_changes needs a control log to keep fingerprints in")
    results = load_many(spark, source, chosen, db, declared=declared, sniff=sniff, collapse_midnight=collapse_midnight,
                        land_mode=land_mode, parallel=parallel, partition_by=partition_by, tracker=Tracker(control, wb) if track_changes else None)
    summary = summarize(results)
    if control is not None:
        per_table = bool(declared) and all(isinstance(v, dict) for v in declared.values())
        asked = tables if user_filter is None else user_filter
        control.register(wb, secret_supplied=secret_supplied, namespace=db,
                         tables=[r["table_name"] for r in results if r["status"] != "failed"],
                         table_filter=list(asked) if asked else None,
                         declared_types=None if per_table or not declared else declared,
                         declared_by_table=declared if per_table else None,
                         sniff=sniff, collapse_midnight=collapse_midnight, partition_by=partition_by or None,
                         track_changes=track_changes or None, **(register or {}))
        control.log_runs([{**{k: v for k, v in r.items() if k in RUN_LOG_SCHEMA.fieldNames()},
                           "workbook_name": wb} for r in results])
        control.compact_if_many()
    return {"workbook_name": wb, "namespace": ns, "status": summary["status"], "summary": summary,
            "message": summary["message_template"].replace("{wb}", wb),
            "tables": results, "duration_seconds": round(time.time() - started, 2)}


def table_results_frame(spark: SparkSession, results: list[dict]) -> DataFrame:
    """The per-table metrics (B5) as a DataFrame: table_name, rows, columns, status."""
    return spark.createDataFrame([(r["table_name"], int(r["rows"]), int(r["columns"]), r["status"])
                                  for r in results],
                                 "table_name string, rows bigint, columns int, status string") \
        .select("table_name", "rows", F.col("columns"), "status")


def migrate_workbook(spark: SparkSession, workbook_path: str, db: str, *, extract_source=None, credentials=None,
                     tables: list[str] | None = None, sniff: str = "undeclared", control=None,
                     schedule: dict | None = None, partitioning: dict | None = None) -> dict:
    """L1 end to end for one workbook file (plain or packaged).

    The workbook is parsed by the corpus job (declared column types, table names,
    connection). Extracted mode reads ``extract_source`` (e.g. a ``DirectorySource``
    of the unpacked extract); live mode builds a JDBC source from the workbook's
    connection plus caller-supplied ``credentials`` ({"user", "password"}). Only the
    workbook's tables are ingested, further narrowed by ``tables`` (C1); a filter that leaves none is an
    error, as is a workbook without tables. A live source is probed first (A8). ``partitioning``
    gives per-table partitioned-read options for live sources (see ``LiveSource``); it is stored for refreshes.
    """
    check_schedule((schedule or {}).get("enable_scheduled_refresh"), (schedule or {}).get("refresh_interval_minutes"))
    from lakewright.operators.workbook import declared_types_of, extract_metadata
    from lakewright.plans.registry import ControlLog  # noqa: F401 - type of ``control``
    from lakewright.sources.jdbc import source_for
    from lakewright.sources.workbooks import read_workbooks

    meta = extract_metadata(read_workbooks(spark, workbook_path))
    heads = meta["parsed"].select("workbook", "path", "has_extract", "error", "parse_error").collect()
    if len(heads) != 1:
        raise ValueError(f"expected one workbook at {workbook_path}, found {len(heads)}")
    wb = heads[0]
    if wb["error"] or wb["parse_error"]:
        raise ValueError(f"workbook '{wb['workbook']}': {wb['error'] or wb['parse_error']}")
    declared = declared_types_of(meta["columns"], wb["workbook"])
    wb_tables = [r["table"] for r in meta["tables"].orderBy("pos").collect()]
    conn = meta["connections"].first()
    if extract_source is not None or wb["has_extract"]:
        if extract_source is None:
            raise ValueError("packaged workbook with an extract: pass extract_source (unpacked table files)")
        root = getattr(extract_source, "root", None)
        source, mode, stype, params = extract_source, "extracted", "extract", {"extract_root": root} if root else {}
        wanted = tables
    else:
        if conn is None or conn["source_type"] is None:
            raise ValueError(conn["error"] if conn else "no connection")
        creds = credentials or {}
        source = LiveSource(spark, source_for(conn["source_type"], dict(conn["params"]), user=creds.get("user"),
                                              password=creds.get("password")), partitioning=partitioning)
        mode, stype, params = "live", conn["source_type"], dict(conn["params"])
        wanted = [t for t in wb_tables if tables is None or t in tables]
        if not wanted:
            raise ValueError(f"workbook '{wb['workbook']}' has none of the requested tables: {tables}"
                             if wb_tables else f"workbook '{wb['workbook']}' names no tables")
        source.probe()
    register = {"file_name": wb["path"].rsplit("/", 1)[-1], "data_mode": mode, "source_type": stype,
                "connection_details": params, "partitioning": json.dumps(partitioning) if partitioning else None,
                **(schedule or {})}
    return ingest(spark, source, db, workbook=wb["workbook"], tables=wanted, declared=declared, sniff=sniff,
                  control=control, register=register, user_filter=tables or [],
                  secret_supplied=bool((credentials or {}).get("password")))
