"""Refresh flows (L2-L5): registered workbook -> schema sync -> re-read -> overwrite -> record."""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from lakewright.operators.control import due_jobs, jobs
from lakewright.plans.ingest import Tracker, load_many, summarize
from lakewright.session import in_pool
from lakewright.sinks.tables import drop_tables
from lakewright.sources.jdbc import source_from_record


def name_diff(source: list[str], registered: list[str]) -> tuple[list[str], list[str]]:
    """I1, I2 for one workbook, whose two name lists are on the driver already: (added, removed), case folded.
    ``operators.sync.catalog_diff`` does the same for a corpus of workbooks."""
    have, known = {t.lower() for t in source}, {t.lower() for t in registered}
    return sorted({t for t in source if t.lower() not in known}), sorted({t for t in registered if t.lower() not in have})


def refresh(spark: SparkSession, control, workbook: str, source=None, *, credentials: dict | None = None,
            tables: list[str] | None = None, sniff: str | None = None, allow_drop_all: bool = False, parallel: int = 1) -> dict:
    """Refresh one registered workbook, by name alone or from a given ``source``.

    Without ``source`` it is rebuilt from the stored record (``credentials`` are the caller's; none are stored).
    Schema sync compares the source catalog with the registered tables (case folded), drops targets that left the
    source, and loads the source's tables, narrowed by the user's stored filter: tables new at the source
    are loaded too. Types and sniffing stored at registration are applied again. If discovery fails the
    registered list is used. A workbook registered with ``track_changes`` has only changed tables and partitions written. ``tables`` reloads just those registered tables, without schema sync. A source listing zero tables is refused unless ``allow_drop_all``. Any error is
    recorded as a failed refresh before it is raised.
    """
    rec = control.get(workbook)
    if rec is None:
        raise KeyError(f"'{workbook}' is not registered")
    try:
        return _refresh(spark, control, rec, source if source is not None else source_from_record(spark, rec, credentials),
                        tables=tables, sniff=sniff, allow_drop_all=allow_drop_all, parallel=parallel)
    except Exception as e:
        control.record_refresh(workbook, "failed", str(e).split("\n")[0])
        raise


def _refresh(spark, control, rec: dict, source, *, tables, sniff, allow_drop_all, parallel) -> dict:
    started = time.time()
    workbook, db = rec["workbook_name"], rec["namespace"]
    registered = list(rec.get("tables") or [])
    wanted = set(rec.get("table_filter") or [])
    try:
        source_tables = list(source.list_tables()) if tables is None else None
    except Exception:  # noqa: BLE001 - discovery failure falls back to the registered list
        source_tables = None

    added, removed, dropped = [], [], []
    current = registered if tables is None else [t for t in registered if t in set(tables)]
    if source_tables is not None:
        if not source_tables and registered and not allow_drop_all:
            control.record_refresh(workbook, "failed", "source lists no tables; refusing to drop every target")
            return {"workbook_name": workbook, "status": "failed", "tables": [], "added": [], "removed": [],
                    "summary": {"total_migrated": 0, "total_failed": 1, "total_rows": 0}}
        current = [t for t in source_tables if not wanted or t in wanted]
        added, removed = name_diff(current, registered)[0], name_diff(source_tables, registered)[1]
        if removed:
            dropped = drop_tables(spark, db, removed)

    results = load_many(spark, source, current, db, declared=rec.get("declared_by_table") or rec.get("declared_types") or {},
                        sniff=sniff or rec.get("sniff") or "undeclared", collapse_midnight=bool(rec.get("collapse_midnight")),
                        parallel=parallel, partition_by=rec.get("partition_by"), tracker=Tracker(control, workbook) if rec.get("track_changes") else None)
    known = {t.lower() for t in registered}
    loaded = [r["table_name"] for r in results if r["status"] != "failed" or r["table_name"].lower() in known]
    if tables is None and sorted(loaded) != sorted(registered):
        control.patch(workbook, known=True, tables=loaded)
    summary = summarize(results, flow="refresh")
    control.record_refresh(workbook, summary["status"], summary["error_summary"])
    control.log_runs([{**r, "workbook_name": workbook} for r in results])
    control.compact_if_many()
    return {"workbook_name": workbook, "status": summary["status"], "summary": summary, "tables": results,
            "added": added, "removed": removed, "dropped": dropped,
            "duration_seconds": round(time.time() - started, 2)}


def refresh_many(spark: SparkSession, control, names: list[str], sources: dict | None = None, credentials: dict | None = None,
                 *, parallel: int = 1, **kw) -> list[dict]:
    """Refresh the named workbooks; one failure does not stop the rest. ``sources`` and ``credentials`` are by workbook;
    a workbook without a source is rebuilt from its record."""
    def one(wb):
        if parallel > 1:
            in_pool(spark, f"workbook-{abs(hash(wb)) % parallel}")
        try:
            return refresh(spark, control, wb, (sources or {}).get(wb), credentials=(credentials or {}).get(wb), **kw)
        except Exception as e:  # noqa: BLE001 - recorded by refresh
            return {"workbook_name": wb, "status": "failed", "error": str(e), "tables": []}

    if parallel <= 1:
        return [one(w) for w in names]
    with ThreadPoolExecutor(max_workers=parallel) as ex:
        return list(ex.map(one, names))


def refresh_all(spark: SparkSession, control, sources: dict | None = None, credentials: dict | None = None, **kw) -> list[dict]:
    """L3: refresh every registered workbook from ``sources`` or its record. An extracted workbook whose record
    names no directory and that was given no source is reported as ``skipped``."""
    sources = sources or {}
    rows = control.state().select("workbook_name", "data_mode", F.col("connection_details")["extract_root"].alias("root")).collect()
    skip = [r["workbook_name"] for r in rows if r["workbook_name"] not in sources and r["data_mode"] != "live" and not r["root"]]
    names = [r["workbook_name"] for r in rows if r["workbook_name"] not in skip]
    return refresh_many(spark, control, names, sources, credentials, **kw) + \
        [{"workbook_name": w, "status": "skipped", "tables": []} for w in skip]


def refresh_due(spark: SparkSession, control, at, credentials: dict | None = None, sources: dict | None = None, **kw) -> list[dict]:
    """K8 carried out: refresh the workbooks whose next run is at or before ``at`` (a timestamp). A start later than the
    allowance is not run but reported as ``missed``. Meant to be called by whatever schedules jobs."""
    when = F.lit(at).cast("timestamp")
    due = due_jobs(jobs(control.state()), when).select("workbook_name", "action").orderBy("workbook_name").collect()
    done = refresh_many(spark, control, [r["workbook_name"] for r in due if r["action"] == "run"], sources, credentials, **kw)
    return done + [{"workbook_name": r["workbook_name"], "status": "missed", "tables": []} for r in due if r["action"] == "missed"]
