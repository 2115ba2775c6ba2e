"""Run registry as an append-only control log (K1-K8) and run roll-ups.

Every change is an event row ``(workbook_name, seq, op, ts, ...)`` with op in
register / refresh / patch / delete. The state of a workbook is a fold of its
events, computed with two aggregations and one join:

1. per workbook: the latest ``register`` event (max of a struct led by ``seq``)
   and the latest ``delete`` seq;
2. events after that register (join on workbook): refresh count and latest
   refresh outcome, latest value of each patched attribute.

Both aggregations pre-aggregate on every task, so a workbook that owns a third
of all events never lands whole on one task; the join salts hot workbooks (at most
``hot_share`` of them, found by one bounded frequent-items scan), so a hot workbook is split over
many tasks whatever AQE's skew thresholds are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakewright.functions.names import job_id, job_name
from lakewright.operators.skew import hot_keys
from lakewright.operators.skew import is_hot as hot_key

OPS = ("register", "refresh", "patch", "delete", "snapshot")
# Smallest refresh interval (minutes) and the late-start allowance (seconds).
MIN_INTERVAL_MINUTES = 5
LATE_START_SECONDS = 300
# Keys dropped from a connection descriptor before it is stored / shown.
DESCRIPTOR_KEYS_DROPPED = ["type", "tables", "column_types", "relationships"]


def registry_state(log: DataFrame, register_attrs: list[str], patch_attrs: list[str] | None = None,
                   include_deleted: bool = False, salt_buckets: int = 32, hot_share: int = 64,
                   skew_safe: bool = True, marks_of_fold: bool = False) -> DataFrame:
    """Current record per workbook.

    ``register_attrs`` are copied from the latest register event; ``patch_attrs``
    (subset of them) may be overridden by later ``patch`` events carrying a
    non-null value. Refresh fields reset on register (count since then).
    A workbook whose latest register is older than its latest delete is gone.
    A ``snapshot`` event (see ``fold``) stands for all events of its workbook up to its seq: register values as patched,
    the refresh count and last refresh so far, and the seqs of register and delete. ``marks_of_fold`` adds what a snapshot needs.
    """
    patch_attrs = list(patch_attrs or [])

    def of_snapshot(c: str, kind: str, otherwise=None) -> Column:
        there = F.col(c) if c in log.columns else F.lit(None).cast(kind)
        return F.when(F.col("op") == "snapshot", there).otherwise(otherwise if otherwise is not None else F.lit(None).cast(kind)).alias(c)
    base = F.struct(of_snapshot("last_refreshed_at", "timestamp").alias("ts"), of_snapshot("last_refresh_status", "string").alias("status"),
                    of_snapshot("last_refresh_error", "string").alias("error"))
    reg = F.struct(F.col("seq").alias("seq"), of_snapshot("reg_ts", dict(log.dtypes)["ts"], F.col("ts")).alias("ts"), of_snapshot("reg_seq", "bigint", F.col("seq")),
                   of_snapshot("refresh_count", "bigint").alias("base_count"), base.alias("base"),
                   *[F.col(a).alias(a) for a in register_attrs])
    is_reg = F.col("op").isin("register", "snapshot")
    is_later = F.col("op").isin("refresh", "patch")
    per_wb = log.groupBy("workbook_name").agg(
        F.max_by(F.when(is_reg, reg), F.when(is_reg, F.col("seq"))).alias("reg"),
        F.max(of_snapshot("del_seq", "bigint", F.when(F.col("op") == "delete", F.col("seq")))).alias("del_seq"),
        F.count_if(is_later).alias("n_later"),
    ).where(F.col("reg").isNotNull())

    # Skew: a workbook holding at least 1/hot_share of the refresh/patch events is hot.
    # There are at most hot_share such names (a proven bound), found by one scan of the
    # log's name column with a bounded frequent-items aggregate (no shuffle). Only hot
    # workbooks are salted: their log rows spread over salt_buckets partitions and their
    # one-row side is replicated per salt with a generator (no cross join); every other
    # workbook keeps salt 0.
    if skew_safe:
        is_hot = hot_key(F.col("workbook_name"), hot_keys(log.where(is_later), "workbook_name", hot_share))
    else:                                   # e.g. one workbook's events: nothing to spread
        is_hot = F.lit(False)
    marks = per_wb.select("workbook_name", F.col("reg.seq").alias("__reg_seq"),
                          F.explode(F.when(is_hot, F.sequence(F.lit(0), F.lit(salt_buckets - 1)))
                                    .otherwise(F.array(F.lit(0)))).alias("__salt"))
    after = (log.where(is_later)
             .withColumn("__salt", F.when(is_hot, F.pmod(F.xxhash64("seq"), F.lit(salt_buckets)).cast("int"))
                         .otherwise(F.lit(0)))
             .join(marks, ["workbook_name", "__salt"])
             .where(F.col("seq") > F.col("__reg_seq")))
    aggs = [
        F.count_if(F.col("op") == "refresh").alias("refresh_count"),
        F.max("seq").alias("later_seq"),
        F.max_by(F.when(F.col("op") == "refresh", F.struct("seq", "ts", "status", "error")),
                 F.when(F.col("op") == "refresh", F.col("seq"))).alias("last_refresh"),
    ]
    for a in patch_attrs:
        hit = (F.col("op") == "patch") & F.col(a).isNotNull()
        aggs.append(F.max_by(F.when(hit, F.struct(F.col("seq"), F.col(a).alias("v"))),
                             F.when(hit, F.col("seq"))).alias(f"p__{a}"))
    later = after.groupBy("workbook_name").agg(*aggs)

    st = per_wb.join(later, "workbook_name", "left")
    live = F.col("del_seq").isNull() | (F.col("del_seq") < F.col("reg.reg_seq"))

    def last(part: str) -> Column:
        return F.when(F.col("last_refresh").isNotNull(), F.col(f"last_refresh.{part}")).otherwise(F.col(f"reg.base.{part}"))
    cols = [F.col("workbook_name")]
    for a in register_attrs:
        if a in patch_attrs:
            cols.append(F.coalesce(F.col(f"p__{a}.v"), F.col(f"reg.{a}")).alias(a))
        else:
            cols.append(F.col(f"reg.{a}").alias(a))
    cols += [
        F.col("reg.ts").alias("last_migrated_at"),
        last("ts").alias("last_refreshed_at"),
        last("status").alias("last_refresh_status"),
        last("error").alias("last_refresh_error"),
        (F.coalesce("refresh_count", F.lit(0)) + F.coalesce("reg.base_count", F.lit(0))).cast("long").alias("refresh_count"),
        live.alias("live"),
    ]
    if marks_of_fold:
        cols += [F.col("reg.reg_seq").alias("reg_seq"), F.col("del_seq"), F.greatest("reg.seq", F.coalesce("later_seq", F.lit(0))).alias("seq")]
    out = st.select(*cols)
    return out if include_deleted else out.where("live").drop("live")


def fold(log: DataFrame, register_attrs: list[str], patch_attrs: list[str] | None = None) -> DataFrame:
    """One ``snapshot`` event a registered workbook that stands for all its events so far, deleted ones included.

    Later events fold onto it: ``registry_state`` of the snapshots and later events equals that of all events, wherever the
    log is cut in order of seq. Events of workbooks that were never registered are dropped, as the state ignores them.
    """
    st = registry_state(log, register_attrs, patch_attrs, include_deleted=True, marks_of_fold=True)
    return st.select("workbook_name", "seq", F.lit("snapshot").alias("op"), F.col("last_migrated_at").alias("ts"), *register_attrs, "reg_seq",
                     F.col("last_migrated_at").alias("reg_ts"), "del_seq", "refresh_count", "last_refreshed_at", "last_refresh_status", "last_refresh_error")


def public_view(state: DataFrame, secret_flag: str = "has_secret", descriptor: str | None = None) -> DataFrame:
    """No secret material; ``has_stored_credentials`` flag; descriptor keys filtered."""
    out = state.withColumn("has_stored_credentials", F.coalesce(F.col(secret_flag), F.lit(False)))
    out = out.drop(secret_flag)
    if descriptor:
        dropped = F.array(*[F.lit(k) for k in DESCRIPTOR_KEYS_DROPPED])
        out = out.withColumn(descriptor, F.map_filter(descriptor, lambda k, v: ~F.array_contains(dropped, k)))
    return out


def schedulable(state: DataFrame) -> Column:
    """Refresh enabled and an interval set."""
    return F.coalesce(F.col("enable_scheduled_refresh"), F.lit(False)) & F.col("refresh_interval_minutes").isNotNull()


def interval_text(minutes: Column) -> Column:
    """Interval trigger text: ``interval[H:MM:SS]`` (days spelled out past 24 h)."""
    m = minutes.cast("long")
    days, rem = F.floor(m / 1440), m % 1440
    hms = F.format_string("%d:%02d:00", F.floor(rem / 60).cast("int"), (rem % 60).cast("int"))
    day_txt = F.when(days == 1, F.lit("1 day, ")).when(days > 1, F.concat(days.cast("string"), F.lit(" days, "))) \
        .otherwise(F.lit(""))
    return F.concat(F.lit("interval["), day_txt, hms, F.lit("]"))


def jobs(state: DataFrame) -> DataFrame:
    """K7: job list for schedulable records; next run = last run (refresh, else migrate) + interval."""
    base = F.coalesce(F.col("last_refreshed_at"), F.col("last_migrated_at"))
    nxt = base + F.make_dt_interval(F.lit(0), F.lit(0), F.col("refresh_interval_minutes").cast("int"), F.lit(0))
    return state.where(schedulable(state)).select(
        "workbook_name", job_id("workbook_name").alias("job_id"), job_name("workbook_name").alias("name"),
        nxt.alias("next_run"), interval_text(F.col("refresh_interval_minutes")).alias("trigger"))


def due_jobs(job_df: DataFrame, at: Column) -> DataFrame:
    """K8: jobs whose next run is at or before ``at``; a start later than the allowance is missed."""
    late = at > F.col("next_run") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(LATE_START_SECONDS))
    return job_df.where(F.col("next_run") <= at).withColumn(
        "action", F.when(late, F.lit("missed")).otherwise(F.lit("run")))


def valid_config(enable: Column, interval: Column) -> tuple[Column, Column]:
    """(valid, reason) for a schedule request."""
    reason = (F.when(enable & interval.isNull(), F.lit("an interval is required when refresh is enabled"))
              .when(interval.isNotNull() & (interval < MIN_INTERVAL_MINUTES),
                    F.lit(f"interval must be at least {MIN_INTERVAL_MINUTES} minutes")))
    return reason.isNull(), reason


def check_schedule(enable: bool | None, interval: int | None) -> None:
    """C10 where a schedule enters: raises on what ``valid_config`` flags in a table of requests."""
    if enable and interval is None:
        raise ValueError("an interval is required when refresh is enabled")
    if interval is not None and interval < MIN_INTERVAL_MINUTES:
        raise ValueError(f"interval must be at least {MIN_INTERVAL_MINUTES} minutes")


# ---------------------------------------------------------------------------
# run roll-ups
# ---------------------------------------------------------------------------
def run_rollup(run_log: DataFrame, run_key: str = "run_id", table_col: str = "table_name",
               pos_col: str = "pos", flow: str = "refresh") -> DataFrame:
    """F2, F3, F6, F7 per run over a run log with one row per (run, table).

    status: refresh - none failed -> success, some ok -> partial, else failed;
    migrate - success / partial (as the original service reports it).
    error_summary: ``table: error`` joined by '; ' in table position order. The
    list is per run and a run has one row per table of its workbook, so the
    collected list is bounded by the catalog, not by the data.
    """
    ok = F.count_if(F.col("status").isin("success", "skipped_empty", "unchanged")).alias("n_success")
    bad = F.count_if(F.col("status") == "failed").alias("n_failed")
    errs = F.collect_list(F.when(F.col("status") == "failed",
                                 F.struct(F.col(pos_col).alias("pos"),
                                          F.concat_ws(": ", F.col(table_col), F.col("error")).alias("txt"))))
    rows_ok = F.sum(F.when(F.col("status") != "failed", F.col("rows")))
    g = run_log.groupBy(run_key).agg(ok, bad, F.coalesce(rows_ok, F.lit(0)).cast("long").alias("total_rows"),
                                     errs.alias("__errs"))
    if flow == "refresh":
        status = F.when(F.col("n_failed") == 0, "success").when(F.col("n_success") > 0, "partial").otherwise("failed")
    else:
        status = F.when(F.col("n_failed") == 0, "success").otherwise("partial")
    summary = F.when(F.size("__errs") > 0,
                     F.array_join(F.transform(F.array_sort("__errs"), lambda x: x["txt"]), "; "))
    return g.select(run_key, "n_success", "n_failed", "total_rows", status.alias("status"),
                    summary.alias("error_summary"))
