"""Spark implementations of the registered check queries.

Each function takes (spark, sf_dir) and returns a DataFrame whose column names
match the oracle SQL of the same key. Temporal results are rendered as text
(fixed formats) so both engines hash the same values; the Spark type chosen by
a coercion is reported in a ``*_type`` column.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakewright.functions import names as N
from lakewright.functions.types import declared_spark_type, inferred_type_from_name
from lakewright.operators.control import due_jobs, fold, jobs, public_view, registry_state, run_rollup
from lakewright.operators.dedupe import first_wins, first_wins_casefold, top_n_per_group
from lakewright.operators.fingerprint import snapshot_changes
from lakewright.operators.profile import column_profile
from lakewright.operators.relate import all_orphans, apply_relationship, join_graph, relationship_orphans
from lakewright.operators.sync import catalog_diff
from lakewright.operators.typing import coerce_table
from lakewright.operators.workbook import (extract_metadata, parse_errors, workbook_columns, workbook_connections,
                                           workbook_relationships, workbook_tables)
from lakewright.plans.ingest import ingest, select_tables, table_results_frame
from lakewright.plans.incremental import upsert
from lakewright.plans.refresh import refresh
from lakewright.plans.registry import ControlLog
from lakewright.session import scratch_path
from lakewright.sinks.tables import drop_tables, ensure_namespace, write_table
from lakewright.sources.catalog import DirectorySource, FrameSource
from lakewright.sources.files import read_table_file
from lakewright.sources.workbooks import list_workbook_files, read_workbooks
from lakewright.suite.inputs import (customer_workbooks, date_text, events_as_control_log, pick, spread, table,
                                     ts_text)

SUITE_DB = "lakewright_suite"
TABLE_COLUMNS = {"region": 2, "nation": 3, "customer": 5, "supplier": 4, "part": 6, "orders": 6, "lineitem": 11,
                 "events": 6, "documents": 5, "embeddings": 3, "pages": 3, "benchmark": 2, "labels": 3,
                 "conversations": 4}


def _typed_type(typed, col: str) -> str:
    return next(d.result_type for d in typed.decisions if d.column == col)


# ---------------------------------------------------------------- scans / catalog
def scan_select_all(spark, sf_dir):
    """SELECT * of one table file, quoted names unquoted."""
    return read_table_file(spark, f"{sf_dir}/orders.parquet")


def source_catalog_list(spark, sf_dir):
    """Directory catalog -> every table read and counted in one job."""
    src = DirectorySource(spark, sf_dir)
    parts = []
    for name in src.list_tables():
        df = src.read(name)
        parts.append(df.agg(F.count(F.lit(1)).alias("rows"))
                     .select(F.lit(name).alias("table_name"), F.lit(len(df.columns)).alias("n_columns"), "rows"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def table_include_filter(spark, sf_dir):
    """Exact, case-sensitive include list over the catalog, then counted."""
    src = DirectorySource(spark, sf_dir)
    keep = select_tables(src.list_tables(), ["orders", "Lineitem", "customer", "part"])
    out = None
    for name in keep:
        p = src.read(name).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        out = p if out is None else out.unionByName(p)
    return out


# ---------------------------------------------------------------- identifiers
def _raw_extract_name(part: DataFrame):
    key = F.col("p_partkey")
    h = F.md5(key.cast("string"))
    return (F.when(key % 5 == 0, F.concat("p_name", F.lit(".csv_"), F.upper(h)))
            .when(key % 5 == 1, F.concat("p_name", F.lit("_"), h))
            .when(key % 5 == 2, F.concat("p_name", F.lit(".CSV")))
            .when(key % 5 == 3, F.concat(F.lit('"'), "p_name", F.lit('"')))
            .otherwise(F.col("p_brand")))


def clean_extract_name(spark, sf_dir):
    """J2, J3."""
    part = table(spark, sf_dir, "part")
    raw = _raw_extract_name(part)
    return part.select("p_partkey", raw.alias("raw_name"),
                       N.clean_extract_name(N.strip_quotes(raw)).alias("clean_name"))


def strip_brackets_last_part(spark, sf_dir):
    """J4, J5, C4."""
    c = table(spark, sf_dir, "customer")
    k, seg, n = F.col("c_custkey"), F.col("c_mktsegment"), F.col("c_nationkey").cast("string")
    raw = (F.when(k % 4 == 0, F.concat(F.lit("["), seg, F.lit("].["), F.col("c_name"), F.lit("]")))
           .when(k % 4 == 1, F.concat(F.lit("["), F.col("c_name"), F.lit("]")))
           .when(k % 4 == 2, F.concat(F.lit("["), seg, F.lit(" "), n, F.lit("]")))
           .otherwise(F.concat(F.lit("[DB"), n, F.lit("."), seg, F.lit("]"))))
    clean = N.last_name_part(raw)
    kept = (clean != "") & ~clean.contains(".") & ~clean.contains(" ")
    return c.select("c_custkey", raw.alias("raw_name"), clean.alias("clean_name"), kept.alias("kept"))


# ---------------------------------------------------------------- dedupe
def dedupe_first_wins(spark, sf_dir):
    """G1: first copy of a clean name wins over (file_idx, table_idx)."""
    part = table(spark, sf_dir, "part")
    cat = part.select(F.concat("p_name", F.lit(".csv_"), F.upper(F.md5(F.col("p_partkey").cast("string"))))
                      .alias("raw_name"), F.col("p_size").alias("file_idx"), F.col("p_partkey").alias("table_idx"))
    cat = cat.withColumn("clean_name", N.clean_extract_name("raw_name"))
    return first_wins(cat, ["clean_name"], ["file_idx", "table_idx"]) \
        .select("clean_name", "raw_name", "file_idx", "table_idx")


def dedupe_case_insensitive(spark, sf_dir):
    """First spelling wins per workbook, names compared case-insensitively."""
    c = table(spark, sf_dir, "customer")
    seg, k = F.col("c_mktsegment"), F.col("c_custkey")
    spelled = (F.when(k % 3 == 0, seg).when(k % 3 == 1, F.lower(seg))
               .otherwise(F.concat(F.upper(F.substring(seg, 1, 1)), F.lower(F.substring(seg, 2, 1000)))))
    t = c.select(F.col("c_nationkey").alias("workbook"), spelled.alias("table_name"), k.alias("pos"))
    return first_wins_casefold(t, "table_name", ["pos"], group=["workbook"]).select("workbook", "table_name", "pos")


def column_type_last_wins(spark, sf_dir):
    """Last declaration of a column wins; first position kept; Spark type looked up."""
    p = table(spark, sf_dir, "part")
    decl = pick(["integer", "real", "string", "date", "Boolean"], F.col("p_size") % 5)
    cols = p.select(F.col("p_brand").alias("workbook"), F.col("p_type").alias("column"), decl.alias("dt"),
                    F.col("p_partkey").alias("pos"))
    g = cols.groupBy("workbook", "column").agg(F.max_by(F.lower("dt"), "pos").alias("declared_type"),
                                               F.min("pos").alias("pos"))
    return g.select("workbook", "column", "declared_type", declared_spark_type("declared_type").alias("spark_type"),
                    "pos")


def type_map_lookup(spark, sf_dir):
    """Declared name -> Spark type; type-name text -> inferred type."""
    e = table(spark, sf_dir, "events")
    decl = pick(["integer", "REAL", "Boolean", "string", "date", "datetime", "spatial", "unknown", "decimal", "",
                 "Integer "], F.col("event_id") % 11)
    dtn = pick(["int64", "Int32", "float64", "double", "bool", "datetime64[ns]", "date32", "object", "UInt8"],
               F.col("user_id") % 9)
    return e.select("event_id", decl.alias("declared"), declared_spark_type(decl).alias("spark_type"),
                    dtn.alias("dtype_name"), inferred_type_from_name(dtn).alias("inferred_type"))


# ---------------------------------------------------------------- coercion
def coerce_integer(spark, sf_dir):
    """Text with bad tokens -> bigint (no fractional value, so the column converts)."""
    o = table(spark, sf_dir, "orders")
    k, ck = F.col("o_orderkey"), F.col("o_custkey").cast("string")
    raw = (F.when(k % 7 == 0, F.lit("abc")).when(k % 7 == 1, F.concat(F.lit(" "), ck, F.lit(" ")))
           .when(k % 7 == 2, F.concat(ck, F.lit("e0"))).when(k % 7 == 3, F.lit("0x10"))
           .when(k % 7 == 4, F.lit("1,000")).when(k % 7 == 5, F.lit(None).cast("string")).otherwise(ck))
    src = o.select("o_orderkey", raw.alias("raw"), raw.alias("value"))
    typed = coerce_table(src, {"value": "integer"}, sniff="none")
    return typed.df.withColumn("result_type", F.lit(_typed_type(typed, "value")))


def coerce_integer_column_kept(spark, sf_dir):
    """A fractional value anywhere keeps the whole declared-integer column as text."""
    li = table(spark, sf_dir, "lineitem")
    src = li.select("l_orderkey", "l_linenumber", F.col("l_discount").cast("string").alias("value"))
    typed = coerce_table(src, {"value": "integer"}, sniff="none")
    return typed.df.withColumn("result_type", F.lit(_typed_type(typed, "value")))


def coerce_real(spark, sf_dir):
    """Text -> double; 'n/a' -> null, 'NaN' -> null, 'inf' -> Infinity, ' 23.0e1 ' -> 230.0."""
    li = table(spark, sf_dir, "lineitem")
    ln = F.col("l_linenumber")
    raw = (F.when(ln == 3, F.lit("n/a")).when(ln == 5, F.lit("NaN")).when(ln == 6, F.lit("inf"))
           .when(ln == 7, F.concat(F.lit(" "), F.col("l_quantity").cast("string"), F.lit("e1 ")))
           .otherwise(F.col("l_extendedprice").cast("string")))
    typed = coerce_table(li.select("l_orderkey", "l_linenumber", raw.alias("value")), {"value": "real"}, sniff="none")
    return typed.df.withColumn("result_type", F.lit(_typed_type(typed, "value")))


BOOLEAN_TOKENS = ["true", "1", "yes", "false", "0", "no", "t", "Y", "TRUE", " yes"]


def coerce_boolean(spark, sf_dir):
    """Only true/1/yes and false/0/no (any case) are booleans."""
    o = table(spark, sf_dir, "orders")
    raw = pick(BOOLEAN_TOKENS, F.col("o_custkey") % 10)
    typed = coerce_table(o.select("o_orderkey", raw.alias("raw"), raw.alias("value")), {"value": "boolean"},
                         sniff="none")
    return typed.df.withColumn("result_type", F.lit(_typed_type(typed, "value")))


def _date_text_variants(o: DataFrame):
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    return (F.when(k % 5 == 0, F.date_format(d, "yyyy-MM-dd"))
            .when(k % 5 == 1, F.date_format(d, "yyyy-MM-dd HH:mm:ss"))
            .when(k % 5 == 2, F.lit("not a date"))
            .when(k % 5 == 3, F.date_format(d, "yyyy/M/d"))
            .otherwise(F.date_format(d, "yyyyMMdd")))


def coerce_date(spark, sf_dir):
    """Declared date, ten text layouts plus junk; each value parsed on its own."""
    o = table(spark, sf_dir, "orders")
    d, k = F.col("o_orderdate"), F.floor(F.col("o_orderkey") / 5) % 7
    more = (F.when(k == 0, F.date_format(d, "MM/dd/yyyy")).when(k == 1, F.date_format(d, "MMM d, yyyy"))
            .when(k == 2, F.date_format(d, "dd-MMM-yyyy")).when(k == 3, F.date_format(d, "yyyy.MM.dd"))
            .when(k == 4, F.date_format(d, "yyyy-MM-dd hh:mm a")).when(k == 5, F.date_format(d, "M/d/yyyy H:mm"))
            .otherwise(F.date_format(d, "yyyyMMdd")))
    raw = F.when(F.col("o_orderkey") % 5 == 4, more).otherwise(_date_text_variants(o))
    typed = coerce_table(o.select("o_orderkey", raw.alias("raw"), raw.alias("value")), {"value": "date"}, sniff="none")
    return typed.df.select("o_orderkey", "raw", date_text("value").alias("value"),
                           F.lit(_typed_type(typed, "value")).alias("result_type"))


def coerce_string_null_tokens(spark, sf_dir):
    """Declared string; 'nan', '<NA>', 'None' become null, 'NaT' survives."""
    e = table(spark, sf_dir, "events")
    k = F.col("event_id")
    raw = (F.when(k % 7 == 0, F.lit("nan")).when(k % 7 == 1, F.lit("<NA>")).when(k % 7 == 2, F.lit("None"))
           .when(k % 7 == 3, F.lit("NaT")).when(k % 7 == 4, F.lit(None).cast("string"))
           .when(k % 7 == 5, F.col("event_type")).otherwise(F.col("props")))
    typed = coerce_table(e.select("event_id", raw.alias("value")), {"value": "string"}, sniff="none")
    return typed.df.withColumn("result_type", F.lit(_typed_type(typed, "value")))


def sniff_date(spark, sf_dir):
    """Undeclared text of midnight dates -> DATE; a text column of keys stays text."""
    o = table(spark, sf_dir, "orders")
    src = o.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
                   F.col("o_orderkey").cast("string").alias("key_text"))
    typed = coerce_table(src, {})
    return typed.df.select("o_orderkey", date_text("day").alias("day"), F.lit(_typed_type(typed, "day")).alias("day_type"),
                           "key_text", F.lit(_typed_type(typed, "key_text")).alias("key_type"))


def sniff_timestamp_utc(spark, sf_dir):
    """Undeclared timestamp text with a time part -> TIMESTAMP; zone-less ts -> UTC timestamp."""
    e = table(spark, sf_dir, "events")
    src = e.select("event_id", "ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts_text"))
    typed = coerce_table(src, {})
    return typed.df.select("event_id", ts_text("ts").alias("ts"), F.lit(_typed_type(typed, "ts")).alias("ts_type"),
                           ts_text("ts_text").alias("ts_text"),
                           F.lit(_typed_type(typed, "ts_text")).alias("ts_text_type"))


def column_profile_q(spark, sf_dir):
    """One-pass profile of lineitem plus two derived columns with nulls / times."""
    li = table(spark, sf_dir, "lineitem")
    li = li.withColumn("disc_if_taxed", F.when(F.col("l_tax") > 0, F.col("l_discount"))) \
        .withColumn("ship_ts", F.col("l_shipdate") + F.make_dt_interval(F.lit(0), F.col("l_linenumber") % 2))
    return column_profile(li)


# ---------------------------------------------------------------- sinks
def write_overwrite_roundtrip(spark, sf_dir):
    """B1, B2: overwrite replaces the schema; the table reads back as the source."""
    s = table(spark, sf_dir, "supplier")
    ensure_namespace(spark, SUITE_DB)
    write_table(spark, s.withColumn("extra_col", F.lit(1)), SUITE_DB, "supplier_roundtrip")
    write_table(spark, s, SUITE_DB, "supplier_roundtrip")
    return spark.table(f"{SUITE_DB}.supplier_roundtrip")


def write_metrics(spark, sf_dir):
    """Rows / columns / status per written table from the write's own metrics."""
    ensure_namespace(spark, SUITE_DB)
    res = [write_table(spark, table(spark, sf_dir, t), SUITE_DB, f"metrics_{t}") for t in ("nation", "supplier", "part")]
    for r in res:
        r["table_name"] = r["table_name"].replace("metrics_", "")
    return table_results_frame(spark, res)


def skip_empty(spark, sf_dir):
    """An empty frame is not written; status skipped_empty. The frame is a whole
    lineitem scan that no row passes (quantities are at least 1)."""
    ensure_namespace(spark, SUITE_DB)
    r = table(spark, sf_dir, "lineitem").where(F.col("l_quantity") <= 0)
    res = write_table(spark, r, SUITE_DB, "lineitem_empty")
    return table_results_frame(spark, [res])


# ---------------------------------------------------------------- roll-ups, sync, control
def run_status_rollup(spark, sf_dir):
    """orders as runs, line numbers as tables, returned lines as failures."""
    li = table(spark, sf_dir, "lineitem")
    per_line = li.groupBy("l_orderkey", "l_linenumber").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("l_returnflag") == "R").alias("n_ret"),
        F.count_if(F.col("l_returnflag") == "N").alias("n_none"))
    log = per_line.select(
        F.col("l_orderkey").alias("run_id"), F.concat(F.lit("line_"), F.col("l_linenumber").cast("string")).alias("table_name"),
        F.col("l_linenumber").alias("pos"), "rows",
        F.when(F.col("n_ret") > 0, "failed").when(F.col("n_none") == F.col("rows"), "skipped_empty")
        .otherwise("success").alias("status"),
        F.when(F.col("n_ret") > 0, F.concat(F.col("n_ret").cast("string"), F.lit(" returned"))).alias("error"))
    return run_rollup(log, "run_id", flow="refresh")


def schema_sync_diff(spark, sf_dir):
    """Per workbook (brand), source vs registered table names, case folded."""
    p = table(spark, sf_dir, "part")
    src = p.where(F.col("p_size") <= 25).select(F.col("p_brand").alias("workbook"), F.col("p_name").alias("table_name"))
    reg = p.where(F.col("p_size") > 10).select(F.col("p_brand").alias("workbook"),
                                               F.upper("p_name").alias("table_name"))
    return catalog_diff(src, reg, group=["workbook"])


REG_ATTRS = ["source_type", "has_secret", "enable_scheduled_refresh", "refresh_interval_minutes", "props"]
PATCH_ATTRS = ["enable_scheduled_refresh", "refresh_interval_minutes"]


def _state(spark, sf_dir):
    log = events_as_control_log(table(spark, sf_dir, "events"))
    return registry_state(log, REG_ATTRS, PATCH_ATTRS)


def registry_state_q(spark, sf_dir):
    """Events replayed as a control log; current record per workbook."""
    st = _state(spark, sf_dir)
    return st.select("workbook_name", "source_type", "enable_scheduled_refresh", "refresh_interval_minutes",
                     ts_text("last_migrated_at").alias("last_migrated_at"),
                     ts_text("last_refreshed_at").alias("last_refreshed_at"),
                     "last_refresh_status", "last_refresh_error", "refresh_count")


def registry_public_view(spark, sf_dir):
    """No secrets, a credentials flag, descriptor keys filtered."""
    st = _state(spark, sf_dir)
    desc = F.map_concat(F.from_json("props", "map<string,string>"),
                        F.create_map(F.lit("type"), F.col("source_type"), F.lit("tables"), F.lit("[]")))
    pv = public_view(st.withColumn("connection_details", desc), descriptor="connection_details")
    return pv.select("workbook_name", "has_stored_credentials",
                     F.array_join(F.array_sort(F.map_keys("connection_details")), ",").alias("connection_keys"),
                     F.col("connection_details")["k"].alias("k_value"))


def jobs_due(spark, sf_dir):
    """Schedulable records, next run, due at the newest event time, missed when late."""
    e = table(spark, sf_dir, "events")
    at = e.select(F.max("ts").cast("timestamp").alias("at")).scalar()
    st = _state(spark, sf_dir).withColumn("last_migrated_at", F.col("last_migrated_at").cast("timestamp")) \
        .withColumn("last_refreshed_at", F.col("last_refreshed_at").cast("timestamp"))
    d = due_jobs(jobs(st), at)
    return d.select("job_id", "name", ts_text("next_run").alias("next_run"), "trigger", "action")


def run_history_topn(spark, sf_dir):
    """H2: five newest runs per workbook."""
    e = table(spark, sf_dir, "events").select(
        F.concat(F.lit("wb_"), F.col("user_id").cast("string")).alias("workbook_name"), "event_id",
        F.col("event_type").alias("status"), "ts")
    top = top_n_per_group(e, ["workbook_name"], [F.col("ts").desc(), F.col("event_id").desc()], 5)
    return top.select("workbook_name", "rank", "event_id", "status", ts_text("ts").alias("at"))


# ---------------------------------------------------------------- workbooks
def _corpus(spark, sf_dir):
    return customer_workbooks(spread(table(spark, sf_dir, "customer"), "c_custkey"))


def workbook_columns_q(spark, sf_dir):
    """A10, J35, C3, G4."""
    return workbook_columns(_corpus(spark, sf_dir))


def workbook_tables_q(spark, sf_dir):
    """J35, J5, C4, G2."""
    return workbook_tables(_corpus(spark, sf_dir))


def workbook_connection_q(spark, sf_dir):
    """C5, J7-J9."""
    c = workbook_connections(_corpus(spark, sf_dir))
    p = F.col("params")
    return c.select("workbook", "connection_class", "source_type",
                    F.coalesce(p["server"], p["server_hostname"]).alias("server"),
                    F.coalesce(p["database"], p["catalog"]).alias("database"), p["schema"].alias("schema_name"),
                    p["account"].alias("account"), p["http_path"].alias("http_path"), "error")


def workbook_relationships_q(spark, sf_dir):
    """E2, G3."""
    return workbook_relationships(_corpus(spark, sf_dir))


def workbook_parse_errors(spark, sf_dir):
    """A10 guard: malformed documents are reported, not fatal."""
    return parse_errors(_corpus(spark, sf_dir))


# ---------------------------------------------------------------- relationships on data
def relationship_join(spark, sf_dir):
    """E3 as a left join: orders -> customer along o_custkey = c_custkey, a third of the keys null, a third one customer's,
    and that customer's orders held twice."""
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    key = F.when(F.col("o_orderkey") % 3 == 1, F.lit(None)).when(F.col("o_orderkey") % 3 == 2, F.lit(1)).otherwise(F.col("o_custkey"))
    o = o.withColumn("o_custkey", key.cast(o.schema["o_custkey"].dataType))
    o = o.unionByName(o.where("o_custkey = 1"))
    j = apply_relationship(o, c, "o_custkey", "c_custkey", "left")
    return j.select("o_orderkey", "o_custkey", "c_name", "c_mktsegment", "o_totalprice")


def relationship_orphans_q(spark, sf_dir):
    """Orphan keys on both sides of two relationships."""
    li, p = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    a = relationship_orphans(li, p, "l_partkey", "p_partkey", "lineitem.l_partkey->part.p_partkey")
    b = relationship_orphans(o, c, "o_custkey", "c_custkey", "orders.o_custkey->customer.c_custkey")
    return a.unionByName(b)


# ---------------------------------------------------------------- files
def profile_new_files(spark, sf_dir):
    """Orders as text in a directory of files; a second batch of files, in which an integer column has fractions and a date column
    other text, is ingested with the first batch's profiles kept. Per column: type after each ingest; the second profiled new files only."""
    o = table(spark, sf_dir, "orders")
    text = _text_copy(o.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")).withColumn("o_custkey", F.col("o_custkey").cast("double"))
    late = F.col("o_orderkey").cast("long") % 10 == 3
    root = scratch_path(spark, "suite_files", unique=True)
    db, wb = f"{SUITE_DB}_profiles", "suite_profiles"
    control = ControlLog(spark, f"{SUITE_DB}_control", location=scratch_path(spark, "suite_control", unique=True))
    declared = {"o_orderkey": "integer", "o_custkey": "integer", "o_totalprice": "real"}
    out = None
    for n in range(2):
        part = text.where(late if n else ~late)
        if n:
            part = part.withColumn("o_custkey", F.col("o_custkey") + 0.5).withColumn("o_orderdate", F.concat("o_orderdate", F.lit(" or so")))
        part.repartition(3).write.mode("append").parquet(f"{root}/data/orders.parquet")
        res = ingest(spark, DirectorySource(spark, f"{root}/data"), db, workbook=wb, declared=declared, control=control, track_changes=True)
        if res["status"] != "success" or res["tables"][0]["files_profiled"] != 3:
            raise RuntimeError(f"ingest {n} did not profile three new files: {res['tables']}")
        t = spark.table(f"{db}.orders")
        types = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(d).alias("type"), F.count(F.lit(1)).alias("rows"), F.count(c).alias("values")) for c, d in t.dtypes])
        found = t.agg(types.alias("x")).select(F.lit(n + 1).alias("ingest"), F.explode("x").alias("x")).select("ingest", "x.*")
        out = spark.createDataFrame(found.collect(), found.schema) if out is None else out.unionByName(found)
    return out


def _write_files(root):
    """Writes each (name, content) below ``root``, in the folder ``at``, as a file of that name."""
    def run(batches):
        from pyarrow import fs
        store, base = fs.FileSystem.from_uri(root)
        made = set()
        for pdf in batches:
            for name, content, at in zip(pdf["name"], pdf["content"], pdf["at"]):
                if at not in made:
                    store.create_dir(f"{base}/{at}", recursive=True)
                    made.add(at)
                with store.open_output_stream(f"{base}/{at}/{name}") as f:
                    f.write(content)
            yield pdf[["name"]]
    return run


def _zipped(batches):
    """Every ``packaged`` content as an archive that holds it as a member, some with an extract beside it."""
    import io
    import zipfile
    for pdf in batches:
        out = []
        for name, content, packaged in zip(pdf["name"], pdf["content"], pdf["packaged"]):
            if packaged:
                buffer = io.BytesIO()
                with zipfile.ZipFile(buffer, "w") as z:
                    if len(name) % 2:
                        z.writestr("Data/Extract.hyper", b"x")
                    z.writestr("book.twb", bytes(content))
                content = buffer.getvalue()
            out.append(content)
        yield pdf[["name", "at"]].assign(content=out)


def _workbook_folder(spark, docs):
    """``docs`` (name, content, packaged) written as files by the executors, each task's into a folder of its own, so that the executors list them too; the folder."""
    root = scratch_path(spark, "suite_files", unique=True)
    root = root if "://" in root or root.startswith("file:") else f"file://{root}"
    packed = docs.withColumn("at", F.concat(F.lit("d"), F.spark_partition_id().cast("string"))).mapInPandas(_zipped, "name string, at string, content binary")
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(path)
    packed.mapInPandas(_write_files(root), "name string").agg(F.count(F.lit(1))).collect()
    return root


def workbook_listing(spark, sf_dir):
    """One file a supplier under the supplier's name, two in three with a workbook suffix in either case; content not read."""
    s = spread(table(spark, sf_dir, "supplier"), "s_suppkey")
    k = F.col("s_suppkey")
    suffix = F.when(k % 3 == 0, ".twb").when(k % 3 == 1, ".TWBX").otherwise(".txt")
    stem = F.when(k % 4 == 0, F.concat("s_name", F.lit(".v2"))).otherwise(F.col("s_name"))
    docs = s.select(F.concat(stem, suffix).alias("name"), F.encode(F.repeat(F.lit("x"), (k % 9 + 1).cast("int")), "UTF-8").alias("content"), F.lit(False).alias("packaged"))
    listed = list_workbook_files(spark, _workbook_folder(spark, docs))
    return listed.select("workbook", F.col("length").cast("long").alias("length"), "error")


def workbook_read(spark, sf_dir):
    """A2, A10: a customer's workbook a file, every third one packaged, every 19th without content: what each file holds, and how many columns it declares."""
    corpus = _corpus(spark, sf_dir).withColumn("k", F.regexp_extract("workbook", "[0-9]+", 0).cast("long"))
    packaged = F.col("k") % 3 == 0
    content = F.when((F.col("k") % 19 == 0) & packaged, F.lit(b"")).otherwise(F.col("content"))
    docs = corpus.select(F.concat("workbook", F.when(packaged, ".twbx").otherwise(".twb")).alias("name"), content.alias("content"), packaged.alias("packaged"))
    read = read_workbooks(spark, _workbook_folder(spark, docs))
    # each file is opened and parsed once; what it holds is landed, not the document
    parsed = extract_metadata(read.withColumn("has_document", F.col("content").isNotNull()))["parsed"]
    columns = workbook_columns(parsed.where("error IS NULL")).groupBy("workbook").agg(F.count(F.lit(1)).alias("n_columns"))
    return parsed.join(columns, "workbook", "left").select("workbook", "has_extract", "error", "has_document", F.coalesce("n_columns", F.lit(0)).alias("n_columns"))


RELATIONSHIPS = [("lineitem", "l_orderkey", "orders", "o_orderkey"), ("lineitem", "l_partkey", "part", "p_partkey"), ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
                 ("orders", "o_custkey", "customer", "c_custkey"), ("customer", "c_nationkey", "nation", "n_nationkey")]


def relationship_orphans_all(spark, sf_dir):
    """E4 for a whole workbook: five relationships from one inverted index; some orders, parts and customers are left out."""
    names = dict.fromkeys(t for r in RELATIONSHIPS for t in (r[0], r[2]))
    tables = {n: table(spark, sf_dir, n) for n in names}
    tables["orders"] = tables["orders"].where("o_orderkey % 4 <> 0")
    tables["part"] = tables["part"].where("p_partkey % 5 <> 0")
    tables["customer"] = tables["customer"].withColumn("c_nationkey", F.when(F.col("c_custkey") % 3 != 0, F.col("c_nationkey")))
    return all_orphans(tables, RELATIONSHIPS)


def relationship_graph(spark, sf_dir):
    """E3 over a workbook's relationship graph: lineitem with its order, part, supplier, customer and nation as one frame."""
    tables = {n: table(spark, sf_dir, n) for n in dict.fromkeys(t for r in RELATIONSHIPS for t in (r[0], r[2]))}
    tables["orders"] = tables["orders"].where("o_orderkey % 4 <> 0")
    j = join_graph(tables, [(c, d, a, b) if n % 2 else (a, b, c, d) for n, (a, b, c, d) in enumerate(RELATIONSHIPS)])
    return j.groupBy(F.col("`nation.n_name`").alias("nation"), F.col("`customer.c_mktsegment`").alias("segment"), F.col("`part.p_brand`").alias("brand")).agg(
        F.count(F.lit(1)).alias("rows"), F.count("`orders.o_orderkey`").alias("with_order"), F.count("`supplier.s_suppkey`").alias("with_supplier"),
        F.sum(F.col("`lineitem.l_quantity`").cast("decimal(18,2)")).cast("double").alias("quantity"))


# ---------------------------------------------------------------- flows
def _text_copy(df: DataFrame, bad: dict | None = None) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name).cast("string")
        if bad and f.name in bad:
            cond, token = bad[f.name]
            c = F.when(cond, F.lit(token)).otherwise(c)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def ingest_flow(spark, sf_dir):
    """Text copy of supplier with a bad token -> declared types -> typed table."""
    s = table(spark, sf_dir, "supplier")
    text = _text_copy(s, {"s_acctbal": (F.col("s_suppkey") % 10 == 3, "n/a")})
    src = FrameSource({"supplier": text, "nation": _text_copy(table(spark, sf_dir, "nation"))})
    db = f"{SUITE_DB}_ingest"
    res = ingest(spark, src, db, workbook="suite_ingest", tables=["supplier"],
                 declared={"s_suppkey": "integer", "s_nationkey": "integer", "s_acctbal": "real", "s_name": "string"})
    if res["status"] != "success":
        raise RuntimeError(f"ingest failed: {res['summary']}")
    return spark.table(f"{db}.supplier")


def refresh_flow(spark, sf_dir):
    """Register with snapshot 1 (customer, region), refresh from snapshot 2
    (customer with changed segments, nation): region dropped, nation added,
    declared types applied again."""
    c = table(spark, sf_dir, "customer")
    db = f"{SUITE_DB}_refresh"
    control = ControlLog(spark, f"{SUITE_DB}_control", location=scratch_path(spark, "suite_control", unique=True))
    declared = {"c_custkey": "integer", "c_nationkey": "integer", "c_acctbal": "real"}
    snap1 = FrameSource({"customer": _text_copy(c), "region": _text_copy(table(spark, sf_dir, "region"))})
    ingest(spark, snap1, db, workbook="suite_refresh", declared=declared, control=control)
    snap2 = FrameSource({"customer": _text_copy(c.withColumn("c_mktsegment", F.lower("c_mktsegment"))),
                         "nation": _text_copy(table(spark, sf_dir, "nation"))})
    res = refresh(spark, control, "suite_refresh", snap2)
    if res["status"] != "success" or res["removed"] != ["region"] or res["added"] != ["nation"]:
        raise RuntimeError(f"refresh did not sync as expected: {res['status']} {res['added']} {res['removed']}")
    return spark.table(f"{db}.customer")


def refresh_stream(spark, sf_dir):
    """M1: events, as text in four files with values that do not fit late in the stream, loaded file by file;
    a second run with a lost checkpoint loads nothing twice. Typed values and kept misfits."""
    from lakewright.streaming.refresh_stream import start_refresh_stream
    landing = scratch_path(spark, "suite_stream", unique=True)
    ev = table(spark, sf_dir, "events")
    late = F.col("event_id") % 10 == 7
    text = ev.withColumn("value", F.when(late, F.concat(F.lit("v"), F.col("event_id").cast("string"))).otherwise(F.col("value").cast("string")))
    text.repartitionByRange(4, "event_id").write.parquet(landing)
    name = f"events_stream_{uuid.uuid4().hex[:8]}"
    for _ in range(2):
        q = start_refresh_stream(spark, landing, text.schema, SUITE_DB, name, declared={"value": "real"}, max_files_per_trigger=1,
                                 checkpoint=scratch_path(spark, "suite_stream", unique=True))
        q.awaitTermination()
    t = spark.table(f"{SUITE_DB}.{name}")
    return t.select("event_id", ts_text("ts").alias("ts"), "user_id", "event_type", "value", "props",
                    F.col("__misfits")["value"].alias("misfit"))


def notice_dedupe_stream(spark, sf_dir):
    """M2: events as change notices, those of even and odd users through two streams with checkpoints of their own into
    one table; accepted notices per workbook with all tables that they name."""
    from lakewright.streaming.notices import start_notice_stream
    schema = table(spark, sf_dir, "events").schema
    name = f"notices_{uuid.uuid4().hex[:8]}"
    for half in range(2):
        ev = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir).where(F.col("user_id") % 2 == half)
        notices = ev.select(F.concat(F.lit("wb_"), F.col("user_id").cast("string")).alias("workbook_name"),
                            F.array("event_type").alias("tables"), F.col("ts").cast("timestamp").alias("ts"))
        start_notice_stream(spark, notices, SUITE_DB, name, checkpoint=scratch_path(spark, "suite_notices", unique=True)).awaitTermination()
    return spark.table(f"{SUITE_DB}.{name}").select("workbook_name", F.array_join("tables", ",").alias("tables"))


def _year_files(spark, name):
    """Per ship or order year of a partitioned target, a digest of its files' names."""
    files = spark.table(name).select("year", F.input_file_name().alias("file")).distinct()
    return files.groupBy("year").agg(F.md5(F.array_join(F.sort_array(F.collect_list("file")), ",")).alias("files"))


def change_only_refresh(spark, sf_dir):
    """L2, L4, B1: lineitem by ship year, registered with change tracking; a refresh from equal rows writes nothing, one from a snapshot
    in which 1994 changed, 1996 went and 1998 came rewrites 1994 and 1998 alone. Per year: content, and whether its files stayed."""
    li = table(spark, sf_dir, "lineitem").withColumn("year", F.year("l_shipdate"))
    db, wb = f"{SUITE_DB}_changes", "suite_changes"
    control = ControlLog(spark, f"{SUITE_DB}_control", location=scratch_path(spark, "suite_control", unique=True))
    drop_tables(spark, db, ["lineitem"]) if spark.catalog.databaseExists(db) else None
    first = li.where("year <> 1998")
    declared = {"l_orderkey": "integer", "l_quantity": "real"}
    ingest(spark, FrameSource({"lineitem": first}), db, workbook=wb, declared=declared, control=control, partition_by={"lineitem": ["year"]}, track_changes=True)
    before = scratch_path(spark, "suite_files", unique=True)
    _year_files(spark, f"{db}.lineitem").write.parquet(before)
    again = refresh(spark, control, wb, FrameSource({"lineitem": first.hint("rebalance")}))  # other tasks and files, as many as the rows need
    if [t["status"] for t in again["tables"]] != ["unchanged"]:
        raise RuntimeError(f"an unchanged table was written: {again['tables']}")
    second = li.where("year <> 1996").withColumn("l_quantity", F.when(F.col("year") == 1994, F.col("l_quantity") + 1).otherwise(F.col("l_quantity")))
    done = refresh(spark, control, wb, FrameSource({"lineitem": second}))
    if done["status"] != "success":
        raise RuntimeError(f"refresh failed: {done}")
    now, was = _year_files(spark, f"{db}.lineitem"), spark.read.parquet(before).withColumnRenamed("files", "was")
    content = spark.table(f"{db}.lineitem").groupBy("year").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("quantity"),
                                                             F.sum("l_orderkey").alias("orderkeys"))
    return content.join(now, "year").join(was, "year", "left").select("year", "rows", "quantity", "orderkeys", F.coalesce(F.col("files") == F.col("was"), F.lit(False)).alias("files_kept"))


def keyed_upsert(spark, sf_dir):
    """K1, B1 on a target: two snapshots of orders, compared by key, merged into the target of the first. Orders of 1993 to 1995 were
    inserted, updated and deleted, some moved to 2050, all of 1992 went; other years keep their files."""
    o = table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    k, db, name = F.col("o_orderkey"), f"{SUITE_DB}_upsert", "orders"
    ensure_namespace(spark, db)
    drop_tables(spark, db, [name])
    some = F.col("year").between(1993, 1995)
    old = o.where(~(some & (k % 7 == 0)))
    new = o.where("year <> 1992").where(~(some & (k % 5 == 0)))
    new = new.withColumn("o_totalprice", F.when(some & (k % 3 == 0), F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    new = new.withColumn("year", F.when(some & (k % 11 == 0), F.lit(2050)).otherwise(F.col("year")))
    write_table(spark, old, db, name, partition_by=["year"])
    before = scratch_path(spark, "suite_files", unique=True)
    _year_files(spark, f"{db}.{name}").write.parquet(before)
    changes = snapshot_changes(old, new, ["o_orderkey"]).withColumn("gone", F.col("change") == "delete").drop("change")
    upsert(spark, changes, db, name, ["o_orderkey"], deleted="gone")
    now, was = _year_files(spark, f"{db}.{name}"), spark.read.parquet(before).withColumnRenamed("files", "was")
    kept = now.join(was, "year", "left").select("year", F.coalesce(F.col("files") == F.col("was"), F.lit(False)).alias("files_kept"))
    return spark.table(f"{db}.{name}").join(kept, "year").select("o_orderkey", "o_custkey", "o_totalprice", "year", "files_kept")


def registry_folded(spark, sf_dir):
    """The events cut in three by time; each part is folded with the snapshots so far, and the state is that of all events."""
    log = events_as_control_log(table(spark, sf_dir, "events"))
    a, b = log.select(F.percentile_approx("seq", [0.33, 0.8]).alias("p")).first().p
    folded = fold(log.where(F.col("seq") <= a), REG_ATTRS, PATCH_ATTRS)
    folded = fold(folded.unionByName(log.where(F.col("seq").between(a + 1, b)), allowMissingColumns=True), REG_ATTRS, PATCH_ATTRS)
    st = registry_state(folded.unionByName(log.where(F.col("seq") > b), allowMissingColumns=True), REG_ATTRS, PATCH_ATTRS)
    return st.select("workbook_name", "source_type", "enable_scheduled_refresh", "refresh_interval_minutes",
                     ts_text("last_migrated_at").alias("last_migrated_at"),
                     ts_text("last_refreshed_at").alias("last_refreshed_at"),
                     "last_refresh_status", "last_refresh_error", "refresh_count")


QUERIES = {
    "scan_select_all": scan_select_all,
    "source_catalog_list": source_catalog_list,
    "table_include_filter": table_include_filter,
    "clean_extract_name": clean_extract_name,
    "strip_brackets_last_part": strip_brackets_last_part,
    "dedupe_first_wins": dedupe_first_wins,
    "dedupe_case_insensitive": dedupe_case_insensitive,
    "column_type_last_wins": column_type_last_wins,
    "type_map_lookup": type_map_lookup,
    "coerce_integer": coerce_integer,
    "coerce_integer_column_kept": coerce_integer_column_kept,
    "coerce_real": coerce_real,
    "coerce_boolean": coerce_boolean,
    "coerce_date": coerce_date,
    "coerce_string_null_tokens": coerce_string_null_tokens,
    "sniff_date": sniff_date,
    "sniff_timestamp_utc": sniff_timestamp_utc,
    "column_profile": column_profile_q,
    "write_overwrite_roundtrip": write_overwrite_roundtrip,
    "write_metrics": write_metrics,
    "skip_empty": skip_empty,
    "run_status_rollup": run_status_rollup,
    "schema_sync_diff": schema_sync_diff,
    "registry_state": registry_state_q,
    "registry_public_view": registry_public_view,
    "jobs_due": jobs_due,
    "run_history_topn": run_history_topn,
    "workbook_columns": workbook_columns_q,
    "workbook_tables": workbook_tables_q,
    "workbook_connection": workbook_connection_q,
    "workbook_relationships": workbook_relationships_q,
    "workbook_parse_errors": workbook_parse_errors,
    "relationship_join": relationship_join,
    "relationship_orphans": relationship_orphans_q,
    "workbook_listing": workbook_listing,
    "ingest_flow": ingest_flow,
    "refresh_flow": refresh_flow,
    "refresh_stream": refresh_stream,
    "notice_dedupe_stream": notice_dedupe_stream,
    "change_only_refresh": change_only_refresh,
    "keyed_upsert": keyed_upsert,
    "registry_folded": registry_folded,
    "workbook_read": workbook_read,
    "profile_new_files": profile_new_files,
    "relationship_orphans_all": relationship_orphans_all,
    "relationship_graph": relationship_graph,
}
