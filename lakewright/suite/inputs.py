"""Inputs of the check queries, derived from the given tables by Spark.

Text copies with bad tokens, event logs and workbook documents are built here
from the test tables with DataFrame expressions, so every check reads the
whole tables and its work grows with them. The oracle SQL builds the same
values independently.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TS_FMT = "yyyy-MM-dd HH:mm:ss.SSSSSS"      # text form of timestamps in check outputs
DATE_FMT = "yyyy-MM-dd"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Rows of a table whose rows are small beside what is built from each.
ROWS_A_TASK = 20_000


def spread(df: DataFrame, key: str) -> DataFrame:
    """``df`` dealt by ``key`` into tasks of about ROWS_A_TASK rows: a few MB of file would be read by a task or two, whatever is built from a row."""
    return df.repartition(max(1, -(-df.count() // ROWS_A_TASK)), key)


def pick(options: list, index: Column) -> Column:
    """options[index] for a 0-based index column."""
    return F.element_at(F.array(*[F.lit(o) for o in options]), (index + 1).cast("int"))


def ts_text(c) -> Column:
    return F.date_format(c, TS_FMT)


def date_text(c) -> Column:
    return F.date_format(c, DATE_FMT)


# --- control log built from events ------------------------------------------------
EVENT_OPS = {"signup": "register", "purchase": "refresh", "error": "refresh", "click": "patch", "view": "delete"}
SOURCE_TYPES = ["snowflake", "sqlserver", "databricks"]


def events_as_control_log(events: DataFrame) -> DataFrame:
    et = F.col("event_type")
    op = None
    for k, v in EVENT_OPS.items():
        op = F.when(et == k, v) if op is None else op.when(et == k, v)
    sched = et.isin("signup", "click")
    return events.select(
        F.concat(F.lit("wb_"), F.col("user_id").cast("string")).alias("workbook_name"),
        F.col("event_id").alias("seq"), F.col("ts"), op.alias("op"),
        F.when(et == "purchase", "success").when(et == "error", "failed").alias("status"),
        F.when(et == "error", F.concat(F.lit("value "), F.col("value").cast("string"))).alias("error"),
        F.when(sched, F.col("value") > 50).alias("enable_scheduled_refresh"),
        F.when(sched & (F.col("value") > 50), (F.lit(5) + F.floor("value").cast("int") % 55)).cast("int")
        .alias("refresh_interval_minutes"),
        F.when(et == "signup", pick(SOURCE_TYPES, F.col("event_id") % 3)).alias("source_type"),
        F.when(et == "signup", F.col("event_id") % 2 == 0).alias("has_secret"),
        F.when(et == "signup", F.col("props")).alias("props"),
    )


# --- workbook documents built from customers ----------------------------------------
CONNECTION_CLASS_CYCLE = ["snowflake", "sqlserver", "azure_sqldb", "databricks", "spark"]


def _attr(name: str, value: Column) -> Column:
    return F.concat(F.lit(f' {name}="'), value, F.lit('"'))


def customer_workbooks(customer: DataFrame) -> DataFrame:
    """One workbook document per customer row, as bytes: (workbook, content).

    Every 7th key's document starts with a byte order mark, every 17th has a second root. Every 11th key gives a truncated (malformed) document, every 13th a document
    whose only connection class is unsupported; every 4th carries an extra
    ``spark`` connection ahead of the main one (precedence test).
    """
    k, n, seg = F.col("c_custkey"), F.col("c_nationkey").cast("string"), F.col("c_mktsegment")
    cls = F.when(k % 13 == 0, F.lit("unknownclass")).otherwise(pick(CONNECTION_CLASS_CYCLE, F.col("c_nationkey") % 5))
    server = (F.when(cls == "sqlserver", F.concat(F.lower(seg), F.lit(".corp.example.com")))
              .when(cls == "azure_sqldb", F.concat(F.lit("srv"), n, F.lit(".database.windows.net")))
              .otherwise(F.concat(F.lit("acct"), n, F.lit(".example.com"))))
    main_conn = F.concat(F.lit("<named-connection><connection"), _attr("class", cls), _attr("server", server),
                         _attr("dbname", F.concat(F.lit("DB"), n)), _attr("schema", seg),
                         _attr("warehouse", F.lit("WH1")), _attr("username", F.concat(F.lit("user"), k.cast("string"))),
                         _attr("v-http-path", F.concat(F.lit("/sql/1.0/"), n)),
                         F.lit("/></named-connection>"))
    extra = F.when(k % 4 == 0, F.lit('<named-connection><connection class="spark" server="extra.example.com"/>'
                                     '</named-connection>')).otherwise(F.lit(""))
    rel = lambda t: F.concat(F.lit('<relation type="table" table="'), t, F.lit('"/>'))
    relations = F.concat(rel(F.concat(F.lit("["), seg, F.lit("].[T"), n, F.lit("]"))),
                         rel(F.concat(F.lit("[t"), n, F.lit("]"))),
                         rel(F.concat(F.lit("["), seg, F.lit("]"))),
                         rel(F.concat(F.lit("[Fact "), seg, F.lit("]"))),
                         rel(F.concat(F.lit("[DB"), n, F.lit("."), seg, F.lit("]"))),
                         rel(F.lit("")))
    col = lambda nm, dt: F.concat(F.lit('<column name="'), nm, F.lit('" datatype="'), dt, F.lit('"/>'))
    columns = F.concat(col(F.lit("[C_CUSTKEY]"), F.lit("integer")), col(F.lit("[C_ACCTBAL]"), F.lit("real")),
                       col(F.lit("[C_NAME]"), F.lit("string")),
                       col(F.lit("[C_ACCTBAL]"), F.when(F.col("c_acctbal") < 0, F.lit("string")).otherwise(F.lit("REAL"))),
                       col(F.lit("[__tableau_internal_object_id__]"), F.lit("table")),
                       col(F.concat(F.lit("[Calculation_"), k.cast("string"), F.lit("]")), F.lit("")))
    hexid = F.upper(F.md5(F.col("c_name")))
    expr = lambda a, b: F.concat(F.lit('<expression op="="><expression op="'), a,
                                 F.lit('"/><expression op="'), b, F.lit('"/></expression>'))
    ep = lambda tag, oid: F.concat(F.lit(f'<{tag} object-id="'), oid, F.lit('"/>'))
    cust_ep = ep("first-end-point", F.concat(F.lit("CUSTOMER_"), hexid))
    nat_ep = ep("second-end-point", F.concat(F.lit("NATION_"), n, F.lit("_"), hexid))
    rel0 = F.concat(F.lit("<relationship>"), expr(F.lit("[C_NATIONKEY]"), F.concat(F.lit("[N_NATIONKEY (NATION_"), n, F.lit(")]"))),
                    cust_ep, nat_ep, F.lit("</relationship>"))
    rel2 = F.concat(F.lit("<relationship>"), expr(F.lit("[C_NAME]"), F.lit("[X]")), cust_ep, F.lit("</relationship>"))
    rel3 = F.concat(F.lit("<relationship>"), expr(F.lit("[C_CUSTKEY]"), F.lit("[O_CUSTKEY (ORDERS)]")), cust_ep,
                    ep("second-end-point", F.concat(F.lit("ORDERS ("), seg, F.lit(")_"), hexid)), F.lit("</relationship>"))
    doc = F.concat(F.lit("<workbook><datasources><datasource><connection><named-connections>"), extra, main_conn,
                   F.lit("</named-connections>"), relations, F.lit("</connection>"), columns,
                   F.lit("<object-graph><relationships>"), rel0, rel0, rel2, rel3,
                   F.lit("</relationships></object-graph></datasource></datasources></workbook>"))
    doc = F.when(k % 11 == 0, F.substring(doc, 1, 60)).otherwise(doc)
    doc = F.when(k % 17 == 0, F.concat(doc, F.lit("<workbook/>"))).otherwise(doc)
    mark = F.when(k % 7 == 0, F.unhex(F.lit("EFBBBF"))).otherwise(F.lit(b""))
    return customer.select(F.col("c_name").alias("workbook"), F.concat(mark, F.encode(doc, "UTF-8")).alias("content"))
