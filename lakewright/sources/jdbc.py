"""Live warehouse sources over JDBC.

Each source type knows how to build its URL, quote a table name, list base tables
and probe the connection. Reads are partitioned when a numeric/date partition
column is given: Spark opens ``num_partitions`` connections, each scanning a
slice, and pushes filters and column pruning into the remote query.

Credentials are passed in by the caller and never written to tables or logs.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from lakewright.functions.names import quote_ident

SOURCE_TYPES = ("snowflake", "sqlserver", "azuresql", "databricks")
# Connection timeout (seconds) for the cloud SQL Server form.
CLOUD_LOGIN_TIMEOUT = 30
SQLSERVER_PORT = 1433


@dataclass
class JdbcSource:
    source_type: str
    params: dict
    user: str | None = None
    password: str | None = None
    extra: dict = field(default_factory=dict)

    def __post_init__(self):
        if self.source_type not in SOURCE_TYPES:
            raise ValueError(f"Unsupported source type: '{self.source_type}'")

    # ---- J11: URLs ---------------------------------------------------------
    def url(self) -> str:
        p = self.params
        if self.source_type == "snowflake":
            account = p.get("account") or (p.get("server") or "").split(".")[0]
            q = "&".join(f"{k}={v}" for k, v in (("db", p.get("database")), ("schema", p.get("schema")),
                                                  ("warehouse", p.get("warehouse"))) if v)
            return f"jdbc:snowflake://{account}.snowflakecomputing.com/?{q}"
        if self.source_type in ("sqlserver", "azuresql"):
            server = p.get("server", "")
            base = f"jdbc:sqlserver://{server}"
            opts = [f"databaseName={p.get('database')}", "encrypt=true", "trustServerCertificate=false"]
            if ".database.windows.net" in server:
                base += f":{SQLSERVER_PORT}"
                opts.append(f"loginTimeout={CLOUD_LOGIN_TIMEOUT}")
            return base + ";" + ";".join(opts)
        # databricks
        host = p.get("server_hostname", "")
        return f"jdbc:databricks://{host}:443/default;transportMode=http;ssl=1;httpPath={p.get('http_path')};AuthMech=3"

    # ---- J10: table references -----------------------------------------------
    def table_ref(self, table: str) -> str:
        p = self.params
        if self.source_type == "snowflake":
            return f"{quote_ident(p.get('schema') or 'PUBLIC')}.{quote_ident(table)}"
        if self.source_type in ("sqlserver", "azuresql"):
            return table
        cat, sch = p.get("catalog"), p.get("schema")
        parts = [cat, sch] if cat and sch else [sch] if sch else []
        return ".".join(quote_ident(x, "`") for x in parts + [table])

    def options(self) -> dict:
        o = {"url": self.url(), **self.extra}
        if self.user is not None:
            o["user"] = self.user
        if self.password is not None:
            o["password"] = self.password
        if self.source_type == "databricks" and self.password is not None:
            o.setdefault("user", "token")
        return o

    # ---- A7: list base tables -------------------------------------------------
    def list_tables_query(self) -> str:
        p = self.params
        if self.source_type == "snowflake":
            return ("SELECT TABLE_NAME FROM INFORMATION_SCHEMA.TABLES WHERE TABLE_TYPE = 'BASE TABLE' "
                    f"AND TABLE_SCHEMA = '{(p.get('schema') or 'PUBLIC').replace(chr(39), chr(39) * 2)}'")
        if self.source_type in ("sqlserver", "azuresql"):
            return "SELECT TABLE_NAME FROM INFORMATION_SCHEMA.TABLES WHERE TABLE_TYPE = 'BASE TABLE'"
        cat = p.get("catalog") or "hive_metastore"
        sch = (p.get("schema") or "default").replace("'", "''")
        return f"SELECT table_name AS TABLE_NAME FROM {quote_ident(cat, '`')}.information_schema.tables WHERE table_schema = '{sch}'"

    def list_tables(self, spark: SparkSession) -> DataFrame:
        return spark.read.format("jdbc").options(**self.options()).option("query", self.list_tables_query()).load()

    # ---- A8: probe --------------------------------------------------------------
    def probe(self, spark: SparkSession) -> bool:
        spark.read.format("jdbc").options(**self.options()).option("query", "SELECT 1 AS ok").load().limit(1).collect()
        return True

    # ---- A4-A6: full scans --------------------------------------------------------
    def read(self, spark: SparkSession, table: str, partition_column: str | None = None,
             lower_bound=None, upper_bound=None, num_partitions: int | None = None,
             fetch_size: int = 10000) -> DataFrame:
        """Full scan. With a partition column the scan is split into ``num_partitions`` ranges;
        missing bounds are read from the source with one min/max query."""
        r = spark.read.format("jdbc").options(**self.options()).option("dbtable", self.table_ref(table)) \
            .option("fetchsize", str(fetch_size))
        if partition_column:
            if lower_bound is None or upper_bound is None:
                lo, hi = self.bounds(spark, table, partition_column)
                lower_bound = lo if lower_bound is None else lower_bound
                upper_bound = hi if upper_bound is None else upper_bound
            if lower_bound is not None and upper_bound is not None:
                r = (r.option("partitionColumn", partition_column)
                     .option("lowerBound", str(lower_bound)).option("upperBound", str(upper_bound))
                     .option("numPartitions", str(num_partitions or spark.sparkContext.defaultParallelism)))
        return r.load()

    def bounds(self, spark: SparkSession, table: str, column: str):
        """Partition bounds from one MIN/MAX query run by the source (one small row)."""
        q = f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {self.table_ref(table)}"
        row = spark.read.format("jdbc").options(**self.options()).option("query", q).load().first()
        return (row[0], row[1]) if row is not None else (None, None)


class LiveSource:
    """A ``JdbcSource`` bound to a session, with the interface the flows use
    (``list_tables()``, ``read(table)``). ``partitioning`` maps a table name to
    ``JdbcSource.read`` options (``partition_column``, ``num_partitions``, bounds), so
    large tables are scanned over many connections."""

    def __init__(self, spark: SparkSession, jdbc: JdbcSource, partitioning: dict | None = None):
        self.spark, self.jdbc, self.partitioning = spark, jdbc, dict(partitioning or {})

    def probe(self) -> None:
        """One trivial query; a connection that fails is an error before anything is written."""
        try:
            self.jdbc.probe(self.spark)
        except Exception as e:
            raise ValueError(f"the {self.jdbc.source_type} source does not answer: {str(e).splitlines()[0]}") from e

    def list_tables(self) -> list[str]:
        """Base-table names (one small row each)."""
        return [r[0] for r in self.jdbc.list_tables(self.spark).collect()]

    def read(self, table: str) -> DataFrame:
        return self.jdbc.read(self.spark, table, **self.partitioning.get(table, {}))


def source_from_record(spark: SparkSession, record: dict, credentials: dict | None = None):
    """The source a stored record describes: a live connection (with its stored partitioning and the caller's
    ``credentials``) or the directory of an unpacked extract."""
    details = dict(record.get("connection_details") or {})
    if record.get("data_mode") == "live":
        creds = credentials or {}
        return LiveSource(spark, source_for(record["source_type"], details, user=creds.get("user"), password=creds.get("password")),
                          partitioning=json.loads(record["partitioning"]) if record.get("partitioning") else None)
    if details.get("extract_root"):
        from lakewright.sources.catalog import DirectorySource
        return DirectorySource(spark, details["extract_root"])
    raise ValueError(f"the record of '{record.get('workbook_name')}' names no source; pass one")


def source_for(source_type: str, params: dict, user: str | None = None, password: str | None = None,
               **extra) -> JdbcSource:
    """Dispatch by source type; unknown types are an error."""
    st = "azuresql" if source_type == "sqlserver" and ".database.windows.net" in (params.get("server") or "") \
        else source_type
    return JdbcSource(st, params, user=user or params.get("username"), password=password, extra=extra)
