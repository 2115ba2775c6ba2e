"""Directory-of-table-files source (A1, A3, C9), re-aimed from packaged extracts.

Layout: ``<root>/<table>.<fmt>`` or ``<root>/<schema>/<table>.<fmt>`` where a table
is a file or a directory of part files. The catalog is listed with Spark
(``binaryFile`` with the content column pruned), so only names and sizes move.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakewright.functions.names import clean_extract_name, strip_quotes

TABLE_FORMATS = {".parquet": "parquet", ".csv": "csv", ".json": "json", ".orc": "orc"}
DEFAULT_SCHEMA = "Extract"


def list_table_files(spark: SparkSession, root: str) -> DataFrame:
    """Files below ``root`` with a table suffix: path, length, and the table path/format they belong to."""
    root = root.rstrip("/")
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
             .select("path", "length"))
    low = F.lower("path")
    fmt = None
    for suf, name in TABLE_FORMATS.items():
        hit = low.endswith(suf) | low.contains(suf + "/")
        fmt = F.when(hit, F.lit(name)) if fmt is None else fmt.when(hit, F.lit(name))
    rel = F.regexp_replace(F.col("path"), r"^.*?" + _escape(root) + "/", "")
    # table path: first segment (or first two when a schema folder is used) ending with a table suffix
    seg = F.split(rel, "/")
    first_is_table = F.lower(seg.getItem(0)).rlike(r"\.(parquet|csv|json|orc)$")
    table_rel = F.when(first_is_table, seg.getItem(0)).otherwise(F.concat_ws("/", seg.getItem(0), seg.getItem(1)))
    schema = F.when(first_is_table, F.lit(DEFAULT_SCHEMA)).otherwise(seg.getItem(0))
    return (files.withColumn("format", fmt).where(F.col("format").isNotNull())
            .withColumn("schema", schema).withColumn("table_rel", table_rel))


def _escape(s: str) -> str:
    import re
    return re.escape(s)


def extract_catalog(spark: SparkSession, root: str) -> DataFrame:
    """A3: (file_idx, schema, table_idx, raw_name, clean_name, format, table_path, bytes) in visit order.

    ``file_idx`` numbers schema folders, ``table_idx`` the tables inside one; the
    name is the stem with outer quotes removed and extract suffixes cleaned (J2, J3).
    """
    files = list_table_files(spark, root)
    tables = (files.groupBy("schema", "table_rel", "format")
              .agg(F.sum("length").alias("bytes"), F.count(F.lit(1)).alias("n_files")))
    stem = F.regexp_replace(F.regexp_extract("table_rel", r"([^/]+)$", 1), r"(?i)\.(parquet|csv|json|orc)$", "")
    raw = strip_quotes(stem)
    # A global window, on purpose: its rows are the catalog (one per table of the extract),
    # never table data, and the file order it numbers is global by definition.
    w_schema = Window.orderBy("schema")
    w_table = Window.partitionBy("schema").orderBy("table_rel")
    return (tables.select(
        (F.dense_rank().over(w_schema) - 1).alias("file_idx"),
        "schema",
        (F.row_number().over(w_table) - 1).alias("table_idx"),
        raw.alias("raw_name"),
        clean_extract_name(raw).alias("clean_name"),
        "format",
        F.concat(F.lit(root.rstrip("/") + "/"), F.col("table_rel")).alias("table_path"),
        "bytes", "n_files"))


def read_table_file(spark: SparkSession, path: str, fmt: str = "parquet", options: dict | None = None) -> DataFrame:
    """A1 for one table: ``SELECT *`` with quoted column names unquoted (C9). Lazy - no rows move here."""
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", "true")
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    df = reader.load(path)
    clean = [c.strip('"') for c in df.columns]
    return df.toDF(*clean) if clean != df.columns else df
