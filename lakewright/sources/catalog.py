"""Sources that are already Spark tables or DataFrames (A6 for same-metastore
sources, and composed sources used by flows and tests)."""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class CatalogSource:
    """Tables of a namespace in the session catalog."""

    def __init__(self, spark: SparkSession, db: str):
        self.spark, self.db = spark, db

    def list_tables(self) -> list[str]:
        return sorted(t.name for t in self.spark.catalog.listTables(self.db) if not t.isTemporary)

    def read(self, table: str) -> DataFrame:
        return self.spark.table(f"`{self.db}`.`{table}`")


class FrameSource:
    """A named set of DataFrames (e.g. tables derived from other tables)."""

    def __init__(self, tables: dict[str, DataFrame]):
        self.tables = dict(tables)

    def list_tables(self) -> list[str]:
        return list(self.tables)

    def read(self, table: str) -> DataFrame:
        if table not in self.tables:
            raise KeyError(f"table '{table}' not found at source")
        return self.tables[table]


class DirectorySource:
    """A directory of table files (see ``sources.files``); names are the cleaned extract names."""

    def __init__(self, spark: SparkSession, root: str):
        from lakewright.sources.files import extract_catalog
        self.spark, self.root = spark, root
        cat = extract_catalog(spark, root)
        # G1: first copy of a clean name wins in (file_idx, table_idx) order
        from lakewright.operators.dedupe import first_wins
        self._rows = first_wins(cat, ["clean_name"], ["file_idx", "table_idx"]) \
            .select("clean_name", "table_path", "format", "file_idx", "table_idx") \
            .orderBy("file_idx", "table_idx").collect()   # one row per table: catalog metadata only

    def list_tables(self) -> list[str]:
        return [r["clean_name"] for r in self._rows]

    def read(self, table: str) -> DataFrame:
        from lakewright.sources.files import read_table_file
        for r in self._rows:
            if r["clean_name"] == table:
                return read_table_file(self.spark, r["table_path"], r["format"])
        raise KeyError(f"table '{table}' not found at source")

    def _row(self, table: str):
        for r in self._rows:
            if r["clean_name"] == table:
                return r
        raise KeyError(f"table '{table}' not found at source")

    def files(self, table: str) -> list[tuple[str, int, int]]:
        """(uri, bytes, modification time) of the files of a table, from one listing."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self._row(table)["table_path"])
        fs = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        found, out = fs.listFiles(path, True), []
        while found.hasNext():
            st = found.next()
            if not st.getPath().getName().startswith(("_", ".")):
                out.append((plain_uri(st.getPath().toUri().toString()), st.getLen(), st.getModificationTime()))
        return sorted(out)

    def read_files(self, table: str, uris: list[str], file_column: str) -> DataFrame:
        """Rows of some files of a table, with the uri of each row's file."""
        whole = self.read(table)
        raw = self.spark.read.format(self._row(table)["format"])
        fields = raw.load(self._row(table)["table_path"]).schema
        df = read_table_files(self.spark, uris, self._row(table)["format"], fields)
        return df.toDF(*whole.columns, file_column)


def plain_uri(uri: str) -> str:
    """One spelling of a uri, whatever the number of slashes behind its scheme."""
    return re.sub(r"^([A-Za-z][\w+.-]*):/+", r"\1:/", uri)


def read_table_files(spark: SparkSession, uris: list[str], fmt: str, schema) -> DataFrame:
    reader = spark.read.format(fmt).schema(schema)
    if fmt == "csv":
        reader = reader.option("header", "true")
    file = F.regexp_replace(F.col("_metadata.file_path"), r"^([A-Za-z][\w+.-]*):/+", "$1:/")
    # paths are given decoded: the reader takes them as paths, not as uris
    return reader.load([unquote(u) for u in uris]).select("*", file.alias("__file"))
