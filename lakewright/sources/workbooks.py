"""Workbook files (A2, A10, A11, A13) and the JSON registry file.

Workbooks are read with ``binaryFile``; packaged workbooks (zip) are opened in an
Arrow batch function - the only per-row Python in the library, a few lines of
``zipfile`` per file. Each output row carries its own error instead of failing
the job.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakewright.functions.names import file_stem
from lakewright.session import scratch_path

# Workbook and extract file suffixes.
WORKBOOK_SUFFIX = ".twb"
PACKAGED_SUFFIX = ".twbx"
EXTRACT_SUFFIX = ".hyper"

#: Spark plans a task for every 32 small files; one opens those of so many such tasks, once there are more than TASKS_A_CORE a core.
FOLD, TASKS_A_CORE = 64, 4

#: Files whose names and tasks the driver holds at once, and threads that count files of folders.
FILES_AT_ONCE, COUNTERS = 50_000, 8

WORKBOOK_SCHEMA = T.StructType([
    T.StructField("workbook", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("content", T.BinaryType()),
    T.StructField("has_extract", T.BooleanType()),
    T.StructField("error", T.StringType()),
])


def file_status(spark: SparkSession, path: str) -> dict:
    """A13 for one named file: existence and size through the Hadoop FileSystem (any shared store).
    ``error`` is set for a missing or zero-length file."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return {"path": path, "exists": False, "length": None, "error": "file not found"}
    length = int(fs.getFileStatus(p).getLen())
    return {"path": path, "exists": True, "length": length, "error": "empty file" if length == 0 else None}


def list_workbook_files(spark: SparkSession, root: str) -> DataFrame:
    """Workbook files by suffix (case-insensitive), with size; content is not read.

    Spark's file listing skips zero-length files, so an empty upload never shows up
    here; ``file_status`` checks a named file explicitly (A13)."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
             .select("path", "length", "modificationTime"))
    low = F.lower("path")
    return (files.where(low.endswith(WORKBOOK_SUFFIX) | low.endswith(PACKAGED_SUFFIX))
            .select(file_stem("path").alias("workbook"), "path", "length", "modificationTime",
                    F.when(F.col("length") == 0, F.lit("empty file")).alias("error")))


def _unpack(batches):
    for pdf in batches:
        out = []
        for path, content in zip(pdf["path"], pdf["content"]):
            name = path.rsplit("/", 1)[-1]
            wb = name.rsplit(".", 1)[0] if "." in name.lstrip(".") else name
            xml, has_extract, err = None, False, None
            data = bytes(content) if content is not None else b""
            if not data:
                err = "empty file"
            elif path.lower().endswith(PACKAGED_SUFFIX):
                try:
                    with zipfile.ZipFile(io.BytesIO(data)) as zf:
                        names = zf.namelist()
                        has_extract = any(n.lower().endswith(EXTRACT_SUFFIX) for n in names)
                        member = next((n for n in names if n.lower().endswith(WORKBOOK_SUFFIX)), None)
                        if member is None:
                            err = f"no {WORKBOOK_SUFFIX} member in '{name}'"
                        else:
                            xml = zf.read(member)
                except zipfile.BadZipFile:
                    err = "not a zip archive"
            else:
                xml = data
            out.append((wb, path, xml, has_extract, err))
        yield pd.DataFrame(out, columns=[f.name for f in WORKBOOK_SCHEMA.fields])


def _groups(spark: SparkSession, root: str) -> Iterator[list[str]]:
    """Paths that together hold what lies below ``root``, in groups of at most FILES_AT_ONCE files: folders, and files of folders that hold more.

    Only one folder's entries are held at a time, page by page where the store lists so; what Spark's listing hides is left out here too."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    top = jvm.org.apache.hadoop.fs.Path(root)
    fs = top.getFileSystem(conf)
    if not fs.exists(top) or fs.getContentSummary(top).getFileCount() <= FILES_AT_ONCE:
        yield [root]
        return

    def hidden(name: str) -> bool:
        return name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_")

    def literal(path) -> str:
        return re.sub(r"([\\{}\[\]*?])", r"\\\1", path.toString())

    group, held, folders = [], 0, [top]
    while folders:
        inside, entries = [], fs.listStatusIterator(folders.pop())
        while entries.hasNext():
            entry = entries.next()
            path = entry.getPath()
            if hidden(name := path.getName()):
                continue
            if entry.isDirectory():
                inside.append(path)
            elif name.lower().endswith((WORKBOOK_SUFFIX, PACKAGED_SUFFIX)):
                if held >= FILES_AT_ONCE:
                    yield group
                    group, held = [], 0
                group.append(literal(path))
                held += 1
        with ThreadPoolExecutor(COUNTERS) as pool:
            counts = list(pool.map(lambda p: fs.getContentSummary(p).getFileCount(), inside))
        for path, n in zip(inside, counts):
            if n > FILES_AT_ONCE:
                folders.append(path)
            elif n:
                if held + n > FILES_AT_ONCE:
                    yield group
                    group, held = [], 0
                group.append(literal(path))
                held += n
    if group:
        yield group


@contextmanager
def _listing_not_kept(spark: SparkSession):
    """Within, the names that a read lists go with it; else Spark keeps up to 250 MB of them in the driver, of reads long done."""
    key = "spark.sql.hive.filesourcePartitionFileCacheSize"
    before = spark.conf.get(key)
    spark.conf.set(key, "0")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _opened(spark: SparkSession, paths: list[str]) -> DataFrame:
    with _listing_not_kept(spark):
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    low = F.lower("path")
    files = files.where(low.endswith(WORKBOOK_SUFFIX) | low.endswith(PACKAGED_SUFFIX)).select("path", "content")
    planned = files.rdd.getNumPartitions()
    files = files.coalesce(min(planned, max(-(-planned // FOLD), spark.sparkContext.defaultParallelism * TASKS_A_CORE)) or 1)
    return files.mapInPandas(_unpack, WORKBOOK_SCHEMA)


def read_workbooks(spark: SparkSession, root: str) -> DataFrame:
    """A10: one row per workbook file: (workbook, path, content, has_extract, error); ``content`` is the document as it lies there.

    The driver holds the names of at most FILES_AT_ONCE files: of more, each group's rows are landed in the shared scratch folder before the next is listed."""
    groups = _groups(spark, root)
    first = next(groups, [root])
    group = next(groups, None)
    if group is None:
        return _opened(spark, first)
    path = scratch_path(spark, "workbook_files", unique=True)
    _opened(spark, first).write.parquet(path)
    while group is not None:
        _opened(spark, group).write.mode("append").parquet(path)
        group = next(groups, None)
    return spark.read.schema(WORKBOOK_SCHEMA).parquet(path)


def load_registry_json(spark: SparkSession, path: str, record_schema: T.StructType) -> DataFrame:
    """A JSON object keyed by workbook -> one row per record; missing or corrupt -> empty."""
    try:
        raw = spark.read.text(path, wholetext=True)
    except Exception:
        return spark.createDataFrame([], T.StructType([T.StructField("workbook_name", T.StringType()),
                                                       T.StructField("record", record_schema)]))
    m = F.from_json("value", T.MapType(T.StringType(), record_schema), {"mode": "PERMISSIVE"})
    return raw.select(F.explode(m).alias("workbook_name", "record"))
