"""Incremental refresh (M1): landing folder -> typed micro-batches -> target table, without losing a value.

Types come from the declared map alone, never from the data, so no batch decides for a later one: a
declared column has its type from the start, any other column keeps the type it arrives with. A
non-null value that does not fit its declared type is kept as text in the row's ``__misfits`` map and
counted into the run log; ``retype`` applies the batch rules to a whole target later.

Exactly once on plain Parquet: each batch is written once, to a folder of its own, and becomes visible as one
catalog partition. A ledger names the source files of each visible folder, and files that it names are not
loaded again, whatever became of the checkpoint; a ledger that can't be read fails the batch. When there are many folders the batch that
adds the last of them merges them, and the ledger is rewritten without what it said of folders that are gone.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakewright.functions import coerce as C
from lakewright.operators.typing import coerce_table
from lakewright.plans.registry import _Versions
from lakewright.session import scratch_path
from lakewright.sinks.tables import (create_entry, delete_path, ensure_namespace, exchange_entry, ident, namespace_location,
                                     sql_text, table_exists, write_table)

BATCH_COLUMN, FILE_COLUMN, MISFITS = "__batch", "__file", "__misfits"
OWN = (FILE_COLUMN, MISFITS, BATCH_COLUMN)
LEDGER = "batch string, file string"
#: Folders of a target that are merged into one, by the batch that reaches this number or when a stream starts.
MAX_BATCHES = 100


def fitted(column: Column, dt: T.DataType, declared: str | None, st: C.Stages) -> tuple[Column, T.DataType, bool]:
    """(value, type, may misfit): ``column`` under its declared type; null where it does not fit."""
    text = isinstance(dt, T.StringType)
    if declared == "integer" and text:
        n = C.TextNumber(column, st, integer=True)
        return F.when(~n.integer_blocker, n.integer), T.LongType(), True
    if declared == "integer" and isinstance(dt, (T.FloatType, T.DoubleType, T.DecimalType)):
        return F.when(~C.float_integer_blocker(column), C.float_to_integer(column)), T.LongType(), True
    if declared == "integer" and isinstance(dt, (T.IntegralType, T.BooleanType)):
        return column.cast("bigint"), T.LongType(), False
    if declared == "real" and text:
        return C.TextNumber(column, st).double, T.DoubleType(), True
    if declared == "real" and isinstance(dt, (T.NumericType, T.BooleanType)):
        return C.to_double_nan_null(column), T.DoubleType(), False
    if declared == "boolean":
        return C.token_boolean(column, dt), T.BooleanType(), True
    if declared == "date" and text:
        return C.TemporalText(column, st, declared=True).date, T.DateType(), True
    if declared == "date" and isinstance(dt, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return C.temporal_to_date(column), T.DateType(), False
    if declared == "string":
        return C.null_token_text(column, dt), T.StringType(), False
    if isinstance(dt, T.TimestampNTZType):
        return C.ntz_to_utc(column), T.TimestampType(), False
    return column, dt, False


def typed_batch(batch: DataFrame, declared: dict[str, str]) -> tuple[DataFrame, list[str]]:
    """``batch`` under its declared types with ``__misfits`` (raw text by column), and the columns that may misfit."""
    st, values, raw, checked = C.Stages(), [], [], []
    missing = {"nan", "<na>", "none", ""}
    for f in batch.schema.fields:
        if f.name in OWN:
            continue
        c = F.col(f"`{f.name}`")
        value, _, may = fitted(c, f.dataType, (declared.get(f.name) or "").lower() or None, st)
        values.append(value.alias(f.name))
        if may:
            checked.append(f.name)
            as_text = c.cast("string")
            lost = c.isNotNull() & value.isNull() & ~F.lower(F.trim(as_text)).isin(*missing)
            raw.append(F.when(lost, F.struct(F.lit(f.name).alias("key"), as_text.alias("value"))))
    entries = F.filter(F.array(*raw), lambda e: e.isNotNull()) if raw else None
    misfits = F.map_from_entries(entries) if raw else F.create_map().cast("map<string,string>")
    return st.apply(batch).select(*values, FILE_COLUMN, misfits.alias(MISFITS)), checked


class _BatchWriter:
    """foreachBatch sink of one target."""

    def __init__(self, spark: SparkSession, db: str, table: str, declared: dict[str, str], control=None, workbook: str = "", max_batches: int = MAX_BATCHES):
        self.spark, self.db, self.table, self.declared = spark, db, table, declared
        self.control, self.workbook, self.max_batches = control, workbook, max_batches
        self.root = f"{namespace_location(spark, db)}/_streams/{table.lower()}"

    def ledger(self, spark) -> _Versions:
        return _Versions(spark, f"{self.root}/ledger")

    def _ledger(self, spark) -> DataFrame:
        path = self.ledger(spark).current()
        return spark.createDataFrame([], LEDGER) if path is None else spark.read.schema(LEDGER).parquet(path)

    def loaded(self, spark) -> DataFrame:
        """Files of visible batches."""
        visible = [(b,) for b in batches(spark, self.db, self.table)]
        return self._ledger(spark).join(F.broadcast(spark.createDataFrame(visible, "batch string")), "batch", "left_semi").select("file").distinct()

    def __call__(self, batch: DataFrame, epoch_id: int) -> None:
        spark, started = batch.sparkSession, datetime.now(timezone.utc)
        typed, checked = typed_batch(batch, self.declared)
        fresh = typed.join(self.loaded(spark).withColumnRenamed("file", FILE_COLUMN), FILE_COLUMN, "left_anti")
        name = uuid.uuid4().hex
        folder = f"{self.root}/data/{name}"
        obs = Observation(f"batch_{name}")
        counts = [F.count_if(F.map_contains_key(MISFITS, c)).alias(f"m{i}") for i, c in enumerate(checked)]
        fresh.select(*typed.columns).observe(obs, F.count(F.lit(1)).alias("rows"), *counts).write.parquet(folder)
        seen = obs.get
        rows = int(seen.get("rows") or 0)
        if not rows:
            delete_path(spark, folder)
            return
        done = spark.read.schema(typed.schema).parquet(folder)
        named = done.select(F.lit(name).alias("batch"), F.col(FILE_COLUMN).alias("file")).distinct()
        self.ledger(spark).append(named)
        if not table_exists(spark, self.db, self.table):
            schema = T.StructType([*typed.schema.fields, T.StructField(BATCH_COLUMN, T.StringType())])
            create_entry(spark, ident(self.db, self.table), schema, "parquet", f"{self.root}/none", [BATCH_COLUMN])
        # from here on the batch is visible
        spark.sql(f"ALTER TABLE {ident(self.db, self.table)} ADD PARTITION ({BATCH_COLUMN}='{name}') LOCATION '{sql_text(folder)}'")
        if self.control is not None:
            lost = {c: int(seen.get(f"m{i}") or 0) for i, c in enumerate(checked)}
            self.control.log_runs([{"run_id": name, "workbook_name": self.workbook, "table_name": self.table, "pos": 0, "rows": rows,
                                    "columns": len(typed.columns) - 2, "status": "success", "error": None, "new_nulls": lost,
                                    "started_at": started, "duration_seconds": (datetime.now(timezone.utc) - started).total_seconds()}])
        if len(batches(spark, self.db, self.table)) >= self.max_batches:
            merge_batches(spark, self.db, self.table)


def batches(spark: SparkSession, db: str, table: str) -> list[str]:
    """Names of the visible batches of a stream target."""
    if not table_exists(spark, db, table):
        return []
    return [r[0].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {ident(db, table)}").collect()]


def merge_batches(spark: SparkSession, db: str, table: str) -> str:
    """Rewrite a stream target as one batch and exchange the table entries; rows and loaded files stay the same.

    The ledger's next version names the visible files under the old batches and under the new one, so it holds whichever of the two entries a
    crash leaves; what it said of batches merged before is gone."""
    writer = _BatchWriter(spark, db, table, {})
    name = uuid.uuid4().hex
    folder = f"{writer.root}/data/{name}"
    source = spark.table(ident(db, table))
    old = batches(spark, db, table)
    source.drop(BATCH_COLUMN).write.parquet(folder)
    kept = writer._ledger(spark).join(F.broadcast(spark.createDataFrame([(b,) for b in old], "batch string")), "batch", "left_semi")
    writer.ledger(spark).replace(kept.unionByName(writer.loaded(spark).select(F.lit(name).alias("batch"), "file")).hint("rebalance"))
    fresh = ident(db, f"__new_{name}")
    create_entry(spark, fresh, source.schema, "parquet", f"{writer.root}/none", [BATCH_COLUMN])
    spark.sql(f"ALTER TABLE {fresh} ADD PARTITION ({BATCH_COLUMN}='{name}') LOCATION '{sql_text(folder)}'")
    exchange_entry(spark, db, table, fresh)
    for b in old:
        delete_path(spark, f"{writer.root}/data/{b}")
    return name


def retype(spark: SparkSession, db: str, table: str, into: str, *, declared: dict | None = None, sniff: str = "undeclared") -> dict:
    """Apply the batch rules to all rows of a stream target, misfits put back as text first; writes ``db.into``."""
    source = spark.table(ident(db, table))
    spilled = [r[0] for r in source.select(F.explode(F.map_keys(MISFITS))).distinct().collect()]  # column names
    raw = source.select(*[F.coalesce(F.col(MISFITS)[c], F.col(f"`{c}`").cast("string")).alias(c) if c in spilled else F.col(f"`{c}`")
                          for c in source.columns if c not in OWN])
    return write_table(spark, coerce_table(raw, declared or {}, sniff=sniff), db, into)


def start_refresh_stream(spark: SparkSession, path: str, schema: T.StructType, db: str, table: str, *,
                         fmt: str = "parquet", declared: dict | None = None, control=None, workbook: str = "",
                         trigger: dict | None = None, checkpoint: str | None = None,
                         max_files_per_trigger: int | None = None, path_glob: str | None = None, max_batches: int = MAX_BATCHES):
    """Start the stream; ``trigger`` defaults to ``{"availableNow": True}``; use
    ``{"processingTime": "5 minutes"}`` for an interval refresh (smallest interval: 5 minutes)."""
    ensure_namespace(spark, db)
    if len(batches(spark, db, table)) >= max_batches:
        merge_batches(spark, db, table)
    reader = spark.readStream.format(fmt).schema(schema)
    if path_glob:
        reader = reader.option("pathGlobFilter", path_glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.load(path).select("*", F.col("_metadata.file_path").alias(FILE_COLUMN))
    ckpt = checkpoint or scratch_path(spark, "streams", f"{db}.{table}")
    writer = _BatchWriter(spark, db, table, declared or {}, control, workbook, max_batches)
    return (stream.writeStream.foreachBatch(writer).option("checkpointLocation", ckpt)
            .trigger(**(trigger or {"availableNow": True})).start())
