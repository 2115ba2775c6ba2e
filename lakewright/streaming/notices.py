"""Change notices (M2): ``{workbook_name, tables, ts}`` events -> refreshes of the named tables.

A notice counts once per workbook and table within the lateness allowance: a second notice that names other
tables is not dropped. ``dropDuplicatesWithinWatermark`` keeps state only until the watermark passes, so state
stays bounded by the notices of the last few minutes.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewright.operators.control import LATE_START_SECONDS
from lakewright.operators.dedupe import first_wins
from lakewright.session import scratch_path
from lakewright.sinks.tables import _fs_path, ensure_namespace, write_batch_partition


def dedupe_notices(notices: DataFrame, lateness: str = f"{LATE_START_SECONDS} seconds") -> DataFrame:
    """(workbook_name, table, ts): the first notice per workbook and table within the watermark delay; a notice without
    tables has one row with a null table, meaning all. On a batch frame the earliest one is kept."""
    one = notices.select("workbook_name", F.explode_outer("tables").alias("table"), "ts")
    if not notices.isStreaming:
        return first_wins(one, ["workbook_name", "table"], ["ts"])
    return one.withWatermark("ts", lateness).dropDuplicatesWithinWatermark(["workbook_name", "table"])


def merged(accepted: DataFrame) -> DataFrame:
    """(workbook_name, tables, ts): accepted notices per workbook; ``tables`` null if one asks for all."""
    return accepted.groupBy("workbook_name").agg(
        F.when(F.count_if(F.col("table").isNull()) == 0, F.sort_array(F.collect_set("table"))).alias("tables"), F.min("ts").alias("ts"))


def refresh_named(spark: SparkSession, control, sources: dict | None = None, credentials: dict | None = None):
    """An ``on_batch`` that refreshes the tables each accepted notice names; a failed one is recorded and the rest go on."""
    from lakewright.plans.refresh import refresh_many

    def on_batch(batch: DataFrame, epoch_id: int) -> None:
        for row in batch.toLocalIterator():
            refresh_many(spark, control, [row["workbook_name"]], sources, credentials, tables=row["tables"])
    return on_batch


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """A name that lives and dies with the checkpoint: a restart from it has the same one, a new or emptied checkpoint another."""
    path, fs = _fs_path(spark, f"{checkpoint.rstrip('/')}/lakewright_stream_id")
    jvm = spark.sparkContext._jvm
    if not fs.exists(path):
        out = fs.create(path)
        out.write(bytearray(uuid.uuid4().hex.encode()))
        out.close()
    stream = fs.open(path)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip()
    finally:
        stream.close()


def start_notice_stream(spark: SparkSession, notices: DataFrame, db: str, table: str = "refresh_notices", *,
                        on_batch=None, trigger: dict | None = None, checkpoint: str | None = None):
    """Deduplicate a notice stream and record what each batch accepts, one row a workbook; ``on_batch(df, epoch)``
    may start the refreshes (see ``refresh_named``). A batch is a partition named by the stream's id and the epoch: a retried one
    replaces its earlier attempt, and a stream with another checkpoint adds to the table."""
    ensure_namespace(spark, db)
    ckpt = checkpoint or scratch_path(spark, "streams", f"{db}.{table}")
    name = stream_id(spark, ckpt)

    def sink(batch: DataFrame, epoch_id: int) -> None:
        batch = merged(batch)
        if on_batch is not None:
            batch = batch.persist()
        try:
            write_batch_partition(batch.withColumn("__batch", F.lit(f"{name}-{epoch_id:09d}")), db, table, "__batch")
            if on_batch is not None:
                on_batch(batch, epoch_id)
        finally:
            batch.unpersist()

    return (dedupe_notices(notices).writeStream.foreachBatch(sink).option("checkpointLocation", ckpt)
            .trigger(**(trigger or {"availableNow": True})).start())
