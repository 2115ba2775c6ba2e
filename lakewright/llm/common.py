"""Helpers shared by the training-data operators: shared-folder tables, skew-safe lookup, components."""

from __future__ import annotations

import gc
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakewright.session import remove_path, scratch_path

#: A key with at least one row in HOT_PARTS is looked up map-side; there are at most HOT_PARTS such keys.
HOT_PARTS = 200
#: Salts for the rows that a map-side lookup has already answered.
SPREAD = 1 << 20
#: A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _free_shuffles(spark: SparkSession) -> None:
    """The shuffle files behind earlier tables are no longer needed; Spark removes them when the driver's JVM collects their handles."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared scratch folder and read it back: cuts the lineage, survives the
    loss of an executor, and is computed once."""
    spark = df.sparkSession
    _free_shuffles(spark)
    path = scratch_path(spark, "llm", name, unique=True)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_path = path
    return out


def bucketed(df: DataFrame, key: str, name: str) -> DataFrame:
    """``staged`` in buckets by ``key``, as many as shuffles have partitions: a join on it deals out the other side only. ``df``
    should come from a shuffle by ``key``, or each task writes to each bucket. Buckets are known to the catalog, which has an entry until the release."""
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    _free_shuffles(spark)
    path, entry = scratch_path(spark, "llm", name, unique=True), f"lakewright_{uuid.uuid4().hex}"
    df.write.format("parquet").option("compression", "zstd").option("path", path).bucketBy(buckets, key).saveAsTable(entry)
    out = spark.table(entry)
    out.staged_path, out.catalog_entry = path, entry
    return out


def release(*tables: DataFrame) -> None:
    """Remove staged tables that nothing reads any more."""
    for t in tables:
        if entry := getattr(t, "catalog_entry", None):
            t.sparkSession.sql(f"DROP TABLE IF EXISTS {entry}")
        remove_path(t.sparkSession, t.staged_path)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int):
    """Within, at most ``rows`` rows go to Python at once: for tables whose rows are large."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def least_hashed(ids: DataFrame, most: int, salt: str) -> DataFrame:
    """At most ``most`` rows of the one-column ``ids``, those of least hash. A first filter at twice the needed
    share keeps what each task hands on small, however many tasks there are."""
    column = ids.columns[0]
    draw = F.pmod(F.xxhash64(F.lit(salt), column), F.lit(1 << 30))
    share = min(1.0, 2.0 * most / max(1, ids.count()))
    return ids.where(draw < int(share * (1 << 30))).orderBy(draw, column).limit(most)


def hex_long(column: Column, digits: int = 15) -> Column:
    """The first hex digits of a digest as a non-negative long."""
    return F.conv(F.substring(column, 1, digits), 16, 10).cast("long")


def spread_lookup(left: DataFrame, right: DataFrame, key: str, left_key: str | None = None) -> DataFrame:
    """Left outer join of ``left`` to ``right``, whose non-null ``key`` is unique, safe for hot keys.

    Keys that hold at least 1/HOT_PARTS of the left rows number at most HOT_PARTS, whatever the data: their
    rows are answered from a broadcast of that bound. All other rows meet ``right`` in an ordinary
    shuffle join; answered ones get a salt, so that they spread. Both frames should be staged tables,
    as they are read more than once. Adds the other columns of ``right``.
    """
    left_key = left_key or key
    values = [c for c in right.columns if c != key]
    counts = left.where(F.col(left_key).isNotNull()).groupBy(left_key).agg(F.count(F.lit(1)).alias("_n"))
    least = max(left.count() // HOT_PARTS, 1000)  # below 1000 rows no key is worth it
    hot_keys = counts.where(F.col("_n") > least).select(F.col(left_key).alias(key))
    hot = right.join(F.broadcast(hot_keys), key, "left_semi")
    packed = F.struct(*values)
    out = left.join(F.broadcast(hot.select(F.col(key).alias("_hk"), packed.alias("_hot"))),
                    F.col(left_key) == F.col("_hk"), "left").drop("_hk")
    out = out.withColumn("_salt", F.when(F.col("_hot").isNull(), F.lit(0))
                         .otherwise((F.rand(7) * SPREAD).cast("int") + 1))
    cold = right.select(F.col(key).alias("_ck"), F.lit(0).alias("_zero"), packed.alias("_cold"))
    out = out.join(cold, (F.col(left_key) == F.col("_ck")) & (F.col("_salt") == F.col("_zero")), "left")
    out = out.withColumn("_got", F.coalesce("_hot", "_cold"))
    keep = [c for c in left.columns if c not in values]
    return out.select(*[F.col(f"`{c}`") for c in keep], *[F.col(f"_got.`{v}`").alias(v) for v in values])


def numbered(df: DataFrame, order: list, name: str) -> DataFrame:
    """``df`` as a staged table with ``pos``, the row's number from 0 in ``order`` (which should leave no ties).

    Rows are dealt by ranges of ``order`` and sorted there; the row's number in its task and the sizes of the tasks
    before it (a row a task) give its place, so no task sees more than its range.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    ranged = staged(ranged, name)
    task = F.shiftright("_at", 33)
    sizes = ranged.groupBy(task.alias("_task")).agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("_task", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    out = ranged.withColumn("_task", task).join(F.broadcast(before), "_task")
    return out.withColumn("pos", F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).drop("_task", "_at", "_before")


def components(edges: DataFrame, name: str) -> DataFrame:
    """Connected components of ``edges(a long, b long)``: (node, root), one row per node of an edge.

    Contraction: every node hangs on its smallest neighbour (a map-side combined minimum), the edges move
    to the parents, and loops and repeats go; each round at least halves the nodes of every component.
    The per-round parent tables, each smaller than the last, are then composed from the end.
    No list of neighbours is ever built, so a node of any degree is fine: its edges meet one parent row in
    a join whose large partitions Spark splits.
    """
    spark = edges.sparkSession

    def clean(pairs: DataFrame) -> DataFrame:
        return pairs.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    todo = staged(clean(edges), f"{name}-edges")
    rounds = []
    while not todo.isEmpty():
        both = todo.select("a", "b").union(todo.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = staged(both.groupBy("a").agg(F.min("b").alias("m"))
                        .select(F.col("a").alias("node"), F.least("a", "m").alias("root")), f"{name}-parents")
        rounds.append(parent)
        moved = (todo.join(parent.toDF("a", "pa"), "a").join(parent.toDF("b", "pb"), "b")
                 .select(F.col("pa").alias("a"), F.col("pb").alias("b")))
        todo = staged(clean(moved), f"{name}-edges")
    if not rounds:
        return spark.createDataFrame([], "node long, root long")
    final = rounds.pop()
    while rounds:
        parent = rounds.pop().toDF("node", "via")
        final = staged(parent.join(final.toDF("via", "root"), "via", "left")
                       .select("node", F.coalesce("root", "via").alias("root")), f"{name}-roots")
    return final
