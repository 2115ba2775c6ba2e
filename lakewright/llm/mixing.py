"""Mixing sources to target weights (DataFrame functions only).

Tokens are summed per source, each source gets a target by weight (no target above ``cap`` times
the source, the excess reshared by weight), and the repetition rate is target / size. A document is
taken floor(rate) times plus one hash-seeded Bernoulli copy with the fraction as its probability.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakewright.llm.common import WORD, hex_long, spread_lookup, staged

WEIGHTS = (5, 2, 1)
CAP = 3
#: Resolution of the drawn numbers: 13 hex digits, exact in a double.
DRAWS = float(16 ** 13)


def words(text: Column) -> Column:
    """Number of words of a text; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """(source, source_size, n) -> the same with ``target``; targets sum to all sizes.

    Sources in code-point order, null last, get ``weights`` in turn. With a common level L a source's target
    is min(cap * size, weight * L). Taken in order of cap * size / weight the saturated sources come
    first, so L follows from running sums. The windows see one row per source, never documents.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    turn = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (turn + 1).cast("int"))
    s = sizes.withColumn("_w", w).withColumn("_most", F.col("source_size") * float(cap))
    by_fill = Window.orderBy(F.col("_most") / F.col("_w"), F.col("source").isNull(), F.col("source"))
    every = Window.partitionBy(F.lit(1))
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    s = (s.withColumn("_total", F.sum("source_size").over(every))
         .withColumn("_full", F.coalesce(F.sum("_most").over(before), F.lit(0.0)))
         .withColumn("_left", F.sum("_w").over(every) - F.coalesce(F.sum("_w").over(before), F.lit(0.0)))
         .withColumn("_level", (F.col("_total") - F.col("_full")) / F.col("_left")))
    # the first source whose cap lies above the level of what is left sets the level for all after it
    s = s.withColumn("_open", F.col("_most") >= F.col("_w") * F.col("_level"))
    s = s.withColumn("_final", F.min(F.when(F.col("_open"), F.struct((F.col("_most") / F.col("_w")).alias("r"),
                                                                     F.col("_level").alias("l")))).over(every)["l"])
    return s.select("source", "source_size", "n", F.least("_most", F.col("_w") * F.col("_final")).alias("target"))


def draw(doc_id: Column, text: Column, seed: int) -> Column:
    """A number in [0, 1) from seed and doc_id; a null doc_id draws by its text."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.concat(F.lit("#"), F.md5(text)), F.lit("")))
    return hex_long(F.md5(named), 13) / F.lit(DRAWS)


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seed: int = 17) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, rate, copies, taken.

    Null text has size 0; a null source is a source of its own, last in order. Documents of an empty
    source are taken 0 times. Repeated rows of one doc_id draw the same number. A source that holds
    most rows is summed map-side and looked up from a broadcast of at most 200 sources.
    Other columns of ``docs`` are not read. An empty table gives no rows.
    """
    sized = staged(docs.select("doc_id", "source", words(F.col("text")).alias("size"),
                               draw(F.col("doc_id"), F.col("text"), seed).alias("drawn"))
                   .withColumn("_source", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n"))), "mix-sized")
    by_source = sized.groupBy("_source", "source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    shares = targets(by_source, weights, cap).select(
        F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")).alias("_source"), "source_size", "target")
    out = spread_lookup(sized, staged(shares, "mix-targets"), "_source")
    rate = F.least(F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0),
                   F.lit(float(cap)))
    copies = F.floor("rate") + (F.col("drawn") < F.col("rate") - F.floor("rate")).cast("long")
    return (out.withColumn("rate", rate).withColumn("copies", copies)
            .select("doc_id", "source", "size", "source_size", "target", "rate", "copies",
                    (F.col("size") * F.col("copies")).alias("taken")))


def repeat(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seed: int = 17) -> DataFrame:
    """The mixed corpus itself: every row of ``docs``, with all its columns, as often as ``mix`` takes it."""
    source = F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n"))
    rate = mix(docs, weights, cap, seed).select(source.alias("_source"), "rate").groupBy("_source").agg(F.max("rate").alias("rate"))
    packed = docs.select(F.struct("*").alias("_row"), source.alias("_source"), draw(F.col("doc_id"), F.col("text"), seed).alias("_drawn"))
    out = spread_lookup(packed, staged(rate, "mix-rates"), "_source")
    copies = F.floor("rate") + (F.col("_drawn") < F.col("rate") - F.floor("rate")).cast("long")
    return (out.withColumn("_copies", copies.cast("int")).where("_copies > 0")
            .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select("_row.*"))
