"""Corpus pipeline: quality filter, line dedup, near dedup, source mix, packing.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; all but the last return the
columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakewright.llm.common import staged, table
from lakewright.llm.linededup import without_repeats
from lakewright.llm.mixing import repeat
from lakewright.llm.packing import pack
from lakewright.llm.quality import keep_good
from lakewright.llm.queries import TOKENIZER
from lakewright.llm.simhash import keep_one

#: Learned weights, fingerprints and packing are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the classifier, trained on labels of these documents, rejects."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that nearly repeat an earlier one."""
    return without_repeats(docs, stored=True)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group."""
    return keep_one(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target asks for, maybe not at all."""
    return repeat(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of at most 2048 tokens."""
    import public_tokenizers
    return pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality_filter", quality_filter),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("source_mix", source_mix),
    ("pack_sequences", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written as Parquet and read again as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
