"""Registered queries of the training-data operators: thin, whole tables, production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewright.llm.common import table


#: The tokenizer file of the packing contract, found through the installed vocabulary package.
TOKENIZER = "word_bpe_49k.json"


def op1_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from lakewright.llm.packing import pack
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakewright.llm.warc import read_archives, resolved, write_archives
    records = read_archives(write_archives(table(spark, sf_dir, "pages")), with_payload=False)
    return resolved(records).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "verified")


def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakewright.llm.topk import top_k
    return top_k(table(spark, sf_dir, "embeddings"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakewright.llm.linededup import dedup_lines
    out = dedup_lines(table(spark, sf_dir, "documents"), stored=True)
    return out.select("row.doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakewright.llm.secrets import digest, scan
    return digest(scan(spark, table(spark, sf_dir, "documents")))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakewright.llm.simhash import near_duplicates
    out = near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakewright.llm.exact import exact_duplicates
    return exact_duplicates(table(spark, sf_dir, "documents"))


def op8_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakewright.llm.suffix import dedup_substrings
    return dedup_substrings(table(spark, sf_dir, "documents"), with_text=False)


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakewright.llm.mixing import mix
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "rate", "copies")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakewright.llm.quality import classify
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakewright.llm.merkle import tampered_third
    return tampered_third(table(spark, sf_dir, "documents"))


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakewright.llm.conversations import repair_damaged
    return repair_damaged(table(spark, sf_dir, "conversations"))


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakewright.llm.sharding import shard
    return shard(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_pack": op1_pack,
    "op2_warc": op2_warc,
    "op3_top_k": op3_top_k,
    "op4_line_dedup": op4_line_dedup,
    "op5_secret_scan": op5_secret_scan,
    "op6_simhash": op6_simhash,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_substrings": op8_substrings,
    "op9_source_mix": op9_source_mix,
    "op10_quality": op10_quality,
    "op11_merkle": op11_merkle,
    "op12_conversations": op12_conversations,
    "op13_sharding": op13_sharding,
}
