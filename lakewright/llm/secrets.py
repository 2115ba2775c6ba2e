"""Secret scanning with an incremental blob ledger (DataFrame functions only).

Every version of a document is addressed by the SHA-256 of its text. The ledger records which
(blob, rule, rule version) triples have been scanned and what they held; a scan looks only at triples that the
ledger lacks, appends them, and joins the findings back to all documents (paths) that hold the blob.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewright.llm.common import spread_lookup, staged


@dataclass(frozen=True)
class Rule:
    """All leftmost non-overlapping matches of ``pattern``, kept if ``group`` has ``least`` characters or more."""
    kind: str
    version: int
    pattern: str
    group: int
    least: int


# The base rules of the scan contract, in their listed order.
RULES = (
    Rule("assign", 1, r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", 1, r"[0-9a-f]+", 0, 16),
)
SPANS = "array<struct<start:bigint,end:bigint>>"
LEDGER = f"blob string, rule string, rule_version int, spans {SPANS}"


def spans(text: Column, rule: Rule) -> Column:
    """Spans of ``rule`` in ``text``, in code points, end exclusive.

    The text between matches (split) and the matches (extract) alternate, so a match starts at the summed
    lengths before it. Only texts in which a long enough match is possible are split.
    """
    pattern = F.lit(rule.pattern)
    gaps = F.transform(F.split(text, rule.pattern, -1), lambda s: F.length(s).cast("long"))
    hits = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), lambda s: F.length(s).cast("long"))
    kept = F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), lambda s: F.length(s) >= rule.least)
    both = F.arrays_zip(F.slice(gaps, 1, F.size(hits)).alias("gap"), hits.alias("hit"), kept.alias("ok"))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(SPANS).alias("found"))

    def step(acc, x):
        begin = acc["at"] + x["gap"]
        end = begin + x["hit"]
        found = F.when(x["ok"], F.concat(acc["found"], F.array(F.struct(begin.alias("start"), end.alias("end"))))).otherwise(acc["found"])
        return F.struct(end.alias("at"), found.alias("found"))

    possible = F.regexp_like(text, F.lit(_possible(rule)))
    return F.when(possible, F.aggregate(both, start, step, lambda acc: acc["found"])).otherwise(F.array().cast(SPANS))


def _possible(rule: Rule) -> str:
    """A pattern that every text with a kept match fulfils: the rule with its last run held to the least length."""
    least = rule.least - 4 if rule.kind == "access" else rule.least
    body = rule.pattern.rstrip(")")
    return f"{body[:-1]}{{{least}}}" + rule.pattern[len(body):] if body.endswith("]+") else rule.pattern


def update_ledger(spark: SparkSession, docs: DataFrame, ledger: DataFrame | None = None,
                  rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Findings for the (blob, rule, version) triples of ``docs`` that ``ledger`` does not hold yet.

    One row per new triple, also when it holds nothing, so that it is not scanned again. Copies of a blob
    are merged before the text is shuffled.
    """
    blobs = docs.select(F.coalesce("text", F.lit("")).alias("text")).select(F.sha2("text", 256).alias("blob"), "text")
    blobs = blobs.groupBy("blob").agg(F.first("text").alias("text"))
    current = F.array(*[F.concat_ws(":", F.lit(r.kind), F.lit(str(r.version))) for r in rules])
    if ledger is None:
        unseen = blobs.withColumn("_seen", F.array().cast("array<string>"))
    else:
        seen = ledger.groupBy("blob").agg(F.collect_set(F.concat_ws(":", "rule", F.col("rule_version").cast("string"))).alias("_seen"))
        unseen = blobs.join(seen, "blob", "left").withColumn("_seen", F.coalesce("_seen", F.array().cast("array<string>")))
        unseen = unseen.where(F.size(F.array_except(current, F.col("_seen"))) > 0)
    each = F.array(*[F.struct(F.lit(r.kind).alias("rule"), F.lit(r.version).alias("rule_version"),
                              F.when(~F.array_contains("_seen", f"{r.kind}:{r.version}"), spans(F.col("text"), r)).alias("spans"))
                     for r in rules])
    found = unseen.select("blob", F.explode(each).alias("f")).select("blob", "f.rule", "f.rule_version", "f.spans")
    return found.where(F.col("spans").isNotNull())


def scan(spark: SparkSession, docs: DataFrame, ledger_path: str | None = None,
         rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document: doc_id, blob, findings array<struct<start, rank, kind, end>> in order of start, then rule.

    With ``ledger_path`` (shared storage) the ledger there is read, completed and kept for the next
    run; without, a scratch one is used. Null text counts as empty. Repeated rows and rows with null doc_id
    each give their own row; extra columns are not read; an empty table gives no rows.
    """
    old = None
    if ledger_path and _exists(spark, ledger_path):
        old = spark.read.schema(LEDGER).parquet(ledger_path)
    new = update_ledger(spark, docs, old, rules)
    if ledger_path:
        new.write.mode("append").parquet(ledger_path)
        ledger = spark.read.schema(LEDGER).parquet(ledger_path)
    else:
        ledger = staged(new, "secrets-ledger")
    rank = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(i))])
    wanted = F.array(*[F.concat_ws(":", F.lit(r.kind), F.lit(str(r.version))) for r in rules])
    now = ledger.where(F.array_contains(wanted, F.concat_ws(":", "rule", F.col("rule_version").cast("string"))) & (F.size("spans") > 0))
    by_blob = (now.select("blob", F.transform("spans", lambda s: F.struct(
        s["start"].alias("start"), rank[F.col("rule")].alias("rank"), F.col("rule").alias("kind"), s["end"].alias("end"))).alias("f"))
        .groupBy("blob").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("f")))).alias("findings")))
    by_blob = staged(by_blob, "secrets-findings")
    paths = staged(docs.select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("blob")), "secrets-paths")
    return spread_lookup(paths, by_blob, "blob").withColumn(
        "findings", F.coalesce("findings", F.array().cast("array<struct<start:bigint,rank:int,kind:string,end:bigint>>")))


def digest(found: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, n_<rule> of the base rules, base_sha256 and spans, from the result of ``scan``."""
    base = [r.kind for r in RULES]

    def told(findings: Column) -> Column:
        return F.array_join(F.transform(findings, lambda f: F.concat_ws(":", f["kind"], f["start"].cast("string"), f["end"].cast("string"))), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("findings", lambda f: f["kind"] == kind)).cast("long").alias(f"n_{kind}")

    kinds = [count(k) for k in base]
    of_base = F.filter("findings", lambda f: f["kind"].isin(base))
    return found.select("doc_id", *kinds, F.sha2(told(of_base), 256).alias("base_sha256"), told(F.col("findings")).alias("spans"))


def _exists(spark: SparkSession, uri: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(uri)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
