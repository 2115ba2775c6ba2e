"""Merkle dataset manifest with pointer-jumping proofs.

Every row is a leaf, the digest of its length-prefixed values. Per partition value the leaves in order of their key are
hashed in runs of FAN, level by level, up to a subroot, and the subroots of all partitions in the same way up to the root.

The nodes of all levels form one table: a node's id, the id of an ancestor (its parent to begin with) and the siblings
met on the way there, a (left, right) pair a level. A self-join of the table with itself, ancestor to id, makes the
ancestor's ancestor the new one and appends its segment, so the distance doubles with each join and every leaf holds its whole
proof after the logarithm of the tree's height. A verifier folds a leaf's digest with the pairs and compares with the root.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakewright.llm.common import numbered, release, spread_lookup, staged

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FAN_BITS = 3
FAN = 1 << FAN_BITS
#: An ancestor of at least 1 / HOT of all leaves is met map-side; a few thousand nodes at most are that large, whatever the data.
HOT = 2048
#: Ids are first leaf * 64 + level; levels from TOP on are those above the subroots, ROOT is the one node above several subroots.
TOP, ROOT = 32, 63
NOTHING = "X''"


def h(text: Column) -> Column:
    """Lower-case hex SHA-256."""
    return F.sha2(text, 256)


def encoded(values: list[Column]) -> Column:
    """Values in order, each as UTF-8 byte count, colon and value; a null is a minus sign."""
    texts = [v.cast("string") for v in values]
    return F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _joined(members: Column) -> Column:
    return F.aggregate(members, F.expr(NOTHING), lambda a, m: F.concat(a, m["d"]))


def _build(leaves: DataFrame, longest: int, code: int) -> tuple[list[DataFrame], DataFrame, list[DataFrame]]:
    """Hash runs level by level. ``leaves`` has tree (where its ids begin), n (leaves of the tree), top (the id that the tree's
    last node gets), i, d, w (leaves of the corpus below) and pay. Returns the pointer tables, the trees' last nodes, and what was staged.
    """
    pointers, held = [], []
    lone = leaves.where("n = 1")
    if code == 0:  # a lone leaf is its subroot: the way there holds no sibling
        empty = F.array().cast("array<struct<left:binary,right:binary>>")
        pointers.append(lone.select((F.col("tree") * 64).alias("id"), F.col("top").alias("up"), "w", empty.alias("seg"), "pay"))
    tops = lone.select("top", "d", "w")
    at, level = leaves, 0
    while FAN ** level < longest:
        span = FAN_BITS * level
        nodes = F.shiftright(F.col("n") + ((1 << span) - 1), span)  # of the tree on this level
        open_ = at.withColumn("nodes", nodes).where("nodes > 1")
        runs = open_.groupBy("tree", F.shiftright("i", FAN_BITS).alias("j")).agg(
            F.max("n").alias("n"), F.max("top").alias("top"), F.max("nodes").alias("nodes"), F.sum("w").alias("w"),
            F.sort_array(F.collect_list(F.struct("i", "d", "w", "pay"))).alias("m"))  # FAN members at most
        parent = F.when(F.col("nodes") <= FAN, F.col("top")).otherwise((F.col("tree") + F.shiftleft("j", span + FAN_BITS)) * 64 + (code + level + 1))
        runs = staged(runs.withColumn("up", parent), "merkle-runs")
        held.append(runs)
        each = runs.select("tree", "up", "m", F.posexplode("m").alias("k", "c"))
        pair = F.struct(_joined(F.slice("m", 1, F.col("k"))).alias("left"), _joined(F.slice("m", F.col("k") + 2, FAN)).alias("right"))
        pointers.append(each.select(((F.col("tree") + F.shiftleft("c.i", span)) * 64 + (code + level)).alias("id"), "up", F.col("c.w").alias("w"),
                                    F.array(pair).alias("seg"), F.col("c.pay").alias("pay")))
        pay = F.lit(None).cast(dict(leaves.dtypes)["pay"]).alias("pay")
        at = runs.select("tree", "n", "top", F.col("j").alias("i"), F.unhex(h(_hex(_joined(F.col("m"))))).alias("d"), "w", pay, "nodes")
        tops = tops.unionByName(at.where(F.col("nodes") <= FAN).select("top", "d", "w"))
        at = at.drop("nodes")
        level += 1
    return pointers, tops, held


@dataclass
class Manifest:
    """``pointers``: a row a node (id, up, w, seg, pay; pay only for leaves); ``subroots``: (top, d, w), ``root``: hex digest,
    ``rows``: number of leaves, ``hops``: the most pointers between a leaf and the root, ``root_id``."""
    pointers: DataFrame
    subroots: DataFrame
    root: str | None
    rows: int
    hops: int
    root_id: int


def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, by: str = "lang", key: str = "doc_id", claimed: dict[str, Column] | None = None,
             when: Column | None = None) -> Manifest:
    """The tree over all rows of ``docs``: leaves per value of ``by`` (null first, then bytewise) in order of ``key``.

    ``claimed`` gives other values of some fields, for rows where ``when`` holds: the digest of such a row is kept beside its
    leaf, to be held against the tree. Repeated keys stand in order of their leaves, null keys come first, repeated rows are leaves
    of their own. Columns besides ``fields`` are not read. An empty table has no root.
    """
    values = [F.col(f) for f in fields]
    other = [(claimed or {}).get(f, F.col(f)) for f in fields]
    claim = F.when(F.lit(False) if when is None else when, F.unhex(h(encoded(other))))
    group = F.coalesce(F.concat(F.lit("s"), F.col(by).cast("string")), F.lit("n"))
    rows = docs.select(F.col(key).alias("_key"), F.col(by).alias("_by"), group.alias("_group"), F.unhex(h(encoded(values))).alias("leaf"),
                       claim.alias("claim"), F.monotonically_increasing_id().alias("_uid"))
    placed = numbered(rows, [F.asc_nulls_first("_by"), F.asc_nulls_first("_key"), F.col("leaf"), F.col("_uid")], "merkle-rows")
    groups = placed.groupBy("_group").agg(F.min("pos").alias("tree"), F.count(F.lit(1)).alias("n"))
    groups = staged(numbered(groups, [F.col("tree")], "merkle-groups").withColumnRenamed("pos", "t"), "merkle-groups")
    stats = groups.agg(F.count(F.lit(1)).alias("groups"), F.max("n").alias("longest"), F.sum("n").alias("rows")).first()
    root_id = TOP if stats.groups == 1 else ROOT
    found = spread_lookup(placed, groups, "_group").withColumn("top", F.col("t") * 64 + TOP)
    pay = F.struct(F.col("_key").alias("key"), "leaf", "claim", "top").alias("pay")
    leaves = found.select("tree", "n", "top", (F.col("pos") - F.col("tree")).alias("i"), F.col("leaf").alias("d"), F.lit(1).cast("long").alias("w"), pay)
    pointers, subroots, held = _build(staged(leaves, "merkle-leaves"), stats.longest or 0, 0)
    subroots = staged(subroots, "merkle-subroots")
    upper = subroots.select(F.lit(0).cast("long").alias("tree"), F.lit(stats.groups).cast("long").alias("n"), F.lit(root_id).cast("long").alias("top"),
                            F.shiftright("top", 6).alias("i"), "d", "w", F.lit(None).cast(pay_type(leaves)).alias("pay"))
    above, last, more = _build(upper, stats.groups, TOP)
    root = last.select(_hex(F.col("d")).alias("d")).first()
    all_ = pointers[0]
    for p in [*pointers[1:], *above]:
        all_ = all_.unionByName(p)
    all_ = staged(all_, "merkle-pointers")
    release(*held, *more)

    def height(n: int | None) -> int:
        return 0 if not n or n < 2 else math.ceil(round(math.log2(n) / FAN_BITS, 9))
    return Manifest(all_, subroots, root.d if root else None, stats.rows or 0, max(1, height(stats.longest)) + height(stats.groups), root_id)


def pay_type(leaves: DataFrame) -> str:
    return dict(leaves.dtypes)["pay"]


def _meet(left: DataFrame, right: DataFrame, key: str, rows: int) -> DataFrame:
    """Inner join to ``right``, one row a ``key`` with w, the number of leaves below: large ones are broadcast (a few thousand
    whatever the data), the others each meet less than 1 / HOT of the leaves in a shuffle."""
    large = F.col("w") * HOT >= rows
    hot, cold = right.where(large).drop("w"), right.where(~large).drop("w")
    there = F.broadcast(hot.select(key))
    return left.join(F.broadcast(hot), key).unionByName(left.join(there, key, "left_anti").join(cold, key))


def proofs(m: Manifest) -> DataFrame:
    """(key, leaf, claim, top, seg): each leaf with its siblings up to the root, by pointer jumping."""
    at = m.pointers
    rounds = max(0, math.ceil(math.log2(m.hops)))
    for n in range(rounds):
        way = F.col("id").bitwiseAND(F.lit(63)) != 0  # leaves are nobody's ancestors
        ancestors = at.where(way).select(F.col("id").alias("up"), F.col("up").alias("_up"), F.col("seg").alias("_seg"), "w")
        going = at if n < rounds - 1 else at.where("pay IS NOT NULL")
        met = _meet(going.where(F.col("up") != m.root_id), ancestors, "up", m.rows)
        met = met.select("id", F.col("_up").alias("up"), "w", F.concat("seg", "_seg").alias("seg"), "pay")
        new = going.where(F.col("up") == m.root_id).unionByName(met)
        if n < rounds - 1:
            new = staged(new, "merkle-pointers")
            release(at)
        at = new
    return at.where("pay IS NOT NULL").select("pay.*", "seg")


def folded(start: Column, seg: Column) -> Column:
    """The root that a proof gives for a leaf's hex digest."""
    return F.aggregate(seg, start, lambda a, s: h(F.concat(_hex(s["left"]), a, _hex(s["right"]))))


def verify(docs: DataFrame, claimed: dict[str, Column] | None = None, when: Column | None = None) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified (see ``manifest``).

    ``folded_root`` is worked out from the claimed values where there are such, else from the row itself, and the siblings of the proof.
    """
    m = manifest(docs, claimed=claimed, when=when)
    out = _meet(proofs(m), m.subroots.select("top", F.col("d").alias("_subroot"), "w"), "top", m.rows)
    siblings = F.array_join(F.transform("seg", lambda s: F.concat(_hex(s["left"]), _hex(s["right"]))), "")
    end = folded(_hex(F.coalesce("claim", "leaf")), F.col("seg"))
    out = out.select(F.col("key").alias("doc_id"), _hex(F.col("leaf")).alias("leaf"), _hex(F.col("_subroot")).alias("subroot"),
                     F.lit(m.root).alias("root"), h(siblings).alias("proof_sha256"), end.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def tampered_third(docs: DataFrame) -> DataFrame:
    """``verify`` where every third document, by the CRC-32 of its decimal doc_id, is claimed with its capitals A-Z lower-cased."""
    third = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False))
    return verify(docs, {"text": F.translate("text", CAPITALS, CAPITALS.lower())}, third)
