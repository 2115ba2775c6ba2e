"""Conversation structure repair by prefix-doubling path ranking.

A conversation's rows, in order of turn, are the letters of a small automaton whose states say what the repaired conversation
ends with so far: nothing, a system, a user or an assistant row. Every row may be kept, given another role or deleted, and empty
rows may be inserted, so that role initials read ``(s?(ua)+)?``; each edit has a price. A cost DP from the end gives every
node (row, state) its cheapest price to the end, and the edits that attain it are its optimal arcs. Nodes are then
ranked by the least audit (the edits' initials in order) of length 1, 2, 4, ... that optimal arcs spell from them: the rank of a doubled length is the
rank of the pair (own rank, rank at the pointer), and the pointer doubles with it. Ranks choose a node's arc, and the doubled pointers
list the least path without walking it.

Rows are numbered over the whole table and dealt into chunks of CHUNK consecutive ones, so a conversation of any length is
spread: its pieces (segments) are solved apart. A segment hands on a (min, +) matrix of prices from state to state;
matrices of a conversation's segments are multiplied by doubling self-joins, which gives each segment the prices at its end, and
the states in which segments are entered follow in the same way from their maps of entry to exit.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from lakewright.llm.common import arrow_rows, numbered, staged

CHUNK = 4096
WHITE = " \t\n\x0b\f\r"
RETYPE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
NEVER = 1 << 40
#: States: nothing yet, after a system, a user, an assistant row. NEXT: the state after the only role that an inserted or retyped row may have.
NEXT = (2, 2, 3, 2)
NAMES = {2: "user", 3: "assistant"}
ENDS = (0, 3)
BLANK, DUPLICATE, CUT = 1, 2, 3


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text of every row after damage by the CRC-32 of ``conv_id:turn`` modulo 20: 0 drops the row,
    1 empties its text, 2 removes its ``[.!?]``, 3 repeats it, 4 sets the role user. Nulls count as one space."""
    def known(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn")).cast("binary")) % 20
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(known("text"), "[.!?]", "")).otherwise(known("text"))
    role = F.when(kind == 4, F.lit("user")).otherwise(known("role"))
    copies = F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return conversations.where(kind != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("_copy")).drop("_copy")


def _inserted(v):
    """Prices before a row, from those without an insertion there."""
    u, a = min(v[2], INSERT + v[3]), min(v[3], INSERT + v[2])
    return min(v[0], INSERT + u), min(v[1], INSERT + u), u, a


def _edits(role: int, fault: int, state: int):
    """(letter, price, state after) of the edits that a row allows; role 1, 2, 3: initial s, u, a; 0: any other."""
    out = [("D", DELETE, state)]
    if fault not in (BLANK, DUPLICATE):
        extra = TRUNCATED if fault == CUT else 0
        if role == 1 and state == 0 or role > 1 and role == NEXT[state]:
            out.append(("K", extra, role))
        out.append(("R", RETYPE + extra, NEXT[state]))
    return out


EDITS = {(r, f): [_edits(r, f, s) for s in range(4)] for r in range(4) for f in range(4)}


def prices(roles: bytes, faults: bytes, end) -> list[tuple]:
    """The cheapest price from each state before each row (and after the last) to ``end``, the prices after the last."""
    at = tuple(end)
    out = [at]
    for row in zip(reversed(roles), reversed(faults)):
        at = _inserted([min(p + at[to] for _, p, to in own) for own in EDITS[row]])
        out.append(at)
    return out[::-1]


ACCEPT = _inserted([0 if s in ENDS else NEVER for s in range(4)])


def matrix(roles: bytes, faults: bytes) -> list[int]:
    """Prices from each state before the rows to each state after them, row by row."""
    to = [prices(roles, faults, [0 if s == x else NEVER for s in range(4)])[0] for x in range(4)]
    return [min(to[x][s], NEVER) for s in range(4) for x in range(4)]


def arcs(roles: bytes, faults: bytes, cost: list[tuple], last: bool):
    """Optimal arcs (node, letter, node) of one segment; node 4 * row + state. Only the conversation's last segment inserts after its rows."""
    for p, row in enumerate(zip(roles, faults)):
        here, there = cost[p], cost[p + 1]
        for s, own in enumerate(EDITS[row]):
            best = here[s]
            for letter, price, to in own:
                if price + there[to] == best:
                    yield 4 * p + s, letter, 4 * p + 4 + to
            if INSERT + here[NEXT[s]] == best:
                yield 4 * p + s, "I", 4 * p + NEXT[s]
    if last:
        p = 4 * len(roles)
        for s in (1, 2):
            yield p + s, "I", p + NEXT[s]


def ranked_paths(n: int, src: np.ndarray, letter: np.ndarray, dst: np.ndarray):
    """Letters of the least path's first arc for each of ``n`` nodes (0 where it ends) and its pointers of lengths 1, 2, 4, ...

    Every doubling ranks the nodes by twice as long an audit, until all pointers stand still. A node's letters differ, so
    its least arc is known from length 1 on; ties between equal letters would fall to the rank at the arc's end.
    """
    first, step = np.zeros(n, np.int64), np.arange(n)
    order = np.lexsort((dst, letter, src))[::-1]
    first[src[order]], step[src[order]] = letter[order], dst[order]  # the least letter is written last
    rank, pointers = first, [step]
    while True:
        far = pointers[-1][pointers[-1]]
        if (far == pointers[-1]).all():
            break
        rank = np.unique(rank * (int(rank.max()) + 1) + rank[pointers[-1]], return_inverse=True)[1].reshape(n).astype(np.int64)
        pointers.append(far)
    order = np.lexsort((rank[dst], letter, src))[::-1]
    chosen = step.copy()
    chosen[src[order]] = dst[order]
    assert (chosen == step).all()
    return first, pointers


def listed(start: int, first: np.ndarray, pointers: list[np.ndarray]) -> tuple[str, int]:
    """The audit from node ``start`` and the node where it ends."""
    path = np.array([start])
    for p in pointers:
        path = np.concatenate([path, p[path]])
    letters = first[path]
    end = np.flatnonzero(letters == 0)
    if len(end):  # the last pointers stand still, so every path has ended
        letters = letters[:end[0]]
        return letters.astype(np.uint8).tobytes().decode(), int(path[end[0]])
    raise AssertionError("a path has not ended")


def _segments(rows: pa.Table, firsts: pa.Table) -> pa.Table:
    """Of one chunk: a row a conversation in it."""
    rows = rows.sort_by("pos")
    new = np.isin(rows.column("pos").to_numpy(), firsts.column("pos").to_numpy())
    blank, cut = (rows.column(c).to_numpy(zero_copy_only=False).astype(bool) for c in ("blank", "cut"))
    fault = np.where(blank, BLANK, np.where(~new, DUPLICATE, np.where(cut, CUT, 0))).astype(np.uint8)
    role = rows.column("initial").to_numpy().astype(np.uint8)
    uid = rows.column("uid").to_numpy()
    conv = rows.column("conv_id").to_pylist()
    starts = [0, *(i for i in range(1, len(conv)) if conv[i] != conv[i - 1]), len(conv)] if conv else [0]
    out = {k: [] for k in ("conv_id", "chunk", "seg", "roles", "faults", "uids", "blank", "duplicate", "truncated", "illegal", "m")}
    chunk = rows.column("chunk")[0].as_py() if conv else 0
    for k, (a, z) in enumerate(zip(starts, starts[1:])):
        f, r = fault[a:z], role[a:z]
        legal = (r[:-1] == 1) & (r[1:] == 2) | (r[:-1] == 2) & (r[1:] == 3) | (r[:-1] == 3) & (r[1:] == 2)
        at_edge = a == 0 or z == len(conv)  # only such a segment can go on in another chunk
        for name, value in (("conv_id", conv[a]), ("chunk", chunk), ("seg", k), ("roles", r.tobytes()), ("faults", f.tobytes()), ("uids", uid[a:z].tobytes()),
                            ("blank", int((f == BLANK).sum())), ("duplicate", int((f == DUPLICATE).sum())), ("truncated", int((f == CUT).sum())),
                            ("illegal", int((~legal).sum())), ("m", matrix(r.tobytes(), f.tobytes()) if at_edge else None)):
            out[name].append(value)
    return pa.table(out, schema=pa.schema([("conv_id", rows.schema.field("conv_id").type), ("chunk", pa.int64()), ("seg", pa.int32()), ("roles", pa.binary()),
                                           ("faults", pa.binary()), ("uids", pa.binary()), ("blank", pa.int64()), ("duplicate", pa.int64()),
                                           ("truncated", pa.int64()), ("illegal", pa.int64()), ("m", pa.list_(pa.int64()))]))


SOLVED = "chunk long, seg int, cost long, exits array<int>, audits array<string>"


def _solve(segments: pa.Table, ends: pa.Table) -> pa.Table:
    """Of one chunk: every segment's least audit for each state in which it may be entered; ``ends`` has the prices after segments of longer conversations."""
    after = {s: (e, first, last) for s, e, first, last in zip(*(ends.column(c).to_pylist() for c in ("seg", "e", "is_first", "is_last")))}
    src, letter, dst, held, base = [], [], [], [], 0
    for chunk, seg, roles, faults in zip(*(segments.column(c).to_pylist() for c in ("chunk", "seg", "roles", "faults"))):
        e, first, last = after.get(seg, (ACCEPT, True, True))
        cost = prices(roles, faults, e)
        for a, x, z in arcs(roles, faults, cost, last):
            src.append(base + a)
            letter.append(ord(x))
            dst.append(base + z)
        held.append((chunk, seg, base, len(roles), cost[0][0], first))
        base += 4 * (len(roles) + 1)
    first_letter, pointers = ranked_paths(base, np.array(src, np.int64), np.array(letter, np.int64), np.array(dst, np.int64))
    out = []
    for chunk, seg, at, n, cost, first in held:
        got = [listed(at + s, first_letter, pointers) for s in range(1 if first else 4)]
        out.append((chunk, seg, cost, [(z - at) - 4 * n for _, z in got], [a for a, _ in got]))
    cols = list(zip(*out)) or [[]] * 5
    return pa.table([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.string())))],
                    names=["chunk", "seg", "cost", "exits", "audits"])


def replayed(roles: bytes, audit: str, state: int):
    """(number of the row or None, new role or None) of each row of the repaired conversation, in order."""
    row = 0
    for x in audit:
        if x == "D":
            row += 1
        elif x == "I":
            state = NEXT[state]
            yield None, NAMES[state]
        else:
            state = roles[row] if x == "K" else NEXT[state]
            yield row, None if x == "K" else NAMES[state]
            row += 1


def _repaired(batches):
    """Rows of the repaired conversations by segment: uid and new role, either may be null."""
    for batch in batches:
        for conv, chunk, roles, uids, audit, state in zip(*(batch.column(i) for i in range(6))):
            at, own = list(replayed(roles.as_py(), audit.as_py(), state.as_py())), np.frombuffer(uids.as_py(), np.int64)
            yield pa.RecordBatch.from_arrays([
                pa.array([conv.as_py()] * len(at), batch.column(0).type), pa.array([chunk.as_py()] * len(at), pa.int64()), pa.array(range(len(at)), pa.int32()),
                pa.array([None if i is None else int(own[i]) for i, _ in at], pa.int64()), pa.array([r for _, r in at], pa.string())],
                names=["conv_id", "chunk", "n", "uid", "new_role"])


def _digests(batches):
    """SHA-256 of each conversation's lines, which arrive in order: a running digest, whatever a conversation's length."""
    conv, running, kind = None, None, None
    for batch in batches:
        done = []
        for c, line in zip(batch.column(0).to_pylist(), batch.column(1)):
            if running is None or c != conv:
                if running is not None:
                    done.append((conv, running.hexdigest()))
                conv, running = c, hashlib.sha256()
            else:
                running.update(b"\n")
            running.update(line.as_buffer())
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], batch.column(0).type), pa.array([d[1] for d in done], pa.string())], names=["conv_id", "repaired_sha256"])
        kind = batch.column(0).type
    if running is not None:
        yield pa.RecordBatch.from_arrays([pa.array([conv], kind), pa.array([running.hexdigest()], pa.string())], names=["conv_id", "repaired_sha256"])


def _product(m: Column, n: Column) -> Column:
    """(min, +) product of two 4 x 4 matrices."""
    return F.transform(F.sequence(F.lit(0), F.lit(15)), lambda e: F.least(
        F.lit(NEVER), *[F.get(m, F.shiftright(e, 2) * 4 + x) + F.get(n, 4 * x + e.bitwiseAND(F.lit(3))) for x in range(4)]))


def _scan(pieces: DataFrame, column: str, combine, backwards: bool, most: int, name: str) -> DataFrame:
    """``pieces`` (conv, k, column) with column combined over all pieces from k on (``backwards``) or up to k, by doubling self-joins."""
    at, reach = staged(pieces.select("conv", "k", column), name), 1
    while reach < most:
        other = at.select("conv", (F.col("k") + (-reach if backwards else reach)).alias("k"), F.col(column).alias("_o"))
        joined = at.join(other, ["conv", "k"], "left")
        both = combine(F.col(column), F.col("_o")) if backwards else combine(F.col("_o"), F.col(column))
        at = staged(joined.select("conv", "k", F.when(F.col("_o").isNull(), F.col(column)).otherwise(both).alias(column)), name)
        reach *= 2
    return at


def _name(conv: str) -> Column:
    """A conversation's name that is never null."""
    return F.coalesce(F.concat(F.lit("s"), F.col(conv).cast("string")), F.lit("n")).alias("_name")


def repair(rows: DataFrame, chunk: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """Cheapest repair of every conversation of ``rows`` (conv_id, turn, role, text).

    Returns (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) per conversation, and the repaired rows:
    (conv_id, chunk, n, role, text), in order by chunk and n.

    Rows stand in order of turn (null turns first; rows of one turn in order of the digest of role and text). A null role or text counts as one
    space, a null conv_id is a conversation of its own, columns besides the four are not read, an empty table gives no rows. Roles that do not begin with s,
    u or a can be retyped or deleted only. No task holds more than ``chunk`` rows of a conversation; only the audit itself is one value.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    rows = staged(rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.monotonically_increasing_id().alias("uid")), "conversations-rows")
    bare = F.rtrim("text", F.lit(WHITE))
    initial = F.substring("role", 1, 1)
    narrow = rows.select("conv_id", "turn", "uid", (bare == "").alias("blank"), (~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("cut"),
                         F.when(initial == "s", 1).when(initial == "u", 2).when(initial == "a", 3).otherwise(0).alias("initial"),
                         F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)).alias("h"))
    placed = numbered(narrow, [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.col("h"), F.col("uid")], "conversations-placed")
    placed = placed.withColumn("chunk", F.floor(F.col("pos") / chunk))
    firsts = placed.groupBy("conv_id", "h").agg(F.min("pos").alias("pos")).select(F.floor(F.col("pos") / chunk).alias("chunk"), "pos")
    kind = placed.schema["conv_id"].dataType
    conv = StructField("conv_id", kind)
    seg_schema = StructType([conv]).simpleString()[7:-1].replace(":", " ") + (
        ", chunk long, seg int, roles binary, faults binary, uids binary, blank long, duplicate long, truncated long, illegal long, m array<long>")
    own = placed.select("chunk", "pos", "conv_id", "uid", "blank", "cut", "initial")
    segments = staged(own.groupBy("chunk").cogroup(firsts.groupBy("chunk")).applyInArrow(_segments, seg_schema), "conversations-segments")

    # conversations in several chunks; a conversation is known by its first chunk, as only one can go on from there
    in_order = Window.partitionBy("conv_id").orderBy("chunk")
    whole = Window.partitionBy("conv_id")
    heads = segments.where("m IS NOT NULL").select(
        "conv_id", "chunk", "seg", "m", (F.row_number().over(in_order) - 1).alias("k"), F.count(F.lit(1)).over(whole).alias("pieces"), F.min("chunk").over(whole).alias("conv"),
        F.lag(F.substring("roles", -1, 1)).over(in_order).alias("before"), F.substring("roles", 1, 1).alias("after"))
    heads = staged(heads.where("pieces > 1"), "conversations-heads")
    most = heads.agg(F.max("pieces")).first()[0] or 0
    suffix = _scan(heads, "m", _product, True, most, "conversations-suffix")
    behind = suffix.select("conv", (F.col("k") - 1).alias("k"), F.col("m").alias("_m"))
    accept = F.array(*[F.lit(x).cast("long") for x in ACCEPT])
    e = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda s: F.least(*[F.get("_m", 4 * s + x) + ACCEPT[x] for x in range(4)]))
    ends = heads.join(behind, ["conv", "k"], "left").select("chunk", "seg", F.when(F.col("_m").isNull(), accept).otherwise(e).alias("e"),
                                                           (F.col("k") == 0).alias("is_first"), (F.col("k") == F.col("pieces") - 1).alias("is_last"))
    solved = staged(segments.select("chunk", "seg", "roles", "faults").groupBy("chunk").cogroup(ends.groupBy("chunk")).applyInArrow(_solve, SOLVED), "conversations-solved")

    # the state in which each segment is entered: what the segments before it make of the first state
    maps = heads.join(solved.select("chunk", "seg", "exits"), ["chunk", "seg"]).select(
        "conv", "k", F.when(F.col("k") == 0, F.array_repeat(F.get("exits", F.lit(0)), 4)).otherwise(F.col("exits")).alias("exits"))
    prefix = _scan(maps, "exits", lambda earlier, later: F.transform(earlier, lambda x: F.get(later, x)), False, most, "conversations-prefix")
    entered = heads.join(prefix.select("conv", (F.col("k") + 1).alias("k"), F.get("exits", F.lit(0)).alias("state")), ["conv", "k"], "left")
    entered = entered.select("chunk", "seg", F.coalesce("state", F.lit(0)).alias("state"), "k", "before", "after")
    met = segments.join(solved, ["chunk", "seg"]).join(entered, ["chunk", "seg"], "left").withColumn("state", F.coalesce("state", F.lit(0)))
    legal = F.concat("before", "after").isin(bytearray(b"\x01\x02"), bytearray(b"\x02\x03"), bytearray(b"\x03\x02"))
    met = met.withColumn("illegal", F.col("illegal") + F.when(F.col("before").isNotNull() & ~legal, 1).otherwise(0))
    met = staged(met.select("conv_id", "chunk", "roles", "uids", F.get("audits", "state").alias("audit"), "state", "k", "cost", "blank", "duplicate", "truncated", "illegal"),
                 "conversations-met")
    turns = placed.groupBy("conv_id", "turn").agg(F.count(F.lit(1)).alias("n")).groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"))
    found = met.groupBy("conv_id").agg(
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")], F.sum(F.when(F.coalesce("k", F.lit(0)) == 0, F.col("cost"))).alias("cost"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("chunk", "audit"))), lambda x: x["audit"]), "").alias("audit"))
    out = found.withColumn("_name", _name("conv_id")).join(turns.select(_name("conv_id"), "gaps"), "_name").drop("_name")

    with arrow_rows(rows.sparkSession, 64):
        made = staged(met.select("conv_id", "chunk", "roles", "uids", "audit", "state").mapInArrow(
            _repaired, StructType([conv]).simpleString()[7:-1].replace(":", " ") + ", chunk long, n int, uid long, new_role string"), "conversations-made")
    kept = made.where("uid IS NOT NULL").join(rows.select("uid", "role", "text"), "uid").select("conv_id", "chunk", "n", F.coalesce("new_role", "role").alias("role"), "text")
    lines = kept.unionByName(made.where("uid IS NULL").select("conv_id", "chunk", "n", F.col("new_role").alias("role"), F.lit("").alias("text")))
    return out, lines


def digests(lines: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of conversations' ``role:text`` lines joined by line feeds. A SHA-256 can only be taken in order, so a conversation's
    lines stream through one task, sorted on disk where they are many; nothing but the running digest is held."""
    conv = StructType([StructField("conv_id", lines.schema["conv_id"].dataType)]).simpleString()[7:-1].replace(":", " ")
    ordered = lines.select("conv_id", "chunk", "n", F.concat("role", F.lit(":"), "text").cast("binary").alias("line")).repartition("conv_id").sortWithinPartitions("conv_id", "chunk", "n")
    with arrow_rows(lines.sparkSession, 512):
        return staged(ordered.select("conv_id", "line").mapInArrow(_digests, f"{conv}, repaired_sha256 string"), "conversations-digests")


def repair_damaged(conversations: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``damage`` and ``repair``: one row per original conv_id, with the digest of its repaired rows. Conversations without rows after damage
    have zeros, an empty audit and the digest of nothing."""
    found, lines = repair(damage(conversations), chunk)
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    out = conversations.select("conv_id").distinct().withColumn("_name", _name("conv_id"))
    out = out.join(found.withColumn("_name", _name("conv_id")).drop("conv_id"), "_name", "left").join(digests(lines).withColumn("_name", _name("conv_id")).drop("conv_id"), "_name", "left")
    return out.select("conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers], F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
