"""Conversation repair against a plain forward DP that carries whole audits."""
import hashlib
import random
import re
import zlib
from collections import Counter

import pytest

from lakewright.llm import conversations as C

WHITE = " \t\n\x0b\f\r"
SCHEMA = "conv_id long, turn long, role string, text string, n string, pos string, chunk string"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        key, role, text = [" " if x is None else str(x) for x in (f"{' ' if conv is None else conv}:{' ' if turn is None else turn}", role, text)]
        kind = zlib.crc32(key.encode()) % 20
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def digest(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()


NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}
LONG = {"u": "user", "a": "assistant"}


def cheapest(rows):
    """rows: (role, text, fault) -> (cost, audit, lines); states by the last initial."""
    at = {"": (0, "", [])}

    def offer(to, state, cost, audit, lines):
        if state not in to or (cost, audit) < to[state][:2]:
            to[state] = (cost, audit, lines)

    def insert(at):
        out = dict(at)
        for _ in range(2):
            for s, (c, a, ls) in list(out.items()):
                offer(out, NEXT[s], c + 2, a + "I", ls + [LONG[NEXT[s]] + ":"])
        return out
    for role, text, fault in rows:
        to = {}
        for s, (c, a, ls) in insert(at).items():
            offer(to, s, c + 3, a + "D", ls)
            if fault not in ("blank", "duplicate"):
                t = fault == "truncated"
                i = role[:1]
                if i == "s" and s == "" or i in LONG and i == NEXT[s]:
                    offer(to, i, c + t, a + "K", ls + [f"{role}:{text}"])
                offer(to, NEXT[s], c + 2 + t, a + "R", ls + [f"{LONG[NEXT[s]]}:{text}"])
        at = to
    return min((v for s, v in insert(at).items() if s in ("", "a")), key=lambda v: v[:2])


def brute(rows):
    convs = {c: [] for c, *_ in rows}
    for c, t, r, x in damaged(rows):
        convs[c].append((t is not None, t or 0, digest(r, x), t, r, x))
    out = []
    for c, own in convs.items():
        own = [x[3:] for x in sorted(own)]
        turns = {t for t, *_ in own if t is not None}
        faults, seen = [], set()
        for _, r, x in own:
            bare = x.rstrip(WHITE)
            faults.append("blank" if not bare else "duplicate" if (r, x) in seen else "truncated" if bare[-1] not in ".!?" else None)
            seen.add((r, x))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit, lines = cheapest([(r, x, f) for (_, r, x), f in zip(own, faults)])
        assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in lines))
        n = Counter(faults)
        out.append((c, max(turns) - min(turns) + 1 - len(turns) if turns else 0, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return Counter(out)


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def random_rows(seed, convs, longest):
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        for t in range(rng.randint(1, longest)):
            rows.append((c, t * rng.choice((1, 1, 1, 2)) if rng.random() < 0.95 else None, rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "User", "", None]),
                         rng.choice(["Yes.", "No", " \t", "", None, "What? ", "ok!\n", f"line {rng.randint(0, 9)}.", "née…", "a\x1c"])))
    return rows


@pytest.mark.parametrize("chunk", [4096, 5])
def test_random_conversations(spark, chunk):
    rows = random_rows(chunk, 60, 14)
    rows += [(None, t, "user" if t % 2 else "system", f"x{t}.") for t in range(9)] + [(1, 3, "user", "Yes."), (1, 3, "user", "Yes.")]
    # one conversation holds a third of the rows, the turns of one repeat, most texts of another are one text
    rows += [(999, t, "user" if t % 3 else "assistant", f"t{t}" + "." * (t % 4 > 0)) for t in range(200)] + [(998, t // 3, "user", f"{t}.") for t in range(30)]
    rows += [(997, t, "assistant", "same." if t % 5 else f"s{t}.") for t in range(60)]
    frame = spark.createDataFrame([(*r, "a", "b", "c") for r in rows], SCHEMA).repartition(4)
    got = Counter(tuple(r) for r in C.repair_damaged(frame, chunk).select(*COLUMNS).collect())
    assert got == brute(rows)


def test_no_rows(spark):
    assert C.repair_damaged(spark.createDataFrame([], SCHEMA)).count() == 0
    gone = next(t for t in range(1000) if zlib.crc32(f"7:{t}".encode()) % 20 == 0)
    got = C.repair_damaged(spark.createDataFrame([(7, gone, "user", "x.", "", "", "")], SCHEMA)).select(*COLUMNS).collect()
    assert [tuple(r) for r in got] == [(7, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_long_text_and_whole_rows(spark):
    rows = [(5, 0, "user", "word " * 400_000 + "end."), (5, 1, "assistant", "é" * 300_000), (6, 0, "assistant", "Alone.")]
    got = Counter(tuple(r) for r in C.repair_damaged(spark.createDataFrame([(*r, "", "", "") for r in rows], SCHEMA)).select(*COLUMNS).collect())
    assert got == brute(rows)
    _, lines = C.repair(spark.createDataFrame([(1, 0, "assistant", "Hello.")], "conv_id long, turn long, role string, text string"))
    assert [(r.role, r.text) for r in lines.orderBy("chunk", "n").collect()] in ([("user", ""), ("assistant", "Hello.")], [])
