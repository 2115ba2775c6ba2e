"""The manifest and its proofs against plain Python."""
import hashlib
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rows import awkward, nothing  # noqa: F401

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf_of(values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(nodes):
    """The root over ``nodes`` and, for each node, its siblings level by level as (left, right) texts."""
    ways = [[] for _ in nodes]
    at = list(nodes)
    span = 1
    while len(at) > 1:
        runs = [at[i:i + 8] for i in range(0, len(at), 8)]
        for n, way in enumerate(ways):
            i = n // span
            run, k = runs[i // 8], i % 8
            way.append(("".join(run[:k]), "".join(run[k + 1:])))
        at = [sha("".join(r)) for r in runs]
        span *= 8
    return at[0], ways


def brute(rows):
    """rows: dicts of FIELDS -> the contract's rows."""
    by = {}
    for r in rows:
        by.setdefault(r["lang"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, leaf_of([r[f] for f in FIELDS]), r))
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    trees = {x: climb([leaf for *_, leaf, _ in sorted(by[x], key=lambda t: t[:3])]) for x in langs}
    root, above = climb([trees[x][0] for x in langs]) if langs else (None, [])
    out = []
    for x, over in zip(langs, above):
        for (*_, leaf, r), way in zip(sorted(by[x], key=lambda t: t[:3]), trees[x][1]):
            way = way + over
            at = leaf
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0 and r["text"] is not None:
                low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r["text"])
                at = leaf_of([low if f == "text" else r[f] for f in FIELDS])
            for left, right in way:
                at = sha(left + at + right)
            out.append((r["doc_id"], leaf, trees[x][0], root, sha("".join(a + b for a, b in way)), at, at == root))
    return Counter(out)


def same(frame):
    from lakewright.llm.merkle import tampered_third
    rows = [r.asDict() for r in frame.collect()]
    got = Counter(tuple(r) for r in tampered_third(frame).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect())
    assert got == brute(rows)
    return got


def test_awkward_rows(awkward, nothing):
    got = same(awkward)
    assert any(not r[-1] for r in got)
    assert not same(nothing)
    same(awkward.where("doc_id = 1"))  # one leaf is subroot and root


@pytest.mark.parametrize("langs, each", [(1, 1), (1, 8), (1, 9), (1, 600), (3, 65), (70, 3)])
def test_shapes(spark, langs, each, monkeypatch):
    """Trees of many shapes; a third of the documents in one more language, most ancestors met in shuffles."""
    from lakewright.llm import merkle
    monkeypatch.setattr(merkle, "HOT", 4)
    rows = [(n * 7 % 1000003, f"Text {n}", None if n % langs == 0 else f"l{n % langs}é", "s", n) for n in range(langs * each)]
    rows += [(10 ** 7 + n, "Same", "zz", None, None) for n in range(langs * each // 2)]
    same(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5))


def test_changed_field_is_noticed(awkward):
    from lakewright.llm.merkle import verify
    got = verify(awkward, {"source": F.lit("elsewhere")}, F.col("doc_id") == 10).collect()
    assert all(r.verified == (r.doc_id != 10) for r in got)
