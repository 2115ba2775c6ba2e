"""Operators on documents against plain Python, over awkward rows and an empty table."""
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import brute
from rows import awkward, nothing  # noqa: F401

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def rows_of(df):
    return [(r["doc_id"], r["text"], r["source"]) for r in df.collect()]


def test_packing_round_trip(spark, awkward, nothing):
    from tokenizers import Tokenizer

    from lakewright.llm.packing import pack
    t = Tokenizer.from_file(TOKENIZER)
    for capacity in (2048, 64):
        got = pack(awkward, TOKENIZER, capacity=capacity).collect()
        want = Counter()
        for d, text, _ in rows_of(awkward):
            ids = t.encode(text or "", add_special_tokens=False).ids + [0]
            for p, at in enumerate(range(0, len(ids), capacity)):
                own = ids[at:at + capacity]
                want[(d, p, at, len(own), zlib.crc32(np.array(own, "<u4").tobytes()))] += 1
        assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
        for _, own in brute.group_by(got, lambda r: r.sequence_id).items():
            at = 0
            for r in sorted(own, key=lambda r: r.offset):
                assert r.offset == at
                at += r.length
            assert at <= capacity and all(r.fill == at for r in own)
    assert pack(nothing, TOKENIZER).count() == 0


def test_encoder_equals_tokenizer():
    from tokenizers import Tokenizer

    from lakewright.llm.packing import WordEncoder
    t, e = Tokenizer.from_file(TOKENIZER), WordEncoder(TOKENIZER)
    for s in ["It's we'll I'VE they'd 'tis ''s x's's", "áé Å µªº ÀÖØöøÿß STRASSE İ ǅ Σς", "12.5% a1b2 <|startoftext|>x <|endof text|>",
              "  ​　|\x1c\x85\x0b", "#$%&*@ ... !!??", "", "   "]:
        assert np.frombuffer(e(s), "<u4").tolist() == t.encode(s, add_special_tokens=False).ids, s


def test_local_search_never_needs_more_bins():
    from lakewright.llm.packing import best_fit, local_search
    rng = np.random.default_rng(0)
    for _ in range(20):
        lengths = rng.integers(1, 101, 300).tolist()
        bins = best_fit(lengths, 100)
        better = local_search(lengths, bins, 100, underfull=1.0)
        assert sorted(i for b in better for i in b) == list(range(300))
        assert all(sum(lengths[i] for i in b) <= 100 for b in better)
        assert len(better) <= len(bins)
        assert sum(sum(lengths[i] for i in b) ** 2 for b in better) >= sum(sum(lengths[i] for i in b) ** 2 for b in bins)
    # one-for-one and two-for-one exchanges empty a bin that best fit leaves
    assert len(local_search([6, 6, 4, 3, 3, 2, 2], [[0, 3], [1, 4], [2, 5, 6]], 13)) <= 3
    assert len(local_search([7, 5, 5, 3], [[0, 3], [1], [2]], 10)) == 2


def test_simhash_groups(spark, awkward, nothing):
    from lakewright.llm.simhash import fingerprint, keep_one, near_duplicates
    rows = rows_of(awkward)
    prints = [brute.simhash(t) for _, t, _ in rows]
    assert [fingerprint(None if t is None else t.encode()) for _, t, _ in rows] == prints
    u = brute.components(prints, brute.near)
    low = {}
    for (d, _, _), p in zip(rows, prints):
        r = u.find(p)
        low[r] = min((x for x in (low.get(r), d) if x is not None), default=None)
    want = Counter((d, p, low[u.find(p)]) for (d, _, _), p in zip(rows, prints))
    got = near_duplicates(awkward).collect()
    assert Counter((r.doc_id, r.fp % 2 ** 64, r.component_id) for r in got) == want
    kept = keep_one(awkward)
    assert kept.columns == awkward.columns
    kept = [(r["doc_id"], brute.simhash(r["text"])) for r in kept.collect()]
    assert len(kept) == len({u.find(p) for p in prints}) == len({u.find(p) for _, p in kept})
    assert all(d == low[u.find(p)] for d, p in kept)
    assert near_duplicates(nothing).count() == 0


@pytest.mark.parametrize("split", [False, True])
def test_simhash_links_lose_nothing(spark, monkeypatch, split):
    """Dense clusters and random fingerprints: the links' components are those of all pairs."""
    from lakewright.llm import simhash
    from lakewright.llm.common import components, staged
    if split:  # every bucket of more than 4 rows goes the forest way, hot values go to blocks
        monkeypatch.setattr(simhash, "CHUNK", 64)
        monkeypatch.setattr(simhash, "BLOCK", 8)
    rng = np.random.default_rng(3)
    fps = set(rng.integers(0, 2 ** 63, 150).tolist())
    for c in rng.integers(0, 2 ** 63, 6).tolist():
        for _ in range(60):
            x = c
            for b in rng.integers(0, 63, rng.integers(0, 4)).tolist():
                x ^= 1 << b
            fps.add(x)
    chain = int(rng.integers(0, 2 ** 60))
    for k in range(0, 60, 3):  # a chain whose ends are far apart
        chain ^= 7 << k
        fps.add(chain)
    frame = staged(spark.createDataFrame([(x,) for x in fps], "fp long"), "test-fps")
    edges = [(r.a, r.b) for r in simhash.links(frame).collect()]
    assert all(a != b and brute.near(a, b) for a, b in edges)
    want = brute.components(fps, brute.near)
    got = brute.Union()
    for a, b in edges:
        got.join(a, b)
    assert all(got.find(x) == want.find(x) for x in fps)
    roots = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long"), "test").collect()}
    assert all(roots.get(x, x) == want.find(x) for x in fps)


def test_thresholds_hold_the_pigeonhole():
    from lakewright.llm.simhash import bit_groups, candidate_estimates, thresholds, values
    rng = np.random.default_rng(1)
    fps = rng.integers(0, 2 ** 62, 500)
    bits = np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.int64)
    groups = bit_groups(bits.T @ bits, 500)
    assert sorted(b for g in groups for b in g) == list(range(64))
    own = [values(fps, g) & 0xFFFF for g in groups]
    est = [candidate_estimates(np.bincount(v, minlength=1 << 16).astype(float), len(g), 3) for v, g in zip(own, groups)]
    t = thresholds(own, [len(g) for g in groups], est)
    assert (t >= -1).all() and ((t + 1).sum(0) == 4).all()


def test_exact_duplicates(spark, awkward, nothing):
    from lakewright.llm.exact import exact_duplicates
    rows = rows_of(awkward)
    groups = brute.group_by(rows, lambda r: r[1] or "")
    for size in ({}, {"max_cells": 512, "cells_per_row": 1}):  # a saturated filter changes nothing
        got = exact_duplicates(awkward, **size).collect()
        assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == Counter(
            (d, max((x[0] for x in g if x[0] is not None), default=None), len(g), brute.sha(t.encode())) for t, g in groups.items() for d, _, _ in g)
        assert Counter(r.text_sha256 for r in got if r.kept) == Counter(brute.sha(t.encode()) for t in groups)
        assert all(r.doc_id == r.keep_id for r in got if r.kept)
    assert exact_duplicates(nothing).count() == 0
    folded = exact_duplicates(awkward, normalise=lambda c: F.regexp_replace(c, " +", " ")).where("doc_id = 3").first()
    assert folded.group_size == 4


def test_mixing(spark, awkward, nothing):
    from lakewright.llm.mixing import mix, repeat
    rows = rows_of(awkward)
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len((t or "").translate({i: " " for i in range(9, 14)}).split(" ")) - (t or "").translate({i: " " for i in range(9, 14)}).split(" ").count("")
    want = brute.targets(sizes)
    got = mix(awkward).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert r.taken in (r.size * int(r.rate), r.size * (int(r.rate) + 1)) and r.taken <= 3 * r.size
    assert sum(want.values()) == pytest.approx(sum(sizes.values()))
    assert Counter(mix(awkward).collect()) == Counter(got)
    again = Counter((r["doc_id"], r["text"]) for r in repeat(awkward).collect())
    assert sum(again.values()) == sum(r.copies for r in got) and repeat(awkward).columns == awkward.columns
    assert mix(nothing).count() == 0 and repeat(nothing).count() == 0


def test_secret_ledger(spark, awkward, nothing, tmp_path):
    from lakewright.llm.secrets import RULES, Rule, digest, scan, update_ledger
    rows = rows_of(awkward)
    got = digest(scan(spark, awkward)).collect()
    assert Counter((r.doc_id, r.spans, r.base_sha256) for r in got) == Counter((d, brute.secrets(t), brute.sha(brute.secrets(t).encode())) for d, t, _ in rows)
    ledger = str(tmp_path / "ledger")
    digest(scan(spark, awkward, ledger)).count()
    old = spark.read.parquet(ledger)
    assert update_ledger(spark, awkward, old).count() == 0
    blobs = len({t or "" for _, t, _ in rows})
    newer = (*RULES[:2], Rule("hex", 2, "[0-9a-f]+", 0, 20))
    assert [r.rule_version for r in update_ledger(spark, awkward, old, newer).select("rule_version").distinct().collect()] == [2]
    more = awkward.select("doc_id", "text").unionByName(spark.createDataFrame([(99, "token=abcdefghijkl1")], "doc_id long, text string"))
    found = {r.doc_id: r.spans for r in digest(scan(spark, more, ledger)).collect()}
    assert found[99] == "assign:0:19" and found[15] == brute.secrets(next(t for d, t, _ in rows if d == 15))
    assert spark.read.parquet(ledger).count() == 3 * (blobs + 1)
    assert scan(spark, nothing).count() == 0


@pytest.mark.parametrize("memory", [1 << 28, 2000])
def test_substring_dedup(spark, awkward, nothing, memory):
    from lakewright.llm.suffix import dedup_substrings
    small = awkward.where("doc_id IS NULL OR doc_id <> 17") if memory < 1 << 20 else awkward
    rows = sorted(rows_of(small), key=lambda r: (r[0] is None, r[0] or 0))
    for length in (100, 40):
        kept = brute.repeated_bytes([(t or "").encode() for _, t, _ in rows], length)
        got = dedup_substrings(small, length=length, memory=memory).collect()
        alone = Counter(r[0] for r in rows)
        want = {(d, len((t or "").encode()), len((t or "").encode()) - len(k), n, brute.sha(k)) for (d, t, _), (k, n) in zip(rows, kept) if alone[d] == 1}
        assert {(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got if alone[r.doc_id] == 1} == want
        assert sum(r.n_removed for r in got) == sum(len((t or "").encode()) - len(k) for (_, t, _), (k, _) in zip(rows, kept))
    assert dedup_substrings(nothing).count() == 0


def test_only_repeated_anchors_give_segments(spark, monkeypatch):
    """However many anchors there are, those that occur once give no segment; parts and rounds of keys of any size give the same."""
    import random

    from lakewright.llm import exact, suffix
    own = random.Random(3)
    texts = ["".join(own.choice("abcdefghij ") for _ in range(600)) for _ in range(150)]
    texts[7] = texts[3][:200] + texts[7] + texts[9][100:260]
    texts[8] = texts[8][:300] + texts[8][100:300]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    # a filter that is as full as that of a large table
    monkeypatch.setattr(suffix, "repeat_filter", lambda h, n: exact.repeat_filter(h, n, max_cells=512), raising=False)
    rows, staged = {}, suffix.staged

    def counted(df, name):
        out = staged(df, name)
        rows[name] = out.count()
        return out
    monkeypatch.setattr(suffix, "staged", counted)
    kept = [k for k, _ in brute.repeated_bytes([t.encode() for t in texts], 100)]
    assert sum(map(len, kept)) < sum(map(len, texts))

    def same(**sizes):
        got = {r.doc_id: bytes(r.kept) for r in suffix.dedup_substrings(docs, **sizes).collect()}
        assert [got[d] for d in range(len(texts))] == kept
    same()
    assert 0 < rows["suffix-segments"] <= 60
    monkeypatch.setattr(suffix, "HELD_KEYS", 40)
    same(part_keys=100)
    assert 0 < rows["suffix-segments"] <= 60
