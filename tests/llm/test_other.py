"""Top-k search, archives, the classifier and the pipeline."""
import hashlib
import struct
from collections import Counter

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

import brute
from rows import awkward, nothing  # noqa: F401
SF001 = "/root/testdata/sf0.001"

VECTORS = "vec_id long, embedding array<float>, label int, uid string, norm string"


def test_top_k(spark):
    from lakewright.llm.topk import top_k
    rng = np.random.default_rng(0)
    rows = [(i, [float(x) for x in rng.normal(0, 1 + i % 5, 8)]) for i in range(160)]
    rows += [(i, [1.0] * 8) for i in range(160, 200)]  # ties
    rows += [(200, [0.0] * 8), (201, None), (202, [1.0, None] * 4), (203, [float("nan")] * 8), (204, [float("inf")] * 8), (None, [1.0] * 8),
             (0, [2.0] * 8), (206, [5.0, 5.0]), (220, [1.0, 2.0]), (207, []), (240, [])]
    frame = spark.createDataFrame([(i, v, 0, "x", "y") for i, v in rows], VECTORS).repartition(3)
    for k in (5, 20, 500):
        got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in top_k(frame, k=k).collect())
        assert got == brute.top_k(rows, 20, k)
    assert top_k(spark.createDataFrame([], VECTORS)).count() == 0


def test_top_k_prunes_exactly():
    """Both prunings are used and lose nothing."""
    from lakewright.llm.topk import Bucket, Search
    rng = np.random.default_rng(1)
    base = rng.normal(0, 1, (40, 32))
    base *= 1000 / np.sqrt((base * base).sum(1))[:, None]
    cloud = np.concatenate([base + rng.normal(0, 5, base.shape) for _ in range(30)] + [rng.normal(0, 30, (800, 32))]).round().astype("<i8")
    order = np.argsort(-np.sqrt((cloud.astype(float) ** 2).sum(1)))
    ids = np.arange(len(cloud), dtype="<i8")

    def bucket(rows):
        return Bucket(32, ids[rows].tobytes(), ids[rows].tobytes(), cloud[rows].tobytes())
    asked = np.arange(0, len(cloud), 7)
    s = Search(bucket(asked), 3)
    for at in range(0, len(order), 200):
        s.visit(bucket(order[at:at + 200]))
    assert s.used["skipped"] > 0 and s.used["length"] > 0 and s.used["coordinate"] > 0
    q, _, _, v, score = s.result()
    products = cloud @ cloud.T
    for i in asked:
        want = sorted((-int(products[i, j]), j) for j in range(len(cloud)) if j != i)[:3]
        mine = q == i
        assert [(-int(a), int(b)) for a, b in zip(score[mine], v[mine])] == want


PAGES = "page_id long, url string, html string, digest string, path string"


def test_archives_round_trip(spark):
    from lakewright.llm.warc import read_archives, resolved, write_archives
    long = "ü" * 600
    rows = [(1, "http://a/", long), (2, "http://b/", long), (3, "http://c/\r\nX: y", "short"), (4, None, "short"), (5, "u", None), (6, "u", ""),
            (7, "u", long + "x"), (7, "u", long + "x"), (None, "u", long), (None, "u", "y" * 2000), (None, "u", "y" * 2000), (8, "u", "\r\n\r\nWARC/1.1\r\n" * 90)]
    rows += [(100 + i, "http://d/%d" % i, "<p>page %d</p>" % i * 50) for i in range(40)]
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], PAGES).repartition(3)
    manifest = write_archives(frame, archive_bytes=3000)
    assert manifest.count() > 3
    records = read_archives(manifest)
    best = {}
    for p, _, h in rows:
        b = (h or "").encode()
        if len(b) >= 1000 and p is not None:
            best[b] = max(best.get(b, p), p)
    want = Counter()
    for p, _, h in rows:
        b = (h or "").encode()
        to = best.get(b)
        revisit = to is not None and p != to
        want[(p, len(b), hashlib.sha1(b).hexdigest(), "revisit" if revisit else "response", to if revisit else None, None if revisit else b)] += 1
    got = records.collect()
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in got) == want
    assert {r.url for r in got if r.page_id == 3} == {"http://c/%0D%0AX:%20y"}
    assert resolved(records).where("NOT verified").count() == 0
    empty = write_archives(spark.createDataFrame([], PAGES))
    assert empty.count() == 0 and read_archives(empty).count() == 0


def _archive(frames, shared=b"", packed=True):
    out = b""
    if shared:
        body = zstandard.ZstdCompressor().compress(shared) if packed else shared
        out = struct.pack("<II", 0x184D2A5D, len(body)) + body
    z = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(shared) if shared else None)
    return out + b"".join(z.compress(f) for f in frames)


@pytest.mark.parametrize("packed", [True, False])
@pytest.mark.parametrize("step", [1, 7, 1 << 16])
def test_frames_with_dictionary(packed, step):
    import io

    from lakewright.llm.warc import dictionary, frames, record_bytes
    shared = dictionary([b"<html><p>number %d of many</p></html>" % i * 3 for i in range(500)], 2048)
    assert shared
    own = [record_bytes("response", i, None, "u", b"<html><p>number %d</p>" % i, "0" * 40) for i in range(20)]
    assert list(frames(io.BytesIO(_archive(own, shared, packed)), step)) == own
    assert list(frames(io.BytesIO(_archive(own)), step)) == own
    assert list(frames(io.BytesIO(b""), step)) == []


def test_faulty_archives_are_refused():
    import io

    from lakewright.llm.warc import WarcError, frames, read_record, record_bytes
    payload = b"hello"
    good = record_bytes("response", 1, None, "u", payload, hashlib.sha1(payload).hexdigest())
    assert read_record(good)[4:] == (5, hashlib.sha1(payload).hexdigest(), payload)
    for bad in (good.replace(b"WARC/1.1", b"WARK/1.1"), good[:-1], good + b"x", good + good, good.replace(b"hello", b"jello"),
                good.replace(b"WARC-Type", b"Warc-Kind"), good.replace(b"Content-Length: 5\r\n", b"Content-Length: 6\r\n"),
                good.replace(b"WARC-Date: ", b"WARC-Date "), good.replace(b"response\r\n", b"resource\r\n", 1),
                good.replace(b"<urn:page:1>", b"<urn:uuid:1>")):
        with pytest.raises(WarcError):
            read_record(bad)
    for raw in (_archive([good])[:-3], b"not zstandard at all", struct.pack("<II", 0x184D2A5D, 99) + b"x", struct.pack("<I", 0x184D2A5D)):
        with pytest.raises(WarcError):
            list(frames(io.BytesIO(raw)))


def test_classifier(spark, awkward, nothing):
    from lakewright.llm.quality import classify, fit, keep_good, predict
    docs, labels = (spark.read.parquet(f"{SF001}/{t}.parquet") for t in ("documents", "labels"))
    out = classify(docs, labels)
    got = out.join(labels, "doc_id").collect()
    assert out.count() == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    good, bad = ([r.score for r in got if r.quality == q] for q in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.9
    assert Counter(out.collect()) == Counter(classify(docs, labels).collect())
    # held-out labels are never learned from
    turned = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert Counter(classify(docs, turned).collect()) == Counter(out.collect())
    none = labels.limit(0)
    assert {r.score for r in classify(awkward, none).collect()} == {0.5}
    assert classify(awkward, labels).count() == awkward.count() and classify(nothing, labels).count() == 0
    assert keep_good(awkward, labels).columns == awkward.columns
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(2, 1, (700, 3)), rng.normal(-2, 1, (300, 3))])
    model = fit(rng.normal(2, 1, (500, 3)), x, 0.7)
    p = predict(model, x)
    assert (p[:700] > 0.5).mean() > 0.95 and (p[700:] < 0.5).mean() > 0.95


def test_spread_lookup_of_a_hot_key(spark, monkeypatch):
    from lakewright.llm import common
    left = common.staged(spark.range(6000).select("id", F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 1000 == 1, None).otherwise(F.col("id")).alias("k")), "test")
    right = common.staged(spark.range(0, 4000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v")), "test")
    got = {r.id: r.v for r in common.spread_lookup(left, right, "k").collect()}
    assert len(got) == 6000
    assert all(got[r.id] == (None if r.k is None or r.k >= 4000 else r.k * 2) for r in left.collect())


def test_pipeline(spark):
    import corpus_pipeline as P

    from lakewright.llm.quality import classify
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    at, held = docs, {}
    for name, stage in P.STAGES[:-1]:
        at = stage(spark, at, SF001)
        assert at.columns == docs.columns and at.dtypes == docs.dtypes
        at = held[name] = P.staged(at, f"test-{name}")
    rejected = {r.doc_id for r in classify(docs, labels).where("predicted = 0").collect()}
    assert {r.doc_id for r in held["quality_filter"].collect()} == {r.doc_id for r in docs.collect()} - rejected
    before = sorted((r.doc_id, r.text) for r in held["quality_filter"].collect())
    lines = sorted((r.doc_id, r.text) for r in held["line_dedup"].collect())
    # every line that goes is one that edit similarity alone would drop, and nine in ten of those go
    want = brute.dedup_lines(before)
    kept = [sum((Counter(t.split("\n")) for t in texts), Counter()) for texts in ([t for _, t in before], want, [t for _, t in lines])]
    gone, found = kept[0] - kept[1], kept[0] - kept[2]
    assert not found - gone and sum(found.values()) >= 0.9 * sum(gone.values()) > 0
    prints = {d: brute.simhash(t) for d, t in lines}
    u = brute.components(prints.values(), brute.near)
    first = {}
    for d in sorted(prints):
        first.setdefault(u.find(prints[d]), d)
    assert sorted(r.doc_id for r in held["near_dedup"].collect()) == sorted(first.values())
    mixed = Counter(r.doc_id for r in held["source_mix"].collect())
    assert set(mixed) <= set(first.values()) and max(mixed.values()) <= 3
    packed = P.run(spark, SF001).collect()
    assert Counter(r.doc_id for r in packed if r.piece == 0) == mixed
