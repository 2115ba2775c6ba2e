"""SimHash near-dedup with a generalised pigeonhole search.

1. Every document gets a 64-bit SimHash of its word shingles. Equal fingerprints merge (map-side first).
2. Bits that vary together are grouped into ``parts`` partitions: the 64 x 64 co-occurrence counts of all
   distinct fingerprints are summed, and groups grow greedily around the most correlated bits.
3. Two fingerprints at most ``bits`` bits apart agree, in some partition i, to within t_i bits whenever the
   t_i + 1 sum to bits + 1 (t_i = -1 leaves a partition out). Per fingerprint, dynamic programming picks the
   thresholds with the fewest estimated candidates plus probes, from value counts of every partition.
4. Each fingerprint is filed under its value in every partition and probes all values within t_i. Filed rows and
   probes meet per value; real distances are verified there, and a bucket hands on a spanning forest of
   its links, never all pairs. Values that hold a large share of all rows are split into blocks.
5. Connected components over the links; documents look theirs up by fingerprint.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakewright.llm.common import components, spread_lookup, staged

SHINGLE = 3
BITS = 3
PARTS = 3
#: Values are counted by this many leading bits of a partition; the others are taken as even.
COUNTED = 16
#: A probe costs as much as this many candidate comparisons.
PROBE_COST = 8.0
#: Rows of one block of a split value; a value is split if it holds 1/256 of all fingerprints and more than this.
BLOCK = 4096
#: Distances computed at once.
CHUNK = 1 << 21


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """Unsigned SimHash of a text: ASCII lower case, words between ASCII white space, XXH64 with seed 42."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(64, np.int64)
    step = 1 << 16
    for at in range(0, n, step):
        part = words[at:at + step + shingle - 1]
        own = [b" ".join(part)] if n == 1 else map(b" ".join, zip(*(part[i:] for i in range(shingle))))
        h = np.array([xxhash.xxh64_intdigest(s, 42) for s in own], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprint_column(text: Column, shingle: int = SHINGLE) -> Column:
    """The SimHash of a text column as a (signed) long."""
    @F.pandas_udf("long")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64))
    return run(F.coalesce(text, F.lit("")).cast("binary"))


def _together(batches):
    """Per bit, how often each of the 64 bits is set along with it."""
    total = np.zeros((64, 64), np.int64)
    for batch in batches:
        f = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        bits = np.unpackbits(f.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
        total += (bits.T @ bits).astype(np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(range(64), pa.int32()), pa.array([r.tobytes() for r in total], pa.binary())],
                                     names=["bit", "counts"])


def _sum_counts(rows: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x, np.int64) for x in rows.column("counts").to_pylist())
    return pa.table({"bit": rows.column("bit")[:1].cast(pa.int32()), "counts": pa.array([total.tobytes()], pa.binary())})


def bit_groups(together: np.ndarray, n: int, parts: int = PARTS) -> list[list[int]]:
    """Bits 0-63 in ``parts`` groups of about equal size, correlated bits together."""
    p = np.diag(together) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs((together / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(corr, 0)
    left, groups = list(range(64)), []
    for g in range(parts):
        size = 64 // parts + (g < 64 % parts)
        own = [max(left, key=lambda b: (corr[b, left].sum(), -b))]
        left.remove(own[0])
        while len(own) < size:
            nxt = max(left, key=lambda b: (corr[b, own].sum(), -b))
            own.append(nxt)
            left.remove(nxt)
        groups.append(own)
    return groups


def values(fps: np.ndarray, bits: list[int]) -> np.ndarray:
    """The bits of a partition, packed in the order given."""
    out = np.zeros(len(fps), np.int64)
    f = fps.view(np.uint64)
    for j, b in enumerate(bits):
        out |= (((f >> np.uint64(b)) & np.uint64(1)) << np.uint64(j)).astype(np.int64)
    return out


def candidate_estimates(histogram: np.ndarray, size: int, most: int) -> np.ndarray:
    """est[t, v]: fingerprints expected within t bits of a partition value whose counted bits are v."""
    counted = min(COUNTED, size)
    at = np.arange(1 << counted)
    shells = [histogram.astype(np.float64)] + [np.zeros(1 << counted) for _ in range(most)]
    for b in range(counted):  # shells[k]: counts over all ways to flip k of the bits so far
        for k in range(most, 0, -1):
            shells[k] = shells[k] + shells[k - 1][at ^ (1 << b)]
    rest = size - counted
    return np.array([sum(shells[s] * sum(comb(rest, x) for x in range(t - s + 1)) / 2.0 ** rest for s in range(t + 1))
                     for t in range(most + 1)], np.float32)


def thresholds(counted: list[np.ndarray], sizes: list[int], estimates: list[np.ndarray], bits: int = BITS) -> np.ndarray:
    """Per fingerprint and partition the threshold t_i >= -1, all t_i + 1 summing to bits + 1, of least cost."""
    n, budget = len(counted[0]), bits + 1
    best = np.full((budget + 1, n), np.inf)
    best[0] = 0
    picks = []
    for v, size, est in zip(counted, sizes, estimates):
        new, pick = np.full((budget + 1, n), np.inf), np.zeros((budget + 1, n), np.int8)
        for used in range(budget + 1):
            for a in range(used + 1):
                cost = best[used - a] + (est[a - 1][v] + PROBE_COST * sum(comb(size, x) for x in range(a)) if a else 0)
                better = cost < new[used]
                new[used][better], pick[used][better] = cost[better], a
        best = new
        picks.append(pick)
    out, left = np.zeros((len(sizes), n), np.int8), np.full(n, budget)
    for i in range(len(sizes) - 1, -1, -1):
        out[i] = picks[i][left, np.arange(n)]
        left = left - out[i]
    return out - 1


def _masks(size: int, t: int) -> np.ndarray:
    return np.array([sum(1 << b for b in c) for k in range(t + 1) for c in combinations(range(size), k)], np.int64)


def _file_and_probe(groups, estimates, hot, bits: int):
    sizes = [len(g) for g in groups]
    hot_keys = np.array(sorted(hot), np.int64)
    hot_blocks = np.array([hot[k] for k in sorted(hot)], np.int64)

    def blocks(keys):
        out = np.ones(len(keys), np.int64)
        if len(hot_keys):
            at = np.minimum(np.searchsorted(hot_keys, keys), len(hot_keys) - 1)
            out = np.where(hot_keys[at] == keys, hot_blocks[at], 1)
        return out

    def rows(keys, fps, probe):
        n = blocks(keys)
        if probe:  # a probe visits every block of its value
            idx = np.repeat(np.arange(len(keys)), n)
            block = np.arange(len(idx)) - np.repeat(np.cumsum(n) - n, n)
            keys, fps = keys[idx], fps[idx]
        else:
            mixed = (fps.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
            block = mixed.astype(np.int64) % n
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(block.astype(np.int32)), pa.array(fps),
                                           pa.array(np.full(len(keys), probe, np.int8))], names=["key", "block", "fp", "probe"])

    def run(batches):
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            own = [values(fps, g) for g in groups]
            ts = thresholds([v & ((1 << min(COUNTED, s)) - 1) for v, s in zip(own, sizes)], sizes, estimates, bits)
            for i, v in enumerate(own):
                yield rows(v | (i << 40), fps, 0)
                for t in range(bits + 1):
                    sel = ts[i] == t
                    if sel.any():
                        masks = _masks(sizes[i], t)
                        some = max(1, (1 << 20) // len(masks))
                        picked_v, picked_f = v[sel], fps[sel]
                        for at in range(0, len(picked_v), some):
                            near = (picked_v[at:at + some, None] ^ masks[None, :]).ravel()
                            yield rows(near | (i << 40), np.repeat(picked_f[at:at + some], len(masks)), 1)
    return run


def _forest(filed: np.ndarray, probes: np.ndarray, bits: int):
    """Links of a large bucket: each probe is tied to one member of every component it touches."""
    label = np.arange(len(filed))
    step = max(1, CHUNK // len(filed))
    for at in range(0, len(probes), step):
        near = np.bitwise_count(probes[at:at + step, None] ^ filed[None, :]) <= bits
        for r in np.flatnonzero(near.any(1)):
            tied, first = np.unique(label[near[r]], return_index=True)
            for x in np.flatnonzero(near[r])[first]:
                yield probes[at + r], filed[x]
            if len(tied) > 1:
                label[np.isin(label, tied[1:])] = tied[0]


def _links(bits: int):
    def found(key, block, fp, probe):
        """Complete groups, in order of key, block, probe."""
        new = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (block[1:] != block[:-1])])
        size = np.diff(np.r_[new, len(key)])
        filed = np.add.reduceat((probe == 0).astype(np.int64), new)
        work = filed * (size - filed)
        a, b = [], []
        small = (work > 0) & (work <= CHUNK // 8)
        pick = np.flatnonzero(small)
        done = np.cumsum(work[pick])
        for part in np.split(pick, np.searchsorted(done, np.arange(CHUNK, done[-1] if len(done) else 0, CHUNK))):
            if len(part):  # every probe of these buckets against every filed row
                per = size[part] - filed[part]
                row = np.repeat(new[part] + filed[part], per) + np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
                nd = np.repeat(filed[part], per)
                left = np.repeat(row, nd)
                right = np.repeat(np.repeat(new[part], per), nd) + np.arange(nd.sum()) - np.repeat(np.cumsum(nd) - nd, nd)
                x, y = fp[left], fp[right]
                ok = (np.bitwise_count(x ^ y) <= bits) & (x != y)
                a.append(x[ok]), b.append(y[ok])
        for g in np.flatnonzero((work > 0) & ~small):
            own = fp[new[g]:new[g] + size[g]]
            pairs = np.array([p for p in _forest(own[:filed[g]], own[filed[g]:], bits)], np.uint64).reshape(-1, 2)
            pairs = pairs[pairs[:, 0] != pairs[:, 1]]
            a.append(pairs[:, 0]), b.append(pairs[:, 1])
        if a:
            x, y = np.concatenate(a).view(np.int64), np.concatenate(b).view(np.int64)
            pairs = np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)], 1), axis=0)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])
        return None

    def run(batches):
        held = None
        for batch in batches:
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            cols[2] = cols[2].astype(np.int64).view(np.uint64)
            held = cols if held is None else [np.concatenate(x) for x in zip(held, cols)]
            last = np.flatnonzero((held[0] != held[0][-1]) | (held[1] != held[1][-1]))
            cut = last[-1] + 1 if len(last) else 0
            if cut:
                out = found(*[x[:cut] for x in held])
                held = [x[cut:] for x in held]
                if out is not None:
                    yield out
        if held is not None and len(held[0]) and (out := found(*held)) is not None:
            yield out
    return run


def links(fps: DataFrame, bits: int = BITS, parts: int = PARTS) -> DataFrame:
    """(a, b): links that connect all pairs of the distinct longs ``fp`` at most ``bits`` bits apart.

    Gathered on the driver, all bounded: 64 x 64 counts, ``parts`` x 2**16 value counts and, of values that
    hold 1/256 of all rows or more, at most 256 a partition.
    """
    spark = fps.sparkSession
    n = fps.count()
    summed = (fps.select("fp").mapInArrow(_together, "bit int, counts binary")
              .groupBy("bit").applyInArrow(_sum_counts, "bit int, counts binary").collect())
    together = np.zeros((64, 64), np.int64)
    for r in summed:
        together[r["bit"]] = np.frombuffer(r["counts"], np.int64)
    groups = bit_groups(together, n, parts)
    sizes = [len(g) for g in groups]

    def filed(batches):
        for batch in batches:
            f = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([values(f, g) | (i << 40) for i, g in enumerate(groups)]))],
                                             names=["key"])
    counts = staged(fps.select("fp").mapInArrow(filed, "key long").groupBy("key").agg(F.count(F.lit(1)).alias("n")), "simhash-counts")
    counted = (counts.groupBy(F.shiftright("key", 40).cast("int").alias("part"),
                              F.col("key").bitwiseAND((1 << COUNTED) - 1).cast("int").alias("v")).agg(F.sum("n").alias("n")).toPandas())
    estimates = []
    for i, size in enumerate(sizes):
        histogram = np.zeros(1 << min(COUNTED, size))
        own = counted[counted["part"] == i]
        histogram[own["v"].to_numpy()] = own["n"].to_numpy()
        estimates.append(candidate_estimates(histogram, size, bits))
    hot = {r["key"]: -(-r["n"] // BLOCK) for r in counts.where((F.col("n") > BLOCK) & (F.col("n") * 256 >= n)).collect()}
    shared = spark.sparkContext.broadcast((groups, estimates, hot))

    def file_and_probe(batches):
        yield from _file_and_probe(*shared.value, bits)(batches)

    rows = fps.select("fp").mapInArrow(file_and_probe, "key long, block int, fp long, probe byte")
    return (rows.repartition("key", "block").sortWithinPartitions("key", "block", "probe")
            .mapInArrow(_links(bits), "a long, b long"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS, parts: int = PARTS) -> DataFrame:
    """One row per document: doc_id, fp (long), component_id (the smallest doc_id that links reach, itself
    included) and root (a fingerprint that names the component).

    Null and wordless texts have fingerprint 0, linked like any other; texts shorter than a shingle hash as
    one. Rows with null doc_id link like others but never name a component (null if all are null). Equal
    texts share a fingerprint and cost one row. Extra columns are not read; an empty table gives no rows.
    """
    prints = staged(docs.select("doc_id", fingerprint_column(F.col("text"), shingle).alias("fp")), "simhash-prints")
    firsts = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    roots = components(links(firsts, bits, parts), "simhash")
    member = firsts.join(roots, firsts["fp"] == roots["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    member = staged(member, "simhash-members")
    lowest = staged(member.groupBy("root").agg(F.min("first").alias("component_id")), "simhash-lowest")
    by_print = staged(spread_lookup(member.select("fp", "root"), lowest, "root").select("fp", "root", "component_id"), "simhash-components")
    return spread_lookup(prints, by_print, "fp").select("doc_id", "fp", "component_id", "root")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """``docs`` with one document of each group: that with the smallest doc_id (a null doc_id only where all are null)."""
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    keepers = (near_duplicates(docs, shingle, bits).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
               .groupBy("root").agg(F.min(F.struct(name.alias("_id"), F.col("fp").alias("_fp"))).alias("k")).select("k.*"))
    rows = docs.select(F.struct("*").alias("_row"), name.alias("_id"), fingerprint_column(F.col("text"), shingle).alias("_fp"))
    return rows.join(staged(keepers, "simhash-keepers"), ["_id", "_fp"], "left_semi").dropDuplicates(["_id", "_fp"]).select("_row.*")
