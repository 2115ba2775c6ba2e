"""Exact top-k inner products by norm-bucketed retrieval.

Vectors are sorted by length into buckets, queries into blocks. Per block, the buckets of a stripe are visited from
the longest on, with each query's k-th best score so far as its threshold. score >= threshold needs a
cosine of at least threshold / (|query| * longest of the bucket): above 1 the query skips the bucket.
Otherwise the bucket is pruned by length (vectors too short for the threshold) or by coordinates (vectors
outside the feasible interval of the query's largest coordinates), whichever the local cosine thresholds favour,
and the products of what is left are computed exactly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakewright.llm.common import arrow_rows, staged

SCALE = 64
#: Vectors in a bucket, queries in a block (on average), and stripes that the buckets of a block are dealt to.
BUCKET, BLOCK, STRIPES = 1024, 512, 8
#: Coordinates tested per query, queries tried for the choice, and the share of survivors up to which it pays.
FOCUS, TRIED, WORTH = 4, 8, 0.1
EXACT = float(1 << 53)
LEAST = np.iinfo(np.int64).min


def _quantise(scale: int):
    def run(batches):
        for batch in batches:
            ids, vectors = batch.column(0).to_pylist(), batch.column(1)
            rows = []
            for i, v in zip(ids, vectors):
                x = np.floor(scale * np.asarray(v.values.to_numpy(zero_copy_only=False), np.float64))
                if len(x) and np.abs(x).max() >= 2.0 ** 62:
                    raise OverflowError(f"a component of vector {i} does not fit a long")
                rows.append((i, len(x), float(np.sqrt((x * x).sum())), x.astype("<i8").tobytes()))
            cols = list(zip(*rows)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.float64(), pa.binary()))],
                                             names=["vec_id", "dim", "norm", "vector"])
    return run


BLOCKS = "dim int, longest double, uids binary, vec_ids binary, vectors binary"


def _pack(most: int, key: str | None = None):
    """Consecutive rows with one dim (and one ``key``) as one block row, at most ``most`` together."""
    def block(rows, k):
        uid, vec_id, dim, norm, vector = zip(*rows)
        cols = [pa.array([dim[0]], pa.int32()), pa.array([max(norm)]), pa.array([np.array(uid, "<i8").tobytes()]),
                pa.array([np.array(vec_id, "<i8").tobytes()]), pa.array([b"".join(vector)], pa.binary())]
        names = ["dim", "longest", "uids", "vec_ids", "vectors"]
        return pa.RecordBatch.from_arrays(cols + ([pa.array([k], pa.int32())] if key else []), names=names + ([key] if key else []))

    def run(batches):
        rows, at = [], None
        for batch in batches:
            cols = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("uid", "vec_id", "dim", "norm", "vector")]
            keys = batch.column(batch.schema.get_field_index(key)).to_pylist() if key else [None] * batch.num_rows
            for k, row in zip(keys, zip(*cols)):
                if rows and (len(rows) >= most or at != (k, row[2])):
                    yield block(rows, at[0])
                    rows = []
                at = (k, row[2])
                rows.append(row)
        if rows:
            yield block(rows, at[0])
    return run


class Bucket:
    """Vectors of one dimension in order of falling length."""

    def __init__(self, dim: int, uids: bytes, vec_ids: bytes, vectors: bytes):
        self.uids, self.vec_ids = np.frombuffer(uids, "<i8"), np.frombuffer(vec_ids, "<i8")
        self.vectors = np.frombuffer(vectors, "<i8").reshape(len(self.uids), dim)
        self.floats = self.vectors.astype(np.float64)
        self.norms = np.sqrt((self.floats * self.floats).sum(1))
        order = np.argsort(-self.norms, kind="stable")
        for name in ("uids", "vec_ids", "vectors", "floats", "norms"):
            setattr(self, name, getattr(self, name)[order])
        self.most = float(np.abs(self.floats).max()) if self.floats.size else 0.0
        self.units = self.floats / np.where(self.norms > 0, self.norms, 1.0)[:, None]


class Search:
    """The k best of a block of queries (a Bucket), over buckets given one after the other."""

    def __init__(self, queries: Bucket, k: int):
        self.q, self.k = queries, k
        n = len(queries.uids)
        self.score = np.zeros((n, 0), np.int64)
        self.vec = np.zeros((n, 0), np.int64)
        self.uid = np.zeros((n, 0), np.int64)
        self.found = np.zeros(n, np.int64)
        self.floor = np.full(n, LEAST)   # k-th best score
        self.floor_id = np.full(n, np.iinfo(np.int64).max)  # and its vec_id
        self.used = {"skipped": 0, "length": 0, "coordinate": 0}

    def visit(self, b: Bucket) -> None:
        q = self.q
        need = np.where(self.floor == LEAST, -np.inf, self.floor.astype(np.float64))
        reach = q.norms * b.norms[0] * (1 + 1e-12) + 1e-6
        live = np.flatnonzero(reach >= need)
        self.used["skipped"] += len(q.uids) - len(live)
        if not len(live):
            return
        with np.errstate(divide="ignore", invalid="ignore"):
            local = np.where((need[live] > 0) & (q.norms[live] > 0), need[live] / (q.norms[live] * b.norms[0]), 0.0)
        picky = local >= self._least_picky(live, local, need, b)
        for part, find in ((live[picky], self._by_coordinates), (live[~picky], self._by_length)):
            if len(part):
                rows, cols, scores = find(part, b, need)
                ids = b.vec_ids[cols]
                good = (scores > self.floor[rows]) | ((scores == self.floor[rows]) & (ids <= self.floor_id[rows]))
                self._merge(rows[good], scores[good], ids[good], b.uids[cols[good]])

    def _least_picky(self, live: np.ndarray, local: np.ndarray, need: np.ndarray, b: Bucket) -> float:
        """The local threshold from which coordinates leave few enough vectors of this bucket, judged by a few queries."""
        order = np.argsort(-local, kind="stable")
        order = order[local[order] > 0]
        least = np.inf
        for k in order[np.unique(np.linspace(0, len(order) - 1, min(TRIED, len(order))).astype(np.int64))] if len(order) else ():
            if self._feasible(live[k], b, need[live[k]]).mean() > WORTH:
                break
            least = local[k]
        return least

    def _by_coordinates(self, part: np.ndarray, b: Bucket, need: np.ndarray):
        self.used["coordinate"] += len(part)
        found = [np.flatnonzero(self._feasible(i, b, need[i])) for i in part]
        rows, cols = np.repeat(part, [len(c) for c in found]), np.concatenate(found)
        scores = self._products(self.q.vectors[rows], b.vectors[cols], self.q.floats[rows], b.floats[cols], b, pairs=True)
        other = self.q.uids[rows] != b.uids[cols]
        return rows[other], cols[other], scores[other]

    def _by_length(self, part: np.ndarray, b: Bucket, need: np.ndarray):
        q = self.q
        self.used["length"] += len(part)
        with np.errstate(divide="ignore", invalid="ignore"):
            least = np.where((need[part] > 0) & (q.norms[part] > 0), need[part] / q.norms[part] * (1 - 1e-12) - 1e-6, 0.0)
        reach = int(np.searchsorted(-b.norms, -least, side="right").max())
        table = self._products(q.vectors[part], b.vectors[:reach], q.floats[part], b.floats[:reach], b)
        _, x, y = np.intersect1d(q.uids[part], b.uids[:reach], return_indices=True)
        table[x, y] = LEAST
        bar = self.floor[part]
        if reach > self.k:  # what is below the k best of the bucket itself can't be among the k best
            bar = np.maximum(bar, np.partition(table, reach - self.k, axis=1)[:, reach - self.k])
        rows, cols = np.nonzero((table >= bar[:, None]) & (table != LEAST))
        return part[rows], cols, table[rows, cols]

    def _feasible(self, i: int, b: Bucket, need: float) -> np.ndarray:
        """Vectors whose largest query coordinates allow a product of ``need``."""
        ok = np.ones(len(b.uids), bool)
        if need <= 0 or self.q.norms[i] <= 0 or b.norms[0] <= 0:
            return ok
        c = min(1.0, need / (self.q.norms[i] * b.norms[0]))
        unit = self.q.units[i]
        for f in np.argsort(-np.abs(unit), kind="stable")[:FOCUS]:
            # q_f p_f + sqrt(1 - q_f^2) sqrt(1 - p_f^2) >= c
            side = np.sqrt(max(0.0, (1 - c * c) * (1 - unit[f] * unit[f])))
            low = -1.0 if unit[f] <= -c else unit[f] * c - side
            high = 1.0 if unit[f] >= c else unit[f] * c + side
            ok &= (b.units[:, f] >= low - 1e-9) & (b.units[:, f] <= high + 1e-9)
        return ok

    def _products(self, qi, bi, qf, bf, b: Bucket, pairs: bool = False) -> np.ndarray:
        bound = self.q.most * b.most * max(1, qi.shape[1])
        if bound < EXACT:
            out = np.einsum("ij,ij->i", qf, bf) if pairs else qf @ bf.T
            return out.astype(np.int64)
        if bound >= 2.0 ** 62:
            raise OverflowError("an inner product does not fit a long")
        return np.einsum("ij,ij->i", qi, bi) if pairs else qi @ bi.T

    def _merge(self, rows, scores, ids, uids) -> None:
        if not len(rows):
            return
        touched = np.unique(rows)
        held = np.repeat(touched, self.found[touched])
        slot = np.concatenate([np.arange(n) for n in self.found[touched]]) if len(held) else np.zeros(0, np.int64)
        r = np.concatenate([rows, held])
        s = np.concatenate([scores, self.score[held, slot]])
        v = np.concatenate([ids, self.vec[held, slot]])
        u = np.concatenate([uids, self.uid[held, slot]])
        order = np.lexsort((u, v, -s, r))
        r, s, v, u = r[order], s[order], v[order], u[order]
        first = np.flatnonzero(np.r_[True, r[1:] != r[:-1]])
        rank = np.arange(len(r)) - np.repeat(first, np.diff(np.r_[first, len(r)]))
        keep = rank < self.k
        r, s, v, u, rank = r[keep], s[keep], v[keep], u[keep], rank[keep]
        if self.score.shape[1] < self.k:
            grow = ((0, 0), (0, self.k - self.score.shape[1]))
            self.score, self.vec, self.uid = np.pad(self.score, grow), np.pad(self.vec, grow), np.pad(self.uid, grow)
        self.score[r, rank], self.vec[r, rank], self.uid[r, rank] = s, v, u
        self.found[touched] = np.bincount(np.searchsorted(touched, r), minlength=len(touched))
        full = touched[self.found[touched] == self.k]
        self.floor[full], self.floor_id[full] = self.score[full, self.k - 1], self.vec[full, self.k - 1]

    def result(self):
        rows = np.repeat(np.arange(len(self.q.uids)), self.found)
        slot = np.concatenate([np.arange(n) for n in self.found]) if len(rows) else np.zeros(0, np.int64)
        return self.q.uids[rows], self.q.vec_ids[rows], self.uid[rows, slot], self.vec[rows, slot], self.score[rows, slot]


def _search(k: int):
    names = ["query_uid", "query_id", "uid", "vec_id", "score"]

    def run(batches):
        at, open_blocks = None, []

        def done():
            for s in open_blocks:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in s.result()], names=names)
        for batch in batches:
            for r in range(batch.num_rows):
                block, stripe, is_bucket, dim, _, uids, vec_ids, vectors = (c[r].as_py() for c in batch.columns)
                if (block, stripe) != at:
                    yield from done()
                    at, open_blocks = (block, stripe), []
                part = Bucket(dim, uids, vec_ids, vectors)
                if not is_bucket:
                    open_blocks.append(Search(part, k))
                else:
                    for s in open_blocks:
                        if s.q.vectors.shape[1] == dim:
                            s.visit(part)
        yield from done()
    return run


def top_k(vectors: DataFrame, every: int = 20, k: int = 20, scale: int = SCALE) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each row whose vec_id is divisible by ``every`` the ``k`` rows of
    ``vectors`` (vec_id, embedding) but itself with the highest inner product of floor(scale * x) vectors.

    Ties go to the smaller vec_id. Vectors null or holding null or non-finite components, and rows without
    vec_id, take no part; vectors of another dimension are no candidates. Repeated vec_ids are rows of their own.
    Products must fit a long, else an error. Extra columns are not read; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    usable = F.col("embedding").isNotNull() & ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.where(F.col("vec_id").isNotNull() & usable).select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    rows = staged(rows.mapInArrow(_quantise(scale), "vec_id long, dim int, norm double, vector binary")
                  .withColumn("uid", F.monotonically_increasing_id()), "topk-vectors")
    n = rows.count()
    buckets = (rows.repartitionByRange(max(1, -(-n // (8 * BUCKET))), "dim", F.desc("norm"), "uid")
               .sortWithinPartitions("dim", F.desc("norm"), "uid").mapInArrow(_pack(BUCKET), BLOCKS))
    buckets = staged(buckets.withColumn("bucket", F.monotonically_increasing_id()), "topk-buckets")
    asked = rows.where(F.pmod("vec_id", F.lit(every)) == 0)
    blocks = max(1, -(-asked.count() // BLOCK))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("uid"), F.lit(blocks)).cast("int"))
    asked = staged(asked.repartition(blocks, "block").sortWithinPartitions("block", "dim")
                   .mapInArrow(_pack(4 * BLOCK, "block"), BLOCKS + ", block int"), "topk-queries")
    payload = ["dim", "longest", "uids", "vec_ids", "vectors"]
    stripes = F.explode(F.sequence(F.lit(0), F.lit(STRIPES - 1))).alias("stripe")
    left = asked.select("block", stripes, F.lit(False).alias("is_bucket"), *payload)
    right = buckets.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
                           F.pmod(F.xxhash64("bucket"), F.lit(STRIPES)).cast("int").alias("stripe"), F.lit(True).alias("is_bucket"), *payload)
    met = left.unionByName(right).repartition(blocks * STRIPES, "block", "stripe").sortWithinPartitions("block", "stripe", "is_bucket", F.desc("longest"))
    with arrow_rows(spark, 16):
        best = staged(met.mapInArrow(_search(k), "query_uid long, query_id long, uid long, vec_id long, score long"), "topk-best")
    # at most k rows a stripe: merged by a sorted list of STRIPES * k entries a query
    lists = best.groupBy("query_uid", "query_id").agg(F.slice(F.array_sort(F.collect_list(F.struct(
        (-F.col("score")).alias("s"), "vec_id", "uid"))), 1, k).alias("best"))
    return lists.select("query_id", F.posexplode("best").alias("p", "b")).select(
        "query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("b.vec_id").alias("vec_id"), (-F.col("b.s")).alias("score"))
