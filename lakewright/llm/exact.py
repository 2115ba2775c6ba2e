"""Exact dedup by two-pass Bloom filtering.

Pass 1: every task keeps, per filter cell, whether its rows hit it once and whether more often; the
tasks' cells are merged by filter segment. Pass 2: a row whose cells were all hit twice or more may
be repeated and is shuffled by its digest; every other row is certainly alone and passes straight
through. A digest that meets no equal one in the shuffle is alone too, so the result is exact whatever
the filter's size.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from lakewright.llm.common import spread_lookup, staged

#: Filter cells per row, and the most cells there may be (2**27 cells: 16 MB for each of the two bit arrays).
CELLS_PER_ROW = 16
MAX_CELLS = 1 << 27
SEGMENTS = 64
PROBES = 2


def _cells(hashes: np.ndarray, cells: int) -> list[np.ndarray]:
    """PROBES cell numbers of each 64-bit hash; ``cells`` is a power of two up to 2**31."""
    h = hashes.view(np.uint64)
    mask = np.uint64(cells - 1)
    return [(h & mask).astype(np.int64), ((h >> np.uint64(32)) & mask).astype(np.int64)][:PROBES]


def _hits(cells: int):
    def run(batches):
        seen = np.zeros(cells, np.uint8)  # 0, 1, or 2 for more
        for batch in batches:
            h = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for c in _cells(h, cells):
                c, n = np.unique(c, return_counts=True)
                seen[c] = np.minimum(seen[c] + np.minimum(n, 2), 2)
        size = cells // SEGMENTS
        rows = []
        for s in range(SEGMENTS):
            part = seen[s * size:(s + 1) * size]
            if part.any():
                rows.append((s, zlib.compress(np.packbits(part > 0).tobytes(), 1), zlib.compress(np.packbits(part > 1).tobytes(), 1)))
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()),
                                          pa.array([r[1] for r in rows], pa.binary()),
                                          pa.array([r[2] for r in rows], pa.binary())],
                                         names=["segment", "once", "again"])
    return run


def _merge(size: int):
    def run(batches):
        """Rows arrive sorted by segment; only one segment's two bit arrays are held."""
        segment, once, again = None, None, None

        def done():
            return pa.RecordBatch.from_arrays([pa.array([segment], pa.int32()),
                                               pa.array([zlib.compress(again.tobytes(), 1)], pa.binary())],
                                              names=["segment", "again"])
        for batch in batches:
            for s, o, a in zip(*(batch.column(i).to_pylist() for i in range(3))):
                o = np.frombuffer(zlib.decompress(o), np.uint8)
                a = np.frombuffer(zlib.decompress(a), np.uint8)
                if s != segment:
                    if segment is not None:
                        yield done()
                    segment, once, again = s, np.zeros(size // 8, np.uint8), np.zeros(size // 8, np.uint8)
                again |= a | (once & o)
                once |= o
        if segment is not None:
            yield done()
    return run


class Filter:
    """The merged filter, broadcast; ``bits()`` unpacks it in a task."""

    def __init__(self, cells: int, segments):
        self.cells, self.segments = cells, segments

    def bits(self) -> np.ndarray:
        out = np.zeros(self.cells // 8, np.uint8)
        size = self.cells // SEGMENTS // 8
        for s, packed in self.segments.value.items():
            out[s * size:(s + 1) * size] = np.frombuffer(zlib.decompress(packed), np.uint8)
        return out

    def may_repeat(self, hashes: np.ndarray, bits: np.ndarray) -> np.ndarray:
        hit = np.ones(len(hashes), bool)
        for c in _cells(hashes, self.cells):
            hit &= (bits[c >> 3] >> (7 - (c & 7)).astype(np.uint8)) & 1 > 0
        return hit


def repeat_filter(hashes: DataFrame, rows: int, cells_per_row: int = CELLS_PER_ROW, max_cells: int = MAX_CELLS) -> Filter:
    """First pass over ``hashes`` (one long column, about ``rows`` of them).

    The filter has about ``cells_per_row`` cells a row, ``max_cells`` at most, which bounds what a task holds and
    what is broadcast; a fuller filter lets more rows through and changes no result.
    """
    cells = min(max(1 << (max(rows, 1) * cells_per_row - 1).bit_length(), SEGMENTS * 8), max_cells)
    seen = hashes.mapInArrow(_hits(cells), "segment int, once binary, again binary")
    merged = (seen.repartition(SEGMENTS, "segment").sortWithinPartitions("segment")
              .mapInArrow(_merge(cells // SEGMENTS), "segment int, again binary").collect())
    return Filter(cells, hashes.sparkSession.sparkContext.broadcast({r["segment"]: bytes(r["again"]) for r in merged}))


def possibly_repeated(hashed: DataFrame, **filter_size) -> DataFrame:
    """``hashed`` (with a long column ``hash``, none null) plus ``maybe``: false only where no other row has the hash."""
    found = repeat_filter(hashed.select("hash"), hashed.count(), **filter_size)

    def probe(batches):
        bits = found.bits()
        for batch in batches:
            h = batch.column(batch.schema.get_field_index("hash")).to_numpy(zero_copy_only=False).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found.may_repeat(h, bits))], names=[*batch.schema.names, "maybe"])
    return hashed.mapInArrow(probe, StructType([*hashed.schema, StructField("maybe", BooleanType())]))


def exact_duplicates(docs: DataFrame, normalise=None, **filter_size) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Equal texts (after ``normalise``, a Column function; none by default) form a group; its row with the
    largest doc_id stays. Null text counts as empty. A null doc_id loses to any other; of several rows
    with the same doc_id and text one stays. Extra columns are not read; an empty table gives no rows.
    Only digests are shuffled, never texts, and only those that the filter can't rule out; a group of any
    size is counted map-side first and its rows find their keeper through a spread lookup.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    sha = F.sha2(normalise(text) if normalise else text, 256)
    hashed = staged(docs.select("doc_id", sha.alias("text_sha256")).withColumn("hash", F.xxhash64("text_sha256"))
                    .withColumn("row", F.monotonically_increasing_id()), "exact-hashed")
    probed = staged(possibly_repeated(hashed, **filter_size).drop("hash"), "exact-probed")
    alone = probed.where(~F.col("maybe")).select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
                                                 F.lit(True).alias("kept"), "text_sha256")
    again = probed.where("maybe")
    best = again.groupBy("text_sha256").agg(F.max(F.struct("doc_id", "row")).alias("best"), F.count(F.lit(1)).alias("group_size"))
    best = staged(best.select("text_sha256", F.col("best.doc_id").alias("keep_id"), F.col("best.row").alias("keep_row"), "group_size"),
                  "exact-groups")
    met = spread_lookup(again, best, "text_sha256").select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "text_sha256")
    return alone.unionByName(met)
