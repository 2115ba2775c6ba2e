"""Best-fit packing with a swap-based local search.

Documents are tokenised where they lie and cut into pieces of at most ``capacity`` tokens. Full pieces are
sequences already. The others are dealt by hash into groups of about GROUP pieces, whatever the corpus size; each
group is packed best fit first and then improved: documents move between underfull bins, or
are exchanged one for one or two for one, whenever that raises the sum of squared fills, until the lightest bins
are empty. Bins that stay underfull in their group meet those of other groups in a second round.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakewright.llm.common import staged

CAPACITY = 2048
END_ID = 0
#: Pieces packed together.
GROUP = 4096
#: Bins filled to less than this share are repacked in the second round.
UNDERFULL = 0.97
#: Entries of the token caches of a Python worker (two generations of each are kept).
CACHED = 250_000

# The pre-tokens of the word BPE vocabulary, for texts of ASCII and Latin-1 letters in lower case.
PRETOKEN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")
SIMPLE = re.compile(r"[!-~À-ÖØ-öø-ÿ]*\Z")


class Aging(dict):
    """A cache of two generations: entries not used during a whole generation go."""

    def __init__(self, make, most: int = CACHED):
        super().__init__()
        self.make, self.most, self.old = make, most, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class WordEncoder:
    """Token ids (little-endian unsigned 32-bit bytes) of a text under a word-wise BPE vocabulary.

    White space never joins tokens, so a text's ids are those of its words, and words repeat. A word of plain
    letters is split into pre-tokens here and each goes to the BPE model; any other word goes whole to
    the tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = [b for b in range(256) if b not in printable]
        self.byte_chars = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(other)}
        self.pretokens = Aging(self._model_ids)
        self.words = Aging(self._word_ids)

    def _model_ids(self, token: str) -> bytes:
        mapped = token.encode().decode("latin-1").translate(self.byte_chars)
        return b"".join(t.id.to_bytes(4, "little") for t in self.model.tokenize(mapped))

    def _word_ids(self, word: str) -> bytes:
        if not SIMPLE.match(word) or any(s in word for s in self.special):
            return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(map(self.pretokens.__getitem__, PRETOKEN.findall(word.lower())))

    def __call__(self, text: str) -> bytes:
        plain = text.replace("\n", " ").replace("\t", " ").replace("\r", " ")
        return b"".join(map(self.words.__getitem__, plain.split(" ")))


def _cut(path: str, capacity: int, end_id: int):
    def run(batches):
        encode, end = WordEncoder(path), end_id.to_bytes(4, "little")
        for batch in batches:
            out: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = memoryview(encode(text.as_py() or "") + end)
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[at:at + 4 * capacity]
                    out.append((doc, piece, at // 4, len(own) // 4, zlib.crc32(own)))
            cols = list(zip(*out)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (
                pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))], names=["doc_id", "piece", "start", "length", "ids_crc32"])
    return run


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Best-fit decreasing: item numbers per bin."""
    rooms: list[tuple[int, int]] = []  # (room, bin), sorted
    bins: list[list[int]] = []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        at = bisect_left(rooms, (lengths[i], -1))
        if at < len(rooms):
            room, b = rooms.pop(at)
            bins[b].append(i)
        else:
            room, b = capacity, len(bins)
            bins.append([i])
        insort(rooms, (room - lengths[i], b))
    return bins


def local_search(lengths: list[int], bins: list[list[int]], capacity: int, underfull: float = UNDERFULL) -> list[list[int]]:
    """Empties light bins: from the lightest on, its items move to, or are exchanged with one smaller item
    of, a fuller bin with room; or two of its items with one. Every step raises the sum of squared fills,
    so the search ends; it stops at a bin that no step improves, and goes on with the next underfull one."""
    size = np.array(lengths, np.int64)
    home = np.zeros(len(size), np.int64)
    for b, items in enumerate(bins):
        home[items] = b
    fill = np.bincount(home, size, len(bins)).astype(np.int64)
    stuck: set[int] = set()

    def victim():
        light = [b for b in range(len(bins)) if 0 < fill[b] < underfull * capacity and b not in stuck]
        return min(light, key=lambda b: (fill[b], b), default=None)

    def swap(out: list[int], back: int | None, to: int, src: int) -> None:
        for i in out:
            home[i] = to
        moved = int(size[out].sum())
        if back is not None:
            home[back] = src
            moved -= int(size[back])
        fill[to] += moved
        fill[src] -= moved

    while (v := victim()) is not None:
        improved = False
        own = sorted(np.flatnonzero(home == v).tolist(), key=lambda i: (-size[i], i))
        room = capacity - fill
        room[v] = -1
        heavier = (fill >= fill[v]) & (fill > 0)
        heavier[v] = False
        # move: the fullest bin that takes it
        for i in own:
            fit = np.flatnonzero(heavier & (room >= size[i]))
            if len(fit):
                swap([i], None, int(fit[np.argmin(room[fit])]), v)
                improved = True
                break
        if not improved:
            other = np.flatnonzero(heavier[home] & (room[home] > 0))
            gives = room[home[other]]
            small = size[other]
            offers = [[i] for i in own] + [[own[x], own[y]] for x in range(min(len(own), 12)) for y in range(x + 1, min(len(own), 12))]
            best, step = 0, None
            for offer in offers:
                gain = int(size[offer].sum()) - small
                ok = np.flatnonzero((gain > 0) & (gain <= gives))
                if len(ok):
                    # fills of the two bins before and after: the squared fill grows by 2 * gain * (heavy - light + gain)
                    worth = gain[ok] * (fill[home[other[ok]]] - fill[v] + gain[ok])
                    k = int(np.argmax(worth))
                    if worth[k] > best:
                        best, step = int(worth[k]), (offer, int(other[ok[k]]))
            if step:
                swap(step[0], step[1], int(home[step[1]]), v)
                improved = True
        if improved:
            stuck.discard(v)
        else:
            stuck.add(v)
    out: list[list[int]] = [[] for _ in bins]
    for i, b in enumerate(home.tolist()):
        out[b].append(i)
    return [b for b in out if b]


def _pack(capacity: int):
    def run(pieces: pa.Table) -> pa.Table:
        pieces = pieces.sort_by("pid")
        pid, lengths = pieces.column("pid").to_pylist(), pieces.column("length").to_pylist()
        bins = local_search(lengths, best_fit(lengths, capacity), capacity)
        if "sequence_id" in pieces.column_names and pieces.column("sequence_id").null_count == 0:
            old = pieces.column("sequence_id").to_pylist()
            if len(set(old)) <= len(bins):
                return pieces
        sequence, offset, filled = [0] * len(pid), [0] * len(pid), [0] * len(pid)
        for items in bins:
            total, first = sum(lengths[i] for i in items), pid[items[0]]
            at = 0
            for i in items:
                sequence[i], offset[i], filled[i] = first, at, total
                at += lengths[i]
        for name, values in (("sequence_id", sequence), ("offset", offset), ("fill", filled)):
            pieces = pieces.set_column(pieces.schema.get_field_index(name), name, pa.array(values, pa.int64()))
        return pieces
    return run


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, fill.

    A document is its ids under ``tokenizer`` (a word-wise BPE file that every worker can read) and then
    ``end_id``; null and empty texts are the end id alone. Repeated rows and null doc_ids are packed each for
    itself. Extra columns are not read; an empty table gives no rows. Only lengths are shuffled, never ids.
    """
    cut = docs.select("doc_id", "text").mapInArrow(_cut(tokenizer, capacity, end_id),
                                                   "doc_id long, piece int, start long, length long, ids_crc32 long")
    pieces = staged(cut.withColumn("pid", F.monotonically_increasing_id()), "pack-pieces")
    full = pieces.where(F.col("length") >= capacity).select(
        "doc_id", "piece", "start", "length", "ids_crc32", F.col("pid").alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"), F.lit(capacity).cast("long").alias("fill"))
    rest = pieces.where(F.col("length") < capacity).select(
        "*", *[F.lit(None).cast("long").alias(c) for c in ("sequence_id", "offset", "fill")])
    first = staged(_in_groups(rest, rest.count(), "pid", capacity), "pack-first")
    light = (F.col("fill") < UNDERFULL * capacity)
    again = first.where(light)
    second = _in_groups(again, again.count(), "sequence_id", capacity)
    out = first.where(~light).unionByName(second).drop("pid")
    return full.unionByName(out.select(full.columns))


def _in_groups(pieces: DataFrame, n: int, by: str, capacity: int) -> DataFrame:
    """Packs ``pieces`` in hash groups of about GROUP; rows with one value of ``by`` stay together."""
    groups = max(1, -(-n // GROUP))
    columns = pieces.columns
    dealt = pieces.withColumn("_group", F.pmod(F.xxhash64(F.col(by)), F.lit(groups)).cast("int"))
    run = _pack(capacity)

    def one(table: pa.Table) -> pa.Table:
        return run(table.select(columns))
    return dealt.groupBy("_group").applyInArrow(one, pieces.schema)
