"""Plain Python versions of the training-data operators, for small inputs."""
import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import xxhash

WHITE = " \t\n\r\x0b\x0c"


class Union:
    def __init__(self):
        self.up = {}

    def find(self, x):
        while self.up.setdefault(x, x) != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def sha(b):
    return hashlib.sha256(b).hexdigest()


def majority(hashes):
    bits = sum(1 << b for b in range(64) if 2 * sum((h >> b) & 1 for h in hashes) > len(hashes))
    return bits


def simhash(text, shingle=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    return majority([xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles])


def components(items, linked):
    u = Union()
    items = sorted(set(items))
    for i, a in enumerate(items):
        u.find(a)
        for b in items[i + 1:]:
            if linked(a, b):
                u.join(a, b)
    return u


def near(a, b):
    return bin(a ^ b).count("1") <= 3


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def normal_line(line):
    return re.sub(f"[{WHITE}]+", " ", line.lower()).strip(" ")


def similar_lines(a, b, similarity=0.8):
    """The larger of the edit similarities over words and, for lines of under 32 words, over characters."""
    def close(x, y):
        most = max(len(x), len(y))
        allowed = int(most * (1 - similarity) + 1e-9)
        if abs(len(x) - len(y)) > allowed:
            return False
        runs = [Counter(zip(z, z[1:])) for z in (x, y)]  # an edit changes two neighbourhoods at most
        if sum((runs[0] & runs[1]).values()) < most - 1 - 2 * allowed:
            return False
        return edit_distance(x, y) <= allowed
    x, y = a.split(" "), b.split(" ")
    return close(x, y) or len(x) < 32 and len(y) < 32 and close(a, b)


def dedup_lines(docs):
    """docs: (doc_id, text) in order of precedence; the kept text of each, by edit similarity alone."""
    first = {}
    for d, (_, text) in enumerate(docs):
        for n, line in enumerate((text or "").split("\n")):
            if normal_line(line):
                first.setdefault(normal_line(line), (d, n))
    u = components(list(first), similar_lines)
    keep = {}
    for x in first:
        r = u.find(x)
        keep[r] = min(keep.get(r, first[x]), first[x])
    out = []
    for d, (_, text) in enumerate(docs):
        out.append(None if text is None else "\n".join(
            x for n, x in enumerate(text.split("\n")) if not normal_line(x) or keep[u.find(normal_line(x))] == (d, n)))
    return out


def repeated_bytes(docs, length):
    """docs: bytes in order of precedence; per document the kept bytes and the number of removed runs."""
    seen, out = set(), []
    for b in docs:
        gone = [False] * len(b)
        for i in range(len(b) - length + 1):
            w = b[i:i + length]
            if w in seen:
                gone[i:i + length] = [True] * length
            seen.add(w)
        runs = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((bytes(c for c, g in zip(b, gone) if not g), runs))
    return out


ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)


def secrets(text):
    text = text or ""
    found = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return ",".join(f"{k}:{a}:{z}" for a, _, z, k in sorted(found))


def targets(sizes, weights=(5, 2, 1), cap=3):
    """{source: size} -> {source: target} by resharing in rounds."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out, open_, left = {}, set(order), float(sum(sizes.values()))
    while open_:
        level = left / sum(w[s] for s in open_)
        full = {s for s in open_ if cap * sizes[s] < w[s] * level}
        if not full:
            out.update({s: w[s] * level for s in open_})
            break
        for s in full:
            out[s] = float(cap * sizes[s])
            left -= out[s]
        open_ -= full
    return out


def top_k(rows, every, k, scale=64):
    """rows: (vec_id, vector) -> {(query row, rank): (query_id, vec_id, score)}"""
    ok = [(i, [int(np.floor(scale * x)) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for a, (q, x) in enumerate(ok):
        if q % every == 0:
            scores = sorted((-sum(p * r for p, r in zip(x, y)), c) for b, (c, y) in enumerate(ok) if b != a and len(y) == len(x))
            out += [(q, n, c, -s) for n, (s, c) in enumerate(scores[:k], 1)]
    return sorted(out)


def group_by(rows, key):
    out = defaultdict(list)
    for r in rows:
        out[key(r)].append(r)
    return out
