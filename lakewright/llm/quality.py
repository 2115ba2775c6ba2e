"""Quality classifier by positive-unlabelled learning.

Trusted positives are labelled documents of quality 1; the unlabelled sample is web text of any quality. A
small network is trained on the non-negative unbiased risk  pi * R_p(+) + max(0, R_u(-) - pi * R_p(-)): the
negatives' risk is what unlabelled text has beyond its share of positives, and a step that would drive it
below zero is taken back. The class prior pi is estimated from the training labels. Inputs are
counts over the whole text; labels, lang, source and doc_id are not among them.
"""

from __future__ import annotations

from math import log1p
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakewright.llm.common import least_hashed

#: Bounds of the training sample: trusted positives and unlabelled documents, those of least hash.
POSITIVES, UNLABELLED = 20_000, 20_000
FOLDS, THRESHOLD = 5, 0.3
HIDDEN, EPOCHS, BATCH, RATE, DECAY, MEMBERS = 24, 60, 1024, 5e-3, 1e-4, 3
#: Scores stay this far from 0 and 1 in the prior.
LEAST_PRIOR = 0.02

UPPER, LOWER, DIGIT = (bytes(range(a, b)) for a, b in ((65, 91), (97, 123), (48, 58)))
SPACE = b" \t\n\r\x0b\x0c"
HIGH = bytes(range(128, 256))
MARKS = [b".", b",", b"!", b"?", b"|", b":", b"-", b"'"]
SYMBOLS = b"#$%&*@^~<>=+_\\/{}[]`"


def features(text: bytes | None) -> list[float]:
    """Counts of a whole text, as shares of its bytes, words or lines; all zero for an empty one."""
    b = text or b""
    n, words = len(b), (text or b"").split()
    nw = len(words)
    if not nw:
        return [0.0] * N_FEATURES
    gone = [n - len(b.translate(None, c)) for c in (UPPER, LOWER, DIGIT, SPACE, HIGH, SYMBOLS)]
    letters = max(1, gone[0] + gone[1])
    distinct = len(set(words))
    pairs = len(set(zip(words, words[1:])))
    lengths = np.fromiter(map(len, words), np.int64, nw)
    lines = b.count(b"\n") + 1
    return [gone[0] / letters, gone[2] / n, gone[4] / n, gone[5] / nw, *(min(b.count(m) / nw, 2.0) for m in MARKS),
            distinct / nw, pairs / nw, log1p(distinct), sum(map(eq, words, words[1:])) / nw, log1p(nw),
            float(lengths.mean()), float(lengths.std()), float((lengths <= 3).mean()), float((lengths > 20).mean()),
            log1p(nw / lines), log1p(lines), log1p(nw / (1 + b.count(b".")))]


N_FEATURES = 4 + len(MARKS) + 12


def features_column(text: Column) -> Column:
    @F.pandas_udf("array<double>")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([features(t) for t in texts])
    return run(F.coalesce(text, F.lit("")).cast("binary"))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, seed: int = 0) -> dict:
    """Weights of MEMBERS small networks, averaged in ``predict``; the same inputs give the same weights."""
    mean, std = unlabelled.mean(0), unlabelled.std(0) + 1e-6
    xp, xu = (np.clip((x - mean) / std, -6, 6) for x in (positive, unlabelled))
    members = []
    for member in range(MEMBERS):
        rng = np.random.default_rng(seed + member)
        w = [rng.normal(0, 1 / np.sqrt(xp.shape[1]), (xp.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.array(np.log(prior / (1 - prior)))]
        m, v, t = [np.zeros_like(x) for x in w], [np.zeros_like(x) for x in w], 0
        steps = max(1, len(xu) // BATCH)
        for epoch in range(EPOCHS):
            pu, pp = rng.permutation(len(xu)), rng.permutation(len(xp))
            for s in range(steps):
                u = xu[pu[s::steps]]
                p = xp[pp[s::steps]] if len(pp) >= steps else xp
                hp, hu = np.tanh(p @ w[0] + w[1]), np.tanh(u @ w[0] + w[1])
                gp, gu = hp @ w[2] + w[3], hu @ w[2] + w[3]
                sp, su = 1 / (1 + np.exp(-gp)), 1 / (1 + np.exp(-gu))
                risk = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
                if risk >= 0:  # d/dg of log(1 + e^-g) is s - 1, of log(1 + e^g) is s
                    dp, du = prior * ((sp - 1) - sp) / len(p), su / len(u)
                else:          # the negatives' risk went below zero: step back on it alone
                    dp, du = prior * sp / len(p), -su / len(u)
                grad = [np.zeros_like(x) for x in w]
                for x, h, d in ((p, hp, dp), (u, hu, du)):
                    back = np.outer(d, w[2]) * (1 - h * h)
                    grad[0] += x.T @ back
                    grad[1] += back.sum(0)
                    grad[2] += h.T @ d
                    grad[3] = grad[3] + d.sum()
                t += 1
                rate = RATE * (0.5 + 0.5 * np.cos(np.pi * epoch / EPOCHS))
                for i in range(4):
                    g = grad[i] + DECAY * w[i]
                    m[i], v[i] = 0.9 * m[i] + 0.1 * g, 0.999 * v[i] + 0.001 * g * g
                    w[i] = w[i] - rate * (m[i] / (1 - 0.9 ** t)) / (np.sqrt(v[i] / (1 - 0.999 ** t)) + 1e-8)
        members.append([np.asarray(x) for x in w])
    return {"mean": mean, "std": std, "members": members}


def predict(model: dict | None, x: np.ndarray) -> np.ndarray:
    """Probability of quality 1; 0.5 without a model."""
    if model is None:
        return np.full(len(x), 0.5)
    z = np.clip((x - model["mean"]) / model["std"], -6, 6)
    logits = np.mean([np.tanh(z @ w[0] + w[1]) @ w[2] + w[3] for w in model["members"]], axis=0)
    return 1 / (1 + np.exp(-logits))


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def train(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> dict | None:
    """A model from documents outside the held-out fold; None if no trusted positive or unlabelled text exists.

    At most ``positives`` + ``unlabelled`` rows, those with the least hash of doc_id, are gathered, as features only.
    """
    trusted = labels.where(fold(F.col("doc_id")) != 0).where("quality IS NOT NULL")
    share = trusted.agg(F.avg((F.col("quality") == 1).cast("double"))).first()[0]
    if not share:
        return None
    prior = min(max(share, LEAST_PRIOR), 1 - LEAST_PRIOR)
    good = trusted.where("quality = 1").select("doc_id").distinct()
    web = docs.where(fold(F.col("doc_id")) != 0).select("doc_id").distinct()
    good, web = least_hashed(good, positives, "positive"), least_hashed(web, unlabelled, "unlabelled")
    picked = good.withColumn("p", F.lit(1)).unionByName(web.withColumn("p", F.lit(0)))
    picked = picked.groupBy("doc_id").agg(F.max("p").alias("p"), F.min("p").alias("u"))  # u = 0: in the unlabelled sample
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("doc_id", "p", "u", features_column(F.col("text")).alias("x"))
    got = rows.toPandas().sort_values("doc_id", kind="stable")
    x = np.array(got["x"].tolist(), np.float64).reshape(-1, N_FEATURES)
    xp, xu = x[got["p"].to_numpy() == 1], x[got["u"].to_numpy() == 0]
    return fit(xp, xu, prior) if len(xp) and len(xu) else None


def scored(docs: DataFrame, model: dict | None) -> Column:
    """The score column of ``docs`` under ``model`` (a few KB, broadcast)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(predict(shared.value, np.array([features(t) for t in texts], np.float64).reshape(-1, N_FEATURES)))
    return run(F.coalesce(F.col("text"), F.lit("")).cast("binary"))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score in [0, 1], predicted (1 if score >= threshold).

    Null and empty texts get the score of all-zero counts. held_out is null for a null doc_id, which is never
    learned from. Repeated rows score alike; extra columns are not read; an empty table gives no rows.
    Without labels every score is 0.5.
    """
    model = train(docs, labels)
    out = docs.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), scored(docs, model).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs``, all columns, without the documents that the classifier rejects."""
    score = scored(docs, train(docs, labels))
    return docs.select(F.struct("*").alias("_row"), score.alias("_score")).where(F.col("_score") >= threshold).select("_row.*")
