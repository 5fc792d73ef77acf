"""Quality classifier: a document's own evidence, shrunk towards its path, its host and the whole.

A logistic model over the shape of a text, fitted on a bounded sample of labelled documents, gives
each document a probability.  Sums of these by host and path, then by host, then over all, give
posterior means from the top down: a host's mean is drawn to the global one and a path's to its
host's, the more the fewer documents it has; how strongly is estimated from how much hosts differ
(and paths within hosts) beyond what their sizes explain.  A document's score adds, in log-odds, its
own evidence and how far its path's mean, without the document itself, is off the global one.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from ledgerloom.session import materialise

#: Labelled documents the model is fitted on, at most.
SAMPLE = 20_000
#: Weight of a host or path mean against the document's own evidence, and the range of strengths.
SITE_WEIGHT, STRENGTHS = 0.5, (4.0, 1e6)
_SYMBOLS = re.compile(r"[^\w\s.,;:!?'\"()\-]")


def shape(text: str) -> list[float]:
    """What a text looks like, whatever its language."""
    words = text.split()
    n, chars = max(1, len(words)), max(1, len(text))
    counts = Counter(words)
    lines = [s.strip() for s in text.split("\n")]
    filled = [s for s in lines if s]
    letters = sum(map(str.isalpha, text))
    capitals = sum(map(str.isupper, text))
    again = sum(a == b for a, b in zip(words, words[1:], strict=False))
    return [
        np.log1p(len(words)),
        sum(map(len, words)) / n / 10,
        letters / chars,
        sum(map(str.isdigit, text)) / chars,
        len(_SYMBOLS.findall(text)) / n,
        len(counts) / n,
        counts.most_common(1)[0][1] / n if words else 0.0,
        again / n,
        capitals / max(1, letters),
        sum(s.count("|") for s in filled) / n,
        1 - len(set(filled)) / max(1, len(filled)),
        sum(w[-1] in ".!?" for w in words) / n,
        float(len(words) < 20),
        float(not words),
    ]


@F.pandas_udf(ArrayType(DoubleType()))
def _shapes(text: pd.Series) -> pd.Series:
    return pd.Series([shape(t or "") for t in text])


def held_out(doc_id: Column) -> Column:
    """Rows kept for testing: crc32 of the id as text divisible by 5.  A null id is not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _expand(x: np.ndarray) -> np.ndarray:
    """The features and their squares, so that too much and too little can both count."""
    return np.hstack([x, x * x])


class Logistic:
    """Weights over standardised features; without labels of both kinds everything scores `base`."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray, base: float):
        self.mean, self.scale, self.weights, self.base = mean, scale, weights, base

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        z = (_expand(x) - self.mean) / self.scale
        return np.clip(np.clip(z, -8, 8) @ self.weights + self.base, -12, 12)


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 25) -> Logistic:
    """Newton's method on log loss with a ridge penalty."""
    width = len(shape("")) * 2
    if not len(y) or y.min() == y.max():
        base = 0.0 if not len(y) else float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
        return Logistic(np.zeros(width), np.ones(width), np.zeros(width), base)
    wide = _expand(x)
    mean, scale = wide.mean(axis=0), np.maximum(wide.std(axis=0), 1e-6)
    z = np.hstack([np.clip((wide - mean) / scale, -8, 8), np.ones((len(y), 1))])
    w = np.zeros(width + 1)
    penalty = ridge * np.eye(width + 1)
    penalty[-1, -1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        hessian = (z * (p * (1 - p) + 1e-6)[:, None]).T @ z + penalty
        step = np.linalg.solve(hessian, z.T @ (y - p) - penalty @ w)
        w += step * min(1.0, 4 / max(1e-9, np.abs(step).max()))
    return Logistic(mean, scale, w[:-1], float(w[-1]))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Logistic:
    """Fit on at most `sample` labelled documents that are not held out, chosen by hash."""
    known = (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
        .where(~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").cast("long").alias("label_id"))
        .agg(F.min("quality").cast("double").alias("y"))
    )
    share = 0.95 * sample / max(1, known.count())
    if share < 1:  # by hash a little less than asked for, so that the limit has nothing to cut
        part = F.pmod(F.xxhash64("label_id"), F.lit(1_000_000))
        known = known.where(part < F.lit(int(share * 1_000_000)))
    texts = docs.select(F.col("doc_id").cast("long").alias("label_id"), "text")
    rows = known.join(texts, "label_id").select("label_id", "y", _shapes("text").alias("x"))
    taken = sorted(rows.limit(sample).toArrow().to_pylist(), key=lambda r: (r["label_id"], r["x"]))
    x = np.array([r["x"] for r in taken], dtype=float).reshape(len(taken), len(shape("")))
    return fit(x, np.array([r["y"] for r in taken], dtype=float))


def url_levels(url: Column) -> tuple[Column, Column]:
    """Host and first part of the path of a URL, in lower case; null where there is none."""
    host = F.lower(F.regexp_extract(url, r"^[a-zA-Z][\w+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))
    path = F.regexp_extract(url, r"^[a-zA-Z][\w+.-]*://[^/?#]*/([^/?#]+)", 1)
    return F.when(host != "", host), F.when(path != "", path)


def _strength(groups: DataFrame, mean: str) -> float:
    """How many documents a group's prior mean is worth, by the method of moments.

    `groups` has n, s (sum of probabilities), ss (of their squares) and the prior `mean`.
    """
    spread = F.greatest(F.col("ss") / F.col("n") - F.pow(F.col("s") / F.col("n"), 2), F.lit(0.0))
    off = F.pow(F.col("s") / F.col("n") - F.col(mean), 2)
    row = (
        groups.where("n > 1")
        .agg(
            F.sum(off).alias("between"),
            F.sum(spread / (F.col("n") - 1)).alias("within"),
            F.avg(spread).alias("spread"),
            F.count(F.lit(1)).alias("groups"),
        )
        .first()
    )
    low, high = STRENGTHS
    if not row["groups"] or not row["spread"]:
        return high
    beyond = (row["between"] - row["within"]) / row["groups"]
    return high if beyond <= row["spread"] / high else min(high, max(low, row["spread"] / beyond))


def _log_odds(p: Column) -> Column:
    p = F.greatest(F.least(p, F.lit(1 - 1e-6)), F.lit(1e-6))
    return F.log(p / (1 - p))


def score(docs: DataFrame, model: Logistic, host: Column, path: Column) -> DataFrame:
    """doc_id, host, path, own (the document's own probability), path_mean (of the other documents of
    its path, shrunk) and score (0 to 1).

    A null host or path is a group like any other; a null text counts as empty.  Repeated rows are
    documents of their own.  An empty table gives an empty result.
    """
    parts = (model.mean, model.scale, model.weights, model.base)

    @F.pandas_udf(DoubleType())
    def own(text: pd.Series) -> pd.Series:
        x = np.array([shape(t or "") for t in text], dtype=float).reshape(len(text), len(shape("")))
        return pd.Series(1 / (1 + np.exp(-Logistic(*parts).log_odds(x))))

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(host, F.lit("")).alias("host"),
        F.coalesce(path, F.lit("")).alias("path"),
        own("text").alias("own"),
    )
    rows, _ = materialise(rows, "quality")
    sums = [F.count(F.lit(1)).alias("n"), F.sum("own").alias("s"), F.sum(F.col("own") ** 2).alias("ss")]
    paths, _ = materialise(rows.groupBy("host", "path").agg(*sums), "quality-paths")
    hosts = paths.groupBy("host").agg(*[F.sum(c).alias(c) for c in ("n", "s", "ss")])
    whole = hosts.agg(F.sum("n").alias("n"), F.sum("s").alias("s")).first()
    total = (whole["s"] or 0.0) / (whole["n"] or 1)
    hosts = hosts.withColumn("total", F.lit(total))
    strength = _strength(hosts, "total")
    host_mean = (F.col("s") + strength * total) / (F.col("n") + strength)
    paths = paths.join(hosts.select("host", host_mean.alias("host_mean")), "host")
    strength = _strength(paths, "host_mean")
    joined = rows.join(paths.select("host", "path", "n", "s", "host_mean"), ["host", "path"])
    others = (F.col("s") - F.col("own") + strength * F.col("host_mean")) / (F.col("n") - 1 + strength)
    joined = joined.withColumn("path_mean", others)
    odds = _log_odds(F.col("own")) + SITE_WEIGHT * (
        _log_odds(F.col("path_mean")) - _log_odds(F.lit(total))
    )
    return joined.select(
        "doc_id", "host", "path", "own", "path_mean", (1 / (1 + F.exp(-odds))).alias("score")
    )
