"""Toxicity: a factorisation machine over hashed terms.

A text's features are its distinct words and their first four and five letters, hashed; the score is
a bias, a weight for each feature and the inner products of the factors of every pair of them, so
that two terms that are harmless alone can count together.  It is fitted on a bounded sample of
labelled documents (`sample` rows, by a hash of doc_id) and applied to every whole text.

A null or empty text has no features and scores by the bias.  Rows that repeat a document are scored each
for itself, and train each for itself under the label of their doc_id.  An empty table gives an empty
result; without labels of both kinds every text scores low.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType

#: Hashed features; 9 floats each, so that a model is under 10 MB.
BITS, FACTORS = 18, 8
SAMPLE, EPOCHS, BATCH = 12_000, 20, 128
#: A feature has factors if so many documents of the sample have it, and a weight of its own if also
#: its rate among toxic ones is so many standard deviations off.
MIN_DOCS, MIN_DEVIATION = 4, 4.0
#: Of the factors: spread at the start, learning rate, shrinkage.
SPREAD, RATE, SHRINK = 0.003, 0.03, 1e-3
#: Share of the sample that judges the factors, how much lower they must make its loss, epochs without
#: that until they are given up.
VALIDATION, GAIN, PATIENCE = 0.2, 0.01, 10
_WORDS = re.compile(r"[^\W\d_]+")


def features(text: str) -> np.ndarray:
    """Hashed features of a text, each once, ascending."""
    words = set(_WORDS.findall(text.lower()))
    terms = words | {w[:4] + "*" for w in words if len(w) > 4} | {w[:5] + "*" for w in words if len(w) > 5}
    mask = (1 << BITS) - 1
    return np.array(sorted({zlib.crc32(t.encode()) & mask for t in terms}), dtype=np.int32)


@F.pandas_udf(ArrayType(IntegerType()))
def _features(text: pd.Series) -> pd.Series:
    return pd.Series([features(t or "") for t in text])


def held_out(doc_id: Column) -> Column:
    """Rows kept for testing: crc32 of the id as text divisible by 5.  A null id is not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """features and y of at most `sample` labelled documents that are not held out.

    Of repeated labels of a document the highest counts.  The choice is by hash, so that it does not
    depend on the order of rows.
    """
    known = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .where(~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").cast("long").alias("label_id"))
        .agg(F.max("toxic").cast("double").alias("y"))
    )
    share = 0.95 * sample / max(1, known.count())
    if share < 1:  # by hash a little less than asked for, so that the limit has nothing to cut
        part = F.pmod(F.xxhash64("label_id"), F.lit(1_000_000))
        known = known.where(part < F.lit(int(share * 1_000_000)))
    texts = docs.select(F.col("doc_id").cast("long").alias("label_id"), "text")
    return known.join(texts, "label_id").select(
        "label_id", "y", _features("text").alias("features")
    ).limit(sample)


class FactorisationMachine:
    """Weights of a fitted model: bias, w (2^BITS) and v (2^BITS by FACTORS)."""

    def __init__(self, bias: float, w: np.ndarray, v: np.ndarray):
        self.bias, self.w, self.v = bias, w, v

    def score(self, found: np.ndarray) -> float:
        if not len(found):
            z = self.bias
        else:
            v = self.v[found]
            pairs = 0.5 * float((v.sum(axis=0) ** 2 - (v * v).sum(axis=0)).sum())
            z = self.bias + float(self.w[found].sum()) + pairs
        return float(1.0 / (1.0 + np.exp(-min(30.0, max(-30.0, z)))))


class _Samples:
    """Labelled rows over the features that have factors, with the steps of AdaGrad on log loss."""

    def __init__(self, rows: list[tuple[np.ndarray, float]], active: np.ndarray, alone: np.ndarray):
        place = np.full(1 << BITS, -1, np.int32)
        place[active] = np.arange(len(active))
        self.sets = [p[p >= 0] for p in (place[f] for f, _ in rows)]
        self.y = np.array([t for _, t in rows])
        self.alone = alone

    def _batch(self, part: np.ndarray):
        lengths = np.array([len(self.sets[i]) for i in part])
        idx = np.concatenate([self.sets[i] for i in part]) if len(part) else np.zeros(0, np.int32)
        return idx, np.repeat(np.arange(len(part)), lengths), lengths

    def linear(self, part: np.ndarray, bias: float, w: np.ndarray) -> np.ndarray:
        idx, seg, _ = self._batch(part)
        return bias + np.bincount(seg, w[idx], len(part))

    def pairs(self, part: np.ndarray, v: np.ndarray):
        """What the factors add to each row, and the sums of the factors."""
        idx, seg, lengths = self._batch(part)
        some, starts = lengths > 0, np.cumsum(lengths) - lengths
        rows_v = v[idx]
        s = np.zeros((len(part), FACTORS), np.float32)
        if len(idx):
            s[some] = np.add.reduceat(rows_v, starts[some], axis=0)
        q = np.bincount(seg, (rows_v * rows_v).sum(axis=1), len(part))
        return 0.5 * ((s * s).sum(axis=1) - q), s, rows_v, idx, seg

    def loss(self, z: np.ndarray, part: np.ndarray) -> float:
        z = np.clip(z, -30, 30) * np.where(self.y[part] > 0, -1, 1)
        return float(np.logaddexp(0, z).mean()) if len(part) else 0.0

    def fit_weights(self, part: np.ndarray, bias: float, rng) -> tuple[float, np.ndarray]:
        w = np.zeros(len(self.alone))
        squares, square = np.full(len(w), 1e-2), 1e-2
        for _ in range(EPOCHS):
            order = rng.permutation(part)
            for at in range(0, len(order), BATCH):
                some = order[at : at + BATCH]
                idx, seg, _ = self._batch(some)
                p = 1 / (1 + np.exp(-np.clip(bias + np.bincount(seg, w[idx], len(some)), -30, 30)))
                g = (p - self.y[some]) / len(some)
                square += g.sum() ** 2
                bias -= 0.2 * g.sum() / np.sqrt(square)
                grad = np.bincount(idx, g[seg], len(w)) + 1e-5 * w
                touched = np.flatnonzero(np.bincount(idx, minlength=len(w)).astype(bool) & self.alone)
                squares[touched] += grad[touched] ** 2
                w[touched] -= 0.2 * grad[touched] / np.sqrt(squares[touched])
        return float(bias), w

    def fit_factors(self, part: np.ndarray, z: np.ndarray, rng):
        """Epoch by epoch the factors, on top of the scores z that the rows have without them."""
        v = rng.normal(0, SPREAD, (len(self.alone), FACTORS)).astype(np.float32)
        squares = np.full(v.shape, 1e-2, np.float32)
        place = np.full(len(self.y), -1)
        place[part] = np.arange(len(part))
        for _ in range(EPOCHS):
            order = rng.permutation(part)
            for at in range(0, len(order), BATCH):
                some = order[at : at + BATCH]
                added, s, rows_v, idx, seg = self.pairs(some, v)
                if not len(idx):
                    continue
                p = 1 / (1 + np.exp(-np.clip(z[place[some]] + added, -30, 30)))
                g = (p - self.y[some]) / len(some)
                by = np.argsort(idx, kind="stable")
                touched, first = np.unique(idx[by], return_index=True)
                pull = g.astype(np.float32)[seg, None] * (s[seg] - rows_v)
                grad = np.add.reduceat(pull[by], first, axis=0) + np.float32(SHRINK) * v[touched]
                squares[touched] += grad**2
                v[touched] -= np.float32(RATE) * grad / np.sqrt(squares[touched])
            yield v


def fit(rows: list[tuple[np.ndarray, float]], seed: int = 7) -> FactorisationMachine:
    """Fit on log loss; without rows every text scores low.

    Weights first, of terms that tell something alone; then factors of all terms on top of them, on four
    fifths of the rows.  The other fifth says after how many epochs the factors helped most, if they help:
    if not there are none, and the model is its linear part.  At last all rows are fitted that long.
    """
    size, rng = 1 << BITS, np.random.default_rng(seed)
    positive = sum(y for _, y in rows)
    bias = float(np.log((positive + 0.1) / (len(rows) - positive + 0.9)))
    w, v = np.zeros(size, np.float32), np.zeros((size, FACTORS), np.float32)
    if not rows or positive in (0, len(rows)):
        return FactorisationMachine(bias, w, v)
    df, toxic = np.zeros(size), np.zeros(size)
    for f, y in rows:
        df[f] += 1
        toxic[f] += y
    rate = positive / len(rows)
    deviation = (toxic - df * rate) / np.sqrt(np.maximum(df, 1) * rate * (1 - rate))
    active = np.flatnonzero(df >= MIN_DOCS)
    # signal alone counts for the weight only: a pair may tell what neither of its terms does
    samples = _Samples(rows, active, np.abs(deviation[active]) >= MIN_DEVIATION)
    every = np.arange(len(rows))
    asked = rng.random(len(rows)) < VALIDATION
    trained, held = every[~asked], every[asked]
    own_bias, own = samples.fit_weights(trained, bias, rng)
    z, z_held = (samples.linear(part, own_bias, own) for part in (trained, held))
    best, epochs, worse = samples.loss(z_held, held) * (1 - GAIN), 0, 0
    for epoch, factors in enumerate(samples.fit_factors(trained, z, rng), start=1):
        loss = samples.loss(z_held + samples.pairs(held, factors)[0], held)
        if loss < best:
            best, epochs, worse = loss, epoch, 0
        else:
            worse += 1
        if worse > PATIENCE:
            break
    bias, weights = samples.fit_weights(every, bias, rng)
    w[active] = weights
    if epochs:
        growing = samples.fit_factors(every, samples.linear(every, bias, weights), rng)
        *_, factors = (f for f, _ in zip(growing, range(epochs), strict=False))
        v[active] = factors
    return FactorisationMachine(float(bias), w, v)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> FactorisationMachine:
    rows = training_rows(docs, labels, sample).toArrow()
    pairs = [
        (np.asarray(f, np.int32), y)
        for _, y, f in sorted(
            zip(
                rows.column("label_id").to_pylist(),
                rows.column("y").to_pylist(),
                (x.values.to_numpy(zero_copy_only=False) for x in rows.column("features")),
                strict=True,
            ),
            key=lambda r: (r[0], r[2].tobytes()),
        )
    ]
    return fit(pairs)


def scores(docs: DataFrame, model: FactorisationMachine, text: str = "text") -> Column:
    """Probability (0 to 1) that a text of the column is toxic; a null text counts as empty."""
    shared = docs.sparkSession.sparkContext.broadcast((model.bias, model.w, model.v))

    @F.pandas_udf(DoubleType())
    def score(texts: pd.Series) -> pd.Series:
        machine = FactorisationMachine(*shared.value)
        return pd.Series([machine.score(features(t or "")) for t in texts], dtype="float64")

    return score(F.col(text))
