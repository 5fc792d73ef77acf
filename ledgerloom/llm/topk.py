"""Exact top-k search by inner product over integer vectors.

Vectors are rotated onto the principal axes of a sample, so that the first coordinates carry most of
an inner product, and kept in order of falling length.  Queries are taken in blocks of a bounded
size: a block and, for each of its queries, the k-th best score among the longest vectors go to all
tasks.  A task takes its vectors in slices.  A slice whose longest vector cannot reach a query's
score (Cauchy-Schwarz) is skipped for it; otherwise partial sums over the first coordinates plus the
product of the lengths of what is left bound each score, ever more coordinates for the pairs still
open.  Only pairs that no bound excludes get their exact integer score, and a task's own k-th best
raises the bar for its next slice.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import groups_for
from ledgerloom.session import materialise

#: Queries sent out together, vectors in a slice, rows for the rotation, longest vectors tried first.
QUERY_BLOCK, SLICE, ROTATION_ROWS, SEED_ROWS = 2048, 1024, 20_000, 2048
#: Part of the coordinates summed before each test.
STEPS = (0.25, 0.5, 0.75)


def finite(vector: Column) -> Column:
    """Whether a vector is there, with all its components, and each of them finite."""
    infinite = F.lit(float("inf"))
    good = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < infinite),
    )
    return F.coalesce(vector.isNotNull() & good, F.lit(False))


def integer_vectors(embeddings: DataFrame, scale: int = 1024) -> DataFrame:
    """vec_id, v (floor of each component times `scale`) and norm of the usable vectors.

    Rows without a vec_id take no part.  Of rows that repeat a vec_id the smallest vector counts.
    """
    v = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long"))
    rows = embeddings.where(F.col("vec_id").isNotNull() & finite(F.col("embedding")))
    rows = rows.groupBy(F.col("vec_id").cast("long").alias("vec_id")).agg(F.min(v).alias("v"))
    squares = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    return rows.withColumn("norm", F.sqrt(squares))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column as a matrix, shorter ones filled with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths == dim).all():
        return flat.reshape(-1, dim)
    out = np.zeros((len(lengths), dim), flat.dtype if len(flat) else np.int64)
    out[np.arange(dim)[None, :] < lengths[:, None]] = flat
    return out


class _Block:
    """Queries with their rotated coordinates and the best found for each so far."""

    def __init__(self, ids: np.ndarray, q: np.ndarray, rotation: np.ndarray, k: int):
        self.ids, self.q, self.rotation, self.k = ids, q, rotation, k
        self.r = q @ rotation
        self.norm = np.linalg.norm(self.r, axis=1)
        self.bar = np.full(len(ids), -np.inf)
        self.kept = [np.zeros(0, np.int64)] * 3  # query, score, vec_id

    def offer(self, ids: np.ndarray, v: np.ndarray) -> None:
        r = v @ self.rotation
        norms = np.linalg.norm(r, axis=1)
        slack = 1e-9 * (1 + self.norm * norms.max(initial=0.0))
        live = np.flatnonzero(self.norm * norms.max(initial=0.0) >= self.bar - slack)
        if not len(live) or not len(ids):
            return
        cuts = [0, *sorted({max(1, int(s * r.shape[1])) for s in STEPS if r.shape[1] > 1})]
        pairs, partial = None, None
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            rest_q = np.linalg.norm(self.r[live, hi:], axis=1)
            rest_v = np.linalg.norm(r[:, hi:], axis=1)
            if pairs is None:
                partial = self.r[live, :hi] @ r[:, :hi].T
                open_ = partial + rest_q[:, None] * rest_v >= (self.bar - slack)[live, None]
                pairs = np.nonzero(open_)
                partial = partial[pairs]
            else:
                a, b = pairs
                partial = partial + np.einsum("ij,ij->i", self.r[live[a], lo:hi], r[b, lo:hi])
                open_ = partial + rest_q[a] * rest_v[b] >= (self.bar - slack)[live[a]]
                pairs, partial = (a[open_], b[open_]), partial[open_]
        if pairs is None:
            pairs = np.nonzero(np.ones((len(live), len(ids)), bool))
        a, b = live[pairs[0]], pairs[1]
        other = self.ids[a] != ids[b]
        a, b = a[other], b[other]
        score = np.concatenate(
            [np.zeros(0, np.int64)]
            + [
                np.einsum("ij,ij->i", self.q[a[i : i + 65536]], v[b[i : i + 65536]])
                for i in range(0, len(a), 65536)
            ]
        )
        good = score >= self.bar[a]
        found = zip(self.kept, (a[good], score[good], ids[b[good]]), strict=True)
        query, score, vec = (np.concatenate(x) for x in found)
        order = np.lexsort((vec, -score, query))
        query, score, vec = query[order], score[order], vec[order]
        first = np.searchsorted(query, query)
        top = np.arange(len(query)) - first < self.k
        self.kept = [query[top], score[top], vec[top]]
        query, score, _ = self.kept
        counts = np.bincount(query, minlength=len(self.ids))
        full = np.flatnonzero(counts >= self.k)
        last = np.searchsorted(query, full, side="right") - 1
        self.bar[full] = np.maximum(self.bar[full], score[last])


def top_k(vectors: DataFrame, is_query: Column, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest inner products of each query with other vectors.

    `vectors` has vec_id, v and norm as `integer_vectors` gives them; a query's own vec_id is no
    candidate.  Ties go to the smaller vec_id; with fewer than k others all are returned.  Vectors
    of different lengths count as filled up with zeros.  An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    vectors, seen = materialise(
        vectors.repartition(F.col("vec_id")).sortWithinPartitions(F.desc("norm"), "vec_id"),
        "topk-vectors",
        n=F.count(F.lit(1)),
        queries=F.count(F.when(is_query, 1)),
        dim=F.max(F.size("v")),
    )
    dim, schema = seen["dim"] or 0, "query_id long, score long, vec_id long"
    part = F.pmod(F.xxhash64("vec_id"), F.lit(1_000_000))
    share = min(1.0, ROTATION_ROWS / max(1, seen["n"]))
    sample = vectors.where(part < F.lit(int(share * 1_000_000))).limit(ROTATION_ROWS)
    rows = _matrix(sample.select("v").toArrow().column(0), dim).astype(np.float64)
    rotation = np.linalg.eigh(rows.T @ rows)[1][:, ::-1] if dim else np.zeros((0, 0))
    seeds = vectors.orderBy(F.desc("norm"), "vec_id").limit(SEED_ROWS).toArrow()
    seed_ids, seed_v = seeds.column("vec_id").to_numpy(), _matrix(seeds.column("v"), dim)
    blocks, found = groups_for(seen["queries"], QUERY_BLOCK), []
    for number in range(blocks):
        chosen = vectors.where(is_query & (F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == number))
        taken = chosen.select("vec_id", "v").toArrow()
        ids, q = taken.column("vec_id").to_numpy(), _matrix(taken.column("v"), dim)
        first = _Block(ids, q, rotation, k)
        for at in range(0, len(seed_ids), SLICE):
            first.offer(seed_ids[at : at + SLICE], seed_v[at : at + SLICE])
        shared = spark.sparkContext.broadcast((ids, q, rotation, first.bar))

        def search(batches, shared=shared):
            ids, q, rotation, bar = shared.value
            block = _Block(ids, q, rotation, k)
            block.bar = bar.copy()
            for batch in batches:
                for at in range(0, batch.num_rows, SLICE):
                    part = batch.slice(at, SLICE)
                    block.offer(part.column(0).to_numpy(), _matrix(part.column(1), dim))
            query, score, vec = block.kept
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[query]), pa.array(score), pa.array(vec)],
                ["query_id", "score", "vec_id"],
            )

        hits = vectors.select("vec_id", "v").mapInArrow(search, schema)
        best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        hits = hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        found.append(materialise(hits.select("query_id", "rank", "vec_id", "score"), "topk")[0])
        shared.destroy()
    result = found[0]
    for part in found[1:]:
        result = result.union(part)
    return result
