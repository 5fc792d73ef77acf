"""Embedding near-dedup through a robust-pruned flat graph.

Equal vectors of a label are one node with a weight.  Nodes are dealt to shards by cluster centres
fitted on a bounded sample; a node is a member of its nearest clusters and of all whose boundary is
close, so that shards overlap.  In a shard, each node's nearest members are pruned so that its edges
lead in different directions; the edges a node gets in all its shards are put together.  Then every
node is searched for in its own cluster's shard: from the shard's medoid and its own place a greedy
search keeps the best nodes met, and every node in range is expanded too, until no new one is in
range.  What is found is verified by cosine in double precision.

Big shards are dealt into parts by hash, each with a graph of its own, and their queries into blocks;
a query looks in every part, so tasks stay of a bounded size and every member is met once.  A task
gives back counts and one link per node, not the pairs.  Recall is audited on a sample of nodes
against all vectors; below the target everything runs again with more overlap and a wider beam, at
last with the largest margin that a link can span and every member of a shard looked at, which finds
all links.  A result that misses the target even so is an error.  Half of the sample is drawn from the
nodes found linked; where none of it has a link, recall is unmeasured, and said to be.
"""

from __future__ import annotations

import logging
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import components, groups_for, local_components
from ledgerloom.llm.topk import _matrix, finite
from ledgerloom.session import materialise

_log = logging.getLogger(__name__)
#: Members aimed at in a shard, most centres over all labels (8 MB at 64 dimensions), rows they are
#: fitted on for each, members of a part and queries of a block.
SHARD, MAX_CENTRES, FIT_ROWS, PART, QUERY_BLOCK = 1000, 16_384, 24, 3000, 3000
#: Nearest clusters a node is a member of, distance to a cluster's boundary within which it is too.
OVERLAP, MARGIN = 2, 0.06
#: Rows times centres compared at once (16 MB each of a few arrays).
CELLS = 1 << 21
#: Candidates and edges of a node, how much shorter a detour must be to prune, beam of the search.
POOL, DEGREE, ALPHA, BEAM = 40, 20, 1.2, 24
AUDIT_ROWS, RECALL = 256, 0.98
#: Runs until the recall is reached, each twice as wide as the one before; the last one is exact.
ATTEMPTS = 3


def _unit(v: np.ndarray) -> np.ndarray:
    v = v.astype(np.float64)
    v = v / np.maximum(np.abs(v).max(axis=1, keepdims=True), 1e-300)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def usable(embeddings: DataFrame) -> DataFrame:
    """Rows whose label and vector can link: a label, and finite components that are not all zero."""
    some = F.exists("embedding", lambda x: x != 0)
    return embeddings.where(
        F.col("label").isNotNull() & F.col("vec_id").isNotNull() & finite(F.col("embedding"))
    ).where(some)


def nodes_of(embeddings: DataFrame) -> DataFrame:
    """label, vector, node (smallest vec_id) and weight of each distinct vector of a label."""
    vector = F.transform("embedding", lambda x: x.cast("double")).alias("vector")
    return (
        usable(embeddings)
        .groupBy("label", vector)
        .agg(F.min(F.col("vec_id").cast("long")).alias("node"), F.count(F.lit(1)).alias("weight"))
    )


def fit_centres(nodes: DataFrame, total: int, dim: int) -> dict:
    """Cluster centres (unit vectors) of the labels that need more than one."""
    sizes = nodes.groupBy("label").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > SHARD)
    target = max(SHARD, -(-total // MAX_CENTRES))
    wanted = sizes.select("label", F.ceil(F.col("n") / target).cast("int").alias("k"))
    part = F.pmod(F.xxhash64("node"), F.lit(1_000_000)) / 1_000_000
    sample = nodes.join(wanted, "label").where(part < F.lit(FIT_ROWS / target))
    rows = sample.select("label", "k", "node", "vector").limit(MAX_CENTRES * FIT_ROWS).toArrow()
    if not rows.num_rows:
        return {}
    labels, k = rows.column("label").to_pylist(), rows.column("k").to_numpy()
    unit, ids = _unit(_matrix(rows.column("vector"), dim)), rows.column("node").to_numpy()
    centres, labels = {}, np.array(labels, dtype=object)
    for label in sorted(set(labels.tolist()), key=str):
        own = np.flatnonzero(labels == label)
        own = own[np.argsort(ids[own], kind="stable")]
        points, count = unit[own], min(int(k[own[0]]), len(own))
        middle = points[np.linspace(0, len(own) - 1, count).astype(int)]
        step = max(1, CELLS // count)
        for _ in range(12):
            # in slices, so that memory does not grow with points times centres
            slices = (points[at : at + step] for at in range(0, len(points), step))
            nearest = np.concatenate([np.argmax(part @ middle.T, axis=1) for part in slices])
            sums = np.zeros_like(middle)
            np.add.at(sums, nearest, points)
            lengths = np.linalg.norm(sums, axis=1, keepdims=True)
            middle = np.where(lengths > 0, sums / np.maximum(lengths, 1e-12), middle)
        centres[label] = middle
    return centres


def _shards(
    unit: np.ndarray, middle: np.ndarray | None, overlap: int = OVERLAP, margin: float = MARGIN
) -> list[np.ndarray]:
    """Shards of each vector, its own cluster first.

    Rows go in slices, and distances between centres come from their inner products, so that memory
    is bounded by CELLS whatever the number of rows and centres.
    """
    if middle is None or len(middle) == 1:
        return [np.zeros(1, np.int32)] * len(unit)
    squares, out, step = (middle * middle).sum(axis=1), [], max(1, CELLS // len(middle))
    for at in range(0, len(unit), step):
        near = unit[at : at + step] @ middle.T
        rows, own = np.arange(len(near)), np.argmax(near, axis=1)
        gap = np.maximum(squares[own, None] + squares - 2 * (middle[own] @ middle.T), 0)
        # how far the vector is from the plane between its own centre and another; to centres nearer
        # to each other than the rounding of the inner products allows to tell it belongs anyway
        member = near[rows, own][:, None] - near <= margin * np.sqrt(gap)
        member |= gap < 1e-6
        if overlap < len(middle):
            first = np.argpartition(-near, overlap - 1, axis=1)[:, :overlap]
            member[rows[:, None], first] = True
        else:
            member[:] = True
        near[rows, own] = np.inf
        for line, has in zip(near, member, strict=True):
            found = np.flatnonzero(has)
            out.append(found[np.argsort(-line[found], kind="stable")].astype(np.int32))
    return out


def assign(
    nodes: DataFrame, centres: dict, dim: int, overlap: int = OVERLAP, margin: float = MARGIN
) -> DataFrame:
    """Each node once per shard it is a member of; `homes` are its shards, the first its own."""
    shared = nodes.sparkSession.sparkContext.broadcast(centres)
    schema = "label int, shard int, node long, weight long, vector array<double>, homes array<int>"

    def deal(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            labels = np.array(batch.column(0).to_pylist())
            unit = _unit(_matrix(batch.column(3), dim))
            homes: list = [None] * len(labels)
            for label in set(labels.tolist()):
                own = np.flatnonzero(labels == label)
                found = _shards(unit[own], shared.value.get(label), overlap, margin)
                for i, h in zip(own.tolist(), found, strict=True):
                    homes[i] = h
            times = np.array([len(h) for h in homes])
            at = np.repeat(np.arange(len(labels)), times)
            offsets = pa.array(np.arange(len(at) + 1, dtype=np.int32) * dim)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(labels[at], pa.int32()),
                    pa.array(np.concatenate(homes), pa.int32()),
                    batch.column(1).take(pa.array(at)),
                    batch.column(2).take(pa.array(at)),
                    pa.ListArray.from_arrays(offsets, pa.array(unit[at].ravel())),
                    pa.array([homes[i] for i in at], pa.list_(pa.int32())),
                ],
                ["label", "shard", "node", "weight", "vector", "homes"],
            )

    rows = nodes.select(F.col("label").cast("int"), "node", "weight", "vector")
    return rows.mapInArrow(deal, schema)


def prune(sims: np.ndarray, pool: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Robust pruning for many nodes at once: up to DEGREE of each node's pool, -1 filled.

    Candidates come nearest first; one that is taken removes those that are, by ALPHA, nearer to it
    than to the node.
    """
    count, width = pool.shape
    among = np.einsum("npd,nqd->npq", vectors[pool], vectors[pool], optimize=True)
    # distances on the unit sphere: sqrt(2 - 2 cos)
    own = np.sqrt(np.maximum(0, 2 - 2 * sims))
    between = ALPHA * np.sqrt(np.maximum(0, 2 - 2 * among))
    open_ = np.isfinite(sims)
    out = np.full((count, DEGREE), -1)
    rows = np.arange(count)
    for slot in range(min(DEGREE, width)):
        pick = np.argmax(open_, axis=1)
        some = open_[rows, pick]
        out[some, slot] = pool[rows[some], pick[some]]
        open_ &= ~(between[rows, pick] <= own) | ~some[:, None]
        open_[rows, pick] = False
    return out


def _build(pdf: pd.DataFrame) -> pd.DataFrame:
    """Edges of each member of a shard's part, by robust pruning of its nearest members."""
    vectors = np.stack(pdf["vector"].to_numpy())
    ids, count = pdf["node"].to_numpy(np.int64), len(pdf)
    width, edges = min(POOL, count - 1), [np.zeros(0, np.int64)] * count
    for at in range(0, count if width > 0 else 0, 256):
        near = vectors[at : at + 256] @ vectors.T
        rows = np.arange(len(near))
        near[rows, at + rows] = -np.inf
        pool = np.argpartition(-near, width - 1, axis=1)[:, :width]
        sims = np.take_along_axis(near, pool, axis=1)
        order = np.argsort(-sims, axis=1, kind="stable")
        pool, sims = np.take_along_axis(pool, order, axis=1), np.take_along_axis(sims, order, axis=1)
        for i, row in enumerate(prune(sims, pool, vectors)):
            edges[at + i] = ids[row[row >= 0]]
    return pd.DataFrame({"label": pdf["label"], "node": ids, "edges": edges})


def _search(cosine: float, beam: int | None):
    """Without a beam every member is looked at."""

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        member = pdf[pdf["is_member"]].reset_index(drop=True)
        asks = pdf[pdf["is_query"]]
        empty = pd.DataFrame({"node": [], "n": [], "met": [], "root": []}).astype("int64")
        if not len(member) or not len(asks):
            return empty
        ids, vectors = member["node"].to_numpy(np.int64), np.stack(member["vector"].to_numpy())
        weights, count = member["weight"].to_numpy(np.int64), len(member)
        order = np.argsort(ids)
        # union of the edges both ways, kept to the members here
        lengths = np.array([0 if e is None else len(e) for e in member["edges"]])
        heads = np.repeat(np.arange(count), lengths)
        tails = np.concatenate([e for e in member["edges"] if e is not None] or [np.zeros(0)])
        at = np.minimum(np.searchsorted(ids[order], tails), count - 1)
        here = ids[order][at] == tails
        heads, tails = heads[here], order[at[here]]
        both = np.unique(np.concatenate([heads * count + tails, tails * count + heads]).astype(np.int64))
        heads, tails = both // count, both % count
        first = np.searchsorted(heads, np.arange(count + 1))
        medoid = int(np.argmax(vectors @ vectors.mean(axis=0)))
        own_home = np.array([h[0] for h in member["homes"]])
        place = {n: i for i, n in enumerate(ids.tolist())}
        stamp = np.full(count, -1)
        found_a, found_b, counts, back = [], [], [], np.zeros((count, 2), np.int64)
        queries = asks["node"].to_numpy(np.int64)
        for number, (node, vector, homes, weight) in enumerate(
            zip(queries.tolist(), asks["vector"], asks["homes"], asks["weight"], strict=True)
        ):
            own = place.get(node, -1)
            front = np.array([medoid] if own in (-1, medoid) else [medoid, own])
            stamp[front] = number
            best, best_sims = front, vectors[front] @ vector
            expanded = np.zeros(len(front), bool)
            if beam is None:
                best, best_sims = np.arange(count), vectors @ vector
            while beam is not None:
                todo = ~expanded
                near = best_sims >= cosine - 0.002
                chosen = np.flatnonzero(todo & near)  # all in range, else the few best of the beam
                if not len(chosen):
                    chosen = np.flatnonzero(todo)[:4]
                if not len(chosen):
                    break
                expanded[chosen] = True
                spread = [tails[first[i] : first[i + 1]] for i in best[chosen].tolist()]
                new = np.unique(np.concatenate(spread))
                new = new[stamp[new] != number]
                if not len(new):
                    continue
                stamp[new] = number
                best = np.concatenate([best, new])
                best_sims = np.concatenate([best_sims, vectors[new] @ vector])
                expanded = np.concatenate([expanded, np.zeros(len(new), bool)])
                by = np.argsort(-best_sims, kind="stable")
                keep = by[: max(beam, int((best_sims >= cosine - 0.002).sum()))]
                best, best_sims, expanded = best[keep], best_sims[keep], expanded[keep]
            hits = best[(best_sims >= cosine) & (best != own)]
            counts.append((int(weights[hits].sum()), len(hits)))
            if len(hits):
                found_a.append(np.full(len(hits), number))
                found_b.append(hits)
                # members whose own shard does not hold this query are told of it
                outside = hits[~np.isin(own_home[hits], homes)]
                back[outside] += (int(weight), 1)
        # one link per node, towards the smallest of what it hangs together with here
        every = np.unique(np.concatenate([ids, queries]))
        a = np.searchsorted(every, queries[np.concatenate(found_a)]) if found_a else []
        b = np.searchsorted(every, ids[np.concatenate(found_b)]) if found_b else []
        label = local_components(len(every), np.asarray(a, int), np.asarray(b, int))
        total = np.zeros((len(every), 2), np.int64)
        np.add.at(total, np.searchsorted(every, queries), counts)
        np.add.at(total, np.searchsorted(every, ids), back)
        kept = (total[:, 0] > 0) | (label != np.arange(len(every)))
        return pd.DataFrame(
            {
                "node": every[kept],
                "n": total[kept, 0],
                "met": total[kept, 1],
                "root": every[label[kept]],
            }
        )

    return search


def _keyed(rows: DataFrame) -> DataFrame:
    """Members and queries of each shard by part and block of queries."""
    home = F.col("shard") == F.col("homes")[0]
    sizes = rows.groupBy("label", "shard").agg(
        F.ceil(F.count(F.lit(1)) / PART).cast("int").alias("parts"),
        F.greatest(F.lit(1), F.ceil(F.count(F.when(home, 1)) / QUERY_BLOCK)).cast("int").alias("blocks"),
    )
    return (
        rows.join(sizes, ["label", "shard"])
        .withColumn("own_part", F.pmod(F.xxhash64("node"), "parts").cast("int"))
        .withColumn("own_block", F.pmod(F.xxhash64("node", F.lit(1)), "blocks").cast("int"))
        .withColumn("home", home)
    )


def _links(rows: DataFrame, beam: int | None, cosine: float) -> DataFrame:
    """Per task and node: links by rows (n), by nodes (met), and the smallest node hung together with."""
    keyed = _keyed(rows)
    by_part = keyed.withColumn("part", F.col("own_part"))
    edges = (
        by_part.groupBy("label", "shard", "part")
        .applyInPandas(_build, "label int, node long, edges array<long>")
        .groupBy("label", "node")
        .agg(F.array_distinct(F.flatten(F.collect_list("edges"))).alias("edges"))
    )
    keyed = keyed.join(edges, ["label", "node"], "left")
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    members = keyed.withColumn("part", F.col("own_part")).withColumn("block", F.explode(every))
    members = members.withColumn("is_member", F.lit(True)).withColumn(
        "is_query", F.col("home") & (F.col("block") == F.col("own_block"))
    )
    others = F.filter(F.sequence(F.lit(0), F.col("parts") - 1), lambda p: p != F.col("own_part"))
    guests = (
        keyed.where("home")
        .withColumn("part", F.explode(others))
        .withColumn("block", F.col("own_block"))
        .withColumn("is_member", F.lit(False))
        .withColumn("is_query", F.lit(True))
        .withColumn("edges", F.lit(None).cast("array<bigint>"))
    )
    columns = "label shard part block node weight vector homes edges is_member is_query".split()
    rows = members.select(*columns).union(guests.select(*columns))
    return rows.groupBy("label", "shard", "part", "block").applyInPandas(
        _search(cosine, beam), "node long, n long, met long, root long"
    )


class Recall(NamedTuple):
    """What an audit found: the mean share of its links that a node has, None if no node of the sample
    has any, and the nodes it is the mean of."""

    share: float | None
    linked: int

    def missed(self) -> bool:
        return self.share is not None and self.share < RECALL

    def __str__(self) -> str:
        if self.share is None:
            return "recall unmeasured: no node of the sample has a link"
        return f"recall {self.share:.4f} over {self.linked} linked nodes"


def audit(nodes: DataFrame, found: DataFrame, cosine: float, total: int, dim: int) -> Recall:
    """Share found of the nodes that a node links with, among all of its label: the mean over a
    bounded sample of nodes, those without links left out.

    Half of the sample is drawn from all nodes, which also meets nodes whose every link is missed, half
    from those with a link, so that nodes with links are met however few they are.
    """
    linked = nodes.join(found.where("met > 0").select("node").distinct(), "node", "left_semi")
    linked, seen = materialise(linked, "vector-linked", n=F.count(F.lit(1)))
    part = F.pmod(F.xxhash64("node", F.lit(2)), F.lit(1_000_000))

    def drawn(of: DataFrame, count: int) -> DataFrame:
        share = min(1.0, AUDIT_ROWS / max(1, count))
        chosen = of.where(part < F.lit(max(1, int(share * 1_000_000)))).limit(2 * AUDIT_ROWS)
        return chosen.select("label", "node", "vector")

    rows = drawn(nodes, total).union(drawn(linked, seen["n"])).dropDuplicates(["node"]).toArrow()
    labels, ids = np.array(rows.column("label").to_pylist()), rows.column("node").to_numpy()
    unit = _unit(_matrix(rows.column("vector"), dim)) if len(ids) else np.zeros((0, dim))
    shared = nodes.sparkSession.sparkContext.broadcast((labels, ids, unit))

    def count(batches):
        labels, ids, unit = shared.value
        total = np.zeros(len(ids), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            near = unit @ _unit(_matrix(batch.column(3), dim)).T >= cosine
            near &= labels[:, None] == np.array(batch.column(0).to_pylist())[None, :]
            near &= ids[:, None] != batch.column(1).to_numpy()[None, :]
            total += near.sum(axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total)], ["node", "truth"])

    truth = nodes.select("label", "node", "weight", "vector").mapInArrow(count, "node long, truth long")
    truth = truth.groupBy("node").agg(F.sum("truth").alias("truth"))
    got = found.groupBy("node").agg(F.sum("met").alias("met"))
    share = F.least("truth", F.coalesce("met", F.lit(0))) / F.col("truth")
    judged = truth.where(F.col("truth") > 0).join(got, "node", "left")
    mean, count = judged.agg(F.avg(share), F.count(F.lit(1))).first()
    shared.destroy()
    return Recall(mean, count)


def near_duplicates(
    embeddings: DataFrame, cosine: float = 0.98, audits: list[Recall] | None = None
) -> DataFrame:
    """vec_id, n_links, component_id and kept per row of `embeddings`.

    What the audit of each run found is logged, and added to `audits` where that is given.

    Rows without a label or with a vector that is null, zero or not finite throughout link with
    nothing and are components of their own; a row without a vec_id has a null component_id and is
    kept.  Repeated rows are equal vectors and link with each other.
    """
    nodes, seen = materialise(
        nodes_of(embeddings), "vector-nodes", n=F.count(F.lit(1)), dim=F.max(F.size("vector"))
    )
    total, dim = seen["n"], seen["dim"] or 0
    audits = [] if audits is None else audits
    centres = fit_centres(nodes, total, dim)
    # linked vectors are at most this far apart, so that within it of the plane none is missed
    reach = float(np.sqrt(max(0.0, 2 - 2 * cosine))) + 1e-9
    for attempt in range(ATTEMPTS):
        last, wider = attempt == ATTEMPTS - 1, 1 << attempt
        margin = reach if last else min(reach, MARGIN * wider)
        dealt = assign(nodes, centres, dim, OVERLAP * wider, margin)
        rows, _ = materialise(dealt, "vector-shards")
        found, _ = materialise(_links(rows, None if last else BEAM * wider, cosine), "vector-links")
        recall = audit(nodes, found, cosine, total, dim)
        audits.append(recall)
        _log.info("near-duplicate vectors, run %d: %s", attempt + 1, recall)
        if not recall.missed():
            break
    else:
        raise RuntimeError(f"near-duplicate links: {recall}, below {RECALL}")
    stars = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")), "vectors")
    counts = found.groupBy("node").agg(F.sum("n").alias("n"))
    classes = (
        nodes.join(counts, "node", "left")
        .join(stars, "node", "left")
        .select(
            F.col("label").alias("node_label"),
            "vector",
            (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("links"),
            F.coalesce("component", "node").alias("component"),
        )
    )
    vector = F.transform("embedding", lambda x: x.cast("double"))
    key = F.when(F.col("vec_id").isNotNull(), vector).alias("own_vector")
    ids = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "label", key)
    same = (F.col("label") == F.col("node_label")) & (F.col("own_vector") == F.col("vector"))
    joined = ids.join(classes, same, "left")
    return joined.select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"),
    ).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
