"""SimHash near-dedup: fingerprints, links between those few bits apart, and their components.

Equal fingerprints are one node.  Two fingerprints that differ in at most b bits agree in one of
b + 1 parts of their bits, so each is dealt to one small bucket per part; a part value that very
many share gets blocks of its own, each pair of blocks a task.  In a task the distances to a table
of reference fingerprints (Walsh codes) are worked out once; by the triangle inequality a pair whose
distances to one reference differ by more than b is further apart than b, so the largest difference
over the references discards nearly all pairs and the bits of the rest are compared.  A task gives
back one link per node at most, towards the smallest node of its own components.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import components, groups_for, local_components
from ledgerloom.session import materialise

SEED = 42
#: Fingerprints in a bucket, and those with one part value from which it gets blocks of its own.
BUCKET, BLOCK = 1024, 768
#: Pairs looked at together.
PAIRS = 1 << 19
#: References: bit i of code s is the parity of the bits of i & s.
PIVOTS = np.array(
    [sum(((i & s).bit_count() & 1) << i for i in range(64)) for s in (*range(1, 64, 3), 2, 5, 63)],
    dtype=np.uint64,
)


def fingerprint(text: str, shingle: int) -> int:
    """SimHash of the whole text over word shingles, repeats included."""
    # bytes.lower changes A-Z alone, bytes.split cuts at blank, tab to carriage return
    words = text.encode("utf-8").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.append(0, ends[:-1] + 1)
    width = min(shingle, len(words))
    total, counts = len(words) - width + 1, np.zeros(64, np.int64)
    for at in range(0, total, 1 << 16):
        upto = min(total, at + (1 << 16))
        a, b = starts[at:upto].tolist(), ends[at + width - 1 : upto + width - 1].tolist()
        hashes = np.fromiter(
            [xxhash.xxh64_intdigest(joined[i:j], SEED) for i, j in zip(a, b, strict=True)],
            "<u8",
            upto - at,
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, key: Column | None = None) -> DataFrame:
    """doc_id, fp (the fingerprint as a signed long) and row_key per row; a null text counts as empty.

    `key` (long) names a row; without one it is null.
    """

    def hashed(batches):
        for batch in batches:
            texts = batch.column(1)
            fps = np.fromiter((fingerprint(t.as_py() or "", shingle) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(fps.view(np.int64)), batch.column(2)],
                ["doc_id", "fp", "row_key"],
            )

    key = (F.lit(None) if key is None else key).cast("long").alias("row_key")
    return docs.select(F.col("doc_id").cast("long"), "text", key).mapInArrow(
        hashed, "doc_id long, fp long, row_key long"
    )


def _near(fps: np.ndarray, table: np.ndarray, a: np.ndarray, b: np.ndarray, bits: int):
    """The pairs (a, b) whose distances to every reference are close and that are near."""
    for pivot in range(len(PIVOTS)):
        close = np.abs(table[pivot, a] - table[pivot, b]) <= bits
        a, b = a[close], b[close]
    near = np.bitwise_count(fps[a] ^ fps[b]) <= bits
    return a[near], b[near]


def _pairs(starts: np.ndarray, lengths: np.ndarray):
    """All pairs of places within runs, in chunks of a bounded size."""
    for start, length in zip(starts.tolist(), lengths.tolist(), strict=True):
        if length > 64:
            step = max(1, PAIRS // length)
            for at in range(0, length, step):
                i = np.arange(at, min(length, at + step))
                a, b = np.repeat(i, length), np.tile(np.arange(length), len(i))
                yield start + a[a < b], start + b[a < b]
    for length in np.unique(lengths[(lengths > 1) & (lengths <= 64)]).tolist():
        i, j = np.triu_indices(length, 1)
        runs, step = starts[lengths == length], max(1, PAIRS // len(i))
        for at in range(0, len(runs), step):
            part = runs[at : at + step, None]
            yield (part + i).ravel(), (part + j).ravel()


def _link(bits: int):
    def linked(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["value", "fp"], ignore_index=True)
        fps = pdf["fp"].to_numpy(np.int64).view(np.uint64)
        table = np.bitwise_count(fps[None, :] ^ PIVOTS[:, None]).astype(np.int8)
        left = pdf["own"].to_numpy() == pdf["p"].to_numpy()
        if pdf["p"].iloc[0] != pdf["q"].iloc[0]:  # two blocks of one value: pairs across
            i, j = np.flatnonzero(left), np.flatnonzero(~left)
            step = max(1, PAIRS // max(1, len(j)))
            chunks = (
                (np.repeat(part := i[at : at + step], len(j)), np.tile(j, len(part)))
                for at in range(0, len(i), step)
            )
        else:
            value = pdf["value"].to_numpy()
            starts = np.flatnonzero(np.append(True, value[1:] != value[:-1]))
            chunks = _pairs(starts, np.diff(np.append(starts, len(value))))
        label = np.arange(len(fps))
        for a, b in chunks:
            a, b = _near(fps, table, a, b, bits)
            if len(a):
                found = local_components(len(fps), np.append(a, np.arange(len(fps))), np.append(b, label))
                label = found
        linked = label != np.arange(len(fps))
        own = fps.view(np.int64)
        return pd.DataFrame({"a": own[linked], "b": own[label[linked]]})

    return linked


def links(nodes: DataFrame, count: int, bits: int = 3) -> DataFrame:
    """Links (a, b) between distinct fingerprints `fp` that join all pairs at most `bits` apart."""
    parts = bits + 1
    edges = [64 * p // parts for p in range(parts + 1)]
    values = F.array(
        *[
            F.shiftrightunsigned(F.col("fp"), lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1))
            for lo, hi in zip(edges, edges[1:], strict=False)
        ]
    )
    rows = nodes.select("fp", F.posexplode(values).alias("part", "value"))
    heavy = (
        rows.groupBy("part", "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > BLOCK)
        .select("part", "value", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    )
    buckets = groups_for(count, BUCKET)
    rows = rows.join(heavy, ["part", "value"], "left").withColumn(
        "own", F.when(F.col("blocks").isNotNull(), F.pmod(F.xxhash64("fp"), "blocks")).otherwise(0)
    )
    others = F.when(F.col("blocks").isNotNull(), F.sequence(F.lit(0), F.col("blocks") - 1))
    rows = rows.withColumn("other", F.explode(F.coalesce(others, F.array(F.lit(0)))))
    rows = rows.select(
        "fp",
        "part",
        "value",
        F.col("own").cast("int").alias("own"),
        F.least(F.col("own").cast("int"), "other").alias("p"),
        F.greatest(F.col("own").cast("int"), "other").alias("q"),
        F.when(F.col("blocks").isNotNull(), -1 - F.col("value"))
        .otherwise(F.pmod(F.xxhash64("value"), F.lit(buckets)))
        .alias("bucket"),
    )
    return rows.groupBy("part", "bucket", "p", "q").applyInPandas(_link(bits), "a long, b long")


def near_duplicates(
    docs: DataFrame, shingle: int = 3, bits: int = 3, key: Column | None = None
) -> DataFrame:
    """doc_id, fp, component_id (smallest doc_id that links lead to, itself included), component (a
    number of the same group that it also has without any doc_id) and row_key (`key`) per row.

    Texts without words have fingerprint zero and link like any other.  Rows without a doc_id take
    part but name no component; one of such rows only has a null component_id.  Repeated rows are
    equal fingerprints.  An empty table gives an empty result.
    """
    found, _ = materialise(fingerprints(docs, shingle, key), "fingerprints")
    nodes = found.groupBy("fp").agg(F.min("doc_id").alias("first_doc"))
    nodes, seen = materialise(nodes, "fingerprint-nodes", n=F.count(F.lit(1)))
    stars = components(links(nodes, seen["n"], bits), "simhash")
    named = nodes.join(stars, nodes["fp"] == stars["node"], "left").select(
        "fp", "first_doc", F.coalesce("component", "fp").alias("component")
    )
    smallest = named.groupBy("component").agg(F.min("first_doc").alias("component_id"))
    named = named.join(smallest, "component").select("fp", "component_id", "component")
    return found.join(named, "fp").select("doc_id", "fp", "component_id", "component", "row_key")
