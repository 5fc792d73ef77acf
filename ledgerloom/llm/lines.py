"""Line dedup: lines that many documents share go from all of them but one.

The distinct keys of long lines are counted by an aggregate.  Those that enough documents hold are
dealt into shards by hash; each shard becomes one row with a minimal perfect hash (levels of
collision-free bits) over the key hashes and, in the order it gives, a fingerprint, a document
count and the document that keeps the line.  The key hashes of the documents probe these arrays:
they meet a shard in groups of a bounded size, salted by document, so that a line held by a third of
all documents is spread over many groups.  Only the keys a document loses come back to its text.

A null text is one empty line.  Rows that repeat a doc_id belong to one document; rows without a
doc_id form one document that is smaller than all others.  An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ledgerloom.llm.common import groups_for
from ledgerloom.session import materialise

BLANKS = " \t\n\x0b\x0c\r"
SHARD_KEYS = 200_000
GROUP_PROBES = 100_000
#: Bits for each key of a level, and levels before the few keys left are listed.
GAMMA, LEVELS = 2.0, 40
_NO_ID = -(1 << 63)


def line_keys(line: str) -> str:
    """The key of a line: blanks stripped at both ends, A-Z in lower case."""
    key = line.strip(BLANKS)
    return key.lower() if key.isascii() else key.encode("utf-8").lower().decode("utf-8")


def _hashes(text: str, min_chars: int) -> list[bytes | None]:
    """128-bit hash of each line's key, None for keys that are too short."""
    return [
        xxhash.xxh3_128_digest(line_keys(line)) if len(line.strip(BLANKS)) >= min_chars else None
        for line in text.split("\n")
    ]


def long_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """doc (long) and the two halves of the key hash (high, low), once per document row and key."""

    def split(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                ids, found = part.column(0).to_pylist(), bytearray()
                docs_out: list[int] = []
                for doc, text in zip(ids, part.column(1).to_pylist(), strict=True):
                    keys = set(_hashes(text or "", min_chars)) - {None}
                    found += b"".join(keys)
                    docs_out += [doc] * len(keys)
                halves = np.frombuffer(bytes(found), ">i8").astype(np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(docs_out, pa.int64()),
                        pa.array(halves[:, 0].copy()),
                        pa.array(halves[:, 1].copy()),
                    ],
                    ["doc", "high", "low"],
                )

    ids = F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID))
    return docs.select(ids, "text").mapInArrow(split, "doc long, high long, low long")


def _mix(keys: np.ndarray, level: int) -> np.ndarray:
    """A hash of 64-bit keys, another one for each level."""
    with np.errstate(over="ignore"):
        x = keys.view(np.uint64) + np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Numbers 0 to n - 1 for n distinct 64-bit keys.

    A level has a bit for each place that exactly one of its keys hashes to; the other keys go to
    the next level.  A key's number is the count of bits before its own.  Keys that were not given
    get any number or -1, so a caller compares a fingerprint.
    """

    def __init__(self, sizes: list[int], bits: bytes, rest: bytes):
        self.sizes = sizes
        self.bits = np.unpackbits(np.frombuffer(bits, np.uint8))[: sum(sizes)]
        self.rank = np.cumsum(self.bits) - self.bits
        self.rest = np.frombuffer(rest, np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> tuple[list[int], bytes, bytes]:
        sizes, levels, left = [], [], keys
        while len(left) and len(sizes) < LEVELS:
            size = max(8, int(len(left) * GAMMA))
            at = (_mix(left, len(sizes)) % np.uint64(size)).astype(np.int64)
            once = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            levels.append(once)
            left = left[~once[at]]
        bits = np.packbits(np.concatenate(levels) if levels else np.zeros(0, bool))
        return sizes, bits.tobytes(), np.sort(left).tobytes()

    def index(self, keys: np.ndarray) -> np.ndarray:
        out, open_, base = np.full(len(keys), -1), np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            at = (_mix(keys[open_], level) % np.uint64(size)).astype(np.int64) + base
            hit = self.bits[at] == 1
            out[open_[hit]] = self.rank[at[hit]]
            open_, base = open_[~hit], base + size
            if not len(open_):
                return out
        if len(self.rest) and len(open_):
            at = np.minimum(np.searchsorted(self.rest, keys[open_]), len(self.rest) - 1)
            hit = self.rest[at] == keys[open_]
            out[open_[hit]] = int(self.bits.sum()) + at[hit]
        return out


_SHARD = "shard long, sizes array<int>, bits binary, rest binary, prints binary, counts binary, keeps binary"


def _build_shard(pdf: pd.DataFrame) -> pd.DataFrame:
    # two keys that agree in the low half would share a number; the high half then tells them apart
    pdf = pdf.sort_values(["low", "high"])
    twin = pdf["low"].duplicated().to_numpy()
    main, parts = pdf[~twin], []
    while len(main):
        keys = main["low"].to_numpy(np.int64)
        sizes, bits, rest = PerfectHash.build(keys)
        order = np.argsort(PerfectHash(sizes, bits, rest).index(keys))
        arrays = [
            main[c].to_numpy(kind)[order].tobytes()
            for c, kind in (("high", np.int64), ("n", np.uint32), ("last", np.int64))
        ]
        parts.append([int(pdf["shard"].iloc[0]), sizes, bits, rest, *arrays])
        pdf = pdf[twin]
        twin = pdf["low"].duplicated().to_numpy()
        main = pdf[~twin]
    return pd.DataFrame(parts, columns=[c.split()[0] for c in _SHARD.split(", ")])


def line_index(lines: DataFrame, min_docs: int) -> tuple[DataFrame, int]:
    """The shards of the index over keys that at least `min_docs` documents hold, and their count."""
    counted = lines.groupBy("high", "low").agg(
        F.count_distinct("doc").alias("n"), F.max("doc").alias("last")
    )
    counted, seen = materialise(counted.where(F.col("n") >= min_docs), "lines", n=F.count(F.lit(1)))
    shards = groups_for(seen["n"], SHARD_KEYS)
    dealt = counted.withColumn("shard", F.pmod("high", F.lit(shards)))
    return dealt.groupBy("shard").applyInPandas(_build_shard, _SHARD), shards


def _probe(probes: pd.DataFrame, arrays: pd.DataFrame) -> pd.DataFrame:
    drop = np.zeros(len(probes), bool)
    low, high = probes["low"].to_numpy(np.int64), probes["high"].to_numpy(np.int64)
    doc = probes["doc"].to_numpy(np.int64)
    for row in arrays.itertuples():
        at = PerfectHash(list(row.sizes), row.bits, row.rest).index(low)
        known = at >= 0
        prints, keeps = np.frombuffer(row.prints, np.int64), np.frombuffer(row.keeps, np.int64)
        known[known] = prints[at[known]] == high[known]
        drop[known] |= keeps[at[known]] != doc[known]
    return probes.loc[drop, ["doc", "high", "low"]]


_REBUILT = StructType(
    [
        StructField("text", StringType()),
        StructField("n_lines", LongType()),
        StructField("n_dropped", LongType()),
    ]
)


@F.pandas_udf(_REBUILT)
def _rebuild(text: pd.Series, lost: pd.Series, min_chars: pd.Series) -> pd.DataFrame:
    rows = []
    for t, gone, least in zip(text, lost, min_chars, strict=True):
        t = t or ""
        if gone is None:
            rows.append((t, t.count("\n") + 1, 0))
            continue
        keys, parts = set(gone), t.split("\n")
        kept = [p for p, h in zip(parts, _hashes(t, int(least)), strict=True) if h not in keys]
        rows.append(("\n".join(kept), len(parts), len(parts) - len(kept)))
    return pd.DataFrame(rows, columns=["text", "n_lines", "n_dropped"])


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """The rows of `docs` as struct `row`, with `text` as it is without the lines it loses, n_lines
    before and n_dropped.

    A line goes if its key has at least `min_chars` code points and is found in at least `min_docs`
    documents, unless this document is the one with the largest doc_id among them.
    """
    lines, seen = materialise(long_lines(docs, min_chars), "line-hashes", n=F.count(F.lit(1)))
    index, shards = line_index(lines, min_docs)
    salts = groups_for(seen["n"], GROUP_PROBES * shards)
    index = index.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    probes = lines.withColumn("shard", F.pmod("high", F.lit(shards))).withColumn(
        "salt", F.pmod(F.xxhash64("doc"), F.lit(salts)).cast("int")
    )
    lost = (
        probes.groupBy("shard", "salt")
        .cogroup(index.groupBy("shard", "salt"))
        .applyInPandas(_probe, "doc long, high long, low long")
    )
    both = F.unhex(F.concat(F.lpad(F.hex("high"), 16, "0"), F.lpad(F.hex("low"), 16, "0")))
    lost = lost.groupBy(F.col("doc").alias("lost_doc")).agg(F.collect_set(both).alias("lost"))
    rows = docs.select(
        F.struct("*").alias("row"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("lost_doc"),
    )
    joined = rows.join(lost, "lost_doc", "left")
    rebuilt = _rebuild(F.col("row.text"), "lost", F.lit(min_chars))
    return joined.select("row", rebuilt.alias("out")).select("row", "out.*")
