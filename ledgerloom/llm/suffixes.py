"""Suffix-array dedup: remove every byte covered by a long string that also starts elsewhere.

All strings of `length` bytes of a text are split into runs that share an anchor, the leftmost
smallest hash of GRAM bytes in the string; equal strings have equal anchors, so only runs with the
same anchor can hold the same string.  A run whose whole segment occurs twice is repeated throughout;
an anchor that occurs once has nothing to share.  What is left are segments that occur once but share
their anchor with others, most of them at the ends of shared passages.  They are dealt by anchor into
shards of a bounded size.  A shard is one text with separators: its rotations are sorted as far as
`length` bytes matter, and from the Burrows-Wheeler transform intervals are extended backward breadth
first.  Level by level that gives the places in the order whose common prefix with the one before is
0, 1, 2, ... bytes; it stops at `length`, and places not reached have a common prefix that is long
enough.  An anchor with very many segments would not fit a shard; its strings are counted one by one
by their hashes, spread over all tasks.

Strings are bytes of UTF-8 and never cross texts.  A null text counts as empty.  Rows that repeat a
doc_id are texts of their own; rows that repeat both doc_id and text are copies of each other.  An
empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from ledgerloom.llm.common import groups_for
from ledgerloom.session import materialise

LENGTH, GRAM = 400, 64
#: Starts of a text looked at together, bytes of a shard, segments from which strings are counted.
CHUNK, SHARD_BYTES, HOT_SEGMENTS = 1 << 22, 1_000_000, 2000
_NO_ID = -(1 << 63)
_SEPARATOR = b"\xff"  # no byte of UTF-8


def _words(data: bytes, count: int) -> np.ndarray:
    """The 8 bytes from each of the first `count` places as big-endian numbers."""
    out = np.empty(count, np.uint64)
    for k in range(min(8, count)):
        places = len(range(k, count, 8))
        out[k::8] = np.frombuffer(data, ">u8", places, k)
    return out


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = a * np.uint64(0x9E3779B97F4A7C15) + b
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(32))


def _gram_hashes(data: bytes, count: int) -> np.ndarray:
    """A hash of the GRAM bytes from each of the first `count` places, doubled up from 8."""
    size, hashes = 8, _words(data, count + GRAM - 8)
    while size < GRAM:
        hashes = _mixed(hashes[: len(hashes) - size], hashes[size:])
        size *= 2
    return hashes


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each `width` neighbours."""
    count = len(values)
    padded = np.full(-(-count // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:count] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: count - width + 1], ahead[width - 1 : count])


def runs(data: bytes, length: int):
    """(first start, number of starts, anchor hash, segment hash) of each run of strings."""
    width = length - GRAM + 1
    for base in range(0, len(data) - length + 1, CHUNK):
        part = data[base : base + CHUNK + length - 1]
        grams = len(part) - GRAM + 1
        hashes = _gram_hashes(part, grams)
        # hash first, then place: the leftmost of the smallest
        keys = (hashes >> np.uint64(24) << np.uint64(24)) | np.arange(grams, dtype=np.uint64)
        anchors = (_sliding_min(keys, width) & np.uint64((1 << 24) - 1)).astype(np.int64)
        first = np.flatnonzero(np.append(True, anchors[1:] != anchors[:-1]))
        counts = np.diff(np.append(first, len(anchors)))
        found = hashes[anchors[first]].view(np.int64)
        for start, count, anchor in zip(first.tolist(), counts.tolist(), found.tolist(), strict=True):
            segment = part[start : start + count + length - 1]
            yield base + start, count, anchor, xxhash.xxh3_64_intdigest(segment) - (1 << 63)


def all_runs(docs: DataFrame, length: int) -> DataFrame:
    """The runs of every text: doc, text_hash, start, starts, anchor, segment."""
    names = ["doc", "text_hash", "start", "starts", "anchor", "segment"]

    def split(batches):
        for batch in batches:
            rows: list[tuple] = []
            docs, hashes = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for doc, text_hash, text in zip(docs, hashes, batch.column(2), strict=True):
                data = text.as_buffer().to_pybytes() if text.is_valid else b""
                rows += [(doc, text_hash, *r) for r in runs(data, length)]
                if len(rows) > 50_000:
                    yield _rows(rows)
                    rows = []
            if rows:
                yield _rows(rows)

    def _rows(rows):
        columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(split, ", ".join(f"{n} long" for n in names))


def sort_rotations(data: np.ndarray, depth: int) -> np.ndarray:
    """Order of the rotations of `data` by at least their first `depth` bytes."""
    count = len(data)
    twice = np.concatenate([data, np.resize(data, 8)]).tobytes()
    keys, reach = _words(twice, count), 8
    while True:
        order = np.argsort(keys, kind="stable")
        ordered = keys[order]
        rank = np.empty(count, np.int64)
        rank[order] = np.cumsum(np.append(0, ordered[1:] != ordered[:-1]))
        if reach >= depth or rank[order[-1]] == count - 1:
            return order
        keys = rank * count + np.roll(rank, -(reach % count))
        reach *= 2


def long_prefixes(data: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """Whether each rotation in `order` shares `length` bytes or more with the one before it."""
    count = len(data)
    transform = data[order - 1]
    step = np.empty(count, np.int64)  # from a rotation to the one that starts a byte earlier
    step[np.argsort(transform, kind="stable")] = np.arange(count)
    heads = data[order]
    known = np.zeros(count + 1, bool)
    known[[0, count]] = True
    low, high = np.array([0]), np.array([count - 1])
    for _ in range(length):  # at value v all intervals of v + 1 bytes are met that end at a new place
        sizes = high - low + 1
        owner = np.repeat(np.arange(len(low)), sizes)
        places = np.arange(len(owner)) + np.repeat(low - (np.cumsum(sizes) - sizes), sizes)
        keys = owner * count + step[places]
        keys.sort()
        owner, to = keys // count, keys % count
        head = heads[to]
        new = np.append(True, (owner[1:] != owner[:-1]) | (head[1:] != head[:-1]))
        first = np.flatnonzero(new)
        low, high = to[first], to[np.append(first[1:], len(to)) - 1]
        fresh = ~known[high + 1]
        low, high = low[fresh], high[fresh]
        known[high + 1] = True
        if not len(low):
            break
    return ~known[:count]


def repeated_starts(bodies: list[bytes], starts: list[int], length: int) -> list[np.ndarray]:
    """For the first `starts` places of each body, whether their string occurs twice among them."""
    data = np.frombuffer(_SEPARATOR.join(bodies) + _SEPARATOR, np.uint8)
    order = sort_rotations(data, length)
    long = long_prefixes(data, order, length)
    flags = np.zeros(len(data), bool)
    flags[order] = long | np.append(long[1:], False)
    at, out = 0, []
    for body, count in zip(bodies, starts, strict=True):
        out.append(flags[at : at + count])
        at += len(body) + 1
    return out


def _intervals(flags: np.ndarray) -> list[list[int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return edges.reshape(-1, 2).tolist()


_OCCURRENCE = "doc long, text_hash long, start long, starts long"


def _search_shard(length: int):
    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        flags = repeated_starts(pdf["body"].tolist(), pdf["starts"].tolist(), length)
        rows = [
            (doc, text_hash, start + a, b - a)
            for doc, text_hash, start, copies, found in zip(
                pdf["doc"], pdf["text_hash"], pdf["start"], pdf["copies"], flags, strict=True
            )
            if copies == 1
            for a, b in _intervals(found)
        ]
        return pd.DataFrame(rows, columns=["doc", "text_hash", "start", "starts"]).astype("int64")

    return search


def _strings(length: int):
    """Every string of the segments by hash."""

    def split(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                rows = batch.slice(at, 512).to_pylist()
                hashes = [
                    xxhash.xxh3_128_digest(r["body"][i : i + length])
                    for r in rows
                    for i in range(r["starts"])
                ]
                if not hashes:
                    continue
                halves = np.frombuffer(b"".join(hashes), ">i8").astype(np.int64).reshape(-1, 2)
                times = np.array([r["starts"] for r in rows])
                place = np.arange(len(hashes)) - np.repeat(np.cumsum(times) - times, times)
                own = {n: np.repeat([r[n] for r in rows], times) for n in ("doc", "text_hash", "start", "copies")}
                own["start"] = own["start"] + place
                columns = [*own.values(), halves[:, 0].copy(), halves[:, 1].copy()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in columns], [*own, "high", "low"]
                )

    return split


def _segments(spots: pa.Array, data: list[bytes], length: int):
    for places, text in zip(spots.to_pylist(), data, strict=True):
        for p in places:
            yield (*[p[n] for n in ("anchor", "start", "starts", "copies", "hot")],
                   text[p["start"] : p["start"] + p["starts"] + length - 1])


def repeated(docs: DataFrame, length: int) -> DataFrame:
    """Starts of strings that start anywhere else too: doc, text_hash, start, starts.

    `docs` has doc, text_hash and text.
    """
    rows, _ = materialise(all_runs(docs, length), "suffix-runs")
    place = F.struct("doc", "text_hash", "start", "starts")
    segments = rows.groupBy("anchor", "segment").agg(
        F.count(F.lit(1)).alias("copies"), F.min(place).alias("place")
    )
    # stored, it gives the join below a plain exchange, so that a segment with very many copies is split
    segments, _ = materialise(segments, "suffix-segment-counts")
    anchors = segments.groupBy("anchor").agg(
        F.count(F.lit(1)).alias("kinds"), F.sum((F.col("copies") == 1).cast("long")).alias("single")
    )
    copied = segments.where("copies > 1").select("anchor", "segment")
    whole = rows.join(copied, ["anchor", "segment"], "left_semi")
    # a segment of one copy may share strings with the other segments of its anchor
    open_ = segments.join(anchors.where("kinds > 1 AND single > 0"), "anchor").select(
        "anchor", "copies", (F.col("kinds") > HOT_SEGMENTS).alias("hot"), "place.*"
    )
    spots = open_.groupBy("doc", "text_hash").agg(
        F.collect_list(F.struct("anchor", "start", "starts", "copies", "hot")).alias("spots")
    )
    # of rows that repeat doc_id and text only one is needed, their segments have copies anyway
    joined = docs.join(spots, ["doc", "text_hash"]).select("doc", "text_hash", "text", "spots")
    names = ["doc", "text_hash", "anchor", "start", "starts", "copies", "hot", "body"]

    def cut(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                data = [t.as_buffer().to_pybytes() if t.is_valid else b"" for t in part.column(2)]
                cuts = list(_segments(part.column(3), data, length))
                if not cuts:
                    continue
                times = np.array([len(s) for s in part.column(3).to_pylist()])
                own = [np.repeat(part.column(c).to_numpy(), times) for c in (0, 1)]
                yield pa.RecordBatch.from_arrays(
                    [*map(pa.array, own), *map(pa.array, zip(*cuts, strict=True))], names
                )

    schema = (
        "doc long, text_hash long, anchor long, start long, starts long, copies long, "
        "hot boolean, body binary"
    )
    bodies, seen = materialise(
        joined.mapInArrow(cut, schema),
        "suffix-bodies",
        size=F.sum(F.when(~F.col("hot"), F.length("body"))),
    )
    shards = groups_for(seen["size"] or 0, SHARD_BYTES)
    dealt = bodies.where("not hot").withColumn(
        "shard", F.pmod(F.xxhash64("anchor"), F.lit(shards))
    )
    searched = dealt.groupBy("shard").applyInPandas(_search_shard(length), _OCCURRENCE)
    hot = bodies.where("hot").select("doc", "text_hash", "start", "starts", "copies", "body")
    strings = hot.mapInArrow(
        _strings(length),
        "doc long, text_hash long, start long, copies long, high long, low long",
    )
    twice = strings.groupBy("high", "low").agg(F.sum("copies").alias("n")).where("n > 1")
    counted = strings.where("copies = 1").join(twice, ["high", "low"], "left_semi")
    counted = counted.withColumn("starts", F.lit(1).cast("long"))
    columns = ["doc", "text_hash", "start", "starts"]
    return whole.select(*columns).union(searched).union(counted.select(*columns))


_CLEANED = StructType(
    [
        StructField("kept", BinaryType()),
        StructField("n_bytes", LongType()),
        StructField("n_removed", LongType()),
        StructField("n_spans", LongType()),
    ]
)


def _cleaner(length: int):
    @F.pandas_udf(_CLEANED)
    def clean(text: pd.Series, spans: pd.Series) -> pd.DataFrame:
        out = []
        for t, found in zip(text, spans, strict=True):
            data = (t or "").encode("utf-8")
            if found is None:
                out.append((data, len(data), 0, 0))
                continue
            start = np.array([s["start"] for s in found], np.int64)
            end = start + np.array([s["starts"] for s in found], np.int64) + length - 1
            depth = np.bincount(start, minlength=len(data) + 1) - np.bincount(end, minlength=len(data) + 1)
            gone = np.cumsum(depth)[:-1] > 0
            kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
            spans_n = int(np.count_nonzero(np.diff(np.append(0, gone.astype(np.int8))) == 1))
            out.append((kept, len(data), int(gone.sum()), spans_n))
        return pd.DataFrame(out, columns=_CLEANED.names)

    return clean


def dedup_strings(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """The rows of `docs` as struct `row`, with kept (remaining bytes), n_bytes, n_removed, n_spans.

    `length` is at least 2 * GRAM.  Cuts may fall inside a character, so `kept` is binary.
    """
    keyed = docs.select(
        F.struct("*").alias("row"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("doc"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"),
    )
    texts = keyed.select("doc", "text_hash", F.col("row.text").alias("text"))
    found = repeated(texts, length)
    spans = found.groupBy("doc", "text_hash").agg(
        F.collect_set(F.struct("start", "starts")).alias("spans")
    )
    joined = keyed.join(spans, ["doc", "text_hash"], "left")
    cleaned = _cleaner(length)(F.col("row.text"), "spans")
    return joined.select("row", cleaned.alias("out")).select("row", "out.*")
