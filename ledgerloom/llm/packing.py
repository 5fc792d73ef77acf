"""Best-fit packing of tokenised documents into sequences, certified by dual-feasible bounds.

A document is its token ids and one closing id.  Only documents longer than a sequence are cut, into
full pieces after a first one that takes the remainder, so every full piece is a sequence of its own
and one remainder per document is left to pack.  Remainders are dealt by hash into groups of a
bounded size; each group is packed best-fit decreasing and compared with its lower bound, the
largest over a family of dual-feasible functions.  Groups above their bound give back the documents
of their unfilled sequences, every other group those of its emptiest one; these are dealt anew and
packed again, as long as that saves sequences.  A bound over the histogram of all remainders
(at most one row per length) certifies the whole.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from ledgerloom.llm.common import groups_for
from ledgerloom.session import materialise

CAPACITY = 2048
#: Documents packed together in one task.
GROUP_ROWS = 16384
#: Words of a generation that a Python worker remembers with their ids (two of them, some 120 MB in all),
#: characters of a word up to which it is remembered, words encoded in one string.
GENERATION, LONG_WORD, TOGETHER = 300_000, 64, 128
MAX_ROUNDS = 4

#: Stands for the ids of a word that has none by itself; ids take four bytes each.
_ODD = b"?"
_PLAIN = re.compile(r"\n?\S+\Z")
_coders: dict[str, _WordCoder] = {}


class _WordCoder:
    """Texts to ids (little-endian unsigned 32-bit) under a byte-level BPE tokenizer file.

    Such a tokenizer never merges over the point before a lone blank or a lone line feed between
    two other characters, so a text is looked up word by word and only words not met before are
    encoded, many in one string, cut again where a token starts with the blank or line feed.  A text
    with any other white space or with a special token is encoded whole.

    Words are remembered in two generations: what a batch uses is in the young one, taken over from the
    old one or encoded; a young one that is full becomes the old one.  So words that keep coming stay, and
    those that are not met again go, whatever the vocabulary of the whole input.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.starts = {"\n": np.zeros(self.tokenizer.get_vocab_size(), bool)}
        self.starts[" "] = self.starts["\n"].copy()
        for token, at in self.tokenizer.get_vocab().items():
            for mark, byte in ((" ", "\u0120"), ("\n", "\u010a")):  # their byte-level characters
                self.starts[mark][at] |= token.startswith(byte)
        self.known: dict[str, bytes] = {"": _ODD}  # the young generation
        self.old: dict[str, bytes] = {}

    def whole(self, texts: list[str]) -> list[bytes]:
        coded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.asarray(e.ids, "<u4").tobytes() for e in coded]

    def words(self, mark: str, words: list[str]) -> list[bytes]:
        """Ids of each word with `mark` before it."""
        out: list[bytes] = []
        parts = [words[at : at + TOGETHER] for at in range(0, len(words), TOGETHER)]
        # a word in front, so that every mark stands between two other characters
        strings = ["x" + mark + mark.join(part) for part in parts]
        for part, coded in zip(parts, self.whole(strings), strict=True):
            ids = np.frombuffer(coded, "<u4")
            cuts = np.append(np.flatnonzero(self.starts[mark][ids]), len(ids)) * 4
            if len(cuts) != len(part) + 1:
                out += self.whole([mark + w for w in part])
                continue
            cuts = cuts.tolist()
            out += [coded[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
        return out

    def learn(self, missing: list[str]) -> None:
        known, stems, tails = self.known, {" ": set(), "\n": set()}, []
        for word in missing:
            if not _PLAIN.match(word):
                known[word] = _ODD
                continue
            stem = word
            # a closing comma or full stop is a token of its own after a letter
            if word[-1] in ",." and word[:-1].isalpha():
                stem = word[:-1]
                tails.append(word)
            if stem not in known:
                stems["\n" if stem[0] == "\n" else " "].add(stem)
        lines = list(stems["\n"])
        known.update(zip(lines, self.words("\n", [w[1:] for w in lines]), strict=True))
        blanks = list(stems[" "])
        known.update(zip(blanks, self.words(" ", blanks), strict=True))
        comma, stop = self.whole([",", "."])
        for word in tails:
            known[word] = known[word[:-1]] + (comma if word[-1] == "," else stop)

    def codes(self, words: list[str]) -> list[bytes]:
        """The ids of distinct words, _ODD where one cannot be looked up by itself."""
        known, old = self.known, self.old
        missing = []
        for word in [w for w, ids in zip(words, map(known.get, words), strict=True) if ids is None]:
            if (ids := old.get(word)) is None:
                missing.append(word)
            else:
                known[word] = ids
        self.learn(missing)
        found = list(map(known.__getitem__, words))
        for word in missing:
            if len(word) > LONG_WORD:
                known.pop(word, None)
        if len(known) > GENERATION:
            self.known, self.old = {"": _ODD}, known
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        marked = pc.replace_substring(pa.array(texts, pa.large_string()), "\n", " \n")
        split = pc.split_pattern(marked, " ")
        bounds = split.offsets.to_numpy()
        flat = split.values
        # a word at the start of a text has no blank before it
        heads = flat.take(pa.array(bounds[:-1])).to_pylist()
        behind = np.ones(len(flat), bool)
        behind[bounds[:-1]] = False
        counted = flat.filter(pa.array(behind)).dictionary_encode()
        codes = self.codes(counted.dictionary.to_pylist())
        sizes = np.fromiter(map(len, codes), np.int64, len(codes))
        odd = sizes % 4 != 0
        sizes[odd] = 0
        # the ids of all words one after the other, gathered from those of the distinct words
        ids = np.frombuffer(b"".join([c for c in codes if len(c) % 4 == 0]), "<u4")
        starts, sizes = np.cumsum(sizes // 4) - sizes // 4, sizes // 4
        word = counted.indices.to_numpy()
        ends = np.concatenate([[0], np.cumsum(sizes[word])])
        # the ids of one lot of texts number below 2^31
        places = np.repeat((starts[word] - ends[:-1]).astype(np.int32), sizes[word])
        places += np.arange(len(places), dtype=np.int32)
        data = ids[places].tobytes()
        of_text = bounds - np.arange(len(bounds))  # heads are not counted
        at = (ends[of_text] * 4).tolist()
        odds = np.concatenate([[0], np.cumsum(odd[word])])[of_text]
        strange = (odds[1:] > odds[:-1]).tolist()
        out: list[bytes | None] = []
        for i, (text, head, first) in enumerate(zip(texts, heads, self.whole(heads), strict=True)):
            whole = strange[i] or not _PLAIN.match(head) or head[0] == "\n"
            whole = whole or any(s in text for s in self.special)
            out.append(None if whole else first + data[at[i] : at[i + 1]])
        left = [i for i, o in enumerate(out) if o is None]
        for i, coded in zip(left, self.whole([texts[i] for i in left]), strict=True):
            out[i] = coded
        return out


def encode_texts(texts: list[str], path: str) -> list[bytes]:
    if path not in _coders:
        _coders[path] = _WordCoder(path)
    return _coders[path].encode(texts)


def tokenise(docs: DataFrame, path: str, end_id: int = 0) -> DataFrame:
    """doc_id, n_ids and ids (binary, little-endian unsigned 32-bit, closed by `end_id`) per row.

    A null text counts as empty: its only id is `end_id`.  Other columns are not read.
    """
    end = np.asarray([end_id], "<u4").tobytes()

    def encode(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one thread per task
        for batch in batches:
            for at in range(0, batch.num_rows, 2560):
                part = batch.slice(at, 2560)
                texts = [t or "" for t in part.column(1).to_pylist()]
                ids = [x + end for x in encode_texts(texts, path)]
                lengths = pa.array([len(x) // 4 for x in ids], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), lengths, pa.array(ids, pa.binary())],
                    ["doc_id", "n_ids", "ids"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        encode, "doc_id long, n_ids long, ids binary"
    )


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Sequences needed at least for `counts[s]` items of each size s, 0 to capacity."""
    sizes, total = np.arange(capacity + 1), int(counts.sum())
    if not total:
        return 0
    mass = counts * sizes
    best = -(-int(mass.sum()) // capacity)
    # items above capacity - e count full, those below e nothing
    cum_n, cum_m = np.cumsum(counts), np.cumsum(mass)
    e = np.arange(1, capacity // 2 + 1)
    large = total - cum_n[capacity - e]
    middle = cum_m[capacity - e] - cum_m[e - 1]
    best = max(best, int((-(-(large * capacity + middle) // capacity)).max()))
    for k in range(1, 24):  # (k + 1) x / capacity rounded down to whole parts of k
        scaled = (k + 1) * sizes
        kept = scaled % capacity == 0
        value = np.where(kept, k * sizes, scaled // capacity * capacity)
        best = max(best, -(-int((counts * value).sum()) // (k * capacity)))
    return best


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each item, and the fill of each bin.

    Open bins are kept in a stack per free space; a bit mask of the free spaces in use finds the
    smallest that is large enough.
    """
    order = np.argsort(-sizes, kind="stable")
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask, fills = 0, []
    bins, offsets = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    for i, size in zip(order.tolist(), sizes[order].tolist(), strict=True):
        fitting = mask >> size
        if fitting:
            free = size + (fitting & -fitting).bit_length() - 1
            at = stacks[free].pop()
            if not stacks[free]:
                mask &= ~(1 << free)
        else:
            free, at = capacity, len(fills)
            fills.append(0)
        bins[i], offsets[i] = at, fills[at]
        fills[at] += size
        free -= size
        if free:
            stacks[free].append(at)
            mask |= 1 << free
    return bins, offsets, np.asarray(fills, dtype=np.int64)


def place(items: DataFrame, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Give each row of `items` (n_ids: its length, at least 1; other columns are carried along) a
    sequence for its remainder and numbers for its full pieces.

    Adds sequence_id and offset of the first piece, full_base (the sequence of piece p > 0 is
    full_base + p - 1) and first_length.  Repeated rows are packed each for itself.  An empty table
    gives an empty result.
    """
    carried = items.columns
    keys = [f.name for f in items.schema if not isinstance(f.dataType, ArrayType)]
    items = items.withColumn("first_length", ((F.col("n_ids") - 1) % capacity + 1).cast("long"))
    schema = items.schema.simpleString()[7:-1]
    schema += ", grp:long, round:int, sequence_id:long, offset:long, full_base:long, again:boolean"
    schema += ", opened:long"

    def pack(number: int):
        def one(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values(keys, ignore_index=True)  # the same places whatever the order
            sizes = pdf["first_length"].to_numpy(np.int64)
            group = int(pdf["grp"].iloc[0])
            bins, offsets, fills = best_fit_decreasing(sizes, capacity)
            bound = lower_bound(np.bincount(sizes, minlength=capacity + 1), capacity)
            gap = len(fills) > bound
            again = fills < capacity if gap else fills == min(fills.min(), capacity - 1)
            pdf = pdf.drop(columns=["round"], errors="ignore")
            pdf["round"] = np.int32(number)
            pdf["sequence_id"] = (number << 56) | (group << 28) | bins
            pdf["offset"] = offsets
            if number == 0:
                full = (pdf["n_ids"].to_numpy(np.int64) - sizes) // capacity
                pdf["full_base"] = (1 << 62) + (group << 36) + np.cumsum(full) - full
            pdf["again"] = again[bins]
            pdf["opened"] = (offsets == 0).astype(np.int64)  # each sequence has one item at 0
            return pdf

        return one

    def deal(rows: DataFrame, count: int, number: int) -> DataFrame:
        """Groups of about `group_rows` rows, other ones each round."""
        n = groups_for(count, group_rows)
        return rows.withColumn("grp", F.pmod(F.xxhash64(F.lit(number), *keys), F.lit(n)).cast("long"))

    sums = {
        "opened": F.sum("opened"),
        "again_rows": F.sum(F.col("again").cast("long")),
        "again_opened": F.sum(F.col("opened") * F.col("again").cast("long")),
    }
    items, counted = materialise(items, "packing-items", n=F.count(F.lit(1)))
    first = deal(items, counted["n"], 0).groupBy("grp").applyInPandas(pack(0), schema)
    placed, seen = materialise(first, "packing", **sums)
    histogram = items.groupBy("first_length").count().collect()  # one row per length
    counts = np.zeros(capacity + 1, np.int64)
    for row in histogram:
        counts[row["first_length"]] = row["count"]
    goal, total, settled = lower_bound(counts, capacity), seen["opened"] or 0, []
    for number in range(1, MAX_ROUNDS):
        if total <= goal or not seen["again_rows"]:
            break
        dealt = deal(placed.where("again"), seen["again_rows"], number)
        repacked = dealt.groupBy("grp").applyInPandas(pack(number), schema)
        repacked, after = materialise(repacked, "packing", **sums)
        if after["opened"] >= seen["again_opened"]:
            break
        settled.append(placed.where("not again"))
        total -= seen["again_opened"] - after["opened"]
        placed, seen = repacked, after
    for part in settled:
        placed = placed.union(part)
    return placed.select(*carried, "first_length", "sequence_id", "offset", "full_base")


def packed_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    `tokenise` gives the ids themselves, which `sequences` joins to these places; only lengths and
    checksums go through the packing.  Null texts are empty documents of one id.
    """
    cut = f"(n_ids - 1) % {capacity} + 1"
    crcs = F.expr(
        f"transform(sequence(0L, (n_ids - 1) div {capacity}), i -> crc32(substring(ids, "
        f"if(i = 0, 1, cast(4 * ({cut} + (i - 1) * {capacity}) + 1 as int)), "
        f"cast(4 * if(i = 0, {cut}, {capacity}) as int))))"
    )
    items = tokenise(docs, path).select("doc_id", "n_ids", crcs.alias("crcs"))
    placed = place(items, capacity)
    return placed.select("*", F.posexplode("crcs").alias("piece", "ids_crc32")).select(
        "doc_id",
        "piece",
        F.expr(f"if(piece = 0, 0L, first_length + (piece - 1L) * {capacity})").alias("start"),
        F.expr(f"if(piece = 0, first_length, {capacity}L)").alias("length"),
        "ids_crc32",
        F.expr("if(piece = 0, sequence_id, full_base + piece - 1L)").alias("sequence_id"),
        F.expr("if(piece = 0, offset, 0L)").alias("offset"),
    )


def sequences(docs: DataFrame, pieces: DataFrame, path: str) -> DataFrame:
    """The packed sequences: sequence_id, ids (binary) and the documents in it by offset.

    Needs doc_id to be unique in `docs`.
    """
    cut = F.expr("substring(ids, cast(4 * start + 1 as int), cast(4 * length as int))")
    parts = pieces.join(tokenise(docs, path), "doc_id").select(
        "sequence_id", F.struct("offset", cut.alias("ids"), "doc_id").alias("part")
    )
    return (
        parts.groupBy("sequence_id")
        .agg(F.sort_array(F.collect_list("part")).alias("parts"))
        .select(
            "sequence_id",
            F.expr("aggregate(parts, X'', (a, p) -> concat(a, p.ids))").alias("ids"),
            F.col("parts.doc_id").alias("doc_ids"),
        )
    )
