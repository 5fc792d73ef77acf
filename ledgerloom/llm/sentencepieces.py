"""SentencePiece models encoded and decoded by the tokenizers library.

The model's protobuf is read field by field; pieces, scores, the normaliser's character map, its
white-space rules and byte fallback are rebuilt as a tokenizers pipeline, for unigram and BPE models.
Texts go through in batches with several threads.  `checked` decodes what it encodes and
holds ids against the sentencepiece library itself, of every text.

Where no piece goes on over the start of a word, neither library joins anything over it, so what both make
of a text is what they make of its words, one after the other.  `checked` then compares the libraries on
every distinct word once (a worker remembers words in two generations) and their normalised forms on every
text; a text whose forms differ, or that is not put together from its words again, goes through both as a
whole, and so do all texts of other models.

Null texts count as empty and have no ids.  Repeated rows are encoded each for itself; a null doc_id stays
null.  An empty table gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import Remembered

MARK = "▁"
#: Types of pieces and of models in the protobuf.
UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
#: Texts encoded in one call, texts whose words are counted together, threads of a call.
BATCH, TOGETHER, THREADS = 256, 4096, 2
#: Words of a generation that a worker remembers (two of them, some 170 MB in all), words of a call and of
#: a text made of words.
WORDS, CALL, GROUP = 400_000, 8192, 64


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a protobuf message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value, shift = 0, 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
        yield tag >> 3, data[at : at + size]
        at += size


@dataclass
class Model:
    """What a SentencePiece file says."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    squeeze: bool = True
    escape: bool = True


def parse(data: bytes) -> Model:
    model = Model()
    for number, value in fields(data):
        if number == 1:
            piece, score, kind = "", 0.0, 1
            for inner, v in fields(value):
                if inner == 1:
                    piece = v.decode("utf-8")
                elif inner == 2:
                    (score,) = struct.unpack("<f", v)
                elif inner == 3:
                    kind = v
            model.pieces.append((piece, score, kind))
        elif number == 2:
            for inner, v in fields(value):
                if inner == 3:
                    model.kind = v
                elif inner == 35:
                    model.byte_fallback = bool(v)
        elif number == 3:
            for inner, v in fields(value):
                if inner == 2:
                    model.charsmap = v
                elif inner == 3:
                    model.dummy_prefix = bool(v)
                elif inner == 4:
                    model.squeeze = bool(v)
                elif inner == 5:
                    model.escape = bool(v)
    return model


def merges(model: Model) -> list[tuple[str, str]]:
    """The pairs that make up each piece, best score first, as a BPE model merges them."""
    vocab = {p: i for i, (p, _, kind) in enumerate(model.pieces) if kind in (1, USER_DEFINED)}
    found = []
    for piece, score, kind in model.pieces:
        if kind != 1:
            continue
        splits = [(piece[:i], piece[i:]) for i in range(1, len(piece))]
        splits = [(vocab[a], vocab[b], a, b) for a, b in splits if a in vocab and b in vocab]
        found += [(-score, vocab[piece], *s) for s in sorted(splits)]
    return [(a, b) for *_, a, b in sorted(found)]


def build(data: bytes):
    """A tokenizers Tokenizer that works like the model."""
    from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    model = parse(data)
    names = [p for p, _, _ in model.pieces]
    unknown = next(i for i, (_, _, kind) in enumerate(model.pieces) if kind == UNKNOWN)
    if model.kind == UNIGRAM:
        pieces = [(p, s) for p, s, _ in model.pieces]
        core = models.Unigram(pieces, unknown, model.byte_fallback)
    elif model.kind == BPE:
        core = models.BPE(
            {p: i for i, p in enumerate(names)},
            merges(model),
            unk_token=names[unknown],
            fuse_unk=True,
            byte_fallback=model.byte_fallback,
        )
    else:
        raise ValueError("only unigram and BPE models are supported")
    tokenizer = Tokenizer(core)
    steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    if model.squeeze:
        steps += [normalizers.Replace(Regex("^ +| +$"), ""), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.dummy_prefix:
        steps.append(normalizers.Prepend(MARK if model.escape else " "))
    if model.escape:
        steps.append(normalizers.Replace(" ", MARK))
    tokenizer.normalizer = normalizers.Sequence(steps)
    # where no piece goes on over the start of a word, words can be looked up one by one
    if not any(MARK in p.lstrip(MARK) for p in names):
        words = Regex(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
        tokenizer.pre_tokenizer = pre_tokenizers.Split(words, "isolated")
    back = [decoders.Replace(MARK, " ")] if model.escape else []
    back += [decoders.ByteFallback(), decoders.Fuse()]
    if model.dummy_prefix:
        back.append(decoders.Strip(" ", 1, 0))
    tokenizer.decoder = decoders.Sequence(back)
    own = [AddedToken(p, normalized=False) for p, _, kind in model.pieces if kind == USER_DEFINED]
    if own:
        tokenizer.add_tokens(own)
    return tokenizer


_built: dict = {}


def _tokenizer(data: bytes, threads: int):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
    os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
    if data not in _built:
        _built[data] = build(data)
    return _built[data]


def _model_bytes(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode(docs: DataFrame, path: str, threads: int = THREADS) -> DataFrame:
    """doc_id and ids (array of int) of each whole text; a null text has none.

    The model file (under a megabyte for 32,000 pieces) goes along with the function.  Repeated rows
    are encoded each for itself; other columns are not read.
    """
    data = _model_bytes(path)

    def run(batches):
        tokenizer = _tokenizer(data, threads)
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                part = batch.slice(at, BATCH)
                texts = [t or "" for t in part.column(1).to_pylist()]
                coded = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
                ids = [np.asarray(e.ids, np.int32) for e in coded]
                offsets = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                flat = np.concatenate([*ids, np.zeros(0, np.int32)])
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
                yield pa.RecordBatch.from_arrays([part.column(0), lists], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, ids array<int>"
    )


def decode(ids: DataFrame, path: str, threads: int = THREADS) -> DataFrame:
    """doc_id and text of each row of ids; null ids give an empty text."""
    data = _model_bytes(path)

    def run(batches):
        tokenizer = _tokenizer(data, threads)
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                part = batch.slice(at, BATCH)
                rows = [i or [] for i in part.column(1).to_pylist()]
                texts = tokenizer.decode_batch(rows, skip_special_tokens=False)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts)], ["doc_id", "text"])

    return ids.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def _expected(model: Model, text: str) -> str:
    """What decoding gives back of a text, white space as the model treats it."""
    text = text.replace(MARK, " ") if model.escape else text
    return " ".join(p for p in text.split(" ") if p) if model.squeeze else text


#: Sets words apart in one string; a text that has it is looked at as a whole.
_CUT = "\x1f"
_AGREE, _TRIP, _ODD = 1, 2, 4
_FLAGS = [bytes([flags]) for flags in range(8)]


class _Checker:
    """Both libraries in a worker, and what is known of words."""

    def __init__(self, data: bytes, threads: int):
        import sentencepiece

        self.model, self.tokenizer = parse(data), _tokenizer(data, threads)
        self.library = sentencepiece.SentencePieceProcessor(model_proto=data)
        own = any(kind == USER_DEFINED for _, _, kind in self.model.pieces)
        self.by_words = (
            self.tokenizer.pre_tokenizer is not None
            and self.model.dummy_prefix
            and self.model.escape
            and not own
        )
        #: whether a piece begins with the mark
        self.marked = np.array([p.startswith(MARK) for p, _, _ in self.model.pieces])
        self.words = Remembered(self._judge, WORDS)

    def _normalised(self, texts: list[str]) -> tuple[list[str], list[str]]:
        """The forms of both libraries.  Without a character map and squeezed blanks the tokenizer only
        puts a mark in front and marks for blanks."""
        if not self.model.charsmap and not self.model.squeeze:
            return self.library.normalize(texts), [t and MARK + t.replace(" ", MARK) for t in texts]
        return self.library.normalize(texts), [self.tokenizer.normalizer.normalize_str(t) for t in texts]

    def _judge(self, words: list[str]) -> list[bytes]:
        """Per word its flags in a byte, then its ids; words are normalised, with the marks before them.

        Words with one mark go through both libraries as texts of GROUP words.  Where forms, ids and texts
        are the same throughout, so are those of each word, and its ids begin at its mark; the words of
        other groups are looked at one by one, as are words with more marks.
        """
        out: list[bytes | None] = [None] * len(words)
        simple = [i for i, w in enumerate(words) if len(w) > 1 and w[0] == MARK and MARK not in w[1:]]
        for at in range(0, len(simple), CALL):
            part = simple[at : at + CALL]
            groups = [part[a : a + GROUP] for a in range(0, len(part), GROUP)]
            texts = [" ".join([words[i][1:] for i in g]) for g in groups]
            one, other = self._normalised(texts)
            coded = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            back = self.tokenizer.decode_batch(coded, skip_special_tokens=False)
            known = self.library.encode(texts)
            for g, t, a, b, ids, text, theirs, their_text in zip(
                groups, texts, one, other, coded, back, known, self.library.decode(known), strict=True
            ):
                if not (a == b == MARK + t.replace(" ", MARK) and ids == theirs and text == their_text == t):
                    continue
                found = np.asarray(ids, "<u4")
                cuts = (np.flatnonzero(self.marked[found]) * 4).tolist()
                if len(cuts) != len(g):
                    continue
                data = found.tobytes()
                for i, x, y in zip(g, cuts, [*cuts[1:], len(data)], strict=True):
                    out[i] = _FLAGS[_AGREE | _TRIP] + data[x:y]
        left = [i for i, o in enumerate(out) if o is None]
        for at in range(0, len(left), CALL):
            part = left[at : at + CALL]
            for i, judged in zip(part, self._judge_part([words[i] for i in part]), strict=True):
                out[i] = judged
        return out

    def _judge_part(self, words: list[str]) -> list[bytes]:
        raw = [w[1:].replace(MARK, " ") for w in words]
        one, other = self._normalised(raw)
        coded = [e.ids for e in self.tokenizer.encode_batch_fast(raw, add_special_tokens=False)]
        back = self.tokenizer.decode_batch(coded, skip_special_tokens=False)
        known = self.library.encode(raw)
        flat = np.fromiter(chain.from_iterable(coded), "<u4").tobytes()
        out, at = [], 0
        for w, r, a, b, ids, text, theirs, their_text in zip(
            words, raw, one, other, coded, back, known, self.library.decode(known), strict=True
        ):
            flags = _AGREE * (ids == theirs and text == their_text) + _TRIP * (text == r)
            flags += _ODD * (a != w or b != w or w[:1] != MARK or not r)  # no text is a lone mark
            out.append(_FLAGS[flags] + flat[at : at + 4 * len(ids)])
            at += 4 * len(ids)
        return out

    def whole(self, texts: list[str]) -> list[tuple]:
        """(ids, round trip, parity) of texts that go through both libraries."""
        if not texts:
            return []
        coded = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        back = self.tokenizer.decode_batch(coded, skip_special_tokens=False)
        known = self.library.encode(texts)
        return [
            (np.asarray(ids, "<u4").tobytes(), b == _expected(self.model, t), ids == k and b == kb)
            for t, ids, b, k, kb in zip(texts, coded, back, known, self.library.decode(known), strict=True)
        ]

    def check(self, texts: list[str]) -> list[tuple]:
        if not self.by_words or not texts:
            return self.whole(texts)
        one, other = self._normalised(texts)
        usual = [a == b and a[:1] == MARK and _CUT not in a for a, b in zip(one, other, strict=True)]
        forms = [n if u else "" for n, u in zip(one, usual, strict=True)]
        del one, other
        # a word is a stretch of marks and what follows up to the next mark
        cut = pc.replace_substring(pa.array(forms, pa.large_string()), MARK, _CUT + MARK)
        for _ in range(2):  # every second cut between two marks, then the others
            cut = pc.replace_substring(cut, f"{MARK}{_CUT}{MARK}", MARK + MARK)
        split = pc.split_pattern(pc.utf8_slice_codeunits(cut, 1), _CUT)
        bounds = split.offsets.to_numpy()
        counted = split.values.dictionary_encode()
        names = counted.dictionary.to_pylist()
        judged = self.words.values(names)
        flags = np.frombuffer(b"".join([j[:1] for j in judged]), np.uint8)
        sizes = np.fromiter(map(len, judged), np.int64, len(judged)) // 4
        ids = np.frombuffer(b"".join([j[1:] for j in judged]), "<u4")
        starts = np.cumsum(sizes) - sizes
        word = counted.indices.to_numpy()
        ends = np.concatenate([[0], np.cumsum(sizes[word])])
        data = ids[np.arange(ends[-1]) + np.repeat(starts[word] - ends[:-1], sizes[word])].tobytes()
        at = (ends[bounds] * 4).tolist()

        def every(flag: int) -> list[bool]:
            misses = np.concatenate([[0], np.cumsum(flags[word] & flag == 0)])[bounds]
            return (misses[1:] == misses[:-1]).tolist()

        agree, trip = every(_AGREE), every(_TRIP)
        odd = np.concatenate([[0], np.cumsum(flags[word] & _ODD > 0)])[bounds]
        odd = (odd[1:] > odd[:-1]).tolist()
        out: list[tuple | None] = []
        for i, (text, form) in enumerate(zip(texts, forms, strict=True)):
            if not usual[i] or odd[i] or not trip[i]:
                out.append(None)
                continue
            same = form[1:].replace(MARK, " ") == _expected(self.model, text)
            out.append((data[at[i] : at[i + 1]], same, agree[i]))
        left = [i for i, o in enumerate(out) if o is None]
        for at_ in range(0, len(left), BATCH):
            part = left[at_ : at_ + BATCH]
            for i, found in zip(part, self.whole([texts[i] for i in part]), strict=True):
                out[i] = found
        return out


_checkers: dict = {}


def checked(docs: DataFrame, path: str, audit: Column, threads: int = THREADS) -> DataFrame:
    """doc_id, n_ids, ids_crc32 (of the ids as little-endian unsigned 32-bit), round_trip (whether
    decoding gives the text that went in, white space as the model treats it) and parity (whether the
    sentencepiece library gives the same ids and text; null where `audit` is not true).

    The rows are those of `encode` with their text alongside, so that a text is read once.
    """
    data = _model_bytes(path)

    def run(batches):
        if data not in _checkers:
            _checkers[data] = _Checker(data, threads)
        for batch in batches:
            for at in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(at, TOGETHER)
                found = _checkers[data].check([t or "" for t in part.column(1).to_pylist()])
                asked = part.column(2).to_pylist()
                columns = [
                    pa.array([len(ids) // 4 for ids, _, _ in found], pa.int64()),
                    pa.array([zlib.crc32(ids) for ids, _, _ in found], pa.int64()),
                    pa.array([trip for _, trip, _ in found], pa.bool_()),
                    pa.array([p if a else None for (_, _, p), a in zip(found, asked, strict=True)], pa.bool_()),
                ]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], names)

    names = ["doc_id", "n_ids", "ids_crc32", "round_trip", "parity"]
    rows = docs.select(F.col("doc_id").cast("long"), "text", audit.alias("audit"))
    return rows.mapInArrow(
        run, "doc_id long, n_ids long, ids_crc32 long, round_trip boolean, parity boolean"
    )
