"""Secret scans: fixed patterns, and literals that reach names which usually hold secrets.

The fixed patterns are assign, access and hex.  The lexer reads assignments of source and
configuration text (name = "x", "name": 'x', name := x, export NAME=x, name => x, <name>x</name>,
sums of literals) into names and literals, follows names that are bound to a literal elsewhere in
the text, and scores a literal by the words of the names it reaches and by what it looks like.
Spans are in code points, end exclusive.  A null or empty text has none.
"""

from __future__ import annotations

import math
import re
import string
from collections import Counter
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)

#: Kinds in the order they are listed in.
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "literal")
#: Score from which a literal counts as a secret.
THRESHOLD = 0.5
MIN_LITERAL = 8

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")

#: How strongly a word of a name speaks for a secret, and words that speak against one.
NAME_WEIGHTS = {
    "password": 1.0,
    "passwd": 1.0,
    "passphrase": 1.0,
    "pwd": 0.9,
    "pass": 0.7,
    "secret": 1.0,
    "token": 0.9,
    "apikey": 1.0,
    "credential": 0.9,
    "credentials": 0.9,
    "bearer": 0.8,
    "signature": 0.6,
    "auth": 0.6,
}
#: Pairs of neighbouring words that mean a secret together.
NAME_PAIRS = {
    ("api", "key"),
    ("access", "key"),
    ("private", "key"),
    ("secret", "key"),
    ("signing", "key"),
    ("encryption", "key"),
    ("client", "key"),
    ("service", "key"),
    ("connection", "string"),
}
NAME_AGAINST = {"count", "length", "len", "max", "min", "type", "url", "uri", "path", "file"} | {
    "policy", "expiry", "ttl", "hint", "field", "label", "limit", "name", "public",
}
PLACEHOLDERS = re.compile(
    r"(?i)change_?me|example|placeholder|your[_-]|dummy|redacted|none$|null$|true$|false$|x{4,}|\*{3,}"
    r"|\$\{|\{\{|<[^>]*>$|%\("
)

_OPERATOR = re.compile(r":=|=>|[:=](?![=/])|</?[A-Za-z_]")
_QUOTES = frozenset("\"'`")
_NAME_STARTS = frozenset(string.ascii_letters + "_")
_NAME_CHARACTERS = _NAME_STARTS | frozenset(string.digits + ".-")
_TAG = re.compile(r"<([A-Za-z_][A-Za-z0-9_.\-]*)>([^<>\n]+)</\1>")
_VALUE = re.compile(
    r"""[ \t]*(?:"((?:[^"\\\n]|\\.)*)"|'((?:[^'\\\n]|\\.)*)'|`([^`\n]*)`|([^\s"'`,;(){}\[\]<>]+))"""
)
_PLUS = re.compile(r"[ \t]*\+")
_IDENTIFIER = re.compile(r"[A-Za-z_$][A-Za-z0-9_.$]*\Z")
_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")


@lru_cache(maxsize=20_000)
def name_weight(name: str) -> float:
    """0 to 1: how likely what a name like this holds is a secret."""
    words = [w.lower() for w in _WORD.findall(name)]
    best = max((NAME_WEIGHTS.get(w, 0.0) for w in words), default=0.0)
    if any(pair in NAME_PAIRS for pair in zip(words, words[1:], strict=False)):
        best = 1.0
    return best * 0.3 if words and words[-1] in NAME_AGAINST else best


def literal_weight(literal: str) -> float:
    """0 to 1: how much a literal looks like a key or password and unlike a word or a placeholder."""
    if len(literal) < MIN_LITERAL or PLACEHOLDERS.search(literal) or any(c.isspace() for c in literal):
        return 0.0
    counts = Counter(literal)
    entropy = -sum(n / len(literal) * math.log2(n / len(literal)) for n in counts.values())
    classes = sum(bool(re.search(c, literal)) for c in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
    weight = min(1.0, entropy / 3.0)
    return weight if classes > 1 else weight * 0.6


def assignments(text: str) -> list[tuple[str, list[tuple[int, int, bool]]]]:
    """Names and the places of what they are assigned; True for text in quotes."""
    found = []
    for match in _OPERATOR.finditer(text):
        at = match.start()
        if text[at] == "<":
            tag = _TAG.match(text, at)
            if tag:
                found.append((tag[1], [(*tag.span(2), True)]))
            continue
        name = _name_before(text, at)
        if not name:
            continue
        parts, end = [], match.end()
        while value := _VALUE.match(text, end):
            group = value.lastindex
            if group is not None:
                parts.append((*value.span(group), group < 4))
            plus = _PLUS.match(text, value.end())
            if not plus:
                break
            end = plus.end()
        if parts:
            found.append((name, parts))
    return found


def _name_before(text: str, at: int) -> str | None:
    """The name in front of an operator, in quotes or not, blanks between them; as far as it goes."""
    end = at
    while end and text[end - 1] in " \t":
        end -= 1
    quote = text[end - 1] if end and text[end - 1] in _QUOTES else ""
    start = end = end - len(quote)
    while start and text[start - 1] in _NAME_CHARACTERS:
        start -= 1
    if quote:
        named = start < end and text[start] in _NAME_STARTS and text[start - 1 : start] == quote
        return text[start:end] if named else None
    while start < end and text[start] not in _NAME_STARTS:
        start += 1
    return text[start:end] or None


class _Flow:
    """Names, what is assigned to them, and where the literals in it end up.

    An assignment is a name and its parts, each (start, end, word): word is None for a literal, and for
    the use of a name that name, which counts as a literal where nothing is assigned to it.  Each name is
    followed once and hands on what it reaches, so the work grows with the text, whatever is chained.
    """

    def __init__(self, text: str, pairs: list[tuple[str, list]]):
        self.text, self.pairs = text, pairs
        self.bound: dict[str, list[int]] = {}
        for i, (name, _) in enumerate(pairs):
            self.bound.setdefault(name, []).append(i)
        self.alias: dict[str, tuple | int | None] = {}

    def _used(self, i: int) -> list[str]:
        return [word for *_, word in self.pairs[i][1] if word in self.bound]

    def targets(self) -> dict[str, str]:
        """For each name the one most likely to hold a secret that its value reaches, itself included."""
        best: dict[str, str] = {}
        for name in sorted(self.bound, key=lambda n: (-name_weight(n), n)):
            self._hand_on(best, [name], name)
        return best

    def _hand_on(self, best: dict, names: list[str], what) -> None:
        """Mark `names` and all names whose values they use, where they have no mark yet."""
        while names:
            name = names.pop()
            if name not in best:
                best[name] = what
                names += [w for i in self.bound[name] for w in self._used(i) if w not in best]

    def sums(self, targets: dict[str, str]) -> dict[int, tuple[float, str]]:
        """Score and name of each assignment through a sum: its own, or one its value becomes a part of."""
        own = {}
        for i, (name, parts) in enumerate(self.pairs):
            if len(parts) > 1:
                weight = name_weight(targets[name]) * literal_weight(self.value(i))
                if weight >= THRESHOLD:
                    own[i] = (weight, targets[name])
        carried: dict[str, tuple[float, str]] = {}
        for i, found in sorted(own.items(), key=lambda x: (-x[1][0], x[0])):
            self._hand_on(carried, self._used(i), found)
        out = dict(own)
        for name, found in carried.items():
            for i in self.bound[name]:
                if i not in out or out[i][0] < found[0]:
                    out[i] = found
        return out

    def value(self, i: int, depth: int = 0) -> str:
        """The joined text of a sum, constants put in; sums in sums up to 8 deep, 4096 characters to judge."""
        out = ""
        for start, end, word in self.pairs[i][1]:
            if len(out) >= 4096:
                break
            found = self._literal(word) if word in self.bound else (start, end)
            if isinstance(found, tuple):
                out += self.text[found[0] : min(found[1], found[0] + 4096)]
            elif found is not None and depth < 8:
                out += self.value(found, depth + 1)
        return out

    def _literal(self, name: str) -> tuple[int, int] | int | None:
        """What a name stands for by its first assignment: a literal, a sum, or nothing in a circle."""
        path, found = [], None
        while name not in self.alias:
            self.alias[name] = None  # met again, it is a circle
            path.append(name)
            first = self.bound[name][0]
            parts = self.pairs[first][1]
            if len(parts) > 1:
                found = first
                break
            start, end, word = parts[0]
            if word not in self.bound:
                found = (start, end)
                break
            name = word
        else:
            found = self.alias[name]
        for met in path:
            self.alias[met] = found
        return found

    def literals(self):
        """(start, end, name, weight, score) of every literal: by itself, and by the sums it is a part of."""
        targets = self.targets()
        sums = self.sums(targets)
        for i, (name, parts) in enumerate(self.pairs):
            for start, end, word in parts:
                if word in self.bound:
                    continue
                target = targets[name]
                score = name_weight(target) * literal_weight(self.text[start:end])
                if i in sums and sums[i][0] > score and end > start:
                    score, target = sums[i]
                yield start, end, target, score


def spans_of(text: str) -> list[tuple[str, int, int, int, str | None, float]]:
    """(kind, start, end, start of the secret itself, name, score) by start, then kind as listed."""
    found = [("access", *m.span(), m.start(), None, 1.0) for m in _ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [("hex", *m.span(), m.start(), None, 1.0) for m in _HEX.finditer(text)]
    if ":" in text or "=" in text:
        found += [
            ("assign", *m.span(), m.start(2), m[1].lower(), 1.0)
            for m in _ASSIGN.finditer(text)
            if len(m[2]) >= 8
        ]
    if ":" in text or "=" in text or "</" in text:
        pairs = []
        for name, parts in assignments(text):
            words = [text[a:b] for a, b, _ in parts]
            marked = [
                (a, b, None if quoted or not _IDENTIFIER.match(w) else w)
                for (a, b, quoted), w in zip(parts, words, strict=True)
            ]
            pairs.append((name, marked))
        for start, end, name, score in _Flow(text, pairs).literals():
            if score >= THRESHOLD:
                found.append(("literal", start, end, start, name, round(score, 6)))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


SPANS = ArrayType(
    StructType(
        [
            StructField("kind", StringType()),
            StructField("start", LongType()),
            StructField("end", LongType()),
            StructField("secret_start", LongType()),
            StructField("name", StringType()),
            StructField("score", DoubleType()),
        ]
    )
)


@F.pandas_udf(SPANS)
def _spans(text: pd.Series) -> pd.Series:
    names = [f.name for f in SPANS.elementType.fields]
    return pd.Series([[dict(zip(names, s, strict=True)) for s in spans_of(t or "")] for t in text])


def secret_spans(text: Column) -> Column:
    """Array of spans (kind, start, end, secret_start, name, score) of a text column."""
    return _spans(text)


def span_list(spans: Column, kinds: tuple[str, ...] = KINDS) -> Column:
    """kind:start:end of the spans of these kinds, joined by commas."""
    kept = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.concat_ws(
        ",", F.transform(kept, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    )


@F.pandas_udf(StringType())
def _masked(text: pd.Series) -> pd.Series:
    out = []
    for t in text:
        found = spans_of(t or "")
        if not found:
            out.append(t)
            continue
        parts, at = [], 0
        for kind, _, end, start, _, _ in sorted(found, key=lambda s: (s[3], -s[2])):
            if end <= at:
                continue
            if start >= at:
                parts += [t[at:start], f"[{kind}]"]
            at = end
        out.append("".join([*parts, t[at:]]))
    return pd.Series(out, dtype=object)


def masked(text: Column) -> Column:
    """The text with every secret (of an assignment: the value alone) replaced by its kind."""
    return _masked(text)
