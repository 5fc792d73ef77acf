"""Plain versions of the corpus operators, for tables that fit in memory."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SECRETS = {
    "assign": re.compile(
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        re.I | re.A,
    ),
    "access": re.compile("AKIA[A-Z0-9]+"),
    "hex": re.compile("[0-9a-f]+"),
}


def simhash(text: str | None) -> int:
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def components(ids: list, linked) -> dict:
    """Smallest id reachable from each; `linked(i, j)` for places in `ids`."""
    label = list(ids)
    changed = True
    pairs = [(i, j) for i in range(len(ids)) for j in range(i) if linked(i, j)]
    while changed:
        changed = False
        for i, j in pairs:
            low = min(label[i], label[j])
            changed |= label[i] != low or label[j] != low
            label[i] = label[j] = low
    return dict(zip(ids, label, strict=True))


def simhash_components(docs: list[tuple]) -> dict:
    prints = [simhash(t) for _, t in docs]
    return components([i for i, _ in docs], lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 3)


def line_key(line: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))


def dedup_lines(docs: list[tuple]) -> dict:
    """doc_id -> (lines, dropped, text)."""
    held = defaultdict(set)
    for doc, text in docs:
        for line in (text or "").split("\n"):
            held[line_key(line)].add(doc)
    out = {}
    for doc, text in docs:
        lines = (text or "").split("\n")
        kept = [
            x
            for x in lines
            if len(k := line_key(x)) < 40 or len(held[k]) < 5 or doc == max(held[k])
        ]
        out[doc] = len(lines), len(lines) - len(kept), "\n".join(kept)
    return out


def base_secrets(text: str | None) -> list[tuple[str, int, int]]:
    found = []
    for kind, pattern in SECRETS.items():
        for m in pattern.finditer(text or ""):
            size = len(m[2]) if kind == "assign" else len(m[0])
            if size >= {"assign": 8, "access": 16, "hex": 32}[kind]:
                found.append((kind, *m.span()))
    return sorted(found, key=lambda s: (s[1], list(SECRETS).index(s[0])))


def dedup_strings(docs: list[tuple], length: int) -> list[tuple]:
    """(doc_id, bytes, removed, spans, sha256) per row."""
    data = [(doc, (text or "").encode()) for doc, text in docs]
    seen = Counter(b[i : i + length] for _, b in data for i in range(len(b) - length + 1))
    out = []
    for doc, b in data:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = True
        spans = int((np.diff(np.append(0, gone.astype(int))) == 1).sum())
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out.append((doc, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def vector_links(rows: list[tuple], cosine: float = 0.98) -> dict:
    """vec_id -> (links, component) of (vec_id, vector, label) rows with distinct ids."""

    def usable(v, label):
        if label is None or v is None or any(x is None for x in v):
            return None
        v = np.array(v, np.float64)
        if not np.isfinite(v).all() or not v.any():
            return None
        v = v / np.abs(v).max()
        return v / np.linalg.norm(v)

    unit = [usable(v, label) for _, v, label in rows]

    def linked(i, j):
        if i == j or unit[i] is None or unit[j] is None or rows[i][2] != rows[j][2]:
            return False
        return float(unit[i] @ unit[j]) >= cosine

    ids = [r[0] for r in rows]
    label = components(ids, linked)
    counts = [sum(linked(i, j) for j in range(len(rows))) for i in range(len(rows))]
    return {i: (n, label[i]) for i, n in zip(ids, counts, strict=True)}


def planted_words(doc_id: int | None, text: str | None) -> list[str]:
    """The words of a text; for a tenth of all ids periodic from some word on."""
    words = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def periodic_runs(words: list, min_words: int = 24, min_periods: int = 3) -> list[tuple]:
    """(start, length, period) of each run, period by period."""
    n, found = len(words), []
    for q in range(1, n // min_periods + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(min_words, min_periods * q):
                inner = words[i : i + length]
                if not any(inner[r:] == inner[:-r] for r in range(1, q)):
                    found.append((i, length, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def periodic_row(doc_id: int | None, text: str | None) -> tuple:
    words = planted_words(doc_id, text)
    runs = periodic_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    milli = None if best[0] is None else 1000 * best[1] // best[2]
    digests = [hashlib.sha256(x.encode()).hexdigest() for x in (listed, kept)]
    return (doc_id, len(runs), *best, milli, *digests)


def trie_nodes(paths: dict[int, tuple]) -> list[tuple]:
    """Nodes of conversations id -> turns (role, text): conv_id, depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256."""
    members = defaultdict(list)
    for conv, turns in sorted(paths.items()):
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
    children = Counter(key[:-1] for key in members if key)
    leaves, saved = Counter(), Counter()
    for key, convs in members.items():
        words = len(WORD.findall(key[-1][1])) if key else 0
        for d in range(len(key) + 1):
            leaves[key[:d]] += not children[key]
            saved[key[:d]] += (len(convs) - 1) * words
    rows = []
    for key, convs in members.items():
        ends = ",".join(str(c) for c in convs if len(paths[c]) == len(key))
        parent = members[key[:-1]][0] if key else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        rows.append((convs[0], len(key), parent, len(convs), children[key], leaves[key], saved[key], digest))
    return sorted(rows, key=str)


def rebuilt_conversations(rows: list[tuple]) -> dict[int, tuple]:
    """id -> turns of rows (conv_id, turn, role, text) without ties, rebuilt as op13 says."""
    own = defaultdict(list)
    for conv, _, role, text in sorted(rows, key=lambda r: (r[0] or 0, r[1] is not None, r[1] or 0)):
        if conv is not None:
            own[conv].append((role or "", text or ""))
    out = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 4
        out[conv] = (*own.get(conv - conv % 20, [])[:h], *turns[h:])
    return out
