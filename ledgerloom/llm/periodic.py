"""Periodic runs of words in texts, found by longest common extensions on suffix trees.

A run is a stretch of consecutive words with a smallest period q, at least `min_words` long and at
least three times q, that no neighbouring word extends keeping the period.

Words become numbers.  Ukkonen's algorithm builds the suffix tree of a stretch of words and that of
its reversal; an Euler tour with a table of minima over all powers of two gives the lowest common
ancestor of two leaves, hence the common extension of two places, in constant time, to the right and to
the left.  Every run has a period that is the longest Lyndon word at its place, in the order of the
words or in the reverse order, so the longest Lyndon words at all places (the next smaller and the next
larger suffix bound them) are the candidates; each is extended in both directions.

Trees are built only for stretches that can hold a run.  Each g words of a run stand in it a second time,
one period on or back, as long as the run has at least g + 2q - 1 words (`gram_size`; 9 words for runs of
24 words and three periods).  So words that no repeated string of g words covers are in no run, and runs
never cross them.  Strings are compared by hashes there; a collision only makes a stretch longer.

A null text has no words.  Texts are looked at whole and one after the other, so memory is that of the
longest text: some 2 kB per word of a stretch.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

MIN_WORDS, MIN_PERIODS = 24, 3
FOUND = "struct<words: bigint, runs: array<struct<start: bigint, length: bigint, period: bigint>>, collapsed: string>"


class SuffixTree:
    """Ukkonen's suffix tree of `symbols` (non-negative ints), closed by a symbol of its own."""

    def __init__(self, symbols: list[int]):
        text = [s + 1 for s in symbols]
        text.append(0)
        self.text, size = text, len(text)
        width = max(text) + 1
        # nodes: the root is 0; an edge ends in its node and carries text[start:end]
        start, end, link = [0], [0], [0]
        edges: dict[int, int] = {}  # node * width + first symbol -> child
        node, at, length, remaining = 0, 0, 0, 0  # active point: node, start of its edge, symbols along it
        for i, symbol in enumerate(text):
            remaining += 1
            last = 0  # inner node that still lacks its suffix link
            while remaining:
                if not length:
                    at = i
                key = node * width + text[at]
                child = edges.get(key)
                if child is None:
                    edges[key] = len(start)
                    start.append(i)
                    end.append(size)
                    link.append(0)
                    if last:
                        link[last] = node
                    last = 0
                else:
                    first = start[child]
                    along = min(end[child], i + 1) - first
                    if length >= along:  # walk down
                        at += along
                        length -= along
                        node = child
                        continue
                    if text[first + length] == symbol:
                        length += 1
                        if last:
                            link[last] = node
                        break
                    split = len(start)
                    start.append(first)
                    end.append(first + length)
                    link.append(0)
                    edges[key] = split
                    start[child] = first + length
                    edges[split * width + text[first + length]] = child
                    edges[split * width + symbol] = split + 1
                    start.append(i)
                    end.append(size)
                    link.append(0)
                    if last:
                        link[last] = split
                    last = split
                remaining -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    at = i - remaining + 1
        self._tour(np.asarray(start), np.asarray(end), edges, width)

    def _tour(self, start: np.ndarray, end: np.ndarray, edges: dict[int, int], width: int) -> None:
        """Depths along the Euler tour, the place of each suffix in it, its rank, the table of minima."""
        size, nodes = len(self.text), len(start)
        keys = np.fromiter(edges.keys(), np.int64, len(edges))
        order = np.argsort(keys)  # by parent, then by symbol
        children = np.fromiter(edges.values(), np.int64, len(edges))[order].tolist()
        bounds = np.searchsorted(keys[order] // width, np.arange(nodes + 1)).tolist()
        lengths = (end - start).tolist()
        depth = [0] * nodes
        tour: list[int] = []
        place, rank = [0] * size, [0] * size
        leaves = 0
        stack = [0]  # a node to enter, or the complement of one that the tour comes back to
        while stack:
            node = stack.pop()
            if node < 0:
                tour.append(depth[~node])
                continue
            here = depth[node]
            first, behind = bounds[node], bounds[node + 1]
            if first == behind:
                suffix = size - here
                place[suffix] = len(tour)
                rank[suffix] = leaves
                leaves += 1
                tour.append(here)
                continue
            tour.append(here)
            for child in reversed(children[first:behind]):
                depth[child] = here + lengths[child]
                stack.append(child)
                stack.append(~node)
            stack.pop()  # the tour is at the node before its first child already
        self.place, self.rank = np.asarray(place), rank
        level = np.asarray(tour, np.int32)
        self.minima = [level]
        step = 1
        while 2 * step <= len(tour):
            level = np.minimum(level[:-step], level[step:])
            self.minima.append(level)
            step *= 2

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common prefix of the suffixes a and b; a place at the end has none."""
        left, right = self.place[a], self.place[b]
        left, right = np.minimum(left, right), np.maximum(left, right)
        power = np.frexp(right - left + 1)[1] - 1
        out = np.empty(len(a), np.int64)
        for k in np.unique(power).tolist():
            own = power == k
            row = self.minima[k]
            out[own] = np.minimum(row[left[own]], row[right[own] + 1 - (1 << k)])
        return out


def lyndon_candidates(rank: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Places and lengths of the longest Lyndon words of both orders; `rank` includes the empty suffix.

    The end is smaller than any symbol in the order of the symbols, larger in the reverse order.
    """
    size = len(rank) - 1
    starts: list[int] = []
    ends: list[int] = []
    smaller: list[int] = []  # places whose next smaller suffix is not met yet, and the like
    larger: list[int] = []
    for i in range(size):
        r = rank[i]
        while smaller and rank[smaller[-1]] > r:
            starts.append(smaller.pop())
            ends.append(i)
        smaller.append(i)
        while larger and rank[larger[-1]] < r:
            starts.append(larger.pop())
            ends.append(i)
        larger.append(i)
    # words still open in the reverse order would go on over the end
    starts += smaller
    ends += [size] * len(smaller)
    first = np.asarray(starts, np.int64)
    return first, np.asarray(ends, np.int64) - first


def stretch_runs(symbols: list[int], min_words: int, min_periods: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of each run of one stretch, by start, then period."""
    size = len(symbols)
    forward, backward = SuffixTree(symbols), SuffixTree(symbols[::-1])
    first, period = lyndon_candidates(forward.rank)
    fits = period * min_periods <= size
    first, period = first[fits], period[fits]
    # the stretch [first, first + period) compared with what follows it, then with what is before it
    right = forward.common(first, first + period)
    left = backward.common(size - first, size - first - period)
    start, length = first - left, left + period + right
    kept = length >= np.maximum(min_words, min_periods * period)
    found = np.stack([start[kept], length[kept], period[kept]], axis=1)
    return sorted(set(map(tuple, found.tolist())), key=lambda r: (r[0], r[2]))


def gram_size(min_words: int, min_periods: int) -> int:
    """Words of the strings of which each repeats inside every run that has it."""
    periods = range(1, -(-min_words // min_periods) + 1)
    return max(1, min(max(min_words, min_periods * q) - 2 * q + 1 for q in periods))


def _stretches(symbols: np.ndarray, gram: int, least: int) -> list[tuple[int, int]]:
    """Bounds of the maximal stretches of at least `least` words covered by repeated strings."""
    if len(symbols) < least:
        return []
    count = len(symbols) - gram + 1
    with np.errstate(over="ignore"):
        mixed = (symbols.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        hashes = np.zeros(count, np.uint64)
        for k in range(gram):
            hashes = hashes * np.uint64(0xBF58476D1CE4E5B9) + mixed[k : k + count]
    order = np.argsort(hashes)
    same = np.flatnonzero(hashes[order[1:]] == hashes[order[:-1]])
    if not len(same):
        return []
    repeats = np.zeros(count + gram, np.int64)
    repeats[order[same]] = 1
    repeats[order[same + 1]] = 1
    seen = np.cumsum(repeats)
    # word i is covered if a repeated string starts at i - gram + 1 to i
    covered = seen[: len(symbols)].copy()
    covered[gram:] -= seen[: len(symbols) - gram]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], covered > 0, [False]]).astype(np.int8)))
    return [(a, b) for a, b in edges.reshape(-1, 2).tolist() if b - a >= least]


def find_runs(
    words: list, min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS
) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a sequence of words, by start, then period.

    `min_periods` is at least 2.
    """
    if len(words) < min_words:
        return []
    numbers: dict = {}
    symbols = [numbers.setdefault(w, len(numbers)) for w in words]
    if len(numbers) == len(symbols):
        return []
    found = []
    gram = gram_size(min_words, min_periods)
    for a, b in _stretches(np.asarray(symbols), gram, min_words):
        part = symbols[a:b]
        # small numbers in order of appearance keep the tree's keys small
        own: dict[int, int] = {}
        part = [own.setdefault(s, len(own)) for s in part]
        found += [(a + s, length, p) for s, length, p in stretch_runs(part, min_words, min_periods)]
    return found


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words but those that a run holds after its first period, joined by blanks."""
    if not runs:
        return b" ".join(words)
    depth = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        depth[start + period] += 1
        depth[start + length] -= 1
    kept = np.cumsum(depth)[:-1] == 0
    return b" ".join([w for w, k in zip(words, kept.tolist(), strict=True) if k])


def periodic_runs(text: Column) -> Column:
    """Of a text column: words (their number), runs by start, then period, and the collapsed text.

    Words are what ASCII white space sets apart.
    """

    @F.arrow_udf(FOUND)
    def found(texts: pa.Array) -> pa.Array:
        counts, offsets, flat, collapsed = [], [0], [], []
        for text in texts:
            # bytes are split at the six ASCII blanks and nothing else
            words = text.as_buffer().to_pybytes().split() if text.is_valid else []
            runs = find_runs(words)
            counts.append(len(words))
            flat += runs
            offsets.append(len(flat))
            collapsed.append(collapse(words, runs).decode())
        columns = np.asarray(flat, np.int64).reshape(-1, 3)
        parts = pa.StructArray.from_arrays(
            [pa.array(columns[:, i].copy()) for i in range(3)], ["start", "length", "period"]
        )
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), parts)
        return pa.StructArray.from_arrays(
            [pa.array(counts, pa.int64()), lists, pa.array(collapsed, pa.string())],
            ["words", "runs", "collapsed"],
        )

    return found(text)


def strongest(runs: Column) -> Column:
    """The run with the greatest length over period, compared exactly; ties go to the smallest start,
    then period.  NULL without runs."""

    def better(a: Column, b: Column) -> Column:
        one, other = a["length"] * b["period"], b["length"] * a["period"]
        before = F.struct(a["start"], a["period"]) < F.struct(b["start"], b["period"])
        return (one > other) | ((one == other) & before)

    none = F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>")
    return F.aggregate(
        runs, none, lambda best, r: F.when(best.isNull(), r).when(better(r, best), r).otherwise(best)
    )
