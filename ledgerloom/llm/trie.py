"""Conversation prefix trie: every distinct start of conversations with what hangs below it.

A turn is named by 16 bytes of SHA-256 of its role and text, a conversation by the list of its turns.
Conversations that are equal in all turns are one path with a number of copies; paths are put in order
by ranges into shards.  Inside a shard they are rows of a padded matrix of turn ids, taken in panels of
columns so that one long conversation does not widen all rows: rows are sorted with lexsort, a mask of
where a column differs from the row before, or-accumulated over the columns, marks where a node starts
at each depth, and reduceat sums the rows of every node.

A node's rows are neighbours in the order of all paths, so only nodes on the first or the last path of a
shard can go on in another.  All others are complete and leave the shard as rows; what is known of the
boundary nodes goes on as at most two paths with sums per depth.  Those of GROUP neighbouring shards are
folded by the same code, round by round, until one group is left; each round is cut by a written table.
Rows that a shard closed under a boundary node learn its conversation by a join at the end.

The ids of equal conversations are put together in blocks of the id, then hashed block by block in
order, so a path with very many copies is neither sorted nor held as a whole.

Order of turns: by turn, null turns first, ties by role, then by the name of the turn.  Null roles and
texts count as empty.  Rows that repeat are turns of their own.  Rows without a conversation id belong to
no conversation and take no part.  An empty table gives no nodes.  Other columns are not read.  The list
of one conversation (24 bytes a turn) must fit a task.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import groups_for
from ledgerloom.session import materialise

#: Turns of a shard, shards folded together in a round, columns of a panel, bits of ids in a block.
SHARD_TURNS, GROUP, PANEL, BLOCK_BITS = 400_000, 256, 32, 16
_NONE = np.iinfo(np.int64).max
#: Per depth of a boundary path: conversations and smallest id so far, closed children and their sums.
_SUMS = ("convs", "first", "children", "leaves", "saved")
_PATH = "path: array<binary>, words: array<int>"
_CLOSED = (
    "depth long, conv_id long, parent_conv_id long, parent_ref binary, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, ends_sha256 string, ref binary"
)
_OPEN = (
    f"open struct<{_PATH}, refs: array<binary>, ends: array<string>, "
    + ", ".join(f"{name}: array<bigint>" for name in _SUMS)
    + ">"
)


def turn_name(role: Column, text: Column) -> Column:
    """16 bytes that stand for a role and a text."""
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.unhex(F.substring(F.sha2(whole.cast("binary"), 256), 1, 32))


def named_turns(rows: DataFrame, words: str = r"[^\x20\x09-\x0D]+") -> DataFrame:
    """conv_id and turns, an array of (name, words: the number of words in the text) in order.

    Texts stay where they are read; rows of a conversation are put together before they are exchanged.
    """
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    one = F.struct(
        F.col("turn"),
        role.alias("role"),
        turn_name(role, text).alias("name"),
        F.regexp_count(text, F.lit(words)).alias("words"),
    )
    named = rows.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), one.alias("one")
    )
    found = named.groupBy("conv_id").agg(F.sort_array(F.collect_list("one")).alias("found"))
    turns = F.transform("found", lambda t: F.struct(t["name"].alias("name"), t["words"].alias("words")))
    return found.select("conv_id", turns.alias("turns"))


def as_paths(turns: DataFrame) -> DataFrame:
    """conv_id, path (names) and words of conversations (conv_id, turns)."""
    return turns.select(
        "conv_id",
        F.transform("turns", lambda t: t["name"]).alias("path"),
        F.transform("turns", lambda t: t["words"]).alias("words"),
    )


def _hash_blocks(batches):
    """Rows (key, block, first, copies, ids), sorted by key and block: one row per key, its ids hashed."""
    key, state, first, copies = None, None, 0, 0
    for batch in batches:
        done = []
        for k, _, f, n, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if k != key:
                if state is not None:
                    done.append((first, copies, state.hexdigest()))
                key, state, first, copies = k, hashlib.sha256(), f, 0
            else:
                state.update(b",")
            state.update(ids.encode())
            copies += n
        if done:
            yield _rows(done)
    if state is not None:
        yield _rows([(first, copies, state.hexdigest())])


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    first, copies, ends = zip(*rows, strict=True)
    columns = [pa.array(first, pa.int64()), pa.array(copies, pa.int64()), pa.array(ends, pa.string())]
    return pa.RecordBatch.from_arrays(columns, ["conv_id", "copies", "ends"])


def distinct_paths(paths: DataFrame) -> DataFrame:
    """One row per distinct path: path, words, conv_id (the smallest), copies, ends (SHA-256 of all its
    ids in order, joined by commas)."""
    # the path as text without doubt where a turn ends: all names have 16 bytes
    key = F.unhex(F.sha2(F.array_join(F.transform("path", F.hex), "").cast("binary"), 256))
    blocks = (
        paths.select(key.alias("key"), F.shiftright("conv_id", BLOCK_BITS).alias("block"), "conv_id")
        .groupBy("key", "block")
        .agg(
            F.min("conv_id").alias("first"),
            F.count(F.lit(1)).alias("n"),
            # ids are distinct, so a block has at most 2^BLOCK_BITS of them
            F.array_join(F.sort_array(F.collect_list("conv_id")), ",").alias("ids"),
        )
        .repartition("key")
        .sortWithinPartitions("key", "block")
        .select("key", "block", "first", "n", "ids")
    )
    hashed = blocks.mapInArrow(_hash_blocks, "conv_id long, copies long, ends string")
    return paths.join(hashed, "conv_id").select("path", "words", "conv_id", "copies", "ends")


class _Level:
    """The nodes of one depth of a shard, in order."""

    def __init__(self, parent, words, rep, sums, ends):
        self.parent, self.words, self.rep, self.ends = parent, words, rep, ends
        for name, values in zip(_SUMS, sums, strict=True):
            setattr(self, name, values)


class _Rows:
    """Paths of a shard: names of turns as dense ids in their own order, sums per row and depth.

    `sums` has a flat array per name of _SUMS, with an entry for each depth of each row, the root's first.
    """

    def __init__(self, names: np.ndarray, words: np.ndarray, lengths: np.ndarray, sums: list, ends: list):
        self.words, self.lengths, self.sums, self.ends = words, lengths, sums, ends
        # names as two big-endian numbers: their order is that of the bytes
        order = np.lexsort((names[:, 1], names[:, 0]))
        new = np.any(names[order[1:]] != names[order[:-1]], axis=1)
        self.ids = np.empty(len(names), np.int32)
        self.ids[order] = np.cumsum(np.concatenate([[0], new]))[: len(names)]
        self.turn_at = np.concatenate([[0], np.cumsum(lengths)])[:-1]
        self.sum_at = self.turn_at + np.arange(len(lengths))  # a row has one depth more than turns

    def levels(self) -> tuple[list[_Level], np.ndarray, np.ndarray]:
        """The nodes of every depth, the node each row ends in, the rows in order."""
        count, lengths = len(self.lengths), self.lengths
        order = np.arange(count)
        node = np.zeros(count, np.int64)  # of each row at the depth before, by place in the order
        ending = np.zeros(count, np.int64)
        out = [self._level(np.zeros(count, np.int64), order, np.zeros(1, np.int64), 0, None)]
        places = np.flatnonzero(lengths > 0)  # of the rows that go on, in the order
        for base in range(0, int(lengths.max(initial=0)), PANEL):
            rows = order[places]
            panel = self._panel(rows, base)
            # the columns, the first one last, behind the node of the depth before
            keys = (*panel.T[::-1], node[places])
            by = np.lexsort(keys)
            rows, panel, before = rows[by], panel[by], node[places][by]
            order[places] = rows
            changed = np.empty(panel.shape, bool)
            changed[0] = True
            changed[1:] = panel[1:] != panel[:-1]
            changed[1:, 0] |= before[1:] != before[:-1]
            starts = np.logical_or.accumulate(changed, axis=1)
            for column in range(panel.shape[1]):
                on = np.flatnonzero(panel[:, column] >= 0)
                if not len(on):
                    break
                first = np.flatnonzero(starts[on, column])
                number = np.cumsum(starts[on, column]) - 1
                depth = base + column + 1
                parent = before[on[first]]
                out.append(self._level(number, rows[on], first, depth, parent))
                before[on] = number
                ending[rows[on]] = number
            node[places] = before
            places = places[lengths[order[places]] > base + PANEL]
        return out, ending, order

    def _panel(self, rows: np.ndarray, base: int) -> np.ndarray:
        """The ids of PANEL turns from `base` on of each of `rows`, -1 behind the last turn."""
        width = int(min(PANEL, self.lengths[rows].max() - base))
        at = base + np.arange(width)
        inside = at < self.lengths[rows][:, None]
        places = np.where(inside, self.turn_at[rows][:, None] + at, 0)
        return np.where(inside, self.ids[places], np.int32(-1))

    def _level(self, number, rows, first, depth: int, parent) -> _Level:
        """The nodes of a depth: `rows` in order, `first` the places where a node starts."""
        at = self.sum_at[rows] + depth
        by = [np.minimum if name == "first" else np.add for name in _SUMS]
        sums = [f.reduceat(s[at], first) for f, s in zip(by, self.sums, strict=True)]
        rep = rows[first]
        words = self.words[self.turn_at[rep] + depth - 1] if depth else np.zeros(1, np.int64)
        ends: dict[int, str] = {}
        for row, node in zip(rows.tolist(), number.tolist(), strict=True) if self._sparse else ():
            if (found := self.ends[self.sum_at[row] + depth]) is not None:
                ends[node] = found
        if not self._sparse:  # a row's end is known by its length
            last = self.lengths[rows] == depth
            ends = dict(
                zip(number[last].tolist(), [self.ends[r] for r in rows[last].tolist()], strict=True)
            )
        return _Level(parent, words, rep, sums, ends)

    #: Whether `ends` has an entry for each row and depth (boundary paths), or one for each row.
    _sparse = False


def _chain(names: list[bytes]) -> list[bytes]:
    """A name for each start of a path, the empty one first."""
    state, out = hashlib.sha256(), []
    out.append(state.digest()[:16])
    for name in names:
        state.update(name)
        out.append(state.digest()[:16])
    return out


def _walk(levels: list[_Level], depth: int, node: int) -> list[int]:
    """The nodes from the root down to a node."""
    found = [node]
    for d in range(depth, 0, -1):
        found.append(int(levels[d].parent[found[-1]]))
    return found[::-1]


def _fold(rows: _Rows, names: list, known_refs: list | None, last: bool):
    """The nodes that are complete, as columns of _CLOSED, and the boundary paths, as structs.

    `names(r)` gives the names of row r; `known_refs` the name of each start of each row, once there is
    one; with `last` no other shard is left and every node is complete.
    """
    levels, ending, order = rows.levels()
    open_at: list[list[int]] = [[] for _ in levels]
    refs_of: list[dict[int, bytes]] = [{} for _ in levels]
    boundary = []
    if not last:
        for row in dict.fromkeys((int(order[0]), int(order[-1]))):
            length = int(rows.lengths[row])
            walk = _walk(levels, length, int(ending[row]))
            new = [node not in open_at[d] for d, node in enumerate(walk)]
            for d, node in enumerate(walk):
                if new[d]:
                    open_at[d].append(node)
            refs = _chain(names(row))
            for d, node in enumerate(walk):
                refs_of[d][node] = refs[d]
            boundary.append((row, walk, new, refs))
    closed = []
    for d in range(len(levels) - 1, -1, -1):
        level = levels[d]
        complete = np.ones(len(level.rep), bool)
        complete[open_at[d]] = False
        level.leaves = np.where(level.children == 0, complete, level.leaves)
        level.saved = level.saved + np.where(complete, (level.convs - 1) * level.words, 0)
        if d and complete.any():
            above, parent = levels[d - 1], level.parent[complete]
            np.add.at(above.children, parent, 1)
            np.add.at(above.leaves, parent, level.leaves[complete])
            np.add.at(above.saved, parent, level.saved[complete])
        nodes = np.flatnonzero(complete)
        if not len(nodes):
            continue
        refs: list = [None] * len(nodes)
        if known_refs is not None:
            refs = [known_refs[r][d] for r in level.rep[nodes].tolist()]
        closed.append((d, nodes, refs))
    batches = [_closed_batch(levels, open_at, refs_of, *c) for c in reversed(closed)]
    paths = []
    for row, walk, new, refs in boundary:
        sums = {}
        for name in _SUMS:
            values = [int(getattr(levels[d], name)[node]) for d, node in enumerate(walk)]
            none = _NONE if name == "first" else 0
            sums[name] = [v if n else none for v, n in zip(values, new, strict=True)]
        ends = [levels[d].ends.get(node) if new[d] else None for d, node in enumerate(walk)]
        at = int(rows.turn_at[row])
        words = rows.words[at : at + int(rows.lengths[row])].tolist()
        paths.append({"path": names(row), "words": words, "refs": refs, "ends": ends, **sums})
    return batches, paths


_EMPTY = hashlib.sha256(b"").hexdigest()


def _closed_batch(levels, open_at, refs_of, depth: int, nodes: np.ndarray, refs: list) -> dict:
    level = levels[depth]
    parents: list = [None] * len(nodes)
    parent_refs: list = [None] * len(nodes)
    if depth:
        above, parent = levels[depth - 1], level.parent[nodes]
        parents = above.first[parent].tolist()
        for node in open_at[depth - 1]:
            for i in np.flatnonzero(parent == node).tolist():
                parents[i], parent_refs[i] = None, refs_of[depth - 1][node]
    return {
        "depth": np.full(len(nodes), depth),
        "conv_id": level.first[nodes],
        "parent_conv_id": parents,
        "parent_ref": parent_refs,
        "n_convs": level.convs[nodes],
        "n_children": level.children[nodes],
        "n_leaves": level.leaves[nodes],
        "saved_tokens": level.saved[nodes],
        "ends_sha256": [level.ends.get(n, _EMPTY) for n in nodes.tolist()],
        "ref": refs,
    }


_KINDS = {"parent_ref": pa.binary(), "ref": pa.binary(), "ends_sha256": pa.string()}
_OPEN_TYPE = pa.struct(
    [
        ("path", pa.list_(pa.binary())),
        ("words", pa.list_(pa.int32())),
        ("refs", pa.list_(pa.binary())),
        ("ends", pa.list_(pa.string())),
        *[(name, pa.list_(pa.int64())) for name in _SUMS],
    ]
)


def _emit(shard: int, batches: list[dict], paths: list[dict]):
    """Batches of the columns shard, those of _CLOSED, open."""
    names = [f.split()[0] for f in _CLOSED.split(", ")]

    def batch(size: int, columns: dict, open_: list):
        arrays = [pa.array([shard] * size, pa.int64())]
        for name in names:
            kind = _KINDS.get(name, pa.int64())
            arrays.append(pa.array(columns[name], kind) if columns else pa.nulls(size, kind))
        arrays.append(pa.array(open_, _OPEN_TYPE))
        return pa.RecordBatch.from_arrays(arrays, ["shard", *names, "open"])

    for columns in batches:
        size = len(columns["depth"])
        for at in range(0, size, 20_000):
            part = {k: v[at : at + 20_000] for k, v in columns.items()}
            count = len(part["depth"])
            yield batch(count, part, [None] * count)
    if paths:
        yield batch(len(paths), {}, paths)


def _names_of(flat: pa.Array) -> np.ndarray:
    """16-byte names as rows of two big-endian numbers."""
    joined = b"".join(flat.to_pylist())
    return np.frombuffer(joined, ">u8").reshape(-1, 2).astype(np.uint64)


def _list_column(column) -> tuple[np.ndarray, pa.Array]:
    """Lengths and flat values of a list column without nulls."""
    column = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    return column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64), column.flatten()


def _fold_shard(batches):
    """One partition is one shard: rows (shard, path, words, conv_id, copies, ends)."""
    table = [b for b in batches if b.num_rows]
    if not table:
        return
    table = pa.Table.from_batches(table)
    lengths, flat = _list_column(table["path"])
    _, words = _list_column(table["words"])
    copies, first = (table[c].to_numpy() for c in ("copies", "conv_id"))
    depths = lengths + 1
    zeros = np.zeros(int(depths.sum()), np.int64)
    sums = [np.repeat(copies, depths), np.repeat(first, depths), zeros, zeros, zeros]
    rows = _Rows(_names_of(flat), words.to_numpy().astype(np.int64), lengths, sums, table["ends"].to_pylist())
    path = table["path"]
    found = _fold(rows, lambda r: path[r].as_py(), None, last=False)
    yield from _emit(table["shard"][0].as_py(), *found)


def _fold_group(last: bool):
    """Boundary paths of neighbouring shards."""

    def fold(key, table):
        table = table.sort_by("place")
        found = table["open"].to_pylist()
        paths = [p["path"] for p in found]
        lengths = np.array([len(p) for p in paths], np.int64)
        names = _names_of(pa.array([n for p in paths for n in p], pa.binary()))
        words = np.array([w for p in found for w in p["words"]], np.int64)
        sums = [np.array([v for p in found for v in p[name]], np.int64) for name in _SUMS]
        rows = _Rows(names, words, lengths, sums, [e for p in found for e in p["ends"]])
        rows._sparse = True
        refs = [p["refs"] for p in found]
        batches = _emit(key[0].as_py(), *_fold(rows, lambda r: paths[r], refs, last))
        return pa.Table.from_batches(list(batches))

    return fold


def prefix_trie(paths: DataFrame, shard_turns: int = SHARD_TURNS, group: int = GROUP) -> DataFrame:
    """The nodes of the trie of `paths` (conv_id, path, words; conv_id distinct).

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens (the sum
    of (n_convs - 1) * words over the subtree), ends_sha256.
    """
    stored, seen = materialise(
        distinct_paths(paths), "trie-paths", turns=F.sum(F.size("path") + 1)
    )
    shards = groups_for(seen["turns"] or 0, shard_turns)
    dealt = stored.repartitionByRange(shards, "path").select(
        F.spark_partition_id().cast("long").alias("shard"), "*"
    )
    schema = f"shard long, {_CLOSED}, {_OPEN}"
    folded, seen = materialise(
        dealt.mapInArrow(_fold_shard, schema), "trie-shards", highest=F.max("shard")
    )
    closed = [folded.where("depth IS NOT NULL")]
    left = (seen["highest"] or 0) + 1
    while True:
        last = left <= group
        grouped = folded.where("open IS NOT NULL").select(
            F.floor(F.col("shard") / group).alias("key"), F.col("shard").alias("place"), "open"
        )
        nodes = grouped.groupBy("key").applyInArrow(_fold_group(last), schema)
        folded, _ = materialise(nodes, "trie-group")
        closed.append(folded.where("depth IS NOT NULL"))
        if last:
            break
        left = groups_for(left, group)
    every = closed[0].drop("shard", "open")
    for more in closed[1:]:
        every = every.union(more.drop("shard", "open"))
    # boundary nodes, a few per shard, by the names that rows closed below them carry
    known = every.where("ref IS NOT NULL").select(
        F.col("ref").alias("parent_ref"), F.col("conv_id").alias("joined_conv_id")
    )
    waiting = every.where("parent_ref IS NOT NULL").join(known, "parent_ref")
    waiting = waiting.withColumn("parent_conv_id", F.col("joined_conv_id"))
    columns = [
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
    ]
    return every.where("parent_ref IS NULL").select(*columns).union(waiting.select(*columns))
