"""Chat formatting with Spark expressions only: turns to one training text and its loss mask.

The turns of a conversation are collected as structs and sorted; neighbours of the same role become
one block of the output, the texts inside a block are told apart by a mark, so nothing is lost:

    ### user: first text<more>second text</turn>
    ### assistant: answer</turn>

Control strings inside texts and roles (`###`, `</turn>`, `<more>`, and the `: ` that ends a role) are
broken up by a backslash, a backslash is doubled; so no control string stands in the output but those
of the template, and `read_back` finds the turns by plain splitting.  The loss mask names, for each
turn in order, the stretch of the output under the loss: its escaped text if its role is trained, a
stretch of length 0 if not.

Every step is linear in the conversation: neighbours are met by arrays shifted by one place, running
sums go in two levels.  Rows of one conversation are put together in the map tasks before they are
exchanged; a conversation is one row of the result, so a single one must fit a task, as its text must.

Order: by turn, null turns first, ties by role, then text.  Null roles and texts count as empty.  Rows
that repeat are turns of their own.  Rows without a conversation id form one conversation without an
id.  An empty table gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEAD, ROLE_END, MORE, END = "### ", ": ", "<more>", "</turn>\n"
#: Where a backslash breaks a control string; the `: ` only matters in roles.
_CONTROL = r"(##(?=#)|<(?=/turn>|more>))"
_ROLE_END = "(:)(?= )"
#: Lengths added up one by one before sums of sums are.
_CHUNK = 512


def escape(text: Column, role: bool = False) -> Column:
    """`text` without any control string; `unescape` gives it back."""
    safe = F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), _CONTROL, r"$1\\")
    return F.regexp_replace(safe, _ROLE_END, r"$1\\") if role else safe


def unescape(text: Column) -> Column:
    """A doubled backslash is one, a single one goes."""
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def sorted_turns(rows: DataFrame) -> DataFrame:
    """conv_id and turns (role, text), an array in the order of the turns."""
    turn = F.struct(
        F.col("turn"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    collected = rows.select("conv_id", turn.alias("one")).groupBy("conv_id")
    ordered = collected.agg(F.sort_array(F.collect_list("one")).alias("found"))
    turns = F.transform("found", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return ordered.select("conv_id", turns.alias("turns"))


def _running(lengths: Column) -> Column:
    """The sum of all lengths before each, chunk by chunk, so that no long array is copied often."""
    chunks = F.transform(
        F.sequence(F.lit(0), F.greatest(F.floor((F.size(lengths) - 1) / _CHUNK), F.lit(0)).cast("int")),
        lambda k: F.slice(lengths, k * _CHUNK + 1, F.lit(_CHUNK)),
    )

    def before(sizes: Column, base: Column) -> Column:
        """Running sums of `sizes` from `base` on, the whole sum last."""
        return F.aggregate(
            sizes, F.array(base), lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n))
        )

    zero = F.lit(0).cast("long")
    totals = F.transform(chunks, lambda c: F.aggregate(c, zero, lambda acc, n: acc + n))
    zipped = F.zip_with(
        chunks,
        before(totals, zero),
        # the array of sums has one element more than there are chunks
        lambda c, base: F.when(
            c.isNotNull(), F.slice(before(c, base), F.lit(1), F.size(c))
        ).otherwise(F.array().cast("array<bigint>")),
    )
    return F.flatten(zipped)


def format_chat(turns: DataFrame, trained: str = "assistant") -> DataFrame:
    """conv_id, formatted, n_blocks and loss_mask of `sorted_turns`.

    loss_mask has a struct (start, length: long, in code points from 0) for each turn.
    """
    roles = F.transform("turns", lambda t: t["role"])
    none = F.array(F.lit(None).cast("string"))
    n = F.size("turns")
    shifted = turns.select(
        "conv_id",
        "turns",
        F.concat(none, F.slice(roles, F.lit(1), n - 1)).alias("role_before"),
        F.concat(F.slice(roles, F.lit(2), n), none).alias("role_after"),
    )
    # merge: a turn opens a block where the role before it is another, closes it where the next is
    neighbours = F.arrays_zip("turns", "role_before", "role_after")
    parts = F.transform(
        neighbours,
        lambda t: F.struct(
            F.when(t["turns"]["role"].eqNullSafe(t["role_before"]), "")
            .otherwise(F.concat(F.lit(HEAD), escape(t["turns"]["role"], role=True), F.lit(ROLE_END)))
            .alias("opening"),
            escape(t["turns"]["text"]).alias("body"),
            F.when(t["turns"]["role"].eqNullSafe(t["role_after"]), MORE).otherwise(END).alias("closing"),
            (t["turns"]["role"] == trained).alias("trained"),
        ),
    )
    pieces = shifted.select("conv_id", parts.alias("parts"))

    def whole(p: Column) -> Column:
        return F.concat(p["opening"], p["body"], p["closing"])

    sized = pieces.select(
        "conv_id",
        "parts",
        F.transform("parts", whole).alias("texts"),
        F.transform("parts", lambda p: F.char_length(whole(p)).cast("long")).alias("lengths"),
    )
    placed = sized.select(
        "conv_id", "parts", "texts", _running(F.col("lengths")).alias("starts")
    )
    mask = F.zip_with(
        "parts",
        "starts",
        lambda p, at: F.struct(
            (at + F.char_length(p["opening"])).alias("start"),
            F.when(p["trained"], F.char_length(p["body"])).otherwise(0).cast("long").alias("length"),
        ),
    )
    return placed.select(
        "conv_id",
        F.array_join("texts", "").alias("formatted"),
        F.size(F.filter("parts", lambda p: p["opening"] != "")).alias("n_blocks"),
        mask.alias("loss_mask"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """The columns of `formatted`, with turns (role, text) and loss_text, both from the output alone.

    loss_text is all text under loss_mask, unescaped.
    """
    blocks = F.split("formatted", f"(?<={END})")
    blocks = F.filter(blocks, lambda b: b != "")  # behind the last mark nothing is left

    def split_block(block: Column) -> Column:
        opening = F.concat(F.substring_index(block, ROLE_END, 1), F.lit(ROLE_END))
        role = unescape(F.substring_index(F.substr(block, F.lit(len(HEAD) + 1)), ROLE_END, 1))
        return F.transform(
            F.split(block, f"(?<={MORE})"),
            lambda part, i: F.struct(
                role.alias("role"),
                part.alias("part"),
                F.when(i == 0, F.char_length(opening)).otherwise(0).alias("skip"),
            ),
        )

    cut = formatted.select("*", F.flatten(F.transform(blocks, split_block)).alias("_parts"))
    lengths = F.transform("_parts", lambda p: F.char_length(p["part"]).cast("long"))
    cut = cut.select("*", lengths.alias("_lengths"))
    cut = cut.select("*", _running(F.col("_lengths")).alias("_starts"))

    def text(p: Column) -> Column:
        body = F.substr(p["part"], p["skip"] + 1)
        return unescape(F.regexp_replace(body, f"{MORE}|{END}", ""))

    turns = F.transform("_parts", lambda p: F.struct(p["role"].alias("role"), text(p).alias("text")))
    under = F.zip_with(
        "_parts",
        F.arrays_zip("_starts", "loss_mask"),
        lambda p, m: unescape(
            F.substr(
                p["part"],
                (m["loss_mask"]["start"] - m["_starts"] + 1).cast("int"),
                m["loss_mask"]["length"].cast("int"),
            )
        ),
    )
    return cut.select(
        *formatted.columns, turns.alias("turns"), F.array_join(under, "").alias("loss_text")
    )
