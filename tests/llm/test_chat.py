"""Chat formatting: reversible output, loss mask, merged blocks, edge rows."""

from __future__ import annotations

import random
import time

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"
PIECES = ["#", "##", "###", "\\", "</turn>", "<", "/turn>", "<more>", ": ", ":", " ", "\n", "é", "x", "<\\"]


def formatted(rows):
    return chat.read_back(chat.format_chat(chat.sorted_turns(rows)))


def plain(turns):
    """Output and blocks of turns (role, text), written out plainly."""

    def safe(text, role=False):
        text = text.replace("\\", "\\\\").replace("</turn>", "<\\/turn>").replace("<more>", "<\\more>")
        out = ""
        for c in text:
            hashes = len(out) - len(out.rstrip("#"))
            out += ("\\" if c == "#" and hashes == 2 else "") + c
        return out.replace(": ", ":\\ ") if role else out

    out, blocks = "", 0
    for i, (role, text) in enumerate(turns):
        if i == 0 or turns[i - 1][0] != role:
            out += f"### {safe(role, True)}: "
            blocks += 1
        out += safe(text)
        out += "<more>" if i + 1 < len(turns) and turns[i + 1][0] == role else "</turn>\n"
    return out, blocks


def test_reads_back_what_went_in(spark):
    rng = random.Random(11)

    def text():
        return "".join(rng.choices(PIECES, k=rng.randint(0, 12)))

    rows = []
    for conv in range(150):
        roles = ["user", "assistant", text()]
        rows += [(conv, t, rng.choice(roles), text()) for t in range(rng.randint(1, 9))]
    rng.shuffle(rows)
    got = {r.conv_id: r for r in formatted(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()}
    assert len(got) == 150
    for conv in range(150):
        turns = [(r, t) for _, _, r, t in sorted(r for r in rows if r[0] == conv)]
        assert [tuple(t) for t in got[conv].turns] == turns
        assert got[conv].loss_text == "".join(t for r, t in turns if r == "assistant")
        assert (got[conv].formatted, got[conv].n_blocks) == plain(turns)
        inner = got[conv].formatted
        for (role, t), (start, length) in zip(turns, got[conv].loss_mask, strict=True):
            assert (length > 0) == (role == "assistant" and t != "")
            assert plain([("", t)])[0] == f"### : {inner[start : start + length]}</turn>\n" or not length


def test_nulls_ties_repeats_and_other_columns(spark):
    rows = [
        (1, None, "user", "first"),
        (1, 0, None, None),
        (1, 1, "assistant", "b"),
        (1, 1, "assistant", "a"),
        (1, 1, "assistant", "a"),
        (None, 5, "user", "no id"),
        (None, 4, "assistant", ""),
    ]
    frame = spark.createDataFrame(rows, SCHEMA).select(
        "*", *[F.lit("x").alias(c) for c in ("turns", "parts", "formatted", "_parts", "one", "found")]
    )
    got = {r.conv_id: r for r in formatted(frame).collect()}
    assert [tuple(t) for t in got[1].turns] == [
        ("user", "first"), ("", ""), ("assistant", "a"), ("assistant", "a"), ("assistant", "b"),
    ]
    assert got[1].loss_text == "aab" and got[1].n_blocks == 3
    assert got[1].formatted.endswith("### assistant: a<more>a<more>b</turn>\n")
    assert [tuple(t) for t in got[None].turns] == [("assistant", ""), ("user", "no id")]
    assert formatted(frame.limit(0)).count() == 0


@pytest.mark.parametrize("one_role", [True, False])
def test_a_very_long_conversation_takes_linear_time(spark, one_role):
    role = F.lit("assistant") if one_role else F.element_at(F.array(F.lit("user"), F.lit("assistant")), (F.col("id") % 2 + 1).cast("int"))
    rows = spark.range(40_000).select(
        F.lit(3).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        role.alias("role"),
        F.concat(F.lit("text <more> "), F.col("id")).alias("text"),
    )
    began = time.perf_counter()
    (got,) = formatted(rows).select(F.size("turns").alias("n"), F.length("loss_text").alias("chars")).collect()
    wanted = sum(len(f"text <more> {i}") for i in range(40_000) if one_role or i % 2)
    assert tuple(got) == (40_000, wanted)
    assert time.perf_counter() - began < 30


def test_plan_is_native_with_one_exchange(spark):
    rows = spark.createDataFrame([(1, 0, "user", "x")], SCHEMA)
    plan = formatted(rows)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "Window", "Join"))
    assert plan.count("Exchange") == 1
