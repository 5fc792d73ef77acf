"""One query per operator, with production parameters, over the whole table it is meant for."""

from __future__ import annotations

import functools

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import (
    chat,
    lines,
    packing,
    periodic,
    quality,
    secret_scan,
    sentencepieces,
    simhash,
    suffixes,
    topk,
    toxicity,
    trie,
    vectors,
)
from ledgerloom.llm.common import read, ship_package
from ledgerloom.session import materialise


def op1_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = topk.integer_vectors(read(spark, sf_dir, "embeddings"))
    return topk.top_k(rows, F.col("vec_id") % 100 == 0)


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_pieces(
        read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")
    )


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents")).select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded, decoded and held against the library."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    return sentencepieces.checked(read(spark, sf_dir, "documents"), path, F.lit(True))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sites are sources, their paths the languages in them."""
    docs = read(spark, sf_dir, "documents")
    model = quality.train(docs, read(spark, sf_dir, "labels"))
    scored = quality.score(docs, model, F.col("source"), F.col("lang"))
    return scored.select(
        "doc_id",
        quality.held_out(F.col("doc_id")).alias("held_out"),
        "own",
        "path_mean",
        "score",
        (F.col("score") >= 0.5).alias("kept"),
    )


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = toxicity.train(docs, read(spark, sf_dir, "labels"))
    return docs.select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        toxicity.scores(docs, model).alias("score"),
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op7_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    def count(kind: str):
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")

    base = secret_scan.span_list(F.col("found"), secret_scan.BASE_KINDS)
    return (
        read(spark, sf_dir, "documents")
        .select("doc_id", secret_scan.secret_spans(F.col("text")).alias("found"))
        .select(
            "doc_id",
            *[count(kind).alias(f"n_{kind}") for kind in secret_scan.BASE_KINDS],
            F.sha2(base.cast("binary"), 256).alias("base_sha256"),
            secret_scan.span_list(F.col("found")).alias("spans"),
        )
    )


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.dedup_strings(read(spark, sf_dir, "documents")).select(
        F.col("row.doc_id").alias("doc_id"),
        "n_bytes",
        "n_removed",
        "n_spans",
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(read(spark, sf_dir, "embeddings"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedup_lines(read(spark, sf_dir, "documents")).select(
        F.col("row.doc_id").alias("doc_id"),
        "n_lines",
        "n_dropped",
        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"),
    )


#: A conversation whose texts hold the control strings of many templates.
CONTROL_CONVERSATION, CONTROL_TEXT = -7, r"\### Assistant: </turn> ok"


def op11_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and the one of control strings; every column is read from the output."""
    planted = spark.range(2).select(
        F.lit(CONTROL_CONVERSATION).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROL_TEXT).alias("text"),
    )
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    back = chat.read_back(chat.format_chat(chat.sorted_turns(rows.union(planted))))
    line, digested = F.lit("\n"), F.col("turns")
    digested = F.transform(digested, lambda t: F.concat(t["role"], line, t["text"], line))
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(digested, "").cast("binary"), 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        F.col("n_blocks").cast("long").alias("n_blocks"),
    )


def _with_planted_runs(text: Column, doc_id: Column) -> Column:
    """`text`, or for a tenth of all ids its words, made periodic from some word on.

    With h = crc32 of the id and g = h / 10: where h is divisible by 10, each word i >= a = g % n becomes
    word a + (i - a) % p, p = 1 + (n - a) / (3 + g % 8), whole numbers.  A row without an id is left.
    """
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n = F.size(words)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    root = F.slice(words, a + 1, p)
    tail = F.slice(F.flatten(F.array_repeat(root, F.ceil((n - a) / p).cast("int"))), F.lit(1), n - a)
    rebuilt = F.array_join(F.concat(F.slice(words, F.lit(1), a), tail), " ")
    return F.when((h % 10 == 0) & (n > 0), rebuilt).otherwise(text)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    text = _with_planted_runs(F.col("text"), F.col("doc_id"))
    found = docs.select("doc_id", periodic.periodic_runs(text).alias("found"))
    best = found.select("doc_id", "found", periodic.strongest(F.col("found.runs")).alias("best"))
    listed = F.transform(
        "found.runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    )
    return best.select(
        "doc_id",
        F.size("found.runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(listed, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("found.collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of rebuilt conversations: each c begins with the first turns of conversation c - c % 20,
    as many as crc32 of c modulo 4 says, and goes on with its own turns behind that many."""
    conv = F.col("conv_id")
    turns = trie.named_turns(read(spark, sf_dir, "conversations"))
    own, _ = materialise(turns, "conversation-turns")
    heads = own.where(conv % 20 == 0).select(
        conv.alias("base"), F.slice("turns", 1, 3).alias("head")
    )
    taken = (F.crc32(conv.cast("string").cast("binary")) % 4).cast("int")
    none = F.slice("turns", 1, 0)
    rebuilt = own.join(heads, conv - conv % 20 == heads["base"], "left").select(
        "conv_id",
        F.concat(
            F.slice(F.coalesce("head", none), F.lit(1), taken),
            F.slice("turns", taken + 1, F.size("turns")),
        ).alias("turns"),
    )
    return trie.prefix_trie(trie.as_paths(rebuilt))


def _query(operator):
    @functools.wraps(operator)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return operator(spark, sf_dir)

    return run


QUERIES = {
    f.__name__: _query(f)
    for f in (
        op1_exact_topk,
        op2_best_fit_packing,
        op3_simhash_near_dedup,
        op4_sentencepiece,
        op5_quality_classifier,
        op6_toxicity,
        op7_secret_scans,
        op8_suffix_array_dedup,
        op9_embedding_near_dedup,
        op10_line_dedup,
        op11_chat_formatting,
        op12_periodic_runs,
        op13_conversation_trie,
    )
}
