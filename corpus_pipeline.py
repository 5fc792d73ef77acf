"""From raw documents to packed training sequences, each stage on all that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of `docs`.  A stage's result is written as Parquet and read again as the next one's docs.
Where a stage changes texts, n_chars follows.  Null texts count as empty and pass the filters.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import lines, packing, secret_scan, simhash, toxicity
from ledgerloom.llm.common import read, ship_package
from ledgerloom.session import materialise


def _with_text(docs: DataFrame, columns: list[str]) -> DataFrame:
    """These columns, with n_chars, where there is one, as the length of `text`."""
    if "n_chars" in columns:
        kind = docs.schema["n_chars"].dataType
        docs = docs.withColumn("n_chars", F.length("text").cast(kind))
    return docs.select(*columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model, fitted on the labelled ones among them, scores below 0.5."""
    ship_package(spark)
    model = toxicity.train(docs, read(spark, sf_dir, "labels"))
    return docs.where(toxicity.scores(docs, model) < 0.5)


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the long lines that at least five of them hold, but for one."""
    ship_package(spark)
    kept = lines.dedup_lines(docs).select("row", F.col("text").alias("kept_text"))
    columns = [F.col("kept_text").alias(c) if c == "text" else F.col(f"row.{c}") for c in docs.columns]
    return _with_text(kept.select(*columns), docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group linked by fingerprints: that with the smallest doc_id, and of several the
    one whose columns have the smallest hash.

    So a row without a doc_id stays only where no row of its group has one, and of rows that repeat a
    doc_id each counts for itself.
    """
    ship_package(spark)
    # columns of `docs`, not names: these may stand in `keepers` too
    row = F.xxhash64(*[docs[c] for c in docs.columns])
    found = simhash.near_duplicates(docs, key=row)
    counted = found.groupBy("component", "doc_id", "row_key").agg(F.count(F.lit(1)).alias("copies"))
    # a grouped minimum: one row per group and map task, also for a group of a third of all rows
    place = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row_key"), F.col("copies"))
    first = counted.groupBy("component").agg(F.min(place).alias("first")).select("first.*")
    keepers, _ = materialise(
        first.select(F.col("doc_id").alias("keeper"), F.col("row_key").alias("keeper_row"), "copies"), "keepers"
    )
    same = docs["doc_id"].cast("long").eqNullSafe(keepers["keeper"]) & (row == keepers["keeper_row"])
    single = docs.join(keepers.where("copies = 1"), same, "left_semi")
    repeated = docs.join(keepers.where("copies > 1"), same, "left_semi").dropDuplicates()
    return single.union(repeated)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret in them replaced by its kind in brackets."""
    ship_package(spark)
    return _with_text(docs.withColumn("text", secret_scan.masked(F.col("text"))), docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in sequences of 2048 tokens."""
    ship_package(spark)
    return packing.packed_pieces(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_shared_lines),
    ("SimHash near-dedup", drop_near_duplicates),
    ("secret scans", mask_secrets),
    ("best-fit packing", pack_sequences),
]

#: Toxicity and tokens cannot be expressed in SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs, _ = materialise(stage(spark, docs, sf_dir), f"stage-{number}")
    return docs
