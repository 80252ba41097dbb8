"""The text pipeline: five stages, each written as Parquet and read again as the next one's documents.

Quality rules drop documents; of near-duplicates one stays; passages that an earlier document has are cut out; documents
that hold benchmark items go; the rest is encoded and decoded by byte-pair encoding.

Ids are whole numbers, texts of any length. A null or empty text fails the quality rules, so later stages of a run see none; by itself each later stage
keeps such a row. Rows with equal ids are judged one by one by the rules and for benchmark items; of near-duplicates all rows with the smallest id of a group
stay, and rows with equal ids take no passages from each other. A row with a null id links with nothing and loses nothing. Ties: the smaller id stays.
Further columns are kept, whatever their names (those that the encoding makes take the place of columns of the same name). Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from gridtide.llm import bpe, leaks, neardup, quality, repeats
from gridtide.session import stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def aside(docs: DataFrame) -> DataFrame:
    """The documents with all columns but id and text renamed, so that no operator takes them for its own."""
    return docs.withColumnsRenamed({c: f"__kept_{c}" for c in docs.columns if c not in ("doc_id", "text")})


def restored(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select(*[F.col(c if c in ("doc_id", "text") else f"__kept_{c}").alias(c) for c in docs.columns])


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep. The classifier learns from the labelled rows of `docs`."""
    model = quality.train(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return restored(quality.judge(aside(docs), model).filter("kept"), docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates; rows with equal ids stay together."""
    return restored(neardup.near_duplicates(aside(docs)).filter("kept"), docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier one has; untouched texts stay as they are, empty rests go."""
    found = repeats.remove_repeats(aside(docs))
    cut = F.col("n_removed") > 0
    text = F.when(cut, F.col("kept_text")).otherwise(F.col("text"))
    found = found.filter("n_removed < n_words OR n_words = 0")
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        found = found.withColumn("__kept_n_chars", F.when(cut, F.char_length("kept_text").cast(kind)).otherwise(F.col("__kept_n_chars")))
    return restored(found.withColumn("text", text), docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    return restored(leaks.find_leaks(aside(docs), table(spark, sf_dir, "benchmark")).filter("size(leaks) = 0"), docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens, and digests of the tokens and of the text that they give back."""
    coded = bpe.encode(docs, decoded="decoded_text")
    ids = F.array_join(F.col("token_ids").cast("array<string>"), " ")
    return coded.select("doc_id", "lang", "source", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids", F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded_text", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", keep_good), ("minhash_near_dedup", drop_near_duplicates), ("substring_dedup", cut_repeats), ("benchmark_decontamination", drop_leaks), ("bpe_encoding", encode),
]

# The encoding cannot be told in SQL; the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
