"""A corpus from documents to packed sequences: five stages, each written and read again by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from osspulse.llm import decontaminate, langid, packing, sentence_spans, simhash
from osspulse.llm.common import renamed, stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that can be told: those without a letter go."""
    plain, names, back = renamed(docs)
    found = langid.identify(plain, names["doc_id"], names["text"], names["lang"])
    return found.filter(F.col("lang_pred") != langid.UNKNOWN).select(back)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id."""
    return simhash.keep_one(docs)


def repeated_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the sentences that others have had before them; those that lose all go.

    `n_chars` follows the text.
    """
    plain, names, back = renamed(docs)
    found = sentence_spans.remove_repeats(plain, names["doc_id"], names["text"])
    text = F.col(names["text"])
    left = found.filter((F.col("n_removed") == 0) | (F.trim(text) != ""))
    if "n_chars" in names:
        size = F.when(F.col("n_removed") > 0, F.char_length(text).cast(docs.schema["n_chars"].dataType))
        left = left.withColumn(names["n_chars"], F.coalesce(size, F.col(names["n_chars"])))
    return left.select(back)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by test items."""
    return decontaminate.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens and their places in sequences of 2048."""
    pieces = packing.token_pieces(docs.select("doc_id", "text"), keep_ids=False).drop("ids")
    return packing.pack(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES: list[tuple[str, Stage]] = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("repeated_spans", repeated_spans),
    ("benchmark", benchmark),
    ("pack", pack),
]

# SQL has no tokenizer, no fitted classifier and no fingerprints of this kind.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
