"""A training corpus from raw documents, one written table per stage.

Documents without a recognisable language go; lines that many documents share
go; one document of each group of near-duplicates stays; documents that hold a
benchmark item go; the rest is packed into training sequences.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phenoloom.llm.common import col, free_name, held_out
from phenoloom.llm.decontaminate import drop_leaks
from phenoloom.llm.language_id import UNDETERMINED, identify_language
from phenoloom.llm.line_dedup import dedup_lines
from phenoloom.llm.packing import pack_tokens
from phenoloom.llm.simhash import keep_one_per_group
from phenoloom.session import staging_root

MIN_LANGUAGE_SCORE = 0.5


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters and with a language that is likelier than all others together."""
    known = docs.filter(~held_out(F.col("doc_id")))
    pred, score = free_name("_lang_pred", docs), free_name("_lang_score", docs)
    scored = identify_language(docs, known, output=(pred, score))
    kept = scored.filter((F.col(pred) != UNDETERMINED) & (F.col(score) >= MIN_LANGUAGE_SCORE))
    return kept.drop(pred, score)


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that other documents keep; ``n_chars`` follows the text."""
    counts = free_name("_n_lines", docs), free_name("_n_dropped", docs)
    kept = dedup_lines(docs, counts=counts).drop(*counts)
    return kept.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(*[col(c) for c in docs.columns])


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id (null ids last)."""
    return keep_one_per_group(docs)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item; all of them if there are no items."""
    return drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every row has at least one piece, its end id, also without a text or an id."""
    packed = pack_tokens(docs)
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("language ID", keep_known_languages),
    ("line dedup", drop_shared_lines),
    ("SimHash near-dedup", keep_distinct),
    ("benchmark decontamination", keep_uncontaminated),
    ("packing", pack),
]

#: Models, fingerprints and token ids have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage but the last is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{staging_root(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs.write.parquet(f"{folder}/{number}")
            docs = spark.read.parquet(f"{folder}/{number}")
    return docs
