"""From raw documents to packed training sequences.

Every stage takes (spark, docs, folder of the tables) and returns a DataFrame that is written as Parquet
and read again as the docs of the next stage. All but the last return the columns of documents. Null,
empty and repeated rows follow the operators' rules; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsemill.llm.catalog import WORD_FILE, tokenizer_path
from pulsemill.llm.languages import fit_trigrams, identify
from pulsemill.llm.neardup import drop_near_duplicates
from pulsemill.llm.packing import pack, token_pieces
from pulsemill.llm.personal import redact
from pulsemill.llm.shared import fresh, ready, staged, tables
from pulsemill.llm.windows import drop_repeated_lines

# SQL has neither the samples of the near-duplicate stage nor the tokenizer.
ORACLE_SQL = None


def _like(frame: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of `docs`, with the length of the text that is there now."""
    columns = [
        F.length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(c) for c in docs.columns
    ]
    return frame.select(*columns)


def language_id(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents in a language; those without letters or in none of the languages go."""
    ready(spark)
    language, confidence, accepted = fresh("language", "confidence", "accepted")
    found = identify(
        docs,
        fit_trigrams(docs),
        declared=F.col("lang"),
        host=F.col("source"),
        language=language,
        confidence=confidence,
        accepted=accepted,
    )
    return found.filter(F.col(accepted)).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Texts without the later occurrences of repeated three-line windows."""
    ready(spark)
    return _like(drop_repeated_lines(docs, removed=fresh("removed")[0]), docs)


def near_dedup(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of every class of near duplicates."""
    ready(spark)
    return drop_near_duplicates(docs)


def personal_data(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Texts with personal data replaced by labels."""
    ready(spark)
    return _like(redact(docs, replaced=fresh("replaced")[0]), docs)


def packing(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pieces of the documents with their sequence and place there."""
    ready(spark)
    return pack(token_pieces(docs, tokenizer_path(WORD_FILE)))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("personal_data", personal_data),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs = tables(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
