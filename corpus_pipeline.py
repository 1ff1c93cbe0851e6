"""A corpus pipeline: language, quality, near duplicates, mixing, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows of ``docs``,
which are what the stage before it kept, written as Parquet and read again.
All but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docsift.llm import langid, mixing, ngram_join, packing, quality
from docsift.llm.common import documents, free_name, work_path
from docsift.session import ship_package


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a known language (operator 4): no letters, or
    letters that no learned language explains. Learns from the documents with
    a language; if none has one, all documents go."""
    ship_package(spark)
    mark = free_name(docs.columns, "language")
    return langid.predict(docs, langid.fit(docs), into=mark).where(langid.speaks(mark)).drop(mark)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that fail the base rules or fall below the ratio of
    trusted to raw text (operator 2). Trusted: labelled of good quality."""
    trusted = documents(spark, sf_dir, "labels").where("quality = 1")
    mark = free_name(docs.columns, "quality")
    return quality.score(docs, quality.fit(docs, trusted), into=mark).where(f"`{mark}`.kept").drop(mark)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies (operator 8): word
    5-grams, similarity of 0.8 or more."""
    ship_package(spark)
    return ngram_join.one_of_each(docs, width=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sample sources to their target weights (operator 9); a document comes
    as often as it is taken."""
    return mixing.mixture(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the mix into sequences of 4096 tokens (operator 10): one row per
    piece with its sequence and place."""
    ship_package(spark)
    return packing.pack(packing.pieces(docs))


STAGES = [
    ("language_id", language_id),
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

#: The language model and the tokenizer have no SQL form; tests compare every
#: stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages from the table ``documents`` on; the last one's rows."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        path = work_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
