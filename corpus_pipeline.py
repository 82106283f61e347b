"""The corpus pipeline: documents in, training sequences out, in five stages.

Each stage takes the session, the documents that the stage before it kept and the folder of tables.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from tapwise.llm import decontaminate, language, line_templates, ngram_join, packing
from tapwise.llm.queries import tokenizer_path
from tapwise.sources.folders import written_once


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language learned from their own labels; texts without letters go."""
    return language.in_known_language(docs, language.learn_languages(docs))


def drop_recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without recurring lines; n_chars follows, and documents of which nothing is left go."""
    changed = line_templates.without_recurring_lines(docs)
    left = (F.col("n_dropped") == 0) | (F.length(F.trim("text")) > 0)
    n_chars = F.when(F.col("n_dropped") == 0, F.col("n_chars")).otherwise(F.length("text").cast("long"))
    return changed.filter(left).select(*[n_chars.alias(c) if c == "n_chars" else c for c in docs.columns])


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word n-grams at a similarity of 0.8 or more."""
    return ngram_join.keep_one_of_each(docs, words=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    return decontaminate.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences along the curve."""
    return packing.pack_along_curve(docs, tokenizer_path())


STAGES = [
    ("language_id", keep_known_languages),
    ("line_dedup", drop_recurring_lines),
    ("ngram_join", keep_one_of_near_copies),
    ("decontaminate", drop_contaminated),
    ("packing", pack),
]

ORACLE_SQL = None  # automata, templates and the curve have no SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result but the last is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written_once(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
