"""Row keys made of content, the same however often and wherever a row is computed again."""

from pyspark.sql import Column, DataFrame, functions as F

KEY = ["_key", "_text_key"]


def with_key(documents: DataFrame) -> DataFrame:
    """The rows (doc_id, text) with a 128-bit key; only rows equal in both columns share one."""
    doc_id, text = documents["doc_id"].cast("long"), documents["text"]
    return documents.select(doc_id.alias("doc_id"), text.alias("text"), F.xxhash64(doc_id, text).alias("_key"),
                            F.xxhash64(text, F.lit("text")).alias("_text_key"))


def key_columns() -> list[Column]:
    """The same key for a table that keeps its other columns."""
    doc_id = F.col("doc_id").cast("long")
    return [F.xxhash64(doc_id, F.col("text")).alias("_key"), F.xxhash64(F.col("text"), F.lit("text")).alias("_text_key")]
