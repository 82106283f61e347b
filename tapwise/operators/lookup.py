"""Joins of a large table to a lookup table by key."""

from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F, types as T

BROADCAST_LIMIT_BYTES = 52_428_800  # fixed value: 50 MiB


def broadcast_bytes(df: DataFrame) -> int:
    """Measured size of `df` as a broadcast relation, by one aggregate over its text columns.

    A row costs eight bytes for each column and eight for its null bits; text adds its bytes,
    padded to words. Spark's own hash table adds an offset and a key per row.
    """
    fixed, texts = 8 * (len(df.columns) + 3), []
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            texts.append(F.coalesce(F.octet_length(field.name), F.lit(0)) + 8)
        elif not isinstance(field.dataType, (T.NumericType, T.BooleanType, T.DateType,
                                             T.TimestampType, T.TimestampNTZType)):
            raise TypeError(f"column {field.name} has no bounded width; project it away first")
    variable = sum((F.sum(t.cast("bigint")) for t in texts), F.lit(0))
    rows, text_bytes = df.agg(F.count(F.lit(1)), F.coalesce(variable, F.lit(0))).first()
    return rows * fixed + text_bytes


class MeasuredLookup(NamedTuple):
    """A lookup table whose size is known, for joins that are made again and again."""

    rows: DataFrame
    bytes: int


def measured(rows: DataFrame) -> MeasuredLookup:
    return MeasuredLookup(rows, broadcast_bytes(rows))


def joins_by_key(lookup: MeasuredLookup, broadcast_limit: int = BROADCAST_LIMIT_BYTES) -> bool:
    """Whether `lookup_join` moves the large table by the key instead of broadcasting the lookup table."""
    return lookup.bytes > broadcast_limit


def lookup_join(facts: DataFrame, lookup: DataFrame | MeasuredLookup, key, how: str = "inner",
                broadcast_limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Join to a lookup table that has one row per key.

    The lookup table is broadcast only when its measured size is within the limit. A larger one
    goes through a sort-merge join, where AQE splits the partitions of hot keys by size and repeats
    the matching lookup rows. Nothing downstream of that join may count on its partitioning.
    """
    if not isinstance(lookup, MeasuredLookup):
        lookup = measured(lookup)
    if not joins_by_key(lookup, broadcast_limit):
        return facts.join(F.broadcast(lookup.rows), key, how)
    return facts.join(lookup.rows.hint("merge"), key, how)
