"""Running totals over a table that is cut into ordered parts, without gathering its rows."""

from pyspark.sql import DataFrame, Window, functions as F


def part_starts(parts: DataFrame, part: str, size: str) -> DataFrame:
    """Table (part, start) with the total size of all parts before each one.

    Sizes are summed before the shuffle, so the window sorts one row for each part of the table and the result
    is small enough to broadcast: a row for each task that wrote it.
    """
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return (
        parts.groupBy(part).agg(F.sum(size).alias("_size"))
        .select(part, F.coalesce(F.sum("_size").over(before), F.lit(0)).cast("long").alias("start"))
    )
