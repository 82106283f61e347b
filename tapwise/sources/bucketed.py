"""Transactions laid out in buckets of cards, for reads and merges that move nothing else.

A load rewrites only the buckets of its own cards; the latest row of a key, the history of a card and its join to the
customers are worked out bucket by bucket, without an exchange. A card with very many rows would make its bucket the
slowest task of every read, so such hot cards are kept apart, in buckets of card and day.
"""

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from tapwise.operators.keyed import latest_complete
from tapwise.operators.lookup import lookup_join
from tapwise.schemas import TRANSACTION_KEY
from tapwise.sources.folders import written_once

BUCKETS = 256  # choose it so that a bucket fits a task: rows of all cards / BUCKETS
HOT_ROWS = 1_000_000  # a card with more rows than this is kept by card and day
CARD, TIME = TRANSACTION_KEY
OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


class _Layout:
    """One bucketed table: the bucket of a row is a partition too, so that single buckets can be overwritten."""

    def __init__(self, spark: SparkSession, name: str, path: str, schema: T.StructType, keys: list[str], buckets: int):
        self.spark, self.name, self.keys, self.buckets = spark, name, keys, buckets
        self.schema, self.columns = schema, schema.names
        if not spark.catalog.tableExists(name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
            spark.sql(
                f"CREATE TABLE {name} ({columns}, bucket INT) USING parquet PARTITIONED BY (bucket)"
                f" CLUSTERED BY ({', '.join(keys)}) SORTED BY ({', '.join([*keys, TIME])}) INTO {buckets} BUCKETS"
                f" LOCATION '{path}'")
            place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            if place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
                spark.catalog.recoverPartitions(name)  # another session wrote it

    def rows(self) -> DataFrame:
        return self.spark.table(self.name).select(*self.columns)

    def bucket(self) -> Column:
        """The bucket that Spark's own bucketing gives a row."""
        return F.pmod(F.hash(*self.keys), F.lit(self.buckets))

    def in_buckets(self, numbers: list[int]) -> DataFrame:
        """The rows of some buckets; the others are not read."""
        return self.spark.table(self.name).filter(F.col("bucket").isin(numbers)).select(*self.columns)

    def overwrite(self, rows: DataFrame) -> None:
        """Replace the buckets that `rows` has rows for, one file each; the others are not touched."""
        placed = rows.select(*self.columns, self.bucket().alias("bucket")).repartition(self.buckets, *self.keys)
        with _dynamic_overwrite(self.spark):
            placed.write.mode("overwrite").insertInto(self.name)

    def remove(self, numbers: list[int]) -> None:
        """Empty buckets whose last rows have gone elsewhere."""
        none = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()})" for f in self.schema)
        for number in numbers:
            self.spark.sql(
                f"INSERT OVERWRITE TABLE {self.name} PARTITION (bucket = {number}) SELECT {none} WHERE false")


@contextmanager
def _dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(OVERWRITE_MODE)
    spark.conf.set(OVERWRITE_MODE, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(OVERWRITE_MODE, before)


class CardBuckets:
    """Transactions by card with one row per card and time, last write wins, kept up by `merge`.

    A serving copy: the loads that it is merged from stay the source of truth. A merge that failed is repeated with the
    same load and ends the same way. Spark puts the buckets of a merge in place one after another at its very end; if
    the driver dies at that moment, merge all loads again. One merge runs at a time. Rows without card or time have no
    place here and stay in the loads.
    """

    def __init__(self, spark: SparkSession, name: str, path: str, schema: T.StructType, newest_first: list[str],
                 buckets: int = BUCKETS, hot_rows: int = HOT_ROWS):
        self.spark, self.newest_first, self.hot_rows = spark, newest_first, hot_rows
        self.columns = schema.names
        day = T.StructType([*schema.fields, T.StructField("_day", T.DateType())])
        self.ordinary = _Layout(spark, f"{name}_by_card", f"{path}/by_card", schema, [CARD], buckets)
        self.hot = _Layout(spark, f"{name}_by_day", f"{path}/by_day", day, [CARD, "_day"], buckets)

    def _hot_cards(self) -> DataFrame:
        """The cards kept by card and day: fewer than one for `hot_rows` rows."""
        return self.hot.rows().select(CARD).distinct()

    def merge(self, load: DataFrame) -> None:
        """Put a load over the stored rows: of each card and time its newest row, if it has one, replaces the stored.

        Reads and rewrites the buckets of the load's cards only. Cards that grow beyond `hot_rows` move over.
        """
        rows = load.select(*self.columns).filter(F.col(CARD).isNotNull() & F.col(TIME).isNotNull())
        rows = written_once(latest_complete(rows, TRANSACTION_KEY, self.newest_first), "bucket-load")
        hot = written_once(self._hot_cards(), "hot-cards").withColumn("_hot", F.lit(True))
        marked = lookup_join(rows, hot, CARD, "left")
        ordinary = marked.filter(F.col("_hot").isNull()).drop("_hot")
        touched = self._touched(ordinary, self.ordinary)
        stored = self.ordinary.in_buckets(touched)
        # without stored rows the load is what it would be merged to
        merged = ordinary if stored.isEmpty() else written_once(self._over(stored, ordinary), "merged-buckets")
        grown = written_once(merged.groupBy(CARD).agg(F.count(F.lit(1)).alias("_rows")).filter(
            F.col("_rows") > self.hot_rows).select(CARD, F.lit(True).alias("_hot")), "grown-cards")
        if not grown.isEmpty():
            # moved cards are written to their new place before they leave the old one
            moving = lookup_join(merged, grown, CARD).drop("_hot")
            self._merge_hot(moving)
            merged = written_once(lookup_join(merged, grown, CARD, "left").filter(F.col("_hot").isNull()).drop("_hot"),
                                  "staying-rows")
        self.ordinary.overwrite(merged)
        left = {r[0] for r in merged.select(self.ordinary.bucket()).distinct().collect()} if touched else set()
        self.ordinary.remove([n for n in touched if n not in left])
        self._merge_hot(marked.filter("_hot").drop("_hot"))

    def _merge_hot(self, rows: DataFrame) -> None:
        rows = rows.withColumn("_day", F.to_date(TIME))
        touched = self._touched(rows, self.hot)
        if touched:
            merged = self._over(self.hot.in_buckets(touched), rows, "_day")
            self.hot.overwrite(written_once(merged, "merged-hot-buckets"))

    def _touched(self, rows: DataFrame, layout: _Layout) -> list[int]:
        """The buckets of some rows: at most as many numbers as there are buckets."""
        return [r[0] for r in rows.select(layout.bucket()).distinct().collect()]

    def _over(self, stored: DataFrame, rows: DataFrame, *extra: str) -> DataFrame:
        order = [F.desc("_new"), *[F.desc(c) for c in self.newest_first]]
        both = stored.withColumn("_new", F.lit(False)).unionByName(rows.withColumn("_new", F.lit(True)))
        return latest_complete(both, TRANSACTION_KEY, order).select(*self.columns, *extra)

    def _has_hot(self) -> bool:
        return not self.hot.rows().isEmpty()

    def transactions(self) -> DataFrame:
        """One row per card and time."""
        rows = self.ordinary.rows()
        return rows.unionByName(self.hot.rows().select(*self.columns)) if self._has_hot() else rows

    def history(self) -> DataFrame:
        """The rows of each card numbered from the newest as `position`, without an exchange for ordinary cards.

        A hot card is ranked day by day and moved on by the rows of later days, which unique seconds bound.
        """
        newest = [F.desc(TIME), *[F.desc(c) for c in self.newest_first]]
        position = F.row_number().over(Window.partitionBy(CARD).orderBy(*newest)).cast("long")
        ordinary = self.ordinary.rows().withColumn("position", position)
        if not self._has_hot():
            return ordinary
        in_day = F.row_number().over(Window.partitionBy(CARD, "_day").orderBy(*newest))
        later = Window.partitionBy(CARD).orderBy(F.desc("_day")).rowsBetween(Window.unboundedPreceding, -1)
        days = self.hot.rows().groupBy(CARD, "_day").agg(F.count(F.lit(1)).alias("_rows")).select(
            CARD, "_day", F.coalesce(F.sum("_rows").over(later), F.lit(0)).alias("_later"))
        placed = lookup_join(self.hot.rows().withColumn("_in_day", in_day), written_once(days, "hot-days"), [CARD, "_day"])
        return ordinary.unionByName(placed.select(*self.columns, (F.col("_in_day") + F.col("_later")).alias("position")))

    def join_cards(self, cards: "CardTable") -> DataFrame:
        """Inner join with a `CardTable` of as many buckets, without an exchange for ordinary cards.

        The few cards that are hot are looked up by a measured broadcast.
        """
        joined = self.ordinary.rows().join(cards.rows().hint("merge"), CARD)
        if not self._has_hot():
            return joined
        few = cards.rows().join(written_once(self._hot_cards(), "hot-cards"), CARD, "left_semi")
        hot = lookup_join(self.hot.rows().select(*self.columns), written_once(few, "hot-card-rows"), CARD)
        return joined.unionByName(hot)


class CardTable:
    """A table with one row per card in the same buckets, such as the customers that transactions are joined to."""

    def __init__(self, spark: SparkSession, name: str, path: str, buckets: int = BUCKETS):
        self.spark, self.name, self.path, self.buckets = spark, name, path, buckets

    def write(self, rows: DataFrame) -> None:
        """Replace the table. Rows without a card are left out."""
        (rows.filter(F.col(CARD).isNotNull()).repartition(self.buckets, CARD).write.mode("overwrite").format("parquet")
         .option("path", self.path).bucketBy(self.buckets, CARD).sortBy(CARD).saveAsTable(self.name))

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)
