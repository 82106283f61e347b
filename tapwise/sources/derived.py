"""Customer, transaction and message tables derived from TPC-H-like tables.

Integer arithmetic and plain casts only, so any engine gets the same rows. The joins are left to
Catalyst and AQE, which broadcast by table statistics and split skewed join partitions.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from tapwise.operators.transactions import encode_messages, normalize_transactions
from tapwise.sources.folders import run_folder, shuffles_dropped


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def customers(spark: SparkSession, folder: str) -> DataFrame:
    """Customers in the input schema, with `dob` as a timestamp at midnight."""
    key = F.col("c_custkey")
    born = F.date_add(F.lit("1930-01-01").cast("date"), ((key * 7919) % 25000).cast("int"))
    return (
        _table(spark, folder, "customer")
        .join(_table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(_table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            key.cast("string").alias("cc_num"),
            F.col("c_name").alias("first"),
            F.col("c_mktsegment").alias("last"),
            F.when(key % 2 == 0, "F").otherwise("M").alias("gender"),
            F.concat(key.cast("string"), F.lit(" Main Street, Flat "), F.col("c_nationkey").cast("string")).alias("street"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("state"),
            F.lpad((key % 100000).cast("string"), 5, "0").alias("zip"),
            (25 + ((key * 37) % 2400) / F.lit(100.0)).alias("lat"),
            (-124 + ((key * 53) % 5600) / F.lit(100.0)).alias("long"),
            F.col("c_mktsegment").alias("job"),
            born.cast("timestamp").alias("dob"),
        )
    )


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "lineitem")


def _narrow(lines: DataFrame) -> DataFrame:
    """The few columns of a line that its transaction is made of, the label and the day worked out.

    The join to the orders moves every line, so it carries one flag and a date instead of four columns.
    """
    flagged = (F.col("l_returnflag") == "R") & (F.col("l_quantity") >= 49) & (F.col("l_discount") >= 0.09)
    return lines.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        F.to_date("l_shipdate").alias("_day"), F.coalesce(flagged, F.lit(False)).alias("_flagged"))


def _transactions(lines: DataFrame, spark: SparkSession, folder: str, *extra) -> DataFrame:
    order, line, part, supplier = map(F.col, ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))
    second = (order * 31 + line * 977) % 86400
    return (
        _narrow(lines)
        .join(_table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderpriority"),
              order == F.col("o_orderkey"))
        .join(_table(spark, folder, "part").select("p_partkey", "p_type"), part == F.col("p_partkey"))
        .join(_table(spark, folder, "supplier").select("s_suppkey", "s_name"), supplier == F.col("s_suppkey"))
        .select(
            F.col("o_custkey").cast("string").alias("cc_num"),
            F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0")).alias("first"),
            F.col("o_orderpriority").alias("last"),
            F.concat_ws("-", *[c.cast("string") for c in (order, line, part, supplier)]).alias("trans_num"),
            F.concat(F.col("_day").cast("string"), F.lit("T00:00:00.000")).alias("trans_date"),
            F.concat_ws(":", *[F.lpad(F.floor(unit).cast("string"), 2, "0") for unit in (
                second / 3600, second % 3600 / 60, second % 60)]).alias("trans_time"),
            (F.unix_date("_day").cast("bigint") * 86400 + second).alias("unix_time"),
            F.col("p_type").alias("category"),
            F.col("s_name").alias("merchant"),
            F.col("l_extendedprice").alias("amt"),
            (25 + ((supplier * 41 + part * 7) % 2400) / F.lit(100.0)).alias("merch_lat"),
            (-124 + ((supplier * 59 + part * 11) % 5600) / F.lit(100.0)).alias("merch_long"),
            F.when(F.col("_flagged"), 1.0).otherwise(0.0).alias("is_fraud"),
            *extra,
        )
    )


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    """Raw labelled transactions in the input schema, date and time still apart as text."""
    return _transactions(_lines(spark, folder), spark, folder)


def _envelopes(lines, spark, folder):
    # topic positions with gaps, as in a compacted topic; numbering rows by partition would gather
    # all rows into four groups
    position = [(F.col("l_orderkey") % 4).cast("int").alias("partition"),
                (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("offset")]
    clean = normalize_transactions(_transactions(lines, spark, folder, *position))
    money = {c: F.format_string("%.2f", c) for c in ("amt", "merch_lat", "merch_long")}
    when = {"trans_time": F.date_format("trans_time", "yyyy-MM-dd HH:mm:ss")}
    return encode_messages(clean.withColumns(money | when))


def _on_the_wire(messages: DataFrame) -> DataFrame:
    return messages.select(F.col("value").cast("binary").alias("value"), "partition", "offset")


def envelopes(spark: SparkSession, folder: str) -> DataFrame:
    """Every transaction as a topic message, with the columns it was made from."""
    return _envelopes(_lines(spark, folder), spark, folder)


def envelope_topic(spark: SparkSession, folder: str) -> str:
    """The same messages as a folder of files in the shared folder, made once for all streams and batches of a job.

    They are packed tightly, as the text of messages repeats its field names; shuffles go when they are written.
    """
    path = run_folder(spark, "topic")
    with shuffles_dropped(spark):
        _on_the_wire(envelopes(spark, folder)).write.parquet(path, compression="zstd")
    return path
