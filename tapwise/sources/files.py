"""CSV inputs with a header line and a fixed schema."""

from pyspark.sql import DataFrame, SparkSession

from tapwise.schemas import CUSTOMER_SCHEMA, LABELLED_SCHEMA


def read_customers(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, schema=CUSTOMER_SCHEMA, header=True)


def read_labelled_transactions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, schema=LABELLED_SCHEMA, header=True)
