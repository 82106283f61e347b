"""The bulk-load job: CSV files to stored tables."""

from pyspark.sql import SparkSession

from tapwise.operators.lookup import joins_by_key, measured
from tapwise.operators.transactions import customer_places, enrich_transactions, normalize_transactions, with_age
from tapwise.sources.files import read_customers, read_labelled_transactions
from tapwise.sources.tables import CardTables


def bulk_load(spark: SparkSession, customers_csv: str, transactions_csv: str, tables: CardTables, load_id: str,
              mode: str = "append", as_of=None, zone: str | None = None) -> None:
    """Load customers and labelled transactions; each table is filled in one write pass."""
    customers = read_customers(spark, customers_csv)
    raw = read_labelled_transactions(spark, transactions_csv)
    places = measured(customer_places(customers))
    enriched = enrich_transactions(normalize_transactions(raw), places, as_of, zone)
    tables.create()
    tables.write_customers(with_age(customers, as_of, zone), load_id, mode)
    tables.write_transactions(enriched, load_id, mode, by_card=joins_by_key(places))
