"""Clean-up, enrichment and labelling of transactions."""

from pyspark.sql import DataFrame, functions as F

from tapwise.functions.geo import haversine_km
from tapwise.functions.messages import message_json, parse_message
from tapwise.functions.times import age_years, event_time, parse_time, wall_clock
from tapwise.operators.lookup import BROADCAST_LIMIT_BYTES, MeasuredLookup, lookup_join
from tapwise.schemas import ENRICHED_COLUMNS, STREAM_COLUMNS, TRAINING_COLUMNS, WIRE_NUMBERS


def normalize_transactions(raw: DataFrame) -> DataFrame:
    """Merge the text date and time of each row into one timestamp, null where they do not parse."""
    return raw.withColumns({
        "trans_date": F.split("trans_date", "T")[0],
        "trans_time": event_time("trans_date", "trans_time"),
    })


def with_age(customers: DataFrame, as_of=None, zone: str | None = None) -> DataFrame:
    return customers.withColumn("age", age_years("dob", as_of, zone))


def with_distance_and_age(joined: DataFrame, as_of=None, zone: str | None = None) -> DataFrame:
    """Distance and age for rows joined to their customers, from `lat`, `long` and `dob`."""
    return joined.withColumns({
        "distance": F.round(haversine_km("lat", "long", "merch_lat", "merch_long"), 2),
        "age": age_years("dob", as_of, zone),
    })


def customer_places(customers: DataFrame) -> DataFrame:
    """What the card join needs of the customers."""
    return customers.select("cc_num", "lat", "long", "dob")


def _join_customers(transactions, customers, as_of, zone, broadcast_limit):
    """Inner join on the card, with distance and age. Unknown and null cards drop out.

    Age is worked out after the join, so a long-running stream never keeps a stale one.
    """
    places = customers if isinstance(customers, MeasuredLookup) else customer_places(customers)
    joined = lookup_join(transactions, places, "cc_num", broadcast_limit=broadcast_limit)
    return with_distance_and_age(joined, as_of, zone)


def enrich_transactions(transactions: DataFrame, customers: DataFrame | MeasuredLookup, as_of=None, zone: str | None = None,
                        broadcast_limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Labelled transactions with distance and customer age, in stored column order."""
    joined = _join_customers(transactions.drop("first", "last"), customers, as_of, zone, broadcast_limit)
    return joined.select(*ENRICHED_COLUMNS)


def enrich_stream(decoded: DataFrame, customers: DataFrame | MeasuredLookup, as_of=None, zone: str | None = None,
                  message_zone: str | None = None,
                  broadcast_limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Decoded messages, streaming or not, with distance, customer age and topic position.

    `customers` may be `customer_places` that were measured before.
    """
    joined = _join_customers(decoded, customers, as_of, zone, broadcast_limit)
    return joined.select(*[
        parse_time(c, message_zone).alias(c) if c == "trans_time" else c for c in STREAM_COLUMNS
    ])


def fraud_only(df: DataFrame, label: str = "is_fraud") -> DataFrame:
    return df.filter(F.col(label) == 1)


def non_fraud_only(df: DataFrame, label: str = "is_fraud") -> DataFrame:
    return df.filter(F.col(label) == 0)


def split_predictions(scored: DataFrame, label: str = "is_fraud") -> tuple[DataFrame, DataFrame]:
    """Rows predicted fraud, and all other rows with a prediction."""
    return scored.filter(F.col(label) == 1.0), scored.filter(F.col(label) != 1.0)


def labelled_union(non_fraud: DataFrame, fraud: DataFrame, *extra: str) -> DataFrame:
    """Both labelled tables as one training table; `extra` columns ride along."""
    columns = TRAINING_COLUMNS + [c for c in extra if c not in TRAINING_COLUMNS]
    return non_fraud.select(*columns).unionByName(fraud.select(*columns))


def encode_messages(transactions: DataFrame, sent_at=None, zone: str | None = None) -> DataFrame:
    """Add the topic message of each row as `value`.

    With `sent_at` (a timestamp column, such as `current_timestamp()`) the message carries that
    instant as wall-clock time of `zone`; without it, the row's own `trans_time`.
    """
    if sent_at is not None:
        transactions = transactions.withColumn(
            "trans_time", wall_clock(sent_at, zone) if zone else wall_clock(sent_at))
    return transactions.withColumn("value", message_json())


def decode_messages(envelopes: DataFrame) -> DataFrame:
    """Message fields and topic position; bad numbers become null, garbage an all-null row.

    The parsed struct is expanded by a generator, which filters on its fields are not pushed through:
    as a plain column it would be parsed once more for the card filter of a later join.
    """
    fields = envelopes.select(F.inline_outer(F.array(parse_message("value"))), "partition", "offset")
    return fields.withColumns({c: F.col(c).try_cast("double") for c in WIRE_NUMBERS}).drop("first", "last")
