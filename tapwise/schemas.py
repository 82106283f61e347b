"""Schemas and fixed column lists of the customer and transaction tables."""

from pyspark.sql import types as T

# --- fixed values: column names, order and types of the input files -------------
CUSTOMER_SCHEMA = T.StructType([
    T.StructField("cc_num", T.StringType()),
    T.StructField("first", T.StringType()),
    T.StructField("last", T.StringType()),
    T.StructField("gender", T.StringType()),
    T.StructField("street", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("zip", T.StringType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("long", T.DoubleType()),
    T.StructField("job", T.StringType()),
    T.StructField("dob", T.TimestampType()),
])

TRANSACTION_SCHEMA = T.StructType([
    T.StructField("cc_num", T.StringType()),
    T.StructField("first", T.StringType()),
    T.StructField("last", T.StringType()),
    T.StructField("trans_num", T.StringType()),
    T.StructField("trans_date", T.StringType()),
    T.StructField("trans_time", T.StringType()),
    T.StructField("unix_time", T.LongType()),
    T.StructField("category", T.StringType()),
    T.StructField("merchant", T.StringType()),
    T.StructField("amt", T.DoubleType()),
    T.StructField("merch_lat", T.DoubleType()),
    T.StructField("merch_long", T.DoubleType()),
])

# Columns of the stored transaction tables, in order.
ENRICHED_COLUMNS = [
    "cc_num", "trans_num", "trans_time", "category", "merchant", "amt",
    "merch_lat", "merch_long", "distance", "age", "is_fraud",
]

# The scored stream carries the topic position instead of a label.
STREAM_COLUMNS = [c for c in ENRICHED_COLUMNS if c != "is_fraud"] + ["partition", "offset"]

# Columns the model is trained from.
TRAINING_COLUMNS = ["cc_num", "category", "merchant", "distance", "amt", "age", "is_fraud"]
MODEL_COLUMNS = ["category", "merchant", "distance", "amt", "age"]

# Fields of one message on the transaction topic, in order.
MESSAGE_FIELDS = [
    "cc_num", "first", "last", "trans_num", "trans_time",
    "category", "merchant", "amt", "merch_lat", "merch_long",
]

# Key of a stored transaction.
TRANSACTION_KEY = ["cc_num", "trans_time"]
# --- end of fixed values --------------------------------------------------------

LABELLED_SCHEMA = T.StructType(TRANSACTION_SCHEMA.fields + [T.StructField("is_fraud", T.DoubleType())])

# Numbers travel as JSON strings, so the wire schema reads them as text.
WIRE_NUMBERS = ["amt", "merch_lat", "merch_long"]
WIRE_SCHEMA = T.StructType([
    T.StructField(f.name, T.StringType() if f.name in WIRE_NUMBERS else f.dataType)
    for f in TRANSACTION_SCHEMA.fields
])

ENVELOPE_SCHEMA = T.StructType([
    T.StructField("value", T.BinaryType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
])

# Stored tables. `loaded_at` orders writes of one key, `load_id` names the load a row came with.
STORED_CUSTOMER_SCHEMA = T.StructType(CUSTOMER_SCHEMA.fields + [
    T.StructField("age", T.IntegerType()),
    T.StructField("loaded_at", T.TimestampType()),
    T.StructField("load_id", T.StringType()),
])

_ENRICHED_TYPES = {f.name: f.dataType for f in TRANSACTION_SCHEMA.fields} | {
    "trans_time": T.TimestampType(), "distance": T.DoubleType(), "age": T.IntegerType(), "is_fraud": T.DoubleType()}
STORED_TRANSACTION_SCHEMA = T.StructType(
    [T.StructField(c, _ENRICHED_TYPES[c]) for c in ENRICHED_COLUMNS if c != "is_fraud"]
    + [T.StructField("loaded_at", T.TimestampType()), T.StructField("load_id", T.StringType()),
       T.StructField("is_fraud", T.DoubleType())])

STORED_OFFSET_SCHEMA = T.StructType([
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("load_id", T.StringType()),
])
