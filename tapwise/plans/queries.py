"""The registered queries: each operator over tables derived from a folder of Parquet files."""

import uuid

import numpy as np
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tapwise.functions import epoch_millis, haversine_km, wall_clock
from tapwise.operators import features, keyed, kmeans, metrics, model
from tapwise.operators.forest import score_columns
from tapwise.operators.lookup import joins_by_key, lookup_join, measured
from tapwise.operators.transactions import (
    customer_places, decode_messages, enrich_stream, enrich_transactions, fraud_only, labelled_union, non_fraud_only,
    normalize_transactions, split_predictions, with_age, with_distance_and_age,
)
from tapwise.plans.bulk_load import bulk_load
from tapwise.plans.training import train
from tapwise.schemas import CUSTOMER_SCHEMA, ENRICHED_COLUMNS, LABELLED_SCHEMA, MODEL_COLUMNS
from tapwise.sources import derived
from tapwise.sources.bucketed import CardBuckets, CardTable
from tapwise.sources.files import read_customers, read_labelled_transactions
from tapwise.sources.folders import run_folder, shuffles_dropped, written_once
from tapwise.sources.tables import CardTables
from tapwise.sources.topics import behind_offsets, read_envelope_files
from tapwise.streaming.scoring import score_messages, start_live_scoring
from tapwise.streaming.sinks import write_to_files, write_to_tables

AS_OF = "2020-04-16"
ROW_ID = ["trans_num"]
NUMBERS = ["distance", "amt", "age"]
BATCH_BYTES = 1 << 30  # of message files in a micro-batch: bounds what its joins shuffle and keep on disk


def _clean(spark, folder):
    return normalize_transactions(derived.transactions(spark, folder))


def _enriched(spark, folder):
    return enrich_transactions(_clean(spark, folder), derived.customers(spark, folder), AS_OF)


# --- clean-up and enrichment ---

def enrich_transactions_query(spark, folder):
    return _enriched(spark, folder)


def normalize_transactions_query(spark, folder):
    return _clean(spark, folder)


def customer_age(spark, folder):
    return with_age(derived.customers(spark, folder), AS_OF).select("cc_num", "dob", "age")


def haversine_distance(spark, folder):
    """Customer to merchant distance, in metres' precision."""
    places = derived.customers(spark, folder).select("cc_num", "lat", "long")
    joined = derived.transactions(spark, folder).join(places, "cc_num")
    return joined.select("trans_num", F.round(haversine_km("lat", "long", "merch_lat", "merch_long"), 3).alias("km"))


def fraud_transactions(spark, folder):
    return fraud_only(_enriched(spark, folder))


def non_fraud_transactions(spark, folder):
    return non_fraud_only(_enriched(spark, folder))


def labelled_union_query(spark, folder):
    enriched = _enriched(spark, folder)
    return labelled_union(non_fraud_only(enriched), fraud_only(enriched), "trans_num")


def format_in_zone(spark, folder):
    events = spark.read.parquet(f"{folder}/events.parquet").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    return events.select("event_id", wall_clock("ts").alias("sent_at"), epoch_millis("ts").alias("sent_millis"))


# --- keyed tables ---

def _newest(spark, folder):
    """One row per card and time. Cleaned before any join on the card, so copies shrink in the map tasks."""
    return keyed.latest_per_key(_clean(spark, folder), ["cc_num", "trans_time"], ["trans_num", "amt"])


def latest_per_key(spark, folder):
    return _newest(spark, folder).select("cc_num", "trans_time", "trans_num", "amt", "is_fraud")


def card_history(spark, folder):
    rows = _clean(spark, folder).select("cc_num", "trans_time", "trans_num", "amt")
    return keyed.card_history(rows, newest_first=["trans_num", "amt"])


def offset_progress(spark, folder):
    return keyed.offset_progress(derived.envelopes(spark, folder))


def _card_buckets(spark, folder, rows):
    """The rows in buckets of cards, merged in two loads; the second holds the larger amounts and wins."""
    name, path = f"cards_{uuid.uuid4().hex}", run_folder(spark, "card-buckets")
    buckets = CardBuckets(spark, name, path, rows.schema, ["trans_num", "amt"], buckets=16)
    rows = written_once(rows, "card-rows")
    buckets.merge(rows.filter("amt <= 30000"))
    buckets.merge(rows.filter("amt > 30000"))
    return buckets, f"{name}_customers", f"{path}/customers"


def bucketed_history(spark, folder):
    """Card history out of bucketed storage, last write wins across two loads."""
    rows = _clean(spark, folder).select("cc_num", "trans_time", "trans_num", "amt")
    return _card_buckets(spark, folder, rows)[0].history()


def bucketed_enrich(spark, folder):
    """The card join out of bucketed storage: enriched rows, last write wins across two loads."""
    wanted = [c for c in ENRICHED_COLUMNS if c not in ("distance", "age")]
    buckets, name, path = _card_buckets(spark, folder, _clean(spark, folder).select(*wanted))
    cards = CardTable(spark, name, path, buckets=16)
    cards.write(derived.customers(spark, folder).select("cc_num", "lat", "long", "dob"))
    return with_distance_and_age(buckets.join_cards(cards), AS_OF).select(*ENRICHED_COLUMNS)


def resumed_offsets(spark, folder):
    """Messages that a new reader gets behind the offsets of a first load; partition 3 was not loaded yet."""
    tables = CardTables(spark, run_folder(spark, "offset-table"))
    tables.create()
    messages = derived.envelopes(spark, folder).select("trans_num", "amt", "partition", "offset")
    loaded = messages.filter("offset <= 20000 and partition < 3")
    tables.write_offsets(keyed.offset_progress(loaded), "first")
    return behind_offsets(messages, tables.offsets())


# --- messages ---

def json_encode(spark, folder):
    return derived.envelopes(spark, folder).select("trans_num", "value")


def json_decode(spark, folder):
    return decode_messages(derived.envelopes(spark, folder).select("value", "partition", "offset")).select(
        "cc_num", "trans_num", "trans_time", "category", "merchant",
        "amt", "merch_lat", "merch_long", "partition", "offset")


# --- counts and metrics ---

def label_counts(spark, folder):
    return metrics.label_counts(derived.transactions(spark, folder))


def _ruled_pairs(spark, folder):
    ruled = derived.transactions(spark, folder).withColumn(
        "prediction", F.when(F.col("amt") > 60000, 1.0).otherwise(0.0))
    return metrics.prediction_pairs(ruled)


def confusion_matrix(spark, folder):
    return metrics.confusion_matrix(_ruled_pairs(spark, folder))


def classification_rates(spark, folder):
    return metrics.classification_rates(metrics.confusion_matrix(_ruled_pairs(spark, folder)))


# --- features ---

def category_index(spark, folder):
    return features.category_index(derived.transactions(spark, folder), "merchant")


def category_lookup(spark, folder):
    rows = written_once(derived.transactions(spark, folder).select("trans_num", "merchant"), "merchant-rows")
    return features.apply_category_index(rows, features.category_index(rows, "merchant"), "merchant")


def onehot_category(spark, folder):
    """Size of the one-hot vector of each row and the position set in it."""
    rows = derived.transactions(spark, folder).select("trans_num", "category")
    places = features.one_hot_position(written_once(features.category_index(rows, "category"), "category-index"))
    places = places.select(F.col("value").alias("category"), "size", "position")
    return lookup_join(rows, places, "category").select("trans_num", "size", "position")


def feature_slice(spark, folder):
    names = ["amt", "merch_lat", "merch_long"]
    vectors = features.vector_assembler(names, "raw").transform(derived.transactions(spark, folder))
    sliced = features.vector_slicer(["merch_long", "amt"], "raw", "slice").transform(vectors)
    return features.vector_slots(sliced.select("trans_num", "slice"), "slice", ["slot_0", "slot_1"]).drop("slice")


def standard_scale(spark, folder):
    rows = derived.transactions(spark, folder).select("trans_num", "amt")
    vectors = features.vector_assembler(["amt"], "raw").transform(rows)
    scaled = features.standard_scaler("raw", "scaled").fit(vectors).transform(vectors)
    return features.vector_slots(scaled.select("trans_num", "scaled"), "scaled", ["amt_scaled"]).drop("scaled")


def _model_rows(spark, folder):
    return _enriched(spark, folder).select("trans_num", *MODEL_COLUMNS, "is_fraud")


def _written_model_rows(spark, folder):
    return written_once(_model_rows(spark, folder), "model-rows", "is_fraud")


def _scaled_slots(transformed):
    names = [f"{n}_scaled" for n in NUMBERS]
    return features.vector_slots(transformed.select("trans_num", "features"), "features", names).drop("features")


def feature_pipeline(spark, folder):
    rows = _written_model_rows(spark, folder)
    return _scaled_slots(features.feature_pipeline(rows.schema, MODEL_COLUMNS).fit(rows).transform(rows))


def saved_pipeline(spark, folder):
    """Features led by the indexed text columns, through save and load."""
    rows = _written_model_rows(spark, folder)
    path = run_folder(spark, "pipeline")
    features.feature_pipeline(rows.schema, MODEL_COLUMNS, include_indexed=True).fit(rows).save(path)
    transformed = features.FeatureModel.load(path).transform(rows).select("trans_num", "features")
    names = ["category_slot", "merchant_slot", *[f"{n}_scaled" for n in NUMBERS]]
    return features.vector_slots(transformed, "features", names).drop("features")


def indexer_pipeline(spark, folder):
    rows = _written_model_rows(spark, folder)
    fitted = features.indexer_pipeline(rows.schema, MODEL_COLUMNS).fit(rows)
    names = ["category_slot", "merchant_slot", "distance_slot", "amt_slot", "age_slot"]
    transformed = fitted.transform(rows).select("trans_num", "features")
    return features.vector_slots(transformed, "features", names).drop("features")


# --- model ---

def holdout_split(spark, folder):
    """Every row with its side of the split."""
    side = F.when(model.on_train_side(ROW_ID), "train").otherwise("test")
    return derived.transactions(spark, folder).select("trans_num", side.alias("side"))


def kmeans_balance(spark, folder):
    """The balanced training set in figures: its fraud rows, and whether its centres are within their bounds."""
    rows = _written_model_rows(spark, folder)
    train_rows, _ = model.holdout_split(rows, ROW_ID)
    fitted = features.feature_pipeline(rows.schema, NUMBERS).fit(rows)
    other = fitted.transform(non_fraud_only(train_rows))
    balanced = written_once(
        model.balanced_training_set(fitted.transform(fraud_only(train_rows)), other)
        .select("is_fraud", vector_to_array("features").alias("v")), "balanced")
    slots = range(len(NUMBERS))
    ranges = other.select(vector_to_array("features").alias("v")).agg(*[
        f(F.col("v")[i]).alias(f"{name}_{i}") for i in slots for name, f in (("low", F.min), ("high", F.max))])
    centre = F.col("is_fraud") == 0
    inside = F.lit(True)
    for i in slots:
        inside = inside & F.col("v")[i].between(F.col(f"low_{i}") - 1e-9, F.col(f"high_{i}") + 1e-9)
    centres = F.count_if(centre)
    return balanced.join(F.broadcast(ranges)).agg(
        F.count_if(~centre).alias("fraud_rows"),
        ((centres > 0) & (centres <= F.count_if(~centre))).alias("centres_bounded"),
        F.bool_and(~centre | inside).alias("centres_inside"))


def kmeans_lloyd(spark, folder):
    """Four Lloyd rounds over all rows from twelve rows that a hash picks: centres and the rows nearest to them."""
    rows = _enriched(spark, folder).select(
        "trans_num", "amt", F.array(F.col("distance") / 100, F.col("amt") / 10000, F.col("age") / 10).alias("point"))
    picked = rows.orderBy(F.md5("trans_num"), "trans_num", "amt").limit(12).collect()
    points = kmeans.weighted_points(rows, "point")
    centres = kmeans.lloyd(points, np.array([r["point"] for r in picked]), rounds=4, tolerance=0.0)
    weights = kmeans.lloyd_round(points, centres)[1]
    found = [(k, int(w), *map(float, c)) for k, (w, c) in enumerate(zip(weights, centres))]
    places = [F.round(c, 6).alias(c) for c in NUMBERS]
    return spark.createDataFrame(found, "centre long, rows long, distance double, amt double, age double").select(
        "centre", "rows", *places)


def rf_score(spark, folder):
    """Hold-out rows and whether the forest's prediction and fraud probability are sound and agree."""
    trained = train(_model_rows(spark, folder), ROW_ID)
    chance = vector_to_array("probability")[1]
    return trained.test_predictions.select(
        "trans_num", "is_fraud", F.col("prediction").isin(0.0, 1.0).alias("predicted"),
        chance.between(0, 1).alias("probable"),
        ((F.col("prediction") == 1) == (chance > 0.5)).alias("agrees"))


def forest_expression(spark, folder):
    """Hold-out rows scored by the forest as column expressions, held against the library's own scoring."""
    trained = train(_model_rows(spark, folder), ROW_ID)
    scored = score_columns(trained.test_predictions.withColumnsRenamed(
        {"prediction": "_prediction", "probability": "_probability"}), trained.features, trained.forest)
    chance = vector_to_array("_probability")
    return scored.select(
        "trans_num", "amt", (F.col("is_fraud") == F.col("_prediction")).alias("same_prediction"),
        (F.abs(F.col("probability")[1] - chance[1]) < 1e-12).alias("same_chance"))


# --- files, stored tables and streams ---

def csv_customers(spark, folder):
    """Customers through a CSV file with header and zone offsets."""
    path = run_folder(spark, "customers-csv")
    derived.customers(spark, folder).select(*CUSTOMER_SCHEMA.names).write.csv(path, header=True)
    return with_age(read_customers(spark, path), AS_OF)


def csv_transactions(spark, folder):
    """Labelled transactions through a CSV file with header."""
    path = run_folder(spark, "transactions-csv")
    derived.transactions(spark, folder).select(*LABELLED_SCHEMA.names).write.csv(path, header=True)
    return normalize_transactions(read_labelled_transactions(spark, path))


def stored_transactions(spark, folder):
    """The whole bulk load, CSV to stored tables, read back with last write wins."""
    root = run_folder(spark, "bulk-load")
    # packed, as large files come
    derived.customers(spark, folder).select(*CUSTOMER_SCHEMA.names).write.csv(f"{root}/customers", header=True, compression="gzip")
    derived.transactions(spark, folder).select(*LABELLED_SCHEMA.names).write.csv(f"{root}/transactions", header=True, compression="gzip")
    tables = CardTables(spark, f"{root}/tables")
    bulk_load(spark, f"{root}/customers", f"{root}/transactions", tables, "bulk", as_of=AS_OF)
    return tables.non_fraud_transactions().unionByName(tables.fraud_transactions())


def stored_customers(spark, folder):
    """Customers stored twice, the second load with another age, read back with last write wins."""
    tables = CardTables(spark, run_folder(spark, "customer-table"))
    tables.create()
    people = derived.customers(spark, folder)
    tables.write_customers(with_age(people, "2000-01-01"), "first")
    tables.write_customers(with_age(people, AS_OF), "second")
    return tables.customers()


def stream_enrich(spark, folder):
    """The live enrichment as a stream run to the end of its input."""
    path = run_folder(spark, "stream-enrich")
    messages = read_envelope_files(spark, derived.envelope_topic(spark, folder), maxBytesPerTrigger=str(BATCH_BYTES))
    enriched = enrich_stream(decode_messages(messages), derived.customers(spark, folder), AS_OF)
    with shuffles_dropped(spark):
        started = write_to_files(enriched, f"{path}/out", "stream_enrich", f"{path}/checkpoint", availableNow=True)
    started.awaitTermination()
    return spark.read.schema(enriched.schema).parquet(f"{path}/out")


def _live_tables(spark, folder, path):
    tables = CardTables(spark, f"{path}/tables")
    tables.create()
    tables.write_customers(with_age(derived.customers(spark, folder), AS_OF), "bulk")
    return tables


def stream_split_sinks(spark, folder):
    """The live job with models trained, saved and loaded: what it stored, compared with a batch prediction."""
    path = run_folder(spark, "stream-score")
    train(_model_rows(spark, folder), ROW_ID).save(f"{path}/features", f"{path}/forest")
    tables, topic = _live_tables(spark, folder, path), derived.envelope_topic(spark, folder)
    start_live_scoring(
        read_envelope_files(spark, topic), tables, f"{path}/features", f"{path}/forest", f"{path}/checkpoint",
        "stream_split_sinks", {"availableNow": True}, as_of=AS_OF).awaitTermination()
    scored = score_messages(
        spark.read.parquet(topic), tables.customers(), features.FeatureModel.load(f"{path}/features"),
        RandomForestClassificationModel.load(f"{path}/forest"), as_of=AS_OF)
    # message numbers repeat with other amounts; a row's numbers make its prediction, so copies of a row share it
    row = ["trans_num", "trans_time", "amt", "distance", "age"]
    batch = scored.groupBy(*row).agg(F.max("is_fraud").alias("_batch"))  # dealt out as the join needs it
    stored = tables.fraud_transactions().unionByName(tables.non_fraud_transactions()).join(batch, row)
    # predictions may put copies of a card and time into both halves, each with its newest row; one of the two is the
    # newest of all copies
    newest = F.struct("trans_num", "amt")
    return stored.groupBy("cc_num", "trans_time").agg(
        F.max_by("trans_num", newest).alias("trans_num"), F.max_by("distance", newest).alias("distance"),
        F.max_by("age", newest).alias("age"),
        F.bool_and(F.col("is_fraud") == F.col("_batch")).alias("same_half"))


def stream_split_rule(spark, folder):
    """The live sink and its split, fed by a rule instead of a model."""
    path = run_folder(spark, "stream-rule")
    tables, topic = _live_tables(spark, folder, path), derived.envelope_topic(spark, folder)
    places = measured(customer_places(derived.customers(spark, folder)))
    enriched = enrich_stream(decode_messages(read_envelope_files(spark, topic)), places, AS_OF)
    ruled = enriched.withColumn("is_fraud", F.when(F.col("amt") > 60000, 1.0).otherwise(0.0))
    fraud, rest = split_predictions(ruled)
    started = [write_to_tables(half, tables, name, f"{path}/{name}", by_card=joins_by_key(places), availableNow=True)
               for name, half in (("fraud_rule", fraud), ("rest_rule", rest))]
    for query in started:
        query.awaitTermination()
    return tables.fraud_transactions().unionByName(tables.non_fraud_transactions())


def tables_overwrite(spark, folder):
    """Transactions stored twice, the second load overwriting, then compacted; customers are truncated."""
    places = measured(customer_places(derived.customers(spark, folder)))
    enriched, by_card = enrich_transactions(_clean(spark, folder), places, AS_OF), joins_by_key(places)
    tables = CardTables(spark, run_folder(spark, "overwrite"))
    tables.create()
    tables.write_customers(with_age(derived.customers(spark, folder), AS_OF), "gone")
    tables.truncate("customer")
    tables.write_transactions(fraud_only(enriched), "first", by_card=by_card)
    tables.write_transactions(non_fraud_only(enriched), "second", mode="overwrite", by_card=by_card)
    tables.compact()
    cards = tables.customers().select("cc_num").distinct()
    return tables.transactions().join(cards, "cc_num", "left_anti").select(*ENRICHED_COLUMNS)


QUERIES = {
    "enrich_transactions": enrich_transactions_query,
    "normalize_transactions": normalize_transactions_query,
    "customer_age": customer_age,
    "haversine_distance": haversine_distance,
    "fraud_transactions": fraud_transactions,
    "non_fraud_transactions": non_fraud_transactions,
    "labelled_union": labelled_union_query,
    "format_in_zone": format_in_zone,
    "latest_per_key": latest_per_key,
    "card_history": card_history,
    "bucketed_history": bucketed_history,
    "bucketed_enrich": bucketed_enrich,
    "offset_progress": offset_progress,
    "resumed_offsets": resumed_offsets,
    "json_encode": json_encode,
    "json_decode": json_decode,
    "label_counts": label_counts,
    "confusion_matrix": confusion_matrix,
    "classification_rates": classification_rates,
    "category_index": category_index,
    "category_lookup": category_lookup,
    "onehot_category": onehot_category,
    "feature_slice": feature_slice,
    "standard_scale": standard_scale,
    "feature_pipeline": feature_pipeline,
    "saved_pipeline": saved_pipeline,
    "indexer_pipeline": indexer_pipeline,
    "holdout_split": holdout_split,
    "kmeans_balance": kmeans_balance,
    "kmeans_lloyd": kmeans_lloyd,
    "rf_score": rf_score,
    "forest_expression": forest_expression,
    "csv_customers": csv_customers,
    "csv_transactions": csv_transactions,
    "stored_transactions": stored_transactions,
    "stored_customers": stored_customers,
    "stream_enrich": stream_enrich,
    "stream_split_sinks": stream_split_sinks,
    "stream_split_rule": stream_split_rule,
    "tables_overwrite": tables_overwrite,
}
