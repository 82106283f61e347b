import pytest
from pyspark.sql import functions as F

from tapwise.operators.transactions import decode_messages, enrich_stream, split_predictions, with_age
from tapwise.plans.training import train
from tapwise.plans import queries
from tapwise.sources import derived
from tapwise.sources.tables import CardTables
from tapwise.sources.topics import read_envelope_files
from tapwise.streaming.scoring import CustomerSide, score_messages, start_live_scoring
from tapwise.streaming.sinks import write_to_files, write_to_tables
from conftest import DATA

STORED = ["cc_num", "trans_num", "trans_time", "amt", "distance", "age", "is_fraud"]


@pytest.fixture(scope="module")
def topic(spark, tmp_path_factory):
    """Message files of the topic: two thirds now, the rest for later."""
    folder = tmp_path_factory.mktemp("topic")
    messages = derived.envelopes(spark, DATA).select(F.col("value").cast("binary").alias("value"), "partition", "offset")
    messages = messages.dropDuplicates(["value"])
    now, later = str(folder / "now"), str(folder / "later")
    messages.filter("offset % 3 > 0").write.parquet(now)
    messages.filter("offset % 3 = 0").write.parquet(later)
    return now, later


@pytest.fixture(scope="module")
def models(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("models")
    paths = str(folder / "features"), str(folder / "forest")
    trained = train(queries._model_rows(spark, DATA), ["trans_num"])
    trained.save(*paths)
    return trained, paths


@pytest.fixture
def tables(spark, tmp_path):
    found = CardTables(spark, str(tmp_path / "tables"))
    found.create()
    found.write_customers(with_age(derived.customers(spark, DATA), queries.AS_OF), "bulk")
    return found


def expected_rows(spark, models, *paths):
    customers = derived.customers(spark, DATA)
    trained = models[0]
    scored = score_messages(spark.read.parquet(*paths), customers, trained.features, trained.forest, as_of=queries.AS_OF)
    return rows(scored)


def rows(df):
    return sorted(map(tuple, df.select(*STORED).collect()))


def test_stream_equals_batch(spark, topic, tmp_path):
    customers = derived.customers(spark, DATA)
    stream = enrich_stream(decode_messages(read_envelope_files(spark, topic[0], maxFilesPerTrigger="2")), customers, queries.AS_OF)
    write_to_files(stream, str(tmp_path / "out"), "same", str(tmp_path / "cp"), availableNow=True).awaitTermination()
    batch = enrich_stream(decode_messages(spark.read.parquet(topic[0])), customers, queries.AS_OF)
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).select(*batch.columns).collect())) == sorted(
        map(tuple, batch.collect()))


def test_live_scoring_stores_both_halves_and_resumes(spark, topic, models, tables, tmp_path):
    def run():
        start_live_scoring(
            read_envelope_files(spark, str(tmp_path / "in")), tables, *models[1], str(tmp_path / "cp"),
            trigger={"availableNow": True}, as_of=queries.AS_OF).awaitTermination()

    spark.read.parquet(topic[0]).write.mode("append").parquet(str(tmp_path / "in"))
    run()
    first = expected_rows(spark, models, topic[0])
    assert rows(tables.transactions()) == first
    run()  # nothing new: the checkpoint remembers what was read
    assert tables._read("transaction").count() == len(first)
    spark.read.parquet(topic[1]).write.mode("append").parquet(str(tmp_path / "in"))
    run()
    assert rows(tables.transactions()) == expected_rows(spark, models, *topic)
    assert rows(tables.fraud_transactions()) == [r for r in rows(tables.transactions()) if r[-1] == 1.0]


def test_customers_loaded_while_the_job_runs_are_seen(spark, topic, models, tmp_path):
    people = with_age(derived.customers(spark, DATA), queries.AS_OF)
    tables = CardTables(spark, str(tmp_path / "growing"))
    tables.create()
    even = F.col("cc_num").cast("long") % 2 == 0
    tables.write_customers(people.filter(even), "daily")
    arriving = str(tmp_path / "arriving")
    spark.read.parquet(topic[0]).write.mode("append").parquet(arriving)
    query = start_live_scoring(read_envelope_files(spark, arriving), tables, *models[1], str(tmp_path / "cp"),
                               as_of=queries.AS_OF)
    try:
        query.processAllAvailable()
        assert tables.transactions().filter(~even).count() == 0
        tables.write_customers(people.filter(even), "daily")  # loaded again under the same name
        tables.write_customers(people.filter(~even), "late")
        spark.read.parquet(topic[1]).write.mode("append").parquet(arriving)
        query.processAllAvailable()
        assert query.exception() is None
    finally:
        query.stop()
    assert rows(tables.transactions().filter(~even)) == [
        r for r in expected_rows(spark, models, topic[1]) if int(r[0]) % 2]
    assert {r.partition for r in tables.offsets().collect()} == {
        r.partition for r in spark.read.parquet(*topic).select("partition").distinct().collect()}


def test_the_customer_side_is_read_once_for_each_version(spark, tables, monkeypatch):
    read, plain = [], tables.customers
    monkeypatch.setattr(tables, "customers", lambda: read.append(1) or plain())
    side = CustomerSide(tables)
    first = side.current()
    assert side.current() is first and len(read) == 1
    assert first.rows.storageLevel.useMemory and first.bytes > 0
    before = first.rows.count()
    changed = with_age(derived.customers(spark, DATA), queries.AS_OF).limit(1).withColumn("cc_num", F.lit("new"))
    tables.write_customers(changed, "later")
    assert side.current().rows.count() == before + 1 and len(read) == 2
    assert not first.rows.storageLevel.useMemory  # given back
    side.close()


def test_batches_share_the_customer_side(spark, topic, models, tables, tmp_path, monkeypatch):
    read, plain = [], tables.customers
    monkeypatch.setattr(tables, "customers", lambda: read.append(1) or plain())
    arriving = str(tmp_path / "arriving")
    spark.read.parquet(topic[0]).write.mode("append").parquet(arriving)
    query = start_live_scoring(read_envelope_files(spark, arriving), tables, *models[1], str(tmp_path / "cp"),
                               as_of=queries.AS_OF)
    try:
        query.processAllAvailable()
        spark.read.parquet(topic[1]).write.mode("append").parquet(arriving)
        query.processAllAvailable()
    finally:
        query.stop()
    assert len({r.load_id for r in tables._read("transaction").select("load_id").distinct().collect()}) == 2
    assert len(read) == 1
    assert rows(tables.transactions()) == expected_rows(spark, models, *topic)


def test_the_newest_of_three_copies_decides(spark, tables):
    """Copies of one card and time in both halves: each half has its newest, and one of these is the newest of all."""
    start = "timestamp'2020-01-01 00:00:00'"
    copies = spark.createDataFrame(
        [("n1", 1.0, 0.0), ("n3", 2.0, 1.0), ("n2", 9.0, 0.0)], "trans_num string, amt double, is_fraud double")
    copies = copies.selectExpr("'1' cc_num", "trans_num", f"{start} trans_time", "'c' category", "'m' merchant", "amt",
                               "1d merch_lat", "1d merch_long", "amt distance", "1 age", "is_fraud")
    tables.write_transactions(copies, "three")
    assert [(r.trans_num, r.is_fraud) for r in tables.transactions().orderBy("trans_num").collect()] == [("n2", 0.0), ("n3", 1.0)]


def test_a_repeated_batch_replaces_itself(spark, topic, models, tables):
    customers, (trained, _) = derived.customers(spark, DATA), models
    batch = score_messages(spark.read.parquet(topic[0]), customers, trained.features, trained.forest, as_of=queries.AS_OF)
    for _ in range(2):
        tables.write_transactions(batch, "live_scoring-000000000007")
    assert tables._read("transaction").count() == batch.count()


def test_two_named_queries_store_the_same_rows(spark, topic, models, tables, tmp_path):
    trained, _ = models
    scored = score_messages(read_envelope_files(spark, topic[0]), tables.customers(), trained.features, trained.forest,
                            as_of=queries.AS_OF)
    fraud, rest = split_predictions(scored)
    started = [write_to_tables(half, tables, name, str(tmp_path / name), availableNow=True)
               for half, name in ((fraud, "fraud_query"), (rest, "other_query"))]
    assert [q.name for q in started] == ["fraud_query", "other_query"]
    for query in started:
        query.awaitTermination()
    assert rows(tables.transactions()) == expected_rows(spark, models, topic[0])


def test_unknown_cards_drop_from_the_stream(spark, tmp_path):
    header = '{"cc_num":"cc_num","trans_num":"trans_num","amt":"amt"}'
    envelope = spark.createDataFrame([(bytearray(header.encode()), 0, 0)], "value binary, partition int, offset bigint")
    assert enrich_stream(decode_messages(envelope), derived.customers(spark, DATA)).count() == 0


@pytest.mark.parametrize("limit,by_card", [(0, True), (1 << 30, False)])
def test_rows_moved_by_card_are_stored_where_they_are(spark, topic, models, tables, tmp_path, monkeypatch, limit, by_card):
    placed, plain = [], tables.write_transactions
    monkeypatch.setattr(tables, "write_transactions", lambda df, load, mode="append", by_card=False: placed.append(by_card)
                        or plain(df, load, mode, by_card))
    start_live_scoring(
        read_envelope_files(spark, topic[0]), tables, *models[1], str(tmp_path / "cp"), trigger={"availableNow": True},
        as_of=queries.AS_OF, broadcast_limit=limit).awaitTermination()
    assert placed == [by_card]
    assert rows(tables.transactions()) == expected_rows(spark, models, topic[0])


def test_a_sink_takes_rows_by_card_as_they_lie(spark, topic, models, tables, tmp_path):
    trained, _ = models
    scored = score_messages(read_envelope_files(spark, topic[0]), tables.customers(), trained.features, trained.forest,
                            as_of=queries.AS_OF, broadcast_limit=0)
    write_to_tables(scored, tables, "by_card", str(tmp_path / "cp"), by_card=True, availableNow=True).awaitTermination()
    assert rows(tables.transactions()) == expected_rows(spark, models, topic[0])


@pytest.mark.parametrize("name", ["stream_split_rule", "stream_enrich"])
def test_streams_read_messages_that_are_made_once(spark, monkeypatch, name):
    made, plain = [], derived._envelopes
    monkeypatch.setattr(derived, "_envelopes", lambda lines, *a: made.append(lines.isStreaming) or plain(lines, *a))
    queries.QUERIES[name](spark, DATA)
    assert made == [False]
