import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F

from tapwise.operators.transactions import with_age
from tapwise.plans.bulk_load import bulk_load
from tapwise.schemas import ENRICHED_COLUMNS, MESSAGE_FIELDS
from tapwise.sources import derived
from tapwise.sources.files import read_customers, read_labelled_transactions
from tapwise.sources.folders import shared_folder
from tapwise.sources.manifest import Manifest, Part
from tapwise.sources.tables import CardTables
from tapwise.sources.topics import write_message_files
from tapwise.operators.transactions import encode_messages
from conftest import DATA

CUSTOMERS = """cc_num,first,last,gender,street,city,state,zip,lat,long,job,dob
1,Ann,Lee,F,1 Road,Town,CA,00123,40.0,-70.0,"Designer, industrial",1980-01-01T00:00:00.000+05:30
2,Bob,Ray,M,2 Road,Town,CA,95233,41.0,-71.0,Clerk,1900-01-01T00:00:00.000+05:53
3,Cid,Fox,M,3 Road,Town,CA,95233,42.0,-72.0,Clerk,1943-01-01T00:00:00.000+06:30
4,Dee,Fox,F,4 Road,Town,CA,95233,43.0,-73.0,Clerk,someday
"""
TRANSACTIONS = """cc_num,first,last,trans_num,trans_date,trans_time,unix_time,category,merchant,amt,merch_lat,merch_long,is_fraud
1,Ann,Lee,n1,2019-11-02T00:00:00.000Z,10:00:00,1,food,"A, B",12.5,40.0,-70.0,0
1,Ann,Lee,n2,2019-11-02T00:00:00.000Z,10:00:00,1,food,shop,13.5,40.0,-70.0,0
2,Bob,Ray,n3,2019-12-30T00:00:00.000Z,10:00:00,1,food,shop,99.0,41.0,-71.0,1
2,Bob,Ray,n4,2019-12-31T00:00:00.000Z,10:00:00,1,food,shop,99.0,41.0,-71.0,
9,Zoe,Ash,n5,2019-12-31T00:00:00.000Z,10:00:00,1,food,shop,99.0,41.0,-71.0,1
"""


@pytest.fixture
def inputs(tmp_path):
    (tmp_path / "customers.csv").write_text(CUSTOMERS)
    (tmp_path / "transactions.csv").write_text(TRANSACTIONS)
    return str(tmp_path / "customers.csv"), str(tmp_path / "transactions.csv")


@pytest.fixture
def tables(spark, tmp_path):
    found = CardTables(spark, str(tmp_path / "tables"))
    found.create()
    return found


def enriched(spark, *rows):
    """Stored-form transactions from (card, number, second, label)."""
    return spark.createDataFrame(
        [(c, n, dt.datetime(2020, 1, 1, 0, 0, s), "food", "shop", 1.0, 2.0, 3.0, 4.0, 50, label) for c, n, s, label in rows],
        "cc_num string, trans_num string, trans_time timestamp, category string, merchant string, amt double, "
        "merch_lat double, merch_long double, distance double, age int, is_fraud double")


def numbers(df):
    return sorted(r.trans_num for r in df.collect())


def test_customer_csv_with_offsets_quotes_and_bad_birth(spark, inputs):
    rows = {r.cc_num: r for r in read_customers(spark, inputs[0]).collect()}
    assert rows["1"].job == "Designer, industrial" and rows["1"].zip == "00123"
    assert rows["1"].dob == dt.datetime(1979, 12, 31, 18, 30)
    assert rows["2"].dob == dt.datetime(1899, 12, 31, 18, 7)
    assert rows["3"].dob == dt.datetime(1942, 12, 31, 17, 30)
    assert rows["4"].dob is None


def test_transaction_csv(spark, inputs):
    rows = {r.trans_num: r for r in read_labelled_transactions(spark, inputs[1]).collect()}
    assert len(rows) == 5 and rows["n1"].merchant == "A, B" and rows["n4"].is_fraud is None


def test_bulk_load(spark, inputs, tables):
    bulk_load(spark, *inputs, tables, "first", as_of="2020-01-01")
    assert numbers(tables.fraud_transactions()) == ["n3"]
    assert numbers(tables.non_fraud_transactions()) == ["n2"]  # n1 has the same card and time
    assert tables.transactions().columns == ENRICHED_COLUMNS
    ages = {r.cc_num: r.age for r in tables.customers().collect()}
    assert ages == {"1": 40, "2": 120, "3": 77, "4": None}
    bulk_load(spark, *inputs, tables, "first", as_of="2020-01-01")  # a repeated load replaces itself
    assert tables._read("transaction").count() == 3


def test_append_overwrite_and_truncate(spark, tables):
    tables.write_transactions(enriched(spark, ("1", "a", 1, 0.0), ("1", "b", 2, 1.0)), "l1")
    tables.write_transactions(enriched(spark, ("2", "c", 1, 0.0), ("1", "d", 1, 0.0)), "l2")
    assert numbers(tables.transactions()) == ["b", "c", "d"]  # d is the later write of a's key
    tables.create()  # keeps present tables
    assert numbers(tables.transactions()) == ["b", "c", "d"]
    tables.write_transactions(enriched(spark, ("3", "e", 1, 1.0)), "l3", mode="overwrite")
    assert numbers(tables.transactions()) == ["e"]
    with pytest.raises(ValueError):
        tables.write_transactions(enriched(spark, ("3", "e", 1, 1.0)), "l4", mode="replace")
    tables.truncate()
    assert tables.transactions().count() == 0 and tables.customers().count() == 0


def test_last_customer_write_wins(spark, tables):
    people = derived.customers(spark, DATA)
    tables.write_customers(with_age(people, "2000-01-01"), "l1")
    tables.write_customers(with_age(people.filter("cc_num = '5'"), "2020-01-01"), "l2")
    old = {r.cc_num: r.age for r in with_age(people, "2000-01-01").collect()}
    new = {r.cc_num: r.age for r in tables.customers().collect()}
    assert new["5"] == old["5"] + 20
    assert {k: v for k, v in new.items() if k != "5"} == {k: v for k, v in old.items() if k != "5"}


def test_one_half_prunes_the_other(spark, tables):
    tables.write_transactions(enriched(spark, ("1", "a", 1, 0.0), ("1", "b", 2, 1.0)), "l1")
    plan = tables.fraud_transactions()._jdf.queryExecution().executedPlan().toString()
    partition_filters = plan[plan.index("PartitionFilters"):].split("]")[0]
    assert "is_fraud" in partition_filters and "1.0" in partition_filters


def test_card_filter_reaches_the_scan(spark, tables):
    tables.write_transactions(enriched(spark, ("1", "a", 1, 0.0)), "l1")
    plan = tables.fraud_transactions().filter("cc_num = '1'")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(cc_num,1)" in plan


def test_a_repeated_load_leaves_no_old_half(spark, tables):
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        tables.write_transactions(enriched(spark, ("1", "a", 1, 0.0), ("1", "b", 2, 1.0)), "l1")
        tables.write_transactions(enriched(spark, ("1", "a", 1, 0.0)), "l1")
        assert numbers(tables.transactions()) == ["a"]
        tables.truncate("transaction")
        assert tables.transactions().count() == 0
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)


def test_a_hot_card_is_stored_by_several_tasks_newest_first(spark, tables):
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100k")
    try:
        text, number = F.sha2(F.col("id").cast("string"), 256), F.col("id").cast("double")
        many = spark.range(0, 30_000, 1, 8).select(
            (F.col("id") % 1).cast("string").alias("cc_num"), text.alias("trans_num"),
            F.timestamp_seconds((F.col("id") * 7919) % 1_000_003).alias("trans_time"), text.alias("category"),
            text.alias("merchant"), *[number.alias(c) for c in ("amt", "merch_lat", "merch_long", "distance")],
            F.lit(50).alias("age"), (number * 0).alias("is_fraud"))
        tables.write_transactions(many, "l1")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    stored = tables._read("transaction").select("trans_time", F.input_file_name().alias("file")).collect()
    files = {}
    for r in stored:
        files.setdefault(r.file, []).append(r.trans_time)
    assert len(stored) == 30_000 and len(files) > 3
    assert all(times == sorted(times, reverse=True) for times in files.values())


def test_offsets_and_views(spark, tables):
    tables.write_offsets(spark.createDataFrame([(0, 5), (1, 3)], "partition int, offset bigint"), "l1")
    tables.write_offsets(spark.createDataFrame([(0, 9)], "partition int, offset bigint"), "l2")
    tables.write_transactions(enriched(spark, ("1", "a", 1, 0.0), ("1", "b", 2, 1.0)), "l1")
    tables.register_views()
    assert sorted(map(tuple, spark.table("kafka_offset").collect())) == [(0, 9), (1, 3)]
    assert spark.sql("SELECT trans_num FROM fraud_transaction").collect()[0][0] == "b"
    assert spark.sql("SELECT trans_num FROM non_fraud_transaction").collect()[0][0] == "a"
    assert spark.table("customer").count() == 0


def test_message_files(spark, tmp_path):
    row = spark.range(3).selectExpr(*[f"cast(id AS string) AS {f}" for f in MESSAGE_FIELDS])
    write_message_files(encode_messages(row), str(tmp_path / "topic"))
    assert spark.read.json(str(tmp_path / "topic")).count() == 3


def test_shared_folder_is_the_session_setting(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert named is None or shared_folder(spark) == named.rstrip("/")
    assert shared_folder(spark) == shared_folder(spark)


def test_customers_doubled_in_one_load_have_one_winner(spark, tmp_path):
    people = with_age(derived.customers(spark, DATA), "2020-01-01")
    doubled = people.withColumn("job", F.lit("a")).union(people.withColumn("job", F.lit("b")))
    for parts in (1, 4, 9):
        tables = CardTables(spark, str(tmp_path / f"doubled-{parts}"))
        tables.create()
        tables.write_customers(doubled.repartition(parts), "one")
        assert {r.job for r in tables.customers().select("job").distinct().collect()} == {"b"}


def test_compaction_keeps_results_and_drops_the_window(spark, tables):
    tables.write_transactions(enriched(spark, ("1", "a", 1, 0.0), ("1", "b", 1, 0.0), ("2", "c", 1, 1.0)), "first")
    tables.write_transactions(enriched(spark, ("1", "d", 1, 0.0), (None, "e", 2, 0.0), (None, "e", 2, 0.0)), "second")
    before = numbers(tables.transactions())
    assert before == ["c", "d", "e", "e"]
    assert "row_number" in tables.transactions()._jdf.queryExecution().optimizedPlan().toString()
    tables.compact()
    assert numbers(tables.transactions()) == before
    assert "row_number" not in tables.transactions()._jdf.queryExecution().optimizedPlan().toString()
    tables.write_transactions(enriched(spark, ("2", "f", 1, 1.0), ("3", "g", 1, 0.0)), "third")
    assert numbers(tables.transactions()) == ["d", "e", "e", "f", "g"]
    tables.write_transactions(enriched(spark, ("3", "h", 1, 0.0)), "second")  # repeated after compaction
    assert numbers(tables.fraud_transactions()) == ["f"]
    tables.compact()
    assert len(tables._manifest("transaction").parts()) == 1


def test_a_load_during_compaction_is_kept(spark, tables, monkeypatch):
    tables.write_transactions(enriched(spark, ("1", "a", 1, 0.0)), "first")
    write = tables._write

    def slow(df, table):
        folder = write(df, table)
        monkeypatch.undo()
        tables.write_transactions(enriched(spark, ("2", "b", 1, 0.0)), "meanwhile")
        return folder

    monkeypatch.setattr(tables, "_write", slow)
    tables.compact("transaction")
    assert numbers(tables.transactions()) == ["a", "b"]


def test_a_failing_overwrite_leaves_the_old_table(spark, tables):
    tables.write_transactions(enriched(spark, ("1", "a", 1, 0.0)), "first")
    bad = enriched(spark, ("1", "b", 1, 0.0)).withColumn("amt", F.raise_error(F.lit("broken")).cast("double"))
    with pytest.raises(Exception, match="broken"):
        tables.write_transactions(bad, "second", mode="overwrite")
    assert numbers(tables.transactions()) == ["a"]


def test_readers_keep_their_files_when_a_load_is_repeated(spark, tables):
    tables.write_transactions(enriched(spark, ("1", "a", 1, 0.0)), "same")
    reader = tables.transactions()
    tables.write_transactions(enriched(spark, ("1", "b", 1, 0.0)), "same")
    assert numbers(reader) == ["a"] and numbers(tables.transactions()) == ["b"]


def test_any_load_name_is_one_load(spark, tables):
    for name in ("a", "a/b", "a=1", "../c"):
        tables.write_transactions(enriched(spark, (name, name, 1, 0.0)), name)
    assert numbers(tables.transactions()) == ["../c", "a", "a/b", "a=1"]
    tables.write_transactions(enriched(spark, ("new", "new", 1, 0.0)), "a")
    assert numbers(tables.transactions()) == ["../c", "a/b", "a=1", "new"]
    with pytest.raises(ValueError, match="name"):
        tables.write_transactions(enriched(spark, ("1", "1", 1, 0.0)), "")


def test_a_writer_that_died_blocks_nobody(spark, tables, tmp_path):
    tables.write_transactions(enriched(spark, ("1", "a", 1, 0.0)), "first")
    manifest = tmp_path / "tables" / "transaction" / "manifest"
    number = max(int(f.name) for f in manifest.iterdir() if f.name.isdigit())
    (manifest / "_0123456789abcdef").write_text("[[")  # written aside, never renamed
    (manifest / f"_claim-{number + 1:012d}").write_text("")
    tables.write_transactions(enriched(spark, ("2", "b", 1, 0.0)), "second")
    assert numbers(tables.transactions()) == ["a", "b"]
    tables.truncate()
    assert numbers(tables.transactions()) == []


def test_racing_writers_lose_no_change(spark, tmp_path):
    path = str(tmp_path / "manifest")
    manifests = [Manifest(spark, path) for _ in range(4)]
    errors = []

    def write(writer):
        try:
            for k in range(8):
                manifests[writer].change(lambda parts, k=k: [*parts, Part(f"{writer}-{k}", "folder")])
        except Exception as error:
            errors.append(error)

    threads = [threading.Thread(target=write, args=(w,)) for w in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors
    loads = [p.load_id for p in Manifest(spark, path).parts()]
    assert sorted(loads) == sorted(f"{w}-{k}" for w in range(4) for k in range(8))
    for w in range(4):  # each writer's own changes are in order
        assert [x for x in loads if x.startswith(f"{w}-")] == [f"{w}-{k}" for k in range(8)]


def test_a_number_is_taken_once(spark, tmp_path):
    manifest = Manifest(spark, str(tmp_path / "manifest"))
    calls = []

    def overtaken(parts):
        calls.append(len(parts))
        if len(calls) == 1:  # somebody else is faster once
            Manifest(spark, str(tmp_path / "manifest")).change(lambda p: [*p, Part("other", "x")])
        return [*parts, Part("own", "y")]

    assert [p.load_id for p in manifest.change(overtaken)] == ["other", "own"]
    assert calls == [0, 1]
    assert [f.name for f in (tmp_path / "manifest").iterdir() if f.name.startswith("_")] == []


def test_a_change_that_is_always_overtaken_ends(spark, tmp_path, monkeypatch):
    manifest = Manifest(spark, str(tmp_path / "manifest"))
    monkeypatch.setattr(manifest, "_taken", lambda number, aside: False)
    with pytest.raises(RuntimeError, match="overtook"):
        manifest.change(lambda parts: parts)
