import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from tapwise.operators import keyed
from tapwise.sources.bucketed import CardBuckets, CardTable

SCHEMA = "cc_num string, trans_time timestamp, trans_num string, amt double"
NEWEST = ["trans_num", "amt"]


def table(spark, tmp_path, buckets=8, hot_rows=1000):
    name = f"t_{uuid.uuid4().hex}"
    schema = spark.createDataFrame([], SCHEMA).schema
    return CardBuckets(spark, name, str(tmp_path / "cards"), schema, NEWEST, buckets, hot_rows)


def rows(spark, *some):
    start = dt.datetime(2020, 1, 1)
    return spark.createDataFrame(
        [(c, None if s is None else start + dt.timedelta(seconds=s), n, a) for c, s, n, a in some], SCHEMA)


def found(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def files(tmp_path, layout="by_card"):
    return {str(f.relative_to(tmp_path)): f.stat().st_mtime_ns for f in (tmp_path / "cards" / layout).rglob("*.parquet")}


@pytest.fixture(scope="module")
def many(spark):
    """2,000 cards with three rows each."""
    second = F.timestamp_seconds(F.col("id") * 60_000 % 10_000_019)
    return spark.range(6000).select(
        (F.col("id") % 2000).cast("string").alias("cc_num"), second.alias("trans_time"),
        F.col("id").cast("string").alias("trans_num"), F.col("id").cast("double").alias("amt")).cache()


def test_last_write_wins_across_loads(spark, tmp_path):
    cards = table(spark, tmp_path)
    cards.merge(rows(spark, ("1", 5, "z", 9.0), ("1", 5, "a", 1.0), ("1", 6, "b", 1.0), ("2", 5, "c", 1.0),
                     (None, 5, "d", 1.0), ("3", None, "e", 1.0)))
    assert found(cards.transactions(), "cc_num", "trans_num") == [("1", "b"), ("1", "z"), ("2", "c")]
    load = rows(spark, ("1", 5, "f", 0.5), ("4", 5, "g", 1.0))
    for _ in range(2):  # a repeated load changes nothing
        cards.merge(load)
        assert found(cards.transactions(), "cc_num", "trans_num") == [("1", "b"), ("1", "f"), ("2", "c"), ("4", "g")]
    cards.merge(load.filter("false"))
    assert cards.transactions().count() == 4


def test_a_small_load_rewrites_its_own_buckets_only(spark, tmp_path, many):
    cards = table(spark, tmp_path, buckets=64)
    cards.merge(many)
    before = files(tmp_path)
    assert len(before) == 64  # one file for each bucket
    one_percent = many.filter("cast(cc_num as int) < 20").withColumn("amt", F.lit(-1.0))
    touched = {r[0] for r in one_percent.select(cards.ordinary.bucket()).distinct().collect()}
    cards.merge(one_percent)
    after = files(tmp_path)
    gone, kept = set(before) - set(after), set(before) & set(after)
    assert {int(f.split("bucket=")[1].split("/")[0]) for f in gone} == touched and len(touched) <= 20
    assert len(kept) == 64 - len(touched) and all(before[f] == after[f] for f in kept)
    assert cards.transactions().count() == many.count()
    assert cards.transactions().filter("amt = -1").count() == one_percent.count()


def test_history_and_latest_rows_need_no_exchange(spark, tmp_path, many):
    cards = table(spark, tmp_path)
    cards.merge(many)
    history = cards.history()
    assert "Exchange" not in plan(history)
    assert "Exchange" not in plan(keyed.latest_per_key(cards.transactions(), ["cc_num", "trans_time"], NEWEST))
    expected = keyed.card_history(many, newest_first=NEWEST)
    assert found(history, *history.columns) == found(expected, *history.columns)


def test_the_card_join_needs_no_exchange(spark, tmp_path, many):
    cards = table(spark, tmp_path)
    cards.merge(many)
    people = CardTable(spark, f"p_{uuid.uuid4().hex}", str(tmp_path / "people"), buckets=8)
    owners = many.select("cc_num").distinct().filter("cc_num != '7'").withColumn("owner", F.concat(F.lit("o"), "cc_num"))
    people.write(owners.unionByName(spark.createDataFrame([(None, "nobody")], "cc_num string, owner string")))
    joined = cards.join_cards(people)
    assert "Exchange" not in plan(joined) and "SortMergeJoin" in plan(joined)
    assert found(joined, "trans_num", "owner") == found(many.join(owners, "cc_num"), "trans_num", "owner")


def test_a_hot_card_moves_to_buckets_of_days(spark, tmp_path, many):
    cards = table(spark, tmp_path, hot_rows=500)
    days = spark.range(1200).select(
        F.lit("hot").alias("cc_num"), F.timestamp_seconds(F.col("id") * 7200).alias("trans_time"),
        F.concat(F.lit("h"), F.col("id").cast("string")).alias("trans_num"), F.lit(1.0).alias("amt"))
    everything = many.unionByName(days)
    cards.merge(many.unionByName(days.filter("trans_num < 'h4'")))
    cards.merge(days.filter("trans_num >= 'h4'"))
    assert cards.hot.rows().count() == 1200 and cards.ordinary.rows().filter("cc_num = 'hot'").count() == 0
    per_file = {r[0]: r[1] for r in cards.hot.rows().groupBy(F.input_file_name()).count().collect()}
    assert len(per_file) == 8 and max(per_file.values()) < 500
    assert found(cards.transactions(), "trans_num") == found(everything, "trans_num")
    expected = keyed.card_history(everything, newest_first=NEWEST)
    assert found(cards.history(), *expected.columns) == found(expected, *expected.columns)
    cards.merge(days.limit(3).withColumn("amt", F.lit(5.0)).withColumn("trans_num", F.lit("new")))
    assert cards.transactions().count() == everything.count()
    assert cards.transactions().filter("trans_num = 'new' and amt = 5").count() == 3
    people = CardTable(spark, f"p_{uuid.uuid4().hex}", str(tmp_path / "people"), buckets=8)
    people.write(everything.select("cc_num").distinct().withColumn("owner", F.upper("cc_num")))
    assert cards.join_cards(people).filter("owner = 'HOT'").count() == 1200
    assert cards.join_cards(people).count() == everything.count()


def test_a_bucket_of_nothing_but_a_hot_card_is_emptied(spark, tmp_path, many):
    cards = table(spark, tmp_path, buckets=4, hot_rows=10)
    single = many.filter("cc_num = '1'")
    cards.merge(single)
    more = spark.range(20).select(F.lit("1").alias("cc_num"), F.timestamp_seconds(F.col("id") + 5).alias("trans_time"),
                                  F.col("id").cast("string").alias("trans_num"), F.lit(1.0).alias("amt"))
    cards.merge(more)
    assert cards.ordinary.rows().count() == 0 and cards.hot.rows().count() == 23


def test_another_session_finds_the_buckets(spark, tmp_path, many):
    cards = table(spark, tmp_path)
    cards.merge(many)
    again = table(spark, tmp_path)  # another name for the same place, as in a new catalog
    assert again.transactions().count() == many.count()
    again.merge(rows(spark, ("0", 1, "x", 1.0)))
    assert again.transactions().count() == many.count() + 1
