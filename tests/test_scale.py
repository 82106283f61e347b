"""Plans that move and read less: fewer bytes, one reading, no distance that is not needed."""

import datetime
import pathlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tapwise.operators import keyed, kmeans
from tapwise.sources import derived
from tapwise.sources.folders import shuffles_dropped
from tapwise.sources.tables import CardTables

DAY = datetime.datetime(2020, 1, 1)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def card_rows(spark, rows):
    return spark.createDataFrame(rows, "cc_num string, trans_time timestamp, trans_num string, amt double")


def test_lines_go_to_their_orders_with_few_columns(spark, tmp_path):
    def table(name, schema, *rows):
        spark.createDataFrame(list(rows), schema).write.parquet(f"{tmp_path}/{name}.parquet")

    table("lineitem", "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double,"
          " l_extendedprice double, l_discount double, l_returnflag string, l_shipdate timestamp",
          (1, 1, 1, 1, 50.0, 9.5, 0.09, "R", DAY), (1, 1, 1, 2, None, 9.5, 0.09, "R", DAY), (1, 1, 1, 3, 50.0, 9.5, 0.09, None, DAY))
    table("orders", "o_orderkey long, o_custkey long, o_orderpriority string", (1, 7, "x"))
    table("part", "p_partkey long, p_type string", (1, "A"))
    table("supplier", "s_suppkey long, s_name string", (1, "S"))
    rows = derived.transactions(spark, str(tmp_path))
    assert [r["is_fraud"] for r in rows.orderBy("trans_num").collect()] == [1.0, 0.0, 0.0]
    joins = rows._jdf.queryExecution().optimizedPlan().toString().split("Join")
    lines = next(part for part in joins if "_flagged" in part and "l_partkey" in part)
    assert "l_returnflag" not in lines.splitlines()[1]


def test_history_reads_its_input_twice_at_most(spark, tmp_path):
    card_rows(spark, [("a", DAY, "1", 1.0), ("a", DAY, "2", 2.0), ("b", None, "3", 3.0)]).write.parquet(f"{tmp_path}/rows")
    history = keyed.card_history(spark.read.parquet(f"{tmp_path}/rows"), newest_first=["trans_num", "amt"])
    found = {r["trans_num"]: r["position"] for r in history.collect()}
    assert found == {"2": 1, "3": None}
    # one for the rows with a position, whose exchange the counts of days share, and one for those without
    final = plan(history).split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final
    assert len(re.findall(r"FileScan|Scan parquet", final)) <= 2


def test_only_repeated_keys_of_a_stored_table_are_ranked(spark, monkeypatch):
    rows = [(f"c{i % 5}", DAY + datetime.timedelta(seconds=i), str(i), 1.0) for i in range(40)]
    rows += [("c1", DAY + datetime.timedelta(seconds=1), "z", 5.0), (None, DAY, "n", 1.0), (None, DAY, "n", 1.0)]
    df, key, order = card_rows(spark, rows), ["cc_num", "trans_time"], ["trans_num", "amt"]
    expected = sorted(map(str, keyed.latest_per_key(df, key, order).collect()))
    ranked, plain = [], keyed.latest_complete

    def counted(some, *arguments):
        ranked.append(some.count())
        return plain(some, *arguments)

    monkeypatch.setattr(keyed, "latest_complete", counted)
    assert sorted(map(str, keyed.latest_stored(df, key, order).collect())) == expected
    assert ranked == [2]
    monkeypatch.setattr(keyed, "BROADCAST_LIMIT_BYTES", 0)  # too many repeated keys
    assert sorted(map(str, keyed.latest_stored(df, key, order).collect())) == expected


def test_a_join_to_an_empty_table_moves_nothing(spark, tmp_path):
    tables = CardTables(spark, str(tmp_path))
    tables.create()
    rows = spark.range(10).select(F.col("id").cast("string").alias("cc_num"))
    left = rows.join(tables.customers().select("cc_num").distinct(), "cc_num", "left_anti")
    assert left.count() == 10 and "Exchange" not in plan(left)


def test_rows_behind_a_join_by_card_are_stored_without_another_exchange(spark, tmp_path):
    df = card_rows(spark, [("a", DAY, "1", 1.0)])
    assert "Exchange" not in plan(keyed.newest_first_in_place(df))
    assert "Exchange" in plan(keyed.cluster_newest_first(df))


def test_choosing_many_centres_passes_over_far_candidates(monkeypatch):
    rng = np.random.default_rng(5)
    points = rng.normal(0, 1, (24_000, 3))
    touched, plain = [], np.minimum

    def counted(a, b):
        touched.append(a.size)
        return plain(a, b)

    monkeypatch.setattr(np, "minimum", counted)
    chosen = kmeans._choose(points, np.ones(len(points)), 3_000, np.random.default_rng(1))
    monkeypatch.undo()
    assert len(np.unique(chosen, axis=0)) == 3_000
    assert sum(touched) < 0.2 * len(points) * len(chosen)
    cost = kmeans.nearest_centres(points, chosen)[1].sum()
    drawn = points[rng.choice(len(points), 3_000, replace=False)]
    assert cost < kmeans.nearest_centres(points, drawn)[1].sum()


def test_runs_with_few_candidates_are_not_divided(monkeypatch):
    rng = np.random.default_rng(3)
    points = rng.normal(0, 1, (50_000, 3))
    points = points[kmeans._curve_order(points)]
    calls, plain = [], kmeans._candidates
    monkeypatch.setattr(kmeans, "_candidates", lambda *a: calls.append(1) or plain(*a))
    centres = rng.normal(0, 1, (kmeans.FEW_CENTRES, 3))
    index, _ = kmeans.nearest_centres(points, centres)
    assert len(calls) < len(points) / kmeans.BOX / 4
    some = rng.choice(len(points), 500)
    assert (index[some] == ((points[some, None] - centres) ** 2).sum(2).argmin(1)).all()


def test_a_run_of_points_looks_only_at_blocks_of_centres_near_it(monkeypatch):
    rng = np.random.default_rng(9)
    centres = rng.random((20_000, 3))
    points = rng.random((40_000, 3)) * 0.1
    points = points[kmeans._curve_order(points)]
    looked, plain = [], kmeans._candidates
    monkeypatch.setattr(kmeans, "_candidates", lambda low, high, some: looked.append(len(some)) or plain(low, high, some))
    index, least = kmeans.nearest_centres(points, centres)
    assert sum(looked) < len(centres)
    for at in rng.choice(len(points), 300):
        squares = ((points[at] - centres) ** 2).sum(1)
        assert index[at] == squares.argmin() and least[at] == squares.min()


def test_rounds_over_packed_points_equal_those_over_single_ones(spark, monkeypatch):
    rng = np.random.default_rng(4)
    points = np.concatenate([rng.normal(0, 1, (3000, 3)), np.full((5, 3), 2.0), [[1e5, 0.0, 0.0]]])
    rows = spark.createDataFrame([(p.tolist(),) for p in points], "point array<double>").repartition(5)
    single, packed = kmeans.weighted_points(rows, "point"), kmeans.packed_points(rows, "point")
    assert packed.count() < single.count() / 20  # few rows go to Python in a pass
    start = points[rng.integers(0, len(points), 700)]
    monkeypatch.setattr(kmeans, "PAIRS", 500)  # lists of boxes are divided
    for one, other in zip(kmeans.lloyd_round(single, start), kmeans.lloyd_round(packed, start)):
        assert np.allclose(one, other, rtol=1e-9)
    at = ((points[:, None] - start) ** 2).sum(2).argmin(1)
    assert (kmeans.lloyd_round(packed, start)[1] == np.bincount(at, minlength=len(start))).all()


def test_start_centres_are_points_and_all_of_few(spark):
    rng = np.random.default_rng(6)
    points = rng.normal(0, 1, (500, 2))
    packed = kmeans.packed_points(spark.createDataFrame([(p.tolist(),) for p in points], "point array<double>"), "point")
    known = {tuple(p) for p in points}
    some = kmeans.start_centres(packed, 40)
    assert len({tuple(c) for c in some}) == 40 and {tuple(c) for c in some} <= known
    assert {tuple(c) for c in kmeans.start_centres(packed, 500)} == known


def test_streamed_messages_are_packed_and_come_in_bounded_batches(spark, tmp_path, monkeypatch):
    from conftest import DATA
    from tapwise.plans import queries

    topics, plain = [], derived.envelope_topic

    def dealt_out(session, folder):
        path = f"{tmp_path}/topic-{len(topics)}"
        session.read.parquet(plain(session, folder)).repartition(4).write.parquet(path)
        topics.append(path)
        return path

    packed = spark.read.parquet(plain(spark, DATA)).inputFiles()
    assert packed and all(f.endswith(".zstd.parquet") for f in packed)
    monkeypatch.setattr(derived, "envelope_topic", dealt_out)
    monkeypatch.setattr(queries, "BATCH_BYTES", 1)
    found = queries.stream_enrich(spark, DATA)
    out = found.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://").removeprefix("file:")
    batches = [int(p.name) for p in pathlib.Path(out).parent.joinpath("checkpoint", "commits").iterdir() if p.name.isdigit()]
    assert sorted(batches) == [0, 1, 2, 3]
    assert found.count() == spark.read.parquet(topics[0]).count()


def test_shuffle_files_of_written_jobs_are_dropped(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    with pytest.raises(ValueError), shuffles_dropped(spark):
        assert spark.conf.get(name) == "true"
        raise ValueError
    assert spark.conf.get(name, None) == before
