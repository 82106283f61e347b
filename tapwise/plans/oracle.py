"""DuckDB SQL for the registered queries, over the same tables and column names."""

_CUSTOMERS = """
fx_customer AS (
  SELECT CAST(c_custkey AS VARCHAR) AS cc_num, c_name AS first, c_mktsegment AS last,
         CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
         c_custkey || ' Main Street, Flat ' || c_nationkey AS street,
         n_name AS city, r_name AS state, lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') AS zip,
         25 + ((c_custkey * 37) % 2400) / 100.0::DOUBLE AS lat,
         -124 + ((c_custkey * 53) % 5600) / 100.0::DOUBLE AS long,
         c_mktsegment AS job,
         CAST(DATE '1930-01-01' + CAST((c_custkey * 7919) % 25000 AS INT) AS TIMESTAMP) AS dob
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""

_TRANSACTIONS = """
fx_txn AS (
  SELECT CAST(o_custkey AS VARCHAR) AS cc_num,
         'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS first, o_orderpriority AS last,
         concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS trans_num,
         strftime(l_shipdate, '%Y-%m-%d') || 'T00:00:00.000' AS trans_date,
         strftime(TIMESTAMP '1970-01-01' + to_seconds((l_orderkey * 31 + l_linenumber * 977) % 86400), '%H:%M:%S') AS trans_time,
         CAST(epoch(CAST(l_shipdate AS DATE)) AS BIGINT) + (l_orderkey * 31 + l_linenumber * 977) % 86400 AS unix_time,
         p_type AS category, s_name AS merchant, l_extendedprice AS amt,
         25 + ((l_suppkey * 41 + l_partkey * 7) % 2400) / 100.0::DOUBLE AS merch_lat,
         -124 + ((l_suppkey * 59 + l_partkey * 11) % 5600) / 100.0::DOUBLE AS merch_long,
         CASE WHEN l_returnflag = 'R' AND l_quantity >= 49 AND l_discount >= 0.09 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_fraud,
         CAST(l_orderkey % 4 AS INT) AS "partition", l_orderkey * 10 + l_linenumber AS "offset"
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
), clean AS (
  SELECT * REPLACE (split_part(trans_date, 'T', 1) AS trans_date,
                    strptime(split_part(trans_date, 'T', 1) || ' ' || trans_time, '%Y-%m-%d %H:%M:%S') AS trans_time)
  FROM fx_txn
)"""

_AGE = "CAST(trunc(date_diff('day', CAST(dob AS DATE), DATE '2020-04-16') / 365.0::DOUBLE) AS INT)"


def _distance(lat="merch_lat", long="merch_long"):
    a = (f"(pow(sin(radians({lat} - lat) / 2), 2) + cos(radians(lat)) * cos(radians({lat}))"
         f" * pow(sin(radians({long} - long) / 2), 2))")
    return f"6371 * 2 * atan2(sqrt({a}), sqrt(1 - {a}))"


_ENRICHED = f"""
enriched AS (
  SELECT cc_num, trans_num, trans_time, category, merchant, amt, merch_lat, merch_long,
         round({_distance()}, 2) AS distance, {_AGE} AS age, is_fraud
  FROM clean JOIN (SELECT cc_num, lat, long, dob FROM fx_customer) USING (cc_num)
)"""

_NEWEST = """
newest AS (
  SELECT * FROM clean
  QUALIFY row_number() OVER (PARTITION BY cc_num, trans_time ORDER BY trans_num DESC, amt DESC) = 1
)"""

_MESSAGES = """
message AS (
  SELECT cc_num, first, last, trans_num, strftime(trans_time, '%Y-%m-%d %H:%M:%S') AS trans_time, category, merchant,
         printf('%.2f', amt) AS amt, printf('%.2f', merch_lat) AS merch_lat, printf('%.2f', merch_long) AS merch_long,
         "partition", "offset"
  FROM clean
)"""

_RULED = """
matrix AS (
  SELECT count(*) FILTER (amt > 60000 AND is_fraud = 1) AS tp,
         count(*) FILTER (amt > 60000 AND is_fraud = 0) AS fp,
         count(*) FILTER (amt <= 60000 AND is_fraud = 0) AS tn,
         count(*) FILTER (amt <= 60000 AND is_fraud = 1) AS fn
  FROM fx_txn
)"""


def _index(column):
    return f"""
{column}_index AS (
  SELECT {column} AS value, count(*) AS rows,
         row_number() OVER (ORDER BY count(*) DESC, {column}) - 1 AS index
  FROM fx_txn GROUP BY {column}
)"""


def _with(*parts):
    return "WITH " + ", ".join(parts)


def _scaled(column, table):
    return (f"round(({column} - (SELECT avg({column}) FROM {table}))"
            f" / (SELECT stddev_samp({column}) FROM {table}), 4) + 0.0 AS {column}_scaled")


_ON_TRAIN_SIDE = "CAST('0x' || substr(md5('42|' || trans_num), 1, 8) AS BIGINT) < 3435973836"

_ENRICH = _with(_CUSTOMERS, _TRANSACTIONS, _ENRICHED)
_SCALED_ROWS = (f"{_ENRICH} SELECT trans_num, {_scaled('distance', 'enriched')}, {_scaled('amt', 'enriched')},"
                f" {_scaled('age', 'enriched')} FROM enriched")
_STREAMED = (
    'SELECT cc_num, trans_num, trans_time, category, merchant, CAST(amt AS DOUBLE) AS amt,'
    ' CAST(merch_lat AS DOUBLE) AS merch_lat, CAST(merch_long AS DOUBLE) AS merch_long, "partition", "offset"')
_LIVE = (
    f"{_ENRICH}, {_MESSAGES}, streamed AS ({_STREAMED.replace('trans_time,', 'CAST(trans_time AS TIMESTAMP) AS trans_time,', 1)}"
    f" FROM message), live AS (SELECT streamed.*, round({_distance()}, 2) AS distance, {_AGE} AS age"
    " FROM streamed JOIN (SELECT cc_num, lat, long, dob FROM fx_customer) USING (cc_num))")

_TWO_LOADS = "PARTITION BY cc_num, trans_time ORDER BY amt > 30000 DESC, trans_num DESC, amt DESC"


def _lloyd(rounds):
    """Lloyd rounds as a chain of common table expressions; ties go to the first centre."""
    parts = ["""
point AS MATERIALIZED (
  SELECT distance / 100.0::DOUBLE AS x, amt / 10000.0::DOUBLE AS y, age / 10.0::DOUBLE AS z, count(*) AS w
  FROM enriched GROUP BY ALL
), centre_0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY md5(trans_num), trans_num, amt) - 1 AS k, distance / 100.0::DOUBLE AS x,
         amt / 10000.0::DOUBLE AS y, age / 10.0::DOUBLE AS z
  FROM enriched ORDER BY k LIMIT 12
)"""]
    for r in range(rounds + 1):
        parts.append(f"""
near_{r} AS (
  SELECT p.x, p.y, p.z, any_value(p.w) AS w,
         arg_min(c.k, (p.x - c.x) * (p.x - c.x) + (p.y - c.y) * (p.y - c.y) + (p.z - c.z) * (p.z - c.z) ORDER BY c.k) AS k
  FROM point p CROSS JOIN centre_{r} c GROUP BY p.x, p.y, p.z
)""")
        if r < rounds:
            parts.append(f"""
centre_{r + 1} AS MATERIALIZED (
  SELECT c.k, coalesce(sum(n.w * n.x) / sum(n.w), any_value(c.x)) AS x,
         coalesce(sum(n.w * n.y) / sum(n.w), any_value(c.y)) AS y, coalesce(sum(n.w * n.z) / sum(n.w), any_value(c.z)) AS z
  FROM centre_{r} c LEFT JOIN near_{r} n ON c.k = n.k GROUP BY c.k
)""")
    return ", ".join(parts)


ORACLE = {
    "enrich_transactions": f"{_ENRICH} SELECT * FROM enriched",
    "normalize_transactions": f'{_with(_TRANSACTIONS)} SELECT * EXCLUDE ("partition", "offset") FROM clean',
    "customer_age": f"{_with(_CUSTOMERS)} SELECT cc_num, dob, {_AGE} AS age FROM fx_customer",
    "haversine_distance": (
        f"{_with(_CUSTOMERS, _TRANSACTIONS)} SELECT trans_num, round({_distance()}, 3) AS km"
        " FROM fx_txn JOIN (SELECT cc_num, lat, long FROM fx_customer) USING (cc_num)"),
    "fraud_transactions": f"{_ENRICH} SELECT * FROM enriched WHERE is_fraud = 1",
    "non_fraud_transactions": f"{_ENRICH} SELECT * FROM enriched WHERE is_fraud = 0",
    "labelled_union": (
        f"{_ENRICH} SELECT cc_num, category, merchant, distance, amt, age, is_fraud, trans_num FROM enriched"
        " WHERE is_fraud = 0 UNION ALL SELECT cc_num, category, merchant, distance, amt, age, is_fraud, trans_num"
        " FROM enriched WHERE is_fraud = 1"),
    "format_in_zone": (
        "SELECT event_id, strftime(ts + INTERVAL '5 hours 30 minutes', '%Y-%m-%d %H:%M:%S') AS sent_at,"
        " epoch_us(ts) // 1000 AS sent_millis FROM events"),
    "latest_per_key": (
        f"{_with(_TRANSACTIONS, _NEWEST)} SELECT cc_num, trans_time, trans_num, amt, is_fraud FROM newest"),
    "card_history": (
        f"{_with(_TRANSACTIONS, _NEWEST)} SELECT cc_num, trans_time, trans_num, amt,"
        " row_number() OVER (PARTITION BY cc_num ORDER BY trans_time DESC, trans_num DESC) AS position FROM newest"),
    "bucketed_history": (
        f"{_with(_TRANSACTIONS)}, won AS (SELECT * FROM clean QUALIFY row_number() OVER ({_TWO_LOADS}) = 1)"
        " SELECT cc_num, trans_time, trans_num, amt,"
        " row_number() OVER (PARTITION BY cc_num ORDER BY trans_time DESC, trans_num DESC) AS position FROM won"),
    "bucketed_enrich": f"{_ENRICH} SELECT * FROM enriched QUALIFY row_number() OVER ({_TWO_LOADS}) = 1",
    "offset_progress": (
        f'{_with(_TRANSACTIONS)} SELECT "partition", max("offset") AS "offset" FROM fx_txn GROUP BY "partition"'),
    "resumed_offsets": (
        f'{_with(_TRANSACTIONS, _MESSAGES)}, stored AS (SELECT "partition" AS p, max("offset") AS o FROM message'
        ' WHERE "offset" <= 20000 AND "partition" < 3 GROUP BY p)'
        ' SELECT trans_num, amt, "partition", "offset" FROM message LEFT JOIN stored ON "partition" = p'
        ' WHERE o IS NULL OR "offset" > o'),
    "json_encode": (
        f"{_with(_TRANSACTIONS, _MESSAGES)} SELECT trans_num, CAST(json_object("
        + ", ".join(f"'{c}', {c}" for c in (
            "cc_num", "first", "last", "trans_num", "trans_time", "category", "merchant", "amt", "merch_lat",
            "merch_long"))
        + ") AS VARCHAR) AS value FROM message"),
    "json_decode": f"{_with(_TRANSACTIONS, _MESSAGES)} {_STREAMED} FROM message",
    "label_counts": f"{_with(_TRANSACTIONS)} SELECT is_fraud, count(*) AS rows FROM fx_txn GROUP BY is_fraud",
    "confusion_matrix": f"{_with(_TRANSACTIONS, _RULED)} SELECT tp, fp, tn, fn FROM matrix",
    "classification_rates": (
        f"{_with(_TRANSACTIONS, _RULED)} SELECT tp / nullif(tp + fn, 0) AS true_positive_rate,"
        " fp / nullif(fp + tn, 0) AS false_positive_rate, tp / nullif(tp + fp, 0) AS precision FROM matrix"),
    "category_index": f"{_with(_TRANSACTIONS, _index('merchant'))} SELECT value, rows, index FROM merchant_index",
    "category_lookup": (
        f"{_with(_TRANSACTIONS, _index('merchant'))} SELECT trans_num, merchant,"
        " CAST(index AS DOUBLE) AS merchant_indexed FROM fx_txn JOIN merchant_index ON merchant = value"),
    "onehot_category": (
        f"{_with(_TRANSACTIONS, _index('category'))} SELECT trans_num, size,"
        " CASE WHEN index < size THEN index ELSE -1 END AS position FROM fx_txn JOIN category_index ON category = value,"
        " (SELECT count(*) - 1 AS size FROM category_index)"),
    "feature_slice": (
        f"{_with(_TRANSACTIONS)} SELECT trans_num, round(merch_long, 4) + 0.0 AS slot_0, round(amt, 4) + 0.0 AS slot_1"
        " FROM fx_txn"),
    "standard_scale": f"{_with(_TRANSACTIONS)} SELECT trans_num, {_scaled('amt', 'fx_txn')} FROM fx_txn",
    "feature_pipeline": _SCALED_ROWS,
    "saved_pipeline": (
        f"{_with(_CUSTOMERS, _TRANSACTIONS, _ENRICHED, _index('category'), _index('merchant'))}"
        " SELECT trans_num, CAST(c.index AS DOUBLE) AS category_slot, CAST(m.index AS DOUBLE) AS merchant_slot,"
        f" {_scaled('distance', 'enriched')}, {_scaled('amt', 'enriched')}, {_scaled('age', 'enriched')}"
        " FROM enriched JOIN category_index c ON category = c.value JOIN merchant_index m ON merchant = m.value"),
    "indexer_pipeline": (
        f"{_with(_CUSTOMERS, _TRANSACTIONS, _ENRICHED, _index('category'), _index('merchant'))}"
        " SELECT trans_num, CAST(c.index AS DOUBLE) AS category_slot, CAST(m.index AS DOUBLE) AS merchant_slot,"
        " round(distance, 4) + 0.0 AS distance_slot, round(amt, 4) + 0.0 AS amt_slot, CAST(age AS DOUBLE) AS age_slot"
        " FROM enriched JOIN category_index c ON category = c.value JOIN merchant_index m ON merchant = m.value"),
    "holdout_split": (
        f"{_with(_TRANSACTIONS)} SELECT trans_num,"
        f" CASE WHEN {_ON_TRAIN_SIDE} THEN 'train' ELSE 'test' END AS side FROM fx_txn"),
    "kmeans_balance": (
        f"{_with(_TRANSACTIONS)} SELECT count(*) AS fraud_rows, true AS centres_bounded, true AS centres_inside"
        f" FROM fx_txn WHERE is_fraud = 1 AND {_ON_TRAIN_SIDE}"),
    "kmeans_lloyd": (
        f"{_ENRICH}, {_lloyd(4)} SELECT c.k AS centre, CAST(coalesce(sum(n.w), 0) AS BIGINT) AS rows,"
        " round(any_value(c.x), 6) AS distance, round(any_value(c.y), 6) AS amt, round(any_value(c.z), 6) AS age"
        " FROM centre_4 c LEFT JOIN near_4 n ON c.k = n.k GROUP BY c.k"),
    "rf_score": (
        f"{_with(_TRANSACTIONS)} SELECT trans_num, is_fraud, true AS predicted, true AS probable, true AS agrees"
        f" FROM fx_txn WHERE NOT {_ON_TRAIN_SIDE}"),
    "forest_expression": (
        f"{_with(_TRANSACTIONS)} SELECT trans_num, amt, true AS same_prediction, true AS same_chance"
        f" FROM fx_txn WHERE NOT {_ON_TRAIN_SIDE}"),
    "csv_customers": f"{_with(_CUSTOMERS)} SELECT *, {_AGE} AS age FROM fx_customer",
    "csv_transactions": f'{_with(_TRANSACTIONS)} SELECT * EXCLUDE ("partition", "offset") FROM clean',
    "stored_transactions": (
        f"{_ENRICH} SELECT * FROM enriched QUALIFY row_number() OVER ("
        "PARTITION BY is_fraud, cc_num, trans_time ORDER BY trans_num DESC, amt DESC) = 1"),
    "stored_customers": f"{_with(_CUSTOMERS)} SELECT *, {_AGE} AS age FROM fx_customer",
    "stream_enrich": f"{_LIVE} SELECT * FROM live",
    "stream_split_sinks": (
        f"{_ENRICH} SELECT cc_num, trans_time, trans_num, distance, age, true AS same_half FROM enriched"
        " QUALIFY row_number() OVER (PARTITION BY cc_num, trans_time ORDER BY trans_num DESC, amt DESC) = 1"),
    "stream_split_rule": (
        f'{_LIVE} SELECT * EXCLUDE ("partition", "offset"),'
        " CASE WHEN amt > 60000 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_fraud"
        " FROM live QUALIFY row_number() OVER (PARTITION BY amt > 60000, cc_num, trans_time"
        " ORDER BY trans_num DESC, amt DESC) = 1"),
    "tables_overwrite": (
        f"{_ENRICH} SELECT * FROM enriched WHERE is_fraud = 0 QUALIFY row_number() OVER ("
        "PARTITION BY cc_num, trans_time ORDER BY trans_num DESC, amt DESC) = 1"),
}
