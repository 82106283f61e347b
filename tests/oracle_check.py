"""Compare registered queries with their SQL, row for row: python tests/oracle_check.py [folder] [query ...]"""

import glob
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry_points  # noqa: E402


def duckdb_rows(folder: str, sql: str) -> pd.DataFrame:
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection.execute(sql).df()


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for column in df.columns:
        if pd.api.types.is_datetime64_any_dtype(df[column]):
            df[column] = df[column].astype("datetime64[us]")
        elif pd.api.types.is_integer_dtype(df[column]):
            df[column] = df[column].astype("float64" if df[column].isna().any() else "int64")
    return df.sort_values(list(df.columns)).reset_index(drop=True)


def compare(spark, folder: str, name: str) -> str | None:
    """None if Spark and DuckDB agree, else the difference."""
    expected = canonical(duckdb_rows(folder, entry_points.oracle_sql()[name]))
    actual = canonical(entry_points.queries()[name](spark, folder).toPandas())
    try:
        pd.testing.assert_frame_equal(actual, expected, check_exact=True)
    except AssertionError as difference:
        return str(difference)
    return None if len(expected) else "no rows on either side"


if __name__ == "__main__":
    from conftest import make_session

    session = make_session()
    data = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    for query in sys.argv[2:] or entry_points.queries():
        begin = time.time()
        if query in entry_points.oracle_sql():
            outcome = compare(session, data, query) or "equal"
        else:
            outcome = f"{entry_points.queries()[query](session, data).count()} rows"
        print(f"{query:25s} {time.time() - begin:6.1f}s  {outcome}", flush=True)
