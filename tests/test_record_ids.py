"""Ids that look like years: the query's rows against its SQL."""

import duckdb

from lamina.plans.catalog import QUERIES, SQL


def test_numbers_of_conversations_are_no_years(spark, tmp_path):
    rows = [(c, t, f"text {c} {t}") for c in (5, 1999, 2000, 2025, 2026, 2029, 2100, 20_240, 120_255) for t in range(4)]
    spark.createDataFrame(rows, "conv_id long, turn int, text string").write.parquet(f"file://{tmp_path}/conversations.parquet")
    df = QUERIES["load_records"](spark, f"file://{tmp_path}")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    want = con.execute(f"SELECT {', '.join(df.columns)} FROM ({SQL['load_records']})").fetchall()
    assert sorted(map(tuple, df.collect()), key=str) == sorted(want, key=str)
