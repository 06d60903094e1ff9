"""Streams with state: sessions and late rows, changes by key, restarts after a failure."""

from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lamina.operators.vectors import upsert
from lamina.sources import sinks
from lamina.streaming import incremental, keyed

T0 = datetime(2024, 1, 1)


def put(spark, rows, path, schema="user long, ts timestamp, v double"):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(path)


def at(minutes):
    return T0 + timedelta(minutes=minutes)


def test_sessions_over_runs_and_late_rows(spark, tmp_path):
    """A session goes on over runs; it comes out once, when the watermark has passed its end; rows that come too late are dropped and counted."""
    src, out, ck = (f"file://{tmp_path}/{x}" for x in ("in", "out", "ck"))

    def run():
        s = incremental.stream_table(spark, f"{src}/*", "user long, ts timestamp, v double")
        q = keyed.append_stream(keyed.sessions(s, "ts", ["user"], "10 minutes", "5 minutes", total=F.sum("v")), out, ck)
        q.awaitTermination()
        return sum(op.get("numRowsDroppedByWatermark", 0) for p in q.recentProgress for op in p["stateOperators"])

    def rows():
        return sorted((r.user, r.start, r.end, r.n, r.total) for r in spark.read.parquet(out).collect()) if list(Path(tmp_path, "out").glob("part-*")) else []

    put(spark, [(1, at(0), 1.0), (1, at(5), 2.0), (2, at(1), 4.0)], f"{src}/a")
    assert run() == 0 and rows() == []
    put(spark, [(1, at(14), 3.0), (2, at(12), 5.0)], f"{src}/b")  # 1's session grows; 2's gap is over 10 minutes: a new session
    run()
    put(spark, [(3, at(60), 0.0)], f"{src}/c")
    run()
    want = [(1, at(0), at(24), 3, 6.0), (2, at(1), at(11), 1, 4.0), (2, at(12), at(22), 1, 5.0)]
    assert rows() == want
    put(spark, [(1, at(15), 9.0), (4, at(58), 1.0)], f"{src}/d")  # the first is too late, the second isn't
    assert run() == 1
    put(spark, [(5, at(200), 0.0)], f"{src}/e")
    run()
    # 3's and 4's sessions are each their own
    assert rows() == sorted([*want, (3, at(60), at(70), 1, 0.0), (4, at(58), at(68), 1, 1.0)])


def test_session_gap_of_each_key(spark, tmp_path):
    src = f"file://{tmp_path}/in"
    put(spark, [(1, at(0), 1.0), (1, at(8), 1.0), (2, at(0), 1.0), (2, at(8), 1.0), (9, at(999), 1.0), (9, None, 1.0)], f"{src}/a")
    s = incremental.stream_table(spark, f"{src}/*", "user long, ts timestamp, v double")
    gap = F.expr("CASE WHEN user = 1 THEN '5 minutes' ELSE '20 minutes' END")
    keyed.append_stream(keyed.sessions(s, "ts", ["user"], gap, "1 minute"), f"file://{tmp_path}/out", f"file://{tmp_path}/ck").awaitTermination()
    assert sorted((r.user, r.n) for r in spark.read.parquet(f"file://{tmp_path}/out").collect()) == [(1, 1), (1, 1), (2, 2)]


SCHEMA = "namespace string, id long, version int, text string"


def delivered(spark, tmp_path, name, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"file://{tmp_path}/in/{name}")


def run_upserts(spark, tmp_path, seen=None):
    s = keyed.changes(incremental.stream_table(spark, f"file://{tmp_path}/in/*", SCHEMA), ["namespace", "id"])

    def watch(batch):
        if seen is not None:
            seen.extend(sorted((r.id, r.version, r.text) for r in batch.collect()))
        return batch

    keyed.upsert_stream(s, f"file://{tmp_path}/v", ["namespace", "id"], f"file://{tmp_path}/ck", watch).awaitTermination()
    return sorted((r.namespace, r.id, r.version, r.text) for r in sinks.read_table(spark, f"file://{tmp_path}/v").select("namespace", "id", "version", "text").collect())


def test_changes_and_upserts(spark, tmp_path):
    seen = []
    delivered(spark, tmp_path, "a", [("n", 1, 1, "x"), ("n", 2, 1, "x"), ("m", 1, 5, "y"), ("m", 1, 6, "z"), ("n", 3, None, None)])
    assert run_upserts(spark, tmp_path, seen) == [("m", 1, 6, "z"), ("n", 1, 1, "x"), ("n", 2, 1, "x"), ("n", 3, None, None)]
    seen.clear()
    # equal content in a newer version is no change; an older version is stale; content that comes back is a change
    delivered(spark, tmp_path, "b", [("n", 1, 2, "x"), ("n", 2, 2, "w"), ("m", 1, 3, "old"), ("n", 3, 0, "now")])
    assert run_upserts(spark, tmp_path, seen) == [("m", 1, 6, "z"), ("n", 1, 1, "x"), ("n", 2, 2, "w"), ("n", 3, 0, "now")]
    assert seen == [(2, 2, "w"), (3, 0, "now")]
    seen.clear()
    delivered(spark, tmp_path, "c", [("n", 2, 3, "x"), ("n", 1, 1, "never")])
    assert run_upserts(spark, tmp_path, seen)[2] == ("n", 2, 3, "x") and seen == [(2, 3, "x")]
    assert run_upserts(spark, tmp_path, seen) and seen == [(2, 3, "x")]  # nothing new


def test_killed_and_restarted(spark, tmp_path):
    """Killed after the upsert and before its batch was noted: the batch is done again and the table is equal."""
    delivered(spark, tmp_path, "a", [("n", i, 1, f"t{i}") for i in range(20)])
    run_upserts(spark, tmp_path)
    delivered(spark, tmp_path, "b", [("n", i, 2, f"u{i}") for i in range(5, 25)])
    want = run_upserts(spark, tmp_path)
    last = max(Path(tmp_path, "ck", "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    last.unlink()
    for p in Path(tmp_path, "ck", "commits").glob(f".{last.name}*"):
        p.unlink()
    seen = []
    assert run_upserts(spark, tmp_path, seen) == want and len(seen) == 20


@pytest.mark.parametrize("order", [1, -1])
def test_upsert_has_a_total_order(spark, order):
    rows = [("n", 1, 1, "a"), ("n", 1, 1, "b"), ("n", 1, 1, "c")][::order]
    df = spark.createDataFrame(rows, SCHEMA)
    assert [r.text for r in upsert(df.limit(0), df, ["namespace", "id"]).collect()] == [upsert(df.limit(0), df.orderBy("text"), ["namespace", "id"]).first().text]
