"""Calls to models: how many run at once, what is tried again, order, rate, and the table of answers."""

import threading
import time

import pyarrow as pa
import pytest

from lamina.operators import enrich, models
from lamina.operators.calls import ONE_BY_ONE, Asker, Calls, Transient, answers, cached_call, call_model


def ask(factory, calls, prompts, size=7):
    batches = [prompts[i : i + size] for i in range(0, len(prompts), size)]
    made = ((pa.RecordBatch.from_pydict({"p": b}), b) for b in batches)
    return [r for _, results in Asker(factory, calls).batches(made) for r in results]


def test_bounded_and_in_order():
    """So many in flight at once as allowed, never more; answers in the order of prompts, whatever order they come in."""
    lock, now, most, made = threading.Lock(), [0], [0], []

    def factory():
        made.append(threading.get_ident())

        def model(p):
            with lock:
                now[0] += 1
                most[0] = max(most[0], now[0])
            time.sleep(0.002 * (int(p) % 5))
            with lock:
                now[0] -= 1
            return f"a{p}"

        return model

    prompts = [str(i) if i % 9 else None for i in range(100)]
    assert ask(factory, Calls(concurrency=6), prompts) == [(f"a{p}", None) if p else (None, None) for p in prompts]
    assert most[0] == 6 and len(made) == len(set(made)) <= 6  # a model for each thread


def test_retries_with_growing_waits(monkeypatch):
    waits, tries = [], {}
    monkeypatch.setattr(time, "sleep", lambda s: waits.append(s))

    def model(p):
        tries[p] = tries.get(p, 0) + 1
        if p == "late" and tries[p] < 3:
            raise Transient("busy")
        if p == "never":
            raise TimeoutError("slow")
        if p == "wrong":
            raise ValueError("no")
        return p

    got = ask(lambda: model, Calls(concurrency=1, retries=2, wait=1.0, longest=1.5), ["late", "never", "wrong", "ok"])
    assert got == [("late", None), (None, "TimeoutError: slow"), (None, "ValueError: no"), ("ok", None)]
    assert tries == {"late": 3, "never": 3, "wrong": 1, "ok": 1}
    assert len(waits) == 4 and all(0.5 <= w <= 1.5 for w in waits[::2]) and all(0.75 <= w <= 2.25 for w in waits[1::2])


def test_rate():
    t = time.monotonic()
    ask(lambda: lambda p: p, Calls(concurrency=8, per_second=50), [str(i) for i in range(20)])
    assert time.monotonic() - t >= 19 / 50


def test_rules_are_checked():
    for bad in ({"concurrency": 0}, {"retries": -1}, {"per_second": 0}):
        with pytest.raises(ValueError):
            Calls(**bad)


def test_call_model_keeps_rows(spark):
    df = spark.createDataFrame([(i, None if i % 4 == 0 else f"p{i}", [i], {"k": i}) for i in range(50)], "id long, prompt string, a array<long>, m map<string,long>")
    got = call_model(df, "prompt", lambda: lambda p: 1 / 0 if p == "p7" else p.upper(), calls=Calls(concurrency=3)).collect()
    assert [r.id for r in got] == list(range(50))
    for r in got:
        assert (r.answer, r.error) == ((None, None) if r.prompt is None else (None, "ZeroDivisionError: division by zero") if r.id == 7 else (r.prompt.upper(), None))
        assert r.a == [r.id] and r.m == {"k": r.id}


def counted(spark):
    seen = spark.sparkContext.accumulator(0)

    def factory():
        def model(p):
            seen.add(1)
            if p == "bad":
                raise ValueError("no")
            return p[::-1]

        return model

    return seen, factory


def test_answers_are_kept(spark, tmp_path):
    """Equal prompts once; a rerun asks only what failed or is new; another model asks anew."""
    cache = f"file://{tmp_path}/answers"
    seen, factory = counted(spark)
    df = spark.createDataFrame([(i, [None, "abc", "abc", "bad", "x" * 100_000][i % 5]) for i in range(50)], "id long, prompt string")
    first = cached_call(df, "prompt", factory, cache, "m")
    want = {None: (None, None), "abc": ("cba", None), "bad": (None, "ValueError: no"), "x" * 100_000: ("x" * 100_000, None)}
    for _ in range(2):  # computing the result again asks nothing
        assert {r.id: (r.answer, r.error) for r in first.collect()} == {i: want[p] for i, p in df.collect()}
    assert seen.value == 3
    more = df.unionByName(spark.createDataFrame([(99, "new")], df.schema))
    again = {r.id: (r.answer, r.error) for r in cached_call(more, "prompt", factory, cache, "m").collect()}
    assert again[99] == ("wen", None) and again[1] == ("cba", None) and again[3] == want["bad"] and len(again) == 51
    assert seen.value == 5  # "bad" and "new"
    cached_call(df.filter("prompt = 'abc'"), "prompt", factory, cache, "other").collect()
    assert seen.value == 6 and answers(spark, cache).count() == 6
    assert cached_call(df.limit(0), "prompt", factory, cache, "m").collect() == []


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_nothing_is_asked_twice(spark, tmp_path):
    """One call of the model in each plan; payloads are parsed once, chunks scanned once."""
    spark.createDataFrame([(i, "Some text that is long enough to be shown to a model. " * 3, "semantic_text") for i in range(20)], "chunk_id long, text string, chunk_type string").write.parquet(f"file://{tmp_path}/c")
    chunks = spark.read.parquet(f"file://{tmp_path}/c")
    seen, factory = counted(spark)
    rich = plan(enrich.enrich(chunks, factory, ONE_BY_ONE))
    assert rich.count("from_json") == 1 and rich.count("MapInArrow") == 1 and rich.count("Relation [") == 1
    assert plan(models.label(chunks.withColumnRenamed("chunk_id", "doc_id"), factory)).count("MapInArrow") == 1
    assert plan(models.repair_with_model(chunks, "text", factory)).count("MapInArrow") == 1
    good, bad = enrich.quarantine_split(enrich.enrich(chunks, factory, ONE_BY_ONE), f"file://{tmp_path}/store")
    assert good.count() == 0 and bad.count() == 20 and bad.count() == 20
    assert seen.value == 20
