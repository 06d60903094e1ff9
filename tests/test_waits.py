"""Waits for later tries: they hold no thread, so many of them take as long as one."""

import json
import threading
import time

from lamina.operators import vectors
from lamina.operators.calls import Asker, Calls, Transient
from tests.test_calls import ask


def test_waiting_prompts_hold_no_thread():
    lock, now, most, tries = threading.Lock(), [0], [0], {}

    def model(p):
        with lock:
            now[0] += 1
            most[0] = max(most[0], now[0])
            tries[p] = tries.get(p, 0) + 1
        time.sleep(0.001)
        with lock:
            now[0] -= 1
        if int(p) % 2 == 0 and tries[p] < 3:
            raise Transient("busy")
        if int(p) % 2:
            raise TimeoutError("slow")
        return p

    t = time.monotonic()
    got = ask(lambda: model, Calls(concurrency=4, retries=2, wait=0.2), [str(i) for i in range(200)], size=100)
    # one after another in 4 threads the waits alone are 200 * 0.6 / 4 = 30 seconds
    assert time.monotonic() - t < 8
    assert got == [(str(i), None) if i % 2 == 0 else (None, "TimeoutError: slow") for i in range(200)]
    assert set(tries.values()) == {3} and most[0] <= 4


def test_chunks_wait_side_by_side(spark):
    def summarizer():
        def answer(prompt):
            if "busy" in prompt:
                raise TimeoutError("busy")
            return json.dumps({"clinical_summary": "c", "economic_summary": " "})

        return answer

    rows = [(f"c{i}", "d", ["s"], "p", "busy" if i % 2 else "free") for i in range(400)]
    df = spark.createDataFrame(rows, "chunk_id string, doc_id string, section_path array<string>, purpose string, text string").coalesce(1)
    made = vectors.vector_payload(df, lambda: lambda t: [len(t)], summarizer, Calls(concurrency=2, retries=2, wait=0.2))
    t = time.monotonic()
    got = sorted(r.id for r in made.collect())
    assert time.monotonic() - t < 20  # one after another in 2 threads: 200 * 0.6 / 2 = 60
    assert got == sorted([f"c{i}::base" for i in range(400)] + [f"c{i}::clinical" for i in range(0, 400, 2)])


def test_left_early():
    """A reader that stops leaves no thread behind."""
    before = threading.active_count()
    made = Asker(lambda: lambda p: p, Calls(concurrency=3)).batches((None, [str(i)] * 50) for i in range(10))
    assert next(made)[1] == [("0", None)] * 50
    made.close()
    assert threading.active_count() == before
