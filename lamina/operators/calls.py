"""Calls to models from inside tasks: bounded concurrency, retries, a rate limit, order kept; and a table of answers, so that equal prompts are asked once and reruns ask nothing."""

from __future__ import annotations

import asyncio
import threading
import time
import uuid
import zlib
from collections import deque
from collections.abc import Awaitable, Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A model is made by its factory, once in each thread that calls it, and answers a text or raises. It sets its own time limits.
Factory = Callable[[], Callable[[str], str]]
#: What side_by_side() gives to run a function in a thread of its own.
Call = Callable[..., Awaitable]


class Transient(Exception):
    """What a model raises when a later try may succeed (busy, rate exceeded); connection errors and timeouts count as such too."""


RETRIED = (Transient, ConnectionError, TimeoutError)


@dataclass(frozen=True)
class Calls:
    """How a task calls: so many calls in flight at once, so many further tries after a transient error, with waits that double from `wait` seconds to
    `longest`, and at most per_second calls started a second. All are for one task: a limit of the whole service is to be divided by the tasks that run at once."""

    concurrency: int = 10
    retries: int = 2
    wait: float = 0.5
    longest: float = 30.0
    per_second: float | None = None

    def __post_init__(self):
        if self.concurrency < 1 or self.retries < 0 or self.wait < 0 or (self.per_second is not None and self.per_second <= 0):
            raise ValueError("concurrency >= 1, retries >= 0, wait >= 0 and per_second > 0 are needed")


#: For models that compute: threads wouldn't speed them up.
ONE_BY_ONE = Calls(concurrency=1, retries=0)


class Asker:
    """Asks a model by the rules of Calls; one for each task."""

    def __init__(self, factory: Factory, calls: Calls):
        self.factory, self.calls = factory, calls
        self.own = threading.local()
        self.lock, self.free_at = threading.Lock(), 0.0

    def _slot(self) -> None:
        if self.calls.per_second is None:
            return
        with self.lock:
            at = max(time.monotonic(), self.free_at)
            self.free_at = at + 1 / self.calls.per_second
        time.sleep(max(0.0, at - time.monotonic()))

    def _pause(self, prompt: str, attempt: int) -> float:
        spread = 0.5 + zlib.crc32(f"{attempt}{prompt}".encode(errors="replace")) / 2**32  # so that many don't come back at once
        return min(self.calls.longest, self.calls.wait * 2**attempt) * spread

    def _try(self, prompt: str) -> tuple[str | None, str | None, bool]:
        """(answer, error, whether a later try may succeed) of one call."""
        self._slot()
        try:
            if not hasattr(self.own, "model"):
                self.own.model = self.factory()
            return self.own.model(prompt), None, False
        except Exception as e:  # noqa: BLE001  errors are data here
            return None, f"{type(e).__name__}: {e}", isinstance(e, RETRIED)

    def one(self, prompt: str | None) -> tuple[str | None, str | None]:
        """(answer, error): one of them null; both for a null prompt, which isn't asked."""
        if prompt is None:
            return None, None
        attempt = 0
        while True:
            answer, error, again = self._try(prompt)
            if not again or attempt >= self.calls.retries:
                return answer, error
            time.sleep(self._pause(prompt, attempt))
            attempt += 1

    async def later(self, prompt: str | None, call: Call) -> tuple[str | None, str | None]:
        """As one(), by `call` of side_by_side(): what waits for its next try holds no thread."""
        if prompt is None:
            return None, None
        attempt = 0
        while True:
            answer, error, again = await call(self._try, prompt)
            if not again or attempt >= self.calls.retries:
                return answer, error
            await asyncio.sleep(self._pause(prompt, attempt))
            attempt += 1

    def batches(self, batches: Iterable[tuple[pa.RecordBatch, list]]) -> Iterator[tuple[pa.RecordBatch, list]]:
        """Each batch with the answers to its prompts, in order, as side_by_side() has it."""
        if self.calls.concurrency == 1:
            for b, prompts in batches:
                yield b, [self.one(p) for p in prompts]
            return
        yield from side_by_side(batches, self.later, self.calls.concurrency)


def side_by_side(batches: Iterable[tuple[pa.RecordBatch, list]], work: Callable[[object, Call], Awaitable], concurrency: int) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Each batch with the results of work(item, call) for its items, in order. `await call(f, ...)` runs f in one of `concurrency` threads.

    Items of a batch are worked on side by side, and those that wait for a later try hold no thread: a batch with many such items takes as long as
    one's waits, not their sum. While a batch's last calls run, those of the next are started; no more than two batches are held.
    """
    loop, pool, waiting = asyncio.new_event_loop(), ThreadPoolExecutor(concurrency), deque()

    def call(f, *args):
        return loop.run_in_executor(pool, f, *args)

    async def whole(items: list) -> list:
        return await asyncio.gather(*(work(x, call) for x in items))

    try:
        for b, items in batches:
            waiting.append((b, loop.create_task(whole(items))))
            if len(waiting) > 1:
                first, task = waiting.popleft()
                yield first, loop.run_until_complete(task)
        while waiting:
            first, task = waiting.popleft()
            yield first, loop.run_until_complete(task)
    finally:
        pool.shutdown(wait=True, cancel_futures=True)
        if left := asyncio.all_tasks(loop):  # of a reader that stops early
            for task in left:
                task.cancel()
            loop.run_until_complete(asyncio.wait(left))
        loop.close()


def call_model(df: DataFrame, prompt: str, factory: Factory, answer: str = "answer", error: str = "error", calls: Calls | None = None) -> DataFrame:
    """Adds the model's answer and the error text, one of them null. Rows with a null prompt pass unasked, with neither. A failing row never fails the task; the order of rows stays."""
    calls, at = calls or Calls(), df.columns.index(prompt)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asker = Asker(factory, calls)
        for b, results in asker.batches((b, b.column(at).to_pylist()) for b in batches):
            both = [pa.array([None if r[i] is None else str(r[i]) for r in results], pa.string()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*b.columns, *both], [*b.schema.names, answer, error])

    return df.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + f", `{answer}` string, `{error}` string")


ANSWERS = "key binary, answer string, error string, run string"


def answers(spark: SparkSession, cache: str) -> DataFrame:
    """The table of answers (key, answer, error, run); empty where there is none yet."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(cache)
    there = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
    return spark.read.schema(ANSWERS).parquet(cache) if there else spark.createDataFrame([], ANSWERS)


def cached_call(df: DataFrame, prompt: str, factory: Factory, cache: str, model: str, answer: str = "answer", error: str = "error", calls: Calls | None = None) -> DataFrame:
    """call_model() through a table of answers: every different prompt that has no answer there is asked once, and its answer is added before this returns.

    model: its name and settings, which are part of the key (SHA-256), so another model's answers don't count. Errors are noted, but asked again by the next run. A run that dies leaves
    the answers of its finished tasks or none; two runs at once may ask the same prompt twice, and either answer is used. The returned rows read
    the table and ask nothing, however often they are computed. A prompt that most rows share is one row here, and its join is split by Spark at run time.
    """
    spark, run = df.sparkSession, uuid.uuid4().hex
    key = F.unhex(F.sha2(F.concat_ws("\u0000", F.lit(model), F.col(prompt)), 256))
    keyed = df.withColumn("__key", F.when(F.col(prompt).isNotNull(), key))
    wanted = keyed.filter("__key is not null").groupBy("__key").agg(F.min(prompt).alias("prompt"))
    known = answers(spark, cache).filter("answer is not null").select(F.col("key").alias("__key"))
    asked = call_model(wanted.join(known, "__key", "left_anti"), "prompt", factory, "answer", "error", calls)
    asked.select(F.col("__key").alias("key"), "answer", "error", F.lit(run).alias("run")).write.mode("append").parquet(cache)
    mine = answers(spark, cache).filter((F.col("answer").isNotNull()) | (F.col("run") == run))
    found = mine.groupBy(F.col("key").alias("__key")).agg(F.min("answer").alias("__answer"), F.min("error").alias("__error"))
    out = keyed.join(found, "__key", "left")
    return out.select(*df.columns, F.col("__answer").alias(answer), F.when(F.col("__answer").isNull(), F.col("__error")).alias(error))
