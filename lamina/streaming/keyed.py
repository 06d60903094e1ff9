"""Streams with state by key: sessions, and changes of keyed rows that are upserted into a vector table."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..sources import sinks


def sessions(stream: DataFrame, time: str, keys: list[str], gap: str | Column, delay: str, **measures: Column) -> DataFrame:
    """(keys, start, end, n, measures): runs of a key's rows with at most `gap` between neighbours, end being the last row's time plus the gap.

    A session is final, and put out, when the watermark (the latest time seen less `delay`) has reached its end; state holds open sessions only. Rows older than the
    watermark that would open or extend a closed session are left out; Spark counts them as dropped by the watermark. gap may be a column, so that keys can have their own.
    """
    s = stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)
    g = s.groupBy(*keys, F.session_window(time, gap).alias("w")).agg(F.count("*").alias("n"), *[c.alias(k) for k, c in measures.items()])
    return g.select(*keys, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n", *measures)


def changes(stream: DataFrame, keys: list[str], version: str = "version", ignore: tuple[str, ...] = ()) -> DataFrame:
    """Rows that change what their key holds: newer than the last accepted version and of another content. Of several in a batch the newest, ties by the greater content digest.

    State by key: the last accepted version and a digest of the other columns (but `ignore`), so that content that comes back after a change counts as a change, which dropping
    repeats would miss. Rows without a version are older than all others. State grows with the keys, by some bytes each, in the checkpoint.
    """
    content = [c for c in stream.columns if c not in (*keys, version, *ignore)]
    whole = F.to_json(F.struct(*[F.col(c) for c in content]), {"ignoreNullFields": "false"})
    rows = stream.withColumn("__digest", F.sha2(whole, 256)).withColumn("__version", F.coalesce(F.col(version).cast("long"), F.lit(-(2**63))))
    names = [f.name for f in stream.schema]

    def newest(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = state.get if state.exists else None
        best, top = None, held  # version and digest of the row to beat
        for f in frames:
            for at, mark in enumerate(zip(f["__version"].tolist(), f["__digest"].tolist(), strict=True)):
                # what is held is beaten by newer versions only, a row of this batch by greater digests too
                if top is None or (mark > top if best is not None else mark[0] > top[0]):
                    best, top = f.iloc[[at]], mark
        if best is not None:
            state.update(top)
            if held is None or top[1] != held[1]:
                yield best[names]

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stream.schema)
    return rows.groupBy(*keys).applyInPandasWithState(newest, schema, "version long, digest string", "append", GroupStateTimeout.NoTimeout)


def upsert_stream(stream: DataFrame, path: str, keys: list[str], checkpoint: str, transform: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Upsert what is new in a stream into a vector table, batch by batch, and end. A batch that is repeated after a failure has the same rows and leaves the same table."""
    def write(batch: DataFrame, number: int) -> None:
        rows = (transform(batch) if transform else batch).persist()
        try:
            if not rows.isEmpty():
                sinks.write_upsert(rows, path, keys)
        finally:
            rows.unpersist()

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def append_stream(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """All that is final now as Parquet files; each row once, also over restarts."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
