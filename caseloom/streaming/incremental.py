"""Streams: files that arrive become table changes, with the batch operators inside each micro-batch."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from ..operators.merge import last_of_key, merge


def file_stream(spark: SparkSession, path: str, schema, glob: str | None = None, files_per_batch: int = 64) -> DataFrame:
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    return (reader.option("pathGlobFilter", glob) if glob else reader).parquet(path)


def windowed_counts(events: DataFrame, ts: str, keys: list[str], value: str, late: str = "1 hour", length: str = "1 day") -> DataFrame:
    """Counts and sums per window and key; what is later than `late` is left out once its window has closed."""
    w = F.window(ts, length)
    return events.withWatermark(ts, late).groupBy(w, *keys).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total")).select(F.col("window.start").alias("window_start"), *keys, "n", "total")


def first_seen(events: DataFrame, ts: str, keys: list[str], late: str = "1 hour") -> DataFrame:
    """Each key once within the watermark, however often it is delivered."""
    return events.withWatermark(ts, late).dropDuplicatesWithinWatermark(keys)


def upsert_into(read: Callable[[], DataFrame], write: Callable[[DataFrame, int], None], keys: list[str], values: list[str], order: str):
    """A foreachBatch function: the last row of each key is merged into a table. `write` gets the merged rows and the
    batch number, so that a repeated batch can overwrite its own result."""

    def apply(batch: DataFrame, number: int) -> None:
        new = last_of_key(batch, keys, F.struct(order, *values))
        write(merge(read(), new, keys, values).drop("action"), number)

    return apply


def run_available(df: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None]) -> None:
    """Process what has arrived, then stop."""
    df.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


class _Retry(StatefulProcessor):
    """Per key: when its parent came, and the rows that wait for it, each with the time and the number of its next look."""

    def __init__(self, every_ms: int, most: int):
        self.every_ms, self.most = every_ms, most

    def init(self, handle) -> None:
        self.handle = handle
        self.came = handle.getValueState("came", "ms long")
        self.waiting = handle.getListState("waiting", "record long, ms long, attempts int")

    def handleInputRows(self, key, rows, timerValues):  # noqa: N802, N803  Spark's names
        came = self.came.get()[0] if self.came.exists() else None
        for pdf in rows:
            for r in pdf.itertuples():
                if r.is_parent:
                    came = r.ms if came is None else min(came, r.ms)
                else:
                    self.waiting.appendValue((int(r.record), int(r.ms), 0))
                    self.handle.registerTimer(int(r.ms))
        if came is not None:
            self.came.update((int(came),))
        yield pd.DataFrame({"record": [], "key": [], "attempts": [], "state": []}).astype({"record": "i8", "key": "i8", "attempts": "i4", "state": "object"})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):  # noqa: N802, N803  Spark's names
        # all that the watermark has passed is known, so every look up to it can be taken now
        now = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        came = self.came.get()[0] if self.came.exists() else None
        rest, out = [], []
        for record, ms, attempts in self.waiting.get() if self.waiting.exists() else ():
            while ms <= now and attempts < self.most and (came is None or came > ms):
                ms, attempts = ms + self.every_ms, attempts + 1
            if ms > now:
                rest.append((record, ms, attempts))
                self.handle.registerTimer(ms)
            else:
                out.append((record, key[0], attempts, "resolved" if came is not None and came <= ms else "given_up"))
        if rest:
            self.waiting.put(rest)
        else:
            self.waiting.clear()
        yield pd.DataFrame(out, columns=["record", "key", "attempts", "state"]).astype({"record": "i8", "key": "i8", "attempts": "i4", "state": "object"})

    def close(self) -> None:
        pass


def retry_stream(arrivals: DataFrame, every_seconds: int, most: int = 5, late: str = "1 hour") -> DataFrame:
    """record, key, attempts, state of a stream of parents and rows that need them (record, key: long, ts: timestamp, is_parent):
    each row is looked at when the watermark passes its time, then every so many seconds, `most` times at most, until its
    parent's time has come; `operators.merge.retried` is the same over whole tables. What waits lives in the state store (RocksDB), so a
    restart goes on where it was."""
    rows = arrivals.where("key IS NOT NULL AND ts IS NOT NULL").withColumn("ms", (F.unix_micros(F.col("ts")) / 1000).cast("long"))
    keyed = rows.withWatermark("ts", late).groupBy("key")
    return keyed.transformWithStateInPandas(_Retry(every_seconds * 1000, most), "record long, key long, attempts int, state string", "Update", "EventTime")
