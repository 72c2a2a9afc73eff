"""Rows that wait for late parents: the stream, with a restart in the middle, gives what the batch form gives."""

import random
from datetime import datetime, timedelta

from caseloom.operators import merge
from caseloom.streaming import incremental

SCHEMA = "record long, key long, ts timestamp, is_parent boolean"


def test_stream_equals_batch(spark, tmp_path):
    r, start = random.Random(9), datetime(2024, 1, 1)
    children = [(i, r.randrange(12), start + timedelta(minutes=r.randrange(600)), False) for i in range(40)]
    parents = [(-1, k, start + timedelta(minutes=r.randrange(900)), True) for k in range(9)] + [(-1, 0, start + timedelta(minutes=899), True)]
    rows = sorted(children + parents, key=lambda x: x[2])
    parts = [rows[:20], rows[20:35], rows[35:], [(-1, 99, start + timedelta(days=d), True) for d in (9,)]]  # the last moves the watermark
    found, provider = [], "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    spark.conf.set(provider, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        for n, part in enumerate(parts):  # each part arrives, is processed, and the query stops: a restart between all of them
            spark.createDataFrame(part, SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/in/{n}")
            stream = incremental.file_stream(spark, f"{tmp_path}/in/*", SCHEMA)
            out = incremental.retry_stream(stream, 3600, 5, "10 seconds")
            query = out.writeStream.outputMode("update").foreachBatch(lambda df, _: found.extend(map(tuple, df.collect()))).option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start()
            query.awaitTermination()
    finally:
        spark.conf.set(provider, before)
    a, b = (spark.createDataFrame(x, SCHEMA) for x in (children, parents))
    expected = sorted(map(tuple, merge.retried(a, b, "record", "key", "ts", 3600).collect()))
    assert sorted(found) == expected and {x[3] for x in expected} == {"resolved", "given_up"}


def test_rows_without_key_or_time(spark):
    rows = spark.createDataFrame([(1, None, datetime(2024, 1, 1), False), (2, 5, None, False), (3, 5, datetime(2024, 1, 1), False)], SCHEMA)
    parents = spark.createDataFrame([(-1, 5, datetime(2024, 1, 1), True), (-1, None, datetime(2023, 1, 1), True)], SCHEMA)
    assert {tuple(x) for x in merge.retried(rows, parents, "record", "key", "ts", 60).collect()} == {(1, None, 0, "given_up"), (2, 5, 0, "given_up"), (3, 5, 0, "resolved")}
