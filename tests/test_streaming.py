"""The row-wise feature steps give the same rows on a stream as in batch."""

from __future__ import annotations

import os
import shutil

from delaylab.sources.flights import read_flights
from delaylab.streaming import row_features, start_feature_stream


def test_stream_equals_batch(spark, scratch, flights_csv):
    src = os.path.join(scratch, "stream-src")
    os.makedirs(src, exist_ok=True)
    shutil.copy(flights_csv, os.path.join(src, "part-0.csv"))
    sink = os.path.join(scratch, "stream-sink")
    q = start_feature_stream(spark, src, sink, os.path.join(scratch, "stream-ckpt"))
    q.awaitTermination(120)
    streamed = spark.read.parquet(sink)
    batch = row_features(read_flights(spark, flights_csv))
    assert streamed.count() == batch.count() > 0
    assert streamed.select(*batch.columns).exceptAll(batch).count() == 0


def test_restart_with_the_same_checkpoint_reads_only_new_files(spark, scratch, flights_csv):
    src, sink, ckpt = (os.path.join(scratch, f"restart-{n}") for n in ("src", "sink", "ckpt"))
    os.makedirs(src, exist_ok=True)
    batch = row_features(read_flights(spark, flights_csv)).count()
    for i in range(2):
        shutil.copy(flights_csv, os.path.join(src, f"part-{i}.csv"))
        start_feature_stream(spark, src, sink, ckpt).awaitTermination(120)
        assert spark.read.parquet(sink).count() == (i + 1) * batch
