"""Streamed event windows: late rows, restarts from the checkpoint, repeated
batches; compared with the batch form of the same definition."""

from __future__ import annotations

import datetime as dt
import random
import uuid

import pytest
from pyspark.sql import functions as F

from cartwheel.plans.parts import PartTable
from cartwheel.streaming.events import EVENTS, append_files, arriving, upsert_windows, windowed

T0 = dt.datetime(2024, 5, 1)


def events(n, first=0, seed=1, hours=30):
    rnd = random.Random(seed)
    return [(first + i, T0 + dt.timedelta(seconds=rnd.randrange(hours * 3600)), rnd.randrange(5), rnd.choice(["view", "click", None]),
             rnd.choice([None, 0.1, 0.2, 12.35]), "{}") for i in range(n)]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def land(spark, folder, rows):
    spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("append").parquet(folder)


@pytest.fixture
def places(tmp_path):
    return f"{tmp_path}/landing", f"{tmp_path}/sink", f"{tmp_path}/checkpoint"


def test_appended_windows_are_complete_and_once(spark, places):
    folder, sink, checkpoint = places
    rows = sorted(events(300), key=lambda r: r[1])
    parts = [rows[:100], rows[100:200], rows[200:]]
    late = [r for r in parts[0][-20:]]  # arrive with the second delivery, within the watermark
    parts[0], parts[1] = parts[0][:-20], parts[1] + late
    end = [(10_000, T0 + dt.timedelta(days=30), 0, "end", 0.0, "{}")]  # closes all windows before
    for part in (*parts, end):  # a new query each time: restarts from the checkpoint
        land(spark, folder, part)
        append_files(windowed(arriving(spark, folder), watermark="12 hours"), sink, checkpoint)
    append_files(windowed(arriving(spark, folder), watermark="12 hours"), sink, checkpoint)  # nothing new
    got = rows_of(spark.read.parquet(sink))
    assert got == rows_of(windowed(spark.createDataFrame(rows, EVENTS)))


def test_rows_beyond_the_watermark_are_dropped(spark, places):
    folder, sink, checkpoint = places
    ahead, late = (1, T0 + dt.timedelta(hours=10), 1, "view", 1.0, "{}"), (2, T0, 1, "view", 1.0, "{}")
    for part in ([ahead], [late, (3, T0 + dt.timedelta(hours=11), 1, "view", 1.0, "{}")], [(4, T0 + dt.timedelta(days=9), 1, "x", 1.0, "{}")]):
        land(spark, folder, part)
        append_files(windowed(arriving(spark, folder), watermark="2 hours"), sink, checkpoint)
    assert [r.window_start for r in spark.read.parquet(sink).orderBy("window_start").collect()] == [ahead[1], T0 + dt.timedelta(hours=11)]


def test_upserted_windows_with_restarts_and_repeated_batches(spark, places):
    folder, _, checkpoint = places
    table = f"stream_tests.t{uuid.uuid4().hex[:8]}"
    rows = events(240, seed=4)
    for at in range(0, 240, 80):
        land(spark, folder, rows[at:at + 80])
        upsert_windows(windowed(arriving(spark, folder), watermark="40 hours"), table, checkpoint, buckets=4)
    want = rows_of(windowed(spark.createDataFrame(rows, EVENTS)))
    assert rows_of(PartTable(spark, table).read()) == want
    # the batches once more, as after a crash between sink and checkpoint
    upsert_windows(windowed(arriving(spark, folder, max_files=1), watermark="40 hours"), table, f"{checkpoint}-again", buckets=4)
    assert rows_of(PartTable(spark, table).read()) == want


def test_batch_form_of_odd_rows(spark):
    rows = [(1, None, 1, "view", 1.0, "{}"), (2, T0, 1, None, None, None), (3, T0, 1, None, 0.1, None), (4, T0, 1, None, 0.2, None)]
    got = rows_of(windowed(spark.createDataFrame(rows, EVENTS)).withColumn("total_value", F.col("total_value").cast("string")))
    assert got == [(T0, None, 3, "0.30")]
    assert rows_of(windowed(spark.createDataFrame([], EVENTS))) == []
