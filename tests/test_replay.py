"""Replays of many batches: watermarks across restarts, redelivered ticks, bars closed by the clock."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from ticksmith.schemas import BAR
from ticksmith.streaming import replay
from ticksmith.streaming.jobs import bar_stream

from .conftest import rows

TICKS = "ticker string, price double, seq long, fetched_at string, arrival_ts timestamp"
CLOCK = "timestamp timestamp"
DAY = dt.datetime(2026, 4, 21)


def ticks(spark, *given):
    """(price, seq, minute of the stamp or None, minute of arrival)."""
    made = [("A", float(p), s, "junk" if m is None else (DAY + dt.timedelta(minutes=m)).isoformat() + "+00:00",
             (DAY + dt.timedelta(minutes=a)).isoformat()) for p, s, m, a in given]
    return (spark.createDataFrame(made, TICKS.replace("arrival_ts timestamp", "a string"))
            .withColumn("arrival_ts", F.concat("a", F.lit("Z")).cast("timestamp")).drop("a"))


BATCHES = [
    [(1, 1, 0, 0), (2, 2, 30, 30), (9, 3, 80, 30)],              # 3 is 50 minutes ahead
    [(3, 4, 2, 31), (4, 5, 21, 32), (5, 6, None, 33)],           # watermark 20: 4 is late, 5 is not
    [],                                                          # nothing arrives
    [(6, 7, 22, 60), (7, 8, 60, 60)],                            # still 20
    [(8, 9, 22, 61), (8, 9, 22, 61), (8, 10, 50, 61)],           # watermark 50: 9 is late, 10's bar is open
]
SEEN = {1: "admitted", 2: "admitted", 3: "ahead", 4: "late", 5: "admitted", 6: "unreadable", 7: "admitted", 8: "admitted",
        9: "late", 10: "admitted"}


def start(spark, root, build, **more):
    return replay.Replay(spark, root, {"ticks": ticks(spark, *BATCHES[0]).schema, **more}, build)


def test_bars_of_batches_stopped_and_resumed(spark, tmp_dir):
    run = start(spark, os.path.join(tmp_dir, "r"), lambda ticks: bar_stream(ticks, "event", "10 minutes"))
    for batch in BATCHES:
        run.step(ticks=ticks(spark, *batch))

    def bar(minute, *prices):
        return (DAY + dt.timedelta(minutes=minute), prices[0], max(prices), min(prices), prices[-1], len(prices))

    got = rows(run.read(BAR), "window_start", "open_price", "high_price", "low_price", "close_price", "tick_count")
    assert got == [bar(0, 1.0), bar(20, 4.0, 6.0), bar(30, 2.0)]   # those at 50 and 60 are open still


def test_admitted_ticks_and_the_report_agree(spark, tmp_dir):
    run = start(spark, os.path.join(tmp_dir, "r"), lambda ticks: replay.admitted_stream(ticks, "10 minutes"))
    for i, batch in enumerate(BATCHES):
        run.step(ticks=ticks(spark, *batch, *(BATCHES[i - 1] if i else ())))      # each is delivered twice
    got = rows(run.read(replay.admitted_schema(run.sources["ticks"])), "seq")
    assert [s for s, in got] == [s for s, v in SEEN.items() if v == "admitted"]
    parts = [ticks(spark, *b).withColumn("batch", F.lit(i)) for i, b in enumerate(BATCHES) if b]
    stored = parts[0]
    for p in parts[1:]:
        stored = stored.unionByName(p)
    told = replay.admission(stored.dropDuplicates(["seq"]), "batch", "10 minutes")
    assert {r["seq"]: r["verdict"] for r in told.collect()} == SEEN
    marks = {r["batch"]: r["watermark"] for r in told.collect()}
    assert marks == {0: None, 1: DAY + dt.timedelta(minutes=20), 3: DAY + dt.timedelta(minutes=20), 4: DAY + dt.timedelta(minutes=50)}


def test_the_clock_closes_the_last_arrival_bar(spark, tmp_dir):
    clock = spark.createDataFrame([(DAY + dt.timedelta(hours=2),)], CLOCK)
    run = start(spark, os.path.join(tmp_dir, "r"), lambda ticks, clock: bar_stream(ticks, "arrival", "1 minute", heartbeat=clock),
                clock=clock.schema)
    run.step(ticks=ticks(spark, (1, 1, 0, 0), (2, 2, 0, 1)))
    assert rows(run.read(BAR)) == []
    run.step(clock=clock)
    assert rows(run.read(BAR), "open_price", "close_price", "tick_count") == [(1.0, 2.0, 2)]


def test_empty_feeds_and_skew(spark, tmp_dir):
    none = ticks(spark, (1, 1, 0, 0)).limit(0)
    run = start(spark, os.path.join(tmp_dir, "r"), lambda ticks: replay.admitted_stream(ticks))
    run.step(ticks=none)
    assert rows(run.read(replay.admitted_schema(run.sources["ticks"]))) == []
    assert rows(replay.admission(none.withColumn("batch", F.lit(0)), "batch")) == []
    alone = replay.admission(ticks(spark, (1, 1, 0, 0)).withColumn("batch", F.lit(None).cast("int")), "batch")
    assert rows(alone, "verdict") == [("admitted",)]
    with pytest.raises(ValueError, match="max_skew"):
        replay.admission(none.withColumn("batch", F.lit(0)), "batch", "5 minutes", max_skew="1 hour")
