"""Property tests: time text and rounding agree with Python on random inputs.

Each property draws a whole batch of inputs and checks it in one Spark job.
"""

from __future__ import annotations

import datetime as dt
from decimal import ROUND_HALF_EVEN, Decimal
from zoneinfo import ZoneInfo

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ticksmith.functions import iso_local, parse_to_utc, round_half_even

INSTANTS = st.datetimes(min_value=dt.datetime(1971, 1, 1), max_value=dt.datetime(2090, 12, 31))
ZONES = st.sampled_from(["Africa/Nairobi", "America/New_York", "Europe/London", "Asia/Kathmandu",
                         "Australia/Lord_Howe", "UTC"])


@settings(max_examples=5, deadline=None)
@given(st.lists(INSTANTS, min_size=1, max_size=200), ZONES)
def test_iso_local_and_parse_round_trip(spark, instants, tz):
    df = spark.createDataFrame([(t,) for t in instants], "utc timestamp_ntz")
    out = df.select("utc", iso_local(F.col("utc"), tz).alias("iso")) \
            .withColumn("back", parse_to_utc(F.col("iso"))).collect()
    for r in out:
        want = r["utc"].replace(tzinfo=dt.timezone.utc).astimezone(ZoneInfo(tz)).isoformat()
        assert r["iso"] == want
        assert r["back"] == r["utc"]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(min_value=-10**9, max_value=10**9), min_size=1, max_size=200))
def test_round_half_even_after_scaling(spark, cents_x2):
    # the rule: scale in double precision, then ties to even on the scaled
    # value (k/200 puts many inputs exactly on a half cent after scaling)
    xs = [k / 200 for k in cents_x2]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in xs], "x double")
           .select(round_half_even(F.col("x"))).collect()]
    for x, g in zip(xs, got):
        scaled = Decimal(x * 100)                     # the double product, exactly
        want = float(scaled.quantize(Decimal(1), rounding=ROUND_HALF_EVEN)) / 100
        assert g == want, x
