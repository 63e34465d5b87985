import math
import random
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from barstats.operators.blocks import over_series
from barstats.operators.sliding import SlidingQuantile, above_quantile
from helpers import plain_window, random_series, same_rows


def brute(values, length, quantile):
    out = []
    for i, x in enumerate(values):
        frame = sorted(v for v in values[max(0, i - length + 1) : i + 1] if v is not None)
        if x is None:
            out.append(None)
            continue
        place = (len(frame) - 1) * quantile
        low, high = frame[math.floor(place)], frame[math.ceil(place)]
        out.append(x > low + (high - low) * (place - math.floor(place)))
    return out


VALUES = st.lists(st.none() | st.integers(-6, 6).map(float), max_size=80)


@settings(deadline=None, max_examples=300)
@given(VALUES, st.integers(2, 20), st.sampled_from([0.0, 0.1, 0.5, 0.95, 1.0]))
def test_agrees_with_sorting_every_frame(values, length, quantile):
    frame = SlidingQuantile(length, quantile)
    assert [frame.above(v) for v in values] == brute(values, length, quantile)


@pytest.mark.parametrize("order", [sorted, lambda v: sorted(v, reverse=True), list])
def test_heaps_stay_of_the_frames_size(order):
    rng = random.Random(3)
    values = order([rng.random() for _ in range(3000)])
    frame = SlidingQuantile(50, 0.9)
    got = []
    for v in values:
        got.append(frame.above(v))
        assert max(len(frame.low), len(frame.high)) <= 64 + 2 * 50 + 1
    assert got == brute(values, 50, 0.9)


def test_nan_is_above_all_numbers():
    frame = SlidingQuantile(3, 0.5)
    assert [frame.above(v) for v in (1.0, math.nan, 2.0)] == [False, True, False]


def test_a_wider_frame_costs_little_more():
    rng = random.Random(1)
    values = [rng.random() for _ in range(60_000)]

    def seconds(length):
        frame = SlidingQuantile(length, 0.95)
        began = time.process_time()
        for v in values:
            frame.above(v)
        return time.process_time() - began

    assert min(seconds(3900) for _ in range(3)) < 2 * min(seconds(390) for _ in range(3))


def test_series_in_blocks_agree_with_a_window(spark):
    bars = random_series(spark, 600)
    stage = above_quantile("close", "high", 30, 0.9)
    cut = {"tiebreak": ("row_index",), "sample_every": 2, "samples_per_block": 20}
    out = over_series(bars, 29, stage, **cut)
    bound = F.percentile("close", 0.9).over(plain_window("symbol").rowsBetween(-29, 0))
    want = bars.withColumn("high", F.col("close") > bound)
    assert out.columns == want.columns and same_rows(out, want)


def test_an_earlier_column_of_the_name_is_replaced(spark):
    bars = random_series(spark, 50).withColumn("high", F.lit("mine"))
    out = over_series(bars, 4, above_quantile("close", "high", 5, 0.5), tiebreak=("row_index",))
    assert dict(out.dtypes)["high"] == "boolean" and out.count() == 50
