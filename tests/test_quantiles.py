import math

import pytest
from pyspark.sql import functions as F

from barstats.operators.quantiles import exact_quantiles

PROBS = (0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0)


def table(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x double")


CASES = {
    "spread": [(i * 7919) % 1009 / 7 for i in range(1009)],
    "one value": [4.25] * 50,
    "mostly copies": [1.0] * 400 + [float(i) for i in range(200)],
    "far outlier": [float(i) for i in range(300)] + [1e12],
    "tiny steps": [1e-9 * i for i in range(100)] + [1e6 + 1e-6 * i for i in range(100)],
    "signs": [-0.0, 0.0, -5.5, 5.5, -1e300, 1e300, 3.25],
    "powers": [10.0**i for i in range(-60, 60)],
    "single": [7.0],
}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("interpolate", [False, True])
@pytest.mark.parametrize("accuracy,reach", [(100_000, 3), (10, 3), (20, 0)])
def test_agrees_with_the_builtin_percentiles(spark, name, interpolate, accuracy, reach):
    df = table(spark, CASES[name]).unionByName(table(spark, [None, math.nan]))
    got = exact_quantiles(df, "x", PROBS, interpolate=interpolate, accuracy=accuracy, reach=reach)
    row = got.first()
    held = table(spark, CASES[name])
    kind = "percentile_cont" if interpolate else "percentile_disc"
    want = held.selectExpr(
        *[f"{kind}({p}) within group (order by x) as q{i}" for i, p in enumerate(PROBS)]
    ).first()
    assert row["n"] == len(CASES[name])
    assert row["quantiles"] == pytest.approx(list(want), rel=1e-12)


def test_infinities(spark):
    df = table(spark, [-math.inf, 1.0, 2.0, 3.0, math.inf])
    row = exact_quantiles(df, "x", (0.2, 0.4, 0.6, 1.0)).first()
    assert row["quantiles"] == [-math.inf, 1.0, 2.0, math.inf]


def test_groups_of_any_size(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 40).cast("string")).alias("g"),
        (F.xxhash64("id") % 500 / 4).alias("x"),
    )
    for few in (True, False):
        got = {
            r["g"]: r["quantiles"]
            for r in exact_quantiles(df, "x", (0.25, 0.75), by=["g"], interpolate=True, few_groups=few).collect()
        }
        want = {r[0]: r[1] for r in df.groupBy("g").agg(F.percentile("x", [0.25, 0.75])).collect()}
        assert got == want


def test_no_values_no_row(spark):
    assert exact_quantiles(table(spark, [None, math.nan]), "x", (0.5,)).isEmpty()


@pytest.mark.parametrize("options", [{"accuracy": 0}, {"reach": -1}])
def test_refuses_brackets_without_width(spark, options):
    with pytest.raises(ValueError):
        exact_quantiles(table(spark, [1.0]), "x", (0.5,), **options)


@pytest.mark.parametrize("reach", [0, 3])
def test_a_rank_outside_its_bracket_is_found_in_a_further_pass(spark, reach):
    """With brackets of one value and a coarse sketch most ranks lie between them."""
    df = spark.range(5000).select(F.when(F.col("id") % 4 > 0, "hot").otherwise("cold").alias("g"), (F.xxhash64("id") % 100_000 / 7).alias("x"))
    probs = (0.1, 0.25, 0.5, 0.75, 0.9)
    got = exact_quantiles(df, "x", probs, by=["g"], interpolate=True, accuracy=5, reach=reach)
    want = {r[0]: r[1] for r in df.groupBy("g").agg(F.percentile("x", list(probs))).collect()}
    for row in got.collect():
        assert row["quantiles"] == pytest.approx(want[row["g"]], rel=1e-12)


@pytest.mark.parametrize("by", [[], ["g"]])
def test_three_passes_at_most(spark, tmp_path, by):
    """The values are read for the sketch, for the counts, and for what these leave."""
    spark.range(2000).select((F.col("id") % 3).alias("g"), (F.xxhash64("id") % 999 / 4).alias("x")).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    for options, most in (({}, 2), ({"accuracy": 4, "reach": 0}, 3)):
        found = exact_quantiles(df, "x", (0.25, 0.5, 0.75), by=by, **options)
        found.collect()
        ran = found._jdf.queryExecution().executedPlan().toString().partition("Initial Plan")[0]
        # What is reused is not read again.
        assert "Final Plan" in ran and ran.count("FileScan parquet") <= most


def test_values_of_all_magnitudes(spark):
    rows = [float(i) / 5000 for i in range(5000)] + [1e300, -1e150, 5e-324, -5e-324, 0.0, -0.0]
    rows += [float("inf"), float("-inf")] + [10.0**k for k in range(-300, 300, 7)] + [-(3.0**k) for k in range(50)]
    df = spark.createDataFrame([(x,) for x in rows], "x double")
    probs = (0.0, 0.001, 0.01, 0.25, 0.5, 0.9, 0.999, 1.0)
    for options in ({}, {"accuracy": 4, "reach": 0}):
        got = exact_quantiles(df, "x", probs, **options).first()
        ordered = sorted(rows)
        want = [ordered[max(math.ceil(p * len(rows)), 1) - 1] for p in probs]
        assert got["n"] == len(rows) and list(got["quantiles"]) == want
