"""Cutting long series into overlapping blocks, so that a trailing window
never has to run over a whole series in one task.

``PARTITION BY symbol`` puts a symbol on one task however long it is. Here a
series is cut at points taken from a hash sample of its own order, and the rows
in front of a cut are handed to the next block too (the *halo*), at least
``depth`` of them. A window that looks back at most ``depth`` rows therefore
gives the same values inside a block as it would over the whole series, and
the halo rows are dropped again afterwards. The rows themselves are shuffled
once, by (keys, block). A series shorter than a block has nothing to be cut for,
and a cut can fall anywhere in the order (symbol, time, tie-break), so neither a hot
symbol nor a hot day nor a hot instant ends up on one task.

The cuts come from one table with a row per series and hour: its rows, counted
map-side, and its samples. Windows run over the hours of a series, whose number
the calendar bounds, never over its rows or samples. A halo starts at
a sample of the cut's own hour, or at an hour with enough rows behind it, so that in sparse
hours it is not much longer than ``depth``. The cuts are a scalar subquery, of one entry
for every half a million rows or so: a task sorts and buffers a few blocks, however long the
series is.

Operators one after the other share the cuts of the first, where they use the same series
and look back no further: each of k operators reads its input once, and all of
them the base table once more.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from barstats.schema import SYMBOL, TS

BLOCK = "_block"
HALO = "_halo"
_CUTS = "_cuts"
_PLACE = "_place"

# Binary search among up to 2 ** 24 cuts.
_SEARCH_STEPS = 24

# A block has about BLOCK_ROWS rows, of which one in SAMPLE_EVERY is sampled. In crowded hours a halo is as
# many samples as the depth has rows, at most one in HALO_SHARE of a block's: deep look-backs sample
# more rows, up to one in LEAST_EVERY, from where on their blocks are longer.
BLOCK_ROWS = 1 << 19
SAMPLE_EVERY = 2048
LEAST_EVERY = 16
HALO_SHARE = 4
# Cuts are made for at least this depth if blocks are long, to be of use to a next operator.
SHARED_DEPTH = 64

Stage = Callable[[WindowSpec], Mapping[str, Column]]


class Passes(Protocol):
    """A stage that goes through the rows of a series in its own way."""

    def add_to(self, part: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame: ...



def series_window(
    df: DataFrame,
    ts: str = TS,
    partition_cols: Sequence[str] = (SYMBOL,),
    tiebreak: Sequence[str] = (),
) -> WindowSpec:
    """The series' own order; inside one block when ``df`` is cut into blocks."""
    keys, order = series_columns(df, ts, partition_cols, tiebreak)
    return Window.partitionBy(*keys).orderBy(*order)


def series_columns(
    df: DataFrame,
    ts: str = TS,
    partition_cols: Sequence[str] = (SYMBOL,),
    tiebreak: Sequence[str] = (),
) -> tuple[list[str], list[str]]:
    """The columns that tell series (or their blocks) apart, and those that order their rows."""
    return [*partition_cols, *([BLOCK] if BLOCK in df.columns else [])], [ts, *tiebreak]


@dataclass(frozen=True)
class Cuts:
    """Cut points as one value (a column), with what they were made for."""

    series: tuple
    depth: int
    points: Column


def carry_cuts(source: DataFrame, target: DataFrame) -> DataFrame:
    """Let a table with the same rows use the cuts of another."""
    if cuts := getattr(source, "_series_cuts", None):
        target._series_cuts = cuts
    return target


def _hour(df: DataFrame, ts: str) -> Column:
    """Groups of neighbouring times, whatever the session's time zone; other types as they are."""
    kind = dict(df.dtypes)[ts]
    if kind == "timestamp":
        return F.floor(F.unix_micros(ts) / F.lit(3_600_000_000))
    if kind == "timestamp_ntz":
        start = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
        return F.floor(F.expr(f"timestampdiff(MICROSECOND, {start}, `{ts}`)") / F.lit(3_600_000_000))
    return F.col(ts)


def _cut_points(
    df: DataFrame, key: Column, at: Column, hour: Column, depth: int, every: int, per_block: int
) -> DataFrame:
    """One row, one array of ``(place, reach)``, sorted.

    A sample stands for a distinct place in the order, so ``depth`` samples in
    front of a cut are ``depth`` rows at least, and so are all rows from an hour that has
    ``depth`` rows between its start and that of the cut's: ``reach`` is where the halo starts.
    """
    sampled = F.when(F.pmod(F.xxhash64("key", "at"), F.lit(every)) == 0, F.col("at"))
    hours = (
        df.select(key.alias("key"), at.alias("at"), hour.alias("hour"))
        .groupBy("key", "hour")
        .agg(
            F.count("*").alias("rows"),
            F.min("at").alias("first"),
            F.sort_array(F.collect_set(sampled)).alias("places"),
        )
    )
    earlier = (
        Window.partitionBy("key").orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    )
    far = Window.partitionBy("key").orderBy("rows_before")
    placed = hours.withColumns(
        {
            "rows_before": F.coalesce(F.sum("rows").over(earlier), F.lit(0)),
            "seen_before": F.coalesce(F.sum(F.size("places")).over(earlier), F.lit(0)),
        }
    ).withColumn(
        "from_hour", F.max("first").over(far.rangeBetween(Window.unboundedPreceding, -depth))
    )
    candidates = placed.select(
        "key",
        "from_hour",
        F.expr(
            f"inline(filter(transform(places, (p, i) -> struct(p AS at, seen_before + i AS seen,"
            f" get(places, i - {depth}) AS near)), x -> x.seen > 0 AND x.seen % {per_block} = 0))"
        ),
    ).select("key", "at", F.coalesce("near", "from_hour").alias("reach"))
    # A halo may not begin before the block in front: such a cut is left out.
    before = F.lag("at").over(Window.partitionBy("key").orderBy("at"))
    kept = candidates.where(F.col("reach").isNotNull()).withColumn("before", before)
    kept = kept.where(F.col("before").isNull() | (F.col("reach") >= F.col("before")))
    cut = F.struct(F.struct("key", "at").alias("place"), "reach")
    cuts = F.sort_array(F.collect_list(cut))
    refused = F.raise_error(F.lit("more cuts than a search goes through: make blocks longer"))
    return kept.agg(F.when(F.size(cuts) < 2**_SEARCH_STEPS, cuts).otherwise(refused).alias("cuts"))


def grain(depth: int) -> tuple[int, int]:
    """How many rows there are to a sample, and samples to a block, if the caller does not say."""
    per_block = max(BLOCK_ROWS // SAMPLE_EVERY, HALO_SHARE * depth)
    return max(LEAST_EVERY, BLOCK_ROWS // per_block), per_block


def _places(ts: str, partition_cols: Sequence[str], tiebreak: Sequence[str]) -> tuple[Column, Column]:
    key = F.struct(*partition_cols) if partition_cols else F.struct(F.lit(0).alias("all"))
    return key, F.struct(ts, *tiebreak)


def find_cuts(
    df: DataFrame,
    depth: int,
    *,
    ts: str = TS,
    partition_cols: Sequence[str] = (SYMBOL,),
    tiebreak: Sequence[str] = (),
    sample_every: int | None = None,
    samples_per_block: int | None = None,
) -> Cuts:
    """Where to cut the series of a table; those of an earlier operator if they do."""
    if depth < 0:
        raise ValueError(f"depth must not be negative, got {depth}")
    series = (ts, tuple(partition_cols), tuple(tiebreak), sample_every, samples_per_block)
    known = getattr(df, "_series_cuts", None)
    if known and known.series == series and known.depth >= depth:
        return known
    key, at = _places(ts, partition_cols, tiebreak)
    every, per_block = grain(max(depth, SHARED_DEPTH))
    every, per_block = sample_every or every, samples_per_block or per_block
    depth = max(depth, 1, min(SHARED_DEPTH, every * per_block // 1024))
    points = _cut_points(df, key, at, _hour(df, ts), depth, every, per_block)
    return Cuts(series, depth, points.scalar())


def split_series(
    df: DataFrame,
    depth: int,
    *,
    ts: str = TS,
    partition_cols: Sequence[str] = (SYMBOL,),
    tiebreak: Sequence[str] = (),
    sample_every: int | None = None,
    samples_per_block: int | None = None,
    cuts: Cuts | None = None,
) -> DataFrame:
    """Add ``_block`` and ``_halo``; halo rows appear in two blocks.

    ``depth`` is how many earlier rows a result may depend on. For windows over
    windows it is the sum of their look-backs.
    """
    key, at = _places(ts, partition_cols, tiebreak)
    if cuts is None:
        cuts = find_cuts(
            df,
            depth,
            ts=ts,
            partition_cols=partition_cols,
            tiebreak=tiebreak,
            sample_every=sample_every,
            samples_per_block=samples_per_block,
        )
    cuts = cuts.points
    place = F.struct(key.alias("key"), at.alias("at"))
    marked = df.select("*", cuts.alias(_CUTS), place.alias(_PLACE), F.lit(0).alias("_from"))

    # Binary search for the number of cuts at or before the row. Each step refers
    # to the one before it, which Catalyst turns into one projection per step; in
    # generated code the array is passed along by reference and goes no further.
    steps, so_far = [], "_from"
    for i in reversed(range(_SEARCH_STEPS)):
        name = f"_step{i}"
        steps.append(
            f"{so_far} + IF(try_element_at({_CUTS}, {so_far} + {2**i}).place <= {_PLACE},"
            f" {2**i}, 0) AS {name}"
        )
        so_far = name
    hops = F.expr(
        f"explode(IF(try_element_at({_CUTS}, {so_far} + 1).place.key = {_PLACE}.key"
        f" AND try_element_at({_CUTS}, {so_far} + 1).reach <= {_PLACE}.at, array(0, 1), array(0)))"
    )
    placed = marked.selectExpr("*", *steps)
    hopped = placed.select(*df.columns, so_far, hops.alias("_hop"))
    return hopped.select(
        *df.columns,
        (F.col(so_far) + F.col("_hop")).alias(BLOCK),
        (F.col("_hop") == 1).alias(HALO),
    )


def merge_blocks(df: DataFrame) -> DataFrame:
    """Drop the halo rows and the two columns of :func:`split_series`."""
    return df.where(~F.col(HALO)).drop(BLOCK, HALO)


def in_blocks(
    df: DataFrame, depth: int, build: Callable[[DataFrame], DataFrame], **series
) -> DataFrame:
    """Run ``build``, which keeps the rows, block-wise, unless ``df`` is in blocks already."""
    if BLOCK in df.columns:
        return build(df)
    cuts = find_cuts(df, depth, **series)
    out = merge_blocks(build(split_series(df, depth, cuts=cuts, **series)))
    out._series_cuts = cuts
    return out


def over_series(df: DataFrame, depth: int, *stages: Stage | Passes, **series) -> DataFrame:
    """Add windowed columns. A stage may use what the stages before it added."""

    def build(part: DataFrame) -> DataFrame:
        names = {k: v for k, v in series.items() if k in ("ts", "partition_cols", "tiebreak")}
        window = series_window(part, **names)
        keys, order = series_columns(part, **names)
        for stage in stages:
            if hasattr(stage, "add_to"):
                part = stage.add_to(part, keys, order)
            else:
                part = part.withColumns(dict(stage(window)))
        return part

    return in_blocks(df, depth, build, **series)
