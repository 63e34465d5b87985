"""Boilerplate removal by the number of distinct sites that have a line.

A HyperLogLog sketch of the sites is kept per line hash and merged by aggregation, so a
line that a third of all documents have costs one sketch for each task. Lines whose
estimate is near the threshold have their sites counted exactly; others are decided by the
estimate, which is out of reach of the threshold by six standard errors and more. Lines
of at least ``min_sites`` sites are removed wherever they occur. Only DataFrame functions
are used.

Lines and texts are known by 128 bits of hash, so that what is shuffled is narrow; the
lines to remove are listed per text, and equal texts share the list. A line without a word
is never removed. A null site counts as one site; a null text has no lines and stays null;
an empty text has one empty line, an empty table no lines; texts of any length are split whole. Repeated
rows have the same lines removed. Columns of the
input with the names of new ones are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barstats.llm.common import WORD, set_apart
from barstats.sources.scratch import staged

MIN_SITES = 5
LG_SLOTS = 12


def _hashes(value: Column, name: str) -> list[Column]:
    return [F.xxhash64(value).alias(f"{name}1"), F.xxhash64(F.lit(name), value).alias(f"{name}2")]


def line_table(docs: DataFrame, text_col: str = "text", site_col: str = "source") -> DataFrame:
    """A row per line with a word: hashes of the text (_t) and line (_l), its number, the site."""
    text = F.col(text_col)
    site = F.coalesce(F.concat(F.lit("s"), F.col(site_col).cast("string")), F.lit(""))
    lines = docs.where(text.isNotNull()).select(
        *_hashes(text, "_t"), site.alias("site"), F.posexplode(F.split(text, "\n")).alias("no", "line")
    )
    lines = lines.where(F.expr(f"line rlike r'{WORD}'"))
    return lines.select("_t1", "_t2", "site", "no", *_hashes(F.col("line"), "_l"))


def widespread(lines: DataFrame, min_sites: int = MIN_SITES, lg_slots: int = LG_SLOTS) -> DataFrame:
    """The hashes (_l1, _l2) of lines that at least ``min_sites`` distinct sites have."""
    sketches = lines.groupBy("_l1", "_l2").agg(F.hll_sketch_agg("site", F.lit(lg_slots)).alias("sketch"))
    spread = sketches.select("_l1", "_l2", F.hll_sketch_estimate("sketch").alias("sites"))
    margin = max(1.0, 6 * 1.04 / math.sqrt(2**lg_slots) * min_sites)
    spread = staged(spread.where(F.col("sites") >= min_sites - margin), "spread")
    near = spread.where(F.col("sites") <= min_sites + margin)
    exact = lines.join(near.select("_l1", "_l2"), ["_l1", "_l2"], "left_semi")
    exact = exact.select("_l1", "_l2", "site").distinct().groupBy("_l1", "_l2").count()
    sure = spread.where(F.col("sites") > min_sites + margin).select("_l1", "_l2")
    return sure.union(exact.where(F.col("count") >= min_sites).select("_l1", "_l2"))


def remove_boilerplate(
    docs: DataFrame,
    text_col: str = "text",
    site_col: str = "source",
    min_sites: int = MIN_SITES,
    lg_slots: int = LG_SLOTS,
) -> DataFrame:
    """The documents with their text without widespread lines, n_lines and n_removed."""
    held, (text, site), back = set_apart(docs, text_col, site_col)
    lines = staged(line_table(held, text, site), "lines")
    wide = staged(widespread(lines, min_sites, lg_slots), "widespread")
    gone = lines.join(wide, ["_l1", "_l2"], "left_semi").select("_t1", "_t2", "no").distinct()
    gone = staged(gone.groupBy("_t1", "_t2").agg(F.collect_set("no").alias("_gone")), "gone")
    keyed = held.withColumns(dict(zip(("_t1", "_t2"), _hashes(F.col(text), "_t"))))
    joined = keyed.join(gone, ["_t1", "_t2"], "left")
    parts = F.split(F.col(text), "\n")
    left = F.filter(parts, lambda _, i: ~F.array_contains("_gone", i))
    n_lines = F.when(F.col(text).isNull(), 0).otherwise(F.size(parts))
    out = joined.withColumns(
        {
            "n_lines": n_lines.cast("long"),
            "n_removed": F.coalesce(F.size("_gone"), F.lit(0)).cast("long"),
            text: F.when(F.col("_gone").isNull(), F.col(text)).otherwise(F.array_join(left, "\n")),
        }
    )
    out = out.withColumn("n_removed", F.greatest("n_removed", F.lit(0)))  # size() of null may be -1
    return back(out, "n_lines", "n_removed")
