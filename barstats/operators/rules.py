"""Combining the intraday detectors into a label and a score."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barstats.operators.zscore import zscore
from barstats.schema import WINDOW, Z_THRESHOLD

# Labels of a bar, from none firing to several.
LABELS = ("none", "return", "volume", "volatility", "composite")

_FIRED = ("is_return_anomaly", "is_volume_anomaly", "is_volatility_regime")


@dataclass(frozen=True)
class Rules:
    size: int = WINDOW
    return_threshold: float = Z_THRESHOLD
    volume_threshold: float = Z_THRESHOLD
    return_weight: float = 1.0
    volume_weight: float = 1.0


def add_return_zscore(df: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Signed score of the log return; flagged on either side."""
    n = rules.size
    score = zscore("log_return", f"rolling_mean_return_{n}", f"rolling_std_return_{n}")
    return df.withColumn("return_zscore", score).withColumn(
        "is_return_anomaly", F.abs("return_zscore") > rules.return_threshold
    )


def add_volume_zscore(df: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Signed score of the volume; only the upper tail is flagged."""
    n = rules.size
    score = zscore("volume", f"volume_rolling_mean_{n}", f"volume_rolling_std_{n}")
    return df.withColumn("volume_zscore", score).withColumn(
        "is_volume_anomaly", F.col("volume_zscore") > rules.volume_threshold
    )


def anomaly_label() -> Column:
    fired = [F.coalesce(F.col(c), F.lit(False)) for c in _FIRED]
    how_many = sum((f.cast("int") for f in fired), F.lit(0))
    label = F.when(how_many >= 2, LABELS[4])
    for name, rule in zip(LABELS[1:4], fired, strict=True):
        label = label.when(rule, name)
    return label.otherwise(LABELS[0])


def anomaly_score(rules: Rules) -> Column:
    """Weighted size of the two scores; one that is NULL adds nothing."""
    weighted = (
        (rules.return_weight, "return_zscore"),
        (rules.volume_weight, "volume_zscore"),
    )
    return sum(
        (F.lit(w) * F.coalesce(F.abs(c), F.lit(0.0)) for w, c in weighted), F.lit(0.0)
    )


def apply_rules(df: DataFrame, rules: Rules = Rules(), run_id: str | None = None) -> DataFrame:
    """Scores, flags, label and score on every bar; none is filtered out."""
    scored = add_volume_zscore(add_return_zscore(df, rules), rules)
    labelled = scored.withColumns(
        {"anomaly_label": anomaly_label(), "anomaly_score": anomaly_score(rules)}
    )
    return labelled if run_id is None else labelled.withColumn("run_id", F.lit(run_id))
