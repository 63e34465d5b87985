"""Z-score of a value against the trailing statistics already on its row."""

from __future__ import annotations

import math
import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barstats.functions import mean_name, ratio, std_name, zscore_flag_name, zscore_name
from barstats.schema import Z_THRESHOLD


def zscore(column: str, mean: str, std: str) -> Column:
    """Deviations from the mean; NULL where the deviation is NULL or zero, or a value NaN."""
    return F.nanvl(ratio(F.col(column) - F.col(mean), F.col(std)), F.lit(None).cast("double"))


def add_rolling_zscore(df: DataFrame, column: str, window: int) -> DataFrame:
    score = zscore(column, mean_name(column, window), std_name(column, window))
    return df.withColumns({zscore_name(column, window): score})


def add_zscore_anomaly_flag(
    df: DataFrame, column: str, window: int, threshold: float = Z_THRESHOLD
) -> DataFrame:
    """TRUE strictly beyond the threshold on either side, NULL for a NULL score."""
    beyond = F.abs(zscore_name(column, window)) > F.lit(float(threshold))
    return df.withColumns({zscore_flag_name(column, window): beyond})


def largest_possible_score(window: int) -> float:
    """A row is part of its own window, which bounds its score."""
    return (window - 1) / math.sqrt(window)


def detect_zscore_anomalies(
    df: DataFrame, column: str, window: int, threshold: float = Z_THRESHOLD
) -> DataFrame:
    """Score and flag; the rolling columns of ``column`` must be there already."""
    if threshold >= largest_possible_score(window):
        warnings.warn(
            f"no row can score above {threshold} in a window of {window} rows", stacklevel=2
        )
    return add_zscore_anomaly_flag(
        add_rolling_zscore(df, column, window), column, window, threshold
    )
