"""Column contracts shared by every stage.

Bar times are wall-clock ``TIMESTAMP_NTZ`` values, so a trading day never
depends on the session time zone.
"""

from pyspark.sql.types import (
    DoubleType,
    LongType,
    NumericType,
    StringType,
    StructField,
    StructType,
)

TS = "date"
SYMBOL = "symbol"
ROW_ID = "row_index"

# The input file's header, in file order.
_RAW_FIELDS = (
    ("row_index", LongType()),
    ("date", StringType()),
    ("open", DoubleType()),
    ("high", DoubleType()),
    ("low", DoubleType()),
    ("close", DoubleType()),
    ("volume", LongType()),
    ("barCount", LongType()),
    ("average", DoubleType()),
)

RAW_SCHEMA = StructType([StructField(n, t, True) for n, t in _RAW_FIELDS])
RAW_COLUMNS = tuple(RAW_SCHEMA.names)
NUMERIC_COLUMNS = tuple(
    f.name for f in RAW_SCHEMA.fields if isinstance(f.dataType, NumericType)
)

# The same file with several series in it: a symbol follows the raw columns.
KEYED_SCHEMA = StructType([*RAW_SCHEMA.fields, StructField(SYMBOL, StringType(), True)])

# Pipeline parameters that must equal the published ones.
WINDOW = 20
Z_THRESHOLD = 3.0
IQR_K = 1.5
RELATIVE_ERROR = 0.01

Z_FLAG = f"close_zscore_anomaly_{WINDOW}"
IQR_FLAG = "close_iqr_anomaly"

ENRICHED_COLUMNS = (
    *RAW_COLUMNS,
    "simple_return",
    "price_range",
    "candle_body",
    f"close_rolling_mean_{WINDOW}",
    f"close_rolling_std_{WINDOW}",
    f"close_zscore_{WINDOW}",
    Z_FLAG,
    IQR_FLAG,
    SYMBOL,
)

# What every chart aggregate may rely on, and the numeric part of it.
CORRELATION_FEATURES = (
    "open",
    "high",
    "low",
    "close",
    "volume",
    "average",
    "simple_return",
    "price_range",
    "candle_body",
    f"close_rolling_mean_{WINDOW}",
    f"close_rolling_std_{WINDOW}",
    f"close_zscore_{WINDOW}",
)
CHART_COLUMNS = (TS, *CORRELATION_FEATURES, Z_FLAG, IQR_FLAG)
