"""Names of derived columns. Stages find each other by these names."""


def mean_name(column: str, size: int) -> str:
    return f"{column}_rolling_mean_{size}"


def std_name(column: str, size: int) -> str:
    return f"{column}_rolling_std_{size}"


def zscore_name(column: str, size: int) -> str:
    return f"{column}_zscore_{size}"


def zscore_flag_name(column: str, size: int) -> str:
    return f"{column}_zscore_anomaly_{size}"


def iqr_flag_name(column: str) -> str:
    return f"{column}_iqr_anomaly"
