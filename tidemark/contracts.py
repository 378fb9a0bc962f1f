"""Schemas, keys and required columns of every layer."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T


@dataclass(frozen=True)
class Contract:
    """What a serving table demands: unique keys and columns that may not be NULL."""

    name: str
    keys: tuple[str, ...]
    required: tuple[str, ...]

    @property
    def not_null(self) -> tuple[str, ...]:
        """Required columns, then the key columns (a primary key is never NULL)."""
        return self.required + tuple(k for k in self.keys if k not in self.required)


# The column names below are the published table layouts.

FACT_RAW_COLUMNS = (
    "data_type_code",
    "time_slot_id",
    "seasonally_adj",
    "category_code",
    "cell_value",
    "error_data",
    "time",
)

FACT_RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in FACT_RAW_COLUMNS])

FACT_SILVER_COLUMNS = (
    "time",
    "date",
    "year",
    "month",
    "is_seasonally_adjusted",
    "category_code",
    "data_type_code",
    "time_slot_id",
    "cell_value",
    "error_data",
)

FACT_GOLD_COLUMNS = (
    "time",
    "dt",
    "year",
    "month",
    "is_seasonally_adjusted",
    "category_code",
    "data_type_code",
    "time_slot_id",
    "cell_value",
    "error_data",
    "ingest_date",
)

FACT = Contract(
    name="fact",
    keys=("dt", "category_code", "data_type_code", "time_slot_id", "is_seasonally_adjusted"),
    required=("time", "dt", "year", "month", "category_code", "data_type_code"),
)

FACT_SERIES_KEYS = ("category_code", "data_type_code", "time_slot_id", "is_seasonally_adjusted")
FACT_RECENCY = ("ingest_date", "time")
FACT_TIE = ("cell_value", "error_data")

MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("ts_ingested", T.StringType()),
        T.StructField("series_id", T.StringType()),
        T.StructField("year", T.StringType()),
        T.StructField("period", T.StringType()),
        T.StructField("periodName", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("footnotes", T.ArrayType(T.StringType())),
        T.StructField("is_latest", T.StringType()),
    ]
)

STREAM_BRONZE_SCHEMA = T.StructType(
    [
        T.StructField("ts_ingested", T.StringType()),
        T.StructField("series_id", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("period", T.StringType()),
        T.StructField("periodName", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("footnotes", T.ArrayType(T.StringType())),
        T.StructField("is_latest", T.BooleanType()),
    ]
)

STREAM_SILVER_SCHEMA = T.StructType(
    [
        T.StructField("ts_ingested", T.TimestampType()),
        T.StructField("series_id", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("period", T.StringType()),
        T.StructField("periodName", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("footnotes", T.ArrayType(T.StringType())),
        T.StructField("is_latest", T.BooleanType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("dt", T.DateType()),
    ]
)

SERVING_COLUMNS = (
    "series_id",
    "ts_ingested",
    "dt",
    "year",
    "month",
    "period",
    "periodname",
    "value",
    "is_latest",
    "footnotes",
)

SERVING_SCHEMA = T.StructType(
    [
        T.StructField(name, next(f.dataType for f in STREAM_SILVER_SCHEMA if f.name.lower() == name))
        for name in SERVING_COLUMNS
    ]
)

SERIES_REQUIRED = ("ts_ingested", "dt", "year", "month", "period", "value", "is_latest")

SERIES_LATEST = Contract("series_latest", keys=("series_id",), required=SERIES_REQUIRED)
SERIES_HISTORY = Contract(
    "series_history", keys=("series_id", "ts_ingested"), required=SERIES_REQUIRED
)

POINT_KEYS = ("series_id", "year", "period")
POINT_RECENCY = ("ts_ingested",)
POINT_TIE = ("value", "periodName", "is_latest", "footnotes")
SERIES_TIE = ("year", "period") + POINT_TIE
# End of fixed values.


def require_columns(df: DataFrame, required, label: str = "Bronze") -> DataFrame:
    """Fail while planning, not while running, when a column is absent."""
    missing = set(required) - set(df.columns)
    if missing:
        raise ValueError(f"{label} missing columns: {sorted(missing)}")
    return df
