"""Panel files: dated scans, CSV in and out, and the merge of weather and air readings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazeline.functions.measures import nan_to_null
from hazeline.schema import KEYS, RAW_SCHEMA


def clean(df: DataFrame) -> DataFrame:
    """NaN becomes null once, at ingest; everything downstream relies on it."""
    doubles = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: nan_to_null(F.col(c)) for c in doubles})


def between_days(df: DataFrame, start: str, end: str, date: str = "date") -> DataFrame:
    """Rows from `start` to `end`, both days included; a plain range, so it reaches the Parquet scan."""
    first = F.lit(start).cast("date").cast("timestamp_ntz")
    after = F.date_add(F.lit(end).cast("date"), 1).cast("timestamp_ntz")
    return df.where((F.col(date) >= first) & (F.col(date) < after))


def read_panel(spark: SparkSession, path: str, start: str | None = None, end: str | None = None) -> DataFrame:
    df = clean(spark.read.schema(RAW_SCHEMA).parquet(path))
    return df if start is None or end is None else between_days(df, start, end)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a declared schema; dates are parsed on the way in and nothing is inferred."""
    return clean(spark.read.schema(RAW_SCHEMA).option("header", True).option("nanValue", "NaN").csv(path))


def merge_readings(weather: DataFrame, air: DataFrame) -> DataFrame:
    """Inner join on date, city and place. The keys hold the hour, so no key is hot."""
    return weather.join(air, KEYS, "inner")
