"""The city dimension and its lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeline.schema import CITY_COORDINATES


class UnknownCity(ValueError):
    pass


def literal_rows(spark: SparkSession, rows: list[tuple], columns: str) -> DataFrame:
    """A few rows as SQL literals: part of the plan, so their size is known to the planner."""

    def literal(value) -> str:
        if value is None:
            return "null"
        if isinstance(value, str):
            return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
        return f"{value!r}D" if isinstance(value, float) else repr(value)

    body = ", ".join("(" + ", ".join(map(literal, row)) + ")" for row in rows)
    return spark.sql(f"select * from values {body} as t({columns})")


def city_table(spark: SparkSession) -> DataFrame:
    rows = [(name, lat, lon) for name, (lat, lon) in CITY_COORDINATES.items()]
    return literal_rows(spark, rows, "_key, lat, lon")


def locate(df: DataFrame, city: str = "city") -> DataFrame:
    """Add `lat` and `lon`; null where the city is not known."""
    table = F.broadcast(city_table(df.sparkSession))  # fixed eight rows
    return df.withColumn("_key", F.lower(F.trim(city))).join(table, "_key", "left").drop("_key")


def unknown_cities(df: DataFrame, city: str = "city") -> DataFrame:
    table = F.broadcast(city_table(df.sparkSession))
    names = df.select(F.col(city).alias("city")).distinct()
    return names.withColumn("_key", F.lower(F.trim("city"))).join(table, "_key", "left_anti").drop("_key")


def resolve(df: DataFrame, city: str = "city") -> DataFrame:
    """`locate`, but an unknown name is an error that lists the known ones."""
    missing = unknown_cities(df, city).limit(5).collect()
    if missing:
        known = ", ".join(sorted(CITY_COORDINATES))
        names = ", ".join(repr(row["city"]) for row in missing)
        raise UnknownCity(f"no coordinates for {names}; there are some for: {known}")
    return locate(df, city)
