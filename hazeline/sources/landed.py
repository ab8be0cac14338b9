"""Provider payloads that have landed as files: checked, exploded to rows, the bad ones set aside with a reason.

A payload is one JSON document per line, or one Parquet row: place, zone, and a block of hourly arrays or of current
values. Spark's own readers split the files and reach any store; a line that is no payload becomes a row of its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazeline.session import written
from hazeline.sources.feature_table import FeatureTable, utc_clock
from hazeline.sources.files import clean
from hazeline.sources.payloads import explode_hourly

BROKEN = "_broken"
PLACE = [("city", T.StringType()), ("latitude", T.DoubleType()), ("longitude", T.DoubleType()), ("timezone", T.StringType())]


def hourly_schema(variables: Sequence[str]) -> T.StructType:
    """Steps from `time` up to `time_end`, `interval` seconds apart, and one array of readings per variable."""
    steps = [T.StructField(c, T.LongType()) for c in ("time", "time_end", "interval")]
    return _with_place("hourly", steps + [T.StructField(v, T.ArrayType(T.DoubleType())) for v in variables])


def current_schema(variables: Sequence[str]) -> T.StructType:
    """One reading per variable at `time`."""
    return _with_place("current", [T.StructField("time", T.LongType()), *(T.StructField(v, T.DoubleType()) for v in variables)])


def _with_place(block: str, fields: list[T.StructField]) -> T.StructType:
    place = [T.StructField(name, kind) for name, kind in PLACE]
    return T.StructType([*place, T.StructField(block, T.StructType(fields))])


def reader(spark: SparkSession, schema: T.StructType, kind: str = "json", stream: bool = False):
    """A reader of payload files; lines that can't be parsed keep their text in `_broken`."""
    source = spark.readStream if stream else spark.read
    if kind == "parquet":
        return source.schema(schema).format("parquet")
    full = T.StructType([*schema.fields, T.StructField(BROKEN, T.StringType())])
    return source.schema(full).format("json").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BROKEN)


def known_zone(spark: SparkSession, name: Column) -> Column:
    """Whether a zone has rules on this platform; the list has a fixed size."""
    zones = spark._jvm.java.time.ZoneId.getAvailableZoneIds().toArray()
    return F.coalesce(name.isin([str(z) for z in zones]), F.lit(False))


def reason(payloads: DataFrame, block: str, variables: Sequence[str]) -> Column:
    """Why a payload can't be used; null if it can."""
    at = F.col(block)
    broken = F.col(BROKEN).isNotNull() if BROKEN in payloads.columns else F.lit(False)
    missing = [F.col(c).isNull() for c in ("city", "latitude", "longitude")]
    out = F.when(broken | at.isNull(), "not a payload").when(missing[0] | missing[1] | missing[2], "no place")
    out = out.when(~known_zone(payloads.sparkSession, F.col("timezone")), "unknown zone")
    if block == "current":
        return out.when(at["time"].isNull(), "no time")
    steps = F.expr(f"({block}.time_end - {block}.time + {block}.interval - 1) div {block}.interval")
    times = at["time"].isNotNull() & (at["time_end"] >= at["time"]) & (at["interval"] > 0)
    out = out.when(~F.coalesce(times, F.lit(False)), "no steps")
    uneven = F.lit(False)
    for v in variables:  # a variable may be left out as a whole
        uneven = uneven | (at[v].isNotNull() & (F.size(at[v]) != steps))
    return out.when(uneven, "arrays of other lengths than the steps")


def sorted_out(payloads: DataFrame, block: str, variables: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(usable payloads, those set aside as `reason`, `city` and the `payload` as text)."""
    judged = payloads.withColumn("reason", reason(payloads, block, variables))
    whole = F.to_json(F.struct(*(F.col(c) for c in payloads.columns if c != BROKEN)))
    said = F.coalesce(F.col(BROKEN), whole) if BROKEN in payloads.columns else whole
    bad = judged.where("reason is not null").select("reason", "city", said.alias("payload"))
    return judged.where("reason is null").drop("reason", BROKEN), bad


def hourly_rows(payloads: DataFrame, variables: Sequence[str]) -> DataFrame:
    """One row per step, as `explode_hourly` makes them; NaN becomes null."""
    flat = payloads.select(
        "city", F.col("latitude").alias("lat"), F.col("longitude").alias("lon"), F.col("timezone").alias("tz"),
        *(F.col(f"hourly.{c}").alias(c) for c in ("time", "time_end", "interval", *variables)))
    return clean(explode_hourly(flat, variables))


def current_rows(payloads: DataFrame, variables: Sequence[str], prefix: str = "") -> DataFrame:
    """(date, city, lat, lon, readings, time): `date` is the clock of the payload's zone, `time` its instant in seconds.

    Readings get `prefix` before their names, so that blocks of several providers can stand side by side.
    """
    utc = utc_clock(F.timestamp_seconds("current.time"))
    rows = payloads.select(
        F.convert_timezone(F.lit("UTC"), F.col("timezone"), utc).alias("date"), "city", F.col("latitude").alias("lat"), F.col("longitude").alias("lon"),
        *(F.col(f"current.{v}").alias(f"{prefix}{v}") for v in variables), F.col("current.time").alias("time"))
    return clean(rows)


def ingest(spark: SparkSession, path: str, table: FeatureTable, variables: Sequence[str], rejected: str, kind: str = "json") -> None:
    """Read a folder of hourly payloads, upsert their rows, append what was set aside to the folder `rejected`.

    Where several payloads of one run hold the same hour of a city, one of them wins, the same in every run.
    """
    payloads = written(reader(spark, hourly_schema(variables), kind).load(path), "payloads")  # parsed once
    good, bad = sorted_out(payloads, "hourly", variables)
    bad.write.mode("append").parquet(rejected)
    table.upsert(hourly_rows(good, variables))


def to_hourly_payloads(rows: DataFrame, variables: Sequence[str]) -> DataFrame:
    """Flat payload rows, as `to_payloads` makes them, in the landed form."""
    hourly = F.struct(*(F.col(c).cast("long").alias(c) for c in ("time", "time_end", "interval")), *variables)
    return rows.select("city", F.col("lat").alias("latitude"), F.col("lon").alias("longitude"), F.col("tz").alias("timezone"), hourly.alias("hourly"))
