"""The hourly panel derived from the `events` table, in Spark and as check SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeline.sources.cities import literal_rows
from hazeline.sources.files import between_days
from hazeline.schema import AIR_VARIABLES, KEYS, WEATHER_VARIABLES

# Event type -> station.
STATIONS = [
    ("click", "Lahore", 31.558, 74.351),
    ("error", "Karachi", 24.8607, 67.0011),
    ("purchase", "Delhi", 28.6139, 77.209),
    ("signup", "Beijing", 39.9042, 116.4074),
    ("view", "London", 51.5074, -0.1278),
]


def panel(
    spark: SparkSession, sf_dir: str, single_series: bool = False, days: tuple[str, str] | None = None
) -> DataFrame:
    """One row per hour and station; `single_series` books every event under the first station.

    A range of days is applied to the event time, so that it reaches the file scan.
    """
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    if days:
        events = between_days(events, *days, date="ts")
    ts = F.col("ts")
    hour = F.make_timestamp_ntz(
        F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.lit(0), F.lit(0).cast("decimal(16,6)")
    )
    readings = events.select(
        hour.alias("date"), "event_type", "user_id",
        F.round(F.col("value") * 100).cast("bigint").alias("cents"),
        F.regexp_extract("props", "([0-9]+)", 1).cast("int").alias("k"),
    )
    # Five literal rows: a broadcast of fixed size.
    stations = literal_rows(spark, STATIONS, "event_type, city, lat, lon")
    if single_series:
        first = STATIONS[0]
        located = readings.withColumns({"city": F.lit(first[1]), "lat": F.lit(first[2]), "lon": F.lit(first[3])})
    else:
        located = readings.join(F.broadcast(stations), "event_type")
    hourly = located.groupBy("date", "city", "lat", "lon").agg(
        F.count("*").cast("double").alias("n"),
        F.count_distinct("user_id").cast("double").alias("users"),
        F.sum("cents").cast("double").alias("s"),
        F.max("cents").cast("double").alias("mx"),
        F.min("cents").cast("double").alias("mn"),
        F.sum("k").cast("double").alias("sk"),
        F.max("k").cast("double").alias("mxk"),
        F.min("k").cast("double").alias("mnk"),
        F.sum(F.col("user_id") % 40).cast("double").alias("su"),
    )
    n, s, sk = F.col("n"), F.col("s"), F.col("sk")
    measures = {
        "temperature_2m": F.col("su") / n,
        "wind_direction_10m": F.lit(3.6) * sk / n,
        "wind_speed_10m": s / (F.lit(1000) * n),
        "rain": s / 10000,
        "weather_code": F.col("mxk") % 4,
        "wind_gusts_10m": F.col("mx") / 1000,
        "cloud_cover": sk / n,
        "relative_humidity_2m": F.lit(30) + F.lit(0.6) * sk / n,
        "pm10": F.col("mx") / 100,
        "pm2_5": F.col("mn") / 100,
        "carbon_monoxide": s / 10,
        "nitrogen_dioxide": sk / n,
        "sulphur_dioxide": F.col("mxk"),
        "ozone": F.col("mnk"),
        "uv_index": n,
        "aerosol_optical_depth": F.col("users"),
        "european_aqi": s / (F.lit(100) * n),
    }
    return hourly.select("date", "city", "lat", "lon", *[c.alias(name) for name, c in measures.items()])


def weather(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    return panel(spark, sf_dir, **kw).select(*KEYS, *WEATHER_VARIABLES)


def air(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    return panel(spark, sf_dir, **kw).select(*KEYS, *AIR_VARIABLES)


def dirty_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel with planted faults, for the quality queries."""
    hour, day = F.hour("date"), F.dayofmonth("date")
    return panel(spark, sf_dir).withColumns({
        "pm10": F.when(hour == 3, -F.col("pm10")).otherwise(F.col("pm10")),
        "ozone": F.when(hour == 5, -1 - F.col("ozone")).otherwise(F.col("ozone")),
        "rain": F.when((hour == 7) & (day % 3 != 0), F.lit(None).cast("double")).otherwise(F.col("rain")),
        "cloud_cover": F.when(hour.isin(1, 2), F.lit(None).cast("double")).otherwise(F.col("cloud_cover")),
        "lat": F.when((hour != 15) | (day != 6), F.col("lat")),
        "european_aqi": F.when(hour == 9, F.col("european_aqi") + 490)
        .when((hour == 11) & (day == 4), F.lit(None).cast("double"))
        .when((hour == 13) & (day == 5), -F.col("european_aqi"))
        .otherwise(F.col("european_aqi")),
    })


PANEL_SQL = """
with ev as (
  select date_trunc('hour', ts) as date, event_type, user_id,
         cast(round(value * 100) as bigint) as cents,
         cast(regexp_extract(props, '([0-9]+)', 1) as int) as k
  from events),
city as (
  select * from (values
    ('click','Lahore',31.558e0,74.351e0), ('error','Karachi',24.8607e0,67.0011e0),
    ('purchase','Delhi',28.6139e0,77.209e0), ('signup','Beijing',39.9042e0,116.4074e0),
    ('view','London',51.5074e0,-0.1278e0)) as t(event_type, city, lat, lon)),
agg as (
  select e.date, c.city, c.lat, c.lon,
    cast(count(*) as double) as n, cast(count(distinct user_id) as double) as users,
    cast(sum(cents) as double) as s, cast(max(cents) as double) as mx, cast(min(cents) as double) as mn,
    cast(sum(k) as double) as sk, cast(max(k) as double) as mxk, cast(min(k) as double) as mnk,
    cast(sum(user_id % 40) as double) as su
  from ev e join city c on e.event_type = c.event_type
  group by e.date, c.city, c.lat, c.lon),
panel as (
select cast(date as timestamp) as date, city, lat, lon,
  su / n as temperature_2m, 3.6e0 * sk / n as wind_direction_10m,
  s / (1000 * n) as wind_speed_10m, s / 10000 as rain,
  mxk % 4 as weather_code, mx / 1000 as wind_gusts_10m,
  sk / n as cloud_cover, 30 + 0.6e0 * sk / n as relative_humidity_2m,
  mx / 100 as pm10, mn / 100 as pm2_5, s / 10 as carbon_monoxide,
  sk / n as nitrogen_dioxide, mxk as sulphur_dioxide, mnk as ozone,
  n as uv_index, users as aerosol_optical_depth, s / (100 * n) as european_aqi
from agg)"""

DIRTY_SQL = PANEL_SQL + """,
dirty as (
select * replace (
  case when hour(date) = 3 then -pm10 else pm10 end as pm10,
  case when hour(date) = 5 then -1 - ozone else ozone end as ozone,
  case when hour(date) = 7 and day(date) % 3 <> 0 then null else rain end as rain,
  case when hour(date) in (1, 2) then null else cloud_cover end as cloud_cover,
  case when hour(date) = 15 and day(date) = 6 then null else lat end as lat,
  case when hour(date) = 9 then european_aqi + 490
       when hour(date) = 11 and day(date) = 4 then null
       when hour(date) = 13 and day(date) = 5 then -european_aqi
       else european_aqi end as european_aqi)
from panel)"""


def r6(value: Column) -> Column:
    """Round to six places; NaN stays. The small shift keeps exact halves from falling either way by the last bit."""
    return F.when(F.isnan(value), value).otherwise(F.floor(value * 1e6 + 0.5001) / 1e6)


def s6(expression: str) -> str:
    return f"floor(({expression}) * 1e6 + 0.5001e0) / 1e6"


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: r6(F.col(c)) for c in columns})
