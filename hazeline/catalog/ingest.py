"""Source, table and data-quality queries."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazeline.catalog import sql
from hazeline.catalog.features import complete_frame, feature_rows, thinned
from hazeline.catalog.panel import DIRTY_SQL, PANEL_SQL, air, dirty_panel, panel, r6, rounded, s6, weather
from hazeline.catalog.registration import query
from hazeline.functions.measures import aqi_band, health_tier
from hazeline.operators import quality
from hazeline.operators.forecast import history
from hazeline.plans.ingest import backfill, refresh
from hazeline.schema import AIR_VARIABLES, FEATURE_SCHEMA, KEYS, MEASURES, RAW_COLUMNS, RAW_SCHEMA, WEATHER_VARIABLES
from hazeline.session import scratch_path, written
from hazeline.sources.cities import locate, unknown_cities
from hazeline.sources.feature_table import FeatureTable, training_snapshot
from hazeline.sources.files import merge_readings, read_csv, write_csv
from hazeline.sources import landed
from hazeline.sources.payloads import explode_hourly, latest_reading, merge_current, to_payloads
from hazeline.streaming.current import follow_current, read_current
from hazeline.streaming.refresh import refresh_stream

# ---- sources ----------------------------------------------------------------

# Station -> time zone.
ZONES = {
    "Lahore": "Asia/Karachi", "Karachi": "Asia/Karachi", "Delhi": "Asia/Kolkata",
    "Beijing": "Asia/Shanghai", "London": "Europe/London",
}


@query("explode_hourly_payload", PANEL_SQL + f""",
days as (select distinct city, lat, lon, date_trunc('day', date) as day from panel),
hours as (select city, lat, lon, day + to_hours(cast(h as int)) as utc from days, range(24) as r(h))
select h.utc as date, h.utc + case h.city when 'Beijing' then interval 480 minute when 'Delhi' then interval 330 minute
    when 'London' then interval 0 minute else interval 300 minute end as local_date, h.city, h.lat, h.lon,
  {', '.join(f'p.{c}' for c in AIR_VARIABLES)}
from hours h left join panel p on p.city = h.city and p.date = h.utc""")
def explode_hourly_payload(spark, sf_dir):
    zone = F.element_at(F.create_map(*[F.lit(x) for pair in ZONES.items() for x in pair]), F.col("city"))
    return explode_hourly(to_payloads(air(spark, sf_dir), AIR_VARIABLES, zone), AIR_VARIABLES)


# Landed payload files: a broken line for each Sunday of Delhi, a wrong length for each fifth day of London, no such zone
# for Beijing on days that seven divides.
def land_payloads(spark, sf_dir) -> str:
    path = scratch_path(spark, "landing")
    zone = F.element_at(F.create_map(*[F.lit(x) for pair in ZONES.items() for x in pair]), F.col("city"))
    rows = landed.to_hourly_payloads(to_payloads(air(spark, sf_dir), AIR_VARIABLES, zone), AIR_VARIABLES)
    day = F.to_date(F.timestamp_seconds("hourly.time"))
    in_london = (F.col("city") == "London") & (F.dayofmonth(day) % 5 == 0)
    short = F.col("hourly").withField("ozone", F.when(in_london, F.slice("hourly.ozone", 1, 23)).otherwise(F.col("hourly.ozone")))
    lost = (F.col("city") == "Beijing") & (F.dayofmonth(day) % 7 == 0)
    rows = rows.withColumns({"hourly": short, "timezone": F.when(lost, "Nowhere/Land").otherwise(F.col("timezone"))})
    line = F.to_json(F.struct("city", "latitude", "longitude", "timezone", "hourly"))
    cut = (F.col("city") == "Delhi") & (F.weekday(day) == 6)
    rows.select(F.when(cut, F.substring(line, 1, 60)).otherwise(line).alias("value")).write.text(path)
    return path


LANDED_SQL = PANEL_SQL + """,
days as (select distinct city, lat, lon, cast(date as date) as day from panel),
judged as (select *, case when city = 'Delhi' and isodow(day) = 7 then 'not a payload' when city = 'Beijing' and day(day) % 7 = 0 then 'unknown zone'
  when city = 'London' and day(day) % 5 = 0 then 'arrays of other lengths than the steps' end as reason from days)"""


@query("ingest_payloads", LANDED_SQL + f"""
select cast(j.day as timestamp) + to_hours(cast(h as int)) as date, j.city, j.lat, j.lon, {', '.join(f'p.{c}' for c in AIR_VARIABLES)}
from judged j cross join range(24) as r(h) left join panel p on p.city = j.city and p.date = cast(j.day as timestamp) + to_hours(cast(h as int))
where j.reason is null""")
def ingest_payloads(spark, sf_dir):
    """Payload files to table rows, twice: the second run changes nothing."""
    path, rejected = land_payloads(spark, sf_dir), scratch_path(spark, "rejected")
    table = raw_table(spark, [*KEYS, *AIR_VARIABLES])
    for _ in range(2):
        landed.ingest(spark, path, table, AIR_VARIABLES, rejected)
    return table.read().select(*KEYS, *AIR_VARIABLES)


@query("rejected_payloads", LANDED_SQL + """
select reason, case when reason <> 'not a payload' then city end as city, count(*) as n from judged where reason is not null group by 1, 2""")
def rejected_payloads(spark, sf_dir):
    payloads = landed.reader(spark, landed.hourly_schema(AIR_VARIABLES)).load(land_payloads(spark, sf_dir))
    _, bad = landed.sorted_out(written(payloads, "payloads"), "hourly", AIR_VARIABLES)
    return bad.groupBy("reason", F.when(F.col("reason") != "not a payload", F.col("city")).alias("city")).agg(F.count("*").alias("n"))


@query("current_stream", PANEL_SQL + f"""
select date + case city when 'Beijing' then interval 480 minute when 'Delhi' then interval 330 minute
    when 'London' then interval 0 minute else interval 300 minute end as date, city, lat, lon, {', '.join(f'{c} as now_{c}' for c in AIR_VARIABLES)}
from (select *, row_number() over (partition by city order by date desc) as rn from panel) where rn = 1""")
def current_stream(spark, sf_dir):
    """The last hours arrive first, then all others, and a few again."""
    base = scratch_path(spark, "current")
    zone = F.element_at(F.create_map(*[F.lit(x) for pair in ZONES.items() for x in pair]), F.col("city"))
    current = F.struct(F.unix_seconds(F.col("date").cast("timestamp")).alias("time"), *AIR_VARIABLES)
    rows = air(spark, sf_dir).select("date", "city", F.col("lat").alias("latitude"), F.col("lon").alias("longitude"), zone.alias("timezone"), current.alias("current"))
    cut = F.lit("2024-01-20").cast("timestamp_ntz")
    for part in (rows.where(F.col("date") >= cut), rows.where(F.col("date") < cut), rows.where(F.hour("date") == 3)):
        part.drop("date").write.mode("append").json(f"{base}/landing")
        follow_current(spark, f"{base}/landing", AIR_VARIABLES, f"{base}/table", f"{base}/checkpoint", prefix="now_").awaitTermination()
    return read_current(spark, f"{base}/table")


@query("latest_reading", PANEL_SQL + f"""
select city, date, {', '.join(AIR_VARIABLES)}
from (select *, row_number() over (partition by city order by date desc) as rn from panel) where rn = 1""")
def latest(spark, sf_dir):
    return latest_reading(air(spark, sf_dir)).select("city", "date", *AIR_VARIABLES)


@query("current_merged", PANEL_SQL + f""",
w as (select * from (select *, row_number() over (partition by city order by date desc) as rn from panel
  where hour(date) < 20) where rn = 1),
a as (select * from (select *, row_number() over (partition by city order by date desc) as rn from panel) where rn = 1)
select a.city, a.date, a.lat, a.lon, {', '.join(f'w.{c}' for c in WEATHER_VARIABLES)},
  {', '.join(f'a.{c}' for c in AIR_VARIABLES)} from w join a on w.city = a.city""")
def current_merged(spark, sf_dir):
    older = latest_reading(weather(spark, sf_dir).where(F.hour("date") < 20))
    return merge_current(older, latest_reading(air(spark, sf_dir)))


@query("scan_range", PANEL_SQL + f"""
select {', '.join(RAW_COLUMNS)} from panel where cast(date as date) between date '2024-01-05' and date '2024-01-12'""")
def scan_range(spark, sf_dir):
    return panel(spark, sf_dir, days=("2024-01-05", "2024-01-12")).select(*RAW_COLUMNS)


@query("csv_roundtrip", PANEL_SQL + f"\nselect {', '.join(RAW_COLUMNS)} from panel")
def csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "csv")
    write_csv(panel(spark, sf_dir).select(*RAW_COLUMNS), path)
    return read_csv(spark, path)


@query("merge_weather_air", PANEL_SQL + f"\nselect {', '.join(RAW_COLUMNS)} from panel")
def merged(spark, sf_dir):
    return merge_readings(weather(spark, sf_dir), air(spark, sf_dir))


# Names in mixed case and with blanks around them, and some that no table knows.
def asked_cities(spark, sf_dir):
    hour = F.hour("date")
    name = (
        F.when(hour % 4 == 0, F.upper("city")).when(hour % 4 == 1, F.concat(F.lit("  "), "city", F.lit(" ")))
        .when(hour % 4 == 2, F.col("city")).otherwise(F.concat(F.lit("Port "), "city"))
    )
    return panel(spark, sf_dir).select("date", name.alias("city"))


ASKED_SQL = PANEL_SQL + """,
asked as (select date, lat, lon, hour(date) % 4 as q, case hour(date) % 4 when 0 then upper(city)
  when 1 then '  ' || city || ' ' when 2 then city else 'Port ' || city end as city from panel)"""


@query("resolve_city", ASKED_SQL + """
select city, date, case when q < 3 then lat end as lat, case when q < 3 then lon end as lon from asked""")
def resolve_city(spark, sf_dir):
    return locate(asked_cities(spark, sf_dir))


@query("unknown_cities", ASKED_SQL + "\nselect distinct city from asked where q = 3")
def unknown(spark, sf_dir):
    return unknown_cities(asked_cities(spark, sf_dir))


# ---- tables -----------------------------------------------------------------

RAW_TABLE_COLUMNS = ["date", "city", "lat", "lon", "pm10", "european_aqi"]


def raw_table(spark, columns) -> FeatureTable:
    schema = T.StructType([f for f in RAW_SCHEMA.fields if f.name in columns])
    return FeatureTable.get_or_create(spark, scratch_path(spark, "tables"), "readings", 1, schema)


@query("append_columns", PANEL_SQL + """
select date, city, lat, lon, pm10, european_aqi,
  case when date >= timestamp '2024-01-15' then ozone end as ozone from panel""")
def append_columns(spark, sf_dir):
    table = raw_table(spark, RAW_TABLE_COLUMNS)
    rows = panel(spark, sf_dir)
    cut = F.lit("2024-01-15").cast("timestamp_ntz")
    table.upsert(rows.where(F.col("date") < cut))
    table.append_columns([RAW_SCHEMA["ozone"]])
    table.upsert(rows.where(F.col("date") >= cut))
    return table.read()


@query("upsert_features", PANEL_SQL + """
select date, city, lat, lon, pm10,
  case when date >= timestamp '2024-01-14' then european_aqi + 1 else european_aqi end as european_aqi from panel""")
def upsert_features(spark, sf_dir):
    table = raw_table(spark, RAW_TABLE_COLUMNS)
    rows = panel(spark, sf_dir)
    table.upsert(rows.where(F.col("date") < F.lit("2024-01-20").cast("timestamp_ntz")))
    newer = rows.where(F.col("date") >= F.lit("2024-01-14").cast("timestamp_ntz"))
    table.upsert(newer.withColumn("european_aqi", F.col("european_aqi") + 1))
    return table.read()


def feature_table(spark, name="features") -> FeatureTable:
    return FeatureTable.get_or_create(spark, scratch_path(spark, "tables"), name, 1, FEATURE_SCHEMA)


@query("training_snapshot", sql.engineered() + "\n" + sql.feature_rows("complete") + """
where cast(date as date) between date '2024-01-16' and date '2024-01-24'""")
def snapshot(spark, sf_dir):
    table = feature_table(spark)
    table.upsert(complete_frame(spark, sf_dir))
    _, rows = training_snapshot(table, "2024-01-16", "2024-01-24", "training")
    return feature_rows(rows)


RANGE_SQL = PANEL_SQL + """,
recent as (select * from panel where cast(date as date) between date '2024-01-14' and date '2024-01-30')"""


@query("incremental_features", sql.engineered("recent", RANGE_SQL) + "\n" + sql.feature_rows("complete"))
def incremental_features(spark, sf_dir):
    table = feature_table(spark)
    refresh(weather(spark, sf_dir), air(spark, sf_dir), table, today=date(2024, 1, 31))
    return feature_rows(table.read())


@query("backfill_features", sql.engineered() + "\n" + sql.feature_rows("complete"))
def backfill_rows(spark, sf_dir):
    table = feature_table(spark)
    backfill(weather(spark, sf_dir), air(spark, sf_dir), table, "2024-01-01", "2024-01-30")
    return feature_rows(table.read())


@query("streaming_refresh", sql.engineered() + "\n" + sql.feature_rows("complete"))
def streaming_refresh(spark, sf_dir):
    return streamed(spark, panel(spark, sf_dir))


def streamed(spark, rows):
    base = scratch_path(spark, "stream")
    rows = rows.select(*RAW_COLUMNS)
    raw = FeatureTable.get_or_create(spark, f"{base}/tables", "raw", 1, RAW_SCHEMA, counted=True)
    features = FeatureTable.get_or_create(spark, f"{base}/tables", "features", 1, FEATURE_SCHEMA)
    cut = F.lit("2024-01-22").cast("timestamp_ntz")
    for part in (rows.where(F.col("date") < cut), rows.where(F.col("date") >= cut)):
        part.write.mode("append").parquet(f"{base}/landing")
        refresh_stream(spark, f"{base}/landing", raw, features, f"{base}/checkpoint").awaitTermination()
    return feature_rows(features.read())


THIN_SQL = PANEL_SQL + """,
thin as (select * from panel where (hour(date) * 7 + day(date) * 5) % 10 < 6 and date <> timestamp '2024-01-22 00:00:00')"""


@query("streaming_refresh_gaps", sql.engineered("thin", THIN_SQL) + "\n" + sql.feature_rows("complete"))
def streaming_refresh_gaps(spark, sf_dir):
    """Four hours in ten are missing, so frames reach further back in days; the stream still equals one batch."""
    return streamed(spark, panel(spark, sf_dir).where((F.hour("date") * 7 + F.dayofmonth("date") * 5) % 10 < 6).where(F.col("date") != F.lit("2024-01-22").cast("timestamp_ntz")))


# ---- quality ----------------------------------------------------------------

_checks = "\nunion all ".join(
    f"select city, date, '{c}' as \"column\", "
    + (f"case when {c} is null then 'required' when {c} < 0 then 'non_negative' when {c} > 500 then 'at_most_500' end"
       if c == "european_aqi" else f"case when {c} < 0 then 'non_negative' end")
    + f" as rule, {s6(c)} as value from dirty"
    for c in AIR_VARIABLES
)


_missing = " ".join(f"union all select city, date, '{c}', 'required', null from dirty where {c} is null" for c in KEYS)


@query("violations", DIRTY_SQL + f"\nselect * from ({_checks}) where rule is not null {_missing}")
def violations(spark, sf_dir):
    found = quality.violations(dirty_panel(spark, sf_dir))
    return rounded(found, "value").select("city", "date", "column", "rule", "value")


_rates = "\nunion all ".join(
    f"select '{c}' as \"column\", avg(cast({c} is null as int)) * 100 as p from dirty" for c in RAW_COLUMNS
)


@query("null_rates", DIRTY_SQL + f"""
select "column", {s6('p')} as null_percent, p > 5 as failed from ({_rates})""")
def null_rates(spark, sf_dir):
    return rounded(quality.null_rates(dirty_panel(spark, sf_dir).select(*RAW_COLUMNS)), "null_percent")


@query("aqi_out_of_range", DIRTY_SQL + f"""
select city, date, {s6('european_aqi')} as european_aqi from dirty
where not coalesce(european_aqi between 0 and 500, false)""")
def out_of_range(spark, sf_dir):
    return rounded(
        quality.aqi_out_of_range(dirty_panel(spark, sf_dir)).select("city", "date", "european_aqi"), "european_aqi"
    )


@query("extreme_aqi", DIRTY_SQL + f"""
select city, date, {s6('european_aqi')} as european_aqi from dirty where european_aqi > 300""")
def extreme(spark, sf_dir):
    return rounded(quality.extreme_aqi(dirty_panel(spark, sf_dir)).select("city", "date", "european_aqi"),
                   "european_aqi")


@query("gaps", PANEL_SQL + """,
thin as (select * from panel where day(date) % 2 = 0 or hour(date) not between 8 and 12),
steps as (select city, date, lag(date) over (partition by city order by date) as previous from thin)
select city, date, previous from steps where date - previous > interval 3 hour""")
def gap_rows(spark, sf_dir):
    return quality.gaps(thinned(panel(spark, sf_dir)))


_shifted = """,
reference as (select * from panel where date < timestamp '2024-01-25'),
recent as (select * replace (uv_index + 100 as uv_index, rain * 1.5 as rain)
  from panel where date >= timestamp '2024-01-25')"""
_shift_rows = "\nunion all ".join(
    f"select '{c}' as \"column\", (select avg({c}) from reference) as mean, "
    f"(select stddev_samp({c}) from reference) as std, (select avg({c}) from recent) as current_mean"
    for c in MEASURES
)


def then_and_now(spark, sf_dir):
    """Reference days, and recent days with two columns moved."""
    rows, cut = written(panel(spark, sf_dir), "panel"), F.lit("2024-01-25").cast("timestamp_ntz")
    moved = {"uv_index": F.col("uv_index") + 100, "rain": F.col("rain") * 1.5}
    return rows.where(F.col("date") < cut), rows.where(F.col("date") >= cut).withColumns(moved)


@query("mean_drift", PANEL_SQL + _shifted + f"""
select "column", {sql.rounded('mean', 'std', 'current_mean')}, {s6('abs(current_mean - mean) / std')} as shift,
  abs(current_mean - mean) / std > 3 as drifted from ({_shift_rows}) where std > 0""")
def mean_drift(spark, sf_dir):
    return rounded(quality.mean_shift(*then_and_now(spark, sf_dir)), "mean", "std", "current_mean", "shift")


# ---- labels -----------------------------------------------------------------

@query("aqi_band", PANEL_SQL + f"""
select city, date, {s6('european_aqi')} as european_aqi,
  case when european_aqi <= 50 then 'Good' when european_aqi <= 100 then 'Moderate'
    when european_aqi <= 150 then 'Unhealthy for Sensitive Groups' when european_aqi <= 200 then 'Unhealthy'
    when european_aqi <= 300 then 'Very Unhealthy' else 'Hazardous' end as label,
  case when european_aqi <= 50 then 'good' when european_aqi <= 100 then 'moderate' else 'bad' end as tier
from panel""")
def bands(spark, sf_dir):
    aqi = F.col("european_aqi")
    return panel(spark, sf_dir).select(
        "city", "date", r6(aqi).alias("european_aqi"), aqi_band(aqi).alias("label"), health_tier(aqi).alias("tier")
    )


@query("history", DIRTY_SQL + f"""
select city, date, {s6('european_aqi')} as european_aqi from dirty where european_aqi is not null""")
def history_rows(spark, sf_dir):
    return rounded(history(dirty_panel(spark, sf_dir)), "european_aqi")
