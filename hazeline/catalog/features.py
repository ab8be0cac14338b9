"""Feature and window queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeline.catalog import sql
from hazeline.catalog.panel import PANEL_SQL, air, panel, r6, rounded, s6, weather
from hazeline.catalog.registration import query
from hazeline.functions.calendar import calendar_columns, cycle_columns
from hazeline.functions.measures import ratio_columns, wind_columns
from hazeline.operators import features as ft
from hazeline.operators.forecast import latest_rows, scorable_cities
from hazeline.operators.sequences import sequence_windows
from hazeline.operators.series import along_series
from hazeline.operators.splits import holdout
from hazeline.operators.targets import delta_target
from hazeline.schema import FEATURES, targets
from hazeline.session import written
from hazeline.sources.files import merge_readings


def engineered_frame(spark, sf_dir, **kw) -> DataFrame:
    return ft.add_features(panel(spark, sf_dir, **kw))


def complete_frame(spark, sf_dir, **kw) -> DataFrame:
    """Complete feature rows, stored once for the passes that follow."""
    return written(ft.complete_rows(engineered_frame(spark, sf_dir, **kw)), "features")


def feature_rows(df: DataFrame) -> DataFrame:
    return rounded(df, *sql.ROUNDED_COLUMNS).select(*sql.EXACT_COLUMNS, *sql.ROUNDED_COLUMNS)


row_wise_queries = {
    "f_calendar": (calendar_columns, sql.CALENDAR, tuple(sql.CALENDAR)),
    "f_cyclical": (cycle_columns, sql.CYCLES, ()),
    "f_wind": (wind_columns, sql.WIND, ()),
    "f_ratios": (ratio_columns, sql.RATIOS, ()),
}


def _register_row_wise(name, columns, expressions, exact):
    def run(spark, sf_dir):
        df = panel(spark, sf_dir).withColumns(columns()).select("city", "date", *expressions)
        return rounded(df, *[c for c in expressions if c not in exact])

    query(name, sql.per_row(expressions))(run)


for _name, _parts in row_wise_queries.items():
    _register_row_wise(_name, *_parts)


# name -> (stages, check expressions, rows back, rows ahead)
window_queries = {
    "f_lags": ([ft.lag_columns], sql.LAGS, 24, 0),
    "f_roll_mean": ([ft.roll_mean_columns], sql.MEANS, 24, 0),
    "f_roll_std": ([ft.roll_std_columns], sql.STDS, 24, 0),
    "f_temp_trend": ([ft.day_parts("temperature_2m"), ft.temp_trend_columns], sql.TREND, ft.WARMUP_ROWS, 0),
    "f_rain_accum": ([ft.day_parts("rain"), ft.rain_columns], sql.RAIN, 167, 0),
    "f_change": ([ft.change_columns], sql.CHANGES, 25, 0),
    "f_targets": ([ft.target_columns], sql.TARGETS, 0, 72),
    "rolling_7d": (
        [ft.day_parts("european_aqi"), ft.weekly_mean_columns],
        {"aqi_mean_7d": sql.frame("avg", "european_aqi", "167 preceding", "current row", 168)},
        167, 0,
    ),
}


def _register_window(name, stages, expressions, back, ahead):
    def run(spark, sf_dir):
        df = panel(spark, sf_dir).select("city", "date", "european_aqi", "temperature_2m", "rain")
        out = along_series(df, *stages, back=back, ahead=ahead)
        return rounded(out, *expressions).select("city", "date", *expressions)

    query(name, sql.per_row(expressions))(run)


for _name, _parts in window_queries.items():
    _register_window(_name, *_parts)


@query("f_ewm", sql.per_row(sql.EWMS))
def f_ewm(spark, sf_dir):
    out = ft.add_ewm(panel(spark, sf_dir).select("city", "date", "european_aqi"))
    return out.select("city", "date", r6(F.col("aqi_ewm_6h")).alias("aqi_ewm_6h"))


@query("engineered", sql.engineered() + "\n" + sql.feature_rows("complete"))
def engineered(spark, sf_dir, **kw):
    merged = merge_readings(weather(spark, sf_dir, **kw), air(spark, sf_dir, **kw))
    return feature_rows(ft.complete_rows(ft.add_features(merged)))


@query("complete_rows", sql.engineered() + """
select city, count(*) as n, min(date) as first_date, max(date) as last_date from complete group by city""")
def complete(spark, sf_dir):
    rows = ft.complete_rows(engineered_frame(spark, sf_dir))
    return rows.groupBy("city").agg(
        F.count("*").alias("n"), F.min("date").alias("first_date"), F.max("date").alias("last_date")
    )


_nulls = """case when (date >= timestamp '2024-01-09 03:00:00' and date < timestamp '2024-01-16 00:00:00') then null else european_aqi end"""


@query("f_ewm_nulls", PANEL_SQL + f""",
n as (select city, date, {_nulls} as x, row_number() over (partition by city order by date) as k from panel),
m as (select a.city, a.date, sum(pow(5e0 / 7, a.k - b.k) * b.x) / sum(pow(5e0 / 7, a.k - b.k)) as mean
  from n a join n b on a.city = b.city and b.k <= a.k and b.x is not null group by a.city, a.date)
select n.city, n.date, {s6('m.mean')} as aqi_ewm_6h from n left join m using (city, date)""")
def f_ewm_nulls(spark, sf_dir):
    """Readings missing for nearly a week: the mean is carried over them."""
    missing = (F.col("date") >= F.lit("2024-01-09 03:00:00").cast("timestamp_ntz")) & (F.col("date") < F.lit("2024-01-16").cast("timestamp_ntz"))
    df = panel(spark, sf_dir).select("city", "date", F.when(~missing, F.col("european_aqi")).alias("european_aqi"))
    out = ft.add_ewm(df, chunk_rows=168)
    return out.select("city", "date", r6(F.col("aqi_ewm_6h")).alias("aqi_ewm_6h"))


@query("hourly_grid_shifted", PANEL_SQL + f""",
thin as (select * replace (case when city = 'Delhi' then date + interval 318 hour + interval 30 minute else date end as date)
  from panel where day(date) % 2 = 0 or hour(date) not between 8 and 12),
spans as (select city, lat, lon, min(date) as a, max(date) as b from thin group by city, lat, lon),
hours as (select city, lat, lon, unnest(generate_series(a, b, interval 1 hour)) as date from spans)
select h.city, h.date, {s6('t.european_aqi')} as european_aqi
from hours h left join thin t on h.city = t.city and h.date = t.date""")
def hourly_grid_shifted(spark, sf_dir):
    """One station reads at half past, over the end of a month."""
    moved = F.when(F.col("city") == "Delhi", F.col("date") + F.expr("interval 318 hours 30 minutes")).otherwise(F.col("date"))
    thin = thinned(panel(spark, sf_dir)).withColumn("date", moved)
    return ft.add_gap_free_hours(thin).select("city", "date", r6(F.col("european_aqi")).alias("european_aqi"))


@query("hourly_grid", PANEL_SQL + f""",
thin as (select * from panel where day(date) % 2 = 0 or hour(date) not between 8 and 12),
spans as (select city, lat, lon, min(date) as a, max(date) as b from thin group by city, lat, lon),
hours as (select city, lat, lon, unnest(generate_series(a, b, interval 1 hour)) as date from spans)
select h.city, h.date, {s6('t.european_aqi')} as european_aqi
from hours h left join thin t on h.city = t.city and h.date = t.date""")
def hourly_grid(spark, sf_dir):
    thin = thinned(panel(spark, sf_dir))
    return ft.add_gap_free_hours(thin).select("city", "date", r6(F.col("european_aqi")).alias("european_aqi"))


def thinned(df: DataFrame) -> DataFrame:
    """The panel without some hours of odd days, for queries about gaps."""
    return df.where((F.dayofmonth("date") % 2 == 0) | ~F.hour("date").between(8, 12))


# ---- targets and sequences --------------------------------------------------

def _register_delta(name, require_all):
    present = " and ".join(
        f"{c} is not null" for c in ([*FEATURES, *targets()] if require_all else [*FEATURES, "aqi_next_1d"])
    )

    def run(spark, sf_dir):
        df = delta_target(engineered_frame(spark, sf_dir), 1, require_all_horizons=require_all)
        return rounded(df.select("city", "date", "target", "target_delta", "aqi_lag_24h"),
                       "target", "target_delta", "aqi_lag_24h")

    query(name, sql.engineered() + f"""
select city, date, {s6('aqi_next_1d')} as target, {s6('aqi_next_1d - european_aqi')} as target_delta,
  {s6('aqi_lag_24h')} as aqi_lag_24h from eng where {present}""")(run)


_register_delta("delta_target", False)
_register_delta("delta_target_all_horizons", True)

SEQUENCE_FEATURES = ["european_aqi", "temperature_2m", "pm10"]


def _sequence_sql(offset: int) -> str:
    target = "european_aqi" if not offset else f"lead(european_aqi, {offset}) over w"
    keep = "" if not offset else "and target is not null"
    return PANEL_SQL + ",\n" + sql.ranked("panel") + f""",
parts as (select *, case when {sql.IS_TRAIN} then 'train' else 'test' end as split from ranked),
seq as (select city, date, split, {target} as target,
    row_number() over w as rn, lag(european_aqi, 23) over w as first_aqi, european_aqi as last_aqi,
    sum(pm10) over (partition by city, split order by date rows between 23 preceding and current row) as pm10_total
  from parts window w as (partition by city, split order by date))
select city, date, split, 24 as steps, 3 as width, {sql.rounded('first_aqi', 'last_aqi', 'pm10_total', 'target')}
from seq where rn >= 24 {keep}"""


def _register_sequences(name, offset):
    def run(spark, sf_dir):
        rows = holdout(panel(spark, sf_dir))
        seq = sequence_windows(
            rows.select("city", "date", "split", *SEQUENCE_FEATURES, F.col("european_aqi").alias("target")),
            SEQUENCE_FEATURES, "target", target_offset=offset,
        )
        steps = F.col("sequence")
        return seq.select(
            "city", "date", "split", F.size(steps).alias("steps"), F.size(steps[0]).alias("width"),
            r6(steps[0][0]).alias("first_aqi"), r6(F.element_at(steps, -1)[0]).alias("last_aqi"),
            r6(F.aggregate(steps, F.lit(0.0), lambda acc, s: acc + s[2])).alias("pm10_total"),
            r6(F.col("target")).alias("target"),
        )

    query(name, _sequence_sql(offset))(run)


_register_sequences("sequence_windows", 0)
_register_sequences("sequence_windows_next", 1)


@query("latest_features", sql.engineered() + """,
newest as (select *, row_number() over (partition by city order by date desc) as rn from complete)
""" + sql.feature_rows("newest") + " where rn = 1")
def latest_features(spark, sf_dir):
    return feature_rows(latest_rows(ft.complete_rows(engineered_frame(spark, sf_dir))))


@query("latest_sequence", PANEL_SQL + f""",
newest as (select *, row_number() over (partition by city order by date desc) as rn from panel)
select city, date, {s6('european_aqi')} as european_aqi from newest where rn <= 24""")
def latest_sequence(spark, sf_dir):
    rows = latest_rows(panel(spark, sf_dir).select("city", "date", "european_aqi"), 24)
    return rounded(rows, "european_aqi")


@query("scorable_cities", PANEL_SQL + """
select city, count(*) as n, count(*) >= 24 as scorable from panel group by city""")
def scorable(spark, sf_dir):
    return scorable_cities(panel(spark, sf_dir))
