"""The 31 engineered features and the lead targets."""

from __future__ import annotations

from functools import reduce
from operator import add, and_

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from hazeline.functions.calendar import calendar_columns, cycle_columns
from hazeline.functions.measures import ratio_columns, wind_columns
from hazeline.operators.series import CHUNK_ROWS, Stage, along_series
from hazeline.schema import DAY_HOURS, EWM_SPAN, FEATURES, FORECAST_HORIZON, LAG_HOURS, ROLLING_HOURS, WEEK_HOURS, targets

AQI = "european_aqi"
WARMUP_ROWS = 2 * WEEK_HOURS - 1  # rows before the first one that has every feature


def full(agg: Column, value: str, frame: WindowSpec, size: int) -> Column:
    """Keep an aggregate only where the frame holds `size` non-null values."""
    return F.when(F.count(value).over(frame) == size, agg.over(frame))


def lag_columns(w: WindowSpec) -> dict[str, Column]:
    return {f"aqi_lag_{k}h": F.lag(AQI, k).over(w) for k in LAG_HOURS}


def roll_mean_columns(w: WindowSpec) -> dict[str, Column]:
    """Frames end one row back, so a row never sees its own value."""
    return {f"aqi_roll_mean_{k}h": full(F.avg(AQI), AQI, w.rowsBetween(-k, -1), k) for k in ROLLING_HOURS}


def roll_std_columns(w: WindowSpec) -> dict[str, Column]:
    return {f"aqi_roll_std_{k}h": full(F.stddev_samp(AQI), AQI, w.rowsBetween(-k, -1), k) for k in ROLLING_HOURS}


# Week-long frames are built from days: Spark walks a sliding frame again for
# every row, so a sum over 24 rows in one stage and seven offset reads of it in
# the next replace 168 updates per row by 24, and nothing is ever subtracted.

def day_parts(*columns: str) -> Stage:
    def stage(w: WindowSpec) -> dict[str, Column]:
        day = w.rowsBetween(1 - DAY_HOURS, 0)
        out = {}
        for c in columns:
            out[f"_{c}_sum"] = F.sum(c).over(day)
            out[f"_{c}_n"] = F.count(c).over(day)
        return out

    return stage


def behind(column: str, rows: int, w: WindowSpec) -> Column:
    return F.coalesce(F.lag(column, rows).over(w) if rows else F.col(column), F.lit(0))


def week_total(column: str, w: WindowSpec, weeks_back: int = 0) -> Column:
    """Sum over 168 rows, where all of them have a value."""
    end = weeks_back * WEEK_HOURS
    days = range(end, end + WEEK_HOURS, DAY_HOURS)
    present = reduce(add, [behind(f"_{column}_n", k, w) for k in days])
    return F.when(present == WEEK_HOURS, reduce(add, [behind(f"_{column}_sum", k, w) for k in days]))


def temp_trend_columns(w: WindowSpec) -> dict[str, Column]:
    """Weekly mean now less the weekly mean a week ago."""
    now, then = (week_total("temperature_2m", w, back) / WEEK_HOURS for back in (0, 1))
    return {"temp_trend_7d": now - then}


def rain_columns(w: WindowSpec) -> dict[str, Column]:
    return {"rain_accum_7d": week_total("rain", w)}


def weekly_mean_columns(w: WindowSpec) -> dict[str, Column]:
    return {"aqi_mean_7d": week_total(AQI, w) / WEEK_HOURS}


def change_columns(w: WindowSpec) -> dict[str, Column]:
    return {f"aqi_change_{k}h": F.lag(AQI, 1).over(w) - F.lag(AQI, 1 + k).over(w) for k in (1, 24)}


def target_columns(w: WindowSpec, horizon: int = FORECAST_HORIZON) -> dict[str, Column]:
    return {name: F.lead(AQI, 24 * day).over(w) for day, name in enumerate(targets(horizon), start=1)}


# Exponentially weighted mean: sum(decay^age * x) / sum(decay^age) over the rows
# with a value. Both sums are built in two steps like the weeks above: 11 rows
# by offset reads, then 10 such parts, each decayed by its age.
EWM_DECAY = 1 - 2 / (EWM_SPAN + 1)
EWM_PART, EWM_PARTS = 11, 10
EWM_ROWS = EWM_PART * EWM_PARTS  # decay^110 is below half a unit in the last place


def ewm_parts(w: WindowSpec) -> dict[str, Column]:
    past = [(EWM_DECAY ** k, F.lag(AQI, k).over(w) if k else F.col(AQI)) for k in range(EWM_PART)]
    return {
        "_ewm_sum": reduce(add, [F.coalesce(x * weight, F.lit(0.0)) for weight, x in past]),
        "_ewm_weight": reduce(add, [F.when(x.isNotNull(), weight).otherwise(0.0) for weight, x in past]),
    }


def ewm_columns(w: WindowSpec) -> dict[str, Column]:
    def total(column: str) -> Column:
        parts = [behind(column, EWM_PART * k, w) * EWM_DECAY ** (EWM_PART * k) for k in range(EWM_PARTS)]
        return reduce(add, parts)

    weight = total("_ewm_weight")
    # a row without a reading keeps the mean of the last row with one, however far back: see `carried`
    return {"aqi_ewm_6h": F.when(F.col(AQI).isNotNull(), total("_ewm_sum") / weight)}


def add_ewm(df: DataFrame, chunk_rows: int | None = CHUNK_ROWS) -> DataFrame:
    out = along_series(
        df, ewm_parts, ewm_columns, back=EWM_ROWS - 1, chunk_rows=chunk_rows, carried=["aqi_ewm_6h"])
    return out.select(*df.columns, "aqi_ewm_6h")


def add_features(
    df: DataFrame, horizon: int = FORECAST_HORIZON, chunk_rows: int | None = CHUNK_ROWS
) -> DataFrame:
    """Raw panel in, 31 features and `horizon` targets added.

    All frames share one partitioning and order, so the panel is shuffled and sorted once.
    """
    row_wise = {**calendar_columns(), **cycle_columns(), **wind_columns(), **ratio_columns()}

    def parts(w: WindowSpec) -> dict[str, Column]:
        return {**day_parts("temperature_2m", "rain")(w), **ewm_parts(w)}

    def frames(w: WindowSpec) -> dict[str, Column]:
        return {
            **temp_trend_columns(w), **rain_columns(w), **lag_columns(w), **roll_mean_columns(w),
            **roll_std_columns(w), **ewm_columns(w), **change_columns(w), **target_columns(w, horizon),
        }

    # Row-wise columns come last: they would only widen the shuffle.
    windowed = along_series(
        df, parts, frames, back=WARMUP_ROWS, ahead=24 * horizon, chunk_rows=chunk_rows, carried=["aqi_ewm_6h"])
    return windowed.withColumns(row_wise).select(*df.columns, *FEATURES, *targets(horizon))


def add_gap_free_hours(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Insert a row of nulls for each missing hour, so that row offsets equal hours.

    The hours of a series lie at the minute of its readings; readings at several minutes are an error.
    """
    keys = keys or ["city", "lat", "lon"]
    past = F.minute("date") * 60 + F.second("date")
    spans = df.groupBy(*keys).agg(
        F.min("date").alias("_from"), F.max("date").alias("_to"), F.min(past).alias("_past"), F.max(past).alias("_most"))
    # One row per (series, month) first, so that no task expands a whole series.
    months = spans.select(
        *keys, "_from", "_to", "_past", "_most",
        F.explode(F.expr("sequence(cast(trunc(_from, 'MM') as date), cast(_to as date), interval 1 month)")).alias("_month"),
    ).repartition(*keys, "_month")
    past = F.expr("make_dt_interval(0, 0, 0, _past)")
    mixed = F.raise_error(F.lit("a series has readings at different minutes of the hour"))
    begin = F.when(F.col("_past") != F.col("_most"), mixed).otherwise(F.greatest(F.col("_from"), F.col("_month").cast("timestamp_ntz") + past))
    end = F.least(F.col("_to"), F.expr("cast(add_months(_month, 1) as timestamp_ntz) - interval 1 hour") + past)
    hours = months.select(*keys, F.explode(F.sequence(begin, end, F.expr("interval 1 hour"))).alias("date"))
    return hours.join(df, [*keys, "date"], "left").select(*df.columns)


def drop_incomplete(df: DataFrame, columns: list[str]) -> DataFrame:
    """Keep rows with a value in every column.

    One null test per column, not `na.drop`: its single predicate over fifty
    columns makes the optimizer derive a variant for every subset of renamed
    columns, and planning runs out of memory.
    """
    return df.where(reduce(and_, [F.col(c).isNotNull() for c in columns]))


def complete_rows(df: DataFrame) -> DataFrame:
    """Drop rows with a missing feature; targets may be missing."""
    return drop_incomplete(df, [c for c in df.columns if not c.startswith("aqi_next_")])


def feature_names(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in ("date", "city")]


class PanelFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """`add_features` as a pipeline stage."""

    horizon = Param(Params._dummy(), "horizon", "days ahead to build targets for", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, horizon: int = FORECAST_HORIZON):
        super().__init__()
        self._setDefault(horizon=FORECAST_HORIZON)
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return add_features(dataset, self.getOrDefault("horizon"))

    def output_names(self, dataset: DataFrame) -> list[str]:
        new = FEATURES + targets(self.getOrDefault("horizon"))
        return feature_names(dataset) + [c for c in new if c not in dataset.columns]
