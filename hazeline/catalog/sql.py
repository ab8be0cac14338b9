"""Check SQL shared by several queries: engineered features, splits, candidate scores."""

from __future__ import annotations

from hazeline.catalog.panel import PANEL_SQL, s6
from hazeline.schema import EWM_SPAN, FEATURES, LAG_HOURS, MEASURES, ROLLING_HOURS, targets

W = "over (partition by city order by date"


def frame(agg: str, column: str, start: str, end: str, size: int) -> str:
    rows = f"{W} rows between {start} and {end})"
    return f"case when count({column}) {rows} = {size} then {agg}({column}) {rows} end"


def lag(k: int) -> str:
    return f"lag(european_aqi, {k}) {W})"


_decay = f"{1 - 2 / (EWM_SPAN + 1)!r}e0"
_recent = f"list(european_aqi) {W} rows between 127 preceding and current row)"
EWM = (
    f"list_reduce({_recent}, lambda a, b: a * {_decay} + b)"
    f" / list_reduce(list_transform({_recent}, lambda x: 1e0), lambda a, b: a * {_decay} + b)"
)

CALENDAR = {
    "hour": "cast(hour(date) as int)",
    "day_of_week": "cast(isodow(date) - 1 as int)",
    "month": "cast(month(date) as int)",
    "is_weekend": "cast(isodow(date) >= 6 as int)",
}
CYCLES = {
    "hour_sin": "sin(2 * pi() * hour(date) / 24)", "hour_cos": "cos(2 * pi() * hour(date) / 24)",
    "day_sin": "sin(2 * pi() * (isodow(date) - 1) / 7)", "day_cos": "cos(2 * pi() * (isodow(date) - 1) / 7)",
    "month_sin": "sin(2 * pi() * month(date) / 12)", "month_cos": "cos(2 * pi() * month(date) / 12)",
}
WIND = {
    "wind_u": "-wind_speed_10m * sin(radians(wind_direction_10m))",
    "wind_v": "-wind_speed_10m * cos(radians(wind_direction_10m))",
}
RATIOS = {
    "pm_ratio": "pm2_5 / (pm10 + 1e-6)",
    "no2_o3_ratio": "nitrogen_dioxide / case when ozone < 5 then 5e0 else ozone end",
}
TREND = {
    "temp_trend_7d": frame("avg", "temperature_2m", "167 preceding", "current row", 168)
    + " - " + frame("avg", "temperature_2m", "335 preceding", "168 preceding", 168)
}
RAIN = {"rain_accum_7d": frame("sum", "rain", "167 preceding", "current row", 168)}
LAGS = {f"aqi_lag_{k}h": lag(k) for k in LAG_HOURS}
MEANS = {
    f"aqi_roll_mean_{k}h": frame("avg", "european_aqi", f"{k} preceding", "1 preceding", k) for k in ROLLING_HOURS
}
STDS = {
    f"aqi_roll_std_{k}h": frame("stddev_samp", "european_aqi", f"{k} preceding", "1 preceding", k)
    for k in ROLLING_HOURS
}
EWMS = {"aqi_ewm_6h": EWM}
CHANGES = {"aqi_change_1h": f"{lag(1)} - {lag(2)}", "aqi_change_24h": f"{lag(1)} - {lag(25)}"}
TARGETS = {name: f"lead(european_aqi, {24 * day}) {W})" for day, name in enumerate(targets(), start=1)}
ALL_FEATURES = {
    **CALENDAR, **CYCLES, **WIND, **RATIOS, **TREND, **RAIN, **LAGS, **MEANS, **STDS, **EWMS, **CHANGES, **TARGETS,
}


def columns(expressions: dict[str, str], exact: tuple[str, ...] = tuple(CALENDAR)) -> str:
    return ",\n  ".join(f"{e if n in exact else s6(e)} as {n}" for n, e in expressions.items())


def bare(expressions: dict[str, str]) -> str:
    return ",\n  ".join(f"{e} as {n}" for n, e in expressions.items())


def per_row(expressions: dict[str, str], source: str = "panel", head: str = PANEL_SQL) -> str:
    return f"{head}\nselect city, date,\n  {columns(expressions)}\nfrom {source}"


def engineered(source: str = "panel", head: str = PANEL_SQL) -> str:
    """CTEs up to `eng` (all columns, unrounded) and `complete` (rows with every feature)."""
    present = " and ".join(f"{c} is not null" for c in [*MEASURES, *FEATURES])
    return (
        f"{head},\neng as (select *,\n  {bare(ALL_FEATURES)}\nfrom {source}),\n"
        f"complete as (select * from eng where {present})"
    )


EXACT_COLUMNS = ["city", "date", *MEASURES, *CALENDAR]
ROUNDED_COLUMNS = [c for c in [*FEATURES, *targets()] if c not in CALENDAR]


def feature_rows(source: str = "complete") -> str:
    out = [*EXACT_COLUMNS, *[f"{s6(c)} as {c}" for c in ROUNDED_COLUMNS]]
    return f"select {', '.join(out)} from {source}"


def ranked(source: str, name: str = "ranked") -> str:
    return (
        f"{name} as (select *, row_number() over (order by date, city) - 1 as rk, count(*) over () as total "
        f"from {source})"
    )


IS_TRAIN = "rk < floor(total * (1 - 0.2e0))"
SCORED_SHARE = 0.3
IS_SCORED = f"rk >= floor(total * (1 - {SCORED_SHARE}e0))"

# Simple forecasters and the column each of them reads.
CANDIDATES = {
    "naive": "european_aqi", "lag_day": "aqi_lag_24h", "mean_day": "aqi_roll_mean_24h", "ewm": "aqi_ewm_6h",
}


def predictions(source: str = "ranked", where: str = IS_SCORED, extra: str = "") -> str:
    """`pred`: (model, horizon, city, date, actual, predicted, naive)."""
    parts = [
        f"select '{model}' as model, {h} as horizon, city, date, aqi_next_{h}d as actual, {column} as predicted, "
        f"european_aqi as naive{extra} from {source} where aqi_next_{h}d is not null and {where}"
        for model, column in CANDIDATES.items() for h in (1, 2, 3)
    ]
    return "pred as (" + "\nunion all ".join(parts) + ")"


def scores(by: str, source: str = "pred") -> str:
    """Unrounded scores per group."""
    return f"""(select {by}, count(*) as n, avg(abs(actual - predicted)) as mae, avg((actual - predicted) ** 2) as mse,
  sqrt(avg((actual - predicted) ** 2)) as rmse, 1 - avg((actual - predicted) ** 2) / var_pop(actual) as r2,
  case when avg((actual - naive) ** 2) > 0
    then 1 - sqrt(avg((actual - predicted) ** 2)) / sqrt(avg((actual - naive) ** 2)) end as skill_vs_naive,
  1 - avg((actual - naive) ** 2) / var_pop(actual) as naive_r2, sqrt(avg((actual - naive) ** 2)) as naive_rmse
from {source} group by {by})"""


def rounded(*names: str) -> str:
    return ", ".join(f"{s6(n)} as {n}" for n in names)


CANDIDATE_SCORES = (
    engineered() + ",\n" + ranked("complete") + ",\n" + predictions() + ",\nscored as " + scores("model, horizon")
)
