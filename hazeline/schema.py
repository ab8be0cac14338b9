"""Names, types and fixed values shared by every module."""

from __future__ import annotations

from pyspark.sql import types as T

# Variable lists, in source order.
WEATHER_VARIABLES = [
    "temperature_2m", "wind_direction_10m", "wind_speed_10m", "rain",
    "weather_code", "wind_gusts_10m", "cloud_cover", "relative_humidity_2m",
]
AIR_VARIABLES = [
    "pm10", "pm2_5", "carbon_monoxide", "nitrogen_dioxide", "sulphur_dioxide",
    "ozone", "uv_index", "aerosol_optical_depth", "european_aqi",
]
KEYS = ["date", "city", "lat", "lon"]
MEASURES = WEATHER_VARIABLES + AIR_VARIABLES
RAW_COLUMNS = KEYS + MEASURES

# City -> (lat, lon).
CITY_COORDINATES = {
    "lahore": (31.558, 74.351),
    "karachi": (24.8607, 67.0011),
    "islamabad": (33.6844, 73.0479),
    "delhi": (28.6139, 77.2090),
    "beijing": (39.9042, 116.4074),
    "new york": (40.7128, -74.0060),
    "london": (51.5074, -0.1278),
    "los angeles": (34.0522, -118.2437),
}

# Index ceiling -> label; above the last ceiling is "Hazardous" too.
AQI_BANDS = [
    (50, "Good"),
    (100, "Moderate"),
    (150, "Unhealthy for Sensitive Groups"),
    (200, "Unhealthy"),
    (300, "Very Unhealthy"),
    (500, "Hazardous"),
]

# Feature windows, limits and thresholds.
LAG_HOURS = [1, 3, 6, 24]
ROLLING_HOURS = [4, 6, 12, 24]
DAY_HOURS = 24
WEEK_HOURS = 168
EWM_SPAN = 6
OZONE_FLOOR = 5.0
PM10_OFFSET = 1e-6
FORECAST_HORIZON = 3
LOOKBACK_DAYS = 16
SEQUENCE_LENGTH = 24
AQI_LIMIT = 500.0
EXTREME_AQI = 300.0
MAX_NULL_PERCENT = 5.0
MAX_GAP_HOURS = 3
MEAN_SHIFT_LIMIT = 3.0
DRIFT_SHARE_LIMIT = 0.3
ALERT_THRESHOLD = 300.0
DECAY_LIMIT_PERCENT = 20.0
INTERVAL_Z = 1.96
MISSING_RMSE = 999999.0
CAPPED_COLUMNS = ["pm10", "pm2_5", "carbon_monoxide", "nitrogen_dioxide", "sulphur_dioxide"]
HISTOGRAM_COLUMNS = [
    "pm10", "pm2_5", "carbon_monoxide", "nitrogen_dioxide", "sulphur_dioxide",
    "ozone", "wind_speed_10m", "rain", "temperature_2m", "relative_humidity_2m",
]

CALENDAR_FEATURES = ["hour", "day_of_week", "month", "is_weekend"]
CYCLE_FEATURES = ["hour_sin", "hour_cos", "day_sin", "day_cos", "month_sin", "month_cos"]
WIND_FEATURES = ["wind_u", "wind_v"]
RATIO_FEATURES = ["pm_ratio", "no2_o3_ratio"]
LAG_FEATURES = [f"aqi_lag_{k}h" for k in LAG_HOURS]
ROLLING_FEATURES = [f"aqi_roll_{s}_{k}h" for k in ROLLING_HOURS for s in ("mean", "std")]
FEATURES = (
    CALENDAR_FEATURES + CYCLE_FEATURES + WIND_FEATURES + RATIO_FEATURES
    + ["temp_trend_7d", "rain_accum_7d"] + LAG_FEATURES + ROLLING_FEATURES
    + ["aqi_ewm_6h", "aqi_change_1h", "aqi_change_24h"]
)
MODEL_FEATURES = MEASURES + FEATURES


def targets(horizon: int = FORECAST_HORIZON) -> list[str]:
    return [f"aqi_next_{day}d" for day in range(1, horizon + 1)]


# `date` is kept zone-free in UTC, so no result depends on the session time zone.
RAW_SCHEMA = T.StructType(
    [
        T.StructField("date", T.TimestampNTZType(), False),
        T.StructField("city", T.StringType(), False),
        T.StructField("lat", T.DoubleType(), False),
        T.StructField("lon", T.DoubleType(), False),
    ]
    + [T.StructField(c, T.DoubleType(), True) for c in MEASURES]
)

FEATURE_SCHEMA = T.StructType(
    RAW_SCHEMA.fields
    + [T.StructField(c, T.IntegerType() if c in CALENDAR_FEATURES else T.DoubleType(), True) for c in FEATURES]
    + [T.StructField(c, T.DoubleType(), True) for c in targets()]
)

REGISTRY_SCHEMA = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("version", T.IntegerType()),
        T.StructField("horizon", T.IntegerType()),
        T.StructField("r2", T.DoubleType()),
        T.StructField("mae", T.DoubleType()),
        T.StructField("mse", T.DoubleType()),
        T.StructField("rmse", T.DoubleType()),
        T.StructField("skill_vs_naive", T.DoubleType()),
        T.StructField("path", T.StringType()),
        T.StructField("created_at", T.TimestampNTZType()),
    ]
)
