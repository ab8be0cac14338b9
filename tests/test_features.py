import numpy as np
import pandas as pd
import pytest
from panels import raw_pandas, sorted_pandas, to_spark
from pyspark.sql import functions as F

from hazeline.operators import features as ft
from hazeline.operators.series import along_series
from hazeline.schema import FEATURES, LAG_HOURS, MODEL_FEATURES, ROLLING_HOURS, targets


def pandas_features(raw: pd.DataFrame) -> pd.DataFrame:
    """Window features by plain pandas, one series at a time."""
    parts = []
    for _, s in raw.sort_values(["city", "date"]).groupby("city"):
        s = s.copy()
        aqi = s["european_aqi"]
        s["temp_trend_7d"] = s["temperature_2m"].rolling(168).mean().diff(168)
        s["rain_accum_7d"] = s["rain"].rolling(168).sum()
        for k in LAG_HOURS:
            s[f"aqi_lag_{k}h"] = aqi.shift(k)
        for k in ROLLING_HOURS:
            s[f"aqi_roll_mean_{k}h"] = aqi.shift(1).rolling(k).mean()
            s[f"aqi_roll_std_{k}h"] = aqi.shift(1).rolling(k).std()
        s["aqi_ewm_6h"] = aqi.ewm(span=6).mean()
        for k in (1, 24):
            s[f"aqi_change_{k}h"] = aqi.shift(1).diff(k)
        for d in (1, 2, 3):
            s[f"aqi_next_{d}d"] = aqi.shift(-24 * d)
        parts.append(s)
    return pd.concat(parts, ignore_index=True)


@pytest.fixture(scope="module")
def holed():
    """A panel with missing values and missing hours."""
    raw = raw_pandas(rows=1500, seed=5)
    rng = np.random.default_rng(1)
    for c in ("european_aqi", "temperature_2m", "rain"):
        raw.loc[rng.random(len(raw)) < 0.004, c] = np.nan
    raw.loc[raw.groupby("city").head(3).index, "european_aqi"] = np.nan
    return raw[rng.random(len(raw)) > 0.02].reset_index(drop=True)


@pytest.mark.parametrize("chunk_rows", [None, 168, 500, 33600])
def test_windows_equal_pandas_with_nulls_and_gaps(spark, holed, chunk_rows):
    got = sorted_pandas(ft.add_features(to_spark(spark, holed), chunk_rows=chunk_rows))
    want = pandas_features(holed)
    for c in [*[f for f in FEATURES if f.startswith(("aqi", "temp", "rain"))], *targets()]:
        np.testing.assert_allclose(got[c].astype(float), want[c], rtol=1e-9, atol=1e-9, err_msg=c)


def test_sparse_series_reaches_over_several_chunks(spark):
    raw = raw_pandas(rows=500)
    raw["date"] = raw["date"].min() + (raw["date"] - raw["date"].min()) * 40  # a row every 40 hours
    got = sorted_pandas(ft.add_features(to_spark(spark, raw), chunk_rows=168))
    want = pandas_features(raw)
    for c in ("temp_trend_7d", "aqi_lag_24h", "aqi_ewm_6h", "aqi_next_3d"):
        np.testing.assert_allclose(got[c].astype(float), want[c], rtol=1e-9, err_msg=c)


@pytest.mark.parametrize("chunk_rows", [2000, 300, 60])
def test_dense_series_is_cut_finer(spark, chunk_rows):
    """One city reads every minute and holds most rows; the other reads hourly."""
    raw = raw_pandas(rows=3000)
    start = raw["date"].min()
    dense = raw.city == "Lahore"
    raw.loc[dense, "date"] = start + (raw.loc[dense, "date"] - start) / 60
    df = to_spark(spark, raw[~((raw.city == "Karachi") & (raw.index % 3000 > 900))])
    got = sorted_pandas(ft.add_features(df, chunk_rows=chunk_rows))
    want = sorted_pandas(ft.add_features(df, chunk_rows=None))
    for c in ("temp_trend_7d", "rain_accum_7d", "aqi_lag_24h", "aqi_ewm_6h", "aqi_roll_std_24h", "aqi_next_3d"):
        np.testing.assert_allclose(got[c].astype(float), want[c].astype(float), rtol=1e-9, atol=1e-9, err_msg=c)
    from hazeline.operators.series import with_chunks

    sizes = with_chunks(df, ["city"], "date", 0, 0, chunk_rows).groupBy("city", "_chunk").count()
    assert sizes.where("city = 'Lahore'").agg({"count": "max"}).first()[0] <= chunk_rows * 1.5


def test_chunks_do_not_repeat_or_lose_rows(spark, raw_df):
    out = along_series(raw_df, lambda w: ft.lag_columns(w), back=24, ahead=30, chunk_rows=168)
    assert out.count() == raw_df.count() == out.select("city", "date").distinct().count()


def test_columns_and_order(engineered_df, raw_df):
    assert engineered_df.columns == [*raw_df.columns, *FEATURES, *targets()]
    assert len(engineered_df.columns) == 55
    assert len(MODEL_FEATURES) == 48


def test_first_and_last_complete_rows(engineered_df, raw_df):
    rows = sorted_pandas(engineered_df)
    one = rows[rows.city == "Lahore"].reset_index(drop=True)
    assert one[FEATURES].notna().all(axis=1).idxmax() == 335
    assert one["aqi_next_3d"].last_valid_index() == len(one) - 73
    assert ft.complete_rows(engineered_df).count() == 2 * (420 - 335)


def test_row_wise_features(engineered_df):
    rows = sorted_pandas(engineered_df)
    assert (rows.hour_sin ** 2 + rows.hour_cos ** 2 - 1).abs().max() < 1e-9
    assert (rows.day_of_week == rows.date.dt.dayofweek).all()
    assert set(rows.is_weekend) == {0, 1}
    angle = np.radians(rows.wind_direction_10m)
    np.testing.assert_allclose(rows.wind_u, -rows.wind_speed_10m * np.sin(angle), atol=1e-9)
    np.testing.assert_allclose(rows.pm_ratio, rows.pm2_5 / (rows.pm10 + 1e-6))
    np.testing.assert_allclose(rows.no2_o3_ratio, rows.nitrogen_dioxide / rows.ozone.clip(lower=5))


def test_missing_ozone_stays_missing(spark):
    raw = raw_pandas(rows=5)
    raw.loc[0, "ozone"] = np.nan
    row = sorted_pandas(ft.add_features(to_spark(spark, raw))).query("city == 'Lahore'").iloc[0]
    assert np.isnan(row.no2_o3_ratio)


def test_spike_is_not_in_its_own_window(spark):
    raw = raw_pandas(rows=60, cities=("Lahore",))
    raw["european_aqi"] = 50.0
    raw.loc[25, "european_aqi"] = 999.0
    rows = sorted_pandas(ft.add_features(to_spark(spark, raw)))
    assert rows.loc[25, "aqi_roll_mean_24h"] == 50
    assert rows.loc[26, "aqi_roll_mean_24h"] > 50


def test_cities_do_not_mix(spark):
    raw = raw_pandas(rows=60)
    raw.loc[raw.city == "Karachi", "european_aqi"] = 0.0
    rows = sorted_pandas(ft.add_features(to_spark(spark, raw)))
    karachi = rows[rows.city == "Karachi"].reset_index(drop=True)
    assert np.isnan(karachi.loc[0, "aqi_lag_1h"])
    assert karachi.aqi_ewm_6h.abs().max() == 0
    assert rows[rows.city == "Lahore"].aqi_ewm_6h.min() >= 40


def test_transformer(raw_df, engineered_df, tmp_path):
    stage = ft.PanelFeatures(horizon=3)
    stage.write().overwrite().save(str(tmp_path / "stage"))
    again = ft.PanelFeatures.load(str(tmp_path / "stage"))
    assert again.transform(raw_df).columns == engineered_df.columns
    assert stage.output_names(raw_df) == ft.feature_names(engineered_df)


def test_gap_free_hours(spark):
    raw = raw_pandas(rows=1000, cities=("Lahore",))
    thin = raw[(raw.index % 50 != 7)].reset_index(drop=True)
    out = sorted_pandas(ft.add_gap_free_hours(to_spark(spark, thin)))
    assert list(out.date) == list(raw.date)
    assert out.european_aqi.isna().sum() == 20


def test_mean_is_carried_over_long_gaps_and_chunk_borders(spark):
    rng = np.random.default_rng(11)
    values = rng.uniform(20, 90, 900)
    values[60:420] = np.nan  # longer than a chunk
    values[700:860] = np.nan
    frame = pd.DataFrame({"date": pd.date_range("2026-01-01", periods=900, freq="h"), "city": "Lahore", "european_aqi": values})
    rows = [(d.to_pydatetime(), c, None if np.isnan(v) else float(v)) for d, c, v in frame.itertuples(index=False)]
    df = spark.createDataFrame(rows, "date timestamp_ntz, city string, european_aqi double")
    want = frame.european_aqi.ewm(span=6).mean().to_numpy()
    for chunk_rows in (None, 168):
        got = sorted_pandas(ft.add_ewm(df, chunk_rows=chunk_rows)).aqi_ewm_6h.to_numpy(dtype=float)
        np.testing.assert_allclose(got, want, rtol=1e-12)


def test_hours_at_half_past_and_mixed_minutes(spark):
    times = pd.date_range("2026-01-30 18:30", periods=96, freq="h")
    rows = [(t.to_pydatetime(), "Delhi", 1.0, 2.0, float(i)) for i, t in enumerate(times) if i % 5]
    df = spark.createDataFrame(rows, "date timestamp_ntz, city string, lat double, lon double, european_aqi double")
    got = ft.add_gap_free_hours(df)
    assert got.count() == 94 and got.where("european_aqi is not null").count() == len(rows)
    mixed = df.unionByName(df.limit(1).withColumn("date", F.col("date") + F.expr("interval 7 minutes")))
    with pytest.raises(Exception, match="different minutes"):
        ft.add_gap_free_hours(mixed).collect()
