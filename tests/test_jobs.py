import os

from datetime import date

import numpy as np
import pytest
from panels import raw_pandas, sorted_pandas, to_spark
from pyspark.sql import functions as F

from hazeline.functions.measures import aqi_band, health_tier, peak_tier
from hazeline.operators import alerts, forecast
from hazeline.operators.features import add_features, complete_rows
from hazeline.operators.quality import DataQualityError
from hazeline.plans import ingest, serve, train
from hazeline.schema import AIR_VARIABLES, FEATURE_SCHEMA, FEATURES, KEYS, RAW_SCHEMA, WEATHER_VARIABLES
from hazeline.sources.feature_table import FeatureTable
from hazeline.learn import training
from hazeline.sources.registry import ModelRegistry
from hazeline.streaming.refresh import refresh_stream


def sides(df):
    return df.select(*KEYS, *WEATHER_VARIABLES), df.select(*KEYS, *AIR_VARIABLES)


def close(got, want):
    assert list(got.columns) == list(want.columns) and len(got) == len(want)
    for c in got.columns[4:]:
        np.testing.assert_allclose(got[c].astype(float), want[c].astype(float), rtol=1e-9, atol=1e-9, err_msg=c)


# ---- alerts -----------------------------------------------------------------

@pytest.mark.parametrize("current, ahead, fired", [
    (149.9, [0.0, 12.5, 150.0], []),
    (150.1, [149.0], [("current", 0)]),
    (7.0, [277.7, 20.0], [("forecast", 1)]),
    (9.0, [None, 77.0, None], []),
    (9.0, [None, 77.0, 150.5], [("forecast", 3)]),
    (150.0, [], []),
])
def test_aqi_alerts(spark, current, ahead, fired):
    df = spark.createDataFrame([("Lahore", current, ahead)], "city string, current_aqi double, predictions array<double>")
    rows = alerts.aqi_alerts(df, threshold=150).collect()
    assert [(r["kind"], r["day"]) for r in rows] == fired
    assert all(f"{r['value']:.0f}" in r["message"] and r["label"] in r["message"] for r in rows)
    assert alerts.aqi_alerts(df).count() == 0  # the default threshold is 300


def test_drift_alert(spark):
    schema = "dataset_drift boolean, share_drifted double, drifted_features array<string>"
    df = spark.createDataFrame([(True, 0.6181, ["rain", "pm10"]), (False, 0.2, ["ozone"]), (True, 1.0, [])], schema)
    messages = [r["message"] for r in alerts.drift_alert(df, "Lahore").collect()]
    assert messages == [
        "Lahore: inputs drifted, share 0.618; columns rain, pm10",
        "Lahore: inputs drifted, share 1.000; columns -",
    ]


def test_decay_alerts(spark):
    live = spark.createDataFrame([(1, 6.0), (2, 4.1), (3, 4.9)], "horizon int, rmse double")
    base = spark.createDataFrame([(1, 5.0), (2, 5.0), (3, 4.0)], "horizon int, rmse double")
    (row,) = alerts.decay_alerts(live, base).collect()  # 20 percent exactly raises nothing
    assert row["horizon"] == 3 and row["degradation"] == pytest.approx(22.5)


def test_labels(spark):
    values = [0.0, 50.0, 50.5, 100.0, 150.0, 200.0, 300.0, 301.0, 900.0, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double").orderBy("i")
    v = F.col("v")
    rows = df.select(aqi_band(v).alias("band"), health_tier(v).alias("tier"), peak_tier(v).alias("peak")).collect()
    assert [r["band"] for r in rows] == [
        "Good", "Good", "Moderate", "Moderate", "Unhealthy for Sensitive Groups", "Unhealthy", "Very Unhealthy",
        "Hazardous", "Hazardous", None,
    ]
    assert [r["tier"] for r in rows][:5] == ["good", "good", "moderate", "moderate", "bad"]
    assert [r["peak"] for r in rows][3:6] == ["none", "moderate", "bad"]


# ---- forecasts --------------------------------------------------------------

def test_latest_rows_limit_groups_before_the_shuffle(raw_df):
    rows = forecast.latest_rows(raw_df, 24)
    assert "WindowGroupLimit" in rows._jdf.queryExecution().executedPlan().toString()
    got = sorted_pandas(rows)
    assert len(got) == 48 and got.date.min() == got.date.max() - np.timedelta64(23, "h")


def test_scorable(spark):
    short = to_spark(spark, raw_pandas(rows=23, cities=("Karachi",)))
    long = to_spark(spark, raw_pandas(rows=24, cities=("Lahore",)))
    got = {r["city"]: r["scorable"] for r in forecast.scorable_cities(short.unionByName(long)).collect()}
    assert got == {"Karachi": False, "Lahore": True}


def test_intervals(spark):
    guesses = spark.createDataFrame(
        [("a", 1, 10.0, 20.0), ("a", 2, 10.0, 30.0), ("a", 3, 10.0, 40.0)],
        "city string, day int, current_aqi double, predicted_aqi double",
    )
    models = spark.createDataFrame(
        [(1, "linear", 4, 2.0), (2, "linear", 1, None)], "day int, model_used string, model_version int, rmse double"
    )
    rows = {r["day"]: r for r in forecast.forecast_rows(guesses, models).collect()}
    assert set(rows) == {1, 2}
    assert (rows[1]["ci_low"], rows[1]["ci_high"]) == (20 - 1.96 * 2, 20 + 1.96 * 2)
    assert rows[2]["ci_low"] is None and rows[2]["predicted_aqi"] == 30


# ---- jobs -------------------------------------------------------------------

@pytest.fixture(scope="module")
def long_raw():
    return raw_pandas(rows=1000, seed=11)


@pytest.fixture(scope="module")
def long_df(spark, long_raw):
    return to_spark(spark, long_raw).cache()


def test_backfill_then_refresh(spark, long_df, tmp_path):
    weather, air = sides(long_df)
    table = FeatureTable.get_or_create(spark, str(tmp_path), "features", 1, FEATURE_SCHEMA)
    ingest.backfill(weather, air, table, "2026-01-01", "2026-01-31")
    before = sorted_pandas(table.read())
    close(before, sorted_pandas(complete_rows(add_features(long_df.where("date < '2026-02-01'")))))
    assert ingest.refresh_range(date(2026, 2, 11)) == ("2026-01-25", "2026-02-10")
    for _ in range(2):
        ingest.refresh(weather, air, table, date(2026, 2, 11))
        after = sorted_pandas(table.read())
        # Two weeks of the refreshed range only warm the windows up: its row 335 is the first complete one.
        fresh = after[after.date >= "2026-02-07 23:00"]
        full = complete_rows(add_features(long_df.where("date < '2026-02-11'")))
        want = sorted_pandas(full.where("date >= '2026-02-07 23:00:00'"))
        close(fresh[FEATURE_SCHEMA.names].reset_index(drop=True), want)
        assert len(after) == len(before) + len(fresh)
    # With a warm-up read, the whole range is refreshed, targets included.
    ingest.refresh(weather, air, table, date(2026, 2, 11), warmup_days=15)
    close(sorted_pandas(table.read("2026-01-25", "2026-02-10")), sorted_pandas(full.where("date >= '2026-01-25'")))


def test_bad_input_stops_the_backfill(spark, long_raw, tmp_path):
    weather, air = sides(to_spark(spark, long_raw.assign(pm10=-1.0)))
    table = FeatureTable.get_or_create(spark, str(tmp_path), "features", 1, FEATURE_SCHEMA)
    with pytest.raises(DataQualityError):
        ingest.backfill(weather, air, table, "2026-01-01", "2026-01-31")
    assert table.read().count() == 0


def test_stream_with_late_rows_equals_batch(spark, long_df, tmp_path):
    root = str(tmp_path)
    raw = FeatureTable.get_or_create(spark, root, "raw", 1, RAW_SCHEMA)
    features = FeatureTable.get_or_create(spark, root, "features", 1, FEATURE_SCHEMA)
    late = "day(date) = 20 and hour(date) between 3 and 9 and month(date) = 1"
    waves = [f"date < '2026-01-25' and not ({late})", "date >= '2026-01-25'", late]
    for wave in waves:
        long_df.where(wave).write.mode("append").parquet(f"{root}/landing")
        refresh_stream(spark, f"{root}/landing", raw, features, f"{root}/checkpoint").awaitTermination()
    close(sorted_pandas(features.read()), sorted_pandas(complete_rows(add_features(long_df))))
    refresh_stream(spark, f"{root}/landing", raw, features, f"{root}/checkpoint").awaitTermination()
    assert features.read().count() == complete_rows(add_features(long_df)).count()


def test_train_and_serve(spark, long_df, tmp_path):
    root = str(tmp_path)
    table = FeatureTable.get_or_create(spark, root, "features", 1, FEATURE_SCHEMA)
    table.upsert(complete_rows(add_features(long_df)))
    registry = ModelRegistry(spark, f"{root}/registry")
    with pytest.raises(RuntimeError, match="no model is registered"):
        serve.forecast(table.read(), registry)
    small = {"random_forest": {"numTrees": 3, "maxDepth": 3}}
    winners = train.train(table, registry, f"{root}/models", "2026-01-01", "2026-12-31", horizons=(1, 2),
                          kinds=("linear", "random_forest"), settings=small)
    assert sorted(r["horizon"] for r in winners.collect()) == [1, 2]
    assert registry.rows().count() == 4
    rows = serve.forecast(table.read(), registry).toPandas()
    assert sorted(zip(rows.city, rows.day)) == [(c, d) for c in ("Karachi", "Lahore") for d in (1, 2)]
    assert ((rows.ci_high - rows.ci_low) > 0).all() and (rows.model_version == 1).all()
    fired = serve.alerts(serve.forecast(table.read(), registry), threshold=0).toPandas()
    assert len(fired) == 2 * (1 + 2)
    assert set(FEATURES) < set(table.read().columns)


class Saved:
    def __init__(self, text):
        self.text = text

    def save(self, path):
        os.makedirs(path)
        with open(f"{path}/model", "x") as f:
            f.write(self.text)


def test_each_version_has_files_of_its_own(spark, tmp_path):
    registry = ModelRegistry(spark, f"{tmp_path}/registry")
    schema = "model string, horizon int, r2 double, mae double, mse double, rmse double, skill_vs_naive double"
    for turn, rmse in (("first", 3.0), ("second", 4.0)):
        metrics = spark.createDataFrame([("linear", 1, 0.5, 1.0, rmse**2, rmse, 0.1), ("linear", 2, 0.4, 1.0, rmse**2, rmse, 0.1)], schema)
        training.register(registry, metrics, {("linear", 1): Saved(turn), ("linear", 2): Saved(turn)}, f"{tmp_path}/models")
    rows = {(r.name, r.version): r.path for r in registry.rows().collect()}
    assert set(rows) == {(f"aqi_linear_h{h}", v) for h in (1, 2) for v in (1, 2)} and len(set(rows.values())) == 4
    best = registry.best("aqi_linear_h1")
    assert (best["version"], open(f"{best['path']}/model").read()) == (1, "first")
