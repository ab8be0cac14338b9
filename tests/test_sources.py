import numpy as np
import pytest
from panels import raw_pandas, sorted_pandas, to_spark
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazeline.schema import AIR_VARIABLES, KEYS, RAW_COLUMNS, RAW_SCHEMA, WEATHER_VARIABLES
from hazeline.sources import cities, files, payloads
from hazeline.sources.feature_table import FeatureTable, table_versions, training_snapshot
from hazeline.sources.registry import ModelRegistry, production_model, training_winner


def test_no_hour_is_lost_when_clocks_change(spark):
    start = 1729987200  # 2024-10-27 in UTC; London repeats an hour
    rows = [("London", 1.0, 2.0, "Europe/London", start, start + 86400, 3600, [float(i) for i in range(24)])]
    df = spark.createDataFrame(
        rows, "city string, lat double, lon double, tz string, time bigint, time_end bigint, interval int, pm10 array<double>"
    )
    got = payloads.explode_hourly(df, ["pm10"])
    assert got.select("date").distinct().count() == 24 and got.select("local_date").distinct().count() == 23


def test_payload_steps_are_left_closed_and_in_utc(spark):
    rows = [("Lahore", 1.0, 2.0, "Asia/Karachi", 1704067200, 1704067200 + 3 * 3600, 3600, [1.0, None, 3.0]),
            ("Delhi", 1.0, 2.0, "Asia/Kolkata", 1704067200, 1704067200 + 5400, 3600, [7.0, 8.0])]
    df = spark.createDataFrame(
        rows, "city string, lat double, lon double, tz string, time bigint, time_end bigint, interval int, pm10 array<double>"
    )
    got = sorted_pandas(payloads.explode_hourly(df, ["pm10"]))
    hours = ["2024-01-01 00:00:00", "2024-01-01 01:00:00", "2024-01-01 00:00:00", "2024-01-01 01:00:00", "2024-01-01 02:00:00"]
    assert [str(d) for d in got.date] == hours
    assert [str(d) for d in got.local_date] == [
        "2024-01-01 05:30:00", "2024-01-01 06:30:00", "2024-01-01 05:00:00", "2024-01-01 06:00:00", "2024-01-01 07:00:00",
    ]
    np.testing.assert_array_equal(got.pm10, [7, 8, 1, np.nan, 3])


def test_latest_and_merge(spark, raw_df, raw):
    weather = payloads.latest_reading(raw_df.select(*KEYS, *WEATHER_VARIABLES))
    air = payloads.latest_reading(raw_df.select(*KEYS, *AIR_VARIABLES).withColumn("lat", F.lit(9.0)))
    got = sorted_pandas(payloads.merge_current(weather, air))
    want = raw.sort_values(["city", "date"]).groupby("city").tail(1).reset_index(drop=True)
    assert (got.lat == 9).all() and list(got.pm10) == list(want.pm10) and list(got.rain) == list(want.rain)


def test_merge_keeps_matching_rows(raw_df):
    merged = files.merge_readings(
        raw_df.select(*KEYS, *WEATHER_VARIABLES), raw_df.select(*KEYS, *AIR_VARIABLES).where("city = 'Lahore'")
    )
    assert merged.count() == 420 and merged.columns == RAW_COLUMNS


def test_csv_round_trip(spark, raw_df, raw, tmp_path):
    files.write_csv(raw_df, str(tmp_path / "csv"))
    back = files.read_csv(spark, str(tmp_path / "csv"))
    assert [f.dataType for f in back.schema] == [f.dataType for f in RAW_SCHEMA]
    assert sorted_pandas(back).equals(sorted_pandas(raw_df))


def test_range_is_inclusive_and_pushed_down(spark, raw_df, tmp_path):
    path = str(tmp_path / "panel")
    raw_df.write.parquet(path)
    got = files.read_panel(spark, path, "2026-01-03", "2026-01-04")
    assert got.count() == 2 * 48
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(date" in plan and "LessThan(date" in plan


def test_nan_becomes_null(spark):
    df = files.clean(spark.createDataFrame([(float("nan"),), (1.0,)], "x double"))
    assert df.where("x is null").count() == 1


def test_city_lookup(spark):
    df = spark.createDataFrame([("  LAHORE ",), ("New York",)], "city string")
    got = {r["city"]: (r["lat"], r["lon"]) for r in cities.resolve(df).collect()}
    assert got == {"  LAHORE ": (31.558, 74.351), "New York": (40.7128, -74.0060)}
    bad = spark.createDataFrame([("Atlantis",), ("Delhi",)], "city string")
    assert [r["city"] for r in cities.unknown_cities(bad).collect()] == ["Atlantis"]
    with pytest.raises(cities.UnknownCity, match="'Atlantis'; there are some for: beijing, delhi"):
        cities.resolve(bad)


# ---- feature table ----------------------------------------------------------

SMALL = T.StructType([RAW_SCHEMA[c] for c in ("date", "city", "pm10")])


def test_table_versions(spark, tmp_path):
    root = str(tmp_path)
    assert table_versions(spark, root, "t") == []
    first = FeatureTable.get_or_create(spark, root, "t", 1, SMALL)
    assert first.read().count() == 0
    second = FeatureTable.new_version(spark, root, "t", RAW_SCHEMA)
    assert second.version == 2 and table_versions(spark, root, "t") == [1, 2]
    again = FeatureTable.get_or_create(spark, root, "t", 1)
    assert again.schema == SMALL and again.primary_key == ["city", "date"]
    with pytest.raises(ValueError, match="v7"):
        FeatureTable.get_or_create(spark, root, "t", 7)


def test_upsert_replaces_and_repeats_safely(spark, raw_df, tmp_path):
    table = FeatureTable.get_or_create(spark, str(tmp_path), "t", 1, SMALL)
    table.upsert(raw_df.where("date < '2026-01-10'"))
    newer = raw_df.where("date >= '2026-01-05'").withColumn("pm10", F.col("pm10") + 1000)
    for _ in range(2):
        table.upsert(newer)
        got = sorted_pandas(table.read())
        assert len(got) == raw_df.count()
        assert ((got.pm10 > 900) == (got.date >= "2026-01-05")).all()
    assert table.read("2026-01-03", "2026-01-03").count() == 48


def test_upsert_resolves_many_copies_of_a_key(spark, tmp_path):
    raw = raw_pandas(rows=30)
    df = to_spark(spark, raw)
    hot = df.where("city = 'Lahore'").limit(1).crossJoin(spark.range(500)).drop("id")
    table = FeatureTable.get_or_create(spark, str(tmp_path), "t", 1, SMALL)
    table.upsert(df.unionByName(hot.withColumn("pm10", F.lit(1.0))))
    assert table.read().count() == 60


def test_upsert_limits_groups_before_the_shuffle(spark, raw_df):
    from pyspark.sql import Window

    newest = Window.partitionBy("city", "date").orderBy(F.col("pm10").desc())
    kept = raw_df.withColumn("_rn", F.row_number().over(newest)).where("_rn = 1")
    assert "WindowGroupLimit" in kept._jdf.queryExecution().executedPlan().toString()


def test_append_columns(spark, raw_df, tmp_path):
    table = FeatureTable.get_or_create(spark, str(tmp_path), "t", 1, SMALL)
    table.upsert(raw_df.where("date < '2026-01-05'"))
    table.append_columns([RAW_SCHEMA["ozone"]])
    table.upsert(raw_df.where("date >= '2026-01-05'"))
    again = FeatureTable.get_or_create(spark, str(tmp_path), "t", 1).read()
    assert again.columns == ["date", "city", "pm10", "ozone"]
    assert again.where("ozone is null").count() == again.where("date < '2026-01-05'").count()


def test_snapshots_are_versioned(spark, raw_df, tmp_path):
    table = FeatureTable.get_or_create(spark, str(tmp_path), "t", 1, SMALL)
    table.upsert(raw_df)
    v1, one = training_snapshot(table, "2026-01-02", "2026-01-03", "training")
    v2, two = training_snapshot(table, "2026-01-02", "2026-01-05", "training")
    assert (v1, v2) == (1, 2) and (one.count(), two.count()) == (96, 192)


# ---- registry ---------------------------------------------------------------

def test_registry(spark, tmp_path):
    registry = ModelRegistry(spark, str(tmp_path / "registry"))
    assert registry.rows().count() == 0

    def runs(*rows):
        return spark.createDataFrame(
            [(n, h, 0.5, 1.0, 1.0, rmse, skill, "p", i) for i, (n, h, rmse, skill) in enumerate(rows)],
            "name string, horizon int, r2 double, mae double, mse double, rmse double, skill_vs_naive double, "
            "path string, i int",
        ).withColumn("created_at", F.expr("timestamp_ntz '2026-01-01' + make_interval(0, 0, 0, 0, 0, i, 0)"))

    registry.register(runs(("aqi_linear_h1", 1, 9.0, 0.1), ("aqi_linear_h1", 1, 7.0, 0.2), ("aqi_linear_h2", 2, 5.0, 0.0)))
    rows = registry.register(runs(("aqi_linear_h1", 1, 8.0, 0.3)))
    versions = {(r["name"], r["version"]): r["rmse"] for r in rows.collect()}
    assert versions == {("aqi_linear_h1", 1): 9, ("aqi_linear_h1", 2): 7, ("aqi_linear_h1", 3): 8, ("aqi_linear_h2", 1): 5}
    assert registry.best("aqi_linear_h1")["version"] == 2
    assert registry.best("aqi_linear_h1", "skill_vs_naive", "max")["version"] == 3
    assert registry.best("nothing") is None
    with pytest.raises(ValueError, match="direction"):
        registry.best("aqi_linear_h1", direction="up")


def test_choices(spark):
    rows = [("a", 1, None, None), ("b", 1, 4.0, 0.0), ("c", 1, 4.0, -0.5), ("a", 2, None, None)]
    df = spark.createDataFrame(rows, "model string, horizon int, rmse double, skill_vs_naive double")
    chosen = {r["horizon"]: r["model"] for r in production_model(df, ["c", "b", "a"]).collect()}
    assert chosen == {1: "c", 2: "a"}
    won = {r["horizon"]: r["model"] for r in training_winner(df, ["a", "b", "c"]).collect()}
    assert won == {1: "b", 2: "a"}


# ---- commits of a table -----------------------------------------------------

def test_a_crash_before_the_commit_changes_nothing(spark, raw_df, tmp_path, monkeypatch):
    table = FeatureTable.get_or_create(spark, str(tmp_path), "t", 1, SMALL)
    table.upsert(raw_df)
    before, held = sorted_pandas(table.read()), table.read()

    def lost(*_):
        raise RuntimeError("driver lost")

    newer = raw_df.withColumn("pm10", F.lit(-1.0))
    with monkeypatch.context() as m:
        m.setattr(FeatureTable, "_publish", lost)
        with pytest.raises(RuntimeError):
            table.upsert(newer)
    assert sorted_pandas(table.read()).equals(before)
    table.upsert(newer)
    assert table.read().where("pm10 <> -1").isEmpty() and sorted_pandas(held).equals(before)  # files that are read stay
    table.vacuum()
    assert table.read().count() == len(before)
    (tmp_path / "t" / "v1" / "commits" / "000000000003").touch()  # a writer that died while it took its number
    table.upsert(newer.withColumn("pm10", F.lit(-2.0)))
    assert table.read().where("pm10 <> -2").isEmpty()


def test_a_second_writer_loses_no_rows(spark, raw_df, tmp_path, monkeypatch):
    one, other = (FeatureTable.get_or_create(spark, str(tmp_path), "t", 1, SMALL) for _ in range(2))
    real, turns = FeatureTable._publish, []

    def meanwhile(self, number, label):
        if not turns:  # the other writer commits rows of the same days first
            turns.append(number)
            other.upsert(raw_df.where("city = 'Karachi'"))
        return real(self, number, label)

    monkeypatch.setattr(FeatureTable, "_publish", meanwhile)
    one.upsert(raw_df.where("city = 'Lahore'"))
    assert one.read().count() == other.read().count() == raw_df.count()


def test_an_upsert_rewrites_touched_parts_only(spark, raw_df, tmp_path):
    table = FeatureTable.get_or_create(spark, str(tmp_path), "t", 1, SMALL, counted=True)
    table.upsert(raw_df)
    _, before = table.latest()
    table.upsert(raw_df.where("city = 'Lahore' and date between '2026-01-03' and '2026-01-04 23:00'").withColumn("pm10", F.lit(0.0)))
    _, after = table.latest()
    changed = {part for part in after if after[part] != before[part]}
    assert {day for day, _ in changed} == {"2026-01-03", "2026-01-04"} and len({bucket for _, bucket in changed}) == 1
    assert table.read().where("pm10 = 0").count() == 48
    want = {(r["city"], r["day"]): r["n"] for r in table.read().groupBy("city", F.to_date("date").alias("day")).agg(F.count("*").alias("n")).collect()}
    assert {(r["city"], r["day"]): r["n"] for r in table.counts().collect()} == want


def test_a_range_reads_its_days_only(spark, raw_df, tmp_path):
    table = FeatureTable.get_or_create(spark, str(tmp_path), "t", 1, SMALL)
    table.upsert(raw_df)
    files = table.read("2026-01-03", "2026-01-04").inputFiles()
    assert files and all("day=2026-01-03" in f or "day=2026-01-04" in f for f in files)
