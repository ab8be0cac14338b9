import json
from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazeline.schema import RAW_SCHEMA
from hazeline.sources import landed
from hazeline.sources.feature_table import FeatureTable, child_names
from hazeline.streaming.current import follow_current, read_current

VARIABLES = ["pm10", "ozone"]
START = int(datetime(2026, 3, 1, tzinfo=timezone.utc).timestamp())


def payload(city="Lahore", steps=4, zone="Asia/Karachi", time=START, interval=3600, **values):
    arrays = {v: values.get(v, [float(i) for i in range(steps)]) for v in VARIABLES}
    return {"city": city, "latitude": 31.5, "longitude": 74.3, "timezone": zone, "hourly": {"time": time, "time_end": time + steps * interval, "interval": interval, **arrays}}


def land(path, *lines):
    path.mkdir(exist_ok=True)
    (path / f"{len(list(path.iterdir()))}.json").write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines))


def test_files_to_table_and_bad_payloads_aside(spark, tmp_path):
    land(
        tmp_path / "in", payload(), payload("Delhi", zone="Asia/Kolkata", ozone=[1.0, None, 3.0, 4.0]), '{"city": "Lahore", "hourly": {"ti',
        payload("Beijing", ozone=[1.0, 2.0]), payload("London", zone="Mars/Base"), {"city": "Nowhere"}, payload("Paris", interval=0),
        {**payload("Rome"), "latitude": None}, payload("Oslo", ozone=None), payload("Bern", zone="Europe/Zurich", interval=1800), "[1, 2]", "")
    schema = T.StructType([RAW_SCHEMA[c] for c in ("date", "city", "lat", "lon", *VARIABLES)])
    table = FeatureTable.get_or_create(spark, str(tmp_path / "t"), "readings", 1, schema)
    for _ in range(2):
        landed.ingest(spark, str(tmp_path / "in"), table, VARIABLES, str(tmp_path / "rejected"))
    rows = table.read().toPandas().sort_values(["city", "date"])
    assert rows.groupby("city").size().to_dict() == {"Lahore": 4, "Delhi": 4, "Oslo": 4, "Bern": 4}
    assert list(rows[rows.city == "Bern"].date) == list(pd.date_range("2026-03-01", periods=4, freq="30min"))
    assert rows[rows.city == "Delhi"].ozone.isna().sum() == 1 and rows[rows.city == "Oslo"].ozone.isna().all()
    bad = spark.read.parquet(str(tmp_path / "rejected")).toPandas()
    assert sorted(bad.reason) == sorted(2 * [
        "not a payload", "arrays of other lengths than the steps", "unknown zone", "not a payload", "no steps", "no place", "not a payload"])
    assert any('"hourly": {"ti' in x for x in bad.payload) and bad.payload.notna().all()


def test_parquet_payloads_and_partial_steps(spark, tmp_path):
    rows = spark.createDataFrame([payload(steps=3), payload("Delhi", steps=2)], landed.hourly_schema(VARIABLES))
    # The last step of a range that isn't a multiple of the interval is there, as in a left-closed range.
    rows = rows.withColumn("hourly", F.col("hourly").withField("time_end", F.col("hourly.time_end") - 60))
    rows.write.parquet(str(tmp_path / "in"))
    found = landed.reader(spark, landed.hourly_schema(VARIABLES), "parquet").load(str(tmp_path / "in"))
    good, bad = landed.sorted_out(found, "hourly", VARIABLES)
    assert bad.isEmpty() and landed.hourly_rows(good, VARIABLES).groupBy("city").count().collect().__len__() == 2
    assert landed.hourly_rows(good, VARIABLES).count() == 5


@pytest.mark.parametrize("session_zone", ["UTC", "Europe/London"])
def test_clock_change_is_kept(spark, tmp_path, session_zone):
    """Hours around the night in which a zone repeats an hour, from payloads and from aware dates, in any session."""
    time = int(datetime(2026, 10, 24, 22, tzinfo=timezone.utc).timestamp())
    spark.conf.set("spark.sql.session.timeZone", session_zone)
    try:
        land(tmp_path / "in", payload("London", 6, "Europe/London", time))
        good, _ = landed.sorted_out(landed.reader(spark, landed.hourly_schema(VARIABLES)).load(str(tmp_path / "in")), "hourly", VARIABLES)
        rows = landed.hourly_rows(good, VARIABLES).selectExpr("cast(date as string) as date", "cast(local_date as string) as local").collect()
        hours = [datetime(2026, 10, 24, 22, tzinfo=timezone.utc) + timedelta(hours=i) for i in range(6)]
        assert sorted(r.date for r in rows) == [h.strftime("%Y-%m-%d %H:%M:%S") for h in hours]
        assert sorted(r.local for r in rows) == sorted(h.astimezone(ZoneInfo("Europe/London")).strftime("%Y-%m-%d %H:%M:%S") for h in hours)
        aware = spark.createDataFrame([(int(h.timestamp()), "London", float(i)) for i, h in enumerate(hours)], "s long, city string, pm10 double")
        table = FeatureTable.get_or_create(spark, str(tmp_path), "aware", 1, T.StructType([RAW_SCHEMA[c] for c in ("date", "city", "pm10")]))
        table.upsert(aware.select(F.timestamp_seconds("s").alias("date"), "city", "pm10"))
        kept = table.read().selectExpr("cast(date as string) as date", "pm10").collect()
        assert {r.date: r.pm10 for r in kept} == {h.strftime("%Y-%m-%d %H:%M:%S"): float(i) for i, h in enumerate(hours)}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_newest_reading_whatever_the_order(spark, tmp_path):
    def current(city, hour, value, zone="Asia/Kolkata"):
        return {"city": city, "latitude": 1.0, "longitude": 2.0, "timezone": zone, "current": {"time": START + 3600 * hour, "pm10": value, "ozone": None}}

    files = [[current("Delhi", 1, 1.0), current("Paris", 5, 2.0, "Europe/Paris")], [current("Delhi", 9, 3.0), "{broken"], [current("Delhi", 4, 4.0), current("Delhi", 9, 5.0)], [current("Oslo", 0, 6.0, "Nowhere/X")]]
    found = []
    for n, order in enumerate(([0, 1, 2, 3], [2, 3, 1, 0])):
        base = tmp_path / str(n)
        for i in order:
            land(base, *files[i])
            follow_current(spark, str(base), VARIABLES, f"{base}-table", f"{base}-checkpoint", prefix="now_").awaitTermination()
        assert len(child_names(spark, f"{base}-table")) == 4
        found.append(sorted(map(str, read_current(spark, f"{base}-table").collect())))
        names = read_current(spark, f"{base}-table").columns
    assert found[0] == found[1] and len(found[0]) == 2  # two readings of one instant: the same one in both orders
    assert names == ["date", "city", "lat", "lon", "now_pm10", "now_ozone"]
    rows = {r.city: r for r in read_current(spark, f"{base}-table").collect()}
    assert str(rows["Delhi"].date) == "2026-03-01 14:30:00" and rows["Delhi"].now_pm10 in (3.0, 5.0)
    assert str(rows["Paris"].date) == "2026-03-01 06:00:00"
