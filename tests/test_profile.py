import numpy as np
import pandas as pd
import pytest
from panels import raw_pandas, to_spark
from pyspark.sql import functions as F

from hazeline.operators import profile
from hazeline.operators.profile import autocorrelation
from hazeline.operators.quantiles import exact_quantiles, narrowed
from hazeline.schema import CAPPED_COLUMNS, MEASURES

PROBS = [0.0, 0.005, 0.25, 0.5, 0.75, 0.995, 1.0]


def value_frame(spark, groups: dict):
    rows = [(k, float(v)) for k, values in groups.items() for v in values]
    return spark.createDataFrame(rows, "k string, value double")


@pytest.mark.parametrize("accuracy", [20000, 50])
def test_quantiles_equal_numpy(spark, accuracy):
    rng = np.random.default_rng(0)
    groups = {
        "many": rng.lognormal(0, 2, 5000), "one": [3.5], "two": [1.0, 2.0], "constant": [7.0] * 50,
        # a third of the rows share one value
        "hot": np.concatenate([rng.normal(size=2000), np.zeros(1000)]), "few": rng.integers(0, 4, 300),
    }
    got = exact_quantiles(value_frame(spark, groups), ["k"], PROBS, accuracy=accuracy).toPandas()
    for k, values in groups.items():
        mine = got[got.k == k].sort_values("prob")
        np.testing.assert_allclose(mine["quantile"], np.quantile(values, PROBS), rtol=1e-12, atol=1e-12, err_msg=k)
        assert (mine.n == len(values)).all()


def test_standard_scaling_of_a_constant_column(spark):
    df = spark.createDataFrame([(3.0, 1.0), (3.0, 3.0)], "same double, two double")
    got = {r["column"]: (r["mean"], r["std"], r["scale"]) for r in profile.standard_scaling(df, ["same", "two"]).collect()}
    assert got == {"same": (3.0, 0.0, 1.0), "two": (2.0, 1.0, 1.0)}


def test_quantiles_skip_nulls(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("a", 3.0)], "k string, value double")
    assert exact_quantiles(df, ["k"], [0.5]).first()["quantile"] == 2.0


def test_scaling_and_caps(spark, raw):
    df = to_spark(spark, raw)
    got = {r["column"]: r for r in profile.robust_scaling(df, MEASURES).collect()}
    for c in MEASURES:
        q1, q2, q3 = np.quantile(raw[c], [0.25, 0.5, 0.75])
        assert got[c]["median"] == pytest.approx(q2) and got[c]["iqr"] == pytest.approx(q3 - q1)
    flat = profile.robust_scaling(df.withColumn("rain", F.lit(2.0)), ["rain"]).first()
    assert (flat["median"], flat["iqr"]) == (2.0, 1.0)
    is_train = F.col("city") == "Lahore"
    train = raw[raw.city == "Lahore"]
    caps = {r["column"]: r for r in profile.cap_thresholds(df, is_train).collect()}
    out = profile.cap_outliers(df, is_train).toPandas()
    for c in CAPPED_COLUMNS:
        limit = np.quantile(train[c], 0.995)
        assert caps[c]["threshold"] == pytest.approx(limit) and caps[c]["n_capped"] == (raw[c] > limit).sum()
        assert out[c].max() == pytest.approx(limit)


def test_cap_keeps_missing(spark):
    raw = raw_pandas(rows=50)
    raw.loc[4, "pm10"] = np.nan
    out = profile.cap_outliers(to_spark(spark, raw), F.lit(True))
    assert out.where("pm10 is null").count() == 1


def test_monthly_box(spark):
    raw = raw_pandas(rows=1700, cities=("Lahore",))
    raw.loc[5, "european_aqi"] = 900
    boxes = {r["month"]: r for r in profile.monthly_box(to_spark(spark, raw)).collect()}
    for month, part in raw.groupby(raw.date.dt.month):
        x = part.european_aqi
        q1, q3 = x.quantile(0.25), x.quantile(0.75)
        inside = x.between(q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1))
        box = boxes[month]
        assert box["q1"] == pytest.approx(q1) and box["median"] == pytest.approx(x.median())
        assert box["n_outliers"] == (~inside).sum() and box["whisker_high"] == pytest.approx(x[inside].max())
    assert boxes[1]["n_outliers"] >= 1


def test_histogram_equals_numpy(spark, raw):
    got = profile.histograms(to_spark(spark, raw), ["ozone", "rain"]).toPandas()
    for c in ("ozone", "rain"):
        counts, _ = np.histogram(raw[c], bins=50)
        mine = got[got.column == c].set_index("bin")["n"].reindex(range(50), fill_value=0)
        assert mine.sum() == len(raw) and np.abs(mine.to_numpy() - counts).sum() <= 2  # a value on a bin edge


def test_correlation_equals_pandas(spark, raw):
    raw = raw.copy()
    raw.loc[:30, "rain"] = np.nan
    raw.loc[20:60, "ozone"] = np.nan
    raw["pm2_5"] = raw["pm10"] * 0.5 + 1
    raw["uv_index"] = 3.0
    got = profile.correlations(to_spark(spark, raw), MEASURES).toPandas().set_index(["feature_a", "feature_b"])
    want = raw[MEASURES].corr()
    for i, a in enumerate(MEASURES):
        for b in MEASURES[i:]:
            np.testing.assert_allclose(got.loc[(a, b), "correlation"], want.loc[a, b], rtol=1e-9, atol=1e-9)
    pairs = profile.redundant_pairs(to_spark(spark, raw), MEASURES).collect()
    assert [(p["feature_a"], p["feature_b"]) for p in pairs] == [("pm10", "pm2_5")]


@pytest.mark.parametrize("chunk_rows", [None, 168])
def test_autocorrelation(spark, raw, chunk_rows):
    got = profile.autocorrelation(to_spark(spark, raw), chunk_rows=chunk_rows).toPandas()
    for city, part in raw.groupby("city"):
        d = part.european_aqi.to_numpy() - part.european_aqi.mean()
        want = [(d[k:] * d[:len(d) - k]).sum() / (d * d).sum() for k in range(73)]
        np.testing.assert_allclose(got[got.city == city].sort_values("lag").acf, want, atol=1e-12)


def test_numeric_columns_leave_keys_out(raw_df):
    assert profile.numeric_columns(raw_df) == MEASURES
    assert isinstance(profile.reference_stats(raw_df).toPandas(), pd.DataFrame)


def test_brackets_are_narrowed_until_few_values_remain(spark):
    """Coarse sketches and a low bound: several passes, the same quantiles, and no task orders more than the bound."""
    rng = np.random.default_rng(12)
    groups = {"flat": rng.normal(size=6000), "ties": rng.integers(0, 3, 4000).astype(float), "long": rng.exponential(size=9000).cumsum(), "one": np.array([7.0])}
    rows = spark.createDataFrame([(g, float(v)) for g, values in groups.items() for v in values], "g string, value double")
    probs = [0.0, 0.25, 0.5, 0.995, 1.0]
    got = {(r.g, r.prob): r.quantile for r in exact_quantiles(rows, ["g"], probs, accuracy=40, most_inside=30).collect()}
    assert got == {(g, p): pytest.approx(np.quantile(v, p), rel=1e-12) for g, v in groups.items() for p in probs}
    start = rows.groupBy("g").agg(F.count("*").alias("_n"), F.min("value").alias("_low0"), F.max("value").alias("_high0"))
    near = narrowed(rows.withColumnRenamed("value", "_v"), start, ["g"], [0.5], 30, 1000).collect()
    for r in near:
        inside = ((groups[r.g] >= r._low0) & (groups[r.g] <= r._high0)).sum()
        assert inside <= 30 or r._low0 == r._high0
        assert r._low0 <= np.quantile(groups[r.g], 0.5) <= r._high0


def test_autocorrelation_of_unlike_series(spark):
    rng = np.random.default_rng(13)
    start = pd.Timestamp("2026-01-01")
    values = {"far": 1e5 + rng.normal(size=700).cumsum(), "short": rng.normal(size=5), "flat": np.full(90, 3.25)}
    rows = spark.createDataFrame([(c, (start + pd.Timedelta(hours=i)).to_pydatetime(), float(x)) for c, v in values.items() for i, x in enumerate(v)], "city string, date timestamp_ntz, european_aqi double")
    got = {(r.city, r.lag): r.acf for r in autocorrelation(rows, 9, chunk_rows=100).collect()}
    for c, v in values.items():
        d = v - v.mean()
        for k in range(10):
            want = None if c == "flat" or k >= len(v) else (d[k:] * d[:len(d) - k]).sum() / (d * d).sum()
            assert got[c, k] == (want if want is None else pytest.approx(want, abs=1e-9))
