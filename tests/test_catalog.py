"""A sample of the registered queries against their check SQL; the full comparison runs outside the tests."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as contract

SF = "/root/testdata/sf0.01"
SAMPLE = ["engineered", "f_ewm", "gaps", "null_rates", "holdout_split", "timeseries_folds", "monthly_box", "drift_ks",
          "upsert_features", "explode_hourly_payload", "aqi_alerts", "latest_features", "redundant_pairs"]


def normal(df: pd.DataFrame) -> pd.DataFrame:
    out = df[sorted(df.columns)].copy()
    for c in out:
        if out[c].dtype.kind == "M":
            out[c] = out[c].astype("datetime64[us]")
    out = out.astype(object).where(out.notna(), None)
    return out.sort_values(list(out.columns), key=lambda s: s.astype(str)).reset_index(drop=True)


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_its_check(spark, name):
    con = duckdb.connect()
    con.execute(f"create view events as select * from '{SF}/events.parquet'")
    want = con.execute(contract.oracle_sql()[name]).df()
    got = contract.queries()[name](spark, SF).toPandas()
    pd.testing.assert_frame_equal(normal(got), normal(want), check_dtype=False, rtol=0, atol=0)


def test_every_check_belongs_to_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() == 196
