import pandas as pd
import pytest
from panels import raw_pandas, sorted_pandas, to_spark
from pyspark.sql import functions as F

from hazeline.operators import splits
from hazeline.operators.features import complete_rows
from hazeline.operators.sequences import sequence_windows
from hazeline.operators.targets import delta_target


def ordered(df) -> pd.DataFrame:
    return sorted_pandas(df, ("date", "city"))


@pytest.mark.parametrize("frac", [0.2, 0.33, 0.01])
def test_holdout_is_a_chronological_cut(raw_df, frac):
    rows = ordered(splits.holdout(raw_df, frac))
    n_train = int(len(rows) * (1 - frac))
    assert list(rows.split) == ["train"] * n_train + ["test"] * (len(rows) - n_train)


def test_holdout_edges(raw_df):
    assert splits.holdout(raw_df, 0.0).where("split = 'test'").count() == 0
    assert splits.holdout(raw_df, 1.0).where("split = 'train'").count() == 0


def test_expanding_folds(raw_df):
    rows = ordered(splits.blocks(raw_df))
    n, size = len(rows), len(rows) // 6
    for i in range(1, 6):
        start = n - (5 - i + 1) * size
        test = rows.index[rows.block == i]
        assert (test[0], test[-1] + 1) == (start, start + size)
    table = {(r["fold"], r["split"]): r["n"] for r in splits.fold_table(splits.blocks(raw_df)).collect()}
    assert table[(5, "train")] == n - size and table[(1, "test")] == size and len(table) == 10


def test_copies_of_one_key_stay_together(spark):
    raw = raw_pandas(rows=50)
    raw = pd.concat([raw, *[raw.iloc[[60]]] * 100], ignore_index=True)
    rows = splits.holdout(to_spark(spark, raw), 0.5)
    hot = rows.where((F.col("city") == raw.city[60]) & (F.col("date") == F.lit(str(raw.date[60])).cast("timestamp_ntz")))
    assert hot.count() == 101 and hot.select("split").distinct().count() == 1


def test_split_by_name(raw_df):
    assert "split" in splits.make_split(raw_df, "holdout").columns
    assert "block" in splits.make_split(raw_df).columns
    with pytest.raises(ValueError, match="no way to split"):
        splits.make_split(raw_df, "random")
    with pytest.raises(ValueError, match="folds"):
        splits.blocks(raw_df.limit(3))


def test_delta_target(engineered_df):
    rows = delta_target(engineered_df, 1)
    assert rows.count() == 2 * (420 - 335 - 24)
    assert delta_target(engineered_df, 1, require_all_horizons=True).count() == 2 * (420 - 335 - 72)
    assert not [c for c in rows.columns if c.startswith("aqi_next_")]
    assert rows.where(F.abs(F.col("target") - F.col("european_aqi") - F.col("target_delta")) > 1e-9).count() == 0
    with pytest.raises(ValueError, match="aqi_next_9d"):
        delta_target(engineered_df, 9)
    assert complete_rows(engineered_df).count() > rows.count()


@pytest.mark.parametrize("chunk_rows", [None, 168])
def test_sequences(raw_df, chunk_rows):
    rows = splits.holdout(raw_df, 0.3)
    features = ["european_aqi", "pm10"]
    flat = sorted_pandas(rows)
    for offset in (0, 1):
        got = sorted_pandas(sequence_windows(
            rows.withColumn("y", F.col("ozone")), features, "y", target_offset=offset, chunk_rows=chunk_rows
        ))
        expected = 0
        for (city, split), part in flat.groupby(["city", "split"]):
            part = part.reset_index(drop=True)
            mine = got[(got.city == city) & (got.split == split)].reset_index(drop=True)
            assert len(mine) == len(part) - 23 - offset
            expected += len(mine)
            last = mine.iloc[-1]
            end = len(part) - 1 - offset
            assert last.y == part.ozone[end + offset]
            assert [list(s) for s in last.sequence] == part[features].iloc[end - 23:end + 1].values.tolist()
        assert len(got) == expected
