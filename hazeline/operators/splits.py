"""Chronological splits by rank over (date, city), without ranking the rows.

A cut at rank r is the key of the row with that rank. It is found from counts
per date and, on the one date where the cut falls, from that date's cities.
The split itself is then a comparison with two literals: no shuffle, and the
date part reaches the file scan.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Cut = tuple[datetime, str]


def before(cut: Cut) -> Column:
    date, city = _date(cut[0]), F.lit(cut[1])
    return (F.col("date") < date) | ((F.col("date") == date) & (F.col("city") < city))


Ranks = Callable[[Column], list[Column]]


def cut_points(df: DataFrame, ranks: Ranks) -> list[Cut]:
    """Keys of the rows at the 0-based ranks that `ranks` derives from the row count."""
    dates = df.groupBy("date").agg(F.count("*").alias("_n")).withColumn("_month", F.trunc("date", "month"))
    # Running totals in two steps; only the handful of month totals shares a task.
    months = Window.orderBy("_month")
    bases = dates.groupBy("_month").agg(F.sum("_n").alias("_total")).select(
        "_month",
        F.coalesce(F.sum("_total").over(months.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_base"),
        F.sum("_total").over(months.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_all"),
    )
    in_month = Window.partitionBy("_month").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    running = dates.withColumn("_run", F.sum("_n").over(in_month)).join(bases, "_month")
    end = F.col("_base") + F.col("_run")
    wanted = F.posexplode(F.array(*[r.cast("bigint") for r in ranks(F.col("_all"))])).alias("_cut", "_rank")
    found = (
        running.select("date", (end - F.col("_n")).alias("_start"), end.alias("_end"), wanted)
        .where("_start <= _rank and _rank < _end").collect()  # one row per cut
    )
    if not found:
        return []
    # On a cut's own date, cities decide. Counts per city first: copies of a key collapse map-side.
    days = {row["date"] for row in found}
    on_day = df.where(F.col("date").isin([_date(d) for d in days])).groupBy("date", "city").agg(F.count("*").alias("_n"))
    by_city = Window.partitionBy("date").orderBy("city").rowsBetween(Window.unboundedPreceding, 0)
    upto = F.sum("_n").over(by_city)
    cities = on_day.select("date", "city", (upto - F.col("_n")).alias("_start"), upto.alias("_end"))
    hit = [
        F.when((F.col("date") == _date(r["date"])) & (F.col("_start") <= r["_rank"] - r["_start"])
               & (F.lit(r["_rank"] - r["_start"]) < F.col("_end")), F.lit(r["_cut"]))
        for r in found
    ]
    cuts = F.array_compact(F.array(*hit))
    keys = {
        row["_cut"]: (row["date"], row["city"])
        for row in cities.select("date", "city", F.explode(cuts).alias("_cut")).collect()  # one row per cut
    }
    return [keys[i] for i in sorted(keys)]


def _date(value: datetime) -> Column:
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def _size(n: Column, share: float) -> Column:
    """int(n * (1 - share)), the length of the first part."""
    return F.floor(n * (1 - share))


def holdout(df: DataFrame, test_frac: float = 0.2) -> DataFrame:
    """Add `split`: the first int(n * (1 - test_frac)) rows are 'train', the rest 'test'."""
    cuts = cut_points(df, lambda n: [_size(n, test_frac)])
    if not cuts:  # the cut lies behind the last row
        return df.withColumn("split", F.lit("train"))
    return df.withColumn("split", F.when(before(cuts[0]), "train").otherwise("test"))


def tail_flag(df: DataFrame, share: float) -> Column:
    """True for the last `share` of the rows."""
    cuts = cut_points(df, lambda n: [_size(n, share)])
    return ~before(cuts[0]) if cuts else F.lit(False)


def fold_starts(n: Column, n_splits: int = 5) -> list[Column]:
    """First test rank of each expanding fold; the test parts hold n // (n_splits + 1) rows each."""
    size = F.floor(n / (n_splits + 1))
    return [n - (n_splits - i) * size for i in range(n_splits)]


def blocks(df: DataFrame, n_splits: int = 5) -> DataFrame:
    """Add `block`: 0 before the first test part, then 1..n_splits.

    Fold i tests on block i and trains on every block before it, so one column
    describes all folds and no row is copied.
    """
    cuts = cut_points(df, lambda n: fold_starts(n, n_splits))
    if len(cuts) < n_splits:
        raise ValueError(f"Too few rows for {n_splits} folds")
    block = F.lit(0)
    for cut in cuts:
        block = block + F.when(before(cut), 0).otherwise(1)
    return df.withColumn("block", block)


def fold(blocked: DataFrame, number: int) -> tuple[DataFrame, DataFrame]:
    return blocked.where(F.col("block") < number), blocked.where(F.col("block") == number)


def fold_table(blocked: DataFrame, n_splits: int = 5) -> DataFrame:
    """(fold, split, n, first_date, last_date), from one count per block."""
    per_block = blocked.groupBy("block").agg(
        F.count("*").alias("n"), F.min("date").alias("first_date"), F.max("date").alias("last_date")
    )
    # Block b is test in fold b and train in every later fold.
    folds = F.sequence(F.greatest(F.col("block"), F.lit(1)), F.lit(n_splits))
    roles = per_block.withColumn("fold", F.explode(folds)).withColumn(
        "split", F.when(F.col("block") == F.col("fold"), "test").otherwise("train")
    )
    return roles.groupBy("fold", "split").agg(
        F.sum("n").alias("n"), F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date")
    )


def make_split(df: DataFrame, method: str = "timeseries", **kwargs) -> DataFrame:
    if method == "holdout":
        return holdout(df, **kwargs)
    if method == "timeseries":
        return blocks(df, **kwargs)
    raise ValueError(f"no way to split called {method!r}")
