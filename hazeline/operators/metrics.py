"""Forecast scores, as one aggregation for any grouping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def skill(rmse: Column, naive_rmse: Column) -> Column:
    """1 - rmse / naive rmse; missing when the naive forecast is perfect."""
    return F.when(naive_rmse > 0, 1 - rmse / naive_rmse)


def r_squared(sse: Column, sst: Column) -> Column:
    return F.when(sst > 0, 1 - sse / sst).when(sse > 0, F.lit(0.0)).otherwise(F.lit(1.0))


def score(
    df: DataFrame, by: Sequence[str], actual: str = "actual", predicted: str = "predicted", naive: str | None = "naive"
) -> DataFrame:
    """(by, n, r2, mae, mse, rmse, skill_vs_naive[, naive_r2, naive_rmse]) per group."""
    y, error = F.col(actual), F.col(actual) - F.col(predicted)
    parts = [
        F.count("*").alias("n"),
        F.avg(F.abs(error)).alias("mae"),
        F.avg(error * error).alias("mse"),
        F.var_pop(y).alias("_spread"),
    ]
    if naive:
        miss = y - F.col(naive)
        parts.append(F.avg(miss * miss).alias("_naive_mse"))
    sums = df.groupBy(*by).agg(*parts)
    rmse = F.sqrt("mse")
    out = [*by, "n", r_squared(F.col("mse"), F.col("_spread")).alias("r2"), "mae", "mse", rmse.alias("rmse")]
    if naive:
        naive_rmse = F.sqrt("_naive_mse")
        out += [
            skill(rmse, naive_rmse).alias("skill_vs_naive"),
            r_squared(F.col("_naive_mse"), F.col("_spread")).alias("naive_r2"),
            naive_rmse.alias("naive_rmse"),
        ]
    else:
        out.append(F.lit(None).cast("double").alias("skill_vs_naive"))
    return sums.select(*out)


def skill_by_month(df: DataFrame, **columns) -> DataFrame:
    """(month, n, rmse, skill_vs_naive) by calendar month of the scored row."""
    scored = score(df.withColumn("month", F.month("date")), ["month"], **columns)
    return scored.select("month", "n", "rmse", "skill_vs_naive").orderBy("month")


def leaderboard(metrics: DataFrame) -> DataFrame:
    return metrics.orderBy(F.col("skill_vs_naive").desc_nulls_last(), "model", "horizon")


def residuals(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    return df.withColumn("residual", F.col(actual) - F.col(predicted))


def persistence(df: DataFrame, horizons: Sequence[int]) -> DataFrame:
    """(city, date, horizon, actual, predicted, naive): tomorrow is like now, for every horizon at once."""
    outcome = F.array(*[
        F.struct(F.lit(h).alias("horizon"), F.col(f"aqi_next_{h}d").alias("actual")) for h in horizons
    ])
    rows = df.select("city", "date", "european_aqi", F.inline(outcome)).where("actual is not null")
    return rows.select(
        "city", "date", "horizon", "actual",
        F.col("european_aqi").alias("predicted"), F.col("european_aqi").alias("naive"),
    )


def fold_summary(fold_scores: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean and sample deviation over folds."""
    stats = fold_scores.agg(*[
        F.struct(F.avg(c).alias("mean"), F.stddev_samp(c).alias("std")).alias(c) for c in columns
    ])
    entries = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).alias("_s")) for c in columns])
    return stats.select(F.inline(entries)).select("metric", "_s.mean", "_s.std")
