"""Distribution statistics: reference stats, histograms, boxes, correlation, autocorrelation, scaling, capping."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazeline.functions.measures import clip_upper
from hazeline.operators.quantiles import exact_quantiles
from hazeline.operators.series import CHUNK_ROWS, along_series
from hazeline.schema import CAPPED_COLUMNS, HISTOGRAM_COLUMNS, KEYS, targets


def numeric_columns(df: DataFrame) -> list[str]:
    """Numeric columns without the keys."""
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in KEYS]


def long_form(one_row: DataFrame, columns: Sequence[str], value: str) -> DataFrame:
    """A one-row aggregate as (column, value) rows."""
    entries = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias(value)) for c in columns])
    return one_row.select(F.inline(entries))


def as_readings(df: DataFrame, columns: Sequence[str], ids: Sequence[str] = ()) -> DataFrame:
    """(ids, column, value) rows as double; expanded map-side."""
    doubles = [F.col(c).cast("double").alias(c) for c in columns]
    return df.select(*ids, *doubles).unpivot(list(ids), list(columns), "column", "value")


def reference_stats(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, mean, std): mean and sample deviation in one pass."""
    columns = columns or numeric_columns(df)
    stats = df.agg(*[
        F.struct(F.avg(c).alias("mean"), F.stddev_samp(c).alias("std")).alias(c) for c in columns
    ])
    return long_form(stats, columns, "_s").select("column", "_s.mean", "_s.std")


# ---- quantile-based ---------------------------------------------------------

def robust_scaling(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, median, iqr) of the training rows; a zero range scales by 1."""
    quartiles = exact_quantiles(as_readings(train, columns), ["column"], [0.25, 0.5, 0.75])

    def q(p: float) -> Column:
        return F.max(F.when(F.col("prob") == p, F.col("quantile")))

    spread = q(0.75) - q(0.25)
    return quartiles.groupBy("column").agg(
        q(0.5).alias("median"), F.when(spread == 0, 1.0).otherwise(spread).alias("iqr")
    )


def standard_scaling(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, mean, std, scale): the population deviation as it is, and as a divisor, where zero scales by 1."""
    stats = train.agg(*[
        F.struct(F.avg(c).alias("mean"), F.stddev_pop(c).alias("std")).alias(c) for c in columns
    ])
    scale = F.when(F.col("_s.std") == 0, 1.0).otherwise(F.col("_s.std"))
    return long_form(stats, columns, "_s").select("column", "_s.mean", "_s.std", scale.alias("scale"))


def apply_scaling(df: DataFrame, scaling: DataFrame, centre: str, spread: str) -> DataFrame:
    """Scale columns by fitted (column, centre, spread) rows: one row per column, so they travel as literals."""
    fitted = {r["column"]: (r[centre], r[spread]) for r in scaling.collect()}
    return df.withColumns({c: (F.col(c) - mid) / width for c, (mid, width) in fitted.items()})


def cap_thresholds(
    df: DataFrame, is_train: Column, columns: Sequence[str] = CAPPED_COLUMNS, upper: float = 0.995
) -> DataFrame:
    """(column, threshold, n_capped, share): upper quantile of the training rows, and rows above it in all."""
    limits = exact_quantiles(as_readings(df.where(is_train), columns), ["column"], [upper])
    readings = as_readings(df, columns).join(
        F.broadcast(limits.select("column", F.col("quantile").alias("threshold"))), "column"  # a row per column
    )
    return readings.groupBy("column", "threshold").agg(
        F.count_if(F.col("value") > F.col("threshold")).alias("n_capped"),
        (F.count_if(F.col("value") > F.col("threshold")) * 100.0 / F.count("*")).alias("percent_capped"),
    )


def cap_outliers(
    df: DataFrame, is_train: Column, columns: Sequence[str] = CAPPED_COLUMNS, upper: float = 0.995
) -> DataFrame:
    """Clip columns from above; missing stays missing."""
    limits = exact_quantiles(as_readings(df.where(is_train), columns), ["column"], [upper])
    fitted = {r["column"]: r["quantile"] for r in limits.collect()}  # one row per column
    return df.withColumns({c: clip_upper(F.col(c), limit) for c, limit in fitted.items()})


def monthly_box(df: DataFrame, value: str = "european_aqi") -> DataFrame:
    """Quartiles, 1.5-IQR whiskers and outlier count per calendar month."""
    data = df.select(F.month("date").alias("month"), F.col(value).alias("value")).where("value is not null")
    quartiles = exact_quantiles(data, ["month"], [0.25, 0.5, 0.75])

    def q(p: float) -> Column:
        return F.max(F.when(F.col("prob") == p, F.col("quantile")))

    boxes = quartiles.groupBy("month").agg(q(0.25).alias("q1"), q(0.5).alias("median"), q(0.75).alias("q3"))
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    fenced = boxes.withColumns({"_low": F.col("q1") - reach, "_high": F.col("q3") + reach})
    inside = F.col("value").between(F.col("_low"), F.col("_high"))
    joined = data.join(F.broadcast(fenced), "month")  # at most 12 rows
    return joined.groupBy("month", "q1", "median", "q3").agg(
        F.count("*").alias("n"),
        F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
        F.count_if(~inside).alias("n_outliers"),
    )


def histograms(df: DataFrame, columns: Sequence[str] = HISTOGRAM_COLUMNS, bins: int = 50) -> DataFrame:
    """(column, bin, n) over equal-width bins; the last bin includes the maximum. Empty bins are left out."""
    readings = as_readings(df, columns).where("value is not null")
    spans = df.agg(*[F.struct(F.min(c).cast("double").alias("lo"), F.max(c).cast("double").alias("hi")).alias(c)
                     for c in columns])
    bounds = long_form(spans, columns, "_s").select("column", "_s.lo", "_s.hi")
    width = (F.col("hi") - F.col("lo")) / bins
    spot = F.when(width > 0, F.least(F.floor((F.col("value") - F.col("lo")) / width), F.lit(bins - 1))).otherwise(0)
    return (
        readings.join(F.broadcast(bounds), "column")  # one row per column
        .groupBy("column", spot.cast("int").alias("bin")).agg(F.count("*").alias("n"))
    )


# ---- correlation ------------------------------------------------------------

_MOMENTS = ["n", "sx", "sy", "sxx", "syy", "sxy"]


def pair_moments(columns: Sequence[str], centres: Sequence[float]):
    """Per partition, sums over rows where both columns of a pair are present, as matrix products."""
    width = len(columns)
    upper = np.triu_indices(width)
    names = np.array(columns, dtype=object)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals = np.zeros((len(_MOMENTS), width, width))
        low, high = np.full((width, width), np.inf), np.full((width, width), -np.inf)
        for batch in batches:
            shifted = batch.to_numpy(dtype=float) - np.asarray(centres)
            present = ~np.isnan(shifted)
            x, seen = np.where(present, shifted, 0.0), present.astype(float)
            for j in range(width):  # least and greatest value of each column where column j has one
                here = present & present[:, j:j + 1]
                if len(batch):
                    low[:, j] = np.minimum(low[:, j], np.where(here, shifted, np.inf).min(axis=0))
                    high[:, j] = np.maximum(high[:, j], np.where(here, shifted, -np.inf).max(axis=0))
            totals += np.stack([
                seen.T @ seen, x.T @ seen, seen.T @ x, (x * x).T @ seen, seen.T @ (x * x), x.T @ x,
            ])
        cells = {m: totals[i][upper] for i, m in enumerate(_MOMENTS)}
        ends = {"x_low": low[upper], "x_high": high[upper], "y_low": low.T[upper], "y_high": high.T[upper]}
        yield pd.DataFrame({"feature_a": names[upper[0]], "feature_b": names[upper[1]], **cells, **ends})

    return run


def correlations(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(feature_a, feature_b, correlation) for a <= b in column order, pairwise complete.

    A pass for the means keeps the sums of squares well conditioned; the second
    pass does one small matrix product per Arrow batch and emits one row per
    pair and partition.
    """
    columns = [c for c in (columns or numeric_columns(df))]
    means = df.agg(*[F.coalesce(F.avg(c), F.lit(0.0)).alias(c) for c in columns]).first()
    ends = {"x_low": F.min, "x_high": F.max, "y_low": F.min, "y_high": F.max}
    schema = "feature_a string, feature_b string, " + ", ".join(f"{m} double" for m in [*_MOMENTS, *ends])
    doubles = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    partial = doubles.mapInPandas(pair_moments(columns, [means[c] for c in columns]), schema)
    sums = partial.groupBy("feature_a", "feature_b").agg(
        *[F.sum(m).alias(m) for m in _MOMENTS], *[f(m).alias(m) for m, f in ends.items()])
    n = F.col("n")
    vx, vy = F.col("sxx") - F.col("sx") ** 2 / n, F.col("syy") - F.col("sy") ** 2 / n
    cov = F.col("sxy") - F.col("sx") * F.col("sy") / n
    varies = (F.col("x_low") < F.col("x_high")) & (F.col("y_low") < F.col("y_high"))
    corr = F.when((n > 1) & varies, F.try_divide(cov, F.sqrt(vx) * F.sqrt(vy)))
    return sums.select("feature_a", "feature_b", corr.alias("correlation"))


def redundant_pairs(df: DataFrame, columns: Sequence[str] | None = None, limit: float = 0.9) -> DataFrame:
    """Feature pairs with |correlation| above the limit, strongest first; targets left out."""
    columns = [c for c in (columns or numeric_columns(df)) if not c.startswith("aqi_next_")]
    pairs = correlations(df, columns).where("feature_a <> feature_b")
    return pairs.where(F.abs("correlation") > limit).orderBy(
        F.abs("correlation").desc(), "feature_a", "feature_b"
    )


def autocorrelation(
    df: DataFrame, lags: int = 72, value: str = "european_aqi", chunk_rows: int | None = CHUNK_ROWS
) -> DataFrame:
    """(city, lag, acf) with divisor n, nulls dropped first."""
    series = df.select("city", "date", F.col(value).alias("_x")).where("_x is not null")
    means = series.groupBy("city").agg(F.avg("_x").alias("_mean"))
    centred = series.join(means, "city").select("city", "date", (F.col("_x") - F.col("_mean")).alias("_d"))
    shifted = along_series(
        centred, lambda w: {f"_lag{k}": F.lag("_d", k).over(w) for k in range(1, lags + 1)},
        back=lags, chunk_rows=chunk_rows,
    )
    sums = shifted.groupBy("city").agg(
        F.sum(F.col("_d") * F.col("_d")).alias("_s0"),
        *[F.sum(F.col("_d") * F.col(f"_lag{k}")).alias(f"_s{k}") for k in range(1, lags + 1)],
    )
    entries = F.array(*[
        F.struct(F.lit(k).alias("lag"), F.try_divide(F.col(f"_s{k}"), F.col("_s0")).alias("acf"))
        for k in range(lags + 1)
    ])
    return sums.select("city", F.inline(entries))


def model_columns(df: DataFrame) -> list[str]:
    """The model matrix: every numeric column but keys, targets and the delta."""
    return [c for c in numeric_columns(df) if c != "target_delta" and not c.startswith("aqi_next_")]
