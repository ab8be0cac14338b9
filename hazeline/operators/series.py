"""Windows along a time series that do not put a whole series into one task.

A plain `Window.partitionBy("city")` sends all rows of a city to one task, so
one long series decides how long the job runs. Where any series has more than
`chunk_rows` rows, series are cut into chunks of about that size, and every
(series, chunk) also receives the rows just before and after it that its frames
reach. Results are the same as with the plain window, gaps included, because the
reach is counted in rows.

A row's own chunk is arithmetic on its date for a series with up to one row per
hour. The weeks next to a chunk border, and those of denser series, are listed
in a layout table made from row counts per (series, week). It is written first,
so that Spark knows its size when it plans: below
`spark.sql.autoBroadcastJoinThreshold` it is broadcast and the panel is shuffled
once, on (series, chunk); above, it is a shuffled join.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from hazeline.schema import WEEK_HOURS
from hazeline.session import written

CHUNK_ROWS = 200 * WEEK_HOURS
WEEK_SECONDS = WEEK_HOURS * 3600

Stage = Callable[[WindowSpec], dict[str, Column]]


def seconds_of(date: str) -> Column:
    """Seconds since a Monday, for zoned and zone-free timestamps alike."""
    days = F.datediff(F.to_date(date), F.lit("1970-01-05")).cast("bigint")
    return days * 86400 + F.hour(date) * 3600 + F.minute(date) * 60 + F.second(date)


def longest_series(df: DataFrame, keys: Sequence[str]) -> int:
    return df.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0


def count_buckets(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return written(df.groupBy(*keys, "_unit", "_bucket").agg(F.count("*").alias("_n")), "buckets")


def with_buckets(df: DataFrame, keys: Sequence[str], order: str, chunk_rows: int) -> tuple[DataFrame, DataFrame]:
    """Add `_unit` and `_bucket`, weeks in general; and the counts per bucket.

    A series whose fullest week alone is more than a chunk gets shorter buckets.
    """
    seconds = seconds_of(order)
    weekly = df.withColumns({"_unit": F.lit(WEEK_SECONDS), "_bucket": F.floor(seconds / WEEK_SECONDS)})
    counts = count_buckets(weekly, keys)
    fullest = counts.groupBy(*keys).agg(F.max("_n").alias("_most")).where(F.col("_most") > chunk_rows)
    dense = written(
        fullest.select(*keys, F.greatest(F.lit(1), F.floor(WEEK_SECONDS * chunk_rows / (4 * F.col("_most")))).alias("_own_unit")),
        "dense",
    )
    if dense.isEmpty():
        return weekly, counts
    unit = F.coalesce("_own_unit", F.lit(WEEK_SECONDS))
    finer = df.join(dense, list(keys), "left").withColumns({"_unit": unit, "_bucket": F.floor(seconds / unit)})
    finer = finer.select(*df.columns, "_unit", "_bucket")
    return finer, count_buckets(finer, keys)


def hourly_chunk(chunk_rows: int) -> Column:
    """The chunk of a week in a series with up to one row per hour."""
    return F.floor(F.col("_bucket") / max(1, chunk_rows // WEEK_HOURS))


def chunk_layout(counts: DataFrame, keys: Sequence[str], back: int, ahead: int, chunk_rows: int) -> DataFrame:
    """(keys, _unit, _bucket, _home, _from, _to) for buckets whose chunks do not follow from the date alone."""
    series = Window.partitionBy(*keys)
    in_order = series.orderBy("_bucket")
    most = F.max("_n").over(series)
    hourly = (F.col("_unit") == WEEK_SECONDS) & (most <= WEEK_HOURS)
    home = F.when(hourly, hourly_chunk(chunk_rows)).otherwise(
        F.floor(F.col("_bucket") / F.greatest(F.lit(1), F.floor(chunk_rows / most)))
    )
    ranked = counts.select(
        *keys, "_unit", "_bucket", "_n", hourly.alias("_hourly"), home.alias("_home"),
        F.sum("_n").over(in_order.rowsBetween(Window.unboundedPreceding, 0)).alias("_last"),
    ).withColumn("_first", F.col("_last") - F.col("_n") + 1)
    beside = ranked.withColumns({"_next": F.lead("_home").over(in_order), "_prev": F.lag("_home").over(in_order)})
    # Bucket b reaches bucket w when the bucket before w ends less than `back` rows after b.
    later = series.orderBy("_last").rangeBetween(0, max(back - 1, 0))
    earlier = series.orderBy("_first").rangeBetween(-max(ahead - 1, 0), 0)
    own = F.col("_home")
    reach = beside.select(
        *keys, "_unit", "_bucket", "_hourly", "_home",
        (F.coalesce(F.min("_prev").over(earlier), own) if ahead else own).alias("_from"),
        (F.coalesce(F.max("_next").over(later), own) if back else own).alias("_to"),
    )
    return reach.where("not _hourly or _from < _home or _to > _home").drop("_hourly")


def with_chunks(
    df: DataFrame, keys: Sequence[str], order: str, back: int, ahead: int, chunk_rows: int
) -> DataFrame:
    """Add `_chunk` and `_own`; rows near a chunk border appear once more per neighbour with `_own` false."""
    bucketed, counts = with_buckets(df, keys, order, chunk_rows)
    layout = written(chunk_layout(counts, keys, back, ahead, chunk_rows), "layout")
    home = F.coalesce("_home", hourly_chunk(chunk_rows))
    return (
        bucketed.join(layout, [*keys, "_unit", "_bucket"], "left")
        .withColumn("_home", home)
        .withColumn("_chunk", F.explode(F.sequence(F.coalesce("_from", "_home"), F.coalesce("_to", "_home"))))
        .withColumn("_own", F.col("_chunk") == F.col("_home"))
        .select(*df.columns, "_chunk", "_own")
    )


def along_series(
    df: DataFrame,
    *stages: Stage,
    keys: Sequence[str] = ("city",),
    order: str = "date",
    back: int = 0,
    ahead: int = 0,
    chunk_rows: int | None = CHUNK_ROWS,
    carried: Sequence[str] = (),
) -> DataFrame:
    """Add window columns per series.

    Each stage maps a window spec to new columns and may use those of the stage
    before. `back` and `ahead` say how many rows the frames reach in total.
    A null in a column named in `carried` takes the last value of the chunks before.
    `chunk_rows=None` always gives the plain one-task-per-series window.
    Otherwise the keys and dates are counted first: pass a stored frame where
    computing `df` is costly.
    """
    whole = chunk_rows is None or longest_series(df, keys) <= chunk_rows
    if whole:
        framed, spec = df, Window.partitionBy(*keys).orderBy(order)
    else:
        framed = with_chunks(df, keys, order, back, ahead, chunk_rows)
        spec = Window.partitionBy(*keys, "_chunk").orderBy(order)
    for stage in stages:
        framed = framed.withColumns(stage(spec))
    running = spec.rowsBetween(Window.unboundedPreceding, 0)
    filled = {c: F.last(c, ignorenulls=True).over(running) for c in carried}
    if whole:
        return framed.withColumns(filled)
    # rows from beside the chunk may lack a part of their own frames, and are not carried on
    own = framed.where("_own")
    return (carried_over(own, own.withColumns(filled), keys, order, carried) if carried else own).drop("_chunk", "_own")


def carried_over(own: DataFrame, filled: DataFrame, keys: Sequence[str], order: str, columns: Sequence[str]) -> DataFrame:
    """Fill what is still null with the last value of the chunks before; one row per chunk is looked at for that."""
    ends = own.groupBy(*keys, "_chunk").agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in columns])
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    last = written(ends.select(*keys, "_chunk", *[F.last(c, ignorenulls=True).over(before).alias(f"_last_{c}") for c in columns]), "carried")
    joined = filled.join(last, [*keys, "_chunk"], "left")
    return joined.withColumns({c: F.coalesce(c, f"_last_{c}") for c in columns}).select(own.columns)
