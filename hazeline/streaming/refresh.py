"""Feature refresh driven by newly landed raw files.

Each micro-batch is upserted into a raw table; features are then recomputed for
the days of the stations that the batch can change. A late row simply falls into an
earlier range, and the upsert replaces what it changes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hazeline.operators.features import WARMUP_ROWS, add_features, complete_rows
from hazeline.schema import FORECAST_HORIZON, RAW_SCHEMA
from hazeline.session import written
from hazeline.sources.feature_table import FeatureTable
from hazeline.sources.files import clean


def apply_batch(
    batch: DataFrame, raw: FeatureTable, features: FeatureTable, horizon: int = FORECAST_HORIZON,
) -> None:
    batch = clean(batch)
    spans = written(batch.groupBy("city").agg(F.min("date").alias("first"), F.max("date").alias("last")), "spans")
    if spans.isEmpty():
        return
    raw.upsert(batch)
    # Rows before the batch gain targets from it, rows after it look back on it; and
    # both need the frames and targets at their own edges.
    back, ahead = WARMUP_ROWS, 24 * horizon
    counts = raw.counts() if raw.counted else raw.read().groupBy("city", F.to_date("date").alias("day")).agg(F.count("*").alias("n"))
    reach = written(reached_days(counts, spans, back, ahead), "reach")
    ends = reach.agg(F.min("read_from").alias("start"), F.max("read_to").alias("end")).first()
    rows = raw.read(str(ends["start"]), str(ends["end"])).join(reach.select("city"), "city", "left_semi")
    found = complete_rows(add_features(rows, horizon)).join(reach, "city").where(F.to_date("date").between(F.col("from"), F.col("to")))
    features.upsert(found.select(features.schema.names))


def reached_days(counts: DataFrame, spans: DataFrame, back: int, ahead: int) -> DataFrame:
    """(city, read_from, from, to, read_to): the days whose features a batch can change, and the days to read for them.

    Frames count rows, so the days are found from the rows (city, day, n) of each city and day, not from the calendar.
    """
    counts = counts.join(spans, "city")
    before = counts.where(F.col("day") < F.to_date("first")).withColumn(
        "rows", F.sum("n").over(Window.partitionBy("city").orderBy(F.desc("day"))))
    after = counts.where(F.col("day") > F.to_date("last")).withColumn("rows", F.sum("n").over(Window.partitionBy("city").orderBy("day")))

    def near(days: DataFrame, enough: int, name: str, nearest, farthest) -> DataFrame:
        held = nearest(F.when(F.col("rows") >= enough, F.col("day")))
        return days.groupBy("city").agg(F.coalesce(held, farthest("day")).alias(name))

    out = spans
    for days, enough, name, nearest, farthest in (
        (before, ahead, "from", F.max, F.min), (before, ahead + back, "read_from", F.max, F.min),
        (after, back, "to", F.min, F.max), (after, back + ahead, "read_to", F.min, F.max),
    ):
        out = out.join(near(days, enough, name, nearest, farthest), "city", "left")
    own = {"from": "first", "read_from": "first", "to": "last", "read_to": "last"}
    return out.select("city", *[F.coalesce(name, F.to_date(edge)).alias(name) for name, edge in own.items()])


def refresh_stream(
    spark: SparkSession, landing: str, raw: FeatureTable, features: FeatureTable, checkpoint: str, **kwargs
) -> StreamingQuery:
    """Process all files landed since the last run, then stop. Replaying a batch changes nothing."""
    landed = spark.readStream.schema(RAW_SCHEMA).parquet(landing)
    return (
        landed.writeStream.foreachBatch(lambda batch, _: apply_batch(batch, raw, features, **kwargs))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
