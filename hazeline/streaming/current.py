"""The newest reading of each city, kept from a stream of payload files that may come late and out of order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hazeline.sources.feature_table import child_names
from hazeline.sources.landed import current_rows, current_schema, reader, sorted_out


def newest(rows: DataFrame) -> DataFrame:
    """One row per city. Among readings of the same instant the choice depends on their content only, so the order of
    arrival changes nothing. The state holds one row per city; `max_by` combines before the shuffle."""
    rest = [c for c in rows.columns if c != "city"]
    order = F.struct("time", F.xxhash64(*rest).alias("tie"))
    kept = rows.groupBy("city").agg(F.max_by(F.struct(*rest), order).alias("_row"))
    return kept.select("city", "_row.*").select(*rows.columns)


def follow_current(spark: SparkSession, landing: str, variables: Sequence[str], target: str, checkpoint: str, prefix: str = "", kind: str = "json") -> StreamingQuery:
    """Process all payload files landed since the last run, then stop.

    Every batch writes the whole table, one row per city, to a folder of its own under `target`; a batch that runs again
    replaces its own folder. Bad payloads are left out here; `landed.sorted_out` shows them.
    """
    payloads = reader(spark, current_schema(variables), kind, stream=True).load(landing)
    good, _ = sorted_out(payloads, "current", variables)

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/{number:012d}")

    return (
        newest(current_rows(good, variables, prefix)).writeStream.outputMode("complete").foreachBatch(put)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def read_current(spark: SparkSession, target: str) -> DataFrame:
    """The table after the last finished batch."""
    batches = sorted(child_names(spark, target), reverse=True)
    done = next((b for b in batches if "_SUCCESS" in child_names(spark, f"{target}/{b}")), None)
    if done is None:
        raise ValueError(f"no finished batch in {target}")
    return spark.read.parquet(f"{target}/{done}").drop("time")
