"""Model versions as a table: one row per (name, version), appended and never changed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hazeline.schema import MISSING_RMSE, REGISTRY_SCHEMA
from hazeline.sources.feature_table import child_names


def next_versions(runs: DataFrame, registry: DataFrame | None, order: str) -> DataFrame:
    """Number new runs per name, on from the highest version known."""
    turn = F.row_number().over(Window.partitionBy("name").orderBy(order))
    if registry is None:
        return runs.withColumn("version", turn)
    known = registry.groupBy("name").agg(F.max("version").alias("_top"))
    return (
        runs.join(known, "name", "left")
        .withColumn("version", turn + F.coalesce("_top", F.lit(0))).drop("_top")
    )


def best_version(registry: DataFrame, metric: str = "rmse", direction: str = "min") -> DataFrame:
    """One row per name; equal metrics go to the older version."""
    if direction not in ("min", "max"):
        raise ValueError(f"direction is min or max, not {direction!r}")
    ranked = F.col(metric).asc_nulls_last() if direction == "min" else F.col(metric).desc_nulls_last()
    place = F.row_number().over(Window.partitionBy("name").orderBy(ranked, "version"))
    return registry.withColumn("_rn", place).where("_rn = 1").drop("_rn")


def production_model(best: DataFrame, candidates: Sequence[str]) -> DataFrame:
    """Per horizon, the candidate with the least rmse; a missing one counts as very large.

    `best` has one row per (model, horizon); ties go to the earlier candidate.
    """
    turn = F.array_position(F.array(*map(F.lit, candidates)), F.col("model"))
    known = best.where(F.col("model").isin(*candidates))
    row = F.struct(*[c for c in best.columns if c != "horizon"])
    error = F.struct(F.coalesce("rmse", F.lit(MISSING_RMSE)), turn)
    return known.groupBy("horizon").agg(F.min_by(row, error).alias("_row")).select("horizon", "_row.*")


def training_winner(metrics: DataFrame, candidates: Sequence[str]) -> DataFrame:
    """Per horizon, the model with the highest skill; only a missing skill ranks last."""
    turn = F.array_position(F.array(*map(F.lit, candidates)), F.col("model"))
    row = F.struct(*[c for c in metrics.columns if c != "horizon"])
    value = F.struct(F.coalesce("skill_vs_naive", F.lit(float("-inf"))), -turn)
    return metrics.groupBy("horizon").agg(F.max_by(row, value).alias("_row")).select("horizon", "_row.*")


class ModelRegistry:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def rows(self) -> DataFrame:
        if not child_names(self.spark, self.path):
            return self.spark.createDataFrame([], REGISTRY_SCHEMA)
        return self.spark.read.schema(REGISTRY_SCHEMA).parquet(self.path)

    def register(self, runs: DataFrame, order: str = "created_at") -> DataFrame:
        """Append runs (name, horizon, metrics, path, created_at) with their new versions."""
        return self.append(next_versions(runs, self.rows(), order))

    def append(self, numbered: DataFrame) -> DataFrame:
        numbered.select(REGISTRY_SCHEMA.names).write.mode("append").parquet(self.path)
        return self.rows()

    def best(self, name: str, metric: str = "rmse", direction: str = "min"):
        return best_version(self.rows().where(F.col("name") == name), metric, direction).first()
