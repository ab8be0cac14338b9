"""The training grid: every model for every horizon, scored, registered."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeline.learn.models import MODELS, DeltaForecaster, fit
from hazeline.learn.validation import PARALLEL_FITS, scored_rows, union_all
from hazeline.operators.metrics import score
from hazeline.operators.splits import holdout
from hazeline.operators.targets import delta_target
from hazeline.session import written
from hazeline.sources.registry import ModelRegistry, next_versions

log = logging.getLogger(__name__)


def run(
    snapshot: DataFrame,
    horizons: Sequence[int] = (1, 2, 3),
    kinds: Sequence[str] = tuple(MODELS),
    settings: dict[str, dict] | None = None,
    test_frac: float = 0.2,
) -> tuple[DataFrame, dict[tuple[str, int], DeltaForecaster]]:
    """Metrics (model, horizon, n, ...) and the fitted models.

    `snapshot` should be a stored table: each horizon reads it again. A model
    that fails is logged and left out; the rest go on.
    """
    frames = {h: holdout(delta_target(snapshot, h), test_frac) for h in horizons}
    fitted: dict[tuple[str, int], DeltaForecaster] = {}

    def one(job: tuple[str, int]) -> DataFrame | None:
        kind, horizon = job
        frame = frames[horizon]
        try:
            model = fit(kind, frame.where("split = 'train'").drop("split"), horizon, (settings or {}).get(kind))
        except Exception:
            log.exception("Training failed for %s, horizon %d", kind, horizon)
            return None
        fitted[job] = model
        return scored_rows(model, frame.where("split = 'test'")).select(
            "*", F.lit(kind).alias("model"), F.lit(horizon).alias("horizon")
        )

    jobs = [(kind, horizon) for horizon in horizons for kind in kinds]
    with ThreadPoolExecutor(PARALLEL_FITS) as pool:
        predictions = [p for p in pool.map(one, jobs) if p is not None]
    if not predictions:
        raise RuntimeError("every fit failed")
    return score(union_all(predictions), ["model", "horizon"]), fitted


def register(
    registry: ModelRegistry, metrics: DataFrame, fitted: dict[tuple[str, int], DeltaForecaster], model_root: str
) -> DataFrame:
    """Number each fitted model on from the versions of its name, save it under that number, then append the rows.

    A version's files are its own: a later run never touches them.
    """
    name = F.concat(F.lit("aqi_"), "model", F.lit("_h"), F.col("horizon").cast("string"))
    runs = metrics.select(
        name.alias("name"), "model", "horizon", "r2", "mae", "mse", "rmse", "skill_vs_naive",
        F.current_timestamp().cast("timestamp_ntz").alias("created_at"),
    )
    path = F.concat(F.lit(f"{model_root}/"), "name", F.lit("/v"), F.col("version").cast("string"))
    numbered = written(next_versions(runs, registry.rows(), "created_at").withColumn("path", path), "versions")
    for row in numbered.select("model", "horizon", "path").collect():  # one row per fitted model
        fitted[row["model"], row["horizon"]].save(row["path"])
    return registry.append(numbered)


def horizon_comparison(metrics: DataFrame, horizons: Sequence[int] = (1, 2, 3)) -> DataFrame:
    """One row per model with its rmse and skill at each horizon."""
    cells = [
        F.max(F.when(F.col("horizon") == h, F.col(m))).alias(f"{m}_{h}d")
        for m in ("rmse", "skill_vs_naive") for h in horizons
    ]
    return metrics.groupBy("model").agg(*cells)
