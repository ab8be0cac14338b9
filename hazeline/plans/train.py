"""Snapshot, train, register, pick winners."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from hazeline.learn.models import MODELS
from hazeline.learn.training import register, run
from hazeline.sources.feature_table import FeatureTable, training_snapshot
from hazeline.sources.registry import ModelRegistry, training_winner


def train(
    table: FeatureTable,
    registry: ModelRegistry,
    model_root: str,
    start: str,
    end: str,
    horizons: Sequence[int] = (1, 2, 3),
    kinds: Sequence[str] = tuple(MODELS),
    settings: dict[str, dict] | None = None,
    snapshot_name: str = "training",
) -> DataFrame:
    """Winner per horizon by skill; every model is registered."""
    _, snapshot = training_snapshot(table, start, end, snapshot_name)
    metrics, fitted = run(snapshot, horizons, kinds, settings)
    register(registry, metrics, fitted, model_root)
    return training_winner(metrics, list(kinds))
