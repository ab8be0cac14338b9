"""Ridge for all folds and penalties at once, from moments per block of time.

Each block is read once and becomes a count, means and co-moments. A fold trains on all blocks before its own, so its
moments are a running sum; each penalty is then a small linear system. A second pass scores all models together.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeline.operators.metrics import r_squared, skill
from hazeline.operators.profile import as_readings, model_columns
from hazeline.operators.quantiles import exact_quantiles
from hazeline.operators.splits import blocks
from hazeline.session import written

LABEL = "target_delta"
SALTS = 64  # tasks, at most, of the first of two merges of a block


@dataclass
class Moments:
    """Count, means and sums of products of deviations from the means."""

    n: float
    mean: np.ndarray
    products: np.ndarray

    @classmethod
    def of(cls, x: np.ndarray) -> Moments:
        mean = x.mean(axis=0)
        return cls(float(len(x)), mean, (x - mean).T @ (x - mean))

    def __add__(self, other: Moments) -> Moments:
        n, shift = self.n + other.n, other.mean - self.mean
        return Moments(n, self.mean + shift * (other.n / n), self.products + other.products + np.outer(shift, shift) * (self.n * other.n / n))


_FIELDS = "block int, n double, mean array<double>, products array<double>"


def _row(block: int, m: Moments) -> pa.RecordBatch:
    """Only the upper triangle travels."""
    upper = m.products[np.triu_indices(len(m.mean))]
    return pa.RecordBatch.from_pylist(
        [{"block": block, "n": m.n, "mean": m.mean, "products": upper}],
        pa.schema([("block", pa.int32()), ("n", pa.float64()), ("mean", pa.list_(pa.float64())), ("products", pa.list_(pa.float64()))]))


def _read(row: dict) -> Moments:
    mean = np.array(row["mean"])
    upper = np.zeros((len(mean), len(mean)))
    upper[np.triu_indices(len(mean))] = row["products"]
    return Moments(row["n"], mean, upper + np.triu(upper, 1).T)


def _merged(rows: DataFrame, *by: str) -> DataFrame:
    def merge(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for row in batch.to_pylist():
                total = _read(row) if total is None else total + _read(row)
        yield _row(key[0].as_py(), total)

    return rows.groupBy(*by).applyInArrow(merge, _FIELDS)


def block_moments(blocked: DataFrame, columns: Sequence[str]) -> dict[int, Moments]:
    """Moments of `columns` in each block of rows without nulls. One pass; the driver gets one row for each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Moments] = {}
        for batch in batches:
            x = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[1:]], axis=1)
            block = batch.column(0).to_numpy()
            for b in np.unique(block).tolist():
                found = Moments.of(x[block == b])
                held[b] = held[b] + found if b in held else found
        for b, m in held.items():
            yield _row(b, m)

    rows = blocked.select(F.col("block").cast("int"), *(F.col(f"`{c}`").cast("double") for c in columns)).mapInArrow(run, _FIELDS)
    once = _merged(rows.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS))), "block", "salt")
    return {r["block"]: _read(r.asDict()) for r in _merged(once, "block").collect()}  # one row per block


def prefixes(found: dict[int, Moments], n_splits: int) -> dict[int, Moments]:
    """By fold: the moments of all blocks before it."""
    out, total = {}, None
    for block in range(n_splits):
        if block in found:
            total = found[block] if total is None else total + found[block]
        out[block + 1] = total
    return out


def solve(m: Moments, widths: np.ndarray, penalty: float) -> tuple[np.ndarray, float]:
    """Coefficients for unscaled columns and the intercept; the penalty holds for columns divided by `widths`. The label
    is the last column of the moments."""
    gram = m.products[:-1, :-1] / np.outer(widths, widths)
    beta = np.linalg.solve(gram + penalty * np.eye(len(widths)), m.products[:-1, -1] / widths) / widths
    return beta, float(m.mean[-1] - m.mean[:-1] @ beta)


def fold_widths(blocked: DataFrame, columns: Sequence[str], n_splits: int) -> dict[int, np.ndarray]:
    """By fold: exact interquartile ranges of its training rows, 1 for none; one job for all folds."""
    folds = F.explode(F.sequence(F.col("block") + 1, F.lit(n_splits))).alias("fold")
    rows = blocked.where(F.col("block") < n_splits).select(folds, *columns)
    widths = {f: np.ones(len(columns)) for f in range(1, n_splits + 1)}
    found: dict[tuple, dict] = {}
    for r in exact_quantiles(as_readings(rows, columns, ["fold"]), ["fold", "column"], [0.25, 0.75]).collect():  # two per fold and column
        found.setdefault((r["fold"], r["column"]), {})[r["prob"]] = r["quantile"]
    for (fold, column), q in found.items():
        widths[fold][columns.index(column)] = (q[0.75] - q[0.25]) or 1.0
    return widths


@dataclass
class RidgePath:
    """Fitted coefficients by fold, one column for each penalty."""

    columns: list[str]
    penalties: list[float]
    widths: dict[int, np.ndarray]
    beta: dict[int, np.ndarray]
    intercept: dict[int, np.ndarray]


def fit_path(blocked: DataFrame, penalties: Sequence[float], n_splits: int = 5, columns: Sequence[str] | None = None) -> RidgePath:
    columns = list(columns or model_columns(blocked.drop("target", "block")))
    sums = prefixes(block_moments(blocked, [*columns, LABEL]), n_splits)
    widths = fold_widths(blocked, columns, n_splits)
    solved = {f: [solve(m, widths[f], p) for p in penalties] for f, m in sums.items()}
    return RidgePath(
        columns, list(penalties), widths, {f: np.stack([b for b, _ in s], axis=1) for f, s in solved.items()},
        {f: np.array([c for _, c in s]) for f, s in solved.items()})


def path_scores(blocked: DataFrame, path: RidgePath) -> DataFrame:
    """(alpha, fold, n, r2, mae, mse, rmse, skill_vs_naive, naive_r2, naive_rmse): each block scored by the models of its
    fold, all penalties in one pass; a task sends sums only."""
    names = ["n", "absolute", "square", "total", "square_total", "naive_square"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            block, actual, current = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            x = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[3:]], axis=1)
            for b in np.unique(block).tolist():
                here = block == b
                y, now = actual[here][:, None], current[here][:, None]
                error = y - now - x[here] @ path.beta[b] - path.intercept[b]
                naive = (y - now) + 0 * error
                sums = np.stack([np.full(error.shape[1], float(len(y))), np.abs(error).sum(0), (error ** 2).sum(0), (y + 0 * error).sum(0), ((y + 0 * error) ** 2).sum(0), (naive ** 2).sum(0)])
                held[b] = held[b] + sums if b in held else sums
        for b, sums in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([b] * sums.shape[1], pa.int32()), pa.array(path.penalties, pa.float64()), *(pa.array(s) for s in sums)], ["fold", "alpha", *names])

    tested = blocked.where("block > 0").select(F.col("block").cast("int"), *(F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(("target", "european_aqi", *path.columns))))
    rows = tested.mapInArrow(run, "fold int, alpha double, " + ", ".join(f"{c} double" for c in names))
    sums = rows.groupBy("alpha", "fold").agg(*(F.sum(c).alias(c) for c in names))
    mse, naive_mse = F.col("square") / F.col("n"), F.col("naive_square") / F.col("n")
    spread = F.col("square_total") / F.col("n") - (F.col("total") / F.col("n")) ** 2
    return sums.select(
        "alpha", "fold", F.col("n").cast("long").alias("n"), r_squared(mse, spread).alias("r2"), (F.col("absolute") / F.col("n")).alias("mae"), mse.alias("mse"),
        F.sqrt(mse).alias("rmse"), skill(F.sqrt(mse), F.sqrt(naive_mse)).alias("skill_vs_naive"), r_squared(naive_mse, spread).alias("naive_r2"), F.sqrt(naive_mse).alias("naive_rmse"))


def ridge_walk_forward(rows: DataFrame, penalties: Sequence[float] = (0.1,), n_splits: int = 5, columns: Sequence[str] | None = None) -> DataFrame:
    """Walk-forward scores of ridge for all penalties, equal to fitting each fold anew."""
    blocked = written(blocks(rows, n_splits), "blocked")
    return path_scores(blocked, fit_path(blocked, penalties, n_splits, columns))


def ridge_search(rows: DataFrame, penalties: Sequence[float], n_splits: int = 5) -> DataFrame:
    """(alpha, folds, mean_mse, mean_rmse), best first."""
    folds = ridge_walk_forward(rows, penalties, n_splits)
    return folds.groupBy("alpha").agg(F.count("*").alias("folds"), F.avg("mse").alias("mean_mse"), F.avg("rmse").alias("mean_rmse")).orderBy("mean_mse", "alpha")


def gradients(blocked: DataFrame, path: RidgePath, n_splits: int = 5) -> DataFrame:
    """(alpha, fold, feature, gradient): what is left of the derivative at each solution, as a share of its terms. 0 if
    the fit is right: computed from the rows, not from the moments."""
    size = len(path.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((n_splits, len(path.penalties), 2, size))
        for batch in batches:
            block, label = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
            x = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[2:]], axis=1)
            for fold in range(max(1, int(block.min()) + 1), n_splits + 1):
                here = block < fold
                error = label[here][:, None] - x[here] @ path.beta[fold] - path.intercept[fold]
                scaled = x[here] / path.widths[fold]
                sums[fold - 1, :, 0] += error.T @ scaled
                sums[fold - 1, :, 1] += np.abs(error).T @ np.abs(scaled)
        f, p, c = np.meshgrid(np.arange(1, n_splits + 1), np.arange(len(path.penalties)), np.arange(size), indexing="ij")
        yield pa.RecordBatch.from_arrays(
            [pa.array(f.ravel(), pa.int32()), pa.array(np.array(path.penalties)[p.ravel()]), pa.array(np.array(path.columns)[c.ravel()]), pa.array(sums[:, :, 0].ravel()), pa.array(sums[:, :, 1].ravel()),
             pa.array(np.stack([(path.beta[i].T * path.widths[i]) * np.array(path.penalties)[:, None] for i in range(1, n_splits + 1)]).ravel())],
            ["fold", "alpha", "feature", "product", "size", "pull"])

    rows = blocked.where(F.col("block") < n_splits).select(F.col("block").cast("int"), *(F.col(f"`{c}`").cast("double") for c in (LABEL, *path.columns)))
    sums = rows.mapInArrow(run, "fold int, alpha double, feature string, product double, size double, pull double")
    sums = sums.groupBy("alpha", "fold", "feature").agg(F.sum("product").alias("product"), F.sum("size").alias("size"), F.first("pull").alias("pull"))
    return sums.select("alpha", "fold", "feature", ((F.col("product") - F.col("pull")) / (1 + F.col("size"))).alias("gradient"))
