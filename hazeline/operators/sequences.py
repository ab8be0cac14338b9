"""Fixed-length row sequences for sequence models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeline.operators.series import CHUNK_ROWS, along_series
from hazeline.schema import SEQUENCE_LENGTH


def sequence_windows(
    df: DataFrame,
    features: Sequence[str],
    target: str = "target_delta",
    length: int = SEQUENCE_LENGTH,
    target_offset: int = 0,
    keys: Sequence[str] = ("city", "split"),
    chunk_rows: int | None = CHUNK_ROWS,
) -> DataFrame:
    """Per row with `length - 1` rows before it, the `length x features` matrix as `sequence`.

    With `split` among the keys no sequence crosses it. The target is that of
    the last row, or of a later one with `target_offset`.
    """
    step = F.array(*[F.col(c).cast("double") for c in features])

    def frames(w):
        out = {"sequence": F.collect_list(step).over(w.rowsBetween(1 - length, 0))}
        if target_offset:
            out["_target"] = F.lead(target, target_offset).over(w)
        return out

    framed = along_series(
        df, frames, keys=keys, back=length - 1, ahead=target_offset, chunk_rows=chunk_rows
    ).where(F.size("sequence") == length)
    if target_offset:
        framed = framed.where("_target is not null").withColumn(target, F.col("_target")).drop("_target")
    return framed
