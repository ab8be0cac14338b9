"""Jobs whose tasks send each other compressed arrays: rows are dealt to numbered receivers, each of which works alone."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeline.session import written

#: `to`, `kind` and `sender` say whose row it is; `s` holds a few numbers that are summed over all rows of a kind.
FIELDS = "to long, kind int, sender long, data array<binary>, s array<long>"
ARROW = pa.schema([("to", pa.int64()), ("kind", pa.int32()), ("sender", pa.int64()), ("data", pa.list_(pa.binary())), ("s", pa.list_(pa.int64()))])


def row(to: int, kind: int, sender: int, *data: bytes, s: tuple[int, ...] = ()) -> dict:
    return {"to": int(to), "kind": kind, "sender": int(sender), "data": list(data), "s": [int(x) for x in s]}


def sent(rows: Iterator[dict]) -> Iterator[pa.RecordBatch]:
    for r in rows:
        yield pa.RecordBatch.from_pylist([r], ARROW)


def mail(rows: DataFrame, kind: int) -> DataFrame:
    return rows.where(F.col("kind") == kind)


def returned(rows: DataFrame) -> DataFrame:
    """The same rows for those who got them as senders."""
    return rows.select(F.col("sender").alias("to"), "kind", F.col("to").alias("sender"), "data", "s")


def totals(rows: DataFrame, kind: int, n: int) -> list[int]:
    found = mail(rows, kind).agg(*(F.coalesce(F.sum(F.col("s")[i]), F.lit(0)).alias(f"s{i}") for i in range(n))).first()
    return [int(x) for x in found]


def dealt(parts: list[DataFrame], work: Callable[[int, dict[int, list[dict]]], Iterator], label: str | None = "mail", fields: str = FIELDS) -> DataFrame:
    """Rows of all `parts`, receiver by receiver: `work(to, rows by kind in order of senders)`. Stored if there is a label."""
    rows = parts[0]
    for more in parts[1:]:
        rows = rows.unionByName(more, allowMissingColumns=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, {}
        for batch in batches:
            for i in range(batch.num_rows):
                r = batch.slice(i, 1).to_pylist()[0]
                if r["to"] != now:
                    if held:
                        yield from work(now, held)
                    now, held = r["to"], {}
                held.setdefault(r["kind"], []).append(r)
        if held:
            yield from work(now, held)

    rows = rows.repartition("to").sortWithinPartitions("to", "kind", "sender").mapInArrow(run, fields)
    return written(rows, label) if label else rows


def narrow(x: np.ndarray) -> np.ndarray:
    """Numbers from 0 on in the smallest type."""
    most = int(x.max()) if len(x) else 0
    return x.astype(next(t for t in (np.uint8, np.uint16, np.uint32, np.int64) if most <= np.iinfo(t).max))
