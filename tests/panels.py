import numpy as np
import pandas as pd

from hazeline.schema import MEASURES, RAW_SCHEMA

#: Generated values: the same span for all measures of a kind, well inside the limits of the quality rules.
RANGES = {c: (1, 80) for c in MEASURES} | {"weather_code": (0, 4), "wind_direction_10m": (0, 360), "european_aqi": (30, 260)}
PLACES = {"Lahore": (31.558, 74.351), "Karachi": (24.8607, 67.0011)}


def raw_pandas(rows=420, cities=("Lahore", "Karachi"), start="2026-01-01", seed=42) -> pd.DataFrame:
    rng = np.random.default_rng(seed)
    parts = []
    for city in cities:
        frame = pd.DataFrame({"date": pd.date_range(start, periods=rows, freq="h"), "city": city})
        frame["lat"], frame["lon"] = PLACES[city]
        for c in MEASURES:
            low, high = RANGES[c]
            frame[c] = rng.integers(low, high, rows).astype(float) if c == "weather_code" else rng.uniform(low, high, rows)
        parts.append(frame)
    return pd.concat(parts, ignore_index=True)


def to_spark(spark, frame: pd.DataFrame):
    """Rows with NaN as null, as an ingested panel has them."""
    names = [f.name for f in RAW_SCHEMA.fields if f.name != "date"]
    values = frame[names].astype(object).where(frame[names].notna(), None)
    rows = zip([d.to_pydatetime() for d in frame["date"]], *(values[c] for c in names))
    return spark.createDataFrame([tuple(r) for r in rows], RAW_SCHEMA)


def sorted_pandas(df, keys=("city", "date")) -> pd.DataFrame:
    return df.toPandas().sort_values(list(keys)).reset_index(drop=True)
