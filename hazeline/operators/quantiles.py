"""Exact interpolated quantiles without holding a group's values in one task.

The built-in exact percentile keeps every distinct value of a group in one buffer. Here a sketch first brackets each
wanted rank. While a bracket may hold more values than one task should see, a further pass counts what lies below and
inside it and narrows it by the quantiles of what is inside. The last pass keeps the values inside, by distinct value.
All passes combine map-side, so a group that holds all rows is no hot spot.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add, or_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazeline.session import written

ACCURACY = 20000  # a bracket holds about 4/ACCURACY of a group
MOST_INSIDE = 1 << 20  # values of a group inside its brackets that the last pass may order in one task
CUTS = 128  # parts into which a pass cuts a bracket


def narrowed(data: DataFrame, brackets: DataFrame, keys: Sequence[str], probs: Sequence[float], most: int, accuracy: int) -> DataFrame:
    """Brackets of at most `most` values for each wanted rank, or of one value that repeats. Stored.

    A pass keeps about two of the `CUTS` parts of a bracket, so there are few even for the largest group.
    """
    count = range(len(probs))
    grid = [i / CUTS for i in range(CUTS + 1)]
    inside = [F.col("_v").between(F.col(f"_low{i}"), F.col(f"_high{i}")) for i in count]
    while True:
        sums = data.join(brackets, list(keys)).groupBy(*keys, "_n", *[f"_{e}{i}" for i in count for e in ("low", "high")]).agg(
            *[F.count_if(F.col("_v") < F.col(f"_low{i}")).alias(f"_below{i}") for i in count],
            *[F.count_if(inside[i]).alias(f"_in{i}") for i in count],
            *[F.percentile_approx(F.when(inside[i], F.col("_v")), grid, max(accuracy, 8 * CUTS)).alias(f"_grid{i}") for i in count],
        )
        sums = written(sums, "brackets")
        wide = [(F.col(f"_in{i}") > most) & (F.col(f"_low{i}") < F.col(f"_high{i}")) for i in count]
        if sums.where(reduce(or_, wide)).isEmpty():
            return sums.select(*brackets.columns)
        edges = {}
        for i, p in enumerate(probs):
            rank = F.floor((F.col("_n") - 1) * p) - F.col(f"_below{i}")  # inside the bracket
            first = F.greatest(F.floor(rank / F.col(f"_in{i}") * CUTS) - 1, F.lit(0))
            last = F.least(F.ceil((rank + 2) / F.col(f"_in{i}") * CUTS) + 1, F.lit(CUTS))
            edges[f"_low{i}"] = F.when(first > 0, F.get(f"_grid{i}", first.cast("int"))).otherwise(F.col(f"_low{i}"))
            edges[f"_high{i}"] = F.when(last < CUTS, F.get(f"_grid{i}", last.cast("int"))).otherwise(F.col(f"_high{i}"))
        tighter = sums.select(*keys, "_n", *[F.when(wide[i], edges[f"_{e}{i}"]).otherwise(F.col(f"_{e}{i}")).alias(f"_{e}{i}") for i in count for e in ("low", "high")])
        brackets = written(tighter.select(*brackets.columns), "brackets")


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], probs: Sequence[float], value: str = "value", accuracy: int = ACCURACY,
    most_inside: int = MOST_INSIDE,
) -> DataFrame:
    """(keys, prob, n, quantile) with linear interpolation between order statistics.

    Groups without a value give no row. `most_inside` bounds what one task orders for each group and probability.
    """
    data = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_v"))
    margin = 2.0 / accuracy  # twice the sketch's rank error
    edges = [max(0.0, p - margin) for p in probs] + [min(1.0, p + margin) for p in probs]
    sketch = data.groupBy(*keys).agg(
        F.count("*").alias("_n"), F.percentile_approx("_v", edges, accuracy).alias("_edges")
    )
    count = range(len(probs))
    brackets = written(
        sketch.select(
            *keys, "_n",
            *[F.col("_edges")[i].alias(f"_low{i}") for i in count],
            *[F.col("_edges")[len(probs) + i].alias(f"_high{i}") for i in count],
        ),
        "brackets",
    )
    largest = brackets.agg(F.max("_n")).first()[0] or 0
    if largest * 2 * margin > most_inside:  # the sketch alone doesn't bound what lies inside
        brackets = narrowed(data, brackets, keys, probs, most_inside, accuracy)
    inside = reduce(or_, [F.col("_v").between(F.col(f"_low{i}"), F.col(f"_high{i}")) for i in count])
    below = reduce(add, [F.when(F.col(f"_high{i}") < F.col("_v"), 1).otherwise(0) for i in count])
    placed = data.join(brackets, list(keys)).select(
        *keys, "_n", "_v",
        F.when(inside, F.col("_v")).alias("_exact"), F.when(~inside, below).alias("_cell"),
    )
    # A cell between brackets is one row, however many values fall into it.
    cells = placed.groupBy(*keys, "_n", "_exact", "_cell").agg(
        F.count("*").alias("_count"), F.min("_v").alias("_min"), F.max("_v").alias("_max")
    )
    ordered = Window.partitionBy(*keys).orderBy("_min").rowsBetween(Window.unboundedPreceding, 0)
    ranked = cells.withColumn("_end", F.sum("_count").over(ordered)).withColumn("_start", F.col("_end") - F.col("_count"))

    def at_rank(rank):
        known = (
            F.when(F.col("_exact").isNotNull(), F.col("_exact"))
            .when(rank == F.col("_start"), F.col("_min"))
            .when(rank == F.col("_end") - 1, F.col("_max"))
        )
        return F.max(F.when((F.col("_start") <= rank) & (rank < F.col("_end")), known))

    wanted = ranked.select("*", F.explode(F.array(*map(F.lit, probs))).alias("prob"))
    position = (F.col("_n") - 1) * F.col("prob")
    lower = F.floor(position)
    found = wanted.groupBy(*keys, "prob").agg(
        F.max("_n").alias("n"),
        at_rank(lower).alias("_low"),
        at_rank(F.least(lower + 1, F.col("_n") - 1)).alias("_high"),
    )
    spot = (F.col("n") - 1) * F.col("prob")
    between = F.col("_low") + (F.col("_high") - F.col("_low")) * (spot - F.floor(spot))
    missed = F.raise_error(F.lit("quantile rank outside its bracket")).cast("double")
    return found.select(*keys, "prob", "n", F.coalesce(between, missed).alias("quantile"))
