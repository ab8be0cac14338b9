"""Mixing sources to target weights by hash-threshold histograms.

Each document gets a point, 60 bits of a digest of its id and text. A source takes every document whose point is below
the source's threshold. The thresholds come from sums of words by (source, bucket of points): the bucket in which the
budget ends is cut in finer buckets until it holds one point, so no document is ever sorted or ranked. A larger budget
has a larger threshold, so smaller mixes are subsets of larger ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazeline.llm.order import placed
from hazeline.llm.text import word_count
from hazeline.session import written

POINT_BITS = 60
LEVEL_BITS = 10


def point(doc_id: Column | str, text: Column | str) -> Column:
    """The document's place in [0, 2^60). Equal rows have equal points; it doesn't depend on the run."""
    said = F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit("|"), F.coalesce(F.col(text), F.lit("")))
    return F.conv(F.substring(F.md5(said), 1, POINT_BITS // 4), 16, 10).cast("long")


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, point) of every document."""
    return docs.select("doc_id", "source", word_count("text").alias("size"), point("doc_id", "text").alias("point"))


def source_targets(sizes: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """(source, source_size, target): words to take of each source.

    `share` of all words is dealt by weight; what a source can't take beyond `cap` times its size goes to the others
    by weight, round by round, until nobody is above. Takes one row (source, source_size) per source. A source of
    size 0 has target 0.
    """
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("place") % len(weights) + 1).cast("int"))
    rows = placed(sizes, F.col("source").asc_nulls_last(), label="mix-order").select("source", "source_size", weight.alias("weight"), (F.col("source_size") * cap).alias("most"))
    rows = written(rows, "mix-sources")
    total = rows.agg(F.sum("source_size")).first()[0] or 0
    limit = None  # a source is full once `limit` words per unit of weight would exceed what it may give
    while True:
        full = F.lit(False) if limit is None else F.col("weight") * limit[0] > F.col("most") * limit[1]
        left = rows.agg(F.sum(F.when(full, F.col("most"))).alias("given"), F.sum(F.when(~full, F.col("weight"))).alias("weight")).first()
        now = (total * share - (left["given"] or 0.0), left["weight"] or 0.0)
        if now[1] == 0.0 or now == limit:
            break
        limit = now
    if limit is None:
        return rows.select("source", "source_size", F.lit(0.0).alias("target"))
    full = F.col("weight") * limit[0] > F.col("most") * limit[1]
    dealt = F.when(full, F.col("most")).otherwise(F.col("weight") * limit[0] / limit[1])
    return rows.select("source", "source_size", dealt.alias("target"))


def thresholds(points: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, source_size, target, whole, cut): take every document `whole` times, and once more if its point < `cut`.

    The one document in which a budget ends is taken if that comes nearer to it. Rows with equal points share a fate.
    """
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    targets = written(targets.withColumn("whole", whole).withColumn("part", F.col("target") - F.col("whole") * F.col("source_size")), "mix-targets")
    open_ = targets.where("part > 0").select("source", "part", F.lit(0).cast("long").alias("prefix"))
    done, shift = None, POINT_BITS
    while True:
        # within an open bucket: sums by the next bits, and the sub-bucket in which the budget ends
        here = points.alias("p").join(
            open_.alias("o"), F.col("p.source").eqNullSafe(F.col("o.source")) & (F.shiftright(F.col("p.point"), shift) == F.col("o.prefix")))
        finer = max(0, shift - LEVEL_BITS)
        sums = here.groupBy("p.source", "o.part", F.shiftright("p.point", finer).alias("prefix")).agg(
            F.sum("p.size").alias("words"), F.min("p.point").alias("low"), F.max("p.point").alias("high"))
        upto = F.sum("words").over(Window.partitionBy("source").orderBy("prefix"))
        ends = sums.withColumn("upto", upto).where("upto >= part and upto - words < part")
        ends = written(ends.select("source", (F.col("part") - F.col("upto") + F.col("words")).alias("part"), "prefix", "words", "low", "high"), "mix-level")
        one = ends.where("low = high").select("source", F.when(F.col("part") * 2 > F.col("words"), F.col("low") + 1).otherwise(F.col("low")).alias("cut"))
        done = one if done is None else done.unionByName(one)
        open_, shift = ends.where("low < high").select("source", "part", "prefix"), finer
        if shift == 0 or open_.isEmpty():
            break
    # a budget that is all but the sum, and lost to rounding, has no end: its source is taken once more in full
    cut = F.when(F.col("part") > 0, F.coalesce("cut", F.lit(1 << POINT_BITS))).otherwise(F.lit(0)).cast("long")
    return targets.alias("t").join(done.alias("d"), F.col("t.source").eqNullSafe(F.col("d.source")), "left").select(
        "t.source", "t.source_size", "t.target", "t.whole", cut.alias("cut"))


def copies(whole: Column | str = "whole", cut: Column | str = "cut", at: Column | str = "point") -> Column:
    return F.col(whole) + (F.col(at) < F.col(cut)).cast("long")


def plan(points: DataFrame, **how) -> DataFrame:
    sizes = points.groupBy("source").agg(F.sum("size").alias("source_size"))
    return written(thresholds(points, source_targets(sizes, **how)), "mix-plan")


def mix(docs: DataFrame, **how) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) of every document; `how` as in `source_targets`.

    A null text has size 0 and nothing taken. A null source is a source like others, the last in order. Repeated rows
    are taken alike. An empty table gives an empty result. Other columns are not looked at.
    """
    points = written(sized(docs), "mix-points")
    found = plan(points, **how)
    both = points.alias("p").join(found.alias("f"), F.col("p.source").eqNullSafe(F.col("f.source")))
    return both.select("p.doc_id", "p.source", "p.size", "f.source_size", "f.target", (F.col("p.size") * copies("f.whole", "f.cut", "p.point")).alias("taken"))


def mixed(docs: DataFrame, **how) -> DataFrame:
    """The documents themselves, each as often as the mix takes it (0 to `cap` times), with the columns of `docs`."""
    found = plan(written(sized(docs), "mix-points"), **how)
    rows = docs.select(F.struct("*").alias("row"), F.col("source").alias("source"), point("doc_id", "text").alias("point"))
    both = rows.alias("r").join(found.alias("f"), F.col("r.source").eqNullSafe(F.col("f.source")))
    times = F.explode(F.sequence(F.lit(1).cast("long"), copies("f.whole", "f.cut", "r.point")))
    return both.where(copies("f.whole", "f.cut", "r.point") > 0).select("r.row", times.alias("time")).select("row.*")
