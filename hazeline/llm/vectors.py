"""What both vector searches share: usable rows, query blocks of bounded size, and the merge of partial results."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazeline.llm.order import placed
from hazeline.session import scratch_path

BLOCK_BYTES = 4 << 20  # of the query vectors that one job sends to all tasks


def usable(vectors: DataFrame, bad: Callable[[Column], Column]) -> DataFrame:
    """(vec_id, embedding) with components as double, without null ids and vectors and those with a bad component.

    Equal rows count once. An id with several vectors stands for each of them.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    fit = ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")) | bad(x))
    return rows.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & fit).distinct()


def query_blocks(queries: DataFrame) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    """The queries (ids, vectors), at most `BLOCK_BYTES` of vectors at a time."""
    spark = queries.sparkSession
    widest = queries.agg(F.max(F.size("embedding"))).first()[0]
    if widest is None:
        return
    rows = max(1, BLOCK_BYTES // (8 * max(1, widest)))
    path = scratch_path(spark, "queries")
    numbered = placed(queries, F.col("vec_id"), F.col("embedding"), label="query-order").withColumn("block", F.floor(F.col("place") / rows))
    numbered.repartition("block").write.partitionBy("block").parquet(path)
    stored = spark.read.parquet(path)
    for (block,) in stored.select("block").distinct().orderBy("block").toLocalIterator():
        some = stored.where(F.col("block") == block).select("vec_id", "embedding").orderBy("vec_id", "embedding").toArrow()
        yield some["vec_id"].to_numpy(), [np.array(x, np.float64) for x in some["embedding"].to_pylist()]


def searched(queries: DataFrame, one_block: Callable[[np.ndarray, list[np.ndarray]], DataFrame], score: str) -> DataFrame:
    """Partial results (query_id, vec_id, score) of all query blocks, each block a job of its own."""
    spark = queries.sparkSession
    path = scratch_path(spark, "partial")
    schema = f"query_id long, vec_id long, score {score}"
    spark.createDataFrame([], schema).write.parquet(path)
    for ids, vectors in query_blocks(queries):
        one_block(ids, vectors).write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def ranked(partial: DataFrame, best: Column, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of each query, ties to the smaller id."""
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(best, "vec_id"))
    return partial.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
