"""Exact top-k search by inner product: columnar branch-and-bound.

Candidates lie in vertical layout, one row per dimension. Partial products are summed block by block of dimensions; what
the remaining dimensions can add at most is the product of the remaining lengths. Candidates whose bound stays below
the query's k-th best score so far are dropped, and the rest moved together before the next block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeline.llm.vectors import ranked, searched, usable

SCALE = 256.0
DIMENSIONS = 16  # of a block
CANDIDATES = 2048  # that are held in vertical layout at once
EXACT = float(1 << 53)  # integers below are exact as double
LARGEST = (1 << 63) - 1


def _dot(a: np.ndarray, b: np.ndarray) -> int:
    """Inner product without bound on its size, cut to 64 bits."""
    total = sum(int(x) * int(y) for x, y in zip(a, b))
    return max(-LARGEST - 1, min(LARGEST, total))


class Search:
    """The k best candidates of each query, over batches of candidates."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, k: int):
        self.ids, self.k = ids, k
        mass = np.square(queries).sum(axis=0)
        self.order = np.argsort(-mass, kind="stable")  # the heaviest dimensions first
        self.queries = queries[:, self.order]
        self.blocks = [slice(i, i + DIMENSIONS) for i in range(0, queries.shape[1], DIMENSIONS)] or [slice(0, 0)]
        tail = np.cumsum(np.square(self.queries)[:, ::-1], axis=1)[:, ::-1]
        self.rest = [np.sqrt(tail[:, b.stop]) if b.stop < queries.shape[1] else np.zeros(len(ids)) for b in self.blocks]
        self.greatest = np.abs(queries).max(initial=0.0)
        self.found = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in ids]
        self.least = np.full(len(ids), -np.inf)  # the k-th best score

    def _keep(self, q: int, vec_ids: np.ndarray, scores: np.ndarray) -> None:
        own = vec_ids != self.ids[q]
        vec_ids = np.concatenate([self.found[q][0], vec_ids[own]])
        scores = np.concatenate([self.found[q][1], scores[own]])
        if len(scores) > 8 * self.k:  # sort few
            near = scores >= np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            vec_ids, scores = vec_ids[near], scores[near]
        best = np.lexsort((vec_ids, ~scores))[:self.k]
        self.found[q] = vec_ids[best], scores[best]
        if len(best) == self.k:
            self.least[q] = float(scores[best[-1]])

    def add(self, vec_ids: np.ndarray, vectors: np.ndarray) -> None:
        if self.greatest * np.abs(vectors).max(initial=0.0) * max(1, vectors.shape[1]) >= EXACT:
            for q, query in enumerate(self.queries):
                scores = [_dot(query, v) for v in vectors[:, self.order]]
                self._keep(q, vec_ids, np.array(scores, np.int64))
            return
        columns = np.ascontiguousarray(vectors[:, self.order].T)
        tail = np.cumsum(np.square(columns)[::-1], axis=0)[::-1]
        rest = [np.sqrt(tail[b.stop]) if b.stop < len(columns) else np.zeros(len(vec_ids)) for b in self.blocks]
        partial = self.queries[:, self.blocks[0]] @ columns[self.blocks[0]]
        for q in range(len(self.ids)):
            alive, score = np.arange(len(vec_ids)), partial[q]
            for i, block in enumerate(self.blocks):
                if i:
                    score = score + self.queries[q, block] @ columns[block][:, alive]
                bound = score + self.rest[i][q] * rest[i][alive] * (1 + 1e-9)
                near = bound >= self.least[q]
                alive, score = alive[near], score[near]
                if not len(alive):
                    break
            if len(alive):
                self._keep(q, vec_ids[alive], score.astype(np.int64))


def top_products(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query the k candidates with the greatest inner product of floor(256 x).

    `vectors` and `queries` have (vec_id, embedding). A query's own id is no candidate; ties go to the smaller id; fewer
    than k candidates are all returned. Left out, as query and as candidate: null ids, null vectors, vectors with a null
    or non-finite component, or one that 256 times is beyond double. Vectors of different length are not compared.
    Equal rows count once. A score beyond 64 bits is cut to the largest. Empty tables give an empty result.
    """
    beyond = lambda x: F.abs(x) > 1.7e308 / SCALE
    candidates = usable(vectors, beyond)

    def one_block(ids: np.ndarray, found: list[np.ndarray]) -> DataFrame:
        widths = {}
        for i, v in enumerate(found):
            widths.setdefault(len(v), []).append(i)
        scaled = [(ids[at], np.floor(np.stack([found[i] for i in at]) * SCALE)) for at in map(np.array, widths.values())]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            searches = {rows.shape[1]: Search(own, rows, k) for own, rows in scaled}
            for batch in batches:
                for first in range(0, batch.num_rows, CANDIDATES):
                    some = batch.slice(first, CANDIDATES)
                    flat, ends = some.column(1).flatten().to_numpy(), np.array(some.column(1).value_lengths())
                    starts, vec_ids = np.cumsum(ends) - ends, some.column(0).to_numpy()
                    for width, search in searches.items():
                        rows = np.flatnonzero(ends == width)
                        if len(rows):
                            search.add(vec_ids[rows], np.floor(flat[starts[rows][:, None] + np.arange(width)] * SCALE))
            for search in searches.values():
                sizes = [len(v) for v, _ in search.found]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(search.ids, sizes)), pa.array(np.concatenate([v for v, _ in search.found])), pa.array(np.concatenate([s for _, s in search.found]))],
                    ["query_id", "vec_id", "score"])

        return candidates.mapInArrow(run, "query_id long, vec_id long, score long")

    return ranked(searched(usable(queries, beyond), one_block, "long"), F.desc("score"), k)
