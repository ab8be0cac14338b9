"""Approximate nearest neighbours: a hierarchical navigable small-world graph per shard, kept as flat arrays.

Rows are dealt to shards by hash. Each shard builds its graph by insertion and is stored as one row of arrays; a query
walks the graph of every shard, and the shards' results are merged.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeline.llm.vectors import ranked, searched, usable
from hazeline.session import written

SHARD_ROWS = 4096  # rows of a shard, about
LINKS = 16  # neighbours that a new node links to on each level; level 0 keeps twice as many
BUILD_WIDTH = 80  # candidates that are kept while a node is inserted
SEARCH_WIDTH = 128  # and while a query is answered


class Graph:
    """Nodes are distinct vectors. `near[level]` has a row of neighbours, padded with -1, for each node of that level."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        self.top = np.zeros(len(vectors), np.int8)  # a node's highest level
        self.near: list[np.ndarray] = []
        self.place: list[np.ndarray] = []  # by level: the node's row in `near`
        self.entry = 0
        self.seen = np.zeros(len(vectors), np.int64)
        self.walks = 0

    @classmethod
    def build(cls, vectors: np.ndarray) -> Graph:
        graph = cls(vectors)
        # the level is drawn from the vector itself, so that a second attempt builds the same graph
        draw = np.array([xxhash.xxh64_intdigest(v.tobytes()) for v in vectors], np.float64) / 2.0**64
        graph.top = np.minimum(-np.log(np.maximum(draw, 1e-12)) / np.log(LINKS), 8).astype(np.int8)
        for level in range(int(graph.top.max()) + 1):
            nodes = np.flatnonzero(graph.top >= level)
            place = np.full(len(vectors), -1, np.int32)
            place[nodes] = np.arange(len(nodes))
            graph.place.append(place)
            graph.near.append(np.full((len(nodes), cls.room(level)), -1, np.int32))
        for node in range(1, len(vectors)):
            graph.insert(node)
        return graph

    @staticmethod
    def room(level: int) -> int:
        return LINKS * (3 if level else 4)  # twice the links that are kept at level 0, and some before it is thinned out

    def neighbours(self, node: int, level: int) -> np.ndarray:
        row = self.near[level][self.place[level][node]]
        return row[:np.searchsorted(row < 0, True)] if row[-1] < 0 else row

    def distances(self, nodes: np.ndarray, to: np.ndarray) -> np.ndarray:
        apart = self.vectors[nodes] - to
        return np.einsum("ij,ij->i", apart, apart)

    def walk(self, to: np.ndarray, starts: list[tuple[float, int]], width: int, level: int) -> list[tuple[float, int]]:
        """The nearest `width` nodes found from `starts`, nearest first."""
        self.walks += 1
        seen, mark = self.seen, self.walks
        open_ = list(starts)
        heapq.heapify(open_)
        kept = [(-d, n) for d, n in starts]
        heapq.heapify(kept)
        for _, n in starts:
            seen[n] = mark
        while open_:
            distance, node = heapq.heappop(open_)
            if len(kept) >= width and distance > -kept[0][0]:
                break
            new = self.neighbours(node, level)
            new = new[seen[new] != mark]
            if not len(new):
                continue
            seen[new] = mark
            found = self.distances(new, to)
            if len(kept) >= width:
                near = found < -kept[0][0]
                new, found = new[near], found[near]
            for d, n in zip(found.tolist(), new.tolist()):
                if len(kept) < width:
                    heapq.heappush(kept, (-d, n))
                elif d < -kept[0][0]:
                    heapq.heapreplace(kept, (-d, n))
                else:
                    continue
                heapq.heappush(open_, (d, n))
        return sorted((-d, n) for d, n in kept)

    def chosen(self, found: list[tuple[float, int]], most: int) -> list[int]:
        """Neighbours in different directions: each nearer to the node than to any chosen before it; then the nearest."""
        if len(found) <= most:
            return [n for _, n in found]
        nodes = np.array([n for _, n in found])
        points = self.vectors[nodes]
        square = np.einsum("ij,ij->i", points, points)
        between = square[:, None] + square[None, :] - 2 * points @ points.T
        reach = np.array([d for d, _ in found])
        free = np.ones(len(nodes), bool)
        picked = []
        for i in range(len(nodes)):
            if free[i]:
                picked.append(i)
                if len(picked) == most:
                    break
                free &= between[i] >= reach  # the rest that lie nearer to this one are reached through it
        left = [i for i in range(len(nodes)) if i not in set(picked)]
        return nodes[picked + left[:most - len(picked)]].tolist()

    def link(self, node: int, to: list[int], level: int) -> None:
        row = self.near[level][self.place[level][node]]
        row[:len(to)] = to
        row[len(to):] = -1

    def insert(self, node: int) -> None:
        to, top = self.vectors[node], int(self.top[node])
        starts = [(float(self.distances(np.array([self.entry]), to)[0]), self.entry)]
        highest = int(self.top[self.entry])
        for level in range(highest, top, -1):
            starts = self.walk(to, starts, 1, level)
        for level in range(min(top, highest), -1, -1):
            starts = self.walk(to, starts, BUILD_WIDTH, level)
            links = self.chosen(starts, LINKS)
            self.link(node, links, level)
            for other in links:
                row = self.near[level][self.place[level][other]]
                if row[-1] < 0:
                    row[np.searchsorted(row < 0, True)] = node
                else:  # full: thinned out to the links worth keeping
                    all_ = np.append(row, node)
                    far = self.distances(all_, self.vectors[other])
                    by = np.argsort(far, kind="stable")
                    self.link(other, self.chosen([(float(far[i]), int(all_[i])) for i in by], LINKS * (1 if level else 2)), level)
        if top > highest:
            self.entry = node

    def search(self, to: np.ndarray, width: int) -> list[tuple[float, int]]:
        starts = [(float(self.distances(np.array([self.entry]), to)[0]), self.entry)]
        for level in range(int(self.top[self.entry]), 0, -1):
            starts = self.walk(to, starts, 1, level)
        return self.walk(to, starts, width, 0)


INDEX = "shard int, width int, nodes int, entry int, vectors array<double>, tops binary, near binary, id_starts array<int>, ids array<long>"


def build_index(vectors: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per shard (and vector length): the graph's flat arrays and the ids of each node. Stored.

    Every usable row is in the index; copies of a vector share a node.
    """
    rows = written(usable(vectors, lambda x: F.abs(x) > 1e150).where(F.exists("embedding", lambda x: x != 0)), "hnsw-rows")
    shards = max(1, ceil(rows.count() / shard_rows))
    rows = rows.select("vec_id", "embedding", F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(shards)).cast("int").alias("shard"), F.size("embedding").alias("width"))

    def built(key: tuple, rows: pa.Table) -> pa.Table:
        shard, width = (x.as_py() for x in key)
        rows = rows.sort_by("vec_id")
        flat = rows["embedding"].combine_chunks().flatten().to_numpy().reshape(-1, width)
        nodes, node = np.unique(flat, axis=0, return_inverse=True)
        # inserted in an order that says nothing about where they lie
        order = np.argsort([xxhash.xxh64_intdigest(v.tobytes(), 1) for v in nodes], kind="stable")
        back = np.empty(len(nodes), np.int64)
        back[order] = np.arange(len(nodes))
        node = back[node.reshape(-1)]
        graph = Graph.build(np.ascontiguousarray(nodes[order]))
        by = np.argsort(node, kind="stable")
        starts = np.searchsorted(node[by], np.arange(len(nodes) + 1))
        return pa.Table.from_pylist([{
            "shard": shard, "width": width, "nodes": len(nodes), "entry": graph.entry, "vectors": graph.vectors.reshape(-1),
            "tops": graph.top.tobytes(), "near": b"".join(x.tobytes() for x in graph.near), "id_starts": starts.astype(np.int32),
            "ids": rows["vec_id"].to_numpy()[by],
        }], schema=pa.schema([("shard", pa.int32()), ("width", pa.int32()), ("nodes", pa.int32()), ("entry", pa.int32()), ("vectors", pa.list_(pa.float64())),
                              ("tops", pa.binary()), ("near", pa.binary()), ("id_starts", pa.list_(pa.int32())), ("ids", pa.list_(pa.int64()))]))

    dealt = rows.repartition(shards, "shard", "width")
    return written(dealt.groupBy("shard", "width").applyInArrow(built, INDEX), "hnsw-index")


def _opened(row: dict) -> tuple[Graph, np.ndarray, np.ndarray]:
    graph = Graph(np.array(row["vectors"], np.float64).reshape(row["nodes"], row["width"]))
    graph.top, graph.entry = np.frombuffer(row["tops"], np.int8), row["entry"]
    near, at = np.frombuffer(row["near"], np.int32), 0
    for level in range(int(graph.top.max()) + 1):
        nodes = np.flatnonzero(graph.top >= level)
        place = np.full(row["nodes"], -1, np.int32)
        place[nodes] = np.arange(len(nodes))
        size = len(nodes) * Graph.room(level)
        graph.near.append(near[at:at + size].reshape(len(nodes), -1))
        graph.place.append(place)
        at += size
    return graph, np.array(row["id_starts"]), np.array(row["ids"], np.int64)


def search_index(index: DataFrame, queries: DataFrame, k: int, search_width: int = SEARCH_WIDTH) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found for each query by Euclidean distance.

    A query's own id is no candidate; ties go to the smaller id; fewer than k found are all returned. Left out, as query
    and as candidate: null ids, null, empty and zero vectors, those with a null or non-finite component, or one beyond
    1e150, whose square leaves double. Vectors of different length are not compared. Equal rows count once. Empty
    tables give an empty result.
    """

    def one_block(ids: np.ndarray, found: list[np.ndarray]) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    graph, starts, own = _opened(batch.slice(i, 1).to_pylist()[0])
                    out: list[tuple[int, int, float]] = []
                    for query_id, to in zip(ids.tolist(), found):
                        if len(to) != graph.vectors.shape[1]:
                            continue
                        here = []
                        for _, node in graph.search(to, max(search_width, k + 1))[:2 * k + 2]:
                            score = float(np.sqrt(np.square(graph.vectors[node] - to).sum()))
                            few = own[starts[node]:starts[node + 1]][:k + 1]  # in order of id
                            here += [(score, x) for x in few.tolist() if x != query_id]
                        out += [(query_id, x, score) for score, x in sorted(here)[:k]]
                    columns = list(zip(*out)) or [(), (), ()]
                    yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.float64())], ["query_id", "vec_id", "score"])

        return index.mapInArrow(run, "query_id long, vec_id long, score double")

    usable_queries = usable(queries, lambda x: F.abs(x) > 1e150).where(F.exists("embedding", lambda x: x != 0))
    return ranked(searched(usable_queries, one_block, "double"), F.col("score"), k)
