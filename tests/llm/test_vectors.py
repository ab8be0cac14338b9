import math

import duckdb
import numpy as np
import pytest

from hazeline.llm import exact_search, hnsw, q_vectors, vectors

SCHEMA = "vec_id long, embedding array<float>, label int"


def rows_of(n=600, d=24, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)).astype(np.float32)
    return [(i, v.tolist(), i % 3) for i, v in enumerate(x)]


ODD = [(None, [1.0] * 24, 0), (9001, None, 0), (9002, [1.0] * 23 + [None], 0), (9003, [1.0] * 23 + [math.nan], 0), (9004, [1.0] * 23 + [math.inf], 0),
       (9005, [0.0] * 24, 0), (9006, [], 0), (9050, [0.25] * 24, 0), (9050, [0.25] * 24, 0), (9100, [1.0, 2.0], 0), (9101, [2.0, 1.0], 0)]


def usable(rows, zero=True):
    seen = {}
    for i, v, _ in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and (zero or any(v)):
            seen[i, tuple(v)] = None
    return list(seen)


def brute(rows, step, k, score, best, zero=True):
    out = []
    every = usable(rows, zero)
    for q, v in every:
        if q % step == 0:
            near = sorted((best(score(v, w)), i, score(v, w)) for i, w in every if i != q and len(w) == len(v))
            out += [(q, r + 1, i, s) for r, (_, i, s) in enumerate(near[:k])]
    return sorted(out)


def product(v, w):
    return sum(math.floor(256 * a) * math.floor(256 * b) for a, b in zip(v, w))


@pytest.mark.parametrize("block", [4 << 20, 8 * 24 * 3])
def test_exact_products(spark, monkeypatch, block):
    monkeypatch.setattr(vectors, "BLOCK_BYTES", block)
    monkeypatch.setattr(exact_search, "CANDIDATES", 100)
    rows = rows_of(200) + ODD
    df = spark.createDataFrame(rows, SCHEMA)
    got = exact_search.top_products(df, df.where("vec_id % 50 = 0"), 5)
    assert sorted(map(tuple, got.collect())) == brute(rows, 50, 5, product, lambda s: -s)


def test_products_beyond_double(spark):
    rows = [(i, [3.0e15 * (i + 1), -2.0e15, 1.0 + i], 0) for i in range(6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = exact_search.top_products(df, df.where("vec_id = 0"), 5).collect()
    cut = lambda s: max(-(1 << 63), min((1 << 63) - 1, s))
    want = sorted((-cut(product(rows[0][1], v)), i) for i, v, _ in rows[1:])
    assert [(-r.score, r.vec_id) for r in got] == want


def test_fewer_candidates_than_asked_for_and_none(spark):
    df = spark.createDataFrame(rows_of(3), SCHEMA)
    assert exact_search.top_products(df, df.where("vec_id = 0"), 5).count() == 2
    none = df.where("false")
    assert exact_search.top_products(none, none, 5).collect() == [] and hnsw.search_index(hnsw.build_index(none), none, 5).collect() == []


def test_equals_its_check(spark):
    con = duckdb.connect()
    con.execute("create view embeddings as select * from '/root/testdata/sf0.01/embeddings.parquet'")
    got = sorted(map(tuple, q_vectors.op10_top_products(spark, "/root/testdata/sf0.01").collect()))
    assert got == sorted(con.execute(q_vectors.PRODUCTS).fetchall())


def test_small_shards_are_exact_and_odd_vectors_left_out(spark):
    rows = rows_of(300) + ODD
    df = spark.createDataFrame(rows, SCHEMA)
    got = hnsw.search_index(hnsw.build_index(df, shard_rows=64), df.where("vec_id % 50 = 0"), 10)
    apart = lambda v, w: float(np.sqrt(np.square(np.array(v) - np.array(w)).sum()))
    want = brute(rows, 50, 10, apart, lambda s: s, zero=False)
    assert [(q, r, i) for q, r, i, _ in sorted(map(tuple, got.collect()))] == [(q, r, i) for q, r, i, _ in want]


def test_copies_share_a_node(spark):
    rows = [(i, [1.0, 2.0, 3.0], 0) for i in range(200)] + [(i, [float(i), 0.5, 1.0], 0) for i in range(200, 260)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = hnsw.search_index(hnsw.build_index(df, shard_rows=100), df.where("vec_id = 100"), 10).collect()
    assert [r.vec_id for r in sorted(got, key=lambda r: r.rank)] == [*range(10)] and {r.score for r in got} == {0.0}


def test_recall(spark):
    folder = "/root/testdata/sf0.1"
    got = q_vectors.op5_nearest(spark, folder).collect()
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").orderBy("vec_id").collect()
    x, ids = np.array([r.embedding for r in rows], np.float64), np.array([r.vec_id for r in rows])
    hits = 0
    for q in ids[ids % 100 == 0]:
        away = np.sqrt(np.square(x - x[ids == q][0]).sum(axis=1))
        near = [i for i in ids[np.lexsort((ids, away))] if i != q][:10]
        mine = [r for r in got if r.query_id == q]
        hits += len({r.vec_id for r in mine} & set(near))
        assert all(r.score == pytest.approx(away[ids == r.vec_id][0]) for r in mine)
    assert hits / len(got) >= 0.9
