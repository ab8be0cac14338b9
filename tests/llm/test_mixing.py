import re
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from hazeline.llm import mixing, q_mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return len(WORD.findall(text or ""))


def brute_targets(rows, weights=(5, 2, 1), share=1.5, cap=2.0):
    sizes = defaultdict(int)
    for source, size in rows:
        sizes[source] += size
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    target, open_, left = {s: 0.0 for s in order}, set(order), share * sum(sizes.values())
    while open_ and left > 1e-9:
        total, given = sum(weight[s] for s in open_), left
        for s in sorted(open_, key=str):
            take = min(given * weight[s] / total, cap * sizes[s] - target[s])
            target[s] += take
            left -= take
        open_ = {s for s in open_ if target[s] < cap * sizes[s] - 1e-9}
    return target


def test_odd_documents(spark, odd_docs):
    got = mixing.mix(odd_docs).collect()
    assert len(got) == odd_docs.count()
    want = brute_targets([(r.source, r["size"]) for r in got])
    taken, largest = defaultdict(int), defaultdict(int)
    for r in got:
        assert 0 <= r.taken <= 2 * r["size"] and r.target == pytest.approx(want[r.source])
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r["size"])
    for source, target in want.items():
        assert abs(taken[source] - target) <= largest[source]
    assert sorted(map(str, mixing.mix(odd_docs).collect())) == sorted(map(str, got))  # reruns agree


def test_the_documents_of_the_mix_are_those_taken(odd_docs):
    got = mixing.mixed(odd_docs)
    assert got.columns == odd_docs.columns
    size = sum(words(r.text) for r in got.collect())
    assert size == mixing.mix(odd_docs).agg(F.sum("taken")).first()[0]


def test_larger_budgets_hold_smaller_ones(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text"), F.concat(F.lit("s"), (F.col("id") % 2).cast("string")).alias("source"))
    picked = []
    for share in (0.2, 0.5, 0.8):
        picked.append({r.doc_id for r in mixing.mix(docs, share=share).where("taken > 0").collect()})
    assert picked[0] < picked[1] < picked[2]


def test_boundary_is_refined_to_one_document(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("a b c d").alias("text"), F.when(F.col("id") % 3 == 0, F.lit("s")).otherwise(F.lit("t")).alias("source"))
    for r in mixing.mix(docs, share=0.7).groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target")).collect():
        assert abs(r.taken - r.target) <= 2


def test_no_documents(no_docs):
    assert mixing.mix(no_docs).collect() == [] and mixing.mixed(no_docs).collect() == []


def test_equals_its_check(spark):
    con = duckdb.connect()
    con.execute("create view documents as select * from '/root/testdata/sf0.001/documents.parquet'")
    want = con.execute(q_mixing.SQL).fetchall()
    got = [tuple(r) for r in q_mixing.op6_mixing(spark, "/root/testdata/sf0.001").collect()]
    assert sorted(got) == sorted(want)
