from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from hazeline.llm import q_rollups
from hazeline.llm.rollups import IMAGE, Rollup

CHANGES = f"batch_id string, before {IMAGE}, after {IMAGE}"
A, B, C = ("s", "en", "t1", 10), ("s", "en", "t2", 13), ("r", None, "t1", 5)
BATCHES = [[("1", None, A), ("1", None, A), ("1", None, C)], [("2", A, B)], [("3", C, None)], [("4", None, None)]]


def sums(batches):
    out = defaultdict(lambda: [0, 0])
    for batch in batches:
        for _, before, after in batch:
            for sign, side in ((-1, before), (1, after)):
                if side:
                    out[side[:3]][0] += sign
                    out[side[:3]][1] += sign * side[3]
    return sorted(((*k, *v) for k, v in out.items() if v != [0, 0]), key=str)


def got(rollup):
    return sorted((tuple(r) for r in rollup.read().collect()), key=str)


def test_deletes_revisions_and_repeated_batches(spark, tmp_path):
    rollup = Rollup(spark, f"{tmp_path}/rollup")
    assert got(rollup) == [] and rollup.version() == 0
    for i, batch in enumerate(BATCHES, 1):
        changes = spark.createDataFrame(batch, CHANGES)
        assert rollup.commit(changes) == 1 and rollup.commit(changes) == 0 and rollup.version() == i
        assert got(rollup) == sums(BATCHES[:i])
    assert got(rollup) == [("s", "en", "t1", 1, 10), ("s", "en", "t2", 1, 13)]
    # known batches together with a new one
    again = spark.createDataFrame([r for b in BATCHES for r in b] + [("5", B, None)], CHANGES)
    assert rollup.commit(again) == 1 and got(rollup) == [("s", "en", "t1", 1, 10)]
    assert got(Rollup(spark, f"{tmp_path}/rollup")) == got(rollup)
    with pytest.raises(ValueError):
        rollup.commit(spark.createDataFrame([(None, None, A)], CHANGES))


def test_any_order_of_batches(spark, tmp_path):
    rollup = Rollup(spark, f"{tmp_path}/rollup")
    for batch in reversed(BATCHES):
        rollup.commit(spark.createDataFrame(batch, CHANGES))
    assert got(rollup) == sums(BATCHES)


def test_a_taken_version_and_a_lost_commit(spark, tmp_path, monkeypatch):
    one, other = (Rollup(spark, f"{tmp_path}/rollup") for _ in range(2))
    publish = one._publish

    def late(aside, version):
        if version == 1 and not other.version():
            other.commit(spark.createDataFrame(BATCHES[0] + BATCHES[2], CHANGES))
        return publish(aside, version)

    monkeypatch.setattr(one, "_publish", late)
    assert one.commit(spark.createDataFrame(BATCHES[0] + BATCHES[1], CHANGES)) == 1  # the other has committed batch 1
    assert one.version() == 2 and got(one) == sums(BATCHES)

    def lost(aside, version):
        raise RuntimeError("lost")

    monkeypatch.setattr(other, "_publish", lost)
    more = spark.createDataFrame([("6", None, A)], CHANGES)
    with pytest.raises(RuntimeError):
        other.commit(more)
    assert got(one) == sums(BATCHES)
    assert one.commit(more) == 1


def test_odd_documents(spark, odd_docs, no_docs, tmp_path):
    rollup = Rollup(spark, f"{tmp_path}/rollup")
    for changes in q_rollups.batches_of(odd_docs):
        rollup.commit(changes)
    assert rollup.read().agg(F.sum("n_docs")).first()[0] == odd_docs.where("coalesce(doc_id, 0) % 5 <> 0").count()
    assert [Rollup(spark, f"{tmp_path}/none").commit(x) for x in q_rollups.batches_of(no_docs)] == [0, 0, 0]


def test_equals_its_check(spark):
    con = duckdb.connect()
    con.execute("create view documents as select * from '/root/testdata/sf0.001/documents.parquet'")
    want = con.execute(__spark_entry__.oracle_sql()["op4_rollups"]).fetchall()
    rows = __spark_entry__.queries()["op4_rollups"](spark, "/root/testdata/sf0.001")
    assert sorted((tuple(r) for r in rows.collect()), key=str) == sorted(want, key=str)
