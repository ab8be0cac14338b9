import hashlib
import random
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from hazeline.llm import q_substrings
from hazeline.llm import substrings as sub
from texts import docs_of


def brute(rows):
    """(doc_id, bytes, removed, runs, digest) by comparing all windows."""
    places = defaultdict(list)
    data = [(t or "").encode() for _, t in rows]
    for d, x in enumerate(data):
        for i in range(len(x) - sub.WINDOW + 1):
            places[hashlib.blake2b(x[i:i + sub.WINDOW], digest_size=16).digest()].append((d, i))
    gone = [bytearray(len(x)) for x in data]
    for same in places.values():
        if len(same) > 1:
            for d, i in same:
                gone[d][i:i + sub.WINDOW] = b"\1" * sub.WINDOW
    out = []
    for (doc_id, _), x, g in zip(rows, data, gone):
        runs = sum(1 for i in range(len(g)) if g[i] and not (i and g[i - 1]))
        kept = bytes(c for c, r in zip(x, g) if not r)
        out.append((str(doc_id), len(x), sum(g), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def engine(df, **how):
    rows = sub.without_repeats(df, **how).select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("r"), F.size("spans").alias("s"), F.sha2("kept", 256).alias("h"))
    return sorted((str(r[0]), *r[1:]) for r in rows.collect())


def passages(rng, n):
    shared = ["".join(rng.choice("abcde é") for _ in range(rng.randint(300, 900))) for _ in range(6)]
    out = []
    for i in range(n):
        text = ""
        for _ in range(rng.randint(0, 5)):
            kind = rng.random()
            if kind < 0.5:
                p = rng.choice(shared)
                at = rng.randint(0, 200)
                text += p[at:at + rng.randint(100, 900)]
            elif kind < 0.7:
                text += rng.choice(["a", "xyz "]) * rng.randint(1, 700)
            else:
                text += "".join(rng.choice("abcdefghij ") for _ in range(rng.randint(1, 500)))
        out.append((i, text))
    return out


@pytest.mark.parametrize("hot", [sub.HOT, 3])
def test_passages(spark, hot):
    rows = passages(random.Random(hot), 120)
    rows += [(900, None), (901, ""), (902, "q" * 399), (903, "q" * 400), (904, "r" * 401), (905, rows[3][1]), (906, rows[3][1])]
    assert engine(spark.createDataFrame(rows, "doc_id long, text string"), hot=hot) == brute(rows)


def test_one_footer_in_many_texts(spark):
    """However many different texts share a passage, no group of tuples is larger than the limit, and nothing is lost."""
    rng = random.Random(8)
    footer = "".join(rng.choice("abcdefgh ") for _ in range(600))
    rows = [(i, "".join(rng.choice("ijklmnop ") for _ in range(rng.randint(5, 60))) + footer + "".join(rng.choice("qrstuv") for _ in range(rng.randint(0, 40)))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = engine(docs, hot=40)
    assert got == brute(rows) and got == engine(docs)
    tuples = sub._tuples(sub._texts(docs, sub._candidates(sub.described(docs))))
    one = tuples.groupBy("id", "value", "before").agg(F.max("seg").alias("seg"), F.count("*").alias("rows"))
    small, large, _ = sub._split(one, 40)
    assert max(r["count"] for r in one.groupBy("value").count().collect()) > 40 and large.count() > 0
    assert max(r["count"] for r in small.groupBy("value").count().collect()) <= 40


def test_planted_passages(spark):
    """Every passage of 400 bytes and more that was planted in two texts goes, and nothing else does."""
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9))) for _ in range(4000)]
    said = lambda n: " ".join(rng.choice(words) for _ in range(n))
    planted = [said(n) for n in (60, 75, 90, 120, 200)]
    texts = [f"{said(80)}\n{planted[i % 5]}\n{said(50)}" for i in range(40)] + [said(150) for _ in range(20)]
    kept = {r.doc_id: r for r in sub.without_repeats(docs_of(spark, texts)).select("doc_id", sub.whole_characters().alias("kept"), "n_bytes").collect()}
    for i, text in enumerate(texts):
        gone = i < 40 and len(planted[i % 5]) >= 400
        assert (planted[i % 5] not in kept[i].kept) if gone else (kept[i].kept == text or i < 40)
    assert all(kept[i].kept == texts[i] for i in range(40, 60))


def test_odd_documents(odd_docs, no_docs):
    got = sub.without_repeats(odd_docs)
    assert got.columns == [c for c in odd_docs.columns if c not in ("n_bytes", "spans", "kept")] + ["n_bytes", "spans", "kept"]
    assert engine(odd_docs) == brute([(r.doc_id, r.text) for r in odd_docs.collect()])
    assert sub.without_repeats(no_docs).collect() == []


def test_real_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert engine(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_anchors_do_not_depend_on_blocks(monkeypatch):
    rng = random.Random(4)
    text = "".join(rng.choice(["abc", "d", "ef ", "aaaaaaaa"]) for _ in range(4000)).encode()
    whole = [x.tolist() for x in sub.anchors(text)]
    monkeypatch.setattr(sub, "BLOCK", 1500)
    assert [x.tolist() for x in sub.anchors(text)] == whole
    hashes = sub._gram_hashes(np.frombuffer(text, np.uint8).astype(np.uint64))
    want = [i + int(np.argmin(hashes[i:i + sub.PLACES])) for i in range(len(text) - sub.WINDOW + 1)]
    got = [a for a, first, last in zip(*whole[1:]) for _ in range(first, last + 1)]
    assert got == want


def test_text_of_what_is_kept(spark):
    row = spark.createDataFrame([(bytearray("é".encode()[1:] + "aé".encode() + "é".encode()[:1]),)], "kept binary")
    assert row.select(sub.whole_characters()).first()[0] == "aé"


def test_equals_its_check(spark):
    con = duckdb.connect()
    con.execute("create view documents as select * from '/root/testdata/sf0.001/documents.parquet'")
    got = sorted(map(tuple, q_substrings.op2_substrings(spark, "/root/testdata/sf0.001").collect()))
    assert got == sorted(con.execute(q_substrings.SQL).fetchall())
