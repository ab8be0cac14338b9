import random
from collections import defaultdict

import corpus_pipeline
from hazeline.llm.passages import SPAN, passages
from hazeline.llm.substrings import class_key
from texts import docs_of


def brute(texts):
    """Words that go of each text, by comparing all passages."""
    places, words = defaultdict(set), [(t or "").encode().split() for t in texts]
    for d, x in enumerate(words):
        for i in range(len(x) - SPAN + 1):
            places[tuple(x[i:i + SPAN])].add((d, i))
    gone = defaultdict(set)
    for same in places.values():
        if len(same) > 1:
            for d, i in same:
                gone[d].update(range(i, i + SPAN))
    return [[w for i, w in enumerate(x) if i not in gone[d]] for d, x in enumerate(words)]


def engine(spark, docs):
    found = {bytes(r.key): r.spans for r in passages(docs.select("text")).collect()}
    out = []
    for r in docs.select("doc_id", "text", class_key().alias("key")).orderBy("doc_id").collect():
        data = bytearray((r.text or "").encode())
        for s in found.get(bytes(r.key), ()):
            data[s["from"]:s["to"]] = b" " * (s["to"] - s["from"])
        out.append(bytes(data).split())
    return out


def test_a_passage_of_54_short_words_goes_from_two_documents(spark):
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("abcdefghij") for _ in range(n))
    text = lambda n: " ".join(word(rng.randint(2, 9)) for _ in range(n))
    long_ = " ".join(word(rng.randint(4, 5)) for _ in range(54))
    short = " ".join(long_.split()[:50])
    assert len(long_) < 320
    a, b, c, d = (text(80) for _ in range(4))
    texts = [f"{a} {long_} {b}", f"{c} {long_}\n{d}", f"{text(70)} {short} {text(70)}"]
    rows = corpus_pipeline.repeated_passages(spark, docs_of(spark, texts), "").orderBy("doc_id").collect()
    assert [r.text for r in rows] == [f"{a}  {b}", f"{c} \n{d}", texts[2]]


def test_all_passages(spark):
    rng = random.Random(8)
    shared = [[rng.choice("ab é xyz lm".split()) for _ in range(120)] for _ in range(4)]
    texts = []
    for _ in range(60):
        words = []
        for _ in range(rng.randint(0, 4)):
            kind, p, at = rng.random(), rng.choice(shared), rng.randint(0, 60)
            words += p[at:at + rng.randint(45, 60)] if kind < 0.6 else ["q"] * rng.randint(1, 60) if kind < 0.7 else [str(rng.random()) for _ in range(rng.randint(1, 40))]
        texts.append("".join(w + rng.choice([" ", "\n", "  "]) for w in words))
    texts += [None, "", " ".join(["r"] * 50), " ".join(["r"] * 51), " ".join(["s"] * 52), " ".join(map(str, range(51))), " ".join(map(str, range(51))), "u v", "u v"]
    want = brute(texts)
    assert engine(spark, docs_of(spark, texts)) == want and sum(map(len, want)) < sum(len((t or "").split()) for t in texts)


def test_real_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert engine(spark, docs) == brute([r.text for r in docs.orderBy("doc_id").collect()])


def test_odd_documents(spark, odd_docs, no_docs):
    assert passages(no_docs).collect() == []
    assert passages(odd_docs).count() > 0
