import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from hazeline.llm import jaccard
from hazeline.llm.components import components


def sets_of(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    """(doc_id, n, component) by comparing all pairs."""
    sets = [sets_of(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(doc_id, least.get(root(i), doc_id))
    return sorted((str(d), len(s), str(least.get(root(i)) if s else d)) for i, ((d, _), s) in enumerate(zip(rows, sets)))


def engine(df):
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in jaccard.similar_groups(df).collect())


def near_copies(rng, n):
    """Groups of near copies at and around the threshold, with common passages and chains."""
    word = lambda: f"w{rng.randint(0, 4000)}"
    common = [word() for _ in range(30)]
    out = []
    while len(out) < n:
        base = [word() for _ in range(rng.choice([3, 8, 30, 120]))]
        if rng.random() < 0.3:
            base[len(base) // 2:len(base) // 2] = common
        for _ in range(rng.choice([1, 1, 2, 5, 12])):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 25))):
                copy[rng.randrange(len(copy))] = word()
            out.append(" ".join(copy))
            if rng.random() < 0.4:
                base = copy
    return list(enumerate(out[:n]))


@pytest.mark.parametrize("chunk, worth", [(1 << 21, 10), (500, 1)])
def test_near_copies(spark, monkeypatch, chunk, worth):
    monkeypatch.setattr(jaccard, "CHUNK_TOKENS", chunk)
    monkeypatch.setattr(jaccard, "WORTH", worth)
    rows = near_copies(random.Random(chunk), 400)
    assert engine(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_ranges_and_ids_that_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "RANGE_TOKENS", 300)
    monkeypatch.setattr(jaccard, "SMALL_IDS", 0)
    rows = near_copies(random.Random(1), 200)
    assert engine(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_odd_documents(odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert engine(odd_docs) == brute(rows)
    assert engine(no_docs) == [] and jaccard.one_of_each_group(no_docs).collect() == []


def test_one_of_each_group(odd_docs):
    got = jaccard.one_of_each_group(odd_docs)
    assert got.columns == odd_docs.columns
    kept = sorted((str(r.doc_id), r.text) for r in got.collect())
    firsts = {c for d, n, c in brute([(r.doc_id, r.text) for r in odd_docs.collect()]) if n}
    said = [d for d, t in kept if sets_of(t)]
    assert sorted(said) == sorted(firsts)
    assert sum(not sets_of(t) for _, t in kept) == sum(not sets_of(r.text) for r in odd_docs.collect())


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(300)] + [(1000 + rng.randint(0, 60), 1000 + rng.randint(0, 60)) for _ in range(60)] + [(5000, 5000)]
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[root(a)] = root(b)
    got = defaultdict(set)
    for r in components(spark.createDataFrame(edges, "a long, b long")).collect():
        got[r.component].add(r.node)
    want = defaultdict(set)
    for x in parent:
        want[root(x)].add(x)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))
    assert components(spark.createDataFrame([], "a long, b long")).agg(F.count("*")).first()[0] == 0
