import random
import time
import zlib
from collections import Counter, defaultdict
from math import log10

import numpy as np
import pytest
from pyspark.sql import functions as F

from hazeline.llm import pitman_yor as m
from hazeline.llm.q_scoring import op11_scoring
from texts import docs_of


def tokens_of(text):
    return [*(w.lower() for w in (text or "").encode().split()), None]


def plain(rows, discounts, samples=6, burn_in=4, seed=1):
    """Seats customers one at a time, in dictionaries, with the parent changing at each step; log10 of each text."""
    rng = random.Random(seed)
    learned = [tokens_of(t) for t, out in rows if not out]
    uniform = 1 / (len({w for x in learned for w in x}) + 1)
    seats = {}, {}  # by level: (room, dish) -> sizes of tables

    def probability(level, room, dish):
        if level < 0:
            return uniform
        count, tables = totals[level][room]
        sizes = seats[level].get((room, dish), [])
        p = probability(level - 1, None, dish)
        return p if not count else (sum(sizes) - discounts[level] * len(sizes) + (m.STRENGTH[level] + discounts[level] * tables) * p) / (m.STRENGTH[level] + count)

    def seat(level, room, dish):
        sizes, (count, tables) = seats[level].setdefault((room, dish), []), totals[level][room]
        new = (m.STRENGTH[level] + discounts[level] * tables) * probability(level - 1, None, dish)
        x = rng.random() * (new + sum(sizes) - discounts[level] * len(sizes)) - new
        at = 0
        while at < len(sizes) and x >= 0:
            x -= sizes[at] - discounts[level]
            at += 1
        opened = at == 0 or not sizes
        if opened:
            sizes.append(1)
            if level:
                seat(level - 1, None, dish)
        else:
            sizes[at - 1] += 1
        totals[level][room] = count + 1, tables + opened

    def leave(level, room, dish):
        sizes, (count, tables) = seats[level][room, dish], totals[level][room]
        at = rng.choices(range(len(sizes)), sizes)[0]
        sizes[at] -= 1
        closed = sizes[at] == 0
        if closed:
            sizes.pop(at)
            if level:
                leave(level - 1, None, dish)
        totals[level][room] = count - 1, tables - closed

    totals = defaultdict(lambda: (0, 0)), defaultdict(lambda: (0, 0))
    customers = [(u, w) for x in learned for u, w in zip(["start", *x], x)]
    for u, w in customers:
        seat(1, u, w)
    mean = defaultdict(float)
    asked = {(u, w) for t, _ in rows for u, w in zip(["start", *tokens_of(t)], tokens_of(t))}
    for turn in range(burn_in + samples):
        for u, w in customers:
            leave(1, u, w)
            seat(1, u, w)
        if turn >= burn_in:
            for u, w in asked:
                mean[u, w] += probability(1, u, w) / samples
    return [sum(log10(mean[u, w]) for u, w in zip(["start", *tokens_of(t)], tokens_of(t))) for t, _ in rows]


def base_of(rows):
    counts = Counter(w for t, out in rows if not out for w in tokens_of(t))
    n, v = sum(counts.values()), len(counts)
    return [(len(tokens_of(t)), sum(w in counts for w in tokens_of(t)), n, sum(log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens_of(t))) for t, _ in rows]


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 10 == 0


def test_agrees_with_seating_one_by_one(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    rows = [(d.text, held(d.doc_id)) for d in docs]
    got = {r.doc_id: r for r in op11_scoring(spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == len(docs)
    for d, (n, known, total, base) in zip(docs, base_of(rows)):
        r = got[d.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(d.doc_id), n, known, total) and r.base_score == pytest.approx(base, rel=1e-9)
    pairs = Counter((u, w) for t, out in rows if not out for u, w in zip(["start", *tokens_of(t)], tokens_of(t)))
    discount = m.discount_of(sum(n == 1 for n in pairs.values()), sum(n == 2 for n in pairs.values()))
    served = Counter(w for _, w in pairs)
    want = plain(rows, (m.discount_of(sum(n == 1 for n in served.values()), sum(n == 2 for n in served.values())), discount), 3, 2)
    for out in (False, True):
        one, other = (sum(s for s, r in zip(x, rows) if r[1] == out) for x in ([got[d.doc_id].score for d in docs], want))
        assert one == pytest.approx(other, rel=0.02)
    assert sum(got[d.doc_id].score for d, r in zip(docs, rows) if r[1]) > 0.95 * sum(x[3] for x, r in zip(base_of(rows), rows) if r[1])


def test_tables_follow_their_distribution():
    """Many restaurants with one dish of five customers, against the exact distribution of the number of tables."""
    n, c, p, strength, d = 20_000, 5, 0.3, 0.7, 0.6
    ways = {(1, 1): 1.0}  # generalised Stirling numbers
    for k in range(2, c + 1):
        for t in range(1, k + 1):
            ways[k, t] = ways.get((k - 1, t - 1), 0) + (k - 1 - d * t) * ways.get((k - 1, t), 0)
    exact = np.array([ways[c, t] * p ** t * np.prod([strength + d * i for i in range(t)]) for t in range(1, c + 1)])
    rng, customers, tables = np.random.default_rng(1), np.full(n, c), np.ones(n, np.int64)
    sizes, total = customers.copy(), tables.copy()
    for _ in range(12):
        sizes, tables = m.reseat(sizes, tables, customers, np.full(n, p), np.arange(n), total, np.ones(n), strength, d, rng)
    assert (total == tables).all() and (np.bincount(np.repeat(np.arange(n), tables), sizes) == c).all() and sizes.min() > 0
    assert np.bincount(tables, minlength=c + 1)[1:] / n == pytest.approx(exact / exact.sum(), abs=0.015)


@pytest.mark.parametrize("n", [300, 30])  # moved side by side, and one after the other
def test_a_round_moves_all_customers(n):
    """Of dishes with many customers, after a few rounds from one table, against the exact mean number of tables."""
    c, p, strength, d = 400, 0.3, 0.7, 0.6
    ways = np.full(c + 1, -np.inf)  # logarithms of generalised Stirling numbers of the customers so far, by tables
    ways[1] = 0.0
    for k in range(2, c + 1):
        t = np.arange(1, k + 1)
        ways[t] = np.logaddexp(ways[t - 1], np.log(k - 1 - d * np.minimum(t, k - 1)) + ways[t])
    t = np.arange(1, c + 1)
    logs = ways[1:] + t * np.log(p) + np.cumsum(np.log(strength + d * (t - 1)))
    exact = np.exp(logs - logs.max())
    rng, customers, tables = np.random.default_rng(2), np.full(n, c), np.ones(n, np.int64)
    sizes, total = customers.copy(), tables.copy()
    for _ in range(12):
        sizes, tables = m.reseat(sizes, tables, customers, np.full(n, p), np.arange(n), total, np.ones(n), strength, d, rng)
    assert (total == tables).all() and (np.bincount(np.repeat(np.arange(n), tables), sizes) == c).all() and sizes.min() > 0
    spread = np.sqrt((exact * t * t).sum() / exact.sum() - ((exact * t).sum() / exact.sum()) ** 2)
    assert abs(tables.mean() - (exact * t).sum() / exact.sum()) < 4 * spread / np.sqrt(n)


def test_dishes_of_one_room():
    """Several dishes in each of many rooms, against the exact mean numbers of tables."""
    customers, p, strength, d, rooms = [2, 3, 8, 40, 150], [0.05, 0.2, 0.1, 0.3, 0.02], 1.0, 0.7, 400
    each = []  # by dish: weights of its numbers of tables, scaled, without what the room adds
    for c, q in zip(customers, p):
        ways = np.full(c + 1, -np.inf)
        ways[1] = 0.0
        for k in range(2, c + 1):
            t = np.arange(1, k + 1)
            ways[t] = np.logaddexp(ways[t - 1], np.log(k - 1 - d * np.minimum(t, k - 1)) + ways[t])
        logs = ways + np.arange(c + 1) * np.log(q)
        each.append(np.exp(logs - logs.max()))
    most = sum(customers)
    room = np.concatenate([[0.0], np.cumsum(np.log(strength + d * np.arange(most)))])
    exact = []
    for i, own in enumerate(each):
        others = np.ones(1)
        for j, x in enumerate(each):
            others = others if i == j else np.convolve(others, x)
        with np.errstate(divide="ignore"):
            logs = np.log(np.outer(own, others)) + room[np.add.outer(np.arange(len(own)), np.arange(len(others)))]
        weight = np.exp(logs - logs.max()).sum(axis=1)
        exact.append((weight * np.arange(len(own))).sum() / weight.sum())
    n, rng = np.tile(customers, rooms), np.random.default_rng(5)
    sizes, tables, total, found = n.copy(), np.ones(len(n), np.int64), np.full(rooms, len(customers)), []
    of = np.repeat(np.arange(rooms), len(customers))
    for turn in range(60):
        sizes, tables = m.reseat(sizes, tables, n, np.tile(p, rooms), of, total, np.ones(len(n)), strength, d, rng)
        assert (total == np.bincount(of, tables)).all() and (np.bincount(np.repeat(np.arange(len(n)), tables), sizes) == n).all() and sizes.min() > 0
        if turn >= 20:
            found.append(tables.reshape(rooms, -1).mean(axis=0))
    assert np.mean(found, axis=0) == pytest.approx(exact, rel=0.025)


def test_moves_back_to_the_same_table_cost_nothing():
    """A million customers at one table, a new one of which opens seldom: one after the other, seconds for each dish."""
    n, c, d = 100, 1_000_000, 0.6
    total = np.full(n, 1000)
    before = time.process_time()
    sizes, tables = m.reseat(np.full(n, c), np.ones(n, np.int64), np.full(n, c), np.full(n, 1e-3), np.arange(n), total, np.ones(n), 1.0, d, np.random.default_rng(3))
    assert time.process_time() - before < 5
    assert sizes.sum() == n * c and (total == 999 + tables).all() and 1.2 < tables.mean() < 1.6


def test_probabilities_sum_to_one(spark):
    """Of all words after a word that is followed by several, seen words and one unseen."""
    texts = ["a b a c", "a b", "a a b c a", "b c a d", "d a b a b", "", None]
    words = ["a", "b", "c", "d"]
    asked = [f"a {w}" for w in [*words, "zzz"]] + [f"a {w} a {v}" for w in words for v in words]
    rows = m.scored(docs_of(spark, texts + asked), F.col("doc_id") >= len(texts)).collect()
    score = {t: 10 ** r.score for t, r in zip(texts + asked, sorted(rows, key=lambda r: r.doc_id))}
    # P(start a) P(v|a) P(end|v) is known for each v, and P(start a) P(w|a) P(a|w) P(v|a) P(end|v) for each w and v.
    end_after = {w: sum(score[f"a {w} a {v}"] for v in words) for w in words}
    assert all(0 < x < 1 for x in score.values()) and all(0 < x < 1 for x in end_after.values())
    ratios = {(w, v): score[f"a {w} a {v}"] / score[f"a {v}"] for w in words for v in words}  # P(w|a) P(a|w)
    assert all(ratios[w, "a"] == pytest.approx(ratios[w, v], rel=1e-9) for w in words for v in words)


def test_parent_is_a_distribution():
    customers, tables = np.array([5, 1, 1, 30, 0]), np.array([2, 1, 1, 3, 0])
    base = {"customers": 37, "tables": 7, "discount": 0.6, "uniform": 1 / 6}
    p = m._parent_probability(customers, tables, base)
    assert p.sum() + m._parent_probability(np.zeros(1), np.zeros(1), base)[0] == pytest.approx(1)


def test_cut_work_changes_little(spark, monkeypatch):
    """Many parts, chunks and restaurants dealt to several parts: counts are the same, scores nearly."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(3)
    one = {r.doc_id: r for r in m.scored(docs, m.held_out()).collect()}
    for name, value in (("CHUNK_TOKENS", 3000), ("PART_BYTES", 60_000), ("HOT", 200)):
        monkeypatch.setattr(m, name, value)
    for r in m.scored(docs, m.held_out()).collect():
        assert (r.n_tokens, r.n_known, r.train_tokens) == (one[r.doc_id].n_tokens, one[r.doc_id].n_known, one[r.doc_id].train_tokens)
        assert r.base_score == pytest.approx(one[r.doc_id].base_score) and r.score == pytest.approx(one[r.doc_id].score, rel=0.1, abs=2)


def test_odd_documents(spark, odd_docs, no_docs):
    rows = odd_docs.collect()
    got = m.scored(odd_docs, m.held_out()).collect()
    want = [(r.doc_id, *x) for r, x in zip(rows, base_of([(r.text, held(r.doc_id)) for r in rows]))]
    assert sorted(map(str, ((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got))) == sorted(map(str, ((*w[:4], round(w[4], 4)) for w in want)))
    assert all(r.score < 0 for r in got)
    assert m.scored(no_docs, m.held_out()).collect() == []
    unlearned = m.scored(docs_of(spark, ["a b", None]), F.lit(True)).collect()  # nothing to learn from
    assert sorted((r.n_tokens, r.n_known, r.train_tokens, round(r.score, 9)) for r in unlearned) == [(1, 0, 0, 0.0), (3, 0, 0, 0.0)]


def test_reruns_agree(spark):
    docs = docs_of(spark, ["one two three two", "two three one", "three one two one two"] * 5)
    once, again = (sorted(map(str, m.scored(docs, m.held_out()).collect())) for _ in range(2))
    assert once == again
