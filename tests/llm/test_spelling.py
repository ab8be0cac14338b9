import random
import re
import zlib
from collections import Counter, defaultdict

from hazeline.llm import spelling
from hazeline.llm.q_spelling import op13_spelling
from texts import docs_of


def brute(rows):
    """Words, forms and roots by one dictionary of all strings one deletion away."""
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    shorter = defaultdict(set)
    for w in words:
        for i in range(len(w)):
            shorter[i, w[:i] + w[i + 1:]].add(w)  # replaced at i
    near = defaultdict(set)
    for same in shorter.values():
        for a in same:
            near[a] |= same - {a}
    for w in words:
        for i in range(len(w)):
            if (cut := w[:i] + w[i + 1:]) in words:
                near[w].add(cut)
                near[cut].add(w)
    best = {w: min(near[w], key=lambda x: (-words[x], x)) for w in words if near[w]}
    forms = {w: b for w, b in best.items() if words[b] >= 5 * words[w]}

    def root(w):
        while w in forms:
            w = forms[w]
        return w

    return sorted((w, forms.get(w), root(w), n, len(near[w]), words[forms[w]] if w in forms else None) for w, n in words.items())


def result(df):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect())


def test_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    got = result(op13_spelling(spark, "/root/testdata/sf0.01"))
    assert got == want and sum(f is not None for _, f, *_ in want) > 10


def test_large_groups_are_cut_without_loss(spark):
    rng = random.Random(3)
    words = {"colour" + "".join(rng.choice("ab") for _ in range(rng.randint(7, 9))) for _ in range(2000)}
    texts = [" ".join([w] * rng.choice([5, 6, 30, 200])) for w in sorted(words)] + ["colour " * 9, "Colours " * 60, "ÀÀÀÀÀÀ àààààà " * 7]
    want = brute(list(enumerate(texts)))
    assert result(spelling.variants(docs_of(spark, texts))) == want
    assert max(r[4] for r in want) > 5 and any(r[2] not in (r[0], r[1]) for r in want)  # chains of forms


def test_words_of_all_lengths(spark):
    rng = random.Random(5)
    texts = []
    for _ in range(300):
        w = "".join(rng.choice("abcé") for _ in range(rng.randint(4, 9)))
        i = rng.randrange(len(w))
        for v in (w, w[:i] + w[i + 1:], w[:i] + rng.choice("abcé") + w[i:], w[:i] + rng.choice("abcé") + w[i + 1:]):
            texts.append(f"{v} " * rng.choice([4, 5, 25, 130]))
    long_ = "y" * 60_000
    texts += [f"{long_} {long_}z " * 5, f"{long_}z-" * 30]
    assert result(spelling.variants(docs_of(spark, texts))) == brute(list(enumerate(texts)))


def test_odd_documents(spark, odd_docs, no_docs):
    more = odd_docs.unionByName(odd_docs).unionByName(odd_docs)  # repeated rows count again
    assert result(spelling.variants(more)) == brute([(r.doc_id, r.text) for r in more.collect()])
    assert spelling.variants(no_docs).collect() == []


def test_blocks_stay_bounded(spark):
    """10,000 words with one half in common: no part holds many more than a block."""
    words = spark.range(10_000).selectExpr("concat('abcdefgh', lpad(conv(id, 10, 36), 6, 'x'), 'zz') as word", "id + 5 as n")
    sizes = spelling._cut(spelling._halves(words)).groupBy("key", "part").count()
    assert sizes.agg({"count": "max"}).first()[0] < 1.5 * spelling.BLOCK
