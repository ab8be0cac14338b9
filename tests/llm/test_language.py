from collections import Counter

from pyspark.sql import functions as F

from hazeline.llm import language, q_language


def brute_counts(text):
    """N-grams as strings, a blank before and after each word."""
    found, word = Counter(), ""
    for c in (text or "") + " ":
        if c.isalpha():
            word += c.lower() if len(c.lower()) == 1 else c
        elif word:
            padded = f" {word} "
            for n in (1, 2, 3):
                for i in range(len(padded) - n + 1):
                    gram = padded[i:i + n]
                    if gram != " " and " " not in gram[1:-1]:
                        found[gram] += 1
            word = ""
    return found


def brute_rank(counts):
    # the blank sorts before all letters, a shorter n-gram before its continuations
    key = lambda g: [0x1 if c == " " else ord(c) for c in g]
    return sorted(counts, key=lambda g: (-counts[g], key(g) + [0] * (3 - len(g))))[:language.PROFILE]


def brute(rows, learned):
    profiles = {}
    for text, lang in learned:
        if text is not None and lang is not None:
            profiles.setdefault(lang, Counter()).update(brute_counts(text))
    profiles = {k: {g: i for i, g in enumerate(brute_rank(v))} for k, v in sorted(profiles.items())}
    out = []
    for text in rows:
        ranked = brute_rank(brute_counts(text))
        if not ranked or not profiles:
            out.append(("und", 0.0))
            continue
        away = {k: sum(abs(p[g] - i) if g in p else language.PROFILE for i, g in enumerate(ranked)) for k, p in profiles.items()}
        best = min(away, key=lambda k: (away[k], k))
        out.append((best, round(1 - away[best] / (language.PROFILE * len(ranked)), 9)))
    return out


def test_odd_documents(odd_docs, no_docs):
    rows = odd_docs.collect()
    known = language.learn(odd_docs)
    got = language.identify(odd_docs, known)
    assert got.columns == [c for c in odd_docs.columns if c not in ("lang_pred", "score")] + ["lang_pred", "score"]
    want = brute([r.text for r in rows], [(r.text, r.lang) for r in rows])
    assert sorted((r.lang_pred, round(r.score, 9)) for r in got.collect()) == sorted(want)
    assert language.identify(no_docs, known).collect() == []
    assert {r.lang_pred for r in language.identify(odd_docs, language.learn(no_docs)).collect()} == {"und"}


def test_real_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.withColumn("out", language.held_out()).orderBy("doc_id").collect()
    want = brute([r.text for r in rows], [(r.text, r.lang) for r in rows if not r.out])
    got = q_language.op1_language(spark, "/root/testdata/sf0.001").orderBy("doc_id").collect()
    assert [(r.lang_pred, round(r.score, 9)) for r in got] == want
    assert [r.held_out for r in got] == [r.out for r in rows]


def test_held_out_accuracy(spark):
    got = q_language.op1_language(spark, "/root/testdata/sf0.01").where("held_out").join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), "doc_id")
    right = got.where("lang is not null").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right > 0.97


def test_long_texts_are_counted_in_pieces(monkeypatch):
    text = "Some words, and more of them " * 300
    whole = language._counts(text)
    monkeypatch.setattr(language, "CHUNK_CHARS", 64)
    assert [x.tolist() for x in language._counts(text)] == [x.tolist() for x in whole]
