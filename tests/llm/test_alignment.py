from collections import defaultdict

import numpy as np
import sentencepiece
from tokenizers import Tokenizer

from hazeline.llm import alignment as m
from hazeline.llm import runs
from hazeline.llm.bpe import byte_letters
from hazeline.llm.q_alignment import A, B, digest, op12_alignment
from texts import docs_of


def brute(texts):
    """The contract word by word, with the two libraries and token by token."""
    coder, letters = Tokenizer.from_file(A), byte_letters()
    coder.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=B)
    said, links, docs_of_pair = [], [], defaultdict(set)
    for d, text in enumerate(texts):
        whole = b" " + (text or "").encode()
        a = coder.encode(" " + (text or ""), add_special_tokens=False)
        b = pieces.encode(text or "")
        spelled_a = [bytes(letters[c] for c in t) for t in a.tokens]
        spelled_b = [bytes([int(p[3:-1], 16)]) if pieces.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, pieces.id_to_piece(i)) for i in b)]
        a = a.ids
        if not text or b"".join(spelled_a) != whole or b"".join(spelled_b) != whole:
            a, b, spelled_a, spelled_b = [], [], [], []
        end_a, end_b = np.cumsum([0, *map(len, spelled_a)]).tolist(), np.cumsum([0, *map(len, spelled_b)]).tolist()
        pairs, first = [], 0
        for i in range(len(a)):
            while first < len(b) and end_b[first + 1] <= end_a[i]:
                first += 1
            j = first
            while j < len(b) and end_b[j] < end_a[i + 1]:
                pairs.append((a[i], b[j]))
                j += 1
        for p in pairs:
            docs_of_pair[p].add(d)
        links.append(pairs)
        cuts = sorted(set(end_a[1:]) & set(end_b[1:]))
        groups, i, j = [], 0, 0
        for c in cuts:
            x, y = end_a.index(c, i), end_b.index(c, j)
            groups.append(",".join(map(str, a[i:x])) + "|" + ",".join(map(str, b[j:y])))
            i, j = x, y
        said.append((len(a), len(b), len(cuts), len(pairs), ";".join(groups)))
    top = defaultdict(int)
    for (a, _), docs in docs_of_pair.items():
        top[a] = max(top[a], len(docs))
    return [
        (*s[:4], sum(len(docs_of_pair[p]) == top[p[0]] for p in pairs), sum(len(docs_of_pair[p]) for p in pairs), s[4])
        for s, pairs in zip(said, links)]


def rows(df):
    return sorted(((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups) for r in df.collect()), key=str)


def test_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    want = [(d.doc_id, *x[:6], digest(x[6].encode()) if x[6] else "") for d, x in zip(docs, brute([d.text for d in docs]))]
    got = op12_alignment(spark, "/root/testdata/sf0.001").withColumnRenamed("groups_sha256", "groups")
    assert rows(got) == sorted(want, key=str)


def test_small_chunks_blocks_and_shares(spark, monkeypatch):
    """Runs of many chunks, merged in several shares and in blocks of a few pairs."""
    for name, value in (("CHUNK_DOCS", 7), ("RADIX", 3), ("BEST_PAIRS", 5), ("SHARE_BYTES", 2000)):
        monkeypatch.setattr(m, name, value)
    monkeypatch.setattr(runs, "BLOCK", 5)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("doc_id < 60").collect()
    texts = [d.text for d in docs] + ["the same words again"] * 40
    want = [(i, *x) for i, x in enumerate(brute(texts))]
    assert rows(m.alignment(docs_of(spark, texts), A, B)) == sorted(want, key=str)


def test_odd_documents(spark, odd_docs, no_docs):
    docs = odd_docs.collect()
    more = ["a  b", " x　y", "<s> </s> <unk> <|endoftext|>", "▁under", "ﬁ ½ é", "\r\n\t tab", "日本語 🙂🏽", " leading", "trailing "]
    want = [(d.doc_id, *x) for d, x in zip(docs, brute([d.text for d in docs] + more))]
    assert all(w[1:7] == (0,) * 6 and w[7] == "" for w, d in zip(want, docs) if not d.text)
    every = odd_docs.select("doc_id", "text").unionByName(spark.createDataFrame([(100 + i, t) for i, t in enumerate(more)], "doc_id long, text string"))
    want += [(100 + i, *x) for i, x in enumerate(brute([d.text for d in docs] + more)[len(docs):])]
    assert rows(m.alignment(every, A, B)) == sorted(want, key=str)
    assert m.alignment(no_docs, A, B).collect() == []


def test_merge_sums_in_order():
    rng = np.random.default_rng(2)
    every = [np.unique(rng.integers(0, 1 << 40, rng.integers(1, 90_000))) for _ in range(5)] + [np.array([7], np.int64)]
    got = list(runs.merged([runs.head_of(r, np.full(len(r), i + 1)) for i, r in enumerate(every)]))
    pairs, counts = (np.concatenate(x) for x in zip(*got))
    want, place = np.unique(np.concatenate(every), return_inverse=True)
    assert (pairs == want).all() and (counts == np.bincount(place, np.repeat(np.arange(1, 7), [len(r) for r in every]))).all()
