import numpy as np
import public_tokenizers
from test_jaccard import sets_of
from tokenizers import Tokenizer

import corpus_pipeline
from hazeline.session import written

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        rows = written(stage(spark, docs, FOLDER), "stage")
        seen.append((name, docs, rows))
        docs = rows
    columns = seen[0][1].columns
    assert all(r.columns == columns for _, _, r in seen[:-1])
    (_, before, kept), (_, _, one), (_, _, cut), (_, _, mix), (_, _, ids) = seen
    texts = {r.doc_id: r.text for r in before.collect()}
    assert {r.doc_id for r in kept.collect()} == {d for d, t in texts.items() if t and any(c.isalpha() for c in t)}
    left = [(r.doc_id, sets_of(r.text)) for r in one.collect()]
    for i, (_, a) in enumerate(left):
        assert not any(100 * len(a & b) >= 75 * len(a | b) for _, b in left[:i] if a and b)
    assert {r.doc_id for r in cut.collect()} == {d for d, _ in left}
    assert all(r.n_chars == len(r.text) and (r.text == texts[r.doc_id] or len(r.text) < len(texts[r.doc_id])) for r in cut.collect())
    after = {r.doc_id: r.text for r in cut.collect()}
    assert all(after[r.doc_id] == r.text for r in mix.collect())
    theirs = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = ids.collect()
    assert sorted(r.doc_id for r in got) == sorted(r.doc_id for r in mix.collect())
    for r in got:
        assert np.frombuffer(r.ids, "<u4").tolist() == theirs.encode(after[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(r.ids) // 4 and r.n_decoded == len(after[r.doc_id])


def test_odd_documents_go_through(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES:
            docs = written(stage(spark, docs, FOLDER), "stage")
        assert docs.columns == ["doc_id", "source", "n_tokens", "ids", "n_decoded"]
    assert docs.count() == 0
