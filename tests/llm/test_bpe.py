import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from hazeline.llm import bpe, q_bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
PIECES = ["a", "ab", " ", "  ", "\n", "\t", "'s", "'", "'re", "1", "²", "½", "é", "漢", "🙂", "_", "-", "<|endoftext|>", "\x1c", "\x85", "　", "\xa0", "the", "ing", "\r\n", "á"]


@pytest.fixture(scope="module")
def ours():
    return bpe.Vocabulary(open(PATH, encoding="utf-8").read())


@pytest.fixture(scope="module")
def theirs():
    return Tokenizer.from_file(PATH)


def same(ours, theirs, text):
    want = theirs.encode(text, add_special_tokens=False).ids
    ids = ours.encode(text)
    return np.frombuffer(ids, "<u4").tolist() == want and ours.decode(ids) == theirs.decode(want, skip_special_tokens=False)


def test_random_texts(ours, theirs):
    rng = random.Random(5)
    for _ in range(4000):
        assert same(ours, theirs, "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 14))))


def test_every_kind_of_letter(ours, theirs):
    for point in [*range(0x3000), *range(0x3000, 0x110000, 97)]:
        if not 0xD800 <= point < 0xE000:
            assert same(ours, theirs, f"a {chr(point)}1{chr(point)} x{chr(point)}"), hex(point)


def test_long_pieces_are_streamed(ours, theirs, monkeypatch):
    rng = random.Random(6)
    for block in (50, 400, 1000):
        monkeypatch.setattr(bpe, "BLOCK_CHARS", block)
        for letters in (["a"], ["aaaa", "ab"], list("abcdeeeinstthr"), ["=", "----"]):
            assert same(ours, theirs, "".join(rng.choice(letters) for _ in range(4000)))


def test_tokens_come_before_the_end_and_nothing_piles_up(ours):
    text = "".join(random.Random(7).choice("abcdeinrst") for _ in range(20_000)).encode()
    read, late = 0, 0

    def parts():
        nonlocal read
        for i in range(0, len(text), 100):
            read = i + 100
            yield text[i:i + 100]

    sent = 0
    for ids in ours.stream(parts()):
        sent += sum(len(ours.text[i]) for i in ids)
        late = max(late, read - sent)
    assert sent == len(text) and late <= ours.lookahead + 2 * ours.longest + 200


def test_lookahead_suffices(ours):
    rng = random.Random(8)
    for _ in range(300):
        head = "".join(rng.choice("aeinrst") for _ in range(700)).encode()
        ends = []
        for tail in (b"", b"ing", b"tttttttt", b"er"):
            cut = np.cumsum([len(ours.text[i]) for i in ours.merged(head + tail)])
            ends.append([x for x in cut.tolist() if x <= len(head) - ours.lookahead])
        assert all(x == ends[0] for x in ends)


def test_broken_bytes_decode_as_the_library_does(ours, theirs):
    rng = random.Random(9)
    for _ in range(500):
        ids = [rng.randrange(50257) for _ in range(rng.randint(0, 12))]
        assert ours.decode(np.array(ids, "<u4").tobytes()) == theirs.decode(ids, skip_special_tokens=False)


def test_odd_documents(odd_docs, no_docs, theirs):
    rows = bpe.transcode(odd_docs, PATH).collect()
    want = [(r.doc_id, theirs.encode(r.text or "", add_special_tokens=False).ids) for r in odd_docs.collect()]
    assert sorted(map(str, ((r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in rows))) == sorted(map(str, want))
    assert sorted(r.decoded for r in rows) == sorted(r.text or "" for r in odd_docs.collect())
    assert bpe.transcode(no_docs, PATH).collect() == []


def test_query(spark, theirs):
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    got = {r.doc_id: r for r in q_bpe.op9_bpe(spark, "/root/testdata/sf0.001").collect()}
    assert got.keys() == docs.keys()
    for key, text in docs.items():
        ids = theirs.encode(text or "", add_special_tokens=False).ids
        digest = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert (got[key].n_tokens, got[key].ids_sha256) == (len(ids), digest)
        assert got[key].decoded_sha256 == hashlib.sha256(theirs.decode(ids, skip_special_tokens=False).encode()).hexdigest()
