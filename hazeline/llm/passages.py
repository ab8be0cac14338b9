"""Passages of more than 50 words that stand in several places.

Words are compared, not the white space between them. Equal runs of `SPAN` words have the same least hash of a short run
of words (their anchor), so only runs whose anchor's hash stands elsewhere too are compared, by a digest of all words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeline.llm.substrings import BASE, MIX, SPANS, _cut, _least, _list, class_key
from hazeline.session import written

SMALL_ROWS = 200_000  # rows of a few numbers, up to which they are broadcast
SPAN = 51  # words: the shortest passage of more than 50
SHORT = 20  # words of the short runs whose hashes are compared
PLACES = SPAN - SHORT + 1  # of short runs in a passage
SHAPE = "array<struct<from:int,to:int>>"


class _Hashes(dict):
    """Hashes of words, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 300_000:
            self.clear()
        self[word] = out = xxhash.xxh64_intdigest(word)
        return out


def anchors(hashes: np.ndarray) -> tuple[np.ndarray, ...]:
    """(hash, first passage, last passage, whether the hash stands there more than once) of each run of passages, each
    known by its first word, with the same least hash of a short run. `hashes`: of the words of a text."""
    n = len(hashes) - SHORT + 1
    if n < PLACES:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    short = np.zeros(n, np.uint64)
    for k in range(SHORT):
        short = short * np.uint64(BASE) + hashes[k:k + n]
    short ^= short >> np.uint64(32)
    short *= MIX
    short ^= short >> np.uint64(32)
    least = _least(short, PLACES)
    first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    last = np.append(first[1:], len(least)) - 1
    views = np.lib.stride_tricks.sliding_window_view(short, PLACES)
    left = first + views[first].argmin(axis=1)
    right = last + PLACES - 1 - views[last][:, ::-1].argmin(axis=1)
    return least[first].view(np.int64), first, last, left != right


def _described(docs: DataFrame) -> DataFrame:
    """(key, n_bytes, n_words, values, firsts, lasts, many): class, size and anchors of each text. Stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Hashes()
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                some = batch.slice(start, 1000)
                sizes, counts, found = [], [], []
                for x in some.column(1):
                    data = (x.as_py() or "").encode()
                    words = data.split()
                    sizes.append(len(data))
                    counts.append(len(words))
                    found.append(anchors(np.fromiter(map(known.__getitem__, words), np.uint64, len(words))))
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64()), *(_list([f[i] for f in found], k) for i, k in enumerate((pa.int64(), pa.int32(), pa.int32(), pa.int8())))],
                    ["key", "n_bytes", "n_words", "values", "firsts", "lasts", "many"])

    shape = "key binary, n_bytes long, n_words long, values array<long>, firsts array<int>, lasts array<int>, many array<tinyint>"
    return written(docs.select(class_key().alias("key"), "text").mapInArrow(run, shape), "passages-docs")


def _small(rows: DataFrame) -> DataFrame:
    return F.broadcast(rows) if rows.count() <= SMALL_ROWS else rows


def _candidates(every: DataFrame) -> DataFrame:
    """(key, runs): of each class the runs of passages whose anchor's hash also stands elsewhere. Stored."""
    one = written(every.where(F.size("values") > 0).select("key", "values", "firsts", "lasts", "many").dropDuplicates(["key"]), "passages-classes")
    rows = one.select("key", F.explode(F.arrays_zip("values", "firsts", "lasts", "many")).alias("a")).select("key", "a.*")
    place = F.xxhash64("key", "firsts")
    sums = rows.groupBy("values").agg(F.min(place).alias("one"), F.max(place).alias("other"), F.max("many").alias("many"))
    shared = written(sums.where("one <> other or many > 0").select("values"), "passages-anchors")
    near = rows.join(_small(shared), "values", "left_semi")
    return written(near.groupBy("key").agg(F.collect_list(F.struct("firsts", "lasts")).alias("runs")), "passages-candidates")


def _windows(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(digest, key, from, to) of each candidate: digest of its words, and its bytes in the text. Stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, kinds = ["digest", "key", "from", "to"], [pa.binary(), pa.binary(), pa.int32(), pa.int32()]
        for batch in batches:
            out = []
            for key, text, runs in zip(*batch.columns):
                key, data = key.as_py(), text.as_py().encode()
                words, octets = data.split(), np.frombuffer(data, np.uint8)
                inside = np.concatenate([[False], (octets != 32) & ((octets < 9) | (octets > 13)), [False]])
                edges = np.flatnonzero(inside[1:] != inside[:-1])
                starts, ends = edges[::2].tolist(), edges[1::2].tolist()
                for r in runs.as_py():
                    for i in range(r["firsts"], r["lasts"] + 1):
                        digest = hashlib.md5(b" ".join(words[i:i + SPAN]), usedforsecurity=False).digest()
                        out.append((digest, key, starts[i], ends[i + SPAN - 1]))
                    if len(out) >= 1 << 16:
                        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names)
                        out = []
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names)

    texts = docs.select(class_key().alias("key"), "text").join(_small(wanted.select("key")), "key", "left_semi").groupBy("key").agg(F.first("text").alias("text"))
    return written(texts.join(wanted, "key").select("key", "text", "runs").mapInArrow(run, "digest binary, key binary, from int, to int"), "passages-windows")


def passages(docs: DataFrame) -> DataFrame:
    """(key, spans): of each class of texts the bytes of passages of at least `SPAN` words that start anywhere else too.

    All occurrences, in the same document or another; texts of more than 50 words that are equal as a whole go entirely.
    Spans are maximal and in order. Stored.
    """
    every = _described(docs)
    windows = _windows(docs, _candidates(every))
    place = F.xxhash64("key", "from")
    shared = written(windows.groupBy("digest").agg(F.min(place).alias("one"), F.max(place).alias("other")).where("one <> other").select("digest"), "passages-shared")
    runs = windows.join(_small(shared), "digest", "left_semi").groupBy("key").agg(F.sort_array(F.collect_list(F.struct("from", "to"))).alias("spans"))

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                some = batch.slice(start, 500)
                spans = pa.array([_cut(b"", x.as_py())[0] for x in some.column(1)], SPANS)
                yield pa.RecordBatch.from_arrays([some.column(0), spans], ["key", "spans"])

    listed = runs.mapInArrow(merged, f"key binary, spans {SHAPE}")
    copies = every.groupBy("key").agg(F.count("*").alias("rows"), F.min("n_bytes").alias("size"), F.min("n_words").alias("words"))
    whole = copies.where((F.col("rows") > 1) & (F.col("words") >= SPAN)).select(
        "key", F.array(F.struct(F.lit(0).alias("from"), F.col("size").cast("int").alias("to"))).cast(SHAPE).alias("spans"))
    return written(listed.join(whole, "key", "left_anti").unionByName(whole), "passages-spans")
