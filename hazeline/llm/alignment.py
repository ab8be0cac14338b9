"""Alignment of two tokenizers over a corpus: which tokens overlap, and how many documents link each pair of ids.

1. A task encodes whole texts with both tokenizers, chunk by chunk. Each stretch between neighbouring token ends is one
   link of a token of A with one of B. The records (pair, document, times) of a chunk are sorted by A id, then B id, and
   stored as runs compressed with zstd, one for each radix of the A id: a head with the distinct pairs and their numbers
   of documents, and a body with the documents.
2. Heads of a radix are merged k ways, block by block, a heap telling whose block ends first; this counts each pair.
   Runs of a large radix are dealt to several tasks by chunk, and their counts are merged once more.
3. Counts come out in the order of A ids, so the highest count of an A id is known when its last pair is. Each task then
   holds the counts of one radix and streams its runs past them; for each chunk it sends the sums of its documents.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeline.llm.bpe import PRETOKEN, byte_letters
from hazeline.llm.runs import blocks, head_of, merged, packed, unpacked
from hazeline.session import written

CHUNK_BYTES = 4 << 20  # of text, whose links a task sorts at once
CHUNK_DOCS = 20_000
RADIX = 64
BEST_PAIRS = 1 << 15  # of a block of final counts, at least
SHARE_BYTES = 32 << 20  # of runs, about, that one task takes
SPAN = 1 << 20  # ids of B, and documents of a chunk, stay below


class ByteVocabulary:
    """A byte-level vocabulary file whose ids are in the order of its merges; texts are encoded by their merge ranks."""

    def __init__(self, file: bytes):
        spec = json.loads(file)
        letters, added = byte_letters(), {x["content"] for x in spec["added_tokens"]}
        ranks = {bytes(letters[c] for c in k): v for k, v in spec["model"]["vocab"].items() if k not in added}
        made = [ranks[bytes(letters[c] for c in "".join(m.split(" ") if isinstance(m, str) else m))] for m in spec["model"]["merges"]]
        if any(x >= y for x, y in zip(made, made[1:])) or spec["normalizer"] is not None:
            raise ValueError("ids must be in the order of the merges, and texts must be encoded as they are")
        self.coder = tiktoken.Encoding("bytes", pat_str=PRETOKEN.pattern, mergeable_ranks=ranks, special_tokens={})
        self.spelling = _listed({v: k for k, v in ranks.items()})

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self.coder.encode_ordinary(" " + x) for x in texts]


class PieceVocabulary:
    """A sentence-piece model; it puts the blank in front itself."""

    def __init__(self, file: bytes):
        self.coder = sentencepiece.SentencePieceProcessor(model_proto=file)
        names = ((i, self.coder.id_to_piece(i)) for i in range(self.coder.get_piece_size()))
        self.spelling = _listed({i: bytes([int(x[3:-1], 16)]) if self.coder.is_byte(i) else x.replace("▁", " ").encode() for i, x in names})

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.coder.encode(texts, num_threads=1)


def _listed(spelling: dict[int, bytes]) -> list[bytes]:
    return [spelling.get(i, b"") for i in range(max(spelling) + 1)]


class Aligner:
    """Both vocabularies; made once for each Python worker."""

    def __init__(self, a: bytes, b: bytes):
        self.a, self.b = ByteVocabulary(a), PieceVocabulary(b)
        self.width_a, self.width_b = (np.array([len(x) for x in v.spelling], np.int64) for v in (self.a, self.b))
        self.most = len(self.a.spelling)
        # What a token is in a text of groups: its id, then what follows it there.
        inside = [[b"%d%s" % (i, after) for i in range(len(v.spelling)) for after in (b",", ends)] for v, ends in ((self.a, b"|"), (self.b, b";"))]
        self.said = inside[0] + inside[1]

    def tokens(self, texts: list[str]) -> list[tuple[list[int], list[int]]]:
        """Ids of both sides; none for an empty text or one that either side spells differently."""
        out = []
        for text, a, b in zip(texts, self.a.encode(texts), self.b.encode(texts)):
            bytes_ = b" " + text.encode()
            same = text and b"".join(map(self.a.spelling.__getitem__, a)) == bytes_ and b"".join(map(self.b.spelling.__getitem__, b)) == bytes_
            out.append((a, b) if same else ([], []))
        return out

    def chunk(self, tokens: list[tuple[list[int], list[int]]], shown: Callable[[bytes], object]) -> tuple[list[dict], np.ndarray, np.ndarray]:
        """Rows of the documents, and their records: sorted keys (A id, B id, document) and how often each is linked."""
        a, b = (np.fromiter((i for t in tokens for i in t[side]), np.int64) for side in (0, 1))
        size_a, size_b = (np.array([len(t[side]) for t in tokens], np.int64) for side in (0, 1))
        end_a, end_b = np.cumsum(self.width_a[a]), np.cumsum(self.width_b[b])
        last = np.concatenate([[0], end_a])[np.cumsum(size_a)]  # where each text ends; both sides end there
        ends = np.union1d(end_a, end_b)
        at_a, at_b = np.searchsorted(end_a, ends), np.searchsorted(end_b, ends)
        of = np.searchsorted(last, ends)
        common = ends[(end_a[at_a] == ends) & (end_b[at_b] == ends)]
        links, groups = np.bincount(of, minlength=len(tokens)), np.bincount(np.searchsorted(last, common), minlength=len(tokens))
        keys, times = np.unique((a[at_a] * SPAN + b[at_b]) * SPAN + of, return_counts=True)

        # Groups as text: the A tokens of a group, then its B tokens.
        group_a, group_b = np.searchsorted(common, end_a), np.searchsorted(common, end_b)
        place_a = np.arange(len(a)) + np.searchsorted(group_b, group_a)
        place_b = np.arange(len(b)) + np.searchsorted(group_a, group_b, "right")
        said = np.empty(len(a) + len(b), np.int64)
        said[place_a] = 2 * a + (np.append(group_a[1:], -1) != group_a)
        said[place_b] = 2 * (self.most + b) + (np.append(group_b[1:], -1) != group_b)
        stops = np.cumsum(size_a + size_b)
        rows = [
            {"n_a": int(na), "n_b": int(nb), "n_groups": int(g), "n_links": int(k), "groups": shown(b"".join(map(self.said.__getitem__, said[s - na - nb:s].tolist()))[:-1])}
            for na, nb, g, k, s in zip(size_a, size_b, groups, links, stops)]
        return rows, keys, times


_aligners: dict[int, Aligner] = {}


def _aligner(files: tuple[bytes, bytes]) -> Aligner:
    key = hash(files)
    if key not in _aligners:
        _aligners[key] = Aligner(*files)
    return _aligners[key]


def _runs(docs: DataFrame, a: bytes, b: bytes, shown: Callable[[bytes], object]) -> DataFrame:
    """Runs (chunk, part, head, body) and, with part -1, the documents of each chunk. Stored."""
    files = docs.sparkSession.sparkContext.broadcast((a, b))
    kind = dict(docs.dtypes)["doc_id"]
    rows_kind = f"array<struct<doc_id:{kind}, n_a:long, n_b:long, n_groups:long, n_links:long, groups:string>>"
    schema = f"chunk long, part int, head array<binary>, body binary, docs {rows_kind}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, chunk = _aligner(files.value), TaskContext.get().partitionId() << 32
        ids: list = []
        tokens: list = []
        texts: list[str] = []
        held = waiting = 0

        def encode() -> None:
            tokens.extend((np.array(x, np.int32), np.array(y, np.int32)) for x, y in aligner.tokens(texts))
            texts.clear()

        def sent(chunk: int) -> Iterator[pa.RecordBatch]:
            rows, keys, times = aligner.chunk(tokens, shown)
            listed = pa.array([{"doc_id": i, **r} for i, r in zip(ids, rows)], kind_of)
            yield pa.RecordBatch.from_arrays(
                [pa.array([chunk]), pa.array([-1], pa.int32()), pa.array([None], pa.list_(pa.binary())), pa.array([None], pa.binary()), pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), listed)], names)
            part = (keys // (SPAN * SPAN)) % RADIX
            for p in np.unique(part):
                here, often = keys[part == p], times[part == p]
                pairs, counts = np.unique(here // SPAN, return_counts=True)
                body = packed((here % SPAN).astype(np.uint32), often.astype(np.uint32))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk]), pa.array([p], pa.int32()), pa.array([head_of(pairs, counts)], pa.list_(pa.binary())), pa.array([body], pa.binary()), pa.array([None], pa.list_(kind_of))], names)

        names = ["chunk", "part", "head", "body", "docs"]
        kind_of = None
        for batch in batches:
            if kind_of is None:
                kind_of = pa.struct([("doc_id", batch.schema.field(0).type), *((c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")), ("groups", pa.string())])
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                ids.append(doc_id.as_py())
                texts.append(text.as_py() or "")
                waiting += len(texts[-1])
                held += len(texts[-1])
                if waiting >= 1 << 18:
                    encode()
                    waiting = 0
                if held >= CHUNK_BYTES or len(ids) >= CHUNK_DOCS:
                    encode()
                    yield from sent(chunk)
                    chunk += 1
                    held = waiting = 0
                    ids.clear()
                    tokens.clear()
        encode()
        if ids:
            yield from sent(chunk)

    return written(docs.select("doc_id", "text").mapInArrow(run, schema), "align-runs")


def _counts(runs: DataFrame, shares: DataFrame) -> DataFrame:
    """(part, block, pairs, counts, best): the pairs of each part in order, how many documents link them, and whether
    that is the highest count of their A id. Stored."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, Iterator]]:
        held: list = []
        now = None
        for batch in batches:
            for *key, head in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns))):
                if now is not None and key != now:
                    yield now, merged(held)
                    held = []
                now = key
                held.append(head)
        if now is not None:
            yield now, merged(held)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (part, _), found in merge(batches):
            head = [x for p, c in found for x in head_of(p, c)]
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([head], pa.list_(pa.binary()))], ["part", "head"])

    def final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (part,), found in merge(batches):
            number, pairs, counts = 0, np.zeros(0, np.int64), np.zeros(0, np.int64)
            for p, c in chain(found, [(None, None)]):
                done = len(pairs)
                if p is not None:
                    pairs, counts = np.concatenate([pairs, p]), np.concatenate([counts, c])
                    done = int(np.searchsorted(pairs, pairs[-1] // SPAN * SPAN))  # the last A id may go on
                    if done < BEST_PAIRS:
                        continue
                if done:
                    starts = np.flatnonzero(np.diff(pairs[:done] // SPAN, prepend=-1))
                    most = np.repeat(np.maximum.reduceat(counts[:done], starts), np.diff(np.append(starts, done)))
                    blob = packed(pairs[:done], counts[:done], (counts[:done] == most).astype(np.uint8))
                    yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([blob], pa.binary())], ["part", "block", "counts"])
                    number, pairs, counts = number + 1, pairs[done:], counts[done:]

    heads = runs.where("part >= 0").join(F.broadcast(shares), "part").select("part", F.pmod("chunk", "shares").alias("share"), "head")
    once = heads.repartition("part", "share").sortWithinPartitions("part", "share").mapInArrow(partial, "part int, head array<binary>")
    twice = once.repartition("part").sortWithinPartitions("part").mapInArrow(final, "part int, block int, counts binary")
    return written(twice, "align-counts")


def _contributions(runs: DataFrame, counts: DataFrame, shares: DataFrame) -> DataFrame:
    """(chunk, sums): what the links of each part add to the documents of each chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, known, table = None, [], None
        for batch in batches:
            for part, share, chunk, head, body, block in zip(*(batch.column(i) for i in range(6))):
                key = part.as_py(), share.as_py()
                if key != now:
                    now, known, table = key, [], None
                if block.as_py() is not None:  # counts come first
                    known.append(unpacked(body.as_py(), np.int64, np.int64, np.uint8))
                    continue
                if table is None:
                    table = [np.concatenate([k[i] for k in known]) for i in range(3)]
                pairs, often = (np.concatenate(x) for x in zip(*blocks(head.as_py())))
                doc, times = unpacked(body.as_py(), np.uint32, np.uint32)
                at = np.repeat(np.searchsorted(table[0], pairs), often)
                docs, place = np.unique(doc, return_inverse=True)
                total = np.zeros(len(docs), np.int64)
                np.add.at(total, place, times * table[1][at])
                best = np.bincount(place, times * table[2][at], len(docs)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([chunk_of(chunk), pa.array([packed(docs.astype(np.uint32), total, best)], pa.binary())], ["chunk", "sums"])

    def chunk_of(chunk: pa.Scalar) -> pa.Array:
        return pa.array([chunk.as_py()], pa.int64())

    dealt = runs.where("part >= 0").join(F.broadcast(shares), "part")
    ours = dealt.select("part", F.pmod("chunk", "shares").cast("int").alias("share"), "chunk", "head", "body", F.lit(None).cast("int").alias("block"))
    theirs = counts.join(F.broadcast(shares), "part").withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares").cast("int") - 1)))
    theirs = theirs.select("part", "share", F.lit(-1).cast("long").alias("chunk"), F.lit(None).cast("array<binary>").alias("head"), F.col("counts").alias("body"), "block")
    rows = ours.unionByName(theirs).repartition("part", "share").sortWithinPartitions("part", "share", "chunk", "block")
    return rows.mapInArrow(run, "chunk long, sums binary")


def alignment(docs: DataFrame, a_path: str, b_path: str, shown: Callable[[bytes], object] = bytes.decode) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups) of each document.

    Tokens of A (a byte-level vocabulary, for a blank and the text) and of B (a piece model, which puts that blank in
    front itself) are linked where their bytes overlap. The count of a pair of ids is the number of documents that link
    it. `n_best`: links whose count is the highest of their A id; `count_sum`: the counts of all links, summed.
    `groups` cuts the tokens wherever both sides end: `a1,a2|b1;a3|b2,b3`; `shown` makes of that text what is to be kept,
    since it is some five times as long as the document.

    Only doc_id and text are looked at. Null and empty texts, and texts that either side doesn't spell byte by byte, have
    no tokens: zeros, and the empty text as groups, whatever `shown` makes of texts. Strings of special tokens are plain
    text. Rows count one by one: repeated rows, or rows with a null doc_id, are documents of their own. An empty table
    gives no rows. Both files are read by the driver; they have a fixed size.
    """
    files = [open(p, "rb").read() for p in (a_path, b_path)]
    runs = _runs(docs, *files, lambda said: shown(said) if said else "")
    sizes = runs.where("part >= 0").groupBy("part").agg(F.sum(F.octet_length("body")).alias("bytes"))
    shares = written(sizes.select("part", F.ceil(F.col("bytes") / SHARE_BYTES).cast("long").alias("shares")), "align-shares")
    counts = _counts(runs, shares)
    kind = dict(docs.dtypes)["doc_id"]

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = best = total = now = None

        def sent() -> pa.RecordBatch:
            flat = rows.values.slice(*_bounds(rows))
            return pa.RecordBatch.from_arrays([*flat.flatten(), pa.array(best), pa.array(total)], [f.name for f in flat.type] + ["n_best", "count_sum"])

        for batch in batches:
            for i, (chunk, sums) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2))):
                if chunk != now:
                    if rows is not None:
                        yield sent()
                    now, rows = chunk, batch.column(1).slice(i, 1)  # the documents come first
                    best, total = (np.zeros(len(rows[0]), np.int64) for _ in range(2))
                else:
                    doc, more, top = unpacked(sums.as_py(), np.uint32, np.int64, np.int64)
                    total[doc] += more
                    best[doc] += top
        if rows is not None:
            yield sent()

    chunks = runs.where("part = -1").select("chunk", "docs", F.lit(None).cast("binary").alias("sums"))
    added = _contributions(runs, counts, shares).select("chunk", F.lit(None).cast(chunks.schema["docs"].dataType).alias("docs"), "sums")
    rows = chunks.unionByName(added).repartition("chunk").sortWithinPartitions("chunk", F.col("sums").isNotNull())
    return rows.mapInArrow(summed, f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups string, n_best long, count_sum long")


def _bounds(rows: pa.ListArray) -> tuple[int, int]:
    return rows.offsets[0].as_py(), len(rows[0])
