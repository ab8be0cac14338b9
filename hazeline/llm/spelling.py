"""Spelling variants of frequent words: all pairs one edit apart, found by blocked Gram matrices of letter counts.

1. Runs of letters are counted in each task, then summed.
2. One edit leaves the first or the second half of the shorter word as it is. So each word is dealt to four groups: by
   its first and its last half as the shorter word, and by the same parts of one letter less as the longer one. A group
   holds words of two adjacent lengths that share that half.
3. Groups are packed into blocks of some hundred words, large groups cut into several; a product of letter counts gives
   the squared distances of all words of a block. One edit changes them by at most two; such pairs are verified.
4. A task sends for each word its number of near words and the best of them, not the pairs.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeline.session import written

RUN = re.compile("[a-zA-ZÀ-ÿ]+")
LEAST_LETTERS = 6
LEAST_TIMES = 5
RATIO = 5
DAMAGED = 199  # a run whose hash this divides loses a letter

HELD_WORDS = 200_000  # distinct words that a task holds before it sends them
BLOCK = 512  # words of a Gram matrix
BLOCK_LETTERS = 1 << 20  # letters of the words of one block, but for a single longer word
LETTERS = np.concatenate([np.arange(0x61, 0x7B), np.arange(0xC0, 0x100)])


def runs(doc_id: int | None, text: str | None) -> Counter[str]:
    """How often each run stands in a text, A-Z in lower case, damaged runs without one letter."""
    found = Counter(RUN.findall(text.encode().lower().decode())) if text else Counter()
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    out: Counter[str] = Counter()
    for run, n in found.items():
        h = zlib.crc32(run.encode(), start)
        if h % DAMAGED == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
        if len(run) >= LEAST_LETTERS:
            out[run] += n
    return out


def frequent_words(docs: DataFrame) -> DataFrame:
    """(word, n): words of at least six letters that occur five times or more in all texts together. Stored."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def sent() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):  # one text at a time
                held.update(runs(doc_id.as_py(), text.as_py()))
                if len(held) >= HELD_WORDS:
                    yield sent()
                    held = Counter()
        yield sent()

    counted = docs.select("doc_id", "text").mapInArrow(count, "word string, n long")
    return written(counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_TIMES), "spelling-words")


def _halves(words: DataFrame) -> DataFrame:
    """(key, word, n, longer): each word in its four groups. A key is the shorter length, the side and the shared half."""
    size = F.char_length("word")

    def place(longer: bool) -> list:
        base = size - 1 if longer else size
        half = F.floor(base / 2).cast("int")
        first = F.substring(F.col("word"), F.lit(1), half)
        last = F.substring(F.col("word"), size - (base - half) + 1, base - half)
        return [F.struct(F.concat(base.cast("string"), F.lit(side), part).alias("key"), F.lit(longer).alias("longer")) for side, part in (("<", first), (">", last))]

    # The shorter length is at least LEAST_LETTERS: words have no partners below that.
    groups = F.filter(F.array(*place(False), *place(True)), lambda g: (~g["longer"]) | (size > LEAST_LETTERS))
    return words.select("word", "n", F.explode(groups).alias("g")).select("g.key", "word", "n", "g.longer")


def _cut(grouped: DataFrame) -> DataFrame:
    """(key, part, own, word, n, longer): groups of more than a block are cut into pieces; each pair of pieces is a part.

    `own` is the piece of the word; within a part of two different pieces only words of different pieces are compared.
    """
    sizes = grouped.groupBy("key").agg(F.count("*").alias("size"), F.sum(F.char_length("word")).alias("letters"))
    pieces = F.greatest(F.ceil(F.col("size") * 2 / BLOCK), F.ceil(F.col("letters") * 2 / BLOCK_LETTERS))
    large = sizes.withColumn("pieces", pieces.cast("int")).where("pieces > 1").select("key", "pieces")
    rows = grouped.join(large, "key", "left").withColumn("own", F.when(F.col("pieces").isNotNull(), F.pmod(F.xxhash64("word"), "pieces").cast("int")).otherwise(0))
    pairs = F.transform(
        F.sequence(F.lit(0), F.coalesce("pieces", F.lit(1)) - 1),
        lambda other: F.least("own", other).cast("long") * F.lit(1 << 31) + F.greatest("own", other))
    return rows.select("key", F.explode(pairs).alias("part"), "own", "word", "n", "longer")


def _spelled(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letters of each word, one row each, 0 behind its end; and the lengths."""
    data = [w.encode("latin-1") for w in words]
    size = np.fromiter(map(len, data), np.int64, len(data))
    width = int(size.max())
    return np.frombuffer(b"".join(x.ljust(width, b"\0") for x in data), np.uint8).reshape(len(data), width), size


def _close(spelled: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Squared distances of the letter counts of all words, from one product."""
    kind = np.float32 if spelled.shape[1] <= 2048 else np.float64  # whole numbers stay exact
    where = np.zeros(256, np.int64)
    where[LETTERS] = np.arange(1, len(LETTERS) + 1)
    flat = where[spelled] + np.arange(len(size))[:, None] * (len(LETTERS) + 1)
    counts = np.bincount(flat.ravel(), minlength=len(size) * (len(LETTERS) + 1)).reshape(len(size), -1)[:, 1:].astype(kind)
    square = (counts * counts).sum(axis=1)
    return square[:, None] + square[None, :] - 2 * (counts @ counts.T)


def _one_edit(spelled: np.ndarray, size: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether words a (not longer) and b are one edit apart; lengths differ by at most one."""
    x, y = spelled[a], spelled[b]
    same = size[a] == size[b]
    replaced = same & ((x != y).sum(axis=1) == 1)
    inside = np.arange(x.shape[1] - 1)[None, :] < size[a][:, None] if x.shape[1] > 1 else np.zeros((len(a), 0), bool)
    ahead = ((x == y)[:, :-1] & inside).cumprod(axis=1).sum(axis=1)  # letters equal from the start
    behind = (((x[:, :-1] == y[:, 1:]) | ~inside)[:, ::-1].cumprod(axis=1) * inside[:, ::-1]).sum(axis=1)  # and from the end
    return replaced | (~same & (ahead + behind >= size[a]))


def near_in_block(words: list[str], longer: np.ndarray, group: np.ndarray, own: np.ndarray, crossing: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of near words of a block, each pair of the whole vocabulary in just one group.

    `group`: number of the part; `crossing`: whether it holds two pieces; `first`: whether its words share the first half.
    """
    spelled, size = _spelled(words)
    fits = _close(spelled, size) <= 2
    fits &= group[:, None] == group[None, :]
    a, b = np.nonzero(fits)
    keep = ~longer[a] & ((a < b) | longer[b]) & ~(crossing[a] & (own[a] == own[b]))
    a, b = a[keep], b[keep]
    near = _one_edit(spelled, size, a, b) if len(a) else np.zeros(0, bool)
    a, b = a[near], b[near]
    # Words that also share their first half meet in that group.
    half = size[a] // 2
    inside = np.arange(spelled.shape[1])[None, :] < half[:, None]
    again = ~first[a] & (((spelled[a] == spelled[b]) | ~inside).all(axis=1) if len(a) else np.zeros(0, bool))
    return a[~again], b[~again]


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best): of each word with near words their number, and the best as (-n, word)."""

    def found(rows: list[dict[str, list]]) -> pa.RecordBatch:
        cat = lambda c: [x for r in rows for x in r[c]]
        text, n = cat("word"), np.array(cat("n"), np.int64)
        longer, own = np.array(cat("longer"), bool), np.array(cat("own"), np.int64)
        group = np.repeat(np.arange(len(rows)), [len(r["word"]) for r in rows])
        crossing = np.array([r["part"] >> 31 != r["part"] & ((1 << 31) - 1) for r in rows], bool)[group]
        first = np.array(["<" in r["key"] for r in rows], bool)[group]
        a, b = near_in_block(text, longer, group, own, crossing, first)
        one, other = np.concatenate([a, b]), np.concatenate([b, a])
        by = sorted(range(len(one)), key=lambda i: (text[one[i]], -n[other[i]], text[other[i]]))
        out: dict[str, list] = {}
        for i in by:
            if text[one[i]] in out:
                out[text[one[i]]][0] += 1
            else:
                out[text[one[i]]] = [1, int(n[other[i]]), text[other[i]]]
        return pa.RecordBatch.from_arrays(
            [pa.array(out.keys(), pa.string()), *(pa.array([x[i] for x in out.values()], kind) for i, kind in ((0, pa.int64()), (1, pa.int64()), (2, pa.string())))],
            ["word", "n_near", "best_n", "best"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[dict] = []  # whole parts, and the one that is still read
        held = letters = 0
        for batch in batches:
            for key, part, own, word, n, longer in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if not waiting or waiting[-1]["key"] != key or waiting[-1]["part"] != part:
                    if held >= BLOCK or letters >= BLOCK_LETTERS:
                        if any(len(r["word"]) > 1 for r in waiting):
                            yield found(waiting)
                        waiting, held, letters = [], 0, 0
                    elif waiting and len(waiting[-1]["word"]) == 1:  # a word alone has no partner
                        held, letters = held - 1, letters - len(waiting.pop()["word"][0])
                    waiting.append({"key": key, "part": part, "own": [], "word": [], "n": [], "longer": []})
                for c, x in (("own", own), ("word", word), ("n", n), ("longer", longer)):
                    waiting[-1][c].append(x)
                held, letters = held + 1, letters + len(word)
        if any(len(r["word"]) > 1 for r in waiting):
            yield found(waiting)

    rows = _cut(_halves(words)).repartition("key", "part").sortWithinPartitions("key", "part")
    sent = rows.mapInArrow(run, "word string, n_near long, best_n long, best string")
    order = F.struct((-F.col("best_n")).alias("first"), F.col("best").alias("word"))
    return sent.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(order).alias("best"))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words with a form. Each round follows twice as many forms; counts rise fivefold with each form,
    so the rounds are few."""
    reached, more = written(forms.select("word", F.col("form").alias("root")), "spelling-roots"), True
    while more:
        further = reached.select(F.col("word").alias("at"), F.col("root").alias("to"))
        stepped = reached.join(further, reached.root == further["at"], "left")
        reached = written(stepped.select("word", F.coalesce("to", "root").alias("root"), F.col("to").isNotNull().alias("moved")), "spelling-roots")
        more = not reached.where("moved").isEmpty()
        reached = reached.select("word", "root")
    return reached


def variants(docs: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of each frequent word of the texts.

    A word is a run of letters (A-Z, a-z, U+00C0 to U+00FF, A-Z in lower case) of at least six, found at least five
    times. Near words differ by one inserted, deleted or replaced letter. `form` is the most frequent near word (ties:
    the first by code point) if it is at least five times as frequent, else null; `root` follows forms to the last.

    Only doc_id and text are looked at. Null, empty or letterless texts have no words; a null doc_id counts as an empty
    one when the id of a run is hashed; repeated rows count again; an empty table gives no words. No word, pair or group
    is left out, whatever its size: a group beyond a block is cut into pieces, all pairs of which are compared.
    """
    words = frequent_words(docs)
    near = words.join(near_words(words), "word", "left")
    is_form = F.col("best").isNotNull() & (-F.col("best.first") >= RATIO * F.col("n"))
    rows = near.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(is_form, F.col("best.word")).alias("form"), F.when(is_form, -F.col("best.first")).alias("form_n"))
    rows = written(rows, "spelling-forms")
    roots = _roots(rows.where("form is not null").select("word", "form"))
    return rows.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
