"""A hierarchical Pitman-Yor language model whose seating is sampled by Gibbs, at the scale of a corpus.

The restaurant of a word seats, for each word that follows it, the customers of that pair at one or more tables; each
table is a customer of the one restaurant of single words, the parent that all share, whose own parent is uniform over
the words of the learned texts and one more for all others.

1. Tasks cut texts into chunks, number their words, and send each word once with its count to one of several parts, which
   count words and give them numbers for the whole corpus.
2. Pairs of words go, sorted and compressed, to parts by their first word. Words that are followed very often are dealt
   to several parts. A part merges its runs and knows how often each pair stands in learned texts.
3. Rounds of Gibbs sampling: parts tell the parent how many tables serve each word, the parent seats these customers and
   answers, and each part takes customers of its pairs from their tables and seats them anew, one at a time for each
   pair, given the parent's probabilities and the tables of their restaurant.
4. After the first rounds each round is a sample. Chunks ask for what their words and pairs have in all samples, average
   the predictive probabilities, and sum up the texts.

Pairs of one customer have one table always, so only their number is kept. Random numbers depend on part and round only:
a task that runs again does the same.
"""

from __future__ import annotations

import random
from collections import defaultdict
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from hazeline.llm.mailbox import dealt, mail, narrow, returned, row, sent, totals
from hazeline.llm.runs import blocks, head_of, merged, packed, unpacked
from hazeline.session import written

CHUNK_TOKENS = 1 << 21
CHUNK_DOCS = 50_000
PART_BYTES = 24 << 20  # of text, about, for each part of words and of pairs
FEW = 32  # dishes that are seated one after the other, since arrays of so few are slower
STEP = 200  # moves of one dish that take as long as a step of so few dishes side by side
HOT = 1 << 20  # customers of a restaurant for each part that it is dealt to
BURN_IN, SAMPLES = 1, 3
STRENGTH = (1.0, 1.0)  # of the parent and of the words' restaurants
FIRST_DISCOUNT = 0.5  # of the parent, before the first round has shown its customers
ADDED = 0.1  # to each count of the base score

BODY, WORDS, NUMBERS, PAIRS, DISHES, SINGLES, TABLES, COUNTS, SOUGHT, SEATS, PARENT, ANSWERS, CONTEXTS, AT_WORDS, AT_PAIRS = range(15)
END, START = (np.uint64(xxhash.xxh3_64_intdigest(x)).astype(np.int64) for x in (b"\n end", b"\n start"))  # no words: they hold white space
MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[bytes]:
    return text.encode().lower().split() if text else []


def _part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    x = keys.astype(np.uint64) * MIX
    return ((x ^ (x >> np.uint64(31))) % np.uint64(parts)).astype(np.int64)


# ---- seating -------------------------------------------------------------------------------------------------------


def reseat(sizes: np.ndarray, tables: np.ndarray, customers: np.ndarray, base: np.ndarray, room: np.ndarray, total: np.ndarray, scale: np.ndarray, strength: float, discount: float, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """One round of Gibbs sampling of all dishes; returns sizes and tables, and changes `total`.

    `sizes` lists the tables of each dish in turn, `tables` their numbers. `base` is the parent's probability of the dish,
    `room` the restaurant of each dish, `total` the tables of a restaurant, `scale` what `total` stands for if the
    restaurant is dealt to several parts. A dish makes as many moves as it has customers, each of one drawn at random; one
    move is enough for two customers, since the seat of the other doesn't matter. A customer who sits down at the old table
    again changes nothing: how many of these moves come before the next change is drawn at once. In each step all dishes
    that still have moves to make come to their next change; the last few make the rest one dish after the other, unless
    nearly all of their moves change nothing.
    """
    moves = np.where(customers <= 2, customers - 1, customers).astype(np.int64)
    at, still = np.flatnonzero(moves > 0), np.flatnonzero(moves <= 0)
    starts = np.cumsum(tables) - tables
    out: list[tuple] = [(still, tables[still], sizes[_within(starts[still], tables[still])])]
    size, live = sizes[_within(starts[at], tables[at])].astype(np.int64), tables[at].astype(np.int64)
    width, left = live.copy(), moves[at]
    c, p, r, k = customers[at].astype(np.float64), base[at], room[at], scale[at]
    first = np.cumsum(width) - width
    squares, single = (np.add.reduceat(x, first) if len(at) else x for x in (np.square(size, dtype=np.float64), (size == 1).astype(np.int64)))
    step = 0
    while True:
        going = left > 0
        n = int(np.count_nonzero(going))
        if step % 16 == 0 or n <= FEW or n < 0.9 * len(at):
            kept, some = np.repeat(going, width), size > 0
            if n < len(at):
                out.append((at[~going], live[~going], size[some & ~kept]))
            size = size[some & kept]
            at, left, c, p, r, k, live, squares, single = (x[going] for x in (at, left, c, p, r, k, live, squares, single))
            width = live.copy()
            first = np.cumsum(width) - width
        step += 1
        weight = np.where(single < live, (strength + discount * total[r] * k) * p + c - 1 - discount * live, 1.0)
        change = np.clip(1 - (squares - (1 + discount) * c + discount * single) / (c * weight), 1e-300, 1 - 1e-16)  # of tables of one none comes back
        if n <= FEW and left.sum() <= STEP * (left * change).max(initial=0):
            break
        idle = np.minimum(np.log1p(-rng.random(len(at))) / np.log1p(-change), left).astype(np.int64)
        moved = np.flatnonzero(idle < left)
        left -= np.minimum(idle + 1, left)
        if not len(moved):
            continue
        leave = np.where(size > 1, size - 1 - discount, 0.0) * np.repeat(1 / weight, width)
        leave = size * (1 - leave) * np.repeat(1 / (c * change), width)
        taken = _drawn(leave, first, width, moved, rng)
        old = size[taken]
        if not old.all():  # an empty place, by rounding
            moved, taken, old = moved[old > 0], taken[old > 0], old[old > 0]
        size[taken] -= 1
        gone = old == 1
        live[moved] -= gone
        fresh = (strength + discount * (total[r[moved]] - gone) * k[moved]) * p[moved]  # other dishes as before the step
        stay = c[moved] - 1 - discount * live[moved] - np.where(gone, 0.0, old - 1 - discount)
        new = rng.random(len(moved)) * (fresh + stay) < fresh
        squares[moved] -= 2 * old - 1
        single[moved] += (old == 2).astype(np.int64) - gone
        if not new.all():
            others = np.where(size > 0, size - discount, 0.0)
            others[taken] = 0
            join = np.flatnonzero(~new)
            joined = _drawn(others, first, width, moved[join], rng)
            fits = others[joined] > 0
            new[join[~fits]] = True
            join, joined = join[fits], joined[fits]
            squares[moved[join]] += 2 * size[joined] + 1
            single[moved[join]] -= size[joined] == 1
            size[joined] += 1
        opened = moved[new]
        live[opened] += 1
        squares[opened] += 1
        single[opened] += 1
        np.add.at(total, r[moved], new.astype(np.int64) - gone)
        size[taken[new & gone]] = 1
        more = moved[new & ~gone]
        if len(more):
            size = np.insert(size, (first + width)[more], 1)
            width[more] += 1
            first = np.cumsum(width) - width
    ends = np.cumsum(live)
    for i in range(len(at)):
        own, total[r[i]] = _moved(size[ends[i] - live[i]:ends[i]], int(left[i]), float(p[i]), int(total[r[i]]), float(k[i]), strength, discount, rng)
        out.append((at[i:i + 1], np.array([len(own)]), own))
    tables = np.zeros(len(customers), np.int64)
    for at, live, _ in out:
        tables[at] = live
    starts = np.cumsum(tables) - tables
    sizes = np.zeros(int(tables.sum()), np.int64)
    for at, live, size in out:
        sizes[_within(starts[at], live)] = size
    return sizes, tables


def _drawn(weights: np.ndarray, first: np.ndarray, width: np.ndarray, which: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """A place of each group in `which`, drawn by weight; groups stand one after the other."""
    ends = np.concatenate([[0.0], np.cumsum(weights)])
    low, high = ends[first[which]], ends[(first + width)[which]]
    at = np.searchsorted(ends, low + rng.random(len(which)) * (high - low), "right") - 1
    return np.clip(at, first[which], (first + width)[which] - 1)


def _within(starts: np.ndarray, n: np.ndarray) -> np.ndarray:
    """`n` numbers from each start."""
    return np.repeat(starts - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


def _moved(sizes: np.ndarray, moves: int, base: float, total: int, scale: float, strength: float, discount: float, rng: np.random.Generator) -> tuple[np.ndarray, int]:
    """Tables of one dish of many customers after `moves` moves, and the tables of its restaurant.

    A customer joins the table of another one drawn at random, which is as likely as the table is large, and draws again
    if the discount wants it.
    """
    seat, size, live, c = np.repeat(np.arange(len(sizes)), sizes).tolist(), sizes.tolist(), len(sizes), int(sizes.sum())
    draw = random.Random(int(rng.integers(1 << 62))).random
    for _ in range(moves):
        who = int(draw() * c)
        old = seat[who]
        size[old] -= 1
        gone = not size[old]
        if gone:
            live -= 1
            total -= 1
        fresh = (strength + discount * total * scale) * base
        if draw() * (fresh + c - 1 - discount * live) < fresh:
            live += 1
            total += 1
            if gone:
                size[old] = 1
            else:
                seat[who] = len(size)
                size.append(1)
            continue
        other = who
        while other == who or draw() * size[seat[other]] < discount:
            other = int(draw() * c)
        seat[who] = old = seat[other]
        size[old] += 1
    found = np.array(size, np.int64)
    return found[found > 0], total


def discount_of(once: int, twice: int) -> float:
    """The share of a customer that each table gives away, from the dishes with one and with two customers."""
    return min(0.95, max(0.05, once / (once + 2 * twice))) if once else 0.5


def seated(customers: np.ndarray, uniform: float, discount: float, seed: tuple[int, ...], known: int) -> np.ndarray:
    """Tables of each word in the parent's restaurant, seated anew since its customers have changed."""
    tables = np.zeros(len(customers), np.int64)
    some = np.flatnonzero(customers >= 2)
    tables[customers == 1] = 1
    if len(some):
        c = customers[some]
        # All words have about one table, so the tables of the whole restaurant are taken as their number.
        total = np.array([known], np.int64)
        _, t = reseat(c.copy(), np.ones(len(c), np.int64), c, np.full(len(c), uniform), np.zeros(len(c), np.int64), total, np.ones(len(c)), STRENGTH[0], discount, np.random.default_rng(seed))
        tables[some] = t
    return tables


# ---- the stages ----------------------------------------------------------------------------------------------------


def _chunks(docs: DataFrame, parts: int) -> DataFrame:
    """The words of each chunk for their parts, and its body for itself. Stored."""
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        place: defaultdict[bytes, int] = defaultdict()
        place.default_factory = place.__len__
        ids, held_out, tokens, held = [], [], [], 0

        def ready(chunk: int) -> Iterator[pa.RecordBatch]:
            words = np.fromiter(map(xxhash.xxh3_64_intdigest, place), np.uint64, len(place)).view(np.int64)
            words = np.append(words, [END, START])
            size = np.array([len(t) + 1 for t in tokens], np.int64)
            stream = np.full(int(size.sum()), len(place), np.int64)  # ends where nothing else is put
            last = np.cumsum(size) - 1
            inside = np.ones(len(stream), bool)
            inside[last] = False
            stream[inside] = np.concatenate(tokens) if tokens else 0
            learned = np.repeat(~np.array(held_out, bool), size)
            part = _part_of(words, parts)
            by = np.lexsort((words, part))
            times, all_times = (np.bincount(stream[x], minlength=len(words))[by] for x in (learned, slice(None)))
            words, part = words[by], part[by]
            back = np.empty(len(by), np.int64)
            back[by] = np.arange(len(by))
            rank = np.empty(len(by), np.int64)
            rank[np.argsort(-all_times, kind="stable")] = np.arange(len(by))
            code = rank[back][stream]
            body = packed((code & 255).astype(np.uint8), (code >> 8 & 255).astype(np.uint8), (code >> 16).astype(np.uint16), all_times.astype(np.uint32), size.astype(np.uint32), np.array(held_out, np.uint8))
            docs_at = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), pa.array(ids, arrow_kind))
            yield pa.RecordBatch.from_arrays(
                [pa.array([chunk]), pa.array([BODY], pa.int32()), pa.array([chunk]), pa.array([[body]], pa.list_(pa.binary())), pa.array([[]], pa.list_(pa.int64())), docs_at], names)
            cut = np.searchsorted(part, np.arange(parts + 1))
            for p in range(parts):
                if cut[p] < cut[p + 1]:
                    run_ = head_of(words[cut[p]:cut[p + 1]], times[cut[p]:cut[p + 1]])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([p], pa.int64()), pa.array([WORDS], pa.int32()), pa.array([chunk]), pa.array([run_], pa.list_(pa.binary())), pa.array([[]], pa.list_(pa.int64())), pa.array([None], pa.list_(arrow_kind))], names)

        names, arrow_kind = ["to", "kind", "sender", "data", "s", "docs"], None
        for batch in batches:
            arrow_kind = batch.schema.field(0).type
            for doc_id, text, out in zip(batch.column(0), batch.column(1), batch.column(2)):
                words = words_of(text.as_py())
                ids.append(doc_id.as_py())
                held_out.append(out.as_py())
                tokens.append(np.array(list(map(place.__getitem__, words)), np.int64))
                held += len(words) + 1
                if held >= CHUNK_TOKENS or len(ids) >= CHUNK_DOCS:
                    yield from ready(chunk)
                    chunk, held = chunk + 1, 0
                    for x in (place, ids, held_out, tokens):
                        x.clear()
        if ids:
            yield from ready(chunk)

    return written(docs.select("doc_id", "text", "held_out").mapInArrow(run, f"to long, kind int, sender long, data array<binary>, s array<long>, docs array<{kind}>"), "lm-chunks")


def _numbers(chunks: DataFrame) -> DataFrame:
    """To each chunk the number of each of its words in their part, and how often they stand in learned texts. Stored."""

    def work(part: int, rows: dict[int, list[dict]]) -> Iterator[pa.RecordBatch]:
        keys, counts = (np.concatenate(x) for x in zip(*merged([r["data"] for r in rows[WORDS]])))
        yield from sent([row(-1, PARENT, part, s=(counts.sum(), (counts > 0).sum(), len(keys)))])
        for r in rows[WORDS]:
            at = np.searchsorted(keys, np.concatenate([k for k, _ in blocks(r["data"])]))
            yield from sent([row(r["sender"], NUMBERS, part, _ranks(at), *_numbers_packed(counts[at]))])

    return dealt([mail(chunks, WORDS).drop("docs")], work, "lm-numbers")


def _ranks(x: np.ndarray) -> bytes:
    """Rising numbers, as differences."""
    return packed(np.diff(x, prepend=0).astype(np.uint32))


def _ranks_of(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked(data, np.uint32)[0].astype(np.int64))


def _numbers_packed(*arrays: np.ndarray) -> list[bytes]:
    return [np.dtype((x := narrow(a)).dtype).char.encode() + packed(x) for a in arrays]


def _numbers_of(data: bytes) -> np.ndarray:
    return unpacked(data[1:], np.dtype(data[:1].decode()))[0].astype(np.int64)


class _Chunk:
    """What a chunk knows once its words have numbers: its tokens as pairs, and the pairs in the order in which they were
    sent to their parts."""

    def __init__(self, body: bytes, numbers: list[dict], parts: int):
        low, middle, high, all_times, size, held_out = unpacked(body, np.uint8, np.uint8, np.uint16, np.uint32, np.uint32, np.uint8)
        code = low.astype(np.int64) | middle.astype(np.int64) << 8 | high.astype(np.int64) << 16
        word = np.argsort(-all_times.astype(np.int64), kind="stable")[code]
        self.size, self.held_out = size.astype(np.int64), held_out.astype(bool)
        found = [(_ranks_of(n["data"][0]) * parts + n["sender"], _numbers_of(n["data"][1])) for n in numbers]
        self.number, self.count = (np.concatenate(x) for x in zip(*found))
        last = np.cumsum(self.size) - 1
        # The end stands last in each text; what never stands in the chunk is the start.
        end, start = int(word[last[0]]), int(np.flatnonzero(all_times == 0)[0])
        before = np.concatenate([[start], word[:-1]])
        before[np.concatenate([[0], last[:-1] + 1])] = start
        self.followed = self.count.copy()  # learned customers of the word's restaurant
        self.followed[start], self.followed[end] = self.count[end], 0
        local, self.of = np.unique(before * len(self.number) + word, return_inverse=True)
        self.u, self.w = local // len(self.number), local % len(self.number)
        self.key = self.number[self.u] << 32 | self.number[self.w]
        spread = 1 + self.followed // HOT
        piece = self.number[self.w] % spread[self.u]
        part = _part_of(self.number[self.u] << 20 ^ piece, parts)
        by = np.lexsort((self.key, part))
        back = np.empty(len(by), np.int64)
        back[by] = np.arange(len(by))
        self.u, self.w, self.key, self.part, self.of = self.u[by], self.w[by], self.key[by], part[by], back[self.of]
        self.spread, self.word = spread, word


def _pairs(chunks: DataFrame, numbers: DataFrame, parts: int) -> DataFrame:
    """The pairs of each chunk for their parts, with their learned counts. Stored."""

    def work(chunk: int, rows: dict[int, list[dict]]) -> Iterator[pa.RecordBatch]:
        x = _Chunk(rows[BODY][0]["data"][0], rows[NUMBERS], parts)
        learned = np.repeat(~x.held_out, x.size)
        times = np.bincount(x.of[learned], minlength=len(x.key))
        cut = np.searchsorted(x.part, np.arange(parts + 1))
        for p in range(parts):
            here = slice(cut[p], cut[p + 1])
            if cut[p] < cut[p + 1]:
                u = np.unique(x.u[here])
                u = u[x.spread[u] > 1]
                yield from sent([row(p, PAIRS, chunk, packed(x.number[u], x.spread[u]), *head_of(x.key[here], times[here]))])

    return dealt([mail(chunks, BODY).drop("docs"), mail(numbers, NUMBERS)], work, "lm-pairs")


def _told(words: np.ndarray, n: np.ndarray, kind: int, part: int, parts: int) -> Iterator[dict]:
    """Rows to the parts of words: numbers `n` summed by word."""
    used, at = np.unique(words, return_inverse=True)
    sums = np.bincount(at, n, len(used)).astype(np.int64)
    to = used % parts
    for p in np.unique(to):
        yield row(p, kind, part, *head_of(used[to == p] // parts, sums[to == p]))


def _dishes(pairs: DataFrame, parts: int) -> DataFrame:
    """Of each part its pairs of two and more learned customers; to each chunk the customers of its pairs. Stored."""

    def work(part: int, rows: dict[int, list[dict]]) -> Iterator[pa.RecordBatch]:
        runs = [r["data"][1:] for r in rows[PAIRS]]
        found = [(k[c > 0], c[c > 0]) for k, c in merged(runs)]
        keys, counts = (np.concatenate(x) for x in zip(*found))
        hot = [unpacked(r["data"][0], np.int64, np.int64) for r in rows[PAIRS]]
        hot_u, first = np.unique(np.concatenate([h[0] for h in hot]), return_index=True)
        spread = np.concatenate([h[1] for h in hot])[first]
        several = counts >= 2
        u, n = np.unique(keys[~several] >> 32, return_counts=True)
        yield from sent([row(part, DISHES, part, *head_of(keys[several], counts[several]), packed(u, n, hot_u, spread), s=((~several).sum(), (counts == 2).sum()))])
        low = (1 << 32) - 1
        yield from sent(_told(keys[~several] & low, np.ones(int((~several).sum())), SINGLES, part, parts))
        yield from sent(_told(keys[several] & low, np.ones(int(several.sum())), TABLES, part, parts))
        number = np.cumsum(several) - 1
        for r, run in zip(rows[PAIRS], runs):
            asked = np.concatenate([k for k, _ in blocks(run)])
            at = np.minimum(np.searchsorted(keys, asked), max(len(keys) - 1, 0))
            there = keys[at] == asked if len(keys) else np.zeros(len(asked), bool)
            c = np.where(there, counts[at], 0) if len(keys) else np.zeros(len(asked), np.int64)
            yield from sent([row(r["sender"], COUNTS, part, *_numbers_packed(c)), row(part, SOUGHT, r["sender"], _ranks(number[at[c >= 2]]) if len(keys) else _ranks(at[:0]))])

    return dealt([pairs], work, "lm-dishes")


class _Dishes:
    def __init__(self, r: dict):
        *head, rest = r["data"]
        found = list(blocks(head))
        self.key = np.concatenate([k for k, _ in found]) if found else np.zeros(0, np.int64)
        self.customers = np.concatenate([c for _, c in found]) if found else np.zeros(0, np.int64)
        single_u, single_n, hot_u, spread = unpacked(rest, np.int64, np.int64, np.int64, np.int64)
        self.words, self.word_at = np.unique(self.key & ((1 << 32) - 1), return_inverse=True)
        self.rooms, at = np.unique(np.concatenate([self.key >> 32, single_u]), return_inverse=True)
        self.room = at[:len(self.key)]
        self.singles = np.bincount(at[len(self.key):], single_n, len(self.rooms)).astype(np.int64)
        self.scale = np.ones(len(self.rooms))
        if len(hot_u) and len(self.rooms):
            near = np.minimum(np.searchsorted(hot_u, self.rooms), len(hot_u) - 1)
            self.scale = np.where(hot_u[near] == self.rooms, spread[near], 1).astype(np.float64)


def _leaf_round(dishes: DataFrame, before: DataFrame | None, parent: DataFrame, parts: int, turn: int, discount: float, base: dict) -> DataFrame:
    """One round in the restaurants of words; new seats, and their tables as customers of the parent. Stored."""

    begun = before is not None

    def work(part: int, rows: dict[int, list[dict]]) -> Iterator[pa.RecordBatch]:
        d = _Dishes(rows[DISHES][0])
        if not len(d.key):
            yield from sent([row(part, SEATS, part, *_numbers_packed(np.zeros(0, np.int64), np.zeros(0, np.int64)))])
            return
        tables, sizes = map(_numbers_of, rows[SEATS][0]["data"]) if begun else (np.ones(len(d.key), np.int64), d.customers)
        customers, served = (np.empty(len(d.words), np.int64) for _ in range(2))
        for r in rows[ANSWERS]:  # in the order in which the words were told
            mine = np.flatnonzero(d.words % parts == r["sender"])
            customers[mine], served[mine] = map(_numbers_of, r["data"])
        p = _parent_probability(customers, served, base)[d.word_at]
        total = d.singles + np.bincount(d.room, tables, len(d.rooms)).astype(np.int64)
        sizes, tables = reseat(sizes, tables, d.customers, p, d.room, total, d.scale[d.room], STRENGTH[1], discount, np.random.default_rng((part, turn)))
        yield from sent([row(part, SEATS, part, *_numbers_packed(tables, sizes))])
        yield from sent(_told(d.key & ((1 << 32) - 1), tables, TABLES, part, parts))

    parts_ = [mail(dishes, DISHES), mail(parent, ANSWERS)] + ([mail(before, SEATS)] if before is not None else [])
    return dealt(parts_, work, "lm-seats")


def _parent_round(singles: DataFrame, tables: DataFrame, parts: int, turn: int, discount: float, uniform: float, words: int) -> DataFrame:
    """The parent's customers and tables by word, and the answers to the parts that have told them. Stored."""

    def work(part: int, rows: dict[int, list[dict]]) -> Iterator[pa.RecordBatch]:
        told = [(r, list(blocks(r["data"]))) for k in (SINGLES, TABLES) for r in rows.get(k, [])]
        most = 1 + max(int(found[-1][0][-1]) for _, found in told)
        customers = np.zeros(most, np.int64)
        for _, found in told:
            for ranks, n in found:
                customers[ranks] += n
        tables = seated(customers, uniform, discount, (part, turn, 1), words)
        yield from sent([row(part, PARENT, part, *_numbers_packed(customers, tables), s=(customers.sum(), tables.sum(), (customers == 1).sum(), (customers == 2).sum()))])
        for r, found in told:
            if r["kind"] == TABLES:
                ranks = np.concatenate([k for k, _ in found])
                yield from sent([row(r["sender"], ANSWERS, part, *_numbers_packed(customers[ranks], tables[ranks]))])

    return dealt([mail(singles, SINGLES), mail(tables, TABLES)], work, "lm-parent")


def _parent_probability(customers: np.ndarray, tables: np.ndarray, base: dict) -> np.ndarray:
    spare = (STRENGTH[0] + base["discount"] * base["tables"]) * base["uniform"]
    return (customers - base["discount"] * tables + spare) / (STRENGTH[0] + base["customers"])


def _seen(dishes: DataFrame, seats: list[DataFrame], parts: int) -> DataFrame:
    """To each chunk the tables of its pairs in each sample; to the parts of words the tables of their restaurants. Stored."""

    def work(part: int, rows: dict[int, list[dict]]) -> Iterator[pa.RecordBatch]:
        d = _Dishes(rows[DISHES][0])
        tables = [_numbers_of(r["data"][0]) for r in rows[SEATS]]
        for i, t in enumerate(tables):
            total = d.singles + np.bincount(d.room, t, len(d.rooms)).astype(np.int64)
            for r in _told(d.rooms, total, CONTEXTS, part, parts):
                yield from sent([r | {"s": [i]}])
        for r in rows.get(SOUGHT, []):
            at = _ranks_of(r["data"][0])
            yield from sent([row(r["sender"], AT_PAIRS, part, *_numbers_packed(*(t[at] for t in tables)))])

    each = [mail(s, SEATS).select("to", "kind", F.lit(i).cast("long").alias("sender"), "data", "s") for i, s in enumerate(seats)]
    return dealt([mail(dishes, DISHES), mail(dishes, SOUGHT), *each], work, "lm-seen")


def _at_words(numbers: DataFrame, parents: list[DataFrame], seen: DataFrame) -> DataFrame:
    """To each chunk, for its words and each sample, customers and tables of the parent, and tables of the word's own
    restaurant. Not stored."""
    n = len(parents)

    def work(part: int, rows: dict[int, list[dict]]) -> Iterator[pa.RecordBatch]:
        asked = [(r["sender"], _ranks_of(r["data"][0])) for r in rows[NUMBERS]]
        most = 1 + max(int(x[-1]) for _, x in asked)
        held = np.zeros((n, 3, most), np.int64)
        for r in rows.get(PARENT, []):
            for i, x in enumerate(map(_numbers_of, r["data"])):
                held[r["sender"], i, :len(x)] = x
        for r in rows.get(CONTEXTS, []):
            for ranks, t in blocks(r["data"]):
                held[r["s"][0], 2, ranks] += t
        for chunk, ranks in asked:
            yield from sent([row(chunk, AT_WORDS, part, *_numbers_packed(*held[:, :, ranks].reshape(3 * n, -1)))])

    each = [mail(p, PARENT).select("to", "kind", F.lit(i).cast("long").alias("sender"), "data", "s") for i, p in enumerate(parents)]
    return dealt([returned(mail(numbers, NUMBERS)), *each, mail(seen, CONTEXTS)], work, None)


def scored(docs: DataFrame, held_out: Column, samples: int = SAMPLES, burn_in: int = BURN_IN) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of each text.

    Tokens are the words of a text, A-Z in lower case, and one end. The model learns from rows where `held_out` is false
    or null. `score` is the log10 probability of the whole text, each token's probability averaged over the samples;
    `base_score` that of single tokens with 0.1 added to each count; `n_known` counts tokens that stand in learned texts.

    Only doc_id, text and what `held_out` reads are looked at. A null or empty text is one end. Repeated rows are learned
    and scored one by one, null ids too. An empty table gives no rows; without any learned text, all tokens are equally
    unlikely. Words are known by 64 bits of a hash; a corpus may have up to 2^32 of them.
    """
    docs = docs.select("doc_id", "text", F.coalesce(held_out, F.lit(False)).alias("held_out"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, ceil(size / PART_BYTES))
    chunks = _chunks(docs, parts)
    numbers = _numbers(chunks)
    tokens, words, _ = totals(numbers, PARENT, 3)
    pairs = _pairs(chunks, numbers, parts)
    dishes = _dishes(pairs, parts)
    once, twice = totals(dishes, DISHES, 2)
    discount, own, uniform = discount_of(once, twice), FIRST_DISCOUNT, 1 / (words + 1)

    def parent_of(tables: DataFrame, turn: int) -> tuple[DataFrame, dict]:
        rows = _parent_round(dishes, tables, parts, turn, own, uniform, words)
        customers, served, single, double = totals(rows, PARENT, 4)
        return rows, {"customers": customers, "tables": served, "discount": own, "uniform": uniform, "next": discount_of(single, double)}

    parent, base = parent_of(dishes, 0)
    seats, kept = None, []
    for turn in range(burn_in + samples):
        own = base["next"]
        seats = _leaf_round(dishes, seats, parent, parts, turn, discount, base)
        parent, base = parent_of(seats, turn + 1)
        if turn >= burn_in:
            kept.append((seats, parent, base))
    seen = _seen(dishes, [k[0] for k in kept], parts)
    at_words = _at_words(numbers, [k[1] for k in kept], seen)
    bases, n = [k[2] for k in kept], len(kept)
    kind = dict(docs.dtypes)["doc_id"]

    def score(chunk: int, rows: dict[int, list[dict]]) -> Iterator[pa.RecordBatch]:
        x = _Chunk(rows[BODY][0]["data"][0], rows[NUMBERS], parts)
        at = [np.concatenate([_numbers_of(r["data"][i]) for r in rows[AT_WORDS]]) for i in range(3 * n)]
        customers = np.concatenate([_numbers_of(r["data"][0]) for r in rows[COUNTS]]).astype(np.float64)
        several = customers >= 2
        here = x.followed[x.u]
        mean = np.zeros(len(x.key))
        for i, b in enumerate(bases):
            p = _parent_probability(at[3 * i], at[3 * i + 1], b)[x.w]
            tables = np.minimum(customers, 1)
            tables[several] = np.concatenate([_numbers_of(r["data"][i]) for r in rows[AT_PAIRS]])
            total = at[3 * i + 2][x.u]
            mean += np.where(here > 0, (customers - discount * tables + (STRENGTH[1] + discount * total) * p) / (STRENGTH[1] + here), p)
        whose = np.repeat(np.arange(len(x.size)), x.size)
        total = np.bincount(whose, np.log10(mean / n)[x.of], len(x.size))
        simple = np.log10((x.count + ADDED) / (tokens + ADDED * (words + 1)))[x.word]
        known = np.bincount(whose, x.count[x.word] > 0, len(x.size)).astype(np.int64)
        ids = rows[BODY][0]["docs"]
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, arrow_kind), pa.array(x.held_out), pa.array(x.size), pa.array(known), pa.array(np.full(len(ids), tokens, np.int64)), pa.array(np.bincount(whose, simple, len(x.size))), pa.array(total)],
            ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    arrow_kind = to_arrow_type(docs.schema["doc_id"].dataType)
    every = [mail(chunks, BODY), mail(numbers, NUMBERS), mail(dishes, COUNTS), mail(seen, AT_PAIRS), at_words]
    return dealt(every, score, None, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document is kept from learning: crc32 of its id as text, modulo 10, is 0. False for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 10 == 0, F.lit(False))
