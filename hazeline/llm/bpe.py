"""Byte-pair encoding as a streaming transducer with bounded lookahead, and decoding as a byte-to-text machine.

A sequence of tokens is the encoding of its bytes exactly if each neighbouring pair is the encoding of its own bytes.
So the transducer reads left to right, appends the longest token that fits its left neighbour, and steps back from dead
ends. How far a byte can change tokens to its left is bounded by the merge list (`sufficient_lookahead`); tokens further
back are emitted and forgotten, so the memory for a text without any break is constant.
"""

from __future__ import annotations

import codecs
import json
import re
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: Fixed value: how byte-level vocabularies of this family split a text before merging.
PRETOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: White space other than blank and line feed, and what the two regular expression libraries read differently.
OTHER_SPACE = re.compile("[\t\x0b\x0c\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")

BLOCK_CHARS = 1 << 18  # a text is read in blocks of about this length
REMEMBERED = 300_000  # pieces of which a worker remembers the tokens; then it starts anew
REMEMBERED_CHARS = 48
BATCH_BYTES = 8 << 20  # output rows are sent in batches of about this size


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary file: itself if visible, else the next from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


def sufficient_lookahead(merges: list[tuple[int, int, int]], width: dict[int, int]) -> int:
    """A distance in bytes beyond which no later byte changes a token; `merges` (left, right, result) in rank order.

    Two texts that agree up to a point can only differ to the left of it by a chain of merges of rising rank, each
    taking in the token left of the difference, whose right part starts with a token of the link before. This is the
    greatest width of such a chain.
    """
    left = {made: a for a, _, made in reversed(merges)}
    further: dict[int, int] = {}  # by token: the widest chain that goes on where this token starts
    widest = 0
    for a, b, made in reversed(merges):
        reach = width[a] + max(further.get(made, 0), further.get(a, 0))
        widest = max(widest, reach)
        while True:
            further[b] = max(further.get(b, 0), reach)
            if b not in left:
                break
            b = left[b]
    return widest


class Vocabulary:
    """A vocabulary file with its merge list; made once for each Python worker."""

    def __init__(self, text: str):
        spec = json.loads(text)
        letters, model = byte_letters(), spec["model"]
        self.added = {x["content"]: x["id"] for x in spec["added_tokens"]}
        if any(x[k] for x in spec["added_tokens"] for k in ("lstrip", "rstrip", "single_word")):
            raise ValueError("added tokens that take in their surroundings are not supported")
        self.added_pattern = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        named = {k: v for k, v in model["vocab"].items() if k not in self.added}
        self.ids = {bytes(letters[c] for c in k): v for k, v in named.items()}
        self.text = {v: k for k, v in self.ids.items()}
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.merges = [(named[a], named[b], named[a + b]) for a, b in pairs]
        self.rank = {(a, b): (i, made) for i, (a, b, made) in reversed([*enumerate(self.merges)])}
        self.lookahead = sufficient_lookahead(self.merges, {k: len(v) for k, v in self.text.items()})
        self.longest = max(map(len, self.ids))
        self.reach: dict[bytes, int] = {}  # by first two bytes: the longest token
        for k in self.ids:
            self.reach[k[:2]] = max(self.reach.get(k[:2], 1), len(k))
        self.made = {made: i for i, (_, _, made) in reversed([*enumerate(self.merges)])}
        self._fits: dict[tuple[int, int], bool] = {}
        self._edges: dict[tuple[int, int], tuple[list[int], list[int]]] = {}
        spellings = self.text | {v: k.encode() for k, v in self.added.items()}
        self.spelling = [spellings.get(i, b"") for i in range(max(spellings) + 1)]
        self.width = np.array([len(x) for x in self.spelling], np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.width)])[:-1]
        self.letters = np.frombuffer(b"".join(self.spelling), np.uint8)
        self.bare, self.spaced = _Memory(self, ""), _Memory(self, " ")

    def merged(self, data: bytes) -> list[int]:
        """The encoding by its definition: again and again the first pair of the lowest rank."""
        ids = [self.ids[data[i:i + 1]] for i in range(len(data))]
        while len(ids) > 1:
            (_, made), at = min(((self.rank.get(p, (len(self.rank), -1)), i) for i, p in enumerate(zip(ids, ids[1:]))), key=lambda x: (x[0][0], x[1]))
            if made < 0:
                break
            ids[at:at + 2] = [made]
        return ids

    def fits(self, before: int, token: int) -> bool:
        """Whether the pair is the encoding of its bytes; before = -1: the token alone."""
        key = (before, token)
        if (known := self._fits.get(key)) is None:
            if len(self._fits) >= REMEMBERED:
                self._fits.clear()
            known = self._fits[key] = self.merged(self.text[token]) == [token] if before < 0 else self._apart(before, token)
        return known

    def _edge(self, token: int, side: int) -> tuple[list[int], list[int]]:
        """The tokens at one edge of a token while it is merged together, and the rank at which each is taken up."""
        key = (token, side)
        if key not in self._edges:
            tokens, ranks = [token], [len(self.merges)]
            while tokens[0] in self.made:
                rank = self.made[tokens[0]]
                tokens.insert(0, self.merges[rank][side])
                ranks.insert(0, rank)
            self._edges[key] = tokens, ranks
        return self._edges[key]

    def _apart(self, before: int, token: int) -> bool:
        """No merge reaches over the border: none comes before both its parts are taken up on their own sides."""
        (left, left_up), (right, right_up) = self._edge(before, 1), self._edge(token, 0)
        i = j = 0
        while True:
            rank = self.rank.get((left[i], right[j]))
            if rank is not None and rank[0] < left_up[i] and rank[0] <= right_up[j]:
                return False
            if left_up[i] <= right_up[j] and i + 1 < len(left):
                i += 1
            elif j + 1 < len(right):
                j += 1
            else:
                return True

    def stream(self, data: Iterable[bytes]) -> Iterator[list[int]]:
        """Tokens of one unbroken piece that comes in parts, as soon as they are stable."""
        buffer, base, ids, ends, dead, at = b"", 0, [], [0], set(), 0  # positions count from `base`
        vocabulary, reach, fits = self.ids, self.reach, self.fits
        parts = iter(data)
        last = False
        while True:
            stop = len(buffer) if last else len(buffer) - self.longest
            while at < stop:
                before = ids[-1] if ids else -1
                for to in range(min(len(buffer), at + reach.get(buffer[at:at + 2], 1)), at, -1):
                    token = vocabulary.get(buffer[at:to])
                    if token is not None and to not in dead and fits(before, token):
                        ids.append(token)
                        ends.append(to)
                        at = to
                        break
                else:
                    dead.add(at)
                    ids.pop()
                    ends.pop()
                    at = ends[-1]
            if last:
                yield ids
                return
            stable = 0  # tokens that end at least the lookahead before here; one stays as left neighbour
            while stable < len(ids) - 1 and ends[stable + 1] <= at - self.lookahead:
                stable += 1
            if stable > 1:
                stable -= 1
                yield ids[:stable]
                base = ends[stable]
                ids, ends, buffer, at = ids[stable:], [x - base for x in ends[stable:]], buffer[base:], at - base
                dead = {x - base for x in dead if x > base}
            more = next(parts, None)
            if more is None:
                last = True
            else:
                buffer += more

    def piece(self, text: str) -> list[int]:
        if len(text) <= BLOCK_CHARS:
            data = text.encode()
            token = self.ids.get(data)
            if token is not None and self.fits(-1, token):
                return [token]
            return [i for part in self.stream([data]) for i in part]
        cut = (text[i:i + BLOCK_CHARS].encode() for i in range(0, len(text), BLOCK_CHARS))
        return [i for part in self.stream(cut) for i in part]

    def encode(self, text: str) -> bytes:
        """Token ids as little-endian unsigned 32-bit integers."""
        if self.added_pattern is None or not self.added_pattern.search(text):
            return b"".join(self._plain(text))
        out, at = [], 0
        for m in self.added_pattern.finditer(text):
            out += [*self._plain(text[at:m.start()]), _packed([self.added[m[0]]])]
            at = m.end()
        return b"".join([*out, *self._plain(text[at:])])

    def _plain(self, text: str) -> Iterator[bytes]:
        at = 0
        while at < len(text):
            to = self._cut(text, at + BLOCK_CHARS)
            yield from self._block(text[at:to])
            at = to

    @staticmethod
    def _cut(text: str, least: int) -> int:
        """The first place from `least` on where a blank stands between two other characters that are not white space."""
        while (to := text.find(" ", least)) > 0:
            if to + 1 < len(text) and not text[to - 1].isspace() and not text[to + 1].isspace():
                return to
            least = to + 1
        return len(text)

    def _block(self, block: str) -> Iterator[bytes]:
        if any(x in block for x in ("  ", "\n\n", " \n", "\n ")) or OTHER_SPACE.search(block):
            for m in PRETOKEN.finditer(block):
                yield self.bare[m[0]]
            return
        # White space is single here, so a break stands before each blank and around each line feed.
        for k, line in enumerate(block.split("\n")):
            if k:
                yield self.bare["\n"]
            words = line.split(" ")
            if words[0]:
                yield self.bare[words[0]]
            yield from map(self.spaced.__getitem__, words[1:])

    def decode(self, ids: bytes) -> str:
        """The text, with a replacement character for each broken byte sequence."""
        machine, out = codecs.getincrementaldecoder("utf-8")("replace"), []
        every = np.frombuffer(ids, "<u4")
        for i in range(0, len(every), BLOCK_CHARS):
            some = every[i:i + BLOCK_CHARS]
            width = self.width[some]
            before = np.cumsum(width) - width
            at = np.arange(int(width.sum())) + np.repeat(self.start[some] - before, width)
            out.append(machine.decode(self.letters[at].tobytes()))
        return "".join([*out, machine.decode(b"", True)])


class _Memory(dict):
    """Packed tokens by piece of text, with what stands before it; short pieces are remembered."""

    def __init__(self, vocabulary: Vocabulary, before: str):
        self.vocabulary, self.before = vocabulary, before

    def __missing__(self, said: str) -> bytes:
        found = [self.before + said] if said.isalpha() else PRETOKEN.findall(self.before + said)
        packed = _packed([i for x in found for i in self.vocabulary.piece(x)])
        if len(said) <= REMEMBERED_CHARS:
            if len(self) >= REMEMBERED:
                self.clear()
            self[said] = packed
        return packed


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


_vocabularies: dict[int, Vocabulary] = {}


def _vocabulary(text: str) -> Vocabulary:
    key = hash(text)
    if key not in _vocabularies:
        _vocabularies[key] = Vocabulary(text)
    return _vocabularies[key]


def transcode(docs: DataFrame, vocabulary_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids, decoded): the tokens of every whole text, and the text that they decode to.

    `ids` is binary, little-endian unsigned 32-bit integers. A null text counts as empty and has no tokens. Each row is
    encoded by itself: repeated rows give equal rows, an empty table an empty result; other columns are not looked at.
    The vocabulary file is read by the driver; a file of this kind has a fixed size.
    """
    with open(vocabulary_path, encoding="utf-8") as f:
        file = docs.sparkSession.sparkContext.broadcast(f.read())
    rows = docs.select(docs[key].alias("key"), docs[text].cast("string").alias("text"))
    kind = dict(rows.dtypes)["key"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(file.value)
        for batch in batches:
            keys, first, size, ids, said = batch.column(0), 0, 0, [], []
            for i, value in enumerate(batch.column(1)):
                ids.append(vocabulary.encode(value.as_py() or ""))
                said.append(vocabulary.decode(ids[-1]))
                size += len(ids[-1]) + len(said[-1])
                if size >= BATCH_BYTES or i == batch.num_rows - 1:
                    yield pa.RecordBatch.from_arrays([keys.slice(first, len(ids)), pa.array(ids, pa.binary()), pa.array(said, pa.string())], ["key", "ids", "decoded"])
                    first, size, ids, said = i + 1, 0, [], []

    return rows.mapInArrow(run, f"key {kind}, ids binary, decoded string").withColumnRenamed("key", key)
