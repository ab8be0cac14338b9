"""Language identification by rank-order profiles.

A profile is the list of the most frequent letter n-grams of a text, most frequent first. A document gets the language
whose profile is nearest: the sum, over the document's n-grams, of how far each is out of place in the language's list.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazeline.session import written

PROFILE = 400  # n-grams of a profile
LONGEST = 3  # letters of the longest n-gram; a blank counts as one
UNKNOWN = "und"

CHUNK_DOCS = 256  # documents that are counted at once
CHUNK_CHARS = 1 << 20  # and their characters; a longer text is counted in pieces
HELD_GRAMS = 1 << 20  # n-grams that a task gathers before it sends their counts
LETTER_BITS = 21  # of a code point


@cache
def _letters() -> np.ndarray:
    """By code point: the lower-case letter, 0 for what isn't a letter."""
    table = np.zeros(0x110000, np.int64)
    for point in range(0x110000):
        letter = chr(point)
        if letter.isalpha():
            low = letter.lower()
            table[point] = ord(low) if len(low) == 1 else point
    return table


def _grams(text: str) -> np.ndarray:
    """The n-grams of each word with a blank on either side, three code points packed in one number.

    The blank is 1, a missing letter 0. A blank alone is no n-gram, and none goes over a blank.
    """
    letters = _letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    keep = (letters > 0) | np.concatenate([[True], letters[:-1] > 0])  # one blank for each run of others
    run = np.where(letters[keep] > 0, letters[keep], 1)
    run = np.concatenate([[1] if run[0] != 1 else [], run, [1] if run[-1] != 1 else []]).astype(np.int64)
    solid = run != 1
    if not solid.any():
        return np.zeros(0, np.int64)
    one = run[solid] << 2 * LETTER_BITS
    two = (run[:-1] << 2 * LETTER_BITS | run[1:] << LETTER_BITS)[solid[:-1] | solid[1:]]
    three = (run[:-2] << 2 * LETTER_BITS | run[1:-1] << LETTER_BITS | run[2:])[solid[1:-1]]
    return np.concatenate([one, two, three])


def _counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a whole text, and how often each stands there. Long texts are counted in pieces."""
    pieces = []
    at = 0
    while at < len(text):
        to = at + CHUNK_CHARS
        while to < len(text) and text[to - 1].isalpha():  # no word is cut
            to += 1
        pieces.append(np.unique(_grams(text[at:to]), return_counts=True))
        at = to
    if len(pieces) == 1:
        return pieces[0]
    return _summed(pieces)


def _summed(pieces: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if not pieces:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    grams, place = np.unique(np.concatenate([p[0] for p in pieces]), return_inverse=True)
    return grams, np.bincount(place, np.concatenate([p[1] for p in pieces]), len(grams)).astype(np.int64)


def _ranked(grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The most frequent n-grams, most frequent first; ties by code point."""
    if len(grams) > PROFILE:
        least = np.partition(counts, len(counts) - PROFILE)[len(counts) - PROFILE]
        grams, counts = grams[counts >= least], counts[counts >= least]
    return grams[np.lexsort((grams, -counts))][:PROFILE]


def gram_counts(docs: DataFrame) -> DataFrame:
    """(lang, gram, n) over all rows (lang, text); rows without either say nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        size = 0

        def sent():
            for lang, pieces in held.items():
                grams, counts = _summed(pieces)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams), pa.array(counts)], ["lang", "gram", "n"])
            held.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.setdefault(lang, []).append(found := _counts(text))
                size += len(found[0])
                if size >= HELD_GRAMS:
                    for key in held:
                        held[key] = [_summed(held[key])]
                    size = sum(len(p[0][0]) for p in held.values())
                    if size >= HELD_GRAMS // 2:
                        yield from sent()
                        size = 0
        yield from sent()

    rows = docs.where("lang is not null and text is not null").select("lang", "text")
    return rows.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def learn(docs: DataFrame) -> DataFrame:
    """(lang, gram, place): the profile of each language, place 0 the most frequent; ties by code point.

    Takes rows (lang, text). All of them count. An empty table, or one without languages, gives no profile.
    """
    counts = written(gram_counts(docs), "lang-grams")
    # First the least count that can reach the profile: ranking then sees few more rows than it keeps.
    size = F.floor(F.log2("n") * 16)
    sizes = counts.groupBy("lang", size.alias("size")).agg(F.count("*").alias("grams"))
    above = F.sum("grams").over(Window.partitionBy("lang").orderBy(F.desc("size")))
    least = sizes.withColumn("above", above - F.col("grams")).where(F.col("above") < PROFILE).groupBy("lang").agg(F.min("size").alias("size"))
    near = counts.withColumn("size", size).alias("c").join(least.alias("l"), "lang").where("c.size >= l.size")
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    return near.select("lang", "gram", place.alias("place")).where(F.col("place") <= PROFILE).withColumn("place", F.col("place") - 1)


class Profiles:
    """The profiles as arrays: for each n-gram of any language its place in each, PROFILE where it has none."""

    def __init__(self, rows: list[tuple[str, int, int]]):
        self.langs = sorted({r[0] for r in rows})
        self.grams, at = np.unique(np.array([r[1] for r in rows], np.int64), return_inverse=True)
        self.places = np.full((len(self.grams) + 1, len(self.langs)), PROFILE, np.int32)
        column = {x: i for i, x in enumerate(self.langs)}
        for (lang, _, place), row in zip(rows, at):
            self.places[row, column[lang]] = place

    def nearest(self, text: str | None) -> tuple[str, float]:
        ranked = _ranked(*_counts(text)) if text else ()
        if not len(ranked) or not self.langs:
            return UNKNOWN, 0.0
        at = np.searchsorted(self.grams, ranked)
        at[at == len(self.grams)] = 0
        at[self.grams[at] != ranked] = len(self.grams)
        places = self.places[at]
        out = np.abs(places - np.arange(len(ranked), dtype=np.int32)[:, None])
        out[places == PROFILE] = PROFILE
        total = out.sum(axis=0)
        best = int(total.argmin())  # ties to the first in order
        return self.langs[best], 1.0 - float(total[best]) / (PROFILE * len(ranked))


def identify(docs: DataFrame, profiles: DataFrame) -> DataFrame:
    """All columns of `docs`, then `lang_pred` and `score`; only the text is looked at.

    `score` is 1 for a text whose n-grams stand just where the profile has them, 0 if the profile has none of them.
    `und` with score 0 if the text is null, or has no letter, or nothing was learned. Equally near languages: the
    first by code point. Columns of `docs` with these two names are replaced. The profiles go to every task: at most
    400 n-grams for each language.
    """
    known = profiles.select("lang", "gram", "place").toArrow().to_pylist()
    model = Profiles([(r["lang"], r["gram"], r["place"]) for r in known])
    kept = docs.select(*(docs[f"`{c}`"] for c in docs.columns if c not in ("lang_pred", "score")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, CHUNK_DOCS):
                some = batch.slice(first, CHUNK_DOCS)
                found = [model.nearest(x) for x in some.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*some.columns, pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())],
                    [*some.schema.names, "lang_pred", "score"])

    fields = ", ".join(f"`{n}` {t}" for n, t in kept.dtypes)
    return kept.mapInArrow(run, f"{fields}, lang_pred string, score double")


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document is kept from learning: crc32 of its id as text, modulo 4, is 2. False for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))
