"""Removal of repeated byte strings by induced suffix sorting.

What is wanted of the suffix array are neighbours that agree in `WINDOW` bytes. Equal windows have the same least hash of
a short string, at the same place (their anchor), so:

1. Every window's anchor is found; anchors whose short string stands in one place only are done.
2. Suffixes that start at the other anchors are the sample. Tuples (anchor, bytes from the anchor on, bytes before it,
   count) are sorted by Spark's external sort, which spills sorted runs to disk and merges them with a priority queue.
3. The order of all other suffixes is induced from the sample: step by step the byte before each suffix is put in front,
   which keeps the order among those with the same byte. Common-prefix values are carried along as minima over what
   lies between new neighbours. A window is repeated if a neighbour agrees in its whole length.

Texts that are equal as a whole are one class; only one of them is sorted.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeline.session import written

WINDOW = 400
GRAM = 64  # bytes of the short strings whose hashes are compared
PLACES = WINDOW - GRAM + 1  # of short strings in a window
PART_BYTES = 24 << 20  # of sample tuples, about, in one partition
CHUNK_BYTES = 8 << 20  # of tuples that are induced at once; groups are not cut
HOT = 20_000  # different surroundings of one anchor, beyond which it is split by place
BAND = 8  # places of a window that stay together then
SALTS = 8  # tasks that the rows of one hash go to when they are looked up
SMALL_BYTES = 96 << 20  # of keys and spans, up to which they are broadcast
BLOCK = 1 << 20  # bytes of a long text that are hashed at once

BASE = 0x9E3779B97F4A7C15
MIX = np.uint64(0xD6E8FEB86659FD93)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


UP, DOWN = _powers(BASE, BLOCK + WINDOW), _powers(pow(BASE, -1, 1 << 64), BLOCK + WINDOW)


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of each short string, from sums of bytes times powers."""
    n = len(data) - GRAM + 1
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(data * UP[:len(data)], out=sums[1:])
    out = (sums[GRAM:] - sums[:n]) * DOWN[:n]
    out ^= out >> np.uint64(32)
    out *= MIX
    return out ^ (out >> np.uint64(32))


def _least(hashes: np.ndarray, places: int = PLACES) -> np.ndarray:
    """The least of each `places` hashes in a row, from running minima of blocks in both directions."""
    padded = np.full(-(-len(hashes) // places) * places, np.iinfo(np.uint64).max, np.uint64)
    padded[:len(hashes)] = hashes
    rows = padded.reshape(-1, places)
    ahead = np.minimum.accumulate(rows, axis=1).reshape(-1)
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    n = len(hashes) - places + 1
    return np.minimum(back[:n], ahead[places - 1:places - 1 + n])


def _block_anchors(data: np.ndarray) -> tuple[np.ndarray, ...]:
    hashes = _gram_hashes(data)
    least = _least(hashes)
    first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    last = np.append(first[1:], len(least)) - 1
    found = []
    views = np.lib.stride_tricks.sliding_window_view(hashes, PLACES)
    while len(first):
        at = np.concatenate([first[i:i + 4096] + views[first[i:i + 4096]].argmin(axis=1) for i in range(0, len(first), 4096)])
        found.append((least[first], at, first, np.minimum(last, at)))
        more = last > at  # the same hash once more, further on
        first, last = at[more] + 1, last[more]
    value, at, first, last = (np.concatenate(x) for x in zip(*found))
    by = np.argsort(first, kind="stable")
    return value[by].view(np.int64), at[by], first[by], last[by]


def anchors(text: bytes) -> tuple[np.ndarray, ...]:
    """(hash, place, first window, last window) of each anchor: the leftmost least short string of these windows."""
    if len(text) < WINDOW:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    data = np.frombuffer(text, np.uint8).astype(np.uint64)
    windows = len(text) - WINDOW + 1
    parts = []
    for start in range(0, windows, BLOCK):
        value, *places = _block_anchors(data[start:min(len(text), start + BLOCK + WINDOW - 1)])
        parts.append((value, *(x + start for x in places)))
    value, at, first, last = (np.concatenate(x) for x in zip(*parts))
    new = np.concatenate([[True], at[1:] != at[:-1]])  # an anchor goes on over the border of two blocks
    starts = np.flatnonzero(new)
    return value[starts], at[starts], first[starts], last[np.append(starts[1:], len(at)) - 1]


def class_key(text: Column | str = "text") -> Column:
    """Texts that are equal as a whole have the same; a null text is empty."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def _list(rows: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int64), *rows]).astype(kind.to_pandas_dtype())))


def described(docs: DataFrame) -> DataFrame:
    """(key, n_bytes, values, places, firsts, lasts): class and anchors of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                some = batch.slice(start, 1000)
                texts = [(x.as_py() or "").encode() for x in some.column(1)]
                found = [anchors(x) for x in texts]
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array([len(x) for x in texts], pa.int64()), _list([f[0] for f in found], pa.int64()), *(_list([f[i] for f in found], pa.int32()) for i in (1, 2, 3))],
                    ["key", "n_bytes", "values", "places", "firsts", "lasts"])

    return docs.select(class_key().alias("key"), "text").mapInArrow(run, "key binary, n_bytes long, values array<long>, places array<int>, firsts array<int>, lasts array<int>")


def _candidates(every: DataFrame) -> DataFrame:
    """(key, anchors): of each class the anchors whose hash also stands elsewhere."""
    one = every.where(F.size("values") > 0).dropDuplicates(["key"])
    rows = written(one.select("key", F.explode(F.arrays_zip("values", "places", "firsts", "lasts")).alias("a")).select("key", "a.*"), "repeats-anchors")
    place = F.xxhash64("key", "places")
    shared = rows.groupBy("values").agg(F.min(place).alias("one"), F.max(place).alias("other")).where("one <> other").select("values")
    near = _salted(rows, shared, "values", place)
    return near.groupBy("key").agg(F.collect_list(F.struct("values", "places", "firsts", "lasts")).alias("anchors"))


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(key, text, anchors) of the wanted classes. Stored."""
    texts = docs.where(F.octet_length("text") >= WINDOW).select(class_key().alias("key"), "text").groupBy("key").agg(F.first("text").alias("text"))
    return written(texts.join(wanted, "key"), "repeats-texts")


def _tuples(texts: DataFrame) -> DataFrame:
    """(id, value, before, seg, key, at): for each anchor the bytes of its windows, `before` of them in front of the
    anchor at `at`; `seg` is null where the task has sent the same bytes already. Stored."""
    names, kinds = ["id", "value", "before", "seg", "key", "at"], [pa.binary(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int32()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[bytes] = set()
        for batch in batches:
            out, size = [], 0
            for key, text, found in zip(*batch.columns):
                key, data = key.as_py(), text.as_py().encode()
                for a in found.as_py():
                    seg = data[a["firsts"]:a["lasts"] + WINDOW]
                    before = a["places"] - a["firsts"]
                    mark = hashlib.md5(seg + before.to_bytes(4, "little"), usedforsecurity=False).digest()
                    new = mark not in sent
                    out.append((mark, a["values"], before, seg if new else None, key, a["places"]))
                    if new:
                        if len(sent) >= 1 << 18:
                            sent.clear()
                        sent.add(mark)
                    size += 64 + new * len(seg)
                    if size > 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names)
                        out, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names)

    return written(texts.select("key", "text", "anchors").mapInArrow(run, "id binary, value long, before int, seg binary, key binary, at int"), "repeats-tuples")


def _split(rows: DataFrame, hot: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Tuples for induction, tuples for counting, and (id, part) of the tuples that were cut.

    Tuples of anchors with more than `hot` different surroundings are cut by place in the window: windows with the anchor
    at one of `BAND` neighbouring places keep the bytes that all of them have as part of their key, so that what doesn't
    agree there is apart, and parts that agree entirely become one tuple before the shuffle. Groups that are still as
    large, at the edges of a frequent passage, have windows that are counted one by one instead.
    """
    many = rows.groupBy("value").agg(F.count("*").alias("n")).where(F.col("n") > hot).select("value")
    least = F.col("before") + WINDOW - F.octet_length("seg")  # bytes before the anchor in the last window
    cut = rows.join(many, "value", "left_semi").withColumn("band", F.explode(F.sequence(F.floor(least / BAND), F.floor(F.col("before") / BAND))))
    high = F.least(F.col("before"), F.col("band") * BAND + BAND - 1)
    low = F.greatest(least, F.col("band") * BAND)
    cut = cut.withColumn("high", high.cast("int")).withColumn("low", low.cast("int"))
    seg = F.expr(f"substring(seg, before - high + 1, high - low + {WINDOW})")
    # bytes in common: from the band's last place before the anchor to the first window's end
    core = F.expr(f"substring(seg, before - least(band * {BAND}, before) + 1, {WINDOW - BAND + 1})")
    cut = cut.select("id", F.xxhash64("value", "band", core).alias("value"), F.col("high").alias("before"), seg.alias("seg"), "rows")
    cut = cut.withColumn("part", F.unhex(F.md5(F.concat(F.encode(F.concat_ws(" ", "value", "before"), "UTF-8"), "seg"))))
    parts = written(cut.groupBy(F.col("part").alias("id"), "value", "before").agg(F.first("seg").alias("seg"), F.sum("rows").alias("rows")), "repeats-parts")
    large = parts.groupBy("value").agg(F.count("*").alias("n")).where(F.col("n") > hot).select("value")
    small = rows.join(many, "value", "left_anti").unionByName(parts.join(large, "value", "left_anti"))
    return small, parts.join(large, "value", "left_semi"), cut.select("id", "part")


def _counted(rows: DataFrame) -> DataFrame:
    """(id, high, low) of repeated windows of these tuples, each window a row: equal ones are counted before the shuffle,
    and meet again under one of several salts."""
    places = F.explode(F.sequence(F.col("before") + WINDOW - F.octet_length("seg"), F.col("before"))).alias("high")
    windows = rows.select("id", "rows", "before", "seg", places)
    mark = F.unhex(F.md5(F.expr(f"substring(seg, before - high + 1, {WINDOW})")))
    windows = windows.select("id", "rows", F.col("high").cast("int").alias("high"), mark.alias("mark"))
    counts = windows.groupBy("mark").agg(F.sum("rows").alias("n")).where(F.col("n") > 1).select("mark")
    hits = _salted(windows, counts, "mark", F.xxhash64("id"))
    return hits.select("id", "high", F.col("high").alias("low"))


def _salted(rows: DataFrame, known: DataFrame, key: str, by: Column) -> DataFrame:
    """Rows whose key is known; a key's rows go to `SALTS` tasks."""
    salted = known.withColumn("salt_", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("salt_", F.pmod(by, F.lit(SALTS)).cast("int")).join(salted, [key, "salt_"], "left_semi").drop("salt_")


def induced(group: np.ndarray, left: list[bytes], right: list[bytes], many: np.ndarray) -> list[np.ndarray]:
    """For each tuple the numbers of bytes before the anchor at which its window is repeated.

    Tuples come sorted by (group, right). `many`: whether the tuple stands in several places.
    """
    n = len(group)
    left_size, right_size = np.array([len(x) for x in left]), np.array([len(x) for x in right])
    before = np.zeros((n, PLACES), np.uint8)  # column k: the byte k places before the anchor, from 1 on
    for i, x in enumerate(left):
        before[i, 1:len(x) + 1] = np.frombuffer(x[::-1], np.uint8)
    after = np.zeros((n, WINDOW), np.uint8)
    for i, x in enumerate(right):
        after[i, :len(x)] = np.frombuffer(x, np.uint8)
    common = np.zeros(n, np.int64)  # of the suffix and the one before it in order
    if n > 1:
        differ = after[1:] != after[:-1]
        agree = np.where(differ.any(axis=1), differ.argmax(axis=1), WINDOW)
        common[1:] = np.minimum(agree, np.minimum(right_size[1:], right_size[:-1]))
    repeated = np.zeros((n, PLACES), bool)
    least = WINDOW - right_size  # fewer bytes before the anchor, and the window isn't this anchor's
    order, family = np.arange(n), group.copy()
    common[np.concatenate([[True], group[1:] != group[:-1]])] = 0
    for k in range(PLACES):
        if k:
            # the suffixes one byte longer: apart by that byte, in the old order where it agrees
            byte = np.where(left_size[order] >= k, before[order, k].astype(np.int64), 256)
            key = family * 257 + byte
            by = np.argsort(key, kind="stable")
            new = np.concatenate([[True], key[by][1:] != key[by][:-1]])
            again = common[by]
            far = np.flatnonzero(~new[1:] & (by[1:] != by[:-1] + 1)) + 1  # new neighbours: the least of what lay between
            if len(far):
                spans = np.stack([by[far - 1] + 1, by[far] + 1], axis=1).reshape(-1)
                again[far] = np.minimum.reduceat(np.append(common, 0), spans)[::2]
            again[new] = 0
            family = np.cumsum(new) - 1
            stay = byte[by] < 256
            order, family, common = order[by][stay], family[stay], again[stay]
            if len(order):
                # alone with its bytes before the anchor: nothing can agree any more, unless it stands in several places
                size = np.bincount(family)[family]
                stay = (size > 1) | many[order]
                order, family, common = order[stay], family[stay], common[stay]
        if not len(order):
            break
        same = np.concatenate([[False], family[1:] == family[:-1]])
        enough = same & (common >= WINDOW - k)
        hit = enough | np.append(enough[1:], False) | many[order]
        fits = (k >= least[order]) & hit
        repeated[order[fits], k] = True
    return [np.flatnonzero(r) for r in repeated]


def _repeats(tuples: DataFrame, hot: int) -> DataFrame:
    """(id, high, low): runs of repeated windows of each tuple, as numbers of bytes before the anchor."""
    one = tuples.groupBy("id", "value", "before").agg(F.max("seg").alias("seg"), F.count("*").alias("rows"))
    rows, large, cut = _split(written(one, "repeats-sample"), hot)
    rows = rows.withColumn("right", F.expr("substring(seg, before + 1)"))
    total = rows.agg(F.sum(F.octet_length("seg"))).first()[0] or 0
    parts = max(1, ceil(total / PART_BYTES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def done() -> Iterator[pa.RecordBatch]:
            if not held:
                return
            # tuples of the same bytes, from the split of a hot anchor, are one
            place, ids, uses = {}, [], []
            for mark, value, before, seg, rows in held:
                key = (value, before, seg)
                if key not in place:
                    place[key] = len(place)
                    ids.append([])
                    uses.append(0)
                ids[place[key]].append(mark)
                uses[place[key]] += rows
            keys = list(place)
            _, group = np.unique(np.array([k[0] for k in keys]), return_inverse=True)
            found = induced(group.astype(np.int64), [s[:b] for _, b, s in keys], [s[b:] for _, b, s in keys], np.array(uses) > 1)
            out = []
            for members, places in zip(ids, found):
                if len(places):
                    cut = np.flatnonzero(np.diff(places) > 1) + 1
                    runs = [(int(r[-1]), int(r[0])) for r in np.split(places, cut)]
                    out += [(m, *r) for m in members for r in runs]
            for i in range(0, len(out), 1 << 18):
                some = out[i:i + (1 << 18)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[c] for r in some], t) for c, t in enumerate([pa.binary(), pa.int32(), pa.int32()])], ["id", "high", "low"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if size > CHUNK_BYTES and row[1] != held[-1][1]:
                    yield from done()
                    held, size = [], 0
                held.append(row)
                size += len(row[3]) + 1500
        yield from done()

    dealt = rows.repartition(parts, "value").sortWithinPartitions("value", "right")
    found = dealt.select("id", "value", "before", "seg", "rows").mapInArrow(run, "id binary, high int, low int")
    found = written(found.unionByName(_counted(large)), "repeats-found")
    of_parts = cut.join(found.withColumnRenamed("id", "part"), "part").select("id", "high", "low")
    return found.unionByName(of_parts)  # ids of parts are in no other table: their own rows join nothing


def removed(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """(key, spans): of each class with repeats the runs of bytes that go, maximal and in order. Stored."""
    every = written(described(docs), "repeats-docs")
    tuples = _tuples(_texts(docs, _candidates(every)))
    repeats = _repeats(tuples, hot)
    covered = tuples.select("id", "key", "at").join(repeats, "id")
    runs = covered.select("key", F.struct((F.col("at") - F.col("high")).alias("from"), (F.col("at") - F.col("low") + WINDOW).alias("to")).alias("run"))
    listed = runs.groupBy("key").agg(F.sort_array(F.collect_list("run")).alias("spans"))
    copies = every.groupBy("key").agg(F.count("*").alias("rows"), F.min("n_bytes").alias("size"))
    whole = copies.where((F.col("rows") > 1) & (F.col("size") >= WINDOW)).select(
        "key", F.array(F.struct(F.lit(0).alias("from"), F.col("size").cast("int").alias("to"))).alias("spans"))
    shape = "array<struct<from:int,to:int>>"
    both = listed.join(whole, "key", "left_anti").unionByName(whole.withColumn("spans", F.col("spans").cast(shape)))
    return written(both, "repeats-spans")


def whole_characters(kept: Column | str = "kept") -> Column:
    """Kept bytes as text, without the rests of characters that a removed run began or ended in; replacement characters
    go as well."""
    return F.replace(F.make_valid_utf8(F.col(kept).cast("string")), F.lit("\ufffd"), F.lit(""))


SPANS = pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())]))


def _cut(data: bytes, runs: list[dict] | None) -> tuple[list[dict], bytes]:
    merged, left, at = [], [], 0
    for r in runs or ():
        if merged and r["from"] <= merged[-1]["to"]:
            merged[-1]["to"] = max(merged[-1]["to"], r["to"])
        else:
            merged.append(dict(r))
    for r in merged:
        left.append(data[at:r["from"]])
        at = r["to"]
    return merged, b"".join([*left, data[at:]])


def without_repeats(docs: DataFrame, hot: int = HOT, also: DataFrame | None = None) -> DataFrame:
    """All columns of `docs`, then n_bytes, spans, kept: each text without the bytes of any 400-byte string that starts
    anywhere else too.

    All occurrences go, in the same document or another; strings don't cross documents and are judged on the input.
    `spans` are the maximal removed runs, array<struct<from: int, to: int>> in bytes of the UTF-8 text; `kept` is binary,
    the bytes between them, for a run may end within a character. A null text is empty; a text of fewer bytes is kept.
    Equal long texts go entirely. Repeated rows count as documents of their own; an empty table gives an empty result.
    Columns of `docs` with the new names are replaced. `also`: (key, spans) of further bytes that go, by `class_key`.
    """
    found = removed(docs.select("text"), hot)
    if also is not None:
        found = written(found.unionByName(also).groupBy("key").agg(F.sort_array(F.flatten(F.collect_list("spans"))).alias("spans")), "repeats-both")
    added = ("n_bytes", "spans", "kept")
    own = [c for c in docs.columns if c not in added]
    fields = ", ".join(f"`{n}` {t}" for n, t in docs.select(*(f"`{c}`" for c in own)).dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                some = batch.slice(start, 500)
                texts = [(x.as_py() or "").encode() for x in some.column(1)]
                cut = [_cut(x, r) for x, r in zip(texts, some.column(2).to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [*some.column(0).flatten(), pa.array([len(x) for x in texts], pa.int64()), pa.array([c[0] for c in cut], SPANS), pa.array([c[1] for c in cut], pa.binary())],
                    [*own, *added])

    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in own)).alias("row"), class_key().alias("key"), "text").alias("d")
    size = found.agg(F.sum(F.lit(16 + 24) + F.size("spans") * 8)).first()[0] or 0
    small = size <= SMALL_BYTES
    both = rows.join((F.broadcast(found) if small else found).alias("f"), F.col("d.key") == F.col("f.key"), "left")
    return both.select("d.row", "d.text", "f.spans").mapInArrow(run, f"{fields}, n_bytes long, spans array<struct<from:int,to:int>>, kept binary")
