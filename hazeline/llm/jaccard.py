"""Join of documents by the Jaccard similarity of their word shingles, skipping by set relations.

1. Texts with the same words are one class. Its set is looked at once.
2. A set can only have a partner if enough of its shingles occur in other sets. Shingles are counted in sorted arrays,
   dealt by ranges of their hashes; sets that can't have a partner are done.
3. The rest are indexed by the rarest shingles of each set. A posting holds the shingle's position in its set, which
   bounds the sizes of partners that can still be reached; lists are cut by size, so whole stretches are skipped.
4. Answers are derived from similar sets: each list is first compared with one of its sets only. What is linked to the
   same sets is in one component and never compared again; lists that lie within one component are skipped as a whole.
   When rounds of this find little more, the pairs left between different components are all compared.

Shingles are known by 64-bit hashes, classes by 128 bits of a digest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeline.llm.components import components
from hazeline.session import written

WORDS = 5
PERCENT = 75
CHUNK_TOKENS = 1 << 19  # shingles that a task sorts at once
RANGE_TOKENS = 1 << 20  # shingles, about, that one task of the count gets
BUCKET_TOKENS = 1 << 24  # shingles of the sets whose counts one task sums up
DRAWS = 16
WORTH = 200  # rounds of comparisons with drawn sets end when one finds less than this part of the best
SMALL_IDS = 4_000_000  # ids (32 MB) up to which a list of them is broadcast

ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], np.uint64)
MIX = np.uint64(0xFF51AFD7ED558CCD)
HALF = np.uint64(1) << np.uint64(63)


def words_of(text: str | None) -> list[bytes]:
    """Words with A-Z in lower case; letters beyond ASCII are kept as they are."""
    return text.encode().lower().split() if text else []


def shingles(words: list[bytes]) -> np.ndarray:
    """Sorted hashes of the distinct five-word shingles; a shorter text is one shingle."""
    if not words:
        return np.zeros(0, np.uint64)
    one = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    size = min(WORDS, len(words))
    total = np.zeros(len(words) - size + 1, np.uint64)
    for k in range(size):
        total += one[k:len(one) - size + 1 + k] * ODD[k]
    total += np.uint64(size)
    total ^= total >> np.uint64(33)
    total *= MIX
    total ^= total >> np.uint64(29)
    total.sort()
    return total[np.concatenate([[True], total[1:] != total[:-1]])]


def class_of(words: list[bytes]) -> tuple[int, int]:
    digest = hashlib.md5(b" ".join(words), usedforsecurity=False).digest()
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


def classes(docs: DataFrame) -> DataFrame:
    """(doc_id, hi, lo, words): each document's class and number of words."""
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for x in batch.column(1):
                words = words_of(x.as_py())
                found.append((*class_of(words), len(words)))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([f[i] for f in found], pa.int64()) for i in range(3))], ["doc_id", "hi", "lo", "words"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, hi long, lo long, words long")


def shared_counts(docs: DataFrame, tokens: int) -> DataFrame:
    """(hi, n, half, shared) of each class: size of its set, how many of its shingles have a hash in the lower half, and
    of these how many occur in another set; copies may count more than once, never less.

    A task sends each shingle of its sets once, in sorted arrays cut by ranges of hashes. A shingle that two sets of the
    task have goes as one entry without a set, so a frequent shingle costs an entry for each task.
    """
    ranges, buckets = max(1, ceil(tokens / 2 / RANGE_TOKENS)), max(1, ceil(tokens / BUCKET_TOKENS))

    def chunk(nodes: list[int], sizes: list[int], sets: list[np.ndarray]) -> Iterator[tuple]:
        low = [s[:np.searchsorted(s, HALF)] for s in sets]
        token, node = np.concatenate(low), np.repeat(np.arange(len(low), dtype=np.uint32), [len(x) for x in low])
        by = np.argsort(token, kind="stable")
        token, node = token[by], node[by]
        new = np.concatenate([[True], token[1:] != token[:-1]]) if len(token) else np.zeros(0, bool)
        run = np.cumsum(new) - 1
        several = np.bincount(run) > 1 if len(token) else np.zeros(0, bool)
        own = np.bincount(node[several[run]], minlength=len(nodes)) if len(token) else np.zeros(len(nodes), np.int64)
        first = np.flatnonzero(new)
        node = np.where(several, np.uint32(len(nodes)), node[first])
        token = token[first]
        keys = np.array(nodes, np.int64)
        cut = np.searchsorted(token, [np.uint64(r * (1 << 63) // ranges) for r in range(ranges + 1)])
        for r in range(ranges):
            if cut[r] < cut[r + 1]:
                here = node[cut[r]:cut[r + 1]]
                used, place = np.unique(here, return_inverse=True)
                names = np.append(keys, 0)[used]
                flag = len(nodes) in used  # the last name then stands for several sets
                yield r, token[cut[r]:cut[r + 1]].tobytes(), place.astype(np.uint32).tobytes(), names.tobytes(), flag
        # sizes and own counts go anywhere, evenly
        counts = np.stack([keys, np.array(sizes, np.int64), np.array([len(x) for x in low], np.int64), own.astype(np.int64)])
        yield ranges + abs(nodes[0]) % ranges, counts.tobytes(), b"", b"", False

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sent(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
            for row in rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row[0]], pa.int32()), *(pa.array([row[i]], pa.binary()) for i in (1, 2, 3)), pa.array([row[4]])], ["part", "tokens", "place", "names", "flag"])

        seen, nodes, sizes, sets, held = set(), [], [], [], 0
        for batch in batches:
            for x in batch.column(0):
                words = words_of(x.as_py())
                hi, _ = class_of(words)
                if not words or hi in seen:
                    continue
                found = shingles(words)
                seen.add(hi)
                nodes.append(hi)
                sizes.append(len(found))
                sets.append(found)
                held += len(found)
                if held >= CHUNK_TOKENS:
                    yield from sent(chunk(nodes, sizes, sets))
                    seen, nodes, sizes, sets, held = set(), [], [], [], 0
        if nodes:
            yield from sent(chunk(nodes, sizes, sets))

    def dealt(hi: np.ndarray, n: np.ndarray, half: np.ndarray, shared: np.ndarray) -> pa.Table:
        """One row for each bucket of classes, whatever their number."""
        at = (hi.view(np.uint64) >> np.uint64(32)) % np.uint64(buckets)
        found = [(int(b), *(x[at == b].astype(np.int64).tobytes() for x in (hi, n, half, shared))) for b in np.unique(at)]
        return pa.table({c: pa.array([f[i] for f in found], pa.binary() if i else pa.int32()) for i, c in enumerate(("bucket", "hi", "n", "half", "shared"))})

    def count(key: tuple, rows: pa.Table) -> pa.Table:
        if key[0].as_py() >= ranges:
            return dealt(*np.concatenate([np.frombuffer(x, np.int64).reshape(4, -1) for x in rows["tokens"].to_pylist()], axis=1))
        token, name, many = [], [], []
        for t, p, n, flag in zip(*(rows[c].to_pylist() for c in ("tokens", "place", "names", "flag"))):
            place, names = np.frombuffer(p, np.uint32), np.frombuffer(n, np.int64)
            token.append(np.frombuffer(t, np.uint64))
            name.append(names[place])
            many.append((place == len(names) - 1) & flag)
        token, name, many = map(np.concatenate, (token, name, many))
        by = np.argsort(token, kind="stable")
        token, name, many = token[by], name[by], many[by]
        starts = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
        least = np.minimum.reduceat(np.where(many, np.iinfo(np.int64).max, name), starts)
        most = np.maximum.reduceat(np.where(many, np.iinfo(np.int64).min, name), starts)
        shared = (least < most) | np.maximum.reduceat(many, starts)
        width = np.diff(np.append(starts, len(token)))
        hi, counts = np.unique(name[np.repeat(shared, width) & ~many], return_counts=True)
        none = np.zeros(len(hi), np.int64)
        return dealt(hi, none, none, counts)

    def total(key: tuple, rows: pa.Table) -> pa.Table:
        every, n, half, shared = (np.concatenate([np.frombuffer(x, np.int64) for x in rows[c].to_pylist()]) for c in ("hi", "n", "half", "shared"))
        hi, at = np.unique(every, return_inverse=True)
        largest = [np.zeros(len(hi), np.int64) for _ in range(2)]
        for out, x in zip(largest, (n, half)):
            np.maximum.at(out, at, x)
        return pa.table({"hi": hi, "n": largest[0], "half": largest[1], "shared": np.bincount(at, shared, len(hi)).astype(np.int64)})

    sent = docs.select("text").mapInArrow(run, "part int, tokens binary, place binary, names binary, flag boolean")
    counted = sent.repartition(2 * ranges, "part").groupBy("part").applyInArrow(count, "bucket int, hi binary, n binary, half binary, shared binary")
    return counted.groupBy("bucket").applyInArrow(total, "hi long, n long, half long, shared long")


def sets_of(docs: DataFrame, open_: DataFrame) -> DataFrame:
    """(node, hi, lo, n, tokens) of the classes whose `hi` is in `open_`. Stored."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [class_of(words_of(x.as_py())) for x in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64()), batch.column(0)], ["hi", "lo", "text"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                some = batch.slice(first, 500)
                found = [shingles(words_of(x.as_py())).view(np.int64) for x in some.column("text")]
                ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
                tokens = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found)))
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.array(np.diff(ends), pa.int32()), tokens], ["hi", "lo", "n", "tokens"])

    few = open_.count() <= SMALL_IDS
    texts = docs.select("text").where("text is not null").mapInArrow(keyed, "hi long, lo long, text string")
    texts = texts.join(F.broadcast(open_) if few else open_, "hi", "left_semi")
    texts = texts.groupBy("hi", "lo").agg(F.first("text").alias("text"))
    sets = texts.mapInArrow(cut, "hi long, lo long, n int, tokens array<long>")
    return written(sets.select(F.monotonically_increasing_id().alias("node"), "*"), "jaccard-sets")


def _postings(sets: DataFrame) -> DataFrame:
    """(token, node, n, at): for each set its rarest shingles that other sets have too, with their positions. Stored.

    Only so many that a partner must have one of them.
    """
    every = sets.select("node", "n", F.explode("tokens").alias("token"))
    often = every.groupBy("token").agg(F.count("*").alias("sets")).where("sets > 1")
    known = every.join(often, "token").groupBy("node", "n").agg(F.sort_array(F.collect_list(F.struct("sets", "token"))).alias("all"))
    alone = F.col("n") - F.size("all")  # shingles that no other set has come first
    first = F.col("n") - F.ceil(F.col("n") * PERCENT / 100) + 1 - alone
    rows = known.where(first > 0).select("node", "n", alone.alias("alone"), F.posexplode(F.slice("all", F.lit(1), first.cast("int"))).alias("at", "one"))
    return written(rows.select(F.col("one.token").alias("token"), "node", "n", (F.col("alone") + F.col("at")).cast("int").alias("at")), "jaccard-postings")


def _reach(n: str, at: str) -> Column:
    """The size up to which a partner can be similar if it has no shingle in common before this position."""
    size = F.col(n).cast("long")
    return F.floor(((size - F.col(at)) * (100 + PERCENT) - size * PERCENT) / PERCENT)


def _possible(x: str, y: str) -> Column:
    fits = lambda a, b: (F.col(f"{b}.n") * 100 >= F.col(f"{a}.n") * PERCENT) & (F.col(f"{b}.n") <= _reach(f"{a}.n", f"{a}.at"))
    return fits(x, y) & fits(y, x)


def _linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough."""
    x = sets.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta"))
    y = sets.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb"))
    both = F.size(F.array_intersect("ta", "tb"))
    held = pairs.join(x, "a").join(y, "b").withColumn("both", both)
    return held.where(F.col("both") * 100 >= (F.col("na") + F.col("nb") - F.col("both")) * PERCENT).select("a", "b")


def _bands(n: str) -> Column:
    """Sizes by powers of 1 / similarity: partners lie in the same band or the next."""
    return F.floor(F.log(F.col(n).cast("double")) / float(np.log(100 / PERCENT)) + 1e-9).cast("int")


def joined(sets: DataFrame) -> DataFrame:
    """(node, component) of all nodes with a link."""
    postings = _postings(sets).withColumn("component", F.col("node"))
    labels, turn, most = sets.select("node", F.col("node").alias("component")), 0, 0
    while True:
        turn += 1
        pairs = _with_centres(postings, turn)
        found = written(_linked(pairs, sets), "jaccard-links")
        links = found.count()
        labels, postings = _merged(found, labels, postings) if links else (labels, postings)
        most = max(most, links)
        if links * WORTH <= most:
            break
    found = written(_linked(_across(postings), sets), "jaccard-links")
    return _merged(found, labels, postings)[0] if not found.isEmpty() else labels


def _with_centres(postings: DataFrame, turn: int) -> DataFrame:
    """Pairs (a, b) of each posting with sets of its list, drawn anew in each turn, of another component.

    The first turn draws one set for each list, `DRAWS` classes of lists each in an order of its own, so that lists with
    the same sets agree; later, when few lists are left, each draws `DRAWS` sets.
    """
    salts = [F.pmod("token", F.lit(DRAWS))] if turn == 1 else [F.lit(i) for i in range(DRAWS)]
    place = [F.min(F.struct(F.xxhash64(F.col("node"), salt, F.lit(turn)).alias("draw"), "node", "n", "at", "component")).alias(f"c{i}") for i, salt in enumerate(salts)]
    several = postings.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high"), *place).where("low < high")
    centres = several.select("token", F.explode(F.array_distinct(F.array(*(f"c{i}" for i in range(len(salts)))))).alias("c")).select("token", "c.node", "c.n", "c.at", "c.component")
    near = postings.alias("x").join(centres.alias("y"), F.col("x.token") == F.col("y.token")).where((F.col("x.component") != F.col("y.component")) & _possible("x", "y"))
    return near.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()


def _across(postings: DataFrame) -> DataFrame:
    """All pairs (a, b) left between components, list by list and band of sizes by band."""
    several = postings.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("token")
    x = postings.join(several, "token", "left_semi").withColumn("band", _bands("n"))
    y = x.withColumn("band", F.explode(F.array(F.col("band"), F.col("band") - 1)))
    near = x.alias("x").join(y.alias("y"), (F.col("x.token") == F.col("y.token")) & (F.col("x.band") == F.col("y.band")))
    larger = (F.col("y.n") > F.col("x.n")) | ((F.col("y.n") == F.col("x.n")) & (F.col("y.node") > F.col("x.node")))
    near = near.where((F.col("x.component") != F.col("y.component")) & larger & _possible("x", "y"))
    return near.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()


def _merged(links: DataFrame, labels: DataFrame, postings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Labels and postings after these links; lists that lie within one component are skipped from now on."""
    a = labels.select(F.col("node").alias("a"), F.col("component").alias("ca"))
    b = labels.select(F.col("node").alias("b"), F.col("component").alias("cb"))
    moved = components(links.join(a, "a").join(b, "b").select(F.col("ca").alias("a"), F.col("cb").alias("b")))
    moved = moved.select(F.col("node").alias("component"), F.col("component").alias("now"))
    now = lambda rows: rows.join(moved, "component", "left").withColumn("component", F.coalesce("now", "component")).select(rows.columns)
    labels, postings = written(now(labels), "jaccard-labels"), written(now(postings), "jaccard-lists")
    several = postings.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("token")
    return labels, written(postings.join(several, "token", "left_semi"), "jaccard-lists")


def _grouped(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(doc_id, hi, lo, words) of each document; (hi, n) of each class; (hi, lo, first, component, component_id) of each
    class with words, `first` its smallest id, `component` null if it has no link."""
    every = written(classes(docs), "jaccard-classes")
    tokens = every.agg(F.sum("words")).first()[0] or 0
    counts = written(shared_counts(docs, tokens), "jaccard-counts")
    missing = F.col("n") - F.ceil(F.col("n") * PERCENT / 100)  # shingles that a partner may lack
    sets = sets_of(docs, counts.where(F.col("shared") >= F.col("half") - missing).select("hi"))
    named = joined(sets).join(sets.select("node", "hi", "lo"), "node").select("hi", "lo", "component")
    firsts = every.where("words > 0").groupBy("hi", "lo").agg(F.min("doc_id").alias("first"))
    firsts = written(firsts.join(named, ["hi", "lo"], "left"), "jaccard-firsts")
    least = firsts.where("component is not null").groupBy("component").agg(F.min("first").alias("least"))
    found = firsts.join(least, "component", "left").select("hi", "lo", "first", "component", F.when(F.col("component").isNull(), F.col("first")).otherwise(F.col("least")).alias("component_id"))
    return every, counts.select("hi", "n"), found


def similar_groups(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id): the size of each document's set, and the smallest id reachable by links.

    Two documents link if 100 * intersection >= 75 * union of their distinct five-word shingles; a text of fewer words is
    one shingle. A null, empty or blank text has no shingle, no link, and its own id as component. A null id has no part
    in the smallest id; a component of null ids has null. Repeated rows give repeated rows, an empty table an empty
    result. Columns other than doc_id and text are not looked at.
    """
    every, sizes, found = _grouped(docs.select("doc_id", "text"))
    rows = every.join(sizes, "hi", "left").join(found.select("hi", "lo", "component_id"), ["hi", "lo"], "left")
    return rows.select(
        "doc_id", F.when(F.col("words") > 0, F.col("n")).otherwise(F.lit(0)).cast("long").alias("n_shingles"),
        F.when(F.col("words") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def one_of_each_group(docs: DataFrame) -> DataFrame:
    """The document of smallest id of each component, as in `similar_groups`, with all columns of `docs`.

    Texts without words are all kept. Of rows with that id and the same words, or of null ids only, one is kept.
    """
    _, _, found = _grouped(docs.select("doc_id", "text"))
    place = F.struct(F.col("first").isNull().alias("none"), "first", "hi", "lo")
    linked = found.where("component is not null").groupBy("component").agg(F.min(place).alias("p")).select("p.hi", "p.lo", "p.first")
    winners = written(found.where("component is null").select("hi", "lo", "first").unionByName(linked), "jaccard-winners").alias("w")
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), "text")
    kind = dict(rows.dtypes)["row"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = []
            for x in batch.column(1):  # one text at a time: its words take many times its own memory
                words = words_of(x.as_py())
                keys.append((*class_of(words), bool(words)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()), pa.array([k[2] for k in keys])], ["row", "hi", "lo", "said"])

    keyed = rows.mapInArrow(run, f"row {kind}, hi long, lo long, said boolean").alias("d")
    ours = keyed.where("said").join(winners, (F.col("d.hi") == F.col("w.hi")) & (F.col("d.lo") == F.col("w.lo")) & F.col("d.row.doc_id").eqNullSafe(F.col("w.first")))
    return ours.select("d.row", "d.hi", "d.lo").dropDuplicates(["hi", "lo"]).select("row").unionByName(keyed.where("not said").select("row")).select("row.*")
