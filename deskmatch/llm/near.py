"""Near-duplicate groups from MinHash bands, odd sketches and exact confirmation.

A text is the set of its word shingles. Texts of equal sets form a class, which one text represents. MinHash
values of the set are cut into bands; representatives that share a band are candidates. The same values,
folded into a parity bitmap (an odd sketch), tell by the population count of an exclusive or how similar two
candidates are. What may reach the threshold is confirmed on the full sets. Groups are the connected
components of the confirmed links.

No group is expanded into its pairs. In each band a representative meets the leader of the band, and what
it shares with the leader and what not is known exactly. Members that end up in other components meet again
only where these parts allow a link: at a shingle both have outside the leader, or at a small enough size.
Such pairs pass the sketches before they are confirmed.
"""

from __future__ import annotations

import hashlib
import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskmatch.llm.common import columns, id_and_text, stored

SKETCH_BITS = 1024
#: chance that two sets exactly at the threshold share no band
MISSED = 1e-7
#: similarity below the threshold by which a sketch may underrate a pair (over five standard deviations)
SKETCH_MARGIN = 0.13
CACHED = 150_000
_MIX = np.uint64(0x9E3779B97F4A7C15)


def band_shape(percent: int) -> tuple[int, int]:
    """(bands, rows): longer bands for higher thresholds, as many as keep the chance of a miss below MISSED."""
    similarity = percent / 100
    rows = max(1, min(12, round(math.log(0.27) / math.log(similarity)))) if similarity < 1 else 12
    return (max(1, math.ceil(math.log(MISSED) / math.log(1 - similarity**rows))) if similarity < 1 else 1), rows


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        found = xxhash.xxh3_64_intdigest(word)
        if len(self) >= CACHED:
            self.clear()
        if len(word) <= 64:
            self[word] = found
        return found


_hashes = WordHashes()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; of a shorter text one, the whole; none without words.

    A-Z are lower-cased and words end at ASCII white space.
    """
    words = text.encode().lower().split()
    n = len(words)
    if not n:
        return np.empty(0, "u8")
    hashed = np.fromiter(map(_hashes.__getitem__, words), "u8", n)
    width = min(n, size)
    out = np.full(n - width + 1, width, "u8")
    for at in range(width):
        out = _mixed(out * _MIX + hashed[at : at + len(out)])
    return np.unique(out)


@lru_cache(maxsize=4)
def _functions(bands: int, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    random = np.random.default_rng(20)
    n = bands * rows
    odd = (random.integers(0, 1 << 31, n, dtype="u4") << np.uint32(1)) | np.uint32(1)
    return odd, random.integers(0, 1 << 32, n, dtype="u4"), np.arange(n, dtype="u8")


def sketch(found: np.ndarray, bands: int, rows: int) -> tuple[list[int], list[int]]:
    """(band hashes, odd sketch as 64-bit words) of a non-empty set."""
    factor, flip, number = _functions(bands, rows)
    short = (found >> np.uint64(32)).astype("u4")
    least = np.full(len(number), 0xFFFFFFFF, "u4")
    room = np.empty((64, len(number)), "u4")  # small enough for a core's cache
    for start in range(0, len(short), 64):
        part = short[start : start + 64, None]
        now = room[: len(part)]
        np.bitwise_xor(part, flip, out=now)
        np.multiply(now, factor, out=now)
        np.minimum(least, np.minimum.reduce(now, axis=0), out=least)
    tagged = _mixed(least.astype("u8") + (number << np.uint64(32)))
    parity = np.bincount((tagged % np.uint64(SKETCH_BITS)).astype("i8"), minlength=SKETCH_BITS) & 1
    odd = np.packbits(parity.astype("u1")).view("i8")
    joined = np.zeros(bands, "u8")
    for column in tagged.reshape(bands, rows).T:
        joined = _mixed(joined * _MIX + column)
    return joined.view("i8").tolist(), odd.tolist()


def most_flips(percent: int, samples: int) -> int:
    """Bits in which the sketches of a pair at the threshold may differ."""
    apart = 2 * samples * (1 - max(0.0, percent / 100 - SKETCH_MARGIN))
    return math.ceil(SKETCH_BITS * (1 - (1 - 2 / SKETCH_BITS) ** apart) / 2)


def flips(left: Column, right: Column) -> Column:
    apart = F.zip_with(left, right, lambda a, b: F.bit_count(a.bitwiseXOR(b)))
    return F.aggregate(apart, F.lit(0), lambda total, n: total + n)


def sketches(docs: DataFrame, size: int, percent: int) -> DataFrame:
    bands, rows = band_shape(percent)

    def run(batches):
        for ids, keys, texts in columns(batches, "doc_id", "text_key", "text"):
            sets = [shingles(text, size) for text in texts]
            found = [sketch(s, bands, rows) if len(s) else ([], []) for s in sets]
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(ids, pa.int64()), "text_key": pa.array(keys, pa.int64()),
                "n_shingles": pa.array(map(len, sets), pa.int64()), "set_key": pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                "bands": pa.array([f[0] for f in found], pa.list_(pa.int64())),
                "odd": pa.array([f[1] for f in found], pa.list_(pa.int64())),
            })

    return docs.mapInArrow(
        run, "doc_id long, text_key long, n_shingles long, set_key binary, bands array<long>, odd array<long>")


def with_texts(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b) with both texts; rows of one b follow each other where the join sorts them."""
    first = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    second = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    return pairs.select("a", "b").join(first, "a").join(second, "b")


def _sets(batches, size: int):
    """(a, b, set of a, set of b) row by row; the set of the last b is kept."""
    last, known = None, None
    for listed in columns(batches, "a", "b", "text_a", "text_b"):
        for a, b, text_a, text_b in zip(*listed):
            if b != last:
                last, known = b, shingles(text_b, size)
            yield a, b, shingles(text_a, size), known


def reaches(common: int, n: int, m: int, percent: int) -> bool:
    return 100 * common >= percent * (n + m - common)


def confirmed(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The (a, b) of ``pairs`` whose full sets reach the threshold."""

    def run(batches):
        found = [
            (a, b) for a, b, own, other in _sets(batches, size)
            if reaches(len(np.intersect1d(own, other, assume_unique=True)), len(own), len(other), percent)
        ]
        yield pa.RecordBatch.from_pydict({
            "a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    return with_texts(pairs, texts).mapInArrow(run, "a long, b long")


def anchored(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Members against the leader they met: id, leader, n (size), m (leader's size), common, linked, and ``rest``,
    the least part of the member's other shingles that any other member it may link with must share.

    Two members with a link have at least percent/100 of the larger set in common. What they do not share
    through the leader they share outside it: k shingles, with k >= percent/100 * n - common for both. Of two
    sets with k equal elements, all but k - 1 elements of each, in one order, already have one in common.
    """

    def run(batches):
        rows = []
        for a, b, own, other in _sets(batches, size):
            outside = np.setdiff1d(own, other, assume_unique=True)
            common = len(own) - len(outside)
            needed = max(1, -(-percent * len(own) // 100) - common)
            rest = outside[: max(0, len(outside) - needed + 1)]
            rows.append((a, b, len(own), len(other), common, reaches(common, len(own), len(other), percent), rest.view("i8").tolist()))
            if len(rows) >= 2000:
                yield _anchored_rows(rows)
                rows = []
        yield _anchored_rows(rows)

    return with_texts(pairs, texts).mapInArrow(
        run, "id long, leader long, n long, m long, common long, linked boolean, rest array<long>")


def _anchored_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.list_(pa.int64()))
    names = ("id", "leader", "n", "m", "common", "linked", "rest")
    listed = list(zip(*rows)) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(listed, kinds)], names=list(names))


def still_possible(members: DataFrame, percent: int) -> DataFrame:
    """(a, b): members of one leader in different components that may be linked. ``members`` are the rows of
    :func:`anchored` with component and main (the leader's component). Pairs meet at a shared shingle outside
    the leader, or, where the leader's shingles alone may do, at a size that is small enough."""
    t = percent / 100
    side = lambda letter, *more: [F.col(c).alias(f"{c}_{letter}") for c in ("id", "n", "common", "component", *more)]
    apart = F.col("component") != F.col("main")
    need = F.col("n_a") + F.col("n_b")
    shared = F.least("common_a", "common_b") + F.least(F.col("n_a") - F.col("common_a"), F.col("n_b") - F.col("common_b"))
    fits = (
        (F.col("component_a") != F.col("component_b"))
        & ((F.col("component_b") == F.col("main")) | (F.col("id_a") < F.col("id_b")))
        & ((100 + percent) * shared >= percent * need)
    )
    spread = members.withColumn("at", F.explode("rest"))
    met = spread.filter(apart).select("leader", "at", *side("a")).join(spread.select("leader", "at", "main", *side("b")), ["leader", "at"]).filter(fits)
    # a link inside the leader alone needs common * (1 + t) / t - n >= the other's size, so the other is the smaller one
    step = lambda size: F.floor(F.log(F.greatest(size, F.lit(1.0)).cast("double")) / math.log(1.02))
    most = F.floor(F.col("common") * ((1 + t) / t) + 1e-9) - F.col("n")
    least = F.floor(t * F.col("n") - 1e-9)
    inside = 100 * F.col("common") >= percent * F.col("n")
    small = (
        members.filter(apart & inside & (most >= least) & (most > 0))
        .select("leader", *side("a"), F.explode(F.sequence(step(least), step(most))).alias("step"))
        .join(members.filter(inside).select("leader", "main", step(F.col("n")).alias("step"), *side("b")), ["leader", "step"])
        .filter(fits & ((100 + percent) * F.least("common_a", "common_b") >= percent * need))
    )
    pairs = met.select(F.col("id_a").alias("a"), F.col("id_b").alias("b")).unionByName(small.select(F.col("id_a").alias("a"), F.col("id_b").alias("b")))
    return pairs.distinct()


def components(links: DataFrame) -> DataFrame:
    """(id, component) of all linked ids; the component is its smallest id. ``links`` has (a, b).

    Every round points all neighbours of an id to the smallest one, first those above it, then those below,
    until only stars are left. Rounds grow with the logarithm of the size of a component.
    """
    def smallest(edges: DataFrame) -> DataFrame:
        return edges.groupBy("u").agg(F.min("v").alias("m"))

    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "links")
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = smallest(both).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        least = smallest(large)
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(small.unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct(), "links")
        mark = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("id"), F.col("v").alias("component"))
    ).distinct()


def near_duplicates(
    docs: DataFrame, size: int = 5, percent: int = 80, id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest id reachable by links), kept (it is that one).

    Two documents are linked if 100 * common shingles >= ``percent`` * all their shingles. Null and empty texts
    have no shingles and no links. A row without id is linked with nothing, has no component and is kept.
    A document is an id with a text: rows of one id with different texts are linked by their texts only, and
    repeated rows count as one. An empty table gives no rows; other columns are ignored.
    """
    return _decided(docs, size, percent, id_column, text_column).drop("text_key")


def _with_key(docs: DataFrame) -> DataFrame:
    return docs.withColumn("text_key", F.xxhash64("text"))


def _decided(docs: DataFrame, size: int, percent: int, id_column: str, text_column: str) -> DataFrame:
    """The rows of :func:`near_duplicates` with the hash of their text."""
    docs = _with_key(id_and_text(docs, id_column, text_column))
    bands, rows = band_shape(percent)
    limit = most_flips(percent, bands * rows)
    sketched = stored(sketches(docs, size, percent), "sketches")
    usable = sketched.filter((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    # documents of one set are one node, shown by its first document
    classes = stored(
        usable.groupBy("set_key").agg(F.min(F.struct("doc_id", "text_key")).alias("first"))
        .select("set_key", "first.doc_id", "first.text_key", F.monotonically_increasing_id().alias("node")), "classes")
    heads = usable.join(classes, ["set_key", "doc_id", "text_key"]).select(F.col("node").alias("id"), "bands", "odd")
    # every representative with the leader of each of its bands: the one that shares bands with most others
    banded = heads.select("id", F.explode("bands").alias("band"))
    crowded = banded.groupBy("band").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    shared = stored(banded.join(crowded, "band"), "bands")
    central = shared.groupBy("id").agg(F.sum("members").alias("weight"))
    leaders = shared.join(central, "id").groupBy("band").agg(F.max(F.struct("weight", (-F.col("id")).alias("id"))).alias("top"))
    met = shared.join(leaders.select("band", (-F.col("top.id")).alias("leader")), "band").filter("id <> leader").select(
        F.col("id").alias("a"), F.col("leader").alias("b")).distinct()
    wanted = classes.join(central.select(F.col("id").alias("node")), "node").select("doc_id", "text_key", F.col("node").alias("id"))
    texts = stored(docs.join(wanted, ["doc_id", "text_key"]).groupBy("id").agg(F.min("text").alias("text")), "texts")
    members = stored(anchored(met, texts, size, percent), "members")
    grouped = stored(components(members.filter("linked").select(F.col("id").alias("a"), F.col("leader").alias("b"))), "components")

    # members that are still apart from others of the same leader
    of_leader = grouped.select(F.col("id").alias("leader"), F.col("component").alias("main"))
    placed = members.join(grouped, "id", "left").join(of_leader, "leader", "left").select(
        "leader", "id", "n", "common", "rest", F.coalesce("component", "id").alias("component"), F.coalesce("main", "leader").alias("main"))
    possible = still_possible(stored(placed, "placed"), percent)
    odd = heads.select("id", "odd")
    further = (
        possible.join(odd.select(F.col("id").alias("a"), F.col("odd").alias("odd_a")), "a")
        .join(odd.select(F.col("id").alias("b"), F.col("odd").alias("odd_b")), "b")
        .filter(flips(F.col("odd_a"), F.col("odd_b")) <= limit).select("a", "b").distinct()
    )
    links = confirmed(further, texts, size, percent)
    of = lambda side: grouped.select(F.col("id").alias(side), F.col("component").alias(f"component_{side}"))
    between = stored(
        links.join(of("a"), "a", "left").join(of("b"), "b", "left")
        .select(F.coalesce("component_a", "a").alias("a"), F.coalesce("component_b", "b").alias("b")).distinct(),
        "links",
    )
    merged = components(between).select(F.col("id").alias("component"), F.col("component").alias("merged"))

    rooted = classes.join(grouped.withColumnRenamed("id", "node"), "node", "left").select(
        "set_key", "doc_id", F.coalesce("component", "node").alias("component")
    ).join(merged, "component", "left").select("set_key", "doc_id", F.coalesce("merged", "component").alias("root"))
    least = rooted.groupBy("root").agg(F.min("doc_id").alias("component"))
    final = rooted.join(least, "root").select("set_key", "component")
    own = F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)
    return (
        sketched.select("doc_id", "text_key", "n_shingles", F.when(own, F.col("set_key")).alias("set_key"))
        .join(final, "set_key", "left")
        .select(
            "doc_id", "text_key", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"),
            F.coalesce(F.coalesce("component", "doc_id") == F.col("doc_id"), F.lit(True)).alias("kept"),
        )
    )


def keep_one(docs: DataFrame, size: int = 5, percent: int = 80, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` whose document is kept, with all their columns; equal texts under one id stay once.

    Rows without id stay, as do rows without words. Of an id with several texts only the rows of dropped texts go.
    ``docs`` is read more than once, so it should be a stored table. An empty table stays empty.
    """
    found = _decided(docs, size, percent, id_column, text_column)
    gone = found.filter(~F.col("kept")).select(F.col("doc_id").alias("_gone"), F.col("text_key").alias("_text")).distinct()
    same = (docs[id_column].cast("long") == gone["_gone"]) & (F.xxhash64(F.coalesce(docs[text_column], F.lit(""))) == gone["_text"])
    left = docs.join(gone, same, "left_anti")
    named = left.filter(F.col(id_column).isNotNull()).dropDuplicates([id_column, text_column])
    return named.unionByName(left.filter(F.col(id_column).isNull()))
