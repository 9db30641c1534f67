"""Phrase collocations. Only the longest windows are counted, padded at the end of a piece; ROLLUP sums them to
the counts of every shorter phrase, as each occurrence of a phrase begins exactly one window.

Texts are read once and kept as blocks of word numbers. Blocks and the counts of words meet in a table of the
frequent words, which gives each an id; a word that is too rare for any phrase ends a window like a piece does.
So windows are a few integers, however long their words.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from deskmatch.llm.common import columns, stored

#: fixed values: the characters that end a piece, and those between words
PIECE_ENDS, BETWEEN = b".,;:!?\n\x0b\x0c\r", b" \t"
#: a byte that no UTF-8 text holds stands for the end of a piece
END = b"\xff"
_CLEAN = bytes(END[0] if b in PIECE_ENDS else 32 if b in BETWEEN else b + 32 if 65 <= b <= 90 else b for b in range(256))
#: texts of one block together, in bytes; one longer text is a block of its own
BLOCK_BYTES = 16_000_000

BLOCK = "block long, lang string, n_words long, words binary, sizes binary, counts binary, codes binary"


def words_and_ends(text: bytes) -> list[bytes]:
    """The words of a text, A-Z in lower case, and an END after each piece."""
    return [word for word in text.translate(_CLEAN).replace(END, b" " + END + b" ").split(b" ") if word] + [END]


def _squeezed(values: np.ndarray | bytes) -> bytes:
    """Compressed; of integers the first bytes of all, then the second ones and so on."""
    import zstandard

    if isinstance(values, np.ndarray):
        values = np.ascontiguousarray(values.astype("<u4").view("u1").reshape(-1, 4).T).tobytes()
    return zstandard.ZstdCompressor(level=1).compress(values)


def _integers(squeezed: bytes) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(squeezed), "u1").reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def word_blocks(docs: DataFrame, text_column: str, group_column: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Blocks of one lang each: distinct words with their counts, and the texts as numbers of these words; 0 ends a piece."""

    def run(batches):
        block, size = TaskContext.get().partitionId() << 32, 0
        held: dict[str, tuple[defaultdict, list]] = {}
        for langs, texts in columns(batches, "lang", "text"):
            for lang, text in zip(langs, texts):
                if lang not in held:
                    numbers: defaultdict = defaultdict()
                    numbers.default_factory = numbers.__len__
                    numbers[END]
                    held[lang] = numbers, []
                numbers, codes = held[lang]
                codes.append(np.fromiter(map(numbers.__getitem__, words_and_ends(text)), "<u4"))
                size += len(text)
                if size >= block_bytes:
                    yield _block_rows(block, held)
                    block, size, held = block + 1, 0, {}
        if held:
            yield _block_rows(block, held)

    rows = docs.select(
        F.coalesce(F.col(group_column).cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(text_column).cast("string"), F.lit("")).cast("binary").alias("text"))
    return rows.mapInArrow(run, BLOCK)


def _block_rows(block: int, held: dict[str, tuple[dict, list]]) -> pa.RecordBatch:
    rows = []
    for lang, (numbers, codes) in held.items():
        used = np.concatenate(codes)
        counts = np.bincount(used, minlength=len(numbers))
        words = list(numbers)
        sizes = np.fromiter(map(len, words), "<u4", len(words))
        rows.append((block, lang, int(counts[1:].sum()), _squeezed(b"".join(words)), _squeezed(sizes), _squeezed(counts), _squeezed(used)))
    kinds = (pa.int64(), pa.string(), pa.int64(), *[pa.binary()] * 4)
    names = [column.split()[0] for column in BLOCK.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def block_words(blocks: DataFrame) -> DataFrame:
    """(block, lang, code, word, f): one row for each distinct word of each block."""

    def run(batches):
        import zstandard

        for batch in batches:
            for block, lang, words, sizes, counts in zip(*(c.to_pylist() for c in batch.columns)):
                ends = np.cumsum(_integers(sizes), dtype="i8")
                n, raw = len(ends) - 1, zstandard.ZstdDecompressor().decompress(words)
                # the first word is END
                listed = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends.astype("<i4").tobytes()), pa.py_buffer(raw)])
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array(np.full(n, block)), "lang": pa.array([lang] * n, pa.string()),
                    "code": pa.array(np.arange(1, n + 1, dtype="i4")), "word": listed.cast(pa.string()),
                    "f": pa.array(_integers(counts)[1:].astype("i8")),
                })

    chosen = blocks.select("block", "lang", "words", "sizes", "counts")
    return chosen.mapInArrow(run, "block long, lang string, code int, word string, f long")


def layout(highest: int, longest: int) -> tuple[int, int, int]:
    """(bits of an id, ids of one number, numbers of one window) where ``highest`` is the highest id."""
    bits = max(1, highest.bit_length())
    together = max(1, 63 // bits)
    return bits, together, -(-longest // together)


def windows(coded: DataFrame, longest: int, highest: int) -> DataFrame:
    """(p0, …, f): every window that begins with a frequent word, as the ids of its words, 0 beyond its end, packed into
    numbers by :func:`layout`. Windows of one block that are the same are counted. ``coded`` has codes, and known:
    (code, id) of frequent words."""
    bits, together, n = layout(highest, longest)
    names = [f"p{k}" for k in range(n)]

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                known = batch.column(1)[row].values.flatten()
                ids = np.concatenate([[0], known[1].to_numpy()])
                codes = _integers(batch.column(0)[row].as_py())
                near = np.zeros(int(codes.max()) + 1, "i4")  # place among the frequent words of this block, 0: none
                near[known[0].to_numpy()] = np.arange(1, len(ids))
                lead = np.concatenate([near[codes], np.zeros(longest, "i4")])
                del codes, near
                leads, counts = _distinct(_leads(lead, longest), len(ids))
                packed = [np.zeros(len(counts), "i8") for _ in names]
                for k, places in enumerate(leads):
                    packed[k // together] |= ids[places] << (bits * (k % together))
                yield pa.RecordBatch.from_arrays([*map(pa.array, packed), pa.array(counts)], names=[*names, "f"])

    return coded.select("codes", "known").mapInArrow(run, ", ".join(f"{name} long" for name in (*names, "f")))


def unpacked(counted: DataFrame, longest: int, highest: int) -> DataFrame:
    """(w1, …, f) from the numbers of :func:`windows`."""
    bits, together, _ = layout(highest, longest)
    mask = F.lit((1 << bits) - 1)
    return counted.select(*[
        F.shiftright(f"p{k // together}", bits * (k % together)).bitwiseAND(mask).alias(f"w{k + 1}") for k in range(longest)], "f")


def _leads(lead: np.ndarray, longest: int) -> Iterator[np.ndarray]:
    """First words of all windows, then second words and so on; 0 behind a 0. ``lead`` ends with ``longest`` zeros."""
    at = np.flatnonzero(lead)
    now = lead[at]
    yield now
    for k in range(1, longest):
        now = np.where(now > 0, lead[at + k], 0)
        yield now


def _distinct(leads: Iterable[np.ndarray], base: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct windows and how often each occurs; numbers are below ``base``."""
    held, key, high = [], None, 1
    for lead in leads:
        held.append(lead)
        if high > 2**62 // base:
            shown, key = np.unique(key, return_inverse=True)
            high = len(shown)
        key, high = lead.astype("i8") if key is None else key * base + lead, high * base
    if base ** len(held) > 2**62:
        _, places, counts = np.unique(key, return_index=True, return_counts=True)
        return [lead[places] for lead in held], counts
    n = len(held)
    del held, lead
    key.sort()
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])[: len(key)])
    counts, key = np.diff(np.append(starts, len(key))), key[starts]
    parts = []
    for _ in range(n):
        key, part = np.divmod(key, base)
        parts.append(part)
    return parts[::-1], counts


def phrase_counts(
    docs: DataFrame, longest: int = 3, least: int = 10, text_column: str = "text", group_column: str = "lang",
    block_bytes: int = BLOCK_BYTES,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Totals (lang, n): all words. Words (id, lang, word): those that occur at least ``least`` times in a lang.
    Phrases (ids, f): arrays of 1 to ``longest`` such ids, all that occur so often."""
    blocks = stored(word_blocks(docs, text_column, group_column, block_bytes), "blocks")
    totals = blocks.groupBy("lang").agg(F.sum("n_words").alias("n"))
    listed = block_words(blocks)
    words = stored(
        listed.groupBy("lang", "word").agg(F.sum("f").alias("f")).filter(F.col("f") >= least)
        .select(F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("row"), "lang", "word"), "words")
    # small ids, so that windows take little room: rows of all parts in turn
    row = F.col("row") - F.shiftleft(F.col("part").cast("long"), 33)
    last = words.agg(F.max("part").alias("part"), F.max(row).alias("row")).first()
    parts = (last["part"] or 0) + 1
    highest = ((last["row"] or 0) + 1) * parts
    words = words.select((row * parts + F.col("part") + 1).alias("id"), "lang", "word")
    # a word occurs once in a block; its key of many blocks is split by Spark
    known = listed.join(words, ["lang", "word"]).groupBy("block", "lang").agg(F.collect_list(F.struct("code", "id")).alias("known"))
    coded = blocks.select("block", "lang", "codes").join(known, ["block", "lang"])

    names = [f"w{k}" for k in range(1, longest + 1)]
    counted = windows(coded, longest, highest)
    counted = unpacked(counted.groupBy(*counted.columns[:-1]).agg(F.sum("f").alias("f")), longest, highest)
    # the longest level is counted already: of it only what is frequent goes on
    last = names[-1]
    counted = counted.withColumn(last, F.when((F.col("f") >= least) & (F.col(last) > 0), F.col(last)))
    summed = counted.rollup(*names).agg(F.sum("f").alias("f"), F.grouping_id().alias("rolled"))
    size = F.lit(longest) - F.bit_count("rolled")
    whole = reduce(lambda a, b: a & b, [(size < k) | (F.col(f"w{k}") > 0) for k in range(1, longest + 1)])
    frequent = summed.filter(whole & (size > 0)).filter(F.col("f") >= least)
    ids = F.array_compact(F.array(*names))
    return totals, words, stored(frequent.select(ids.alias("ids"), "f"), "phrases")


def _exact(value: Column) -> Column:
    return value.cast("decimal(20,0)")


def collocations(
    docs: DataFrame, longest: int = 3, least: int = 10, top: int = 2000, absorb_percent: int = 50, scale: int = 1_000_000,
    text_column: str = "text", group_column: str = "lang", block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The ``top`` phrases of each lang by score: lang, rank, phrase, a, l, r, n, score.

    Texts are split into pieces at `.,;:!?` and line ends, pieces into words at spaces and tabs; only A-Z are
    lower-cased. A phrase of 2 to ``longest`` words is a candidate if it occurs a >= ``least`` times. Its cut
    into l = f(first k words) and r = f(rest) of least floor(scale * a * a / (l * r)) counts, ties to smallest k.
    A candidate inside a longer one with 100 * f(longer) >= ``absorb_percent`` * a is dropped. n is the number of
    words of the lang. Order: score, a (both descending), phrase by its bytes. Null texts are empty, a null lang
    is `und`; repeated rows count again; an empty table gives no rows; other columns are ignored. Arithmetic is
    decimal and exact up to 38 digits: a up to 10^16 at this scale.
    """
    totals, words, phrases = phrase_counts(docs, longest, least, text_column, group_column, block_bytes)
    size = F.size("ids")
    candidates = phrases.filter(size > 1).withColumnRenamed("f", "a")
    parts = phrases.filter(size < longest)

    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), size - 1))).select(
        "ids", "a", "k", F.slice("ids", 1, F.col("k")).alias("head"), F.slice("ids", F.col("k") + 1, size).alias("tail"))
    # a frequent word is head or tail of many candidates: Spark splits such keys
    for side, count in (("head", "l"), ("tail", "r")):
        cuts = cuts.join(parts.select(F.col("ids").alias(side), F.col("f").alias(count)), side)
    cuts = cuts.withColumn("above", _exact(F.col("a")) * _exact(F.col("a")) * F.lit(scale).cast("decimal(10,0)"))
    cuts = cuts.withColumn("below", _exact(F.col("l")) * _exact(F.col("r"))).withColumn("score", F.expr("above div below"))
    best = cuts.groupBy("ids", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")).select(
        "ids", "a", "cut.score", "cut.l", "cut.r")

    # every shorter run of words inside a candidate, with the most frequent candidate around it
    around = candidates.filter(size > 2).select("ids", "a").withColumn("n", F.explode(F.sequence(F.lit(2), size - 1))).select(
        "a", F.explode(F.transform(F.sequence(F.lit(1), size - F.col("n") + 1), lambda at: F.slice("ids", at, F.col("n")))).alias("ids"))
    around = around.groupBy("ids").agg(F.max("a").alias("longer"))
    kept = best.join(around, "ids", "left").filter(
        F.col("longer").isNull() | (100 * F.col("longer") < absorb_percent * F.col("a"))).drop("longer")

    first = words.select(F.col("id").alias("_first"), "lang")
    kept = kept.withColumn("_first", F.col("ids")[0]).join(first, "_first").drop("_first")
    # names are needed for those only that can be among the first, ties included
    level = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc())
    likely = kept.withColumn("level", F.rank().over(level)).filter(F.col("level") <= top)
    for k in range(longest):
        name = words.select(F.col("id").alias("_id"), F.col("word").alias(f"_w{k}"))
        likely = likely.withColumn("_id", F.get("ids", F.lit(k))).join(name, "_id", "left").drop("_id")
    likely = likely.withColumn("phrase", F.concat_ws(" ", *[f"_w{k}" for k in range(longest)]))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = likely.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", *[F.col(c).cast("long").alias(c) if c != "phrase" else F.col(c) for c in (
        "rank", "phrase", "a", "l", "r", "n", "score")])
