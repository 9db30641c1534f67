"""Packing of token sequences: a configuration linear program over the histogram of piece lengths.

Multiplicative weights solve the program; a knapsack over the capacity prices its columns, the configurations
(multisets of lengths that fit a sequence). Rounding leaves a remainder, which is packed best fit on the
histogram. The solver sees counts per length only, so its size depends on the capacity, not the data.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from deskmatch.llm.bpe import packed, ranks_suffice, worker_cache
from deskmatch.llm.common import columns, id_and_text, stored

#: rounds of the solver for few and for many lengths, knapsacks of one round, the rate at which prices change, and
#: how far (in rounds) a length may be covered ahead of time
ROUNDS, KNAPSACKS, RATE, AHEAD = (100, 20), 12, 0.3, 0.2
#: the solver ends early when its cover is so close to the bound of its prices
GAP = 0.001
TINY = 1e-9


def best_totals(prices: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """For every space up to ``capacity`` the greatest total price of pieces that fit, and the last piece used (-1: none)."""
    best = np.zeros(capacity + 1)
    choice = np.full(capacity + 1, -1)
    upto = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for space in range(int(lengths[0]) if len(lengths) else capacity + 1, capacity + 1):
        m = upto[space]
        values = best[space - lengths[:m]] + prices[:m]
        k = m - 1 - int(values[::-1].argmax())  # of equal totals the one with the longest piece
        best[space], choice[space] = values[k], k
    return best, choice


def knapsack(prices: np.ndarray, lengths: np.ndarray, limits: np.ndarray, capacity: int) -> Counter:
    """The configuration of greatest total price; ``limits`` bounds how often a length is used."""
    _, choice = best_totals(prices, lengths, capacity)
    used: Counter = Counter()
    space = capacity
    while space > 0 and choice[space] >= 0:
        k = int(choice[space])
        if used[k] < limits[k]:
            used[k] += 1
        space -= int(lengths[k])
    return used


def fractional(histogram: dict[int, int], capacity: int, rounds: int | None = None) -> tuple[dict[tuple[tuple[int, int], ...], float], float]:
    """Amounts of configurations ((length, times), …) that cover the histogram, and a lower bound for their sum.

    Each round covers a further share of every length. A length that is behind takes the dearest configuration that
    holds it; a knapsack over the capacity prices them all at once. Lengths that got ahead in a round close, and the
    knapsack is repeated without them. Prices then change by multiplicative weights: what is covered ahead of its time
    gets cheaper, what is behind gets dearer. Prices are feasible for the dual once divided by the dearest
    configuration, so each round gives a lower bound.
    """
    sizes = sorted(histogram)
    lengths, demand = np.array(sizes), np.array([histogram[l] for l in sizes], float)
    rounds = rounds or max(ROUNDS[1], min(ROUNDS[0], 2000 // len(sizes)))
    weights, bound = np.ones(len(sizes)), float(demand @ lengths) / capacity
    missing = np.zeros(len(sizes))  # behind (positive) or ahead
    amounts: dict[tuple[tuple[int, int], ...], float] = {}
    for done in range(1, rounds + 1):
        prices = weights * lengths / capacity
        missing += demand / rounds
        short, ahead = missing.tolist(), (-AHEAD / rounds * demand).tolist()
        todo = [k for k in range(len(sizes) - 1, -1, -1) if short[k] > TINY * histogram[sizes[k]]]
        for attempt in range(KNAPSACKS):
            usable = [k for k in range(len(sizes)) if attempt == 0 or short[k] > ahead[k] + TINY]
            best, choice = best_totals(prices[usable], lengths[usable], capacity)
            if attempt == 0:
                bound = max(bound, float(demand @ prices) / best[capacity])
            choice, later = choice.tolist(), []
            for k in todo:
                used, space = {k: 1}, capacity - sizes[k]
                while space > 0 and choice[space] >= 0:
                    other = usable[choice[space]]
                    used[other] = used.get(other, 0) + 1
                    space -= sizes[other]
                amount = max(0.0, short[k] / used[k])
                if attempt < KNAPSACKS - 1:  # the last knapsack covers whatever is left
                    amount = min([amount, *((short[j] - ahead[j]) / n for j, n in used.items() if j != k)])
                if amount > 0:
                    for j, n in used.items():
                        short[j] -= n * amount
                    key = tuple((sizes[j], n) for j, n in sorted(used.items(), reverse=True))
                    amounts[key] = amounts.get(key, 0.0) + amount
                if short[k] > TINY * histogram[sizes[k]]:
                    later.append(k)
            todo = later
            if not todo:
                break
        missing = np.array(short)
        weights *= np.exp(RATE * np.clip(missing / demand * rounds / done**0.5, -1, 1))
        weights *= float(demand @ lengths) / float(demand @ (weights * lengths))
        if sum(amounts.values()) * rounds / done <= (1 + GAP) * bound:
            return {key: amount * rounds / done for key, amount in amounts.items()}, bound
    return amounts, bound


def rounded(amounts: dict[tuple[tuple[int, int], ...], float], histogram: dict[int, int], capacity: int, up: bool) -> list[tuple[tuple[int, ...], int]]:
    """Whole sequences of each configuration, never more than there are pieces, and the rest best fit."""
    rest, plan = dict(histogram), []
    for key, amount in sorted(amounts.items(), key=lambda entry: (-entry[1], entry[0])):
        whole = math.ceil(amount - TINY) if up else math.floor(amount + TINY)
        count = min(whole, *(rest[length] // n for length, n in key))
        if count > 0:
            for length, n in key:
                rest[length] -= n * count
            plan.append((tuple(length for length, n in key for _ in range(n)), count))
    return plan + best_fit(rest, capacity)


def configurations(histogram: dict[int, int], capacity: int, rounds: int | None = None) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of one sequence, number of such sequences): every piece of the histogram is placed once.

    The program's plan, rounded down or up, unless best fit alone needs fewer sequences. The number of entries is
    bounded by the rounds and the capacity.
    """
    plan: list[tuple[tuple[int, ...], int]] = []
    left = {int(l): int(n) for l, n in histogram.items() if n > 0}
    if capacity in left:
        plan.append(((capacity,), left.pop(capacity)))
    if not left:
        return plan
    amounts, _ = fractional(left, capacity, rounds)
    plans = [rounded(amounts, left, capacity, up) for up in (False, True)] + [best_fit(left, capacity)]
    return plan + min(plans, key=lambda parts: sum(n for _, n in parts))


def best_fit(histogram: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """The longest piece left, filled up with the longest that still fit, as often as the counts allow."""
    left = {l: n for l, n in histogram.items() if n > 0}
    plan = []
    while left:
        space, used = capacity, Counter()
        for length in sorted(left, reverse=True):
            n = min(left[length], space // length)
            if n:
                used[length] += n
                space -= n * length
        count = min(left[l] // n for l, n in used.items())
        for l, n in used.items():
            left[l] -= n * count
            if not left[l]:
                del left[l]
        plan.append((tuple(l for l, n in used.items() for _ in range(n)), count))
    return plan


def places(plan: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, first sequence, pieces per sequence, offset of the first) per part of a plan."""
    taken: Counter = Counter()
    rows, sequence = [], 0
    for lengths, count in plan:
        offset = 0
        for length, n in Counter(lengths).items():
            rows.append((length, taken[length], taken[length] + n * count, sequence, n, offset))
            taken[length] += n * count
            offset += n * length
        sequence += count
    return rows


def cut_documents(docs: DataFrame, path: str, capacity: int, end_id: int, keep_ids: bool) -> DataFrame:
    """Pieces of all documents, each with its task and its rank among the task's pieces of the same length."""

    by_rank = ranks_suffice(path)

    def run(batches):
        task = TaskContext.get().partitionId()
        seen: Counter = Counter()
        ids_of, end = worker_cache(path, by_rank).text_ids, packed([end_id])
        for doc_ids, texts in columns(batches, "doc_id", "text"):
            rows = []
            for doc_id, text in zip(doc_ids, texts):
                ids = ids_of(text) + end
                n = len(ids) // 4
                start, size, piece = 0, n % capacity or capacity, 0
                while start < n:
                    part = ids[4 * start : 4 * (start + size)]
                    rows.append((doc_id, piece, start, size, zlib.crc32(part), task, seen[size], part if keep_ids else None))
                    seen[size] += 1
                    start, size, piece = start + size, capacity, piece + 1
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary())
            names = ("doc_id", "piece", "start", "length", "ids_crc32", "task", "nth", "ids")
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 8, kinds)], names=names)

    return docs.mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long, task int, nth long, ids binary"
    )


def pack_documents(
    docs: DataFrame, path: str, capacity: int = 1024, end_id: int = 2, id_column: str = "doc_id",
    text_column: str = "text", keep_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, and with ``keep_ids`` its ids.

    A document is the ids of its text (null: empty) and ``end_id``. Only documents longer than ``capacity``
    are cut; the first piece takes what is left over by full ones. Repeated rows and null ids are documents
    of their own; an empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    pieces = stored(cut_documents(id_and_text(docs, id_column, text_column), path, capacity, end_id, keep_ids), "pieces")
    counts = pieces.groupBy("task", "length").agg((F.max("nth") + 1).alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = spark.createDataFrame(
        places(configurations(histogram, capacity)),
        "length long, first long, end long, sequence long, times long, place long",
    )
    # ranks over all tasks: one row per task and length is summed up, at most one per task for any length
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    ranked = pieces.join(offsets, ["task", "length"]).withColumn("rank", F.col("nth") + F.col("ahead"))
    # the plan has a bounded number of parts: rounds and capacity set it, not the data
    part = F.broadcast(plan.withColumnRenamed("length", "_length"))
    inside = (F.col("length") == F.col("_length")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("end"))
    k = F.col("rank") - F.col("first")
    return ranked.join(part, inside).select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("sequence") + F.floor(k / F.col("times"))).cast("long").alias("sequence_id"),
        (F.col("place") + F.pmod(k, F.col("times")) * F.col("length")).cast("long").alias("offset"),
        *(["ids"] if keep_ids else []),
    )
