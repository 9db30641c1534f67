"""Exact top-k search by inner product on a bit-sliced index.

The index holds, for blocks of rows, one bitmap per attribute and binary place. The scores of all rows of a
block are sums of such bitmaps: a query's weight is written in signed binary digits, each digit adds the
attribute's bitmaps at its place, and carry-save adders turn columns of bitmaps into one bitmap per place of
the score. The top rows are chosen from the most significant bitmap downward; rows that tie on the boundary
are settled by their ids.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from deskmatch.llm.common import stored

BLOCK_ROWS, QUERY_ROWS = 32_768, 128
_LARGEST = 1 << 62


def quantised(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component, held within 62 bits."""
    bound = F.lit(_LARGEST)
    return F.transform(vector, lambda x: F.least(F.greatest(F.floor(F.lit(float(scale)) * x.cast("double")), -bound), bound))


def usable(vector: Column) -> Column:
    finite = lambda x: x.isNotNull() & (F.abs(x.cast("double")) < F.lit(math.inf))  # noqa: E731  NaN is above infinity
    return vector.isNotNull() & F.forall(vector, finite)


def sliced(vectors: np.ndarray) -> tuple[list[int], list[int], np.ndarray]:
    """(lowest value, number of places) of each attribute, and the bitmaps of value - lowest, attribute by attribute."""
    n = len(vectors)
    words = -(-n // 64)
    lows, places, maps = [], [], []
    for column in vectors.T:
        low, high = int(column.min()), int(column.max())
        lows.append(low)
        places.append((high - low).bit_length())
        above = column.astype("u8") - np.uint64(low & 0xFFFFFFFFFFFFFFFF)  # modulo 2^64, so always the difference
        for place in range(places[-1]):
            bits = np.packbits(((above >> np.uint64(place)) & np.uint64(1)).astype("u1"), bitorder="little")
            maps.append(np.pad(bits, (0, 8 * words - len(bits))).view("u8"))
    return lows, places, np.array(maps, "u8").reshape(len(maps), words)


def digits(weight: int) -> list[tuple[int, int]]:
    """(place, +1 or -1): the signed binary digits of a number, no two of them neighbours."""
    found, place = [], 0
    while weight:
        if weight & 1:
            digit = 2 - (weight & 3)
            found.append((place, digit))
            weight -= digit
        weight >>= 1
        place += 1
    return found


def score_maps(query: list[int], lows: list[int], places: list[int], maps, negated) -> tuple[list[np.ndarray | None], int]:
    """Bitmaps of the places of (score - constant) of all rows, and the constant."""
    columns: dict[int, list[np.ndarray]] = {}
    constant = at = 0
    for weight, low, width in zip(query, lows, places):
        constant += weight * low
        for place, digit in digits(weight):
            # minus a number is its complement, less a constant
            if digit < 0:
                constant -= ((1 << width) - 1) << place
            source = maps if digit > 0 else negated
            for k in range(width):
                columns.setdefault(place + k, []).append(source[at + k])
        at += width
    result: list[np.ndarray | None] = []
    place = 0
    while columns:
        column = columns.pop(place, [])
        carries = columns.setdefault(place + 1, []) if len(column) > 1 else []
        while len(column) > 2:
            a, b, c = column.pop(), column.pop(), column.pop()
            either = a ^ b
            carries.append((a & b) | (either & c))
            either ^= c
            column.append(either)
        if len(column) == 2:
            carries.append(column[0] & column[1])
            column = [column[0] ^ column[1]]
        result.append(column[0] if column else None)
        place += 1
    return result, constant


def rows_of(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view("u1"), bitorder="little"))


def best_rows(levels: list[np.ndarray | None], candidates: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Rows of the k highest scores; of equal scores the smaller ids."""
    sure, open_ = np.zeros_like(candidates), candidates
    taken, left = 0, int(np.bitwise_count(candidates).sum())
    for level in reversed(levels):
        if level is None or taken + left <= k:
            continue
        ones = open_ & level
        n = int(np.bitwise_count(ones).sum())
        if taken + n <= k:
            sure, taken = sure | ones, taken + n
            open_, left = open_ & ~level, left - n
        else:
            open_, left = ones, n
    boundary = rows_of(open_)
    boundary = boundary[np.argsort(ids[boundary], kind="stable")][: k - taken]
    return np.concatenate([rows_of(sure), boundary])


def _search(index: pa.Table, queries: pa.Table, k: int) -> pa.Table:
    found: list[tuple[int, int, int]] = []
    for block in index.to_pylist() if queries.num_rows else []:
        ids = np.array(block["ids"], "i8")
        words = -(-len(ids) // 64)
        maps = np.frombuffer(block["maps"], "u8").reshape(-1, words)
        negated = ~maps
        every = np.pad(np.packbits(np.ones(len(ids), "u1"), bitorder="little"), (0, 7))[: 8 * words].view("u8")
        for query_id, query in zip(queries["query_id"].to_pylist(), queries["query"].to_pylist()):
            levels, constant = score_maps(query, block["lows"], block["places"], maps, negated)
            candidates = every.copy()
            for row in np.flatnonzero(ids == query_id):
                candidates[row >> 6] &= ~(np.uint64(1) << np.uint64(row & 63))
            for row in best_rows(levels, candidates, ids, k).tolist():
                bits = sum(((int(level[row >> 6]) >> (row & 63)) & 1) << i for i, level in enumerate(levels) if level is not None)
                found.append((query_id, int(ids[row]), max(-(1 << 63), min((1 << 63) - 1, bits + constant))))
    columns = list(zip(*found)) if found else [[], [], []]
    return pa.table([pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"])


def build_index(vectors: DataFrame, block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, int]:
    """One stored row per block of (vec_id, values): block, ids, lows, places, maps; and the number of blocks.

    Every row is indexed. Shorter vectors count as padded with zeros.
    """
    blocks = max(1, math.ceil(vectors.count() / block_rows))

    def run(batches):
        ids, rows = [], []
        for batch in batches:
            ids += batch.column(0).to_pylist()
            rows += batch.column(1).to_pylist()
        if not ids:
            return
        table = np.zeros((len(rows), max(map(len, rows))), "i8")
        for i, row in enumerate(rows):
            table[i, : len(row)] = row
        lows, places, maps = sliced(table)
        yield pa.RecordBatch.from_pydict({
            "block": pa.array([TaskContext.get().partitionId()], pa.int32()), "ids": pa.array([ids], pa.list_(pa.int64())),
            "lows": pa.array([lows], pa.list_(pa.int64())), "places": pa.array([places], pa.list_(pa.int32())),
            "maps": pa.array([maps.tobytes()], pa.binary()),
        })

    dealt = vectors.select("vec_id", "values").repartition(blocks)  # dealt in turn, so all blocks are alike
    index = dealt.mapInArrow(run, "block int, ids array<long>, lows array<long>, places array<int>, maps binary")
    return stored(index, "bitmaps"), blocks


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256, id_column: str = "vec_id",
    vector_column: str = "embedding", block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each row where ``is_query`` holds, the k other rows of the
    highest inner product of floor(scale * x); ties go to smaller ids; fewer if there are fewer rows.

    Rows without id, and vectors that are null or hold null or non-finite components, take no part. Shorter
    vectors count as padded with zeros. Rows with the id of the query are not its results; of several queries
    with one id the least vector asks. An empty table gives no rows. Components beyond 62 bits count as 62
    bits, scores beyond a long as the last long. Other columns are ignored.
    """
    id_, vector = F.col(id_column), F.col(vector_column)
    ready = vectors.filter(id_.isNotNull() & usable(vector))
    values = ready.select(id_.cast("long").alias("vec_id"), quantised(vector, scale).alias("values"))
    queries = (
        ready.filter(is_query).select(id_.cast("long").alias("query_id"), quantised(vector, scale).alias("query"))
        .groupBy("query_id").agg(F.min("query").alias("query"))
    )
    index, blocks = build_index(values, block_rows)
    groups = max(1, math.ceil(queries.count() / query_rows))
    # each group of queries meets each block of the index once
    asked = queries.withColumn("part", F.pmod(F.xxhash64("query_id"), F.lit(groups)).cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    held = index.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    found = held.groupBy("block", "part").cogroup(asked.groupBy("block", "part")).applyInArrow(
        lambda left, right: _search(left, right, k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
