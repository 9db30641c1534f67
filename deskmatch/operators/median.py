"""Exact medians that hold up when one group has most of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from deskmatch.operators.scale import materialise

SKETCH_ACCURACY = 10_000
BRACKET = 10.0 / SKETCH_ACCURACY
#: zones into which the bracket around the middle is cut
ZONES = 40


def exact_median(
    df: DataFrame, keys: Sequence[str], value: str, alias: str, accuracy: int = SKETCH_ACCURACY
) -> DataFrame:
    """Interpolated median per group, null when the group has no value.

    A mergeable quantile sketch brackets the middle of each group and cuts the bracket into zones. Values outside
    are only counted, values inside are counted per distinct value. A running count over the zones, at most a few
    dozen rows per group, finds the zones of the two middle ranks, and a second one the values inside these. So no
    task sees more of a group in order than one zone of it, and the data are read twice. Only where the middle of
    a group lies outside its bracket, that group is counted once more without one.
    """
    data = df.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(value).cast("double").alias("_v"))
    names = [f"_k{i}" for i in range(len(keys))]
    bracket = max(BRACKET, 10.0 / accuracy)
    low, high = max(0.0, 0.5 - bracket), min(1.0, 0.5 + bracket)
    probes = F.array(*[F.lit(low + (high - low) * i / ZONES) for i in range(ZONES + 1)])
    sketch = materialise(
        data.groupBy(*names).agg(F.percentile_approx("_v", probes, accuracy).alias("_q"), F.count("_v").alias("_n")), "sketch")
    found = materialise(_middles(data, sketch, names), "middles")
    missed = found.filter((F.col("_n") > 0) & (F.col("_lo").isNull() | F.col("_hi").isNull()))
    if not missed.isEmpty():
        # the whole range of such a group is its bracket
        wide = F.array(F.lit(float("-inf")), *[F.get("_q", F.lit(i)) for i in range(ZONES + 1)], F.lit(float("nan")))
        again = _joined(sketch, missed.select(*names), names).select(*names, wide.alias("_q"), "_n")
        rest = _joined(data, again.select(*names), names)
        found = _joined(found, again.select(*names), names, "left_anti").unionByName(_middles(rest, again, names))
    return found.select(*[F.col(n).alias(k) for n, k in zip(names, keys)], _halfway("_lo", "_hi").alias(alias))


def _halfway(low: str, high: str) -> Column:
    """Mean of two values as they are written: 28.74 and 31.36 have 30.05 between them, where the sum of the binary numbers
    falls short of it and would be displayed as 30.0. Values that are no decimal of ten places keep the binary mean."""
    exact = [F.col(c).try_cast("decimal(28,10)") for c in (low, high)]
    written = (exact[0].cast("double") == F.col(low)) & (exact[1].cast("double") == F.col(high))
    return F.when(written, ((exact[0] + exact[1]) / 2).cast("double")).otherwise((F.col(low) + F.col(high)) / 2)


def _joined(left: DataFrame, right: DataFrame, names: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which null keys are equal; the columns of ``right`` other than the keys are added."""
    side = right.withColumnsRenamed({n: f"{n}r" for n in names})
    same = reduce(lambda a, b: a & b, [F.col(n).eqNullSafe(F.col(f"{n}r")) for n in names], F.lit(True))
    return left.join(side, same, how).drop(*[f"{n}r" for n in names])


def _middles(data: DataFrame, sketch: DataFrame, names: Sequence[str]) -> DataFrame:
    """(keys, _n, _lo, _hi): the two middle values of each group of the sketch, null where they lie outside ``_q``."""
    boundaries = F.size("_q")
    zone = F.size(F.filter("_q", lambda x: x <= F.col("_v")))  # 0: below the first boundary
    zone = F.when((zone == boundaries) & (F.col("_v") > F.element_at("_q", -1)), boundaries + 1).otherwise(zone)
    inside = (F.col("_zone") > 0) & (F.col("_zone") <= boundaries)
    zoned = _joined(data.filter(F.col("_v").isNotNull()), sketch.select(*names, "_q"), names).withColumn("_zone", zone)
    counted = materialise(
        zoned.groupBy(*names, "_zone", F.when(inside, F.col("_v")).alias("_v")).agg(F.count(F.lit(1)).alias("_w")), "counted")
    sums = counted.groupBy(*names, "_zone").agg(F.sum("_w").alias("_w"))
    up_to = Window.partitionBy(*names, F.lit(0)).orderBy("_zone").rowsBetween(Window.unboundedPreceding, 0)
    zones = _joined(sums.withColumn("_end", F.sum("_w").over(up_to)), sketch.select(*names, "_n"), names)
    ranks = F.array(F.struct(F.lit("_lo").alias("side"), F.expr("(_n + 1) div 2").alias("rank")),
                    F.struct(F.lit("_hi").alias("side"), F.expr("_n div 2 + 1").alias("rank")))
    wanted = zones.select(*names, "_zone", (F.col("_end") - F.col("_w")).alias("_before"), "_end", F.explode(ranks).alias("_r")).filter(
        _covers(F.col("_before"), F.col("_end"), F.col("_r.rank")))
    picked = _joined(
        counted.filter(F.col("_v").isNotNull()), wanted.select(*names, F.col("_zone").alias("_at"), "_before", "_r"), names
    ).filter("_zone = _at")
    inner = Window.partitionBy(*names, "_zone", "_r.side").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = picked.withColumn("_end", F.col("_before") + F.sum("_w").over(inner))
    hits = ranked.filter(_covers(F.col("_end") - F.col("_w"), F.col("_end"), F.col("_r.rank")))
    values = hits.groupBy(*names).agg(*[F.max(F.when(F.col("_r.side") == s, F.col("_v"))).alias(s) for s in ("_lo", "_hi")])
    return _joined(sketch.select(*names, "_n"), values, names, "left")


def _covers(before: Column, end: Column, rank: Column) -> Column:
    return (before < rank) & (rank <= end)
