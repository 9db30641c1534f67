"""Moving statistics over ordered series. A series has one row per date, so its length is bounded."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def rolling_mean(value: str, window: int, series: Sequence[str], order: Sequence[Column]) -> Column:
    """Centred mean over ``window`` rows, at least one value; null where the row itself is null."""
    frame = Window.partitionBy(*series).orderBy(*order).rowsBetween(-(window // 2), (window - 1) // 2)
    return F.when(F.col(value).isNotNull(), F.avg(value).over(frame))


def period_sum_to_date(value: str, series: Sequence[str], period: str, order: Sequence[Column]) -> Column:
    """Running sum inside a period; null rows stay null and add nothing."""
    frame = Window.partitionBy(*series, period).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return F.when(F.col(value).isNotNull(), F.sum(value).over(frame))


def ewma(
    df: DataFrame, value: str, span: int, series: Sequence[str], order: Sequence[Column], alias: str
) -> DataFrame:
    """Exponentially weighted mean with weights that add up to one; gaps decay, null rows stay null.

    The series is cut into blocks so long that anything older than one whole block weighs less than
    1e-17. Each row also joins the next block as history, and two running sums per block pair give
    the mean: linear work, and exponents that cannot overflow.
    """
    decay = 1 - 2.0 / (span + 1)
    if decay <= 0:
        return df.withColumn(alias, F.col(value).cast("double"))
    block = max(1, math.ceil(math.log(1e-17) / math.log(decay)))
    step = -math.log(decay)
    placed = df.withColumn("_pos", F.row_number().over(Window.partitionBy(*series).orderBy(*order)) - 1)
    home = F.floor(F.col("_pos") / block).cast("int")
    copies = placed.withColumn("_home", home).withColumn("_block", F.explode(F.array(home, home + 1)))
    growth = F.exp((F.col("_pos") - F.col("_block") * block) * F.lit(step))
    present = F.col(value).isNotNull()
    run = Window.partitionBy(*series, "_block").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    mean = F.sum(F.when(present, growth * F.col(value))).over(run) / F.sum(F.when(present, growth)).over(run)
    return (
        copies.withColumn(alias, F.when(present, mean))
        .filter("_block = _home")
        .drop("_pos", "_home", "_block")
    )
