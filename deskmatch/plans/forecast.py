"""Additive forecast of daily series: linear trend, weekday and month effects, constant-width bounds.

Every part is a grouped sum, so many series are fitted in one job. The numbers are those of this
model, not of a Bayesian solver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODEL_NAME = "additive"
# fixed values: days ahead and the normal quantile of an 80 % interval
FORECAST_DAYS = 396
INTERVAL_Z = 1.2815515655446004


def forecast_days(actual: DataFrame, series: Sequence[str], days: int = FORECAST_DAYS) -> DataFrame:
    """The ``days`` dates after each series' last one."""
    last = actual.groupBy(*series).agg(F.max("ds").alias("_last"))
    ahead = F.sequence(F.date_add("_last", 1), F.date_add("_last", days))
    return last.select(*series, F.explode(ahead).alias("ds"))


def additive_forecast(actual: DataFrame, series: Sequence[str], days: int = FORECAST_DAYS) -> DataFrame:
    """(series, ds, yhat_lower, yhat, yhat_upper) for the days after the last actual one."""
    keys = list(series)
    known = actual.filter(F.col("y").isNotNull())
    origin = known.groupBy(*keys).agg(F.min("ds").alias("_origin"), F.avg(F.col("y").cast("double")).alias("_level"))
    placed = known.join(origin, keys).withColumn("_t", F.datediff("ds", "_origin").cast("double"))
    placed = placed.withColumn("_y", F.col("y").cast("double"))
    trend = placed.groupBy(*keys, "_origin").agg(
        F.coalesce(F.regr_slope("_y", "_t"), F.lit(0.0)).alias("_slope"),
        F.coalesce(F.regr_intercept("_y", "_t"), F.first("_level")).alias("_intercept"),
    )

    def detrended(rows):
        elapsed = F.datediff("ds", "_origin").cast("double")
        return rows.join(trend, keys).withColumn("_trend", F.col("_intercept") + F.col("_slope") * elapsed)

    weekday, month = F.dayofweek("ds").alias("_weekday"), F.month("ds").alias("_month")
    residual = detrended(known).select(*keys, weekday, month, (F.col("y") - F.col("_trend")).alias("_r"))
    by_weekday = residual.groupBy(*keys, "_weekday").agg(F.avg("_r").alias("_weekday_effect"))
    residual = residual.join(by_weekday, [*keys, "_weekday"]).withColumn("_r", F.col("_r") - F.col("_weekday_effect"))
    by_month = residual.groupBy(*keys, "_month").agg(F.avg("_r").alias("_month_effect"))
    residual = residual.join(by_month, [*keys, "_month"]).withColumn("_r", F.col("_r") - F.col("_month_effect"))
    spread = residual.groupBy(*keys).agg(F.coalesce(F.stddev_samp("_r"), F.lit(0.0)).alias("_sigma"))

    ahead = detrended(forecast_days(known, series, days)).withColumns({"_weekday": weekday, "_month": month})
    ahead = ahead.join(by_weekday, [*keys, "_weekday"], "left").join(by_month, [*keys, "_month"], "left")
    ahead = ahead.join(spread, keys)
    none = F.lit(0.0)
    yhat = F.col("_trend") + F.coalesce("_weekday_effect", none) + F.coalesce("_month_effect", none)
    margin = F.lit(INTERVAL_Z) * F.col("_sigma")
    return ahead.select(
        *keys, "ds", (yhat - margin).alias("yhat_lower"), yhat.alias("yhat"), (yhat + margin).alias("yhat_upper")
    )
