"""Daily editorial metrics and the combined actual/forecast table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegralType

from deskmatch.functions import dates
from deskmatch.functions.text import rounded_integer
from deskmatch.operators.median import exact_median
from deskmatch.operators.series import ewma, period_sum_to_date, rolling_mean
from deskmatch.plans.submissions import INITIAL_STAGE

# fixed values: window lengths of the combined table and the opened range of month offsets
ROLLING_WINDOW = 30
EWMA_SPAN = 30
MONTH_OFFSETS = 12


def daily_distinct(rows: DataFrame, stamp: Column | str, counted: str, day: str, alias: str) -> DataFrame:
    """Distinct values per calendar day. Spark counts on (day, value) first, so a busy day is spread."""
    stamp = F.col(stamp) if isinstance(stamp, str) else stamp
    return rows.groupBy(F.to_date(stamp).alias(day)).agg(F.countDistinct(counted).alias(alias))


def initial_submissions_by_day(versions: DataFrame, as_of: Column) -> DataFrame:
    first_initial = versions.filter(
        (F.col("Overall_Stage") == INITIAL_STAGE)
        & (F.col("Position_In_Overall_Stage") == 1)
        & (F.to_date("QC_Complete_Timestamp") < F.to_date(as_of))
    )
    return daily_distinct(
        first_initial, "QC_Complete_Timestamp", "Manuscript_ID", "initial_submission_date", "manuscript_count"
    )


def daily_median(rows: DataFrame, stamp: Column, value: Column, day: str, alias: str) -> DataFrame:
    """Median per calendar day as an integer, halves away from zero."""
    picked = rows.select(F.to_date(stamp).alias(day), value.cast("double").alias("_value"))
    return exact_median(picked, [day], "_value", alias).withColumn(alias, rounded_integer(alias))


def first_decision_by_day(processing: DataFrame, as_of: Column) -> DataFrame:
    stamp = F.col("First_Full_Submission.Decision_Sent_Timestamp")
    value = F.col("Full_Submission_Received_To_First_Full_Decision")
    rows = processing.filter((F.to_date(stamp) <= F.to_date(as_of)) & value.isNotNull())
    return daily_median(rows, stamp, value, "Full_Decision_Sent_Date", "Full_Submission_Received_To_First_Full_Decision")


def accept_to_record_by_day(processing: DataFrame, as_of: Column) -> DataFrame:
    """Rows are kept when the *other* measure is known, so a day's median may be null."""
    stamp = F.col("Publication.VOR_Timestamp")
    rows = processing.filter(
        (F.to_date(stamp) <= F.to_date(as_of)) & F.col("Full_Submission_Received_To_First_Full_Decision").isNotNull()
    )
    return daily_median(rows, stamp, F.col("Accept_Decision_To_VOR"), "VOR_Date", "Accept_Decision_To_VOR")


def as_series(daily: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    """Checks the shape of a daily metric (a date and an integer besides the series keys) and renames
    its columns to ``ds`` and ``y``."""
    rest = [f for f in daily.schema.fields if f.name not in series]
    if len(rest) != 2:
        raise ValueError(f"expected a date and a value, got {[f.name for f in rest]}")
    day, value = rest
    if not isinstance(day.dataType, DateType):
        raise ValueError(f"{day.name} must be a date")
    if not isinstance(value.dataType, IntegralType):
        raise ValueError(f"{value.name} must be an integer")
    return daily.select(*series, F.col(day.name).alias("ds"), F.col(value.name).alias("y"))


def actual_table(
    actual: DataFrame, series: Sequence[str], window: int = ROLLING_WINDOW, span: int = EWMA_SPAN,
    newest_first: bool = False,
) -> DataFrame:
    """Actual values with both averages. ``newest_first`` runs the averages backwards in time."""
    order = [F.col("Date").desc() if newest_first else F.col("Date").asc()]
    table = actual.select(*series, F.col("ds").alias("Date"), F.col("y").alias("Actual_Value"))
    table = table.withColumn("Actual_Rolling_Average_Value", rolling_mean("Actual_Value", window, series, order))
    return ewma(table, "Actual_Value", span, series, order, "Actual_Ewma_Value")


def opening_balances(actual: DataFrame, starts: DataFrame, series: Sequence[str]) -> DataFrame:
    """Actual sums of the month, quarter and year the prediction starts in, and of the quarter window
    that begins with that month, per series."""
    first_day = F.col("prediction_start")
    month, quarter, year = (dates.month_start(first_day), dates.quarter_start(first_day), dates.year_start(first_day))

    def total(condition, alias):
        return F.coalesce(F.sum(F.when(condition, F.col("y"))), F.lit(0)).alias(alias)

    joined = starts.join(actual, list(series), "left")
    return joined.groupBy(*series, "prediction_start").agg(
        total(dates.in_month("ds", month), "month_opening"),
        total(dates.in_quarter("ds", month), "month_quarter_opening"),
        total(dates.in_quarter("ds", quarter), "quarter_opening"),
        total(dates.in_year("ds", year), "year_opening"),
    )


def forecast_table(
    actual: DataFrame, forecast: DataFrame, series: Sequence[str], model: str,
    window: int = ROLLING_WINDOW, span: int = EWMA_SPAN, quarter_as_month: bool = False,
) -> DataFrame:
    """Rounded forecast with averages and opening balances added to each series' first day.

    ``quarter_as_month`` adds the three months from the month start to the month column, not the month.
    """
    starts = forecast.groupBy(*series).agg(F.min("ds").alias("prediction_start"))
    balances = opening_balances(actual, starts, series)
    order = [F.col("Date").asc()]
    rounded = forecast.select(
        *series,
        F.col("ds").alias("Date"),
        *[
            F.bround(source, 0).cast("int").alias(target)
            for source, target in (
                ("yhat_lower", "Forecast_Lower_Bound_Value"),
                ("yhat", "Forecast_Value"),
                ("yhat_upper", "Forecast_Upper_Bound_Value"),
            )
        ],
    )
    table = rounded.withColumn("Forecast_Rolling_Average_Value", rolling_mean("Forecast_Value", window, series, order))
    table = ewma(table, "Forecast_Value", span, series, order, "Forecast_Ewma_Value").join(balances, list(series))
    opened = F.col("Date") == F.col("prediction_start")
    month = "month_quarter_opening" if quarter_as_month else "month_opening"
    for alias, opening in (
        ("Forecast_Month_Offset_Value", month),
        ("Forecast_Quarter_Offset_Value", "quarter_opening"),
        ("Forecast_Year_Offset_Value", "year_opening"),
    ):
        table = table.withColumn(
            alias, F.col("Forecast_Value") + F.when(opened, F.col(opening)).otherwise(F.lit(0))
        )
    return table.withColumn("Forecast_Date", dates.iso_date("Date")).withColumn("Model", F.lit(model)).drop(
        "month_opening", "month_quarter_opening", "quarter_opening", "year_opening"
    )


def combined_table(actual: DataFrame, forecast: DataFrame, series: Sequence[str]) -> DataFrame:
    """Outer join of :func:`actual_table` and :func:`forecast_table` on the date, with period starts,
    running period sums of the actual values, and a flag for the quarter the prediction starts in."""
    keys = [*series, "Date"]
    starts = forecast.groupBy(*series).agg(F.first("prediction_start").alias("_start"))
    table = forecast.drop("prediction_start").join(actual, keys, "full").join(starts, list(series), "left")
    day = F.col("_day")
    table = table.withColumnRenamed("Date", "_day").withColumns({
        "Date": dates.iso_date(day),
        "Actual_Or_Forecast_Value": F.coalesce("Actual_Value", "Forecast_Value"),
        "Date_Timestamp": dates.iso_midnight(day),
        "Month_Start_Date": dates.iso_date(dates.month_start(day)),
        "Quarter_Start_Date": dates.iso_date(dates.quarter_start(day)),
        "Year_Start_Date": dates.iso_date(dates.year_start(day)),
        "Quarter_Week_Date": dates.iso_date(dates.quarter_week(day)),
        "Is_Current_Quarter": dates.quarter_start(day) == dates.quarter_start("_start"),
    })
    for period in ("Month", "Quarter", "Year"):
        table = table.withColumn(
            f"Actual_{period}_Cumsum_Value",
            period_sum_to_date("Actual_Value", series, f"{period}_Start_Date", [F.col("Date").asc()]),
        )
    return table.drop("_day", "_start")


def period_sums(actual: DataFrame, forecast: DataFrame, series: Sequence[str]) -> DataFrame:
    """Sums of actual and forecast values for each of the 25 months around the prediction start, its
    quarter and its year: (series, period, start, actual_sum, forecast_sum)."""
    start = forecast.groupBy(*series).agg(F.min("ds").alias("_start"))
    offsets = F.sequence(F.lit(-MONTH_OFFSETS), F.lit(MONTH_OFFSETS))

    def entry(kind, begin, months):
        return F.struct(F.lit(kind).alias("period"), begin.alias("start"), F.add_months(begin, months).alias("end"))

    first_day = F.col("_start")
    months = F.transform(offsets, lambda n: entry("month", F.add_months(dates.month_start(first_day), n), 1))
    wider = F.array(
        entry("quarter", dates.quarter_start(first_day), 3), entry("year", dates.year_start(first_day), 12)
    )
    wanted = start.select(*series, F.explode(F.concat(months, wider)).alias("_p")).select(*series, "_p.*")
    sides = actual.select(*series, "ds", F.col("y").cast("double").alias("_a"), F.lit(None).cast("double").alias("_f"))
    sides = sides.unionByName(
        forecast.select(*series, "ds", F.lit(None).cast("double").alias("_a"), F.col("yhat").alias("_f"))
    )
    # sums per month first: three months or twelve of them make up the wider periods
    monthly = sides.groupBy(*series, dates.month_start("ds").alias("_month")).agg(
        F.sum("_a").alias("_a"), F.sum("_f").alias("_f")
    )
    reach = F.months_between(F.col("end"), F.col("start")).cast("int") - 1
    spread = wanted.withColumn("_n", F.explode(F.sequence(F.lit(0), reach))).withColumn(
        "_month", F.add_months("start", F.col("_n"))
    )
    return spread.join(monthly, [*series, "_month"], "left").groupBy(*series, "period", "start").agg(
        F.coalesce(F.sum("_a"), F.lit(0.0)).alias("actual_sum"),
        F.coalesce(F.sum("_f"), F.lit(0.0)).alias("forecast_sum"),
    )
