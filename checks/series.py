"""Daily metrics, moving averages, forecasts and person figures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.common import rounded, table
from deskmatch.operators.scale import materialise
from deskmatch.operators.series import ewma, period_sum_to_date, rolling_mean
from deskmatch.plans import daily, forecast, stats

SERIES = ["o_orderstatus"]


def daily_count(spark, sf_dir) -> DataFrame:
    """Distinct customers with a first order per day before the given date."""
    orders = table(spark, sf_dir, "orders")
    versions = orders.select(
        F.col("o_custkey").alias("Manuscript_ID"),
        F.when(F.col("o_orderstatus") != "P", "Initial Submission").otherwise("Full Submission").alias("Overall_Stage"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("Position_In_Overall_Stage"),
        F.col("o_orderdate").alias("QC_Complete_Timestamp"),
    )
    return daily.initial_submissions_by_day(versions, F.lit("2001-01-01").cast("timestamp"))


DAILY_COUNT_SQL = """SELECT o_orderdate::DATE AS initial_submission_date, count(DISTINCT o_custkey) AS manuscript_count
FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority LIKE '1%' AND o_orderdate < DATE '2001-01-01' GROUP BY 1"""


def _processing(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.struct(F.col("l_shipdate").alias("VOR_Timestamp")).alias("Publication"),
        F.struct(F.col("l_shipdate").alias("Decision_Sent_Timestamp")).alias("First_Full_Submission"),
        F.when(F.col("l_returnflag") != "A", F.col("l_quantity")).alias("Accept_Decision_To_VOR"),
        F.when(F.col("l_discount") > 0.02, F.col("l_extendedprice")).alias(
            "Full_Submission_Received_To_First_Full_Decision"
        ),
    )


def daily_median(spark, sf_dir) -> DataFrame:
    return daily.accept_to_record_by_day(_processing(spark, sf_dir), F.lit("2001-01-01").cast("timestamp"))


def daily_median_decision(spark, sf_dir) -> DataFrame:
    return daily.first_decision_by_day(_processing(spark, sf_dir), F.lit("2001-01-01").cast("timestamp"))


MEDIAN_SQL = """SELECT l_shipdate::DATE AS VOR_Date,
  round(quantile_cont(CASE WHEN l_returnflag <> 'A' THEN l_quantity END, 0.5))::BIGINT AS Accept_Decision_To_VOR
FROM lineitem WHERE l_shipdate::DATE <= DATE '2001-01-01' AND l_discount > 0.02 GROUP BY 1"""
DECISION_SQL = """SELECT l_shipdate::DATE AS Full_Decision_Sent_Date,
  round(quantile_cont(l_extendedprice, 0.5))::BIGINT AS Full_Submission_Received_To_First_Full_Decision
FROM lineitem WHERE l_shipdate::DATE <= DATE '2001-01-01' AND l_discount > 0.02 GROUP BY 1"""


def _actual(spark, sf_dir) -> DataFrame:
    """Orders per day and status."""
    counted = table(spark, sf_dir, "orders").groupBy("o_orderstatus", F.to_date("o_orderdate").alias("day")).agg(
        F.count(F.lit(1)).alias("orders")
    )
    return daily.as_series(counted, SERIES)


ACTUAL = """
actual AS (SELECT o_orderstatus, o_orderdate::DATE AS ds, count(*) AS y FROM orders GROUP BY ALL)"""


def _gapped(spark, sf_dir) -> DataFrame:
    """The same series with days of a single order made unknown."""
    return _actual(spark, sf_dir).withColumn("y", F.nullif("y", F.lit(1)))


GAPPED = f"{ACTUAL}, gapped AS (SELECT o_orderstatus, ds, nullif(y, 1) AS y FROM actual)"


def rolling_average(spark, sf_dir) -> DataFrame:
    return _gapped(spark, sf_dir).select(
        "o_orderstatus", "ds",
        F.round(rolling_mean("y", 30, SERIES, [F.col("ds").asc()]), 6).alias("mean30"),
        F.round(rolling_mean("y", 7, SERIES, [F.col("ds").asc()]), 6).alias("mean7"),
    )


ROLLING_SQL = f"""WITH {GAPPED}
SELECT o_orderstatus, ds,
  CASE WHEN y IS NOT NULL THEN round(avg(y) OVER (PARTITION BY o_orderstatus ORDER BY ds
    ROWS BETWEEN 15 PRECEDING AND 14 FOLLOWING), 6) END AS mean30,
  CASE WHEN y IS NOT NULL THEN round(avg(y) OVER (PARTITION BY o_orderstatus ORDER BY ds
    ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING), 6) END AS mean7
FROM gapped"""


def ewma_average(spark, sf_dir) -> DataFrame:
    """Forwards and, as for series read newest first, backwards in time."""
    forward = ewma(_gapped(spark, sf_dir), "y", 30, SERIES, [F.col("ds").asc()], "forward")
    both = ewma(forward, "y", 30, SERIES, [F.col("ds").desc()], "backward")
    return both.select("o_orderstatus", "ds", rounded("forward"), rounded("backward"))


EWMA_SQL = f"""WITH {GAPPED},
placed AS (
  SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY ds) AS a,
            row_number() OVER (PARTITION BY o_orderstatus ORDER BY ds DESC) AS b
  FROM gapped
)
SELECT o_orderstatus, ds,
  CASE WHEN y IS NOT NULL THEN round(
    sum(y * pow(31.0 / 29.0, a)) OVER (PARTITION BY o_orderstatus ORDER BY a)
    / sum(CASE WHEN y IS NOT NULL THEN pow(31.0 / 29.0, a) END) OVER (PARTITION BY o_orderstatus ORDER BY a), 6) END AS forward,
  CASE WHEN y IS NOT NULL THEN round(
    sum(y * pow(31.0 / 29.0, b)) OVER (PARTITION BY o_orderstatus ORDER BY b)
    / sum(CASE WHEN y IS NOT NULL THEN pow(31.0 / 29.0, b) END) OVER (PARTITION BY o_orderstatus ORDER BY b), 6) END AS backward
FROM placed"""


def period_to_date(spark, sf_dir) -> DataFrame:
    from deskmatch.functions import dates

    rows = _gapped(spark, sf_dir).withColumns({
        "month": dates.month_start("ds"), "quarter": dates.quarter_start("ds"), "year": dates.year_start("ds"),
        "week": dates.week_start("ds"), "quarter_week": dates.quarter_week("ds"),
    })
    order = [F.col("ds").asc()]
    return rows.select(
        "*", *[period_sum_to_date("y", SERIES, p, order).alias(f"{p}_sum") for p in ("month", "quarter", "year")]
    )


PERIOD_SQL = f"""WITH {GAPPED}
SELECT o_orderstatus, ds, y, date_trunc('month', ds)::DATE AS month, date_trunc('quarter', ds)::DATE AS quarter,
  date_trunc('year', ds)::DATE AS year, date_trunc('week', ds)::DATE AS week,
  greatest(date_trunc('week', ds), date_trunc('quarter', ds))::DATE AS quarter_week,
  CASE WHEN y IS NOT NULL THEN sum(y) OVER (PARTITION BY o_orderstatus, date_trunc('month', ds) ORDER BY ds) END::BIGINT AS month_sum,
  CASE WHEN y IS NOT NULL THEN sum(y) OVER (PARTITION BY o_orderstatus, date_trunc('quarter', ds) ORDER BY ds) END::BIGINT AS quarter_sum,
  CASE WHEN y IS NOT NULL THEN sum(y) OVER (PARTITION BY o_orderstatus, date_trunc('year', ds) ORDER BY ds) END::BIGINT AS year_sum
FROM gapped"""


def forecast_additive(spark, sf_dir) -> DataFrame:
    ahead = forecast.additive_forecast(_actual(spark, sf_dir), SERIES)
    return ahead.select("o_orderstatus", "ds", *[rounded(c, 5) for c in ("yhat_lower", "yhat", "yhat_upper")])


FORECAST = f"""{ACTUAL},
origin AS (SELECT o_orderstatus, min(ds) AS t0, max(ds) AS last FROM actual GROUP BY ALL),
trend AS (
  SELECT o_orderstatus, t0, last, regr_slope(y, datediff('day', t0, ds)) AS b, regr_intercept(y, datediff('day', t0, ds)) AS a
  FROM actual JOIN origin USING (o_orderstatus) GROUP BY ALL
),
r1 AS (SELECT o_orderstatus, ds, dayofweek(ds) AS wd, month(ds) AS mo, y - (a + b * datediff('day', t0, ds)) AS r
       FROM actual JOIN trend USING (o_orderstatus)),
wk AS (SELECT o_orderstatus, wd, avg(r) AS we FROM r1 GROUP BY ALL),
r2 AS (SELECT r1.o_orderstatus, ds, mo, r - we AS r FROM r1 JOIN wk USING (o_orderstatus, wd)),
mn AS (SELECT o_orderstatus, mo, avg(r) AS me FROM r2 GROUP BY ALL),
sg AS (SELECT o_orderstatus, stddev_samp(r - me) AS s FROM r2 JOIN mn USING (o_orderstatus, mo) GROUP BY ALL),
days AS (SELECT o_orderstatus, a, b, t0, (last + n::INT)::DATE AS ds FROM trend CROSS JOIN range(1, 397) t(n)),
ahead AS (
  SELECT d.o_orderstatus, d.ds, a + b * datediff('day', t0, ds) + we + me AS yhat, 1.2815515655446004 * s AS margin
  FROM days d JOIN wk ON wk.o_orderstatus = d.o_orderstatus AND wk.wd = dayofweek(ds)
  JOIN mn ON mn.o_orderstatus = d.o_orderstatus AND mn.mo = month(ds)
  JOIN sg ON sg.o_orderstatus = d.o_orderstatus
)"""
FORECAST_SQL = f"""WITH {FORECAST}
SELECT o_orderstatus, ds, round(yhat - margin, 5) AS yhat_lower, round(yhat, 5) AS yhat, round(yhat + margin, 5) AS yhat_upper
FROM ahead"""


def actual_forecast_merge(spark, sf_dir) -> DataFrame:
    """The combined table with all of its columns."""
    actual = materialise(_actual(spark, sf_dir), "series")
    ahead = materialise(forecast.additive_forecast(actual, SERIES), "forecast")
    merged = daily.combined_table(
        daily.actual_table(actual, SERIES), daily.forecast_table(actual, ahead, SERIES, forecast.MODEL_NAME), SERIES
    )
    decimals = {"Forecast_Rolling_Average_Value", "Forecast_Ewma_Value", "Actual_Rolling_Average_Value",
                "Actual_Ewma_Value"}
    return merged.select(*[rounded(c, 5) if c in decimals else F.col(c) for c in merged.columns])


def _ewma_sql(value: str, position: str, keys: str) -> str:
    weight = f"pow(31.0 / 29.0, {position})"
    over = f"OVER (PARTITION BY {keys} ORDER BY {position})"
    return (f"CASE WHEN {value} IS NOT NULL THEN round(sum({value} * {weight}) {over} / sum(CASE WHEN {value} IS NOT NULL"
            f" THEN {weight} END) {over}, 5) END")


MERGE_SQL = f"""WITH {FORECAST},
f0 AS (
  SELECT o_orderstatus, ds, row_number() OVER (PARTITION BY o_orderstatus ORDER BY ds) AS n,
    round_even(yhat - margin, 0)::INT AS lo, round_even(yhat, 0)::INT AS v, round_even(yhat + margin, 0)::INT AS hi
  FROM ahead
),
starts AS (SELECT o_orderstatus, min(ds) AS p FROM f0 GROUP BY ALL),
opening AS (
  SELECT s.o_orderstatus, p,
    coalesce(sum(y) FILTER (date_trunc('month', ds) = date_trunc('month', p)), 0)::BIGINT AS m,
    coalesce(sum(y) FILTER (date_trunc('quarter', ds) = date_trunc('quarter', p)), 0)::BIGINT AS q,
    coalesce(sum(y) FILTER (date_trunc('year', ds) = date_trunc('year', p)), 0)::BIGINT AS yr
  FROM starts s JOIN actual a ON a.o_orderstatus = s.o_orderstatus GROUP BY ALL
),
f AS (
  SELECT f0.*, p, v + CASE WHEN n = 1 THEN m ELSE 0 END AS mo, v + CASE WHEN n = 1 THEN q ELSE 0 END AS qo,
    v + CASE WHEN n = 1 THEN yr ELSE 0 END AS yo,
    round(avg(v) OVER (PARTITION BY f0.o_orderstatus ORDER BY ds ROWS BETWEEN 15 PRECEDING AND 14 FOLLOWING), 5) AS roll,
    {_ewma_sql('v', 'n', 'f0.o_orderstatus')} AS ew
  FROM f0 JOIN opening o ON o.o_orderstatus = f0.o_orderstatus
),
a0 AS (SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY ds) AS n FROM actual),
a AS (
  SELECT *, round(avg(y) OVER (PARTITION BY o_orderstatus ORDER BY ds ROWS BETWEEN 15 PRECEDING AND 14 FOLLOWING), 5) AS roll,
    {_ewma_sql('y', 'n', 'o_orderstatus')} AS ew
  FROM a0
),
j AS (
  SELECT coalesce(f.o_orderstatus, a.o_orderstatus) AS o_orderstatus, coalesce(f.ds, a.ds) AS d, f.ds AS fd, f.lo, f.v, f.hi,
    f.roll AS froll, f.ew AS few, f.mo, f.qo, f.yo, a.y, a.roll AS aroll, a.ew AS aew
  FROM f FULL JOIN a ON f.o_orderstatus = a.o_orderstatus AND f.ds = a.ds
)
SELECT j.o_orderstatus, strftime(fd, '%Y-%m-%d') AS Forecast_Date, lo AS Forecast_Lower_Bound_Value, v AS Forecast_Value,
  hi AS Forecast_Upper_Bound_Value, froll AS Forecast_Rolling_Average_Value, few AS Forecast_Ewma_Value,
  mo AS Forecast_Month_Offset_Value, qo AS Forecast_Quarter_Offset_Value, yo AS Forecast_Year_Offset_Value,
  strftime(d, '%Y-%m-%d') AS Date, CASE WHEN fd IS NOT NULL THEN 'additive' END AS Model, y AS Actual_Value,
  aroll AS Actual_Rolling_Average_Value, aew AS Actual_Ewma_Value, coalesce(y, v) AS Actual_Or_Forecast_Value,
  strftime(d, '%Y-%m-%dT00:00:00Z') AS Date_Timestamp, strftime(date_trunc('month', d), '%Y-%m-%d') AS Month_Start_Date,
  strftime(date_trunc('quarter', d), '%Y-%m-%d') AS Quarter_Start_Date,
  strftime(date_trunc('year', d), '%Y-%m-%d') AS Year_Start_Date,
  strftime(greatest(date_trunc('week', d), date_trunc('quarter', d)), '%Y-%m-%d') AS Quarter_Week_Date,
  date_trunc('quarter', d) = date_trunc('quarter', p) AS Is_Current_Quarter,
  CASE WHEN y IS NOT NULL THEN sum(y) OVER (PARTITION BY j.o_orderstatus, date_trunc('month', d) ORDER BY d) END::BIGINT AS Actual_Month_Cumsum_Value,
  CASE WHEN y IS NOT NULL THEN sum(y) OVER (PARTITION BY j.o_orderstatus, date_trunc('quarter', d) ORDER BY d) END::BIGINT AS Actual_Quarter_Cumsum_Value,
  CASE WHEN y IS NOT NULL THEN sum(y) OVER (PARTITION BY j.o_orderstatus, date_trunc('year', d) ORDER BY d) END::BIGINT AS Actual_Year_Cumsum_Value
FROM j JOIN starts s ON s.o_orderstatus = j.o_orderstatus"""


def period_totals(spark, sf_dir) -> DataFrame:
    actual = _actual(spark, sf_dir)
    sums = daily.period_sums(actual, forecast.additive_forecast(actual, SERIES), SERIES)
    return sums.select("o_orderstatus", "period", "start", rounded("actual_sum"), rounded("forecast_sum", 4))


TOTALS_SQL = f"""WITH {FORECAST},
starts AS (SELECT o_orderstatus, min(ds) AS p FROM ahead GROUP BY ALL),
wanted AS (
  SELECT o_orderstatus, 'month' AS period, (date_trunc('month', p) + to_months(n::INT))::DATE AS s,
         (date_trunc('month', p) + to_months(n::INT + 1))::DATE AS e FROM starts CROSS JOIN range(-12, 13) t(n)
  UNION ALL SELECT o_orderstatus, 'quarter', date_trunc('quarter', p)::DATE, (date_trunc('quarter', p) + INTERVAL 3 MONTH)::DATE FROM starts
  UNION ALL SELECT o_orderstatus, 'year', date_trunc('year', p)::DATE, (date_trunc('year', p) + INTERVAL 12 MONTH)::DATE FROM starts
),
both_sides AS (SELECT o_orderstatus, ds, y::DOUBLE AS a, 0.0::DOUBLE AS f FROM actual UNION ALL SELECT o_orderstatus, ds, 0.0, yhat FROM ahead)
SELECT w.o_orderstatus, period, s AS start, round(coalesce(sum(a), 0), 6) AS actual_sum, round(coalesce(sum(f), 0), 4) AS forecast_sum
FROM wanted w LEFT JOIN both_sides b ON b.o_orderstatus = w.o_orderstatus AND b.ds >= w.s AND b.ds < w.e GROUP BY ALL"""


def _workload(spark, sf_dir) -> DataFrame:
    """Events as editor workload; sign-ups list the role twice, errors under another role."""
    k = F.get_json_object("props", "$.k").cast("int")
    role = F.struct(F.lit(stats.EVENT_ROLE).alias("Role_Name"))
    other = F.struct(F.lit("Author").alias("Role_Name"))
    roles = F.when(F.col("event_type") == "signup", F.array(role, role)).when(
        F.col("event_type") == "error", F.array(other)).otherwise(F.array(other, role))
    consultation = F.struct(
        F.when(F.col("event_type") != "view", F.col("value")).alias("Days_To_Respond"), k.alias("Request_Version_ID"),
        F.when(F.col("event_type") == "click", k).alias("Response_Version_ID"),
        F.when(F.col("event_type") != "view", (k % 2).cast("double")).alias("Has_Response_Ratio"),
    )
    full = F.struct(
        k.alias("Current_Assignment_Count"),
        F.when(F.col("event_type") == "purchase", k).alias("Assigned_Version_ID"),
        F.when(F.col("event_type") == "purchase", k).alias("Submission_Received_To_Decision_Complete"),
    )
    return table(spark, sf_dir, "events").select(
        F.col("ts").alias("Event_Timestamp"),
        F.struct(F.col("user_id").alias("Person_ID"), roles.alias("Roles")).alias("Person"),
        F.struct(F.struct(consultation.alias("Consultation")).alias("Reviewing_Editor")).alias("Initial_Submission"),
        F.struct(full.alias("Reviewing_Editor")).alias("Full_Submission"),
    )


def person_stats(spark, sf_dir) -> DataFrame:
    """Details of all customers with twelve months of figures for those with events."""
    rows = stats.workload_rows(_workload(spark, sf_dir), F.lit("2024-01-20").cast("timestamp"))
    return stats.person_details(*_person_tables(spark, sf_dir), stats.workload_stats(rows))


def requested_persons(spark, sf_dir) -> DataFrame:
    """The same for the customers of some nations, asked for by id, some of them twice."""
    nations = F.col("c_nationkey") % 5 == 2
    ids = table(spark, sf_dir, "customer").filter(nations).select(F.col("c_custkey").alias("person_id"))
    wanted = ids.unionByName(ids.filter("person_id % 2 = 0"))
    as_of = F.lit("2024-01-20").cast("timestamp")
    return stats.requested_person_details(*_person_tables(spark, sf_dir), _workload(spark, sf_dir), wanted, as_of)


def _person_tables(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    customer = table(spark, sf_dir, "customer")
    persons = customer.select(
        F.col("c_custkey").alias("Person_ID"), F.col("c_name").alias("Name"), F.col("c_mktsegment").alias("institution"),
        F.struct(F.col("c_nationkey").cast("string").alias("Country")).alias("Primary_Address"),
    )
    profiles = customer.filter("c_acctbal > 0").select(
        F.col("c_custkey").alias("Person_ID"), F.lit("w").alias("Website_URL"), F.lit("p").alias("Pubmed_URL"),
        F.lit(None).cast("string").alias("Dates_Not_Available_CSV"),
    )
    return persons, profiles


STATS_SQL = """WITH e AS (
  SELECT user_id, event_type, value, json_extract(props, '$.k')::INT AS k FROM events
  WHERE ts::DATE BETWEEN DATE '2023-01-20' AND DATE '2024-01-20' AND event_type <> 'error'
),
twice AS (SELECT * FROM e UNION ALL SELECT * FROM e WHERE event_type = 'signup'),
figures AS (
  SELECT user_id,
    regexp_replace(round(quantile_cont(CASE WHEN event_type <> 'view' THEN value END, 0.5), 1)::VARCHAR, '\\.0$', '') AS days_to_respond,
    count(DISTINCT k)::VARCHAR AS requests, count(DISTINCT CASE WHEN event_type = 'click' THEN k END)::VARCHAR AS responses,
    regexp_replace(round(avg(CASE WHEN event_type <> 'view' THEN k % 2 END) * 100, 1)::VARCHAR, '\\.0$', '') AS response_rate,
    max(k)::VARCHAR AS no_of_assigments,
    count(DISTINCT CASE WHEN event_type = 'purchase' THEN k END)::VARCHAR AS no_of_full_submissions,
    regexp_replace(quantile_cont(CASE WHEN event_type = 'purchase' THEN k::DOUBLE END, 0.5)::VARCHAR, '\\.0$', '') AS decision_time
  FROM twice GROUP BY user_id
)
SELECT c_custkey AS person_id, c_name AS person_name, c_mktsegment AS institution, c_nationkey::VARCHAR AS country,
  'w' AS website, 'p' AS pubmed, NULL::VARCHAR AS availability, days_to_respond, requests, responses, response_rate,
  no_of_assigments, no_of_full_submissions, decision_time
FROM customer LEFT JOIN figures ON user_id = c_custkey WHERE c_acctbal > 0"""


QUERIES = {
    "daily_count": daily_count,
    "daily_median": daily_median,
    "daily_median_decision": daily_median_decision,
    "rolling_average": rolling_average,
    "ewma_average": ewma_average,
    "period_to_date": period_to_date,
    "forecast_additive": forecast_additive,
    "actual_forecast_merge": actual_forecast_merge,
    "period_totals": period_totals,
    "person_stats": person_stats,
    "requested_persons": requested_persons,
}
SQL = {
    "daily_count": DAILY_COUNT_SQL,
    "daily_median": MEDIAN_SQL,
    "daily_median_decision": DECISION_SQL,
    "rolling_average": ROLLING_SQL,
    "ewma_average": EWMA_SQL,
    "period_to_date": PERIOD_SQL,
    "forecast_additive": FORECAST_SQL,
    "actual_forecast_merge": MERGE_SQL,
    "period_totals": TOTALS_SQL,
    "person_stats": STATS_SQL,
    "requested_persons": STATS_SQL + " AND c_nationkey % 5 = 2",
}
