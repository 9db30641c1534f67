"""Person details with twelve months of workload figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskmatch.functions.dates import in_last_year
from deskmatch.functions.text import display_number
from deskmatch.operators.median import exact_median

# fixed value: role whose events count
EVENT_ROLE = "Editorial Board Member"

STAT_COLUMNS = ("days_to_respond", "requests", "responses", "response_rate", "no_of_assigments",
                "no_of_full_submissions", "decision_time")


def workload_rows(events: DataFrame, as_of: Column) -> DataFrame:
    """Events of the last twelve months, once per matching role of the person."""
    consultation = "Initial_Submission.Reviewing_Editor.Consultation"
    full = "Full_Submission.Reviewing_Editor"
    return (
        events.filter(in_last_year("Event_Timestamp", as_of))
        .select("*", F.explode("Person.Roles").alias("_role"))
        .filter(F.col("_role.Role_Name") == EVENT_ROLE)
        .select(
            F.col("Person.Person_ID").alias("person_id"),
            F.col(f"{consultation}.Days_To_Respond").cast("double").alias("days_to_respond"),
            F.col(f"{consultation}.Request_Version_ID").alias("request_id"),
            F.col(f"{consultation}.Response_Version_ID").alias("response_id"),
            F.col(f"{consultation}.Has_Response_Ratio").cast("double").alias("response_ratio"),
            F.col(f"{full}.Current_Assignment_Count").alias("assignments"),
            F.col(f"{full}.Assigned_Version_ID").alias("assigned_id"),
            F.col(f"{full}.Submission_Received_To_Decision_Complete").cast("double").alias("decision_days"),
        )
    )


def workload_stats(rows: DataFrame) -> DataFrame:
    """Display texts per person. Distinct counts and medians combine before the shuffle by person."""
    plain = rows.groupBy("person_id").agg(
        F.countDistinct("request_id").cast("string").alias("requests"),
        F.countDistinct("response_id").cast("string").alias("responses"),
        display_number(F.avg("response_ratio") * 100, 1).alias("response_rate"),
        F.max("assignments").cast("string").alias("no_of_assigments"),
        F.countDistinct("assigned_id").cast("string").alias("no_of_full_submissions"),
    )
    respond = exact_median(rows, ["person_id"], "days_to_respond", "_respond")
    decide = exact_median(rows, ["person_id"], "decision_days", "_decide")
    return plain.join(respond, "person_id").join(decide, "person_id").select(
        "person_id",
        display_number("_respond", 1).alias("days_to_respond"),
        *plain.columns[1:],
        display_number("_decide").alias("decision_time"),
    ).select("person_id", *STAT_COLUMNS)


def person_details(persons: DataFrame, profiles: DataFrame, stats: DataFrame) -> DataFrame:
    """Details of every person with an editor profile; figures are null without events."""
    person = persons.select(
        F.col("Person_ID").alias("person_id"),
        F.col("Name").alias("person_name"),
        "institution",
        F.col("Primary_Address.Country").alias("country"),
    )
    profile = profiles.select(
        F.col("Person_ID").alias("person_id"),
        F.col("Website_URL").alias("website"),
        F.col("Pubmed_URL").alias("pubmed"),
        F.col("Dates_Not_Available_CSV").alias("availability"),
    )
    return person.join(profile, "person_id").join(stats, "person_id", "left")


def requested_person_details(
    persons: DataFrame, profiles: DataFrame, events: DataFrame, wanted: DataFrame, as_of: Column
) -> DataFrame:
    """Details of the wanted persons only; the semi-join comes before the figures are computed."""
    ids = wanted.select("person_id").distinct()
    rows = workload_rows(events, as_of).join(ids, "person_id", "left_semi")
    return person_details(persons, profiles, workload_stats(rows)).join(ids, "person_id", "left_semi")
