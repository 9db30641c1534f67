"""Matching-profile report: editors of a role with the open manuscripts they have a score for."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskmatch.functions.arrays import any_field_equals, first, joined
from deskmatch.functions.dates import whole_days
from deskmatch.plans.submissions import REVIEWING, SENIOR, is_open_stage

# fixed values: age limits and display texts
MAX_STAGE_DAYS = 90
MAX_ASSIGNED_STAGE_DAYS = 30
SENIOR_ASSIGNED_STAGE = "Senior Editor Assigned"
REVIEWING_ASSIGNED_STAGE = "Reviewing Editor Assigned"
NO_MANUSCRIPT = "~ No Manuscript Selected ~"
NO_RECOMMENDATION_YET = " (no recommendation yet)"
DISPLAY_SEPARATOR = " - "


@dataclass(frozen=True)
class ReportRole:
    role_name: str
    assigned_stage: str
    assigned_column: str
    assigned_suffix: str


SENIOR_REPORT = ReportRole(SENIOR, SENIOR_ASSIGNED_STAGE, "Senior_Editor_Assigned_Timestamp", " (SE assigned)")
REVIEWING_REPORT = ReportRole(
    REVIEWING, REVIEWING_ASSIGNED_STAGE, "Reviewing_Editor_Assigned_Timestamp", " (RE assigned)"
)


def open_for_report(versions: DataFrame, as_of: Column) -> DataFrame:
    """Open versions whose newest stage is at most 90 days old, or 30 once a senior editor is assigned."""
    age = whole_days(first("stages")["stage_timestamp"], as_of)
    unassigned = ~any_field_equals("stages", "stage_name", SENIOR_ASSIGNED_STAGE)
    return versions.filter(
        is_open_stage()
        & (age <= MAX_STAGE_DAYS)
        & ((age <= MAX_ASSIGNED_STAGE_DAYS) | unassigned)
        & ~F.col("is_withdrawn")
        & ~F.col("is_deleted")
    )


def version_texts(versions: DataFrame, role: ReportRole) -> DataFrame:
    """Report columns that depend on the version only."""
    stages = F.filter("stages", lambda s: s["stage_name"] == role.assigned_stage)
    return versions.select(
        F.col("manuscript_id").alias("Manuscript_ID"),
        F.col("version_id").alias("Version_ID"),
        F.col("long_manuscript_identifier").alias("Long_Manuscript_Identifier"),
        F.coalesce(
            F.concat("long_manuscript_identifier", F.lit(DISPLAY_SEPARATOR), "manuscript_title"), F.lit(NO_MANUSCRIPT)
        ).alias("Display_Manuscript_Identifier"),
        F.col("overall_stage").alias("Overall_Stage"),
        F.col("manuscript_title").alias("Manuscript_Title"),
        F.col("abstract").alias("Abstract"),
        first("stages")["stage_name"].alias("Last_Stage_Name"),
        F.array_max(F.transform(stages, lambda s: s["stage_timestamp"])).alias(role.assigned_column),
    )


def matching_report(
    editors: DataFrame, versions: DataFrame, recommendations: DataFrame, role: ReportRole, as_of: Column
) -> DataFrame:
    """One row per scored pair of a listed editor and an open version, one per open version without such a
    score (no editor), and one per editor without a manuscript.

    Pairs without score are not written out: they hold nothing beyond the two lists. Keys are matched first
    and the wide texts are joined last.
    """
    listed = editors.filter(F.col("Role_Name") == role.role_name)
    texts = version_texts(open_for_report(versions, as_of), role)
    rated = recommendations.filter(F.col("score").isNotNull()).select(
        F.col("version_id").alias("Version_ID"),
        F.col("person_id").alias("Person_ID"),
        F.col("score").alias("Matching_Score"),
        joined("matching_keywords", ", ", "keyword").alias("Matching_Keywords_CSV"),
    )
    pairs = rated.join(listed, "Person_ID")
    scored = pairs.join(texts, "Version_ID").withColumn("Has_Recommendation", F.lit(True))
    unscored = texts.join(pairs.select("Version_ID").distinct(), "Version_ID", "left_anti").withColumn(
        "Has_Recommendation", F.lit(False))
    matched = scored.unionByName(unscored, allowMissingColumns=True)
    unselected = listed.withColumn("Has_Recommendation", F.lit(False)).withColumn(
        "Display_Manuscript_Identifier", F.lit(NO_MANUSCRIPT)
    )
    rows = matched.unionByName(unselected, allowMissingColumns=True).withColumn(
        "Matching_Keywords_CSV", F.coalesce("Matching_Keywords_CSV", F.lit(""))
    )
    state = F.concat(
        "Long_Manuscript_Identifier",
        F.when(F.col(role.assigned_column).isNotNull(), role.assigned_suffix).otherwise(""),
        F.when(~F.col("Has_Recommendation"), NO_RECOMMENDATION_YET).otherwise(""),
        F.lit(DISPLAY_SEPARATOR),
        "Manuscript_Title",
    )
    display = F.when(F.col("Version_ID").isNull(), F.col("Display_Manuscript_Identifier")).otherwise(state)
    return rows.withColumn("Display_Manuscript_Identifier_With_State", display)


def in_report_order(report: DataFrame) -> DataFrame:
    return report.orderBy(F.desc_nulls_last("Version_ID"), F.desc_nulls_last("Matching_Score"))
