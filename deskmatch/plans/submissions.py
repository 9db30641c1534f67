"""Extracted keywords, editor assignments, training sets and the manuscripts that need editors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskmatch.functions.arrays import has_items, joined, max_field
from deskmatch.functions.dates import whole_days
from deskmatch.functions.text import manuscript_id_from_doi
from deskmatch.operators.latest import latest_import, latest_per_key
from deskmatch.operators.scale import spread_nulls
from deskmatch.operators.membership import drop_members, keep_known_names

# fixed values: stages, relations, site and age limits of the editorial tables
INITIAL_STAGE = "Initial Submission"
FULL_STAGE = "Full Submission"
SENIOR = "Senior Editor"
REVIEWING = "Reviewing Editor"
PREPRINT_SITE = "rp_site"
MAX_CREATED_DAYS = 365
MAX_ASSIGNED_DAYS = 30


def _batch_rows(batch: DataFrame, id_field: str) -> DataFrame:
    """(id, keywords, imported_timestamp) per entry of a keyword batch, keywords null-safe."""
    entry = batch.select("imported_timestamp", F.explode("data").alias("entry"))
    return entry.select(
        F.col(f"entry.meta.{id_field}").cast("string").alias(id_field),
        F.transform("entry.attributes.keywords", lambda k: k["keyword"]).alias("extracted_keywords"),
        "imported_timestamp",
    )


def _newest(rows: DataFrame, id_field: str) -> DataFrame:
    order = [F.desc_nulls_last("imported_timestamp"), F.asc("extracted_keywords")]
    return latest_per_key(rows, [id_field], order).drop("imported_timestamp")


def manuscript_keywords(batch: DataFrame) -> DataFrame:
    """Newest non-empty keyword list per manuscript version; empty lists never replace older ones."""
    rows = _batch_rows(batch, "version_id")
    return _newest(rows.filter(has_items("extracted_keywords")), "version_id")


def publication_keywords(batch: DataFrame, summaries: DataFrame, doi_prefix: str) -> DataFrame:
    """Newest keyword list per publication, dropped when that newest list is empty."""
    newest = _newest(_batch_rows(batch, "pmid"), "pmid").filter(has_items("extracted_keywords"))
    papers = latest_import(summaries, ["pmid"], "doi").select("pmid", "doi", "firstPublicationDate")
    return newest.join(papers, "pmid").select(
        F.concat(F.lit("pmid:"), "pmid").alias("publication_id"),
        "pmid",
        "doi",
        manuscript_id_from_doi("doi", doi_prefix).alias("manuscript_id"),
        F.col("firstPublicationDate").alias("publication_date"),
        F.col("extracted_keywords").alias("abstract_keywords"),
    )


def related_persons(versions: DataFrame, editors: str, relation: str) -> DataFrame:
    return (
        versions.select(F.col("Version_ID").alias("version_id"), F.explode(editors).alias("_person"))
        .select("version_id", F.lit(relation).alias("relationship_type"), F.col("_person.Person_ID").alias("person_id"))
        .distinct()
    )


def _assignments(versions: DataFrame, related: DataFrame, persons: DataFrame, how: str) -> DataFrame:
    version = versions.select(
        F.col("Manuscript_ID").alias("manuscript_id"),
        F.col("Version_ID").alias("version_id"),
        F.col("Overall_Stage").alias("overall_stage"),
        F.col("QC_Complete_Timestamp").alias("qc_complete_timestamp"),
        F.col("Position_In_Overall_Stage").alias("position_in_overall_stage"),
    )
    person = persons.select(
        F.col("Person_ID").alias("person_id"),
        F.col("Name").alias("name"),
        joined("Roles", "|", "Role_Name").alias("person_roles"),
        joined("Keywords", "|", "Keyword").alias("person_keywords"),
        joined("Subject_Areas", "|", "Subject_Area_Name").alias("person_subject_areas"),
    )
    result = version.join(related, "version_id", how)
    # versions without an editor are spread out; they match nobody
    key = spread_nulls(F.col("person_id").cast("string"), "version_id")
    named = person.withColumnRenamed("person_id", "_person")
    result = result.withColumn("_key", key).join(named, F.col("_key") == F.col("_person").cast("string"), how)
    if how == "left":
        # a version without a known person has empty lists, not unknown ones
        lists = ("person_roles", "person_keywords", "person_subject_areas")
        result = result.withColumns({c: F.coalesce(c, F.lit("")) for c in lists})
    return result.select(*version.columns, "relationship_type", "person_id", *person.columns[1:])


def senior_assignments(versions: DataFrame, persons: DataFrame) -> DataFrame:
    """Versions with their senior and reviewing editors; versions without editors stay."""
    related = related_persons(versions, "Senior_Editors", SENIOR).unionByName(
        related_persons(versions, "Reviewing_Editors", REVIEWING)
    )
    return _assignments(versions, related, persons, "left")


def reviewing_assignments(versions: DataFrame, persons: DataFrame) -> DataFrame:
    """Versions with known reviewing editors only."""
    return _assignments(versions, related_persons(versions, "Reviewing_Editors", REVIEWING), persons, "inner")


def _first_assignments(assigned: DataFrame, stage: str, relation: str, editors: DataFrame) -> DataFrame:
    rows = assigned.filter(
        (F.col("overall_stage") == stage)
        & (F.col("position_in_overall_stage") == 1)
        & (F.col("relationship_type") == relation)
    )
    return keep_known_names(rows, editors)


def senior_training(assignments: DataFrame, keywords: DataFrame, editors: DataFrame) -> DataFrame:
    """First initial submissions of senior editors, and first full submissions they reviewed whose
    manuscript is not among the former."""
    assigned = assignments.join(keywords, "version_id")
    initial = _first_assignments(assigned, INITIAL_STAGE, SENIOR, editors)
    reviewed = _first_assignments(assigned, FULL_STAGE, REVIEWING, editors)
    return initial.unionByName(drop_members(reviewed, "manuscript_id", initial))


def reviewing_training(
    assignments: DataFrame, keywords: DataFrame, editors: DataFrame, publications: DataFrame, papers: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """(all training rows, assignment rows): first full submissions of reviewing editors, plus the
    publications of editors that have at least one. ``papers`` holds the publications' keywords."""
    assigned = assignments.join(keywords, "version_id")
    full = _first_assignments(assigned, FULL_STAGE, REVIEWING, editors)
    written = (
        editors.select("person_id", "name")
        .join(publications.select("person_id", "publication_id"), "person_id")
        .join(papers.select("publication_id", F.col("abstract_keywords").alias("extracted_keywords")), "publication_id")
    )
    names = full.filter(F.col("name").isNotNull()).select("name").distinct()
    return full.unionByName(written.join(names, "name", "left_semi"), allowMissingColumns=True), full


def duplicate_manuscripts(training: DataFrame) -> DataFrame:
    """Manuscripts that occur more than once in a training set, with their count."""
    return (
        training.groupBy("manuscript_id")
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .filter((F.col("occurrences") > 1) & F.col("manuscript_id").isNotNull())
    )


def is_open_stage() -> Column:
    return (F.col("overall_stage") == INITIAL_STAGE) | (F.col("source_site_id") == PREPRINT_SITE)


def manuscripts_to_recommend(versions: DataFrame, keywords: DataFrame, as_of: Column) -> DataFrame:
    """Open versions not older than a year without a senior editor, or with one assigned in the last
    30 days: (version_id, extracted_keywords, author_person_ids)."""
    last_assigned = max_field("senior_editors", "last_assigned_timestamp")
    wanted = versions.filter(
        is_open_stage()
        & (~has_items("senior_editors") | (whole_days(last_assigned, as_of) < MAX_ASSIGNED_DAYS))
        & (whole_days("created_timestamp", as_of) < MAX_CREATED_DAYS)
        & ~F.col("is_withdrawn")
        & ~F.col("is_deleted")
    )
    authors = F.coalesce(F.transform("authors", lambda a: a["person_id"]), F.array())
    return wanted.select("version_id", authors.alias("author_person_ids")).join(keywords, "version_id").select(
        "version_id", "extracted_keywords", "author_person_ids"
    )
