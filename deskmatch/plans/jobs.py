"""The five table flows: paper harvest, profiles, batch recommendation, report, metric forecast.

Each job reads and writes named tables, so every step can run as its own Spark application. Landed
responses (searches, bibliography pages, keyword batches) are inputs; nothing is fetched here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskmatch import schemas
from deskmatch.operators.latest import newest_import_rows
from deskmatch.operators.scale import materialise
from deskmatch.plans import daily, disambiguation, forecast, harvest, recommend, reports, stats, submissions
from deskmatch.sources import landing
from deskmatch.sources.cleaning import clean_fields
from deskmatch.sources.model_store import load_model, save_model
from deskmatch.sources.tables import APPEND, REPLACE, Tables, limited, with_provenance

LINKS, PAPER_IDS, SUMMARIES = "editor_pubmed_links", "editor_pubmed_ids", "external_manuscript_summary"
DETAILS, PAPERS = "disambiguated_editor_papers_details", "disambiguated_editor_papers"
RECOMMENDATIONS = {
    recommend.SENIOR_ROLE: "editor_recommendation",
    recommend.REVIEWING_ROLE: "reviewing_editor_recommendation",
}
REPORTS = {
    recommend.SENIOR_ROLE: (reports.SENIOR_REPORT, "Manuscript_Version_Matching_Editor_Profile"),
    recommend.REVIEWING_ROLE: (reports.REVIEWING_REPORT, "Manuscript_Version_Matching_Reviewing_Editor_Profile"),
}


def _append_new(tables: Tables, rows: DataFrame, name: str) -> int:
    """Appends; nothing new changes nothing."""
    return tables.save(rows, name, APPEND)


# --- paper harvest ----------------------------------------------------------------------------


def parse_links(tables: Tables, redirects: DataFrame | None = None) -> int:
    parsed = harvest.parsed_links(tables.source("mv_Editorial_Editor_Profile"), redirects)
    return tables.save(parsed, LINKS, REPLACE)


def _existing_ids(tables: Tables) -> DataFrame:
    return tables.first_existing([PAPER_IDS], schemas.PUBMED_IDS)


def _id_rows(wanted: DataFrame, found: DataFrame, source: str, as_of: Column) -> DataFrame:
    """One row per wanted editor and id found, one without id where none was found: an import of any size."""
    ids = found.filter(F.col("pmid").isNotNull()).select("person_id", "pmid").distinct()
    persons = wanted.select("person_id", "name", "pubmed_url").join(
        found.select("person_id").distinct(), "person_id", "left_semi"
    )
    return with_provenance(persons.join(ids, "person_id", "left"), source, as_of)


def import_bibliography_ids(tables: Tables, pages: DataFrame, as_of: Column, limit: int | None = None) -> int:
    """``pages`` holds landed bibliography pages: (person_id, html)."""
    wanted = harvest.bibliographies_to_fetch(tables.output(LINKS), _existing_ids(tables), limit)
    found = pages.select("person_id", F.explode(landing.cited_ids(F.col("html"))).alias("pmid"))
    return _append_new(tables, _id_rows(wanted, found, "bibliography", as_of), PAPER_IDS)


def import_search_ids(tables: Tables, responses: DataFrame, as_of: Column, limit: int | None = None) -> int:
    """``responses`` holds landed author searches: (person_id, response)."""
    wanted = harvest.editors_to_refresh(tables.output(LINKS), _existing_ids(tables), as_of, limit)
    found = responses.select("person_id", F.explode(landing.result_ids(F.col("response"))).alias("pmid"))
    return _append_new(tables, _id_rows(wanted, found, "search", as_of), PAPER_IDS)


def snapshot_ids(tables: Tables) -> DataFrame:
    """Rows of the newest import per editor as a stored copy, in which only editors with new imports are replaced."""
    newest = lambda rows: newest_import_rows(rows, ["person_id"], "provenance.source")
    return tables.refreshed_snapshot(PAPER_IDS, newest, ["person_id"])


def _summaries(tables: Tables) -> DataFrame:
    return tables.first_existing([SUMMARIES], schemas.MANUSCRIPT_SUMMARY)


def import_summaries(
    tables: Tables, responses: DataFrame, latest_ids: DataFrame, as_of: Column, limit: int | None = None
) -> int:
    """``responses`` holds landed paper searches: (response). Only wanted papers are kept."""
    every = harvest.all_paper_ids(disambiguation.as_listed(latest_ids), tables.output(LINKS))
    wanted = harvest.papers_to_fetch(every, _summaries(tables), limit).select(F.col("pubmed_id").alias("pmid"))
    rows = landing.search_results(responses.select("response")).join(wanted, "pmid", "left_semi")
    return _append_new(tables, with_provenance(rows, "search", as_of), SUMMARIES)


def disambiguate(
    tables: Tables, latest_ids: DataFrame,
    target: int = disambiguation.TARGET_PAPERS, maximum: int = disambiguation.MAX_PAPERS,
) -> DataFrame:
    """Writes match details and selected papers; returns the coverage flags per editor."""
    profiles, links = tables.source("mv_Editorial_Editor_Profile"), tables.output(LINKS)
    listed = disambiguation.as_listed(latest_ids)
    with_terms = listed.join(links.select("person_id", "parsed_search_term"), "person_id", "left")
    first_author = F.struct(
        F.struct(F.try_element_at("parsed_search_term.include", F.lit("author")).alias("author")).alias("include")
    )
    details = disambiguation.paper_details(
        profiles, with_terms.withColumn("parsed_search_term", first_author), tables.source("mv_person_v2"),
        _summaries(tables),
    )
    tables.save(details, DETAILS, REPLACE)
    priorities = disambiguation.paper_priorities(links, tables.output(DETAILS))
    chosen = disambiguation.selected_papers(
        priorities, disambiguation.priority_cutoffs(priorities, target, maximum)
    )
    tables.save(links.select("person_id", "name").join(chosen, "person_id", "left"), PAPERS, REPLACE)
    papers = disambiguation.as_listed(tables.output(PAPERS), "disambiguated_pubmed_ids")
    counts = disambiguation.coverage_counts(profiles, papers, links, listed)
    return disambiguation.coverage_flags(counts)


# --- profiles, recommendations, reports -------------------------------------------------------


def _editors(tables: Tables, role_name: str) -> DataFrame:
    profiles = tables.source("mv_Editorial_Editor_Profile").filter(F.col("Role_Name") == role_name)
    return profiles.select(F.col("Person_ID").alias("person_id"), F.col("Name").alias("name"))


def _keywords(tables: Tables) -> DataFrame:
    return submissions.manuscript_keywords(tables.source("keywords_from_manuscript_abstract_batch"))


def senior_profiles(tables: Tables) -> DataFrame:
    assignments = submissions.senior_assignments(
        tables.source("mv_Editorial_All_Manuscript_Version"), tables.source("mv_Editorial_Person")
    )
    # a chain of joins that the profile build reads several times
    training = materialise(
        submissions.senior_training(assignments, _keywords(tables), _editors(tables, submissions.SENIOR)), "training")
    return recommend.role_profiles(
        training, training, recommend.SENIOR_ROLE, ("manuscript_id", "version_id"),
        excluded=tables.source("keyword_exclusion"),
    )


def reviewing_profiles(tables: Tables, latest_ids: DataFrame, doi_prefix: str) -> DataFrame:
    assignments = submissions.reviewing_assignments(
        tables.source("mv_Editorial_All_Manuscript_Version"), tables.source("mv_Editorial_Person")
    )
    summaries = _summaries(tables)
    chosen = tables.output(PAPERS).filter(F.col("pmid").isNotNull()).select("person_id", "pmid")
    publications = disambiguation.editor_publications(
        chosen, tables.output(LINKS), disambiguation.as_listed(latest_ids), summaries, doi_prefix
    )
    papers = submissions.publication_keywords(
        tables.source("keywords_from_disambiguated_editor_papers_abstract_batch"), summaries, doi_prefix
    )
    training, assigned = submissions.reviewing_training(
        assignments, _keywords(tables), _editors(tables, submissions.REVIEWING), publications, papers
    )
    return recommend.role_profiles(
        materialise(training, "training"), assigned, recommend.REVIEWING_ROLE, ("manuscript_id", "version_id"),
        excluded=tables.source("keyword_exclusion"),
    )


def build_model(profiles: DataFrame, path: str) -> None:
    """Stores the profiles of one or both roles below ``path``."""
    save_model(profiles, path)


def recommend_editors(tables: Tables, path: str, role: str, as_of: Column, limit: int | None = None) -> int:
    """Replaces the role's recommendation table; both roles use the same list of manuscripts."""
    wanted = submissions.manuscripts_to_recommend(tables.source("mv_manuscript_version"), _keywords(tables), as_of)
    model = load_model(tables.spark, path).only(role)
    rows = recommend.recommendation_rows(limited(wanted, limit, "version_id"), model)
    return tables.save(clean_fields(rows.drop("role", "rank")), RECOMMENDATIONS[role], REPLACE)


def update_report(tables: Tables, role: str, as_of: Column) -> int:
    shape, name = REPORTS[role]
    report = reports.matching_report(
        tables.source("mv_Editorial_Editor_Profile"), tables.source("mv_manuscript_version"),
        tables.output(RECOMMENDATIONS[role]), shape, as_of,
    )
    return tables.save(report, name, REPLACE)


def person_details(tables: Tables, wanted: DataFrame, as_of: Column) -> DataFrame:
    return stats.requested_person_details(
        tables.source("mv_Editorial_Person"), tables.source("mv_Editorial_Editor_Profile"),
        tables.source("mv_Editorial_Editor_Workload_Event"), wanted, as_of,
    )


# --- metric forecast --------------------------------------------------------------------------


def forecast_metric(tables: Tables, metric: DataFrame, name: str, series: tuple[str, ...]) -> int:
    """Forecast of a daily metric, combined with its actual values, as table ``Forecast_name``.

    ``series`` names the key columns of the metric; a single series needs a constant one.
    """
    # one row per day: everything below starts from the stored series and its stored forecast
    actual = materialise(daily.as_series(metric, series), "series")
    ahead = materialise(forecast.additive_forecast(actual, series), "forecast")
    table = daily.combined_table(
        daily.actual_table(actual, series), daily.forecast_table(actual, ahead, series, forecast.MODEL_NAME), series
    )
    return tables.save(table, f"Forecast_{name}", REPLACE)
