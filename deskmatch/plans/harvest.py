"""Which editors and papers to fetch, and the parsed links they come from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskmatch.functions import links
from deskmatch.functions.dates import whole_days
from deskmatch.operators.latest import latest_import
from deskmatch.operators.scale import materialise, spread_nulls
from deskmatch.operators.membership import drop_members, not_in
from deskmatch.sources.tables import limited

# fixed value: whole days after which an import is repeated
MAX_IMPORT_DAYS = 15


def final_targets(redirects: DataFrame) -> DataFrame:
    """(url, target): where each address of (url, target) leads in the end, one row per address.

    Of several targets of one address the least counts. Every round lets each address point to where its target
    points, so chains of any length take as many rounds as their length has binary digits. Addresses that run in a
    circle, or into one, lead nowhere and are left out, as are null addresses and targets. A round after which as many
    addresses are open as before leaves circles only: a longer chain would have every shorter one in it. The table meets
    itself by a merge join, as a broadcast would pass it through the driver in every round.
    """
    steps = materialise(
        redirects.filter(F.col("url").isNotNull() & F.col("target").isNotNull() & (F.col("url") != F.col("target")))
        .groupBy("url").agg(F.min("target").alias("target")), "redirects")
    left = None
    while True:
        further = steps.select(F.col("url").alias("target"), F.col("target").alias("_next"))
        steps = materialise(
            steps.join(further.hint("merge"), "target", "left").select(
                "url", F.coalesce("_next", "target").alias("target"), F.col("_next").isNotNull().alias("open")), "redirects")
        before, left = left, steps.filter("open").count()
        if left in (0, before):
            return steps.filter("not open").select("url", "target")
        steps = steps.drop("open")


def parsed_links(profiles: DataFrame, redirects: DataFrame | None = None) -> DataFrame:
    """Profile links with article ids, resolved address, search term and bibliography flag.

    ``redirects`` (url, target) resolves addresses outside the literature site, through chains; without it they stay.
    """
    table = profiles.select(
        F.col("Person_ID").alias("person_id"),
        F.col("Name").alias("name"),
        F.col("Pubmed_URL").alias("pubmed_url"),
        F.col("Relevant_Pubmed_URLs").alias("relevant_pubmed_urls"),
        links.article_ids("Relevant_Pubmed_URLs").alias("relevant_pubmed_ids"),
        links.normal_url("Pubmed_URL").alias("_url"),
    )
    if redirects is None:
        table = table.withColumnRenamed("_url", "resolved_pubmed_url")
    else:
        targets = final_targets(redirects).select(F.col("url").alias("_url"), F.col("target").alias("_target"))
        own = links.is_literature_url("_url")
        key = spread_nulls(F.col("_url"), "person_id")  # profiles without address are spread out
        targets = targets.withColumnRenamed("_url", "_from")
        table = table.withColumn("_key", key).join(targets.hint("merge"), F.col("_key") == F.col("_from"), "left").withColumn(
            "resolved_pubmed_url", F.when(own, F.col("_url")).otherwise(F.coalesce("_target", "_url"))
        ).drop("_url", "_target", "_key", "_from")
    term = F.nullif(links.search_term("resolved_pubmed_url"), F.lit(""))
    return (
        table.withColumn("search_term", term)
        .withColumn("parsed_search_term", links.parsed_term("search_term"))
        .withColumn("is_ncbi_bibliography_url", links.is_bibliography_url("resolved_pubmed_url"))
    )


def bibliography_flag_counts(parsed: DataFrame) -> DataFrame:
    return parsed.groupBy("is_ncbi_bibliography_url").agg(F.count(F.lit(1)).alias("editors"))


def bibliographies_to_fetch(parsed: DataFrame, existing: DataFrame, limit: int | None = None) -> DataFrame:
    """Editors with a bibliography page whose ids have not been imported."""
    wanted = parsed.filter(F.col("is_ncbi_bibliography_url"))
    return limited(drop_members(wanted, "person_id", existing), limit, "person_id")


def editors_to_refresh(
    parsed: DataFrame, imports: DataFrame, as_of: Column, limit: int | None = None
) -> DataFrame:
    """Editors with a search term that are new, whose address changed, or whose import is too old."""
    last = latest_import(imports, ["person_id"]).select(
        "person_id",
        F.col("pubmed_url").alias("_old_url"),
        F.col("provenance.imported_timestamp").alias("_imported"),
        F.lit(True).alias("_known"),
    )
    # an address that became null counts as changed
    changed = F.col("_old_url").isNotNull() & ~F.col("pubmed_url").eqNullSafe(F.col("_old_url"))
    stale = F.coalesce(whole_days("_imported", as_of.cast("timestamp")) > MAX_IMPORT_DAYS, F.lit(False))
    candidates = parsed.filter(F.col("parsed_search_term").isNotNull() & F.col("person_id").isNotNull())
    wanted = candidates.join(last, "person_id", "left").filter(F.col("_known").isNull() | changed | stale)
    return limited(wanted.drop("_old_url", "_imported", "_known"), limit, "person_id")


def all_paper_ids(pubmed_ids: DataFrame, parsed: DataFrame) -> DataFrame:
    """Distinct ids from imports, relevant links and search terms."""
    searched = F.try_element_at("parsed_search_term.include", F.lit("pmid"))
    lists = (
        pubmed_ids.select(F.col("pubmed_ids").alias("ids"))
        .union(parsed.select("relevant_pubmed_ids"))
        .union(parsed.select(searched))
    )
    return lists.select(F.explode("ids").alias("pubmed_id")).distinct()


def papers_to_fetch(wanted: DataFrame, summaries: DataFrame, limit: int | None = None) -> DataFrame:
    """Ids without a summary; a null id among the summaries stops the import, as ``NOT IN`` does."""
    return limited(not_in(wanted, "pubmed_id", summaries, "pmid"), limit, "pubmed_id")
