"""Which papers an editor most likely wrote: scored authors, priorities, and a cut-off per editor."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from deskmatch.functions.arrays import distinct_present, first, joined, or_empty, pick_ordered
from deskmatch.functions.text import contains, manuscript_id_from_doi
from deskmatch.operators.latest import latest_import, newest_import_rows
from deskmatch.operators.scale import materialise, spread_nulls

# fixed values: points per matching trait of an author
POINTS = {
    "has_matching_orcid": 50,
    "has_mismatching_orcid": -5,
    "has_matching_last_name": 20,
    "has_matching_first_name": 10,
    "has_matching_first_name_letter": 5,
    "has_matching_affiliation": 4,
    "has_matching_previous_affiliation": 2,
    "has_matching_postal_code": 3,
    "has_matching_city": 2,
    "has_matching_country": 1,
}
# fixed values: base of score-derived priorities, paper targets, and the priority no upper limit applies to
SCORE_PRIORITY_BASE = 1000
TARGET_PAPERS = 50
MAX_PAPERS = 2000
SURE_PRIORITY = 2

AUTHOR_FIELDS = ("author_first_name", "author_last_name", "author_full_name", "author_initials",
                 "affiliation_string", "author_orcid")


def enriched_editors(profiles: DataFrame, pubmed_ids: DataFrame, persons: DataFrame) -> DataFrame:
    """Editors with their newest address, ORCID (confirmed ones first) and distinct paper ids."""

    def orcid(kind: str) -> Column:
        return pick_ordered(
            F.col("external_references"),
            lambda r: [r["start_timestamp"], r["modified_timestamp"]],
            lambda r: r["reference_value"],
            keep=lambda r: r["is_enabled"] & (r["reference_type"] == kind),
        )

    address = pick_ordered(F.col("addresses"), lambda a: [a["start_timestamp"]], descending=True)
    person = persons.select(
        "person_id", "first_name", "last_name", "institution",
        address.alias("primary_address"),
        F.coalesce(orcid("ORCID"), orcid("UNVERIFIED_ORCID")).alias("orcid"),
    )
    role = profiles.select(F.col("Person_ID").alias("person_id"), F.col("Role_Name").alias("role_name"))
    ids = pubmed_ids.select(
        "person_id", "name",
        first("parsed_search_term.include.author").alias("search_author_name"),
        distinct_present("pubmed_ids").alias("pubmed_ids"),
    )
    return role.join(ids, "person_id").join(person, "person_id")


def _author(author: Column) -> list[Column]:
    is_orcid = author["authorId"]["type"] == "ORCID"
    return [
        author["firstName"].alias("author_first_name"),
        author["lastName"].alias("author_last_name"),
        author["fullName"].alias("author_full_name"),
        author["initials"].alias("author_initials"),
        F.array_join(author["authorAffiliationsList"]["authorAffiliation"], ", ").alias("affiliation_string"),
        F.when(is_orcid, F.nullif(author["authorId"]["value"], F.lit(""))).alias("author_orcid"),
    ]


def _papers(summaries: DataFrame) -> DataFrame:
    """One row per paper row with its authors as they are listed."""
    return summaries.select(
        "pmid", F.col("provenance.imported_timestamp").alias("paper_imported"), "doi", "title",
        F.to_date("firstPublicationDate").alias("first_publication_date"),
        F.col("authorString").alias("author_string"), F.col("authorList.author").alias("_authors"),
    )


def _each_author(papers: DataFrame) -> DataFrame:
    names = F.transform("_authors", lambda a: F.trim(F.concat(a["firstName"], F.lit(" "), a["lastName"])))
    return papers.select(
        *[c for c in papers.columns if c != "_authors"], joined(names, "; ").alias("first_last_name_author_string"),
        F.posexplode_outer("_authors").alias("author_position", "_author"),
    ).select("*", *_author(F.col("_author"))).drop("_author")


def paper_authors(summaries: DataFrame) -> DataFrame:
    """One row per paper row and listed author, with the author's position."""
    return _each_author(_papers(summaries))


def affiliation_history(authors: DataFrame) -> DataFrame:
    """Distinct (author_orcid, affiliation_string) over all papers; authors without ORCID have no history."""
    known = F.col("author_orcid").isNotNull() & F.col("affiliation_string").isNotNull()
    return authors.filter(known).select("author_orcid", "affiliation_string").distinct()


def _found_papers(editors: DataFrame) -> DataFrame:
    return editors.withColumn("pmid", F.explode("pubmed_ids")).drop("pubmed_ids")


def author_candidates(editors: DataFrame, authors: DataFrame) -> DataFrame:
    """Editor columns with every author of each paper found for the editor."""
    return _found_papers(editors).join(authors, "pmid")


def flag_candidates(candidates: DataFrame, history: DataFrame) -> DataFrame:
    """Ten match flags per candidate (null when a side is unknown).

    The earlier affiliations of an ORCID are compared one by one with each institution asked for, so
    no ORCID's history is gathered in one place, and candidates without ORCID are spread out.
    """
    asked = candidates.select("author_orcid", "institution").filter(
        F.col("author_orcid").isNotNull() & (F.col("institution") != "")
    ).distinct()
    # no row: nothing is known of the ORCID's earlier affiliations
    seen = (
        history.filter(F.col("affiliation_string").isNotNull()).join(asked, "author_orcid")
        .groupBy(F.col("author_orcid").alias("_orcid"), F.col("institution").alias("_institution"))
        .agg(F.max(F.instr(F.col("affiliation_string"), F.col("institution")) > 0).alias("_seen"))
    )
    # stored: Spark knows its size before the candidates move, and they stay dealt by paper where it is small
    seen = materialise(seen, "seen")
    key = spread_nulls(F.col("author_orcid"), "person_id", "pmid")
    flagged = candidates.withColumn("_key", key)
    joined_rows = flagged.join(
        seen, (F.col("_key") == F.col("_orcid")) & (F.col("institution") == F.col("_institution")), "left"
    )
    affiliation = F.col("affiliation_string")
    same_letter = F.substring("author_first_name", 1, 1) == F.substring("first_name", 1, 1)
    return joined_rows.select(
        *candidates.columns,
        (F.col("author_orcid") == F.col("orcid")).alias("has_matching_orcid"),
        (F.col("author_orcid") != F.col("orcid")).alias("has_mismatching_orcid"),
        (F.col("author_last_name") == F.col("last_name")).alias("has_matching_last_name"),
        (F.col("author_first_name") == F.col("first_name")).alias("has_matching_first_name"),
        same_letter.alias("has_matching_first_name_letter"),
        contains(affiliation, "institution").alias("has_matching_affiliation"),
        contains(affiliation, "primary_address.country").alias("has_matching_country"),
        contains(affiliation, "primary_address.city").alias("has_matching_city"),
        contains(affiliation, "primary_address.postal_code").alias("has_matching_postal_code"),
        F.col("_seen").alias("has_matching_previous_affiliation"),
    )


def match_score() -> Column:
    """Sum of the points of all flags that are true."""
    total = F.lit(0)
    for flag, points in POINTS.items():
        total = total + F.when(F.coalesce(F.col(flag), F.lit(False)), points).otherwise(0)
    return total


def best_candidates(flagged: DataFrame, paper_key: tuple[str, ...] = ("person_id", "pmid")) -> DataFrame:
    """Highest scoring author per editor and paper, the first listed on ties; its fields are null unless
    the score is positive or there is no other author.

    Only a running maximum per paper is kept, so a paper with very many authors needs no more memory.
    """
    fields = [*AUTHOR_FIELDS, *POINTS, "author_match_score"]
    rest = [c for c in flagged.columns if c not in (*fields, *paper_key, "author_position")]
    scored = flagged.withColumn("author_match_score", match_score())
    rank = F.struct("author_match_score", (-F.col("author_position")).alias("first"))
    best = scored.groupBy(*paper_key).agg(
        F.max_by(F.struct(*[F.col(c) for c in (*rest, *fields)]), rank).alias("best"),
        F.count("author_position").alias("authors"),
    )
    accepted = (F.col("best.author_match_score") > 0) | (F.col("authors") == 1)
    return best.select(
        *paper_key,
        *[F.col(f"best.{c}").alias(c) for c in rest],
        *[F.when(accepted, F.col(f"best.{c}")).alias(c) for c in fields],
    )


def paper_details(
    profiles: DataFrame, pubmed_ids: DataFrame, persons: DataFrame, summaries: DataFrame, dedupe: bool = False
) -> DataFrame:
    """Best author with all flags for every paper found for an editor.

    ``dedupe`` keeps the newest import per editor and paper; without it each import of a paper counts.
    """
    if dedupe:
        pubmed_ids = newest_import_rows(pubmed_ids, ["person_id"])
        summaries = latest_import(summaries, ["pmid"], "doi")
    # papers meet their editors as one row each, and their authors are listed after that: they are not moved one by one
    found = _found_papers(enriched_editors(profiles, pubmed_ids, persons)).join(_papers(summaries), "pmid")
    candidates = _each_author(found)
    key = ("person_id", "role_name", "pmid", "paper_imported")
    return best_candidates(flag_candidates(candidates, affiliation_history(paper_authors(summaries))), key).drop("paper_imported")


def priority() -> Column:
    """1 is the surest. Without a best author the result is null."""

    def yes(*flags: str) -> Column:
        condition = ~F.coalesce(F.col("has_mismatching_orcid"), F.lit(False))
        for flag in flags:
            condition = condition & F.col(flag)
        return condition

    either = F.col("has_matching_affiliation") | F.col("has_matching_previous_affiliation")
    names = yes("has_matching_last_name", "has_matching_first_name")
    return (
        F.when(F.col("has_matching_orcid"), 1)
        .when(names & either, 2)
        .when(names & F.col("has_matching_postal_code"), 3)
        .when(names & F.col("has_matching_city"), 4)
        .when(names & F.col("has_matching_country"), 5)
        .when(yes("has_matching_last_name", "has_matching_first_name_letter") & either, 6)
        .otherwise(F.lit(SCORE_PRIORITY_BASE) - F.col("author_match_score"))
    )


def paper_priorities(links: DataFrame, details: DataFrame) -> DataFrame:
    """(person_id, pmid, priority); papers named as relevant have priority 1. A paper may have two."""
    named = links.select("person_id", F.explode("relevant_pubmed_ids").alias("pmid"), F.lit(1).alias("priority"))
    rated = details.select("person_id", "pmid", priority().alias("priority"))
    return named.union(rated).distinct()


def priority_cutoffs(priorities: DataFrame, target: int = TARGET_PAPERS, maximum: int = MAX_PAPERS) -> DataFrame:
    """Largest priority to accept per person.

    The smallest one that reaches the target without passing the maximum (sure priorities may), else
    the largest one that stays below the target. The running total sees one row per priority, never
    the papers themselves, and papers without a priority do not count.
    """
    counts = (
        priorities.filter(F.col("priority").isNotNull())
        .groupBy("person_id", "priority")
        .agg(F.count(F.lit(1)).alias("papers"))
    )
    up_to = Window.partitionBy("person_id").orderBy("priority").rowsBetween(Window.unboundedPreceding, 0)
    running = counts.withColumn("running", F.sum("papers").over(up_to))
    reaches = (F.col("running") >= target) & ((F.col("running") < maximum) | (F.col("priority") <= SURE_PRIORITY))
    return running.groupBy("person_id").agg(
        F.coalesce(
            F.min(F.when(reaches, F.col("priority"))), F.max(F.when(F.col("running") < target, F.col("priority")))
        ).alias("max_preferred_priority")
    )


def selected_papers(priorities: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """(person_id, pmid) up to the person's cut-off, one row per paper."""
    return (
        priorities.filter(F.col("pmid").isNotNull())
        .join(cutoffs, "person_id")
        .filter(F.col("priority") <= F.col("max_preferred_priority"))
        .select("person_id", "pmid")
        .distinct()
    )


def as_listed(rows: DataFrame, alias: str = "pubmed_ids") -> DataFrame:
    """Rows of one id each as rows with a list of it, an empty one for none: the form in which the operators of this
    module take ids. A person may have any number of rows, so no list grows with a person."""
    return rows.withColumn(alias, F.when(F.col("pmid").isNotNull(), F.array("pmid")).otherwise(F.array().cast("array<string>"))).drop("pmid")


def as_id_lists(
    persons: DataFrame, selected: DataFrame, ids: str = "pmid", alias: str = "disambiguated_pubmed_ids"
) -> DataFrame:
    """For readers: one row per person with the sorted list of selected ids, empty when none. Jobs keep the rows."""
    lists = selected.groupBy("person_id").agg(F.array_sort(F.collect_list(ids)).alias(alias))
    return persons.join(lists, "person_id", "left").withColumn(alias, or_empty(alias))


def editor_publications(
    selected: DataFrame, links: DataFrame, pubmed_ids: DataFrame, summaries: DataFrame, doi_prefix: str
) -> DataFrame:
    """Selected papers with identifiers, date and where they came from: (person_id, publication_id, …)."""
    newest_ids = newest_import_rows(pubmed_ids, ["person_id"])
    papers = latest_import(summaries, ["pmid"], "doi").select("pmid", "doi", "firstPublicationDate")

    def listed(df, array, flag):
        return df.select("person_id", F.explode(array).alias("pmid")).distinct().withColumn(flag, F.lit(True))

    def with_null_rule(df, array):
        # not found in a list that holds a null is unknown, not false
        return df.groupBy("person_id").agg(F.max(F.exists(or_empty(array), lambda x: x.isNull())).alias("_has_null"))

    result = selected
    for source, array, flag in (
        (links, "relevant_pubmed_ids", "is_relevant_pubmed_id"),
        (newest_ids, "pubmed_ids", "is_search_pubmed_id"),
    ):
        result = (
            result.join(with_null_rule(source, array), "person_id")
            .join(listed(source, array, flag), ["person_id", "pmid"], "left")
            .withColumn(flag, F.coalesce(F.col(flag), F.when(~F.col("_has_null"), F.lit(False))))
            .drop("_has_null")
        )
    return result.join(papers, "pmid").select(
        "person_id",
        F.concat(F.lit("pmid:"), "pmid").alias("publication_id"),
        "pmid",
        "doi",
        manuscript_id_from_doi("doi", doi_prefix).alias("manuscript_id"),
        F.col("firstPublicationDate").alias("publication_date"),
        "is_relevant_pubmed_id",
        "is_search_pubmed_id",
    )


def coverage_counts(profiles: DataFrame, papers: DataFrame, links: DataFrame, pubmed_ids: DataFrame) -> DataFrame:
    """Paper and link counts per named editor; absent editors have null counts."""
    return (
        profiles.filter(F.col("Name").isNotNull())
        .select(F.col("Person_ID").alias("person_id"), F.col("Name").alias("name"))
        .join(
            papers.groupBy("person_id").agg(F.sum(F.size("disambiguated_pubmed_ids")).alias("pubmed_count")),
            "person_id", "left",
        )
        .join(
            links.select(
                "person_id",
                F.size("relevant_pubmed_urls").alias("relevant_pubmed_url_count"),
                F.size("relevant_pubmed_ids").alias("relevant_pubmed_id_count"),
                "pubmed_url", "search_term",
            ),
            "person_id", "left",
        )
        .join(
            pubmed_ids.groupBy("person_id").agg(F.sum(F.size("pubmed_ids")).alias("retrieved_pubmed_id_count")),
            "person_id", "left",
        )
    )


def coverage_flags(counts: DataFrame, few: int = 5) -> DataFrame:
    """Which editors need attention, as flags on the coverage counts."""
    count, named = F.col("pubmed_count"), F.col("relevant_pubmed_id_count")
    found = F.col("retrieved_pubmed_id_count")

    def flag(condition):
        return F.coalesce(condition, F.lit(False))

    return counts.withColumns({
        "has_unparsed_urls": flag(F.col("relevant_pubmed_url_count") > named),
        "lost_relevant_papers": flag((count == 0) & (named > 0)),
        "has_few_papers": flag((count > 0) & (count < few)),
        "found_nothing_new": flag((count <= named) & (found > named)),
        "has_only_relevant_papers": flag((count > 0) & (found <= named)),
        "has_no_papers": flag(count == 0),
    })
