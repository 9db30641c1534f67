"""Typed rows from landed responses: search results, keyword batches, bibliography pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskmatch.functions import tags
from deskmatch.functions.links import next_page_url
from deskmatch.schemas import KEYWORD_RESPONSE, SEARCH_RESPONSE

# fixed value: share of the announced hits that must have arrived
MIN_RECEIVED_SHARE = 0.9
START_CURSOR = "*"


def search_results(landed: DataFrame, raw: str = "response") -> DataFrame:
    """One row per result of each landed response; responses without a result list give none."""
    others = [c for c in landed.columns if c != raw]
    parsed = landed.select(*others, F.from_json(raw, SEARCH_RESPONSE).alias("_r"))
    return parsed.select(*others, F.explode("_r.resultList.result").alias("_item")).select(*others, "_item.*")


def result_ids(raw: Column) -> Column:
    """Article ids of one response in order, null ids included; an empty response gives an empty list."""
    results = F.from_json(raw, SEARCH_RESPONSE)["resultList"]["result"]
    return F.coalesce(F.transform(results, lambda x: x["pmid"]), F.array())


def page_faults(pages: DataFrame, query: str, page_number: str, raw: str = "response") -> DataFrame:
    """Queries whose landed pages are incomplete: (query, received, announced, broken_links).

    Received results must reach 90 % of the announced hits and each page's cursor must be the next
    cursor of the page before it. Neighbouring pages meet in an equi-join on (query, page), so one
    query with very many pages is spread like any other.
    """
    parsed = pages.select(query, page_number, F.from_json(raw, SEARCH_RESPONSE).alias("_r"))
    facts = parsed.select(
        query,
        page_number,
        F.coalesce(F.size("_r.resultList.result"), F.lit(0)).alias("results"),
        F.col("_r.hitCount").alias("hits"),
        F.col("_r.request.cursorMark").alias("cursor"),
        F.col("_r.nextCursorMark").alias("next_cursor"),
    )
    expected = facts.select(
        query, (F.col(page_number) + 1).alias(page_number), F.col("next_cursor").alias("expected"),
    )
    is_first = F.col(page_number) == 1
    linked = facts.join(expected, [query, page_number], "left").withColumn(
        "broken", ~F.when(is_first, F.lit(START_CURSOR)).otherwise(F.col("expected")).eqNullSafe(F.col("cursor"))
    )
    checked = linked.groupBy(query).agg(
        F.sum("results").alias("received"),
        F.max(F.when(is_first, F.col("hits"))).alias("announced"),
        F.count(F.when(F.col("broken"), 1)).alias("broken_links"),
    )
    short = F.col("received") < F.col("announced") * MIN_RECEIVED_SHARE
    return checked.filter(short | (F.col("broken_links") > 0))


def keyword_request(text: Column, kind: str = "extract-keyword-request") -> Column:
    """Request body that asks for the keywords of one text."""
    return F.to_json(
        F.struct(
            F.array(
                F.struct(F.lit(kind).alias("type"), F.struct(text.alias("content")).alias("attributes"))
            ).alias("data")
        )
    )


def keyword_lists(raw: Column) -> Column:
    """``array<array<string>>``: keywords per document of one response, both orders kept."""
    data = F.from_json(raw, KEYWORD_RESPONSE)["data"]
    return F.transform(data, lambda d: F.transform(d["attributes"]["keywords"], lambda k: k["keyword"]))


def keywords_by_document(landed: DataFrame, raw: str = "response") -> DataFrame:
    """One row per document of each response: other columns, ``position``, ``keywords``."""
    others = [c for c in landed.columns if c != raw]
    return landed.select(*others, F.posexplode(keyword_lists(F.col(raw))).alias("position", "keywords"))


def cited_ids(html: Column, name: str = "div") -> Column:
    """Article ids listed on a bibliography page: the last number of each element of class ``pmid`` in the citations
    block, the first element ``name`` of that class; null for an element without a number."""
    inside = tags.block(html, lambda tag: tags.has_class(tag, "citations") & tags.is_named(tag, name))
    return F.transform(tags.items(inside, lambda tag: tags.has_class(tag, "pmid")), lambda item: tags.last_number(item["text"]))


def next_page(html: Column, base_url: Column) -> Column:
    """Address of the next bibliography page, or null on the last one."""
    pager = tags.block(html, lambda tag: tags.has_id(tag, "pager"))
    links = F.filter(
        F.regexp_extract_all(pager, F.lit("<[Aa][^<>]*+>"), F.lit(0)),
        lambda tag: tags.is_named(tag, "a") & tags.has_class(tag, "nextPage", "enabled"))
    href = F.replace(F.nullif(tags.attribute(F.get(links, F.lit(0)), "href"), F.lit("")), F.lit("&amp;"), F.lit("&"))
    return tags.let(href, lambda found: F.when(found.isNotNull(), next_page_url(base_url, found)))
