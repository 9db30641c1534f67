"""Profile links: normal form, article ids, search terms, bibliography pages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from deskmatch.functions.tags import let
from deskmatch.functions.text import stripped, without_outer_quotes

# fixed values: the literature site and its article addresses
LITERATURE_HOST = "ncbi.nlm.nih.gov"
ARTICLE_PREFIXES = (
    "https://www.ncbi.nlm.nih.gov/pubmed/",
    "https://ncbi.nlm.nih.gov/pubmed/",
    "https://pubmed.ncbi.nlm.nih.gov/",
)
BIBLIOGRAPHY_SEGMENTS = ("bibliography", "collection")
DEFAULT_TERM_FIELD = "author"
TERM_FIELD_ALIASES = {"au": "author", "auth": "author"}

_MARK = "\u0001"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def normal_url(url: Column | str) -> Column:
    url = _col(url)
    secure = F.replace(url, F.lit("http://"), F.lit("https://"))
    return F.when(F.instr(url, "://") == 0, F.concat(F.lit("https://"), url)).otherwise(secure)


def _clean(url: Column | str) -> Column:
    return F.regexp_replace(_col(url), r"[\t\r\n]", "")


def host(url: Column | str) -> Column:
    """Lower-case host; null when the address has none."""
    pattern = r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)"
    return F.nullif(F.regexp_extract(F.lower(_clean(url)), pattern, 1), F.lit(""))


def path(url: Column | str) -> Column:
    return F.regexp_extract(_clean(url), r"^[^:/?#]+://[^/?#]*([^?#]*)", 1)


def query_text(url: Column | str) -> Column:
    return F.regexp_extract(_clean(url), r"^[^?#]*\?([^#]*)", 1)


def query_value(url: Column | str, name: str) -> Column:
    """First non-blank value of a query parameter, decoded; null when absent. Broken escapes stay as they are."""
    named = f"{name}="
    values = F.filter(F.split(query_text(url), "&"), lambda p: p.startswith(named) & (p != named))
    value = F.regexp_replace(F.get(values, F.lit(0)), f"^{name}=", "")
    return F.try_url_decode(F.regexp_replace(value, "%(?![0-9A-Fa-f]{2})", "%25"))


def is_literature_url(url: Column | str) -> Column:
    return host(url).endswith(LITERATURE_HOST)


def is_bibliography_url(url: Column | str) -> Column:
    listed = F.arrays_overlap(F.split(path(url), "/"), F.array(*[F.lit(s) for s in BIBLIOGRAPHY_SEGMENTS]))
    return is_literature_url(url) & listed


def search_term(url: Column | str) -> Column:
    """Search term of a literature search address; empty when blank, null for other addresses."""
    searchable = is_literature_url(url) & ~is_bibliography_url(url)
    return F.when(searchable, F.coalesce(query_value(url, "term"), F.lit("")))


def is_search_url(url: Column | str) -> Column:
    return F.coalesce(search_term(url) != "", F.lit(False))


def article_id(url: Column | str) -> Column:
    """Last path segment of an article address; null for any other address."""
    full = normal_url(url)
    is_article = F.lit(False)
    for prefix in ARTICLE_PREFIXES:
        is_article = is_article | full.startswith(prefix)
    segments = F.split(F.regexp_replace(path(full), "/+$", ""), "/")
    return F.when(is_article, stripped(F.element_at(segments, -1)))


def article_ids(urls: Column | str) -> Column:
    """Ids of the article addresses in a list; others and empty ids are skipped."""
    return F.filter(F.transform(_col(urls), article_id), lambda x: F.coalesce(x, F.lit("")) != "")


def term_items(term: Column | str) -> Column:
    """Search term as ``array<struct<part, field, value>>`` in reading order.

    ``part`` is ``exclude`` after NOT and ``include`` otherwise. The term is split at every
    operator, also inside a word, so operators and items alternate.
    """
    def item(text, before):
        named = F.regexp_extract(text, r"(?s)^[^\[]+\[(.*)\]", 1)
        field = F.lower(F.when(named == "", F.lit(DEFAULT_TERM_FIELD)).otherwise(named))
        aliases = F.create_map(*[F.lit(x) for pair in TERM_FIELD_ALIASES.items() for x in pair])
        value = without_outer_quotes(stripped(F.regexp_extract(text, r"^([^\[]+)", 1)))
        value = F.when(text.startswith("["), text).otherwise(value)
        part = F.when(before == "NOT", F.lit("exclude")).otherwise(F.lit("include"))
        return F.struct(
            part.alias("part"), let(field, lambda f: F.coalesce(F.try_element_at(aliases, f), f)).alias("field"),
            value.alias("value"))

    def items(pieces):
        # every second piece is an operator, the one before an item tells its part
        at = F.sequence(F.lit(0), F.size(pieces) - 1, F.lit(2))
        return F.transform(
            at, lambda i: let(stripped(F.get(pieces, i)), lambda text: item(text, F.when(i > 0, F.get(pieces, i - 1)))))

    pieces = F.split(F.regexp_replace(_col(term), "(OR|NOT|AND)", f"{_MARK}$1{_MARK}"), _MARK)
    return let(pieces, lambda found: F.when(found.isNotNull(), items(found)))


def parsed_term(term: Column | str) -> Column:
    """``struct<include: map<field, values>, exclude: map<field, values>>``; an unused part is null."""
    def values_by_field(items, part):
        mine = F.filter(items, lambda x: x["part"] == part)
        fields = F.array_distinct(F.transform(mine, lambda x: x["field"]))
        lists = F.transform(
            fields, lambda f: F.transform(F.filter(mine, lambda x: x["field"] == f), lambda x: x["value"])
        )
        return F.when(F.size(mine) > 0, F.map_from_arrays(fields, lists))

    def both(items):
        return F.struct(values_by_field(items, "include").alias("include"), values_by_field(items, "exclude").alias("exclude"))

    return F.when(_col(term).isNotNull(), let(term_items(term), both))


def next_page_url(base_url: Column | str, href: Column | str) -> Column:
    """Base address with ``page`` replaced by that of ``href`` (or 1) at its first place, or added at the end.

    Parameters without value are left out; repeated ones all stay, grouped by name in the order of first use.
    """
    base = _col(base_url)
    page = F.concat(F.lit("page="), F.coalesce(query_value(href, "page"), F.lit("1")))
    pairs = F.filter(F.split(query_text(base), "&"), lambda p: p.contains("=") & ~p.endswith("="))
    names = F.array_distinct(F.transform(pairs, lambda p: F.substring_index(p, "=", 1)))
    grouped = F.flatten(F.transform(names, lambda n: F.when(n == "page", F.array(page)).otherwise(
        F.filter(pairs, lambda p: F.substring_index(p, "=", 1) == n))))
    every = F.when(F.array_contains(names, "page"), grouped).otherwise(F.array_append(grouped, page))
    return F.concat(F.regexp_extract(base, r"^([^?#]*)", 1), F.lit("?"), F.array_join(every, "&"))
