"""Links, search terms, landed responses, batches, cleaning, files and the streaming form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.common import table
from checks.keywords import RENDER_SQL, SCORED_REQUESTS, _details, _requests, both_models
from deskmatch.functions import links
from deskmatch.functions.text import author_name
from deskmatch.operators.membership import not_in, pick_in_order
from deskmatch.operators.scale import scratch_folder, shuffles_dropped
from deskmatch.plans import harvest
from deskmatch.sources import batches, cleaning, evolve, files, landing
from deskmatch.streaming import scoring


def _text(column):
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def _profiles(spark, sf_dir) -> DataFrame:
    """Pages as editor profiles: searches, bibliographies, other sites, and null addresses."""
    key = _text("page_id")
    path = F.regexp_extract("url", r"//[^/]+/([a-z]+)/", 1)
    return table(spark, sf_dir, "pages").select(
        key.alias("Person_ID"),
        F.concat(F.lit("Editor "), key).alias("Name"),
        F.when(path == "fr", F.concat(F.lit("http://www.ncbi.nlm.nih.gov/pubmed/?term=Smith+J%5BAuthor%5D+OR+"), key,
                                      F.lit("%5Bpmid%5D+NOT+x"), key, F.lit("%5Bpmid%5D&sort=date")))
        .when(path == "de", F.concat(F.lit("www.ncbi.nlm.nih.gov/myncbi/user"), key, F.lit("/bibliography/public/?q")))
        .when(path == "es", F.lit(None).cast("string"))
        .otherwise(F.col("url")).alias("Pubmed_URL"),
        F.array(
            F.concat(F.lit("http://pubmed.ncbi.nlm.nih.gov/"), key, F.lit("/\n")),
            F.concat(F.lit("ncbi.nlm.nih.gov/pubmed/9"), key), F.col("url"),
        ).alias("Relevant_Pubmed_URLs"),
    )


def _parsed(spark, sf_dir) -> DataFrame:
    return harvest.parsed_links(_profiles(spark, sf_dir))


def parsed_links(spark, sf_dir) -> DataFrame:
    term = F.col("parsed_search_term")

    def values(part, field):
        return F.array_join(F.try_element_at(term[part], F.lit(field)), ",")

    return _parsed(spark, sf_dir).select(
        "person_id", "resolved_pubmed_url", F.array_join("relevant_pubmed_ids", ",").alias("relevant_ids"), "search_term",
        values("include", "author").alias("authors"), values("include", "pmid").alias("pmids"),
        values("exclude", "pmid").alias("excluded"), "is_ncbi_bibliography_url",
    )


PARSED_SQL = r"""WITH p AS (SELECT page_id::VARCHAR AS k, url, regexp_extract(url, '//[^/]+/([a-z]+)/', 1) AS path FROM pages)
SELECT k AS person_id,
  CASE path WHEN 'fr' THEN 'https://www.ncbi.nlm.nih.gov/pubmed/?term=Smith+J%5BAuthor%5D+OR+' || k || '%5Bpmid%5D+NOT+x' || k || '%5Bpmid%5D&sort=date'
    WHEN 'de' THEN 'https://www.ncbi.nlm.nih.gov/myncbi/user' || k || '/bibliography/public/?q'
    WHEN 'es' THEN NULL ELSE replace(url, 'http://', 'https://') END AS resolved_pubmed_url,
  k || ',9' || k AS relevant_ids,
  CASE WHEN path = 'fr' THEN 'Smith J[Author] OR ' || k || '[pmid] NOT x' || k || '[pmid]' END AS search_term,
  CASE WHEN path = 'fr' THEN 'Smith J' END AS authors, CASE WHEN path = 'fr' THEN k END AS pmids,
  CASE WHEN path = 'fr' THEN 'x' || k END AS excluded,
  CASE WHEN path = 'es' THEN NULL ELSE path = 'de' END AS is_ncbi_bibliography_url
FROM p"""


def bibliography_flags(spark, sf_dir) -> DataFrame:
    return harvest.bibliography_flag_counts(_parsed(spark, sf_dir))


def bibliographies_to_fetch(spark, sf_dir) -> DataFrame:
    """Bibliography editors that are not among the customers with a positive balance."""
    known = table(spark, sf_dir, "customer").filter("c_acctbal > 0").select(_text("c_custkey").alias("person_id"))
    return harvest.bibliographies_to_fetch(_parsed(spark, sf_dir), known).select("person_id", "resolved_pubmed_url")


def url_parts(spark, sf_dir) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return pages.select(
        "page_id", links.host("url").alias("host"), links.path("url").alias("path"),
        links.query_value("url", "page").alias("page"), links.query_value("url", "ref").alias("ref"),
        links.next_page_url("url", F.concat(F.lit("?page="), _text("page_id"))).alias("next_url"),
        links.is_literature_url("url").alias("is_literature"),
    )


URL_SQL = r"""SELECT page_id, regexp_extract(url, '//([^/?#]+)', 1) AS host, regexp_extract(url, '//[^/?#]+([^?#]*)', 1) AS path,
  nullif(regexp_extract(url, '[?&]page=([^&#]+)', 1), '') AS page, nullif(regexp_extract(url, '[?&]ref=([^&#]+)', 1), '') AS ref,
  regexp_extract(url, '^[^?#]*') || '?' || CASE
    WHEN contains(url, 'page=') THEN regexp_replace(regexp_extract(url, '\?([^#]*)', 1), 'page=[^&]*', 'page=' || page_id)
    WHEN contains(url, '?') THEN regexp_extract(url, '\?([^#]*)', 1) || '&page=' || page_id
    ELSE 'page=' || page_id END AS next_url,
  false AS is_literature
FROM pages"""


def term_query(spark, sf_dir) -> DataFrame:
    """Search terms built from customers, as one row per parsed item."""
    key = _text("c_custkey")
    term = F.concat(F.lit('"'), "c_name", F.lit('"[Author] OR '), key, F.lit("[pmid] OR "), "c_mktsegment",
                    F.lit("[au] NOT x"), key, F.lit("[PMID] AND [odd]"))
    # the table's files are few and small for their rows, and a term takes longer to parse than to send
    spread = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment").repartition("c_custkey")
    rows = spread.select("c_custkey", F.posexplode_outer(links.term_items(term)).alias("place", "i")).filter("i IS NOT NULL")
    return rows.select("c_custkey", "place", "i.part", "i.field", "i.value")


TERM_SQL = """SELECT c_custkey, 0 AS place, 'include' AS part, 'author' AS field, c_name AS value FROM customer
UNION ALL SELECT c_custkey, 1, 'include', 'pmid', c_custkey::VARCHAR FROM customer
UNION ALL SELECT c_custkey, 2, 'include', 'author', c_mktsegment FROM customer
UNION ALL SELECT c_custkey, 3, 'exclude', 'pmid', 'x' || c_custkey FROM customer
UNION ALL SELECT c_custkey, 4, 'include', 'author', '[odd]' FROM customer"""


def author_names(spark, sf_dir) -> DataFrame:
    """Every distinct word of the documents as a family name with initials."""
    words = table(spark, sf_dir, "documents").select(F.explode(F.array_distinct(F.split("text", "[^\\p{L}]+"))).alias("word"))
    names = words.filter("word != ''").distinct()
    given = F.concat(F.lit('  "'), "word", F.lit(', J. X Y" '))
    return names.select("word", author_name(given).alias("name"))


NAMES_SQL = r"""SELECT word, replace(strip_accents(word), 'ß', 'ss') || ' JX Y' AS name
FROM (SELECT DISTINCT unnest(regexp_split_to_array(text, '[^\p{L}]+')) AS word FROM documents) WHERE word <> ''"""


def author_name_scripts(spark, sf_dir) -> DataFrame:
    """Every distinct word of plain letters, spelt with Cyrillic and with Greek letters, as a family name."""
    words = table(spark, sf_dir, "documents").select(F.explode(F.array_distinct(F.split("text", "[^a-z]+"))).alias("word"))
    words = words.filter("word != ''").distinct()
    cyrillic = F.translate("word", "abvgdezijklmnoprstufhcy", "абвгдезийклмнопрстуфхцы")
    greek = F.translate("word", "abdeziklmnxoprt", "αβδεζικλμνξοπρτ")
    return words.select(
        "word", author_name(F.concat(cyrillic, F.lit(" Ж. Я"))).alias("cyrillic"), author_name(F.concat(greek, F.lit(", Φ"))).alias("greek"))


SCRIPTS_SQL = """SELECT word, word || ' ZA' AS cyrillic, word || ' Ph' AS greek
FROM (SELECT DISTINCT unnest(regexp_split_to_array(text, '[^a-z]+')) AS word FROM documents) WHERE word <> ''"""


def redirected_links(spark, sf_dir) -> DataFrame:
    """Customers' short addresses through redirects: chains of up to five steps that end on a search page, circles of
    three, every redirect listed twice, and some with a second target."""
    key, at = F.col("c_custkey"), F.col("c_custkey") % 12
    customer = table(spark, sf_dir, "customer")
    here, onward = F.concat(F.lit("https://short.example/p"), _text("c_custkey")), F.concat(F.lit("https://short.example/p"), _text(key + 1))
    page = F.concat(F.lit("https://www.ncbi.nlm.nih.gov/pubmed/?term=author"), _text("c_custkey"))
    target = F.when(at < 4, onward).when(at == 4, page).when(at.isin(6, 7), onward).when(at == 8, F.concat(
        F.lit("https://short.example/p"), _text(key - 2)))
    steps = customer.select(here.alias("url"), target.alias("target"))
    second = customer.filter(at == 4).select(here.alias("url"), F.lit("https://zzz.example/other").alias("target"))
    profiles = customer.select(
        _text("c_custkey").alias("Person_ID"), F.col("c_name").alias("Name"), here.alias("Pubmed_URL"),
        F.lit(None).cast("array<string>").alias("Relevant_Pubmed_URLs"))
    parsed = harvest.parsed_links(profiles, steps.unionByName(steps).unionByName(second))
    return parsed.select("person_id", "resolved_pubmed_url", "search_term")


REDIRECT_SQL = """SELECT c_custkey::VARCHAR AS person_id,
  CASE WHEN c_custkey % 12 < 5 THEN 'https://www.ncbi.nlm.nih.gov/pubmed/?term=author' || (c_custkey - c_custkey % 12 + 4)
    ELSE 'https://short.example/p' || c_custkey END AS resolved_pubmed_url,
  CASE WHEN c_custkey % 12 < 5 THEN 'author' || (c_custkey - c_custkey % 12 + 4) END AS search_term
FROM customer"""


def html_extract(spark, sf_dir) -> DataFrame:
    """Pages read as bibliography pages: paragraphs are the cited articles, the article element is the block,
    the addresses of its links give the next page. The ids are numbers of the pages' own texts."""
    html = F.replace(F.replace(F.col("html"), F.lit("<p>"), F.lit('<p class="x pmid">')), F.lit("<article>"), F.lit('<article class="citations">'))
    pager = F.concat(
        F.lit('<ul id="pager"><li><a class="nextPage enabled" href="?a=1&amp;page='), _text(F.length("html")), F.lit('">next</a></li></ul>'),
        F.lit('<a class="nextPage enabled" href="?page=0">other</a>'),
    )
    return table(spark, sf_dir, "pages").select(
        "page_id", F.array_join(F.transform(landing.cited_ids(html, "article"), lambda x: F.coalesce(x, F.lit("-"))), ",").alias("ids"),
        landing.next_page(F.when(F.col("page_id") % 3 > 0, F.concat(html, pager)).otherwise(html),
                          F.lit("http://host/path?sortby=pubDate&page=1")).alias("next_page"),
    )


HTML_SQL = r"""WITH block AS (
  SELECT page_id, html, CASE WHEN contains(html, '<article>') THEN string_split(string_split(html, '<article>')[2], '</article>')[1] ELSE '' END AS inside FROM pages
),
texts AS (
  SELECT page_id, html, [regexp_replace(regexp_replace(x, '(?s)</(p|div|li|td|tr|ul|ol|form|section|article)\b.*', ''), '<[^>]*>', '', 'g')
    FOR x IN string_split(inside, '<p>')[2:]] AS parts FROM block
)
SELECT page_id, array_to_string([coalesce(nullif(regexp_extract(x, '(?s).*\b(\d+)\b', 1), ''), '-') FOR x IN parts], ',') AS ids,
  CASE WHEN page_id % 3 > 0 THEN 'http://host/path?sortby=pubDate&page=' || length(html) END AS next_page FROM texts"""


def search_landing(spark, sf_dir) -> DataFrame:
    """Documents packed as search responses with two results each, then landed."""

    def result(pmid):
        return F.struct(
            pmid.alias("pmid"), F.col("source"), F.substring("text", 1, 40).alias("title"), F.col("text").alias("abstractText"),
            F.struct(F.array(F.struct(F.col("lang").alias("lastName"))).alias("author")).alias("authorList"),
        )

    key = _text("doc_id")
    body = F.struct(F.col("n_chars").alias("hitCount"),
                    F.struct(F.array(result(key), result(F.concat(F.lit("x"), key))).alias("result")).alias("resultList"))
    landed = table(spark, sf_dir, "documents").select("doc_id", F.to_json(body).alias("response"))
    rows = landing.search_results(landed)
    return rows.select("doc_id", "pmid", "source", "title", F.md5("abstractText").alias("text_md5"),
                       F.get("authorList.author", F.lit(0))["lastName"].alias("author"), "doi")


SEARCH_SQL = """SELECT doc_id, pmid, source, text[1:40] AS title, md5(text) AS text_md5, lang AS author, NULL::VARCHAR AS doi
FROM (SELECT *, doc_id::VARCHAR AS pmid FROM documents UNION ALL SELECT *, 'x' || doc_id FROM documents)"""


def keyword_landing(spark, sf_dir) -> DataFrame:
    """Conversation turns packed as keyword responses of two documents, then landed in order."""

    def packed(words):
        listed = F.transform(words, lambda w: F.struct(w.alias("keyword")))
        return F.struct(F.struct(listed.alias("keywords")).alias("attributes"))

    body = F.struct(F.array(packed(F.split("text", " ")), packed(F.array("role"))).alias("data"))
    landed = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.to_json(body).alias("response"))
    rows = landing.keywords_by_document(landed)
    return rows.select("conv_id", "turn", "position", F.md5(F.array_join("keywords", "|")).alias("keywords_md5"),
                       F.size("keywords").alias("n"))


KEYWORD_SQL = """SELECT conv_id, turn, 0 AS position, md5(replace(text, ' ', '|')) AS keywords_md5, len(string_split(text, ' ')) AS n
FROM conversations UNION ALL SELECT conv_id, turn, 1, md5(role), 1 FROM conversations"""


def event_landing(spark, sf_dir) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


def page_faults(spark, sf_dir) -> DataFrame:
    """Documents of one source as result pages; some are short, some break the cursor chain."""
    docs = table(spark, sf_dir, "documents")
    number = F.floor(F.col("doc_id") / 20) + 1
    results = F.transform(F.sequence(F.lit(1), F.col("n_chars") % 4 + 1), lambda n: F.struct(n.cast("string").alias("pmid")))
    body = F.struct(
        F.lit(2).alias("hitCount"),
        F.struct(F.when(number == 1, F.lit("*")).otherwise(F.concat(F.lit("c"), _text(number)))
                 .alias("cursorMark")).alias("request"),
        F.when(F.col("n_chars") % 97 == 0, F.lit("lost")).otherwise(F.concat(F.lit("c"), _text(number + 1)))
        .alias("nextCursorMark"),
        F.struct(results.alias("result")).alias("resultList"),
    )
    landed = docs.select(F.col("source").alias("query"), number.alias("page"), F.to_json(body).alias("response"))
    faults = landing.page_faults(landed, "query", "page")
    return faults.select("query", "received", "announced", "broken_links")


FAULTS_SQL = """WITH p AS (SELECT source AS query, doc_id // 20 + 1 AS page, n_chars % 4 + 1 AS n, n_chars % 97 = 0 AS lost FROM documents),
l AS (SELECT a.*, CASE WHEN a.page = 1 THEN false ELSE coalesce(b.lost, true) END AS broken
      FROM p a LEFT JOIN p b ON b.query = a.query AND b.page = a.page - 1),
t AS (SELECT query, sum(n)::BIGINT AS received, max(CASE WHEN page = 1 THEN 2 END) AS announced, count(*) FILTER (broken) AS broken_links
      FROM l GROUP BY query)
SELECT * FROM t WHERE received < announced * 0.9 OR broken_links > 0"""


def id_batches(spark, sf_dir) -> DataFrame:
    """Customer ids of all orders in batches of 1000, with the search text of each."""
    lists = batches.id_batches(table(spark, sf_dir, "orders"), "o_custkey")
    return lists.select("batch", F.size("ids").alias("n"), F.array_min("ids").alias("first"), F.array_max("ids").alias("last"),
                        batches.id_search(F.col("ids")).alias("search"))


BATCH_SQL = """WITH k AS (SELECT DISTINCT o_custkey AS id FROM orders),
n AS (SELECT id, (row_number() OVER (ORDER BY id) - 1) // 1000 AS batch FROM k)
SELECT batch, count(*) AS n, min(id) AS first, max(id) AS last,
  '(' || string_agg('EXT_ID:"' || id || '"', ' OR ' ORDER BY id) || ') AND (SRC:"MED")' AS search FROM n GROUP BY batch"""


def remaining_ids(spark, sf_dir) -> DataFrame:
    """Customers of orders without events, from three id lists, by the rules of NOT IN."""
    orders = table(spark, sf_dir, "orders")
    ids = orders.select(F.array(_text("o_custkey")).alias("pubmed_ids"))
    term = F.struct(F.create_map(F.lit("pmid"), F.array(_text("o_orderkey"))).alias("include")).alias("parsed_search_term")
    parsed = orders.select(F.array(_text(F.col("o_custkey") + 1)).alias("relevant_pubmed_ids"), term)
    known = table(spark, sf_dir, "events").select(_text("user_id").alias("pmid"))
    return harvest.papers_to_fetch(harvest.all_paper_ids(ids, parsed), known)


REMAINING_SQL = """SELECT DISTINCT id::VARCHAR AS pubmed_id FROM (
  SELECT o_custkey AS id FROM orders UNION SELECT o_custkey + 1 FROM orders UNION SELECT o_orderkey FROM orders)
WHERE id NOT IN (SELECT user_id FROM events)"""


def null_rule_ids(spark, sf_dir) -> DataFrame:
    """The same rule when the list is empty: every row stays, also the null one."""
    customer = table(spark, sf_dir, "customer").select(F.when(F.col("c_acctbal") > 0, F.col("c_custkey")).alias("id"))
    listed = table(spark, sf_dir, "orders").filter("o_totalprice < 0").select("o_custkey")
    kept = not_in(customer, "id", listed, "o_custkey")
    return kept.groupBy(F.col("id").isNull().alias("is_null")).agg(F.count(F.lit(1)).alias("n"))


NULL_RULE_SQL = """SELECT id IS NULL AS is_null, count(*) AS n
FROM (SELECT CASE WHEN c_acctbal > 0 THEN c_custkey END AS id FROM customer)
WHERE id NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice < 0) GROUP BY 1"""


def incremental_refresh(spark, sf_dir) -> DataFrame:
    """Customers whose newest order has another priority than expected, is old, or is missing."""
    parsed = table(spark, sf_dir, "customer").select(
        _text("c_custkey").alias("person_id"),
        F.when(F.col("c_nationkey") > 2, F.lit("1-URGENT")).alias("pubmed_url"),
        F.when(F.col("c_mktsegment") != "MACHINERY", F.struct("c_name")).alias("parsed_search_term"),
    )
    later = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("o_orderkey") * F.lit(0.000001))
    imports = table(spark, sf_dir, "orders").filter("o_orderstatus != 'P'").select(
        _text("o_custkey").alias("person_id"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("pubmed_url"),
        F.struct((F.col("o_orderdate").cast("timestamp") + later).alias("imported_timestamp")).alias("provenance"),
    )
    return harvest.editors_to_refresh(parsed, imports, F.lit("2001-08-01 12:00:00").cast("timestamp")).select(
        "person_id", "pubmed_url"
    )


REFRESH_SQL = """WITH last AS (
  SELECT o_custkey, o_orderpriority, o_orderdate, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders WHERE o_orderstatus <> 'P'
),
p AS (SELECT c_custkey, CASE WHEN c_nationkey > 2 THEN '1-URGENT' END AS url FROM customer WHERE c_mktsegment <> 'MACHINERY')
SELECT c_custkey::VARCHAR AS person_id, url AS pubmed_url
FROM p LEFT JOIN last ON o_custkey = c_custkey AND rn = 1
WHERE o_custkey IS NULL OR (o_orderpriority <> '5-LOW' AND o_orderpriority IS DISTINCT FROM url)
  OR o_orderdate <= TIMESTAMP '2001-07-16 00:00:00'"""


def clean_fields(spark, sf_dir) -> DataFrame:
    """Zero, empty text, empty lists and empty structs become null; False and list elements stay."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_discount",
        F.when(F.col("l_returnflag") != "A", F.col("l_returnflag")).otherwise(F.lit("")).alias("flag"),
        (F.col("l_tax") == 0).alias("untaxed"),
        F.filter(F.array("l_linenumber"), lambda x: x > 3).alias("list"),
        F.struct(F.col("l_tax").alias("tax"), F.struct(F.nullif("l_linestatus", F.lit("O")).alias("status")).alias("inner")).alias("s"),
    )
    rows = cleaning.clean_fields(lines)
    return rows.select("l_orderkey", "l_partkey", "l_linenumber", "l_discount", "flag", "untaxed", F.size("list").alias("items"),
                       F.col("s.tax").alias("tax"), F.col("s.inner").isNotNull().alias("has_inner"), "s.inner.status")


CLEAN_SQL = """SELECT nullif(l_orderkey, 0) AS l_orderkey, nullif(l_partkey, 0) AS l_partkey, l_linenumber, nullif(l_discount, 0) AS l_discount,
  CASE WHEN l_returnflag <> 'A' THEN l_returnflag END AS flag, l_tax = 0 AS untaxed, CASE WHEN l_linenumber > 3 THEN 1 END AS items,
  nullif(l_tax, 0) AS tax, l_linestatus <> 'O' AS has_inner, nullif(l_linestatus, 'O') AS status FROM lineitem"""


def delimited_roundtrip(spark, sf_dir) -> DataFrame:
    """Documents through a gzipped tab-separated file, with line breaks and quotes inside texts."""
    path = f"{scratch_folder(spark, 'files')}/documents.tsv.gz"
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars", "text")
    files.write_delimited(docs, path)
    back = files.read_delimited(spark, path, "doc_id bigint, source string, n_chars bigint, text string", True)
    return back.select("doc_id", "source", "n_chars", F.md5("text").alias("text_md5"))


def json_lines_roundtrip(spark, sf_dir) -> DataFrame:
    """Orders through cleaned JSON lines: inferred types, zero keys gone."""
    path = f"{scratch_folder(spark, 'files')}/orders.jsonl"
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", F.struct(_text("o_custkey").alias("id"), "o_orderstatus").alias("who"))
    files.write_json_lines(orders, path)
    back = files.read_json_lines(spark, path)
    return back.select("o_orderkey", "o_totalprice", F.col("who.id").alias("id"), F.col("who.o_orderstatus").alias("status"))


def schema_evolution(spark, sf_dir) -> DataFrame:
    """Two appends to one folder: the second adds a column and a nested field and brings a key as text."""
    path = scratch_folder(spark, "evolved")
    orders = table(spark, sf_dir, "orders")
    first = orders.select("o_orderkey", F.struct(F.col("o_custkey").alias("key")).alias("who"))
    second = orders.select(_text("o_orderkey").alias("O_ORDERKEY"),
                           F.struct(F.col("o_orderstatus").alias("status"), _text("o_custkey").alias("KEY")).alias("who"), "o_totalprice")
    schema = evolve.append_parquet(first, path, None)
    schema = evolve.append_parquet(second, path, schema)
    back = evolve.read_merged(spark, path, schema)
    return back.select("o_orderkey", F.col("who.key").alias("key"), F.col("who.status").alias("status"), "o_totalprice")


EVOLUTION_SQL = """SELECT o_orderkey, o_custkey AS key, NULL AS status, NULL AS o_totalprice FROM orders
UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders"""


def ordered_pick(spark, sf_dir) -> DataFrame:
    """Customer details in the order of the ids each order lists, repeats kept, unknown ids skipped."""
    lists = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.array(F.col("o_custkey"), F.lit(-1), F.col("o_custkey")).alias("ids"))
    details = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return pick_in_order(lists, ["o_orderkey"], "ids", details, "c_custkey")


PICK_SQL = """SELECT o_orderkey, position, c_custkey, c_name FROM orders JOIN customer ON c_custkey = o_custkey
CROSS JOIN (VALUES (0), (2)) p(position)"""


# requests in one arriving file: a micro-batch of the stream has a number of files, so more input makes more batches
REQUESTS_PER_FILE = 200_000


def _request_files(spark, sf_dir, least: int, part: int = 1) -> int:
    """For one in ``part`` of the documents."""
    return max(least, -(-table(spark, sf_dir, "documents").count() // (part * REQUESTS_PER_FILE)))


def stream_scoring(spark, sf_dir) -> DataFrame:
    """Every document as an arriving request, scored in micro-batches; the log of what was answered."""
    root = scratch_folder(spark, "stream")
    arriving = _requests(spark, sf_dir).select(
        _text("doc_id").alias("request_id"), "body", "keywords", F.lit("2024-01-01").cast("timestamp").alias("received"))
    with shuffles_dropped(spark):
        arriving.repartition(_request_files(spark, sf_dir, 3), "request_id").write.json(f"{root}/in")
    query = scoring.start_scoring(
        scoring.read_requests(spark, f"{root}/in", files_per_batch=2), both_models(spark, sf_dir), _details(spark, sf_dir),
        f"{root}/log", f"{root}/rejected", f"{root}/checkpoint",
    )
    query.awaitTermination()
    answered = spark.read.parquet(f"{root}/log").select(
        "request_id", F.array_join("senior_editor_recommendation.person_ids", ",").alias("senior"),
        F.array_join("reviewing_editor_recommendation.person_ids", ",").alias("reviewing"), F.lit(None).cast("string").alias("problems"),
    )
    rejected = spark.read.parquet(f"{root}/rejected").select(
        "request_id", F.lit(None).cast("string").alias("senior"), F.lit(None).cast("string").alias("reviewing"),
        F.array_join("problems", ",").alias("problems"))
    return answered.unionByName(rejected)


STREAM_SQL = f"""WITH {SCORED_REQUESTS},
top AS (SELECT doc_id, role, string_agg('p-' || name, ',' ORDER BY rank) AS ids FROM best WHERE rank <= 3 GROUP BY ALL)
SELECT d.doc_id::VARCHAR AS request_id, s.ids AS senior, r.ids AS reviewing,
  CASE WHEN coalesce(l.toxic, 0) <> 0 THEN 'title' END AS problems
FROM documents d LEFT JOIN labels l USING (doc_id)
LEFT JOIN top s ON s.doc_id = d.doc_id AND s.role = 'Senior' LEFT JOIN top r ON r.doc_id = d.doc_id AND r.role = 'Reviewing'"""


def stream_once(spark, sf_dir) -> DataFrame:
    """Every document as an arriving request; then, in a second run, every third one again with another text, and an
    hour later. The log has the first answer only: both texts, and request and time as provenance."""
    root = scratch_folder(spark, "stream")
    first = _requests(spark, sf_dir).select(
        _text("doc_id").alias("request_id"), "body", "keywords", F.lit("2024-01-01").cast("timestamp").alias("received"))
    again = first.filter(F.col("request_id").cast("long") % 3 == 0).withColumns({
        "body": F.regexp_replace("body", '"manuscript_id":"', '"manuscript_id":"again-'),
        "received": F.lit("2024-01-01 01:00:00").cast("timestamp")})
    models, details = both_models(spark, sf_dir), _details(spark, sf_dir)
    for rows, part in ((first, 1), (again, 3)):
        with shuffles_dropped(spark):
            rows.repartition(_request_files(spark, sf_dir, 2, part), "request_id").write.mode("append").json(f"{root}/in")
        scoring.start_scoring(
            scoring.read_requests(spark, f"{root}/in", files_per_batch=2), models, details,
            f"{root}/log", f"{root}/rejected", f"{root}/checkpoint",
        ).awaitTermination()
    log = spark.read.parquet(f"{root}/log")
    sides = [F.struct(F.lit(role).alias("role"), F.col(f"{role.lower()}_editor_recommendation").alias("answer")) for role in ("Senior", "Reviewing")]
    return log.select("request_id", "provenance", F.explode(F.array(*sides)).alias("side")).select(
        F.col("request_id").cast("long").alias("doc_id"), "side.role",
        F.coalesce(F.array_join("side.answer.person_ids", ","), F.lit("")).alias("person_ids"), "side.answer.recommendation_html",
        F.get_json_object("provenance.recommendation_request", "$.manuscript_id").alias("manuscript_id"),
        F.date_format("provenance.imported_timestamp", "yyyy-MM-dd HH:mm").alias("received"))


ONCE_SQL = f"""SELECT doc_id, role, person_ids, recommendation_html, doc_id::VARCHAR AS manuscript_id, '2024-01-01 00:00' AS received
FROM ({RENDER_SQL})"""


QUERIES = {
    "parsed_links": parsed_links,
    "bibliography_flags": bibliography_flags,
    "bibliographies_to_fetch": bibliographies_to_fetch,
    "url_parts": url_parts,
    "term_query": term_query,
    "author_names": author_names,
    "author_name_scripts": author_name_scripts,
    "html_extract": html_extract,
    "redirected_links": redirected_links,
    "search_landing": search_landing,
    "keyword_landing": keyword_landing,
    "event_landing": event_landing,
    "page_faults": page_faults,
    "id_batches": id_batches,
    "remaining_ids": remaining_ids,
    "null_rule_ids": null_rule_ids,
    "incremental_refresh": incremental_refresh,
    "clean_fields": clean_fields,
    "delimited_roundtrip": delimited_roundtrip,
    "json_lines_roundtrip": json_lines_roundtrip,
    "schema_evolution": schema_evolution,
    "ordered_pick": ordered_pick,
    "stream_scoring": stream_scoring,
    "stream_once": stream_once,
}
SQL = {
    "parsed_links": PARSED_SQL,
    "bibliography_flags": f"SELECT is_ncbi_bibliography_url, count(*) AS editors FROM ({PARSED_SQL}) GROUP BY 1",
    "bibliographies_to_fetch": f"""SELECT person_id, resolved_pubmed_url FROM ({PARSED_SQL})
WHERE is_ncbi_bibliography_url AND person_id NOT IN (SELECT c_custkey::VARCHAR FROM customer WHERE c_acctbal > 0)""",
    "url_parts": URL_SQL,
    "term_query": TERM_SQL,
    "author_names": NAMES_SQL,
    "author_name_scripts": SCRIPTS_SQL,
    "html_extract": HTML_SQL,
    "redirected_links": REDIRECT_SQL,
    "search_landing": SEARCH_SQL,
    "keyword_landing": KEYWORD_SQL,
    "event_landing": "SELECT event_id, json_extract(props, '$.k')::BIGINT AS k FROM events",
    "page_faults": FAULTS_SQL,
    "id_batches": BATCH_SQL,
    "remaining_ids": REMAINING_SQL,
    "null_rule_ids": NULL_RULE_SQL,
    "incremental_refresh": REFRESH_SQL,
    "clean_fields": CLEAN_SQL,
    "delimited_roundtrip": "SELECT doc_id, source, n_chars, md5(text) AS text_md5 FROM documents",
    "json_lines_roundtrip": """SELECT nullif(o_orderkey, 0) AS o_orderkey, o_totalprice, o_custkey::VARCHAR AS id,
  o_orderstatus AS status FROM orders""",
    "schema_evolution": EVOLUTION_SQL,
    "ordered_pick": PICK_SQL,
    "stream_scoring": STREAM_SQL,
    "stream_once": ONCE_SQL,
}
