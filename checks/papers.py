"""Author matching, priorities, cut-offs and selected papers on orders, line items and customers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.common import table
from deskmatch.plans import disambiguation as dis

TARGET, MAXIMUM = 5, 12


def _text(column: str):
    return F.col(column).cast("string")


def _priorities(spark, sf_dir) -> DataFrame:
    """Customers as persons, orders as papers; cheap orders have no priority."""
    level = F.substring("o_orderpriority", 1, 1).cast("int")
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("person_id"),
        F.col("o_orderkey").alias("pmid"),
        F.when(F.col("o_totalprice") >= 30000, level).alias("priority"),
    )


PRIORITY_SQL = """
paper AS (
  SELECT o_custkey AS person_id, o_orderkey AS pmid,
         CASE WHEN o_totalprice >= 30000 THEN o_orderpriority[1]::INT END AS priority
  FROM orders
),
counts AS (SELECT person_id, priority, count(*) AS n FROM paper WHERE priority IS NOT NULL GROUP BY ALL),
running AS (
  SELECT c.person_id, c.priority,
         (SELECT sum(h.n) FROM counts h WHERE h.person_id = c.person_id AND h.priority <= c.priority) AS total
  FROM counts c
),
cutoff AS (
  SELECT person_id, coalesce(
    min(CASE WHEN total >= 5 AND (total < 12 OR priority <= 2) THEN priority END),
    max(CASE WHEN total < 5 THEN priority END)) AS max_preferred_priority
  FROM running GROUP BY person_id
),
chosen AS (
  SELECT DISTINCT p.person_id, p.pmid FROM paper p JOIN cutoff c USING (person_id)
  WHERE p.priority <= c.max_preferred_priority
)"""


def priority_cutoff(spark, sf_dir) -> DataFrame:
    return dis.priority_cutoffs(_priorities(spark, sf_dir), TARGET, MAXIMUM)


def _selected(spark, sf_dir) -> DataFrame:
    rows = _priorities(spark, sf_dir)
    return dis.selected_papers(rows, dis.priority_cutoffs(rows, TARGET, MAXIMUM))


def selected_papers(spark, sf_dir) -> DataFrame:
    return _selected(spark, sf_dir)


def selected_paper_lists(spark, sf_dir) -> DataFrame:
    """Ids per customer as text; customers without any are listed too."""
    persons = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("person_id"))
    lists = dis.as_id_lists(persons, _selected(spark, sf_dir))
    return lists.select("person_id", F.array_join("disambiguated_pubmed_ids", ",").alias("ids"))


LISTS_SQL = f"""WITH {PRIORITY_SQL},
lists AS (SELECT person_id, string_agg(pmid::VARCHAR, ',' ORDER BY pmid) AS ids FROM chosen GROUP BY person_id)
SELECT c_custkey AS person_id, coalesce(ids, '') AS ids FROM customer LEFT JOIN lists ON person_id = c_custkey"""


def _editor_tables(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame]:
    nation = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    customer = table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    day = F.lit("2020-01-01").cast("timestamp")

    def reference(kind, value, enabled, start):
        return F.struct(
            F.lit(kind).alias("reference_type"), value.alias("reference_value"), enabled.alias("is_enabled"),
            start.alias("start_timestamp"), day.alias("modified_timestamp"),
        )

    def address(country, city, code, start):
        return F.struct(
            start.alias("start_timestamp"), country.alias("country"), city.alias("city"), code.alias("postal_code")
        )

    newer = day + F.expr("INTERVAL 1 DAY")
    persons = customer.select(
        _text("c_custkey").alias("person_id"),
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", "Anna").otherwise("Otto").alias("first_name"),
        F.concat(F.lit("N"), _text("c_nationkey")).alias("last_name"),
        F.col("n_name").alias("institution"),
        F.array(
            address(F.lit("Elsewhere"), F.lit("Old Town"), F.lit("00"), day),
            address(
                F.col("r_name"),
                F.concat(F.lit("City"), (F.col("c_custkey") % 5).cast("string")),
                F.concat(F.lit("Z"), (F.col("c_custkey") % 7).cast("string")), newer,
            ),
        ).alias("addresses"),
        F.array(
            reference("UNVERIFIED_ORCID", F.concat(F.lit("o"), _text("c_nationkey")), F.lit(True), day),
            reference("ORCID", F.lit("disabled"), F.lit(False), day),
            reference("ORCID", F.lit("later"), F.col("c_acctbal") > 5000, newer),
            reference("ORCID", F.concat(F.lit("o"), (F.col("c_custkey") % 25).cast("string")),
                      F.col("c_acctbal") > 5000, day),
        ).alias("external_references"),
    )
    profiles = customer.select(
        _text("c_custkey").alias("Person_ID"), F.lit("Reviewing Editor").alias("Role_Name")
    )
    # one line per paper: the same editor may hold any number of them
    papers = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    # an id begins with its order, so rows that are alike have the same order: they meet where the join has put them
    ids = papers.select(
        "l_orderkey", _text("o_custkey").alias("person_id"),
        F.concat(F.lit("Customer "), _text("o_custkey")).alias("name"),
        F.lit(None).cast(
            "struct<include: struct<author: array<string>>, exclude: struct<author: array<string>>>"
        ).alias("parsed_search_term"),
        F.array(_pmid()).alias("pubmed_ids"),
    ).distinct().drop("l_orderkey")
    return profiles, ids, persons


def _pmid():
    return F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def _summaries(spark, sf_dir) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    supplier = table(spark, sf_dir, "supplier").join(
        table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    ).join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    # dealt by paper before the rows grow wide; rows that are alike are of the same paper
    rows = lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(
        _pmid().alias("pmid"), "l_returnflag", "l_linestatus", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate",
        "s_nationkey", "n_name", "r_name",
    ).repartition("pmid")

    def author(first, last, kind, value, *affiliations):
        return F.struct(
            first.alias("firstName"), last.alias("lastName"),
            F.concat(last, F.lit(" "), F.substring(first, 1, 1)).alias("fullName"),
            F.substring(first, 1, 1).alias("initials"),
            F.struct(F.lit(kind).alias("type"), value.alias("value")).alias("authorId"),
            F.struct(F.array(*affiliations).alias("authorAffiliation")).alias("authorAffiliationsList"),
        )

    authors = F.array(
        author(
            F.concat("l_returnflag", F.lit("nna")), F.concat(F.lit("N"), _text("s_nationkey")), "ORCID",
            F.when(F.col("l_linestatus") == "O", F.concat(F.lit("o"), _text("s_nationkey"))).otherwise(F.lit("")),
            F.col("n_name"), F.col("r_name"),
        ),
        author(
            F.concat("l_linestatus", F.lit("tto")), F.concat(F.lit("N"), (F.col("l_partkey") % 25).cast("string")),
            "OTHER", F.lit("x"),
            F.concat(F.lit("City"), (F.col("l_suppkey") % 5).cast("string")), F.concat(F.lit("Z"), _text("l_linenumber")),
        ),
    )
    return rows.select(
        "pmid", F.lit(None).cast("string").alias("doi"), F.lit("t").alias("title"),
        F.lit("2020-01-01").alias("firstPublicationDate"), F.lit("a").alias("authorString"),
        F.struct(authors.alias("author")).alias("authorList"),
        F.struct(F.col("l_shipdate").cast("timestamp").alias("imported_timestamp")).alias("provenance"),
    ).distinct()


def author_match(spark, sf_dir) -> DataFrame:
    """Best author, score, flags and priority for every paper of every editor."""
    details = dis.paper_details(*_editor_tables(spark, sf_dir), _summaries(spark, sf_dir))
    flags = [F.coalesce(f, F.lit(False)).cast("int").alias(f.removeprefix("has_")) for f in dis.POINTS]
    return details.select(
        "person_id", "pmid", "orcid", "author_first_name", "author_last_name", "author_orcid",
        F.col("author_match_score").cast("bigint").alias("score"), *flags,
        dis.priority().cast("bigint").alias("priority"),
    )


MATCH_SQL = """WITH line AS (
  SELECT DISTINCT l.l_orderkey || '-' || l.l_linenumber || '-' || l.l_partkey || '-' || l.l_suppkey AS pmid,
    l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus, l_shipdate, s_nationkey, n_name, r_name
  FROM lineitem l JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
),
author AS (
  SELECT pmid, l_orderkey, l_shipdate, 0 AS pos, l_returnflag || 'nna' AS first, 'N' || s_nationkey AS last,
    CASE WHEN l_linestatus = 'O' THEN 'o' || s_nationkey END AS orcid, n_name || ', ' || r_name AS aff FROM line
  UNION ALL
  SELECT pmid, l_orderkey, l_shipdate, 1, l_linestatus || 'tto', 'N' || l_partkey % 25, NULL,
    'City' || l_suppkey % 5 || ', Z' || l_linenumber FROM line
),
history AS (SELECT orcid, string_agg(DISTINCT aff, '; ') AS affs FROM author WHERE orcid IS NOT NULL GROUP BY orcid),
editor AS (
  SELECT c_custkey::VARCHAR AS person_id, c_custkey,
    CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'Anna' ELSE 'Otto' END AS first, 'N' || c_nationkey AS last,
    n_name AS institution, r_name AS country, 'City' || c_custkey % 5 AS city, 'Z' || c_custkey % 7 AS code,
    CASE WHEN c_acctbal > 5000 THEN 'o' || c_custkey % 25 ELSE 'o' || c_nationkey END AS orcid
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
),
flagged AS (
  SELECT e.person_id, a.pmid, a.l_shipdate, e.orcid, a.pos, a.first AS author_first_name, a.last AS author_last_name,
    a.orcid AS author_orcid,
    coalesce(a.orcid = e.orcid, false)::INT AS matching_orcid, coalesce(a.orcid <> e.orcid, false)::INT AS mismatching_orcid,
    (a.last = e.last)::INT AS matching_last_name, (a.first = e.first)::INT AS matching_first_name,
    (a.first[1] = e.first[1])::INT AS matching_first_name_letter,
    contains(a.aff, e.institution)::INT AS matching_affiliation,
    coalesce(contains(h.affs, e.institution), false)::INT AS matching_previous_affiliation,
    contains(a.aff, e.code)::INT AS matching_postal_code, contains(a.aff, e.city)::INT AS matching_city,
    contains(a.aff, e.country)::INT AS matching_country
  FROM author a JOIN orders o ON a.l_orderkey = o.o_orderkey JOIN editor e ON e.c_custkey = o.o_custkey
  LEFT JOIN history h ON h.orcid = a.orcid
),
scored AS (
  SELECT *, 50 * matching_orcid - 5 * mismatching_orcid + 20 * matching_last_name + 10 * matching_first_name
    + 5 * matching_first_name_letter + 4 * matching_affiliation + 2 * matching_previous_affiliation
    + 3 * matching_postal_code + 2 * matching_city + matching_country AS score
  FROM flagged
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY person_id, pmid, l_shipdate ORDER BY score DESC, pos) AS place FROM scored
),
best AS (SELECT *, score > 0 AS ok FROM placed WHERE place = 1)
SELECT person_id, pmid, orcid, CASE WHEN ok THEN author_first_name END AS author_first_name,
  CASE WHEN ok THEN author_last_name END AS author_last_name, CASE WHEN ok THEN author_orcid END AS author_orcid,
  CASE WHEN ok THEN score END AS score,
  ok AND matching_orcid = 1 AS matching_orcid, ok AND mismatching_orcid = 1 AS mismatching_orcid,
  ok AND matching_last_name = 1 AS matching_last_name, ok AND matching_first_name = 1 AS matching_first_name,
  ok AND matching_first_name_letter = 1 AS matching_first_name_letter,
  ok AND matching_affiliation = 1 AS matching_affiliation,
  ok AND matching_previous_affiliation = 1 AS matching_previous_affiliation,
  ok AND matching_postal_code = 1 AS matching_postal_code, ok AND matching_city = 1 AS matching_city,
  ok AND matching_country = 1 AS matching_country,
  CASE WHEN NOT ok THEN NULL WHEN matching_orcid = 1 THEN 1
    WHEN mismatching_orcid = 1 THEN 1000 - score
    WHEN matching_last_name + matching_first_name = 2 AND (matching_affiliation + matching_previous_affiliation) > 0 THEN 2
    WHEN matching_last_name + matching_first_name + matching_postal_code = 3 THEN 3
    WHEN matching_last_name + matching_first_name + matching_city = 3 THEN 4
    WHEN matching_last_name + matching_first_name + matching_country = 3 THEN 5
    WHEN matching_last_name + matching_first_name_letter = 2
      AND (matching_affiliation + matching_previous_affiliation) > 0 THEN 6
    ELSE 1000 - score END AS priority
FROM best""".replace(" = 1 AS ", " = 1)::INT AS ").replace("ok AND ", "(ok AND ")


def editor_publications(spark, sf_dir) -> DataFrame:
    """Selected orders with identifier, date and origin flags."""
    orders = table(spark, sf_dir, "orders").withColumn("person_id", F.col("o_custkey"))
    links = orders.select(
        "person_id",
        F.when(F.col("o_orderpriority") == "1-URGENT", F.array("o_orderkey"))
        .when(F.col("o_totalprice") > 499000, F.array(F.lit(None).cast("bigint")))
        .otherwise(F.array().cast("array<bigint>")).alias("relevant_pubmed_ids"),
    )
    imports = orders.select(
        "person_id",
        F.array("o_orderkey", F.col("o_orderkey") + 1).alias("pubmed_ids"),
        F.struct((F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(
            F.lit(0), F.lit(0), F.lit(0), F.col("o_orderkey") * F.lit(0.000001))).alias("imported_timestamp")
        ).alias("provenance"),
    )
    summaries = orders.select(
        F.col("o_orderkey").alias("pmid"),
        F.concat(F.lit("10.5555/JRNL."), F.lpad(_text("o_orderkey"), 5, "0")).alias("doi"),
        F.to_date("o_orderdate").alias("firstPublicationDate"),
        F.struct(F.col("o_orderdate").cast("timestamp").alias("imported_timestamp")).alias("provenance"),
    )
    return dis.editor_publications(_selected(spark, sf_dir), links, imports, summaries, "10.5555/jrnl.")


PUBLICATIONS_SQL = f"""WITH {PRIORITY_SQL},
newest AS (
  SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders
),
lists AS (
  SELECT o_custkey, bool_or(o_orderpriority <> '1-URGENT' AND o_totalprice > 499000) AS has_null FROM orders GROUP BY ALL
)
SELECT c.person_id, 'pmid:' || c.pmid AS publication_id, c.pmid, '10.5555/JRNL.' || lpad(c.pmid::VARCHAR, 5, '0') AS doi,
  lpad(c.pmid::VARCHAR, 5, '0') AS manuscript_id, o.o_orderdate::DATE AS publication_date,
  CASE WHEN o.o_orderpriority = '1-URGENT' THEN true WHEN l.has_null THEN NULL ELSE false END AS is_relevant_pubmed_id,
  c.pmid IN (n.o_orderkey, n.o_orderkey + 1) AS is_search_pubmed_id
FROM chosen c JOIN orders o ON o.o_orderkey = c.pmid JOIN lists l ON l.o_custkey = c.person_id
JOIN newest n ON n.o_custkey = c.person_id AND n.rn = 1"""


def coverage_report(spark, sf_dir) -> DataFrame:
    """Paper and link counts of named customers with the six attention flags."""
    customer = table(spark, sf_dir, "customer").withColumn("person_id", F.col("c_custkey"))
    profiles = customer.select(
        F.col("person_id").alias("Person_ID"),
        F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_name")).alias("Name"),
    )
    persons = customer.select("person_id")
    papers = dis.as_id_lists(persons, _selected(spark, sf_dir))
    some = F.filter(F.sequence(F.lit(0), F.col("c_nationkey")), lambda x: (x > 0) & (x % 5 == 0))
    links = customer.select(
        "person_id", F.sequence(F.lit(0), F.col("c_nationkey")).alias("relevant_pubmed_urls"),
        some.alias("relevant_pubmed_ids"), F.col("c_mktsegment").alias("pubmed_url"), F.lit("t").alias("search_term"),
    ).filter("c_acctbal > 0")
    found = customer.select("person_id", F.sequence(F.lit(1), F.greatest(F.lit(1), F.col("c_nationkey") - 18)).alias("pubmed_ids"))
    flagged = dis.coverage_flags(dis.coverage_counts(profiles, papers, links, found))
    flags = [c for c, t in flagged.dtypes if t == "boolean"]
    return flagged.select(
        "person_id", "name", "pubmed_count", "relevant_pubmed_url_count", "relevant_pubmed_id_count",
        "retrieved_pubmed_id_count", *[F.col(f).cast("int").alias(f) for f in flags],
    )


COVERAGE_SQL = f"""WITH {PRIORITY_SQL},
counted AS (SELECT person_id, count(*) AS n FROM chosen GROUP BY person_id),
base AS (
  SELECT c_custkey AS person_id, c_name AS name, coalesce(n, 0) AS p,
    CASE WHEN c_acctbal > 0 THEN c_nationkey + 1 END AS urls,
    CASE WHEN c_acctbal > 0 THEN c_nationkey // 5 END AS ids,
    greatest(1, c_nationkey - 18) AS found
  FROM customer LEFT JOIN counted ON person_id = c_custkey WHERE c_mktsegment <> 'MACHINERY'
)
SELECT person_id, name, p AS pubmed_count, urls AS relevant_pubmed_url_count, ids AS relevant_pubmed_id_count,
  found AS retrieved_pubmed_id_count, coalesce(urls > ids, false)::INT AS has_unparsed_urls,
  coalesce(p = 0 AND ids > 0, false)::INT AS lost_relevant_papers, (p > 0 AND p < 5)::INT AS has_few_papers,
  coalesce(p <= ids AND found > ids, false)::INT AS found_nothing_new,
  coalesce(p > 0 AND found <= ids, false)::INT AS has_only_relevant_papers, (p = 0)::INT AS has_no_papers
FROM base"""


QUERIES = {
    "priority_cutoff": priority_cutoff,
    "selected_papers": selected_papers,
    "selected_paper_lists": selected_paper_lists,
    "author_match": author_match,
    "editor_publications": editor_publications,
    "coverage_report": coverage_report,
}
SQL = {
    "priority_cutoff": f"WITH {PRIORITY_SQL} SELECT * FROM cutoff",
    "selected_papers": f"WITH {PRIORITY_SQL} SELECT * FROM chosen",
    "selected_paper_lists": LISTS_SQL,
    "author_match": MATCH_SQL,
    "editor_publications": PUBLICATIONS_SQL,
    "coverage_report": COVERAGE_SQL,
}
