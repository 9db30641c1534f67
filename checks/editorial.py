"""Keyword batches, assignments, training sets and manuscripts to recommend, on orders and customers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.common import table
from deskmatch.operators.latest import latest_per_key
from deskmatch.plans import submissions as sub


def _text(column):
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def latest_per_user(spark, sf_dir) -> DataFrame:
    events = table(spark, sf_dir, "events")
    newest = latest_per_key(events, ["user_id"], [F.desc("ts"), F.desc("event_id")])
    return newest.select("user_id", "event_id", "ts", "event_type", "value", "props")


LATEST_SQL = """SELECT user_id, event_id, ts, event_type, value, props
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1"""


def _stamp():
    """A distinct import time per order."""
    return F.timestamp_seconds(F.col("o_orderkey") + F.unix_seconds(F.col("o_orderdate").cast("timestamp")))


def _batch(spark, sf_dir, field: str, meta) -> DataFrame:
    """One landed keyword batch per order with two entries: priority words, and the status, empty for F."""
    word = F.struct(F.lit("").alias("keyword"))
    empty = F.filter(F.array(word), lambda _: F.lit(False))
    words = F.transform(F.split("o_orderpriority", "[- ]"), lambda w: F.struct(w.alias("keyword")))
    status = F.when(F.col("o_orderstatus") == "F", empty).otherwise(
        F.array(F.struct(F.col("o_orderstatus").alias("keyword")), F.struct(_text("o_orderkey").alias("keyword")))
    )

    def entry(key, keywords):
        return F.struct(F.struct(key.alias(field)).alias("meta"), F.struct(keywords.alias("keywords")).alias("attributes"))

    return table(spark, sf_dir, "orders").select(
        _stamp().alias("imported_timestamp"),
        F.array(
            entry(meta(F.col("o_custkey")), F.when(F.col("o_totalprice") < 400000, words).otherwise(empty)),
            entry(meta(F.col("o_custkey") + 1_000_000), status),
        ).alias("data"),
    )


BATCH = """
entry AS (
  SELECT o_custkey AS k, o_orderkey + epoch(o_orderdate)::BIGINT AS stamp, o_totalprice < 400000 AS filled,
         replace(replace(o_orderpriority, '-', ','), ' ', ',') AS words FROM orders
  UNION ALL
  SELECT o_custkey + 1000000, o_orderkey + epoch(o_orderdate)::BIGINT, o_orderstatus <> 'F',
         o_orderstatus || ',' || o_orderkey FROM orders
)"""


def manuscript_keywords(spark, sf_dir) -> DataFrame:
    """Newest list per version; empty lists are dropped before ranking."""
    newest = sub.manuscript_keywords(_batch(spark, sf_dir, "version_id", _text))
    return newest.select("version_id", F.array_join("extracted_keywords", ",").alias("keywords"))


MANUSCRIPT_SQL = f"""WITH {BATCH},
placed AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY stamp DESC, words) AS rn FROM entry WHERE filled)
SELECT k::VARCHAR AS version_id, words AS keywords FROM placed WHERE rn = 1"""


def _summaries(spark, sf_dir) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    both = customer.select("c_custkey", "c_mktsegment").union(
        customer.select(F.col("c_custkey") + 1_000_000, "c_mktsegment")
    )
    return both.select(
        _text("c_custkey").alias("pmid"),
        F.concat(F.lit("10.5555/JRNL."), F.lpad(_text("c_custkey"), 7, "0")).alias("doi"),
        F.col("c_mktsegment").alias("firstPublicationDate"),
        F.struct(F.lit("2020-01-01").cast("timestamp").alias("imported_timestamp")).alias("provenance"),
    )


def publication_keywords(spark, sf_dir) -> DataFrame:
    """Newest list per publication; empty lists are dropped after ranking."""
    batch = _batch(spark, sf_dir, "pmid", lambda c: c)
    rows = sub.publication_keywords(batch, _summaries(spark, sf_dir), "10.5555/jrnl.")
    return rows.withColumn("abstract_keywords", F.array_join("abstract_keywords", ","))


PUBLICATION_SQL = f"""WITH {BATCH},
placed AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY stamp DESC) AS rn FROM entry)
SELECT 'pmid:' || k AS publication_id, k::VARCHAR AS pmid, '10.5555/JRNL.' || lpad(k::VARCHAR, 7, '0') AS doi,
  lpad(k::VARCHAR, 7, '0')[1:6] AS manuscript_id, c_mktsegment AS publication_date, words AS abstract_keywords
FROM placed JOIN customer ON c_custkey = k % 1000000 WHERE rn = 1 AND filled"""


def _versions(spark, sf_dir) -> DataFrame:
    """Orders as manuscript versions; some have no editors, some an unknown or repeated one."""

    def person(key):
        return F.struct(_text(key).alias("Person_ID"))

    none = F.filter(F.array(person("o_custkey")), lambda _: F.lit(False))
    key = F.col("o_custkey")
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("m"), _text((F.col("o_orderkey") / 2).cast("bigint"))).alias("Manuscript_ID"),
        _text("o_orderkey").alias("Version_ID"),
        F.when(F.col("o_orderstatus") == "O", "Initial Submission").otherwise("Full Submission").alias("Overall_Stage"),
        F.col("o_orderdate").alias("QC_Complete_Timestamp"),
        F.when(F.col("o_orderpriority") == "1-URGENT", 2).otherwise(1).alias("Position_In_Overall_Stage"),
        F.when(F.col("o_totalprice") > 100000, F.array(person(key))).otherwise(none).alias("Senior_Editors"),
        F.when(F.col("o_totalprice") > 200000, F.array(person(key + 1), person(key + 1), person(-key))).otherwise(none)
        .alias("Reviewing_Editors"),
    )


def _persons(spark, sf_dir) -> DataFrame:
    def listed(field, *values):
        return F.array(*[F.struct(v.alias(field)) for v in values])

    return table(spark, sf_dir, "customer").select(
        _text("c_custkey").alias("Person_ID"),
        F.concat(F.lit("Name "), _text((F.col("c_custkey") / 2).cast("bigint"))).alias("Name"),
        listed("Role_Name", F.lit("Editor"), F.col("c_mktsegment")).alias("Roles"),
        F.when(F.col("c_acctbal") > 0, listed("Keyword", _text("c_nationkey"))).alias("Keywords"),
        listed("Subject_Area_Name", F.lit("Area")).alias("Subject_Areas"),
    )


ASSIGN = """
version AS (
  SELECT o_orderkey, o_custkey, o_totalprice, 'm' || o_orderkey // 2 AS manuscript_id, o_orderkey::VARCHAR AS version_id,
    CASE WHEN o_orderstatus = 'O' THEN 'Initial Submission' ELSE 'Full Submission' END AS overall_stage,
    o_orderdate AS qc_complete_timestamp, CASE WHEN o_orderpriority = '1-URGENT' THEN 2 ELSE 1 END AS position_in_overall_stage
  FROM orders
),
related AS (
  SELECT o_orderkey, 'Senior Editor' AS relationship_type, o_custkey AS person FROM version WHERE o_totalprice > 100000
  UNION ALL SELECT o_orderkey, 'Reviewing Editor', o_custkey + 1 FROM version WHERE o_totalprice > 200000
  UNION ALL SELECT o_orderkey, 'Reviewing Editor', -o_custkey FROM version WHERE o_totalprice > 200000 AND o_custkey <> 0
  UNION ALL SELECT o_orderkey, 'Reviewing Editor', 0 FROM version WHERE o_totalprice > 200000 AND o_custkey = 0
),
person AS (
  SELECT c_custkey, 'Name ' || c_custkey // 2 AS name, 'Editor|' || c_mktsegment AS person_roles,
    CASE WHEN c_acctbal > 0 THEN c_nationkey::VARCHAR ELSE '' END AS person_keywords, 'Area' AS person_subject_areas FROM customer
)"""
_VERSION_COLUMNS = "v.manuscript_id, v.version_id, v.overall_stage, v.qc_complete_timestamp, v.position_in_overall_stage"


def senior_assignments(spark, sf_dir) -> DataFrame:
    return sub.senior_assignments(_versions(spark, sf_dir), _persons(spark, sf_dir))


SENIOR_SQL = f"""WITH {ASSIGN}
SELECT {_VERSION_COLUMNS}, r.relationship_type, r.person::VARCHAR AS person_id, p.name,
  coalesce(person_roles, '') AS person_roles, coalesce(person_keywords, '') AS person_keywords,
  coalesce(person_subject_areas, '') AS person_subject_areas
FROM version v LEFT JOIN related r USING (o_orderkey) LEFT JOIN person p ON p.c_custkey = r.person"""


def reviewing_assignments(spark, sf_dir) -> DataFrame:
    return sub.reviewing_assignments(_versions(spark, sf_dir), _persons(spark, sf_dir))


REVIEWING_SQL = f"""WITH {ASSIGN}
SELECT {_VERSION_COLUMNS}, r.relationship_type, r.person::VARCHAR AS person_id, p.name, person_roles, person_keywords,
  person_subject_areas
FROM version v JOIN related r USING (o_orderkey) JOIN person p ON p.c_custkey = r.person
WHERE r.relationship_type = 'Reviewing Editor'"""


def _version_keywords(spark, sf_dir) -> DataFrame:
    orders = table(spark, sf_dir, "orders").filter("o_totalprice < 450000")
    return orders.select(_text("o_orderkey").alias("version_id"), F.split("o_orderpriority", "-").alias("extracted_keywords"))


def _editors(spark, sf_dir) -> DataFrame:
    persons = _persons(spark, sf_dir).select(F.col("Person_ID").alias("person_id"), F.col("Name").alias("name"), "Keywords")
    return persons.filter(F.col("Keywords").isNotNull()).select("person_id", "name")


TRAINING = f"""{ASSIGN},
editor AS (SELECT c_custkey, name FROM person WHERE person_keywords <> ''),
assigned AS (
  SELECT v.*, r.relationship_type, r.person, p.name FROM version v LEFT JOIN related r USING (o_orderkey)
  LEFT JOIN person p ON p.c_custkey = r.person
  WHERE o_totalprice < 450000 AND position_in_overall_stage = 1 AND p.name IN (SELECT name FROM editor)
),
initial AS (SELECT * FROM assigned WHERE overall_stage = 'Initial Submission' AND relationship_type = 'Senior Editor'),
reviewed AS (SELECT * FROM assigned WHERE overall_stage = 'Full Submission' AND relationship_type = 'Reviewing Editor')"""


def senior_training_set(spark, sf_dir) -> DataFrame:
    training = sub.senior_training(
        senior_assignments(spark, sf_dir), _version_keywords(spark, sf_dir), _editors(spark, sf_dir)
    )
    return training.select("manuscript_id", "version_id", "relationship_type", "person_id", "name")


SENIOR_TRAINING_SQL = f"""WITH {TRAINING}
SELECT manuscript_id, version_id, relationship_type, person::VARCHAR AS person_id, name FROM initial
UNION ALL SELECT manuscript_id, version_id, relationship_type, person::VARCHAR, name FROM reviewed
WHERE manuscript_id NOT IN (SELECT manuscript_id FROM initial)"""


def duplicate_manuscripts(spark, sf_dir) -> DataFrame:
    return sub.duplicate_manuscripts(senior_training_set(spark, sf_dir))


DUPLICATES_SQL = f"""WITH t AS ({SENIOR_TRAINING_SQL.replace("WITH ", "WITH ", 1)})
SELECT manuscript_id, count(*) AS occurrences FROM t GROUP BY manuscript_id HAVING count(*) > 1"""


def reviewing_training_set(spark, sf_dir) -> DataFrame:
    """Assignments plus publications of the editors that have one."""
    customer = table(spark, sf_dir, "customer")
    publications = customer.select(
        _text("c_custkey").alias("person_id"), F.explode(F.array("c_nationkey", F.lit(99))).alias("n")
    ).select("person_id", F.concat(F.lit("pmid:"), _text("n")).alias("publication_id"))
    papers = table(spark, sf_dir, "nation").select(
        F.concat(F.lit("pmid:"), _text("n_nationkey")).alias("publication_id"), F.split("n_name", "_").alias("abstract_keywords")
    )
    training, _ = sub.reviewing_training(
        reviewing_assignments(spark, sf_dir), _version_keywords(spark, sf_dir), _editors(spark, sf_dir), publications, papers
    )
    return training.select("version_id", "publication_id", "person_id", "name",
                           F.array_join("extracted_keywords", ",").alias("keywords"))


REVIEWING_TRAINING_SQL = f"""WITH {TRAINING}
SELECT version_id, NULL AS publication_id, person::VARCHAR AS person_id, name, replace(o_orderpriority, '-', ',') AS keywords
FROM reviewed JOIN orders USING (o_orderkey)
UNION ALL
SELECT NULL, 'pmid:' || c_nationkey, c_custkey::VARCHAR, e.name, replace(n_name, '_', ',')
FROM editor e JOIN customer USING (c_custkey) JOIN nation ON n_nationkey = c_nationkey
WHERE e.name IN (SELECT name FROM reviewed)"""


def manuscripts_to_recommend(spark, sf_dir) -> DataFrame:
    day = F.lit("2001-06-01").cast("timestamp")
    assigned = F.struct((day - F.make_dt_interval(F.col("o_custkey").cast("int") % 60)).alias("last_assigned_timestamp"))
    older = F.struct((day - F.expr("INTERVAL 400 DAYS")).alias("last_assigned_timestamp"))
    author = F.struct(_text("o_custkey").alias("person_id"))
    versions = table(spark, sf_dir, "orders").select(
        _text("o_orderkey").alias("version_id"),
        F.when(F.col("o_orderstatus") == "O", "Initial Submission").otherwise("Full Submission").alias("overall_stage"),
        F.when(F.col("o_orderpriority") == "2-HIGH", "rp_site").alias("source_site_id"),
        F.when(F.col("o_totalprice") > 250000, F.array(older, assigned)).otherwise(
            F.filter(F.array(older), lambda _: F.lit(False))).alias("senior_editors"),
        F.col("o_orderdate").cast("timestamp").alias("created_timestamp"),
        F.when(F.col("o_custkey") % 3 == 0, F.array(author, author)).alias("authors"),
        (F.col("o_orderpriority") == "5-LOW").alias("is_withdrawn"),
        F.when(F.col("o_custkey") % 11 != 0, F.lit(False)).alias("is_deleted"),
    )
    rows = sub.manuscripts_to_recommend(versions, _version_keywords(spark, sf_dir), day + F.expr("INTERVAL 12 HOURS"))
    return rows.select("version_id", F.array_join("extracted_keywords", ",").alias("keywords"),
                       F.array_join("author_person_ids", ",").alias("authors"))


TO_RECOMMEND_SQL = """SELECT o_orderkey::VARCHAR AS version_id, replace(o_orderpriority, '-', ',') AS keywords,
  CASE WHEN o_custkey % 3 = 0 THEN o_custkey || ',' || o_custkey ELSE '' END AS authors
FROM orders
WHERE (o_orderstatus = 'O' OR o_orderpriority = '2-HIGH') AND (o_totalprice <= 250000 OR o_custkey % 60 < 30)
  AND datediff('day', o_orderdate, TIMESTAMP '2001-06-01') < 365 AND o_orderpriority <> '5-LOW' AND o_custkey % 11 <> 0
  AND o_totalprice < 450000"""


QUERIES = {
    "latest_per_user": latest_per_user,
    "manuscript_keywords": manuscript_keywords,
    "publication_keywords": publication_keywords,
    "senior_assignments": senior_assignments,
    "reviewing_assignments": reviewing_assignments,
    "senior_training_set": senior_training_set,
    "duplicate_manuscripts": duplicate_manuscripts,
    "reviewing_training_set": reviewing_training_set,
    "manuscripts_to_recommend": manuscripts_to_recommend,
}
SQL = {
    "latest_per_user": LATEST_SQL,
    "manuscript_keywords": MANUSCRIPT_SQL,
    "publication_keywords": PUBLICATION_SQL,
    "senior_assignments": SENIOR_SQL,
    "reviewing_assignments": REVIEWING_SQL,
    "senior_training_set": SENIOR_TRAINING_SQL,
    "duplicate_manuscripts": DUPLICATES_SQL,
    "reviewing_training_set": REVIEWING_TRAINING_SQL,
    "manuscripts_to_recommend": TO_RECOMMEND_SQL,
}
