import datetime as dt
import json
import random
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from deskmatch import schemas
from deskmatch.operators.keywords import rank_editors
from deskmatch.plans import daily, disambiguation as dis, forecast, harvest, jobs, recommend, reports, requests, stats
from deskmatch.sources.model_store import load_model, stored_model
from deskmatch.sources.tables import REPLACE, Tables, save_table
from deskmatch.streaming import scoring

NOW = dt.datetime(2024, 6, 1, 12)


def as_of():
    return F.lit(NOW)


def ago(**delta):
    return NOW - dt.timedelta(**delta)


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


# --- author matching ---

def author(first, last, orcid=None, affiliations=(), kind="ORCID"):
    return (first, last, f"{last} {first}", first[:1], (kind, orcid), (list(affiliations),))


PERSONS = ("person_id string, first_name string, last_name string, institution string, "
           "addresses array<struct<start_timestamp: timestamp, country: string, city: string, postal_code: string>>, "
           "external_references array<struct<reference_type: string, reference_value: string, is_enabled: boolean, "
           "start_timestamp: timestamp, modified_timestamp: timestamp>>")
IDS = ("person_id string, name string, pubmed_ids array<string>, provenance struct<source: string, "
       "imported_timestamp: timestamp>, parsed_search_term struct<include: struct<author: array<string>>>")


@pytest.fixture
def paper_tables(spark):
    profiles = frame(spark, [("e1", "Reviewing Editor", "Ann Lee")], "Person_ID string, Role_Name string, Name string")
    ids = frame(spark, [("e1", "Ann Lee", ["1", "2", "3", "4", "5", "1", None], ("s", ago(days=1)), None)], IDS)
    persons = frame(spark, [(
        "e1", "Ann", "Lee", "Inst", [(ago(days=9), "Old", "Old", "0"), (ago(days=1), "Land", "Town", "Z1")],
        [("UNVERIFIED_ORCID", "o9", True, None, None), ("ORCID", "o0", False, None, None),
         ("ORCID", "o1", True, ago(days=1), None), ("ORCID", "o2", True, ago(days=0), None)],
    )], PERSONS)

    def summary(pmid, *authors):
        return (None, pmid, None, f"10.5555/JRNL.0000{pmid}", "t", "a", (list(authors),), "text", "2020-01-02",
                ("s", ago(days=1)))

    summaries = frame(spark, [
        summary("1", author("Bob", "Poe", None, ["X"]), author("Zed", "Moe", "o1", ["Inst, Town", "Land"])),
        summary("2", author("Ann", "Lee", "", ["Y Town"]), author("Ann", "Lee", "other", ["Inst"])),
        summary("3", author("Bob", "Poe")),
        summary("4", author("Bob", "Poe"), author("Cid", "Roe")),
        summary("5", author("A.", "Lee", "o5", ["Elsewhere"], kind="OTHER"), author("Cid", "Roe", "o7", [])),
        summary("9", author("Ann", "Lee", "other", ["Past, Inst"])),
    ], schemas.MANUSCRIPT_SUMMARY)
    return profiles, ids, persons, summaries


def test_paper_details(spark, paper_tables):
    rows = {r.pmid: r for r in dis.paper_details(*paper_tables).withColumn("p", dis.priority()).collect()}
    assert set(rows) == {"1", "2", "3", "4", "5"}
    one = rows["1"]
    assert one.orcid == "o1" and one.author_last_name == "Moe" and one.primary_address.city == "Town"
    # the ORCID's own affiliation also counts as an earlier one
    assert one.author_match_score == 50 + 4 + 2 + 2 + 1 and one.p == 1
    # wrong ORCID: 20 + 10 + 5 - 5 + 4 + 2 = 36; without ORCID in the town: 20 + 10 + 5 + 2 = 37
    assert rows["2"].author_match_score == 37 and rows["2"].author_orcid is None and rows["2"].p == 4
    # the only author is kept without a score, of several none
    assert rows["3"].author_match_score == 0 and rows["3"].author_last_name == "Poe" and rows["3"].p == 1000
    assert rows["4"].author_match_score is None and rows["4"].p is None
    assert rows["5"].author_match_score == 25 and rows["5"].author_orcid is None and rows["5"].p == 975
    assert rows["1"].first_last_name_author_string == "Bob Poe; Zed Moe"


def test_repeated_imports(spark, paper_tables):
    profiles, ids, persons, summaries = paper_tables
    later = summaries.withColumn("provenance", F.struct(F.lit("s").alias("source"), as_of().alias("imported_timestamp")))
    both = summaries.unionByName(later)
    assert dis.paper_details(profiles, ids, persons, both).count() == 10
    assert dis.paper_details(profiles, ids, persons, both, dedupe=True).count() == 5


def brute_cutoff(rows, target, maximum):
    counts = {}
    for priority in rows:
        if priority is not None:
            counts[priority] = counts.get(priority, 0) + 1
    total, above, below = 0, [], []
    for priority in sorted(counts):
        total += counts[priority]
        if total >= target and (total < maximum or priority <= 2):
            above.append(priority)
        if total < target:
            below.append(priority)
    return min(above) if above else max(below) if below else None


def test_cutoffs_and_lists(spark):
    rng = random.Random(3)
    papers = {f"e{i}": [rng.choice([None, 1, 2, 3, 6, 950, 1000]) for _ in range(rng.randrange(1, 40))] for i in range(30)}
    rows = [(e, f"{e}-{n}", p) for e, ps in papers.items() for n, p in enumerate(ps)]
    priorities = frame(spark, rows + [("e0", None, 1)], "person_id string, pmid string, priority int")
    papers["e0"].append(1)
    cutoffs = dis.priority_cutoffs(priorities, 5, 12)
    found = {r.person_id: r.max_preferred_priority for r in cutoffs.collect()}
    expected = {e: brute_cutoff(ps, 5, 12) for e, ps in papers.items()}
    assert found == {e: p for e, p in expected.items() if e in found} and all(expected[e] is None for e in set(expected) - set(found))
    chosen = dis.selected_papers(priorities, cutoffs)
    wanted = {(e, pmid) for e, pmid, p in rows if p is not None and expected[e] is not None and p <= expected[e]}
    assert {(r.person_id, r.pmid) for r in chosen.collect()} == wanted
    people = frame(spark, [(e,) for e in papers] + [("nobody",)], "person_id string")
    lists = dis.as_id_lists(people, chosen).collect()
    assert {(r.person_id, i) for r in lists for i in r.disambiguated_pubmed_ids} == wanted
    assert [r.disambiguated_pubmed_ids for r in lists if r.person_id == "nobody"] == [[]]
    assert len(lists) == len(papers) + 1


# --- series ---


def test_series_shape(spark):
    good = frame(spark, [(dt.date(2020, 1, 1), 1)], "d date, n int")
    assert daily.as_series(good).columns == ["ds", "y"]
    for schema, row in (("d date, n int, m int", (dt.date(2020, 1, 1), 1, 1)), ("d string, n int", ("x", 1)),
                        ("d date, n double", (dt.date(2020, 1, 1), 1.0))):
        with pytest.raises(ValueError):
            daily.as_series(frame(spark, [row], schema))


def test_forecast_recovers_an_additive_series(spark):
    days = [dt.date(2020, 1, 1) + dt.timedelta(days=i) for i in range(700)]
    rows = [("s", d, 100 + 2 * i + (50 if d.weekday() == 0 else 0)) for i, d in enumerate(days)]
    rows += [("one", days[0], 5)]
    ahead = forecast.additive_forecast(frame(spark, rows, "s string, ds date, y int"), ["s"], 14).toPandas()
    assert ahead.groupby("s").size().to_dict() == {"s": 14, "one": 14}
    assert (ahead[ahead.s == "one"].yhat == 5).all()
    mine = ahead[ahead.s == "s"].sort_values("ds").reset_index(drop=True)
    truth = pd.Series([100 + 2 * (700 + i) + (50 if d.weekday() == 0 else 0) for i, d in enumerate(mine.ds)])
    assert (mine.yhat - truth).abs().max() < 6
    assert (mine.yhat_lower <= mine.yhat).all()


def test_month_opening_compat(spark):
    actual = frame(spark, [("s", dt.date(2020, m, 15), 10 ** (m - 9)) for m in (9, 10, 11)], "s string, ds date, y int")
    ahead = frame(spark, [("s", dt.date(2020, 11, 16 + i), 1.5, 2.5, 3.5) for i in range(2)],
                  "s string, ds date, yhat_lower double, yhat double, yhat_upper double")
    plain = daily.forecast_table(actual, ahead, ["s"], "m").orderBy("Date").collect()
    compat = daily.forecast_table(actual, ahead, ["s"], "m", quarter_as_month=True).orderBy("Date").collect()
    assert [r.Forecast_Value for r in plain] == [2, 2]
    assert [r.Forecast_Month_Offset_Value for r in plain] == [102, 2]
    assert [r.Forecast_Quarter_Offset_Value for r in plain] == [112, 2]
    assert [r.Forecast_Year_Offset_Value for r in plain] == [113, 2]
    assert compat[0].Forecast_Month_Offset_Value == 102


def test_period_sums(spark):
    actual = frame(spark, [("s", dt.date(2020, m, 15), m) for m in range(1, 13)], "s string, ds date, y int")
    ahead = frame(spark, [("s", dt.date(2021, 1, 1), 0.0, 1.5, 2.0)],
                  "s string, ds date, yhat_lower double, yhat double, yhat_upper double")
    rows = {(r.period, r.start.isoformat()): (r.actual_sum, r.forecast_sum) for r in daily.period_sums(actual, ahead, ["s"]).collect()}
    assert len(rows) == 27 and rows["month", "2020-12-01"] == (12.0, 0.0) and rows["year", "2021-01-01"] == (0.0, 1.5)


# --- harvest ---


def test_redirects_and_ids(spark):
    profiles = frame(spark, [("e1", "n", "http://short.example/x", None), ("e2", "n", None, ["pubmed.ncbi.nlm.nih.gov/7/"])],
                     "Person_ID string, Name string, Pubmed_URL string, Relevant_Pubmed_URLs array<string>")
    target = "https://pubmed.ncbi.nlm.nih.gov/?term=Lee+A%5BAuthor%5D+OR+8%5Bpmid%5D"
    redirects = frame(spark, [("https://short.example/x", target)], "url string, target string")
    rows = {r.person_id: r for r in harvest.parsed_links(profiles, redirects).collect()}
    assert rows["e1"].search_term == "Lee A[Author] OR 8[pmid]" and rows["e2"].relevant_pubmed_ids == ["7"]
    assert rows["e2"].parsed_search_term is None and rows["e2"].is_ncbi_bibliography_url is None
    ids = frame(spark, [(["1", "7"],)], "pubmed_ids array<string>")
    every = harvest.all_paper_ids(ids, harvest.parsed_links(profiles, redirects))
    assert sorted(r.pubmed_id for r in every.collect()) == ["1", "7", "8"]


# --- requests ---


def request(**changes):
    body = {"manuscript_id": "m", "tracking_number": "t", "revision_number": 0, "abstract": "abc", "title": "x",
            "author_suggestion": {name: [] for name in schemas.SUGGESTION_LISTS}}
    body.update(changes)
    return json.dumps({k: v for k, v in body.items() if v != "drop"})


@pytest.mark.parametrize("body,problems", [
    (request(), []), (request(extra=1), []), (request(revision_number=1.0), []),
    (request(revision_number=1.5), ["revision_number"]), (request(revision_number="1"), ["revision_number"]),
    (request(abstract=5), ["abstract"]), (request(title=None), ["title"]), (request(title="drop"), ["title"]),
    (request(author_suggestion=[]), ["author_suggestion"]),
    (request(author_suggestion={n: [] for n in schemas.SUGGESTION_LISTS[1:]}), [schemas.SUGGESTION_LISTS[0]]),
    (request(author_suggestion={n: [1] for n in schemas.SUGGESTION_LISTS}), list(schemas.SUGGESTION_LISTS)),
    (request(author_suggestion={n: ["a", None] for n in schemas.SUGGESTION_LISTS}), list(schemas.SUGGESTION_LISTS)),
    (request(author_suggestion={n: ["a", "b"] for n in schemas.SUGGESTION_LISTS}), []),
    ("[1]", None), ("no json", None), ("{}", None),
])
def test_request_checks(spark, body, problems):
    row = requests.checked_requests(frame(spark, [(body,)], "body string")).first()
    if problems is None:
        assert row.problems
    else:
        assert row.problems == problems
    if problems == []:
        assert row.abstract == "abc" and isinstance(row.include_senior_editors_id, list)


def test_no_recommendation(spark):
    checked = requests.checked_requests(frame(spark, [("r", request(author_suggestion={
        n: ["p1"] for n in schemas.SUGGESTION_LISTS}))], "request_id string, body string"))
    nothing = frame(spark, [], "request_id string, role string, name string, person_id string, score double, rank int")
    details = stats_row(spark)
    rows = requests.responses(requests.valid_requests(checked), nothing, details, "request_id").collect()
    assert {r.role for r in rows} == {"Senior", "Reviewing"} and all(r.person_ids == [] for r in rows)
    assert all(r.recommendation_html.endswith("</h4> No recommendation available") for r in rows)
    assert all(r.recommendation_html.count("Not provided") == 2 for r in rows)
    documents = requests.response_documents(requests.responses(
        requests.valid_requests(checked), nothing, details, "request_id"), "request_id").first()
    assert set(json.loads(documents.response)) == {"senior_editor_recommendation", "reviewing_editor_recommendation"}


def stats_row(spark):
    columns = ("person_id", "person_name", "institution", "country", "website", "pubmed", "availability", *stats.STAT_COLUMNS)
    return frame(spark, [("p1", "Ann Lee", "Inst") + (None,) * (len(columns) - 3)], ", ".join(f"{c} string" for c in columns))


# --- reports ---


def test_matching_report(spark):
    editors = frame(spark, [("p1", "A", "Senior Editor"), ("p2", "B", "Senior Editor"), ("p3", "C", "Other")],
                    "Person_ID string, Name string, Role_Name string")
    version = ("manuscript_id string, version_id string, long_manuscript_identifier string, manuscript_title string, "
               "abstract string, overall_stage string, source_site_id string, "
               "stages array<struct<stage_name: string, stage_timestamp: timestamp>>, is_withdrawn boolean, is_deleted boolean")
    assigned = "Senior Editor Assigned"

    def row(key, stages, stage="Initial Submission", site=None, withdrawn=False, deleted=False, title="T"):
        return ("m", key, f"L{key}", title, "a", stage, site, stages, withdrawn, deleted)

    versions = frame(spark, [
        row("v1", [("Check", ago(days=80)), (assigned, ago(days=99)), (assigned, ago(days=95))]),
        row("v2", [("Check", ago(days=80)), (None, None)]), row("v3", [("Check", ago(days=91))]),
        row("v4", [(assigned, ago(days=30)), (assigned, ago(days=40))], stage="Full", site="rp_site"),
        row("v5", [("Check", ago(days=1))], withdrawn=True), row("v6", None), row("v7", [("Check", ago(days=1))], deleted=None),
    ], version)
    rated = frame(spark, [("v4", "p1", 0.5, [(0.4, "x"), (0.1, "y")]), ("v2", "p3", 0.9, [])],
                  "version_id string, person_id string, score double, matching_keywords array<struct<score: double, keyword: string>>")
    rows = reports.in_report_order(reports.matching_report(editors, versions, rated, reports.SENIOR_REPORT, as_of())).collect()
    assert [(r.Version_ID, r.Person_ID) for r in rows[:1]] == [("v4", "p1")]
    assert sorted((r.Version_ID or "", r.Person_ID or "") for r in rows) == [("", "p1"), ("", "p2"), ("v2", ""), ("v4", "p1")]
    texts = {(r.Version_ID, r.Person_ID): r for r in rows}
    assert texts["v4", "p1"].Display_Manuscript_Identifier_With_State == "Lv4 (SE assigned) - T"
    assert texts["v4", "p1"].Has_Recommendation and texts["v2", None].Matching_Keywords_CSV == ""
    assert texts["v4", "p1"].Matching_Keywords_CSV == "x, y"
    assert texts["v4", "p1"].Senior_Editor_Assigned_Timestamp == ago(days=30)
    assert texts["v2", None].Display_Manuscript_Identifier_With_State == "Lv2 (no recommendation yet) - T"
    assert texts[None, "p1"].Display_Manuscript_Identifier_With_State == "~ No Manuscript Selected ~"
    assert texts[None, "p1"].Has_Recommendation is False


# --- whole flow on small tables ---


@pytest.fixture
def flow(spark):
    for name in ("flow_in", "flow_out"):
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
        spark.sql(f"CREATE DATABASE {name}")
    tables = Tables(spark, "flow_in", "flow_out")

    def put(name, rows, schema):
        save_table(frame(spark, rows, schema), tables.source_name(name), REPLACE)

    editor = "Person_ID string, Name string, Role_Name string, Pubmed_URL string, Relevant_Pubmed_URLs array<string>, Website_URL string, Dates_Not_Available_CSV string"
    base = "https://www.ncbi.nlm.nih.gov"
    put("mv_Editorial_Editor_Profile", [
        ("s1", "Sue", "Senior Editor", None, None, "w", None), ("s2", "Sam", "Senior Editor", None, None, None, None),
        ("r1", "Ann Lee", "Reviewing Editor", f"{base}/pubmed/?term=Lee+A%5BAuthor%5D", [f"{base}/pubmed/4"], None, None),
        ("r2", "Bob Poe", "Reviewing Editor", f"{base}/x/bibliography/", None, None, None),
    ], editor)
    people = [("s1", "Sue"), ("s2", "Sam"), ("r1", "Ann Lee"), ("r2", "Bob Poe")]
    put("mv_Editorial_Person", [(k, n, "Inst", ("Land",), [("Editor",)], None, None) for k, n in people],
        "Person_ID string, Name string, institution string, Primary_Address struct<Country: string>, Roles array<struct<Role_Name: string>>, "
        "Keywords array<struct<Keyword: string>>, Subject_Areas array<struct<Subject_Area_Name: string>>")
    put("mv_person_v2", [(k, n.split()[0], n.split()[-1], "Inst", None, None) for k, n in people], PERSONS)
    rng = random.Random(2)
    words = {"s1": "abcde", "s2": "cdefg", "r1": "abfgh", "r2": "efghi"}
    versions, batch, manuscripts = [], [], []
    for i in range(80):
        senior, reviewing = rng.choice(["s1", "s2"]), rng.choice(["r1", "r2"])
        stage = "Initial Submission" if i % 2 else "Full Submission"
        versions.append((f"m{i}", f"v{i}", stage, NOW, 1, [(senior,)], [(reviewing,)]))
        keys = [(rng.choice(words[senior]),) for _ in range(3)] + [(rng.choice(words[reviewing]),) for _ in range(3)]
        batch.append((NOW, [((f"v{i}",), (keys,))]))
        manuscripts.append((f"v{i}", f"m{i}", f"L{i}", "T", "abc", stage, None, [("Check", ago(days=1))], [("s1",)] if i == 1 else [],
                            [], ago(days=3), False, False))
    put("mv_Editorial_All_Manuscript_Version", versions,
        "Manuscript_ID string, Version_ID string, Overall_Stage string, QC_Complete_Timestamp timestamp, Position_In_Overall_Stage int, "
        "Senior_Editors array<struct<Person_ID: string>>, Reviewing_Editors array<struct<Person_ID: string>>")
    put("keywords_from_manuscript_abstract_batch", batch,
        "imported_timestamp timestamp, data array<struct<meta: struct<version_id: string>, attributes: struct<keywords: array<struct<keyword: string>>>>>")
    put("keywords_from_disambiguated_editor_papers_abstract_batch", [(NOW, [((1,), ([("a",), ("b",)],)), ((4,), ([("h",)],))])],
        "imported_timestamp timestamp, data array<struct<meta: struct<pmid: bigint>, attributes: struct<keywords: array<struct<keyword: string>>>>>")
    put("keyword_exclusion", [("i",)], schemas.KEYWORD_EXCLUSION)
    put("mv_manuscript_version", manuscripts,
        "version_id string, manuscript_id string, long_manuscript_identifier string, manuscript_title string, abstract string, "
        "overall_stage string, source_site_id string, stages array<struct<stage_name: string, stage_timestamp: timestamp>>, "
        "authors array<struct<person_id: string>>, senior_editors array<struct<last_assigned_timestamp: timestamp>>, "
        "created_timestamp timestamp, is_withdrawn boolean, is_deleted boolean")
    return tables


def found(*pmids):
    return json.dumps({"resultList": {"result": [
        {"pmid": p, "doi": f"10.5555/JRNL.0000{p}", "authorList": {"author": [{"firstName": "Ann", "lastName": "Lee"}]}} for p in pmids]}})


def test_whole_flow(spark, flow, tmp_path):
    assert jobs.parse_links(flow) == 4
    pages = frame(spark, [("r2", '<div class="citations"><b class="pmid">2</b></div>')], "person_id string, html string")
    assert jobs.import_bibliography_ids(flow, pages, as_of()) == 1
    searches = frame(spark, [("r1", found("1", "4")), ("s1", found("9"))], "person_id string, response string")
    assert jobs.import_search_ids(flow, searches, as_of()) == 2  # one row per id
    assert jobs.import_search_ids(flow, searches, as_of()) == 0
    latest = jobs.snapshot_ids(flow)
    assert {(r.person_id, r.pmid) for r in latest.collect()} == {("r1", "1"), ("r1", "4"), ("r2", "2")}
    papers = frame(spark, [(found("1", "2", "4", "8"),)], "response string")
    assert jobs.import_summaries(flow, papers, latest, as_of()) == 3
    assert jobs.import_summaries(flow, papers, latest, as_of()) == 0
    flags = {r.person_id: r for r in jobs.disambiguate(flow, latest).collect()}
    assert flags["r1"].pubmed_count == 2 and flags["r2"].pubmed_count == 1 and flags["s1"].has_no_papers

    model_path = str(tmp_path / "model")
    both = jobs.senior_profiles(flow).unionByName(jobs.reviewing_profiles(flow, latest, "10.5555/jrnl."))
    jobs.build_model(both, model_path)
    model = load_model(spark, model_path)
    assert {(r.role, r.name) for r in model.editors.collect()} == {
        ("Senior", "Sue"), ("Senior", "Sam"), ("Reviewing", "Ann Lee"), ("Reviewing", "Bob Poe")}
    assert model.terms.filter("keyword = 'i'").count() == 0
    written = jobs.recommend_editors(flow, model_path, recommend.SENIOR_ROLE, as_of())
    rows = flow.output("editor_recommendation")
    assert written == rows.count() > 40
    assert rows.filter("version_id = 'v1' and person_id = 's1'").count() == 0
    assert jobs.recommend_editors(flow, model_path, recommend.REVIEWING_ROLE, as_of(), limit=3) <= 6
    shown = jobs.update_report(flow, recommend.SENIOR_ROLE, as_of())
    report = flow.output("Manuscript_Version_Matching_Editor_Profile")
    scored = rows.join(report.select(F.col("Version_ID").alias("version_id")).distinct(), "version_id", "left_semi").count()
    assert report.select("Version_ID").distinct().count() == 41 and report.filter("Version_ID IS NULL").count() == 2
    assert shown == report.count() == scored + report.filter("Person_ID IS NULL").count() + 2
    series = frame(spark, [("s", dt.date(2024, 1, 1) + dt.timedelta(days=i), i) for i in range(60)], "s string, d date, n int")
    assert jobs.forecast_metric(flow, series, "x", ("s",)) == 60 + 396
    assert len(flow.output("Forecast_x").columns) == 25


def test_stream_survives_replay(spark, tmp_path):
    trained = frame(spark, [(f"n{i % 2}", f"p{i % 2}", ["a", f"w{i % 2}"], i) for i in range(20)],
                    "name string, person_id string, extracted_keywords array<string>, i int")
    model = stored_model(role_profiles_for(trained))
    source, log, rejected = (str(tmp_path / n) for n in ("in", "log", "rejected"))
    rows = [("r1", request(), ["w1"], NOW), ("r2", request(abstract=""), ["w1"], NOW), ("r3", "{}", ["w1"], NOW)]
    frame(spark, rows, scoring.REQUEST_FILE).write.json(source)
    stream = scoring.start_scoring(scoring.read_requests(spark, source), model, stats_row(spark), log, rejected,
                                   str(tmp_path / "checkpoint"))
    stream.awaitTermination()
    batch = frame(spark, rows, scoring.REQUEST_FILE)
    scoring.score_batch(batch, 0, model, stats_row(spark), log, rejected)
    answered = {r.request_id: r for r in spark.read.parquet(log).collect()}
    assert set(answered) == {"r1", "r2"} and spark.read.parquet(log).count() == 2
    assert answered["r1"].senior_editor_recommendation.person_ids == ["p1"]
    assert answered["r2"].senior_editor_recommendation.person_ids is None
    assert answered["r1"].provenance.imported_timestamp == NOW
    assert [r.request_id for r in spark.read.parquet(rejected).collect()] == ["r3"]


def test_stream_answers_a_repeated_request_once(spark, tmp_path):
    trained = frame(spark, [(f"n{i % 2}", f"p{i % 2}", ["a", f"w{i % 2}"], i) for i in range(20)],
                    "name string, person_id string, extracted_keywords array<string>, i int")
    model = stored_model(role_profiles_for(trained))
    source, log, rejected, checkpoint = (str(tmp_path / n) for n in ("in", "log", "rejected", "checkpoint"))
    later = NOW + dt.timedelta(hours=1)
    runs = [[("r1", request(), ["w1"], NOW), ("r1", request(), ["w1"], NOW), (None, request(title="a"), ["w0"], NOW)],
            [("r1", request(), ["w0"], later), ("r2", request(), ["w0"], later), (None, request(title="a"), ["w0"], later), ("r3", "{}", [], later)],
            [("r3", "{}", [], later)]]
    for rows in runs:
        frame(spark, rows, scoring.REQUEST_FILE).coalesce(1).write.mode("append").json(source)
        scoring.start_scoring(scoring.read_requests(spark, source), model, stats_row(spark), log, rejected, checkpoint).awaitTermination()
    answered = spark.read.parquet(log).filter("request_id is not null").collect()
    assert sorted((r.request_id, *r.senior_editor_recommendation.person_ids) for r in answered) == [("r1", "p1"), ("r2", "p0")]
    assert [r.request_id for r in spark.read.parquet(rejected).collect()] == ["r3"]


def role_profiles_for(trained):
    return recommend.role_profiles(trained, trained, "Senior", ("i",))


def test_ranking_ties_fall_by_name(spark):
    scores = frame(spark, [("v", "Senior", n, s) for n, s in (("a", 0.5), ("b", 0.5), ("c", 0.0001))],
                   "version_id string, role string, name string, score double")
    assert [r.name for r in rank_editors(scores).orderBy("rank").collect()] == ["b", "a"]


def test_redirects_lead_through_chains(spark):
    rng = random.Random(3)
    for _ in range(3):
        steps = [(f"u{rng.randrange(60)}", f"u{rng.randrange(90)}") for _ in range(70)] + [(f"c{i}", f"c{i + 1}") for i in range(40)]
        steps += [("x", "y"), ("y", "x"), ("z", "x"), ("s", "s"), (None, "a"), ("n", None)] + steps[:5]
        one = {}
        for url, target in steps:
            if url is not None and target is not None and url != target:
                one[url] = min(target, one.get(url, target))
        expected = {}
        for url in one:
            seen, at = {url}, one[url]
            while at in one and at not in seen:
                seen.add(at)
                at = one[at]
            if at not in one:
                expected[url] = at
        found = harvest.final_targets(frame(spark, steps, "url string, target string"))
        assert sorted(map(tuple, found.collect())) == sorted(expected.items())
    assert harvest.final_targets(frame(spark, [], "url string, target string")).count() == 0


def test_candidates_stay_dealt_by_paper(spark):
    """Spark's own size of a large input stands in for one: only what is stored is known to be small."""
    editors = spark.createDataFrame([("1", "i", ["a", "b"])], "person_id string, institution string, pubmed_ids array<string>").select(
        "*", F.lit("r").alias("role_name"), F.lit("o").alias("orcid"), F.lit("x").alias("first_name"), F.lit("y").alias("last_name"),
        F.struct(F.lit("c").alias("country"), F.lit("t").alias("city"), F.lit("z").alias("postal_code")).alias("primary_address"))
    authors = spark.createDataFrame(
        [("a", 0, "o", "at i"), ("a", 1, None, "at j"), ("b", 0, "o", "at j")],
        "pmid string, author_position int, author_orcid string, affiliation_string string").select(
        "*", F.lit("x").alias("author_first_name"), F.lit("y").alias("author_last_name"), F.lit("xy").alias("author_full_name"),
        F.lit("x").alias("author_initials"))
    flagged = dis.flag_candidates(dis.author_candidates(editors, authors), dis.affiliation_history(authors))
    plan = flagged._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan  # the earlier affiliations are read back, not counted on the way
    found = {(r["pmid"], r["author_position"]): r["has_matching_previous_affiliation"] for r in flagged.collect()}
    assert found == {("a", 0): True, ("a", 1): None, ("b", 0): True}


def test_redirects_stop_when_only_circles_are_left(spark, monkeypatch):
    stored, kept = [], harvest.materialise
    monkeypatch.setattr(harvest, "materialise", lambda df, label: stored.append(df) or kept(df, label))
    chains = [(f"u{i}-{j}", f"u{i}-{j + 1}") for i in range(40) for j in range(5)]
    circles = [("a", "b"), ("b", "c"), ("c", "a"), ("into", "b"), ("x", "y"), ("y", "x")]
    found = harvest.final_targets(frame(spark, chains + circles, "url string, target string"))
    assert {tuple(r) for r in found.collect()} == {(url, f"{url.split('-')[0]}-5") for url, _ in chains}
    # five steps take four rounds, one more shows that the rest are circles; nothing goes through the driver
    assert len(stored) <= 1 + 5
    assert all("BroadcastHashJoin" not in df._jdf.queryExecution().executedPlan().toString() for df in stored)


def test_authors_are_listed_after_papers_met_their_editors(spark, paper_tables):
    details = dis.paper_details(*paper_tables)
    plan = details._jdf.queryExecution().optimizedPlan().toString()
    # below the join a paper is one row, however many authors it has
    assert plan.index("posexplode") < plan.index("Join Inner") and plan.count("posexplode") == 1


def test_stream_holds_one_batch_on_disk_and_none_in_memory(spark, tmp_path, monkeypatch):
    trained = frame(spark, [(f"n{i % 2}", f"p{i % 2}", ["a", f"w{i % 2}"], i) for i in range(20)],
                    "name string, person_id string, extracted_keywords array<string>, i int")
    model = stored_model(role_profiles_for(trained))
    source, log, rejected, checkpoint = (str(tmp_path / n) for n in ("in", "log", "rejected", "checkpoint"))
    rows = [(f"r{i}", request() if i % 3 else "{}", [f"w{i % 2}"], NOW) for i in range(12)]
    frame(spark, rows, scoring.REQUEST_FILE).repartition(4).write.json(source)
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager()
    kept, seen, scored = scoring.score_batch, [], scoring.req.recommended_editors

    def looked(*args):
        seen.append(len(spark.sparkContext._jsc.getPersistentRDDs()))
        return scored(*args)

    held = []
    monkeypatch.setattr(scoring.req, "recommended_editors", looked)
    monkeypatch.setattr(scoring, "score_batch", lambda *args: held.append(args[6]) or kept(*args))

    def shuffled():
        return {x for x in blocks.diskBlockManager().getAllBlocks().mkString(" ").split() if x.startswith("shuffle_")}

    before = shuffled()
    scoring.start_scoring(scoring.read_requests(spark, source, files_per_batch=1), model, stats_row(spark), log, rejected,
                          checkpoint).awaitTermination()
    assert len(seen) >= 3 and not any(seen)
    until = time.monotonic() + 20
    while shuffled() - before and time.monotonic() < until:
        time.sleep(0.2)
    assert not shuffled() - before
    # every batch uses the same folder, and at the end no request is left in it
    assert len(set(held)) == 1 and spark.read.parquet(held[0]).count() == 0
    assert {r["request_id"] for r in spark.read.parquet(log).collect()} == {f"r{i}" for i in range(12) if i % 3}
    assert {r["request_id"] for r in spark.read.parquet(rejected).collect()} == {f"r{i}" for i in range(0, 12, 3)}


def test_more_requests_make_more_batches_of_the_same_size(spark, tmp_path, monkeypatch):
    from checks import landing

    monkeypatch.setattr(landing, "REQUESTS_PER_FILE", 10)
    spark.range(95).write.parquet(str(tmp_path / "documents.parquet"))
    assert landing._request_files(spark, str(tmp_path), 3) == 10 and landing._request_files(spark, str(tmp_path), 2, 3) == 4
    monkeypatch.setattr(landing, "REQUESTS_PER_FILE", 1000)
    assert landing._request_files(spark, str(tmp_path), 3) == 3
