from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from deskmatch.functions import arrays, dates, html, links, text


def day(s):
    return F.lit(s).cast("date")


@pytest.mark.parametrize("given,expected", [
    ("Novak R T", "Novak RT"), ("OKAFOR B", "OKAFOR B"), ("Okafor, B", "Okafor B"), ("Novak R.", "Novak R"),
    (' "Novak R" ', "Novak R"), (' "Ñövâk Ŕ" ', "Novak R"), ("R T U", "R TU"), ("A R T U", "A RT U"), ("Weiß Æ", "Weiss AE"),
    ("Пушкин А С", "Puskin AS"), ("Щербаков Й", "Serbakov J"), ("Ёлкина Ю", "Elkina U"), ("Шевченко Ї", "Sevcenko I"),
    ("Παπαδόπουλος Θ", "Papadopoulos Th"), ("Αγγελίδης Χ", "Angelides Ch"), ("Εὐριπίδης", "Eyripides"), ("Ψαράς Υ", "Psaras Y"),
    ("山田 T", "山田 T"),
])
def test_author_name(value, given, expected):
    assert value(text.author_name(F.lit(given))) == expected


def test_manuscript_id_from_doi(value):
    assert value(text.manuscript_id_from_doi(F.lit("10.5555/JRNL.012345"), "10.5555/jrnl.")) == "012345"
    assert value(text.manuscript_id_from_doi(F.lit("10.5555/jrnl.123"), "10.5555/jrnl.")) is None


def test_numbers_as_text(value):
    assert value(text.display_number(F.lit(80.0), 1)) == "80"
    assert value(text.display_number(F.lit(0.94), 1)) == "0.9"
    assert value(text.display_number(F.lit(43.25))) == "43.25"
    assert value(text.rounded_integer(F.lit(2.5))) == 3


def test_contains(value):
    assert value(text.contains(F.lit("abc"), F.lit("b"))) is True
    assert value(text.contains(F.lit("abc"), F.lit(""))) is False
    assert value(text.contains(F.lit("abc"), F.lit(None).cast("string"))) is None


@pytest.mark.parametrize("url", ["http://host/path", "host/path", "https://host/path"])
def test_normal_url(value, url):
    assert value(links.normal_url(F.lit(url))) == "https://host/path"


@pytest.mark.parametrize("url", [
    "https://www.ncbi.nlm.nih.gov/pubmed/20417", "http://www.ncbi.nlm.nih.gov/pubmed/20417/",
    "https://ncbi.nlm.nih.gov/pubmed/20417", "https://pubmed.ncbi.nlm.nih.gov/20417/",
    "https://www.ncbi.nlm.nih.gov/pubmed/20417\n",
])
def test_article_id(value, url):
    assert value(links.article_id(F.lit(url))) == "20417"


def test_article_ids_skip_other_addresses(value):
    listed = F.array(F.lit("https://www.ncbi.nlm.nih.gov/other/123"), F.lit("pubmed.ncbi.nlm.nih.gov/5"))
    assert value(links.article_id(F.lit("https://www.ncbi.nlm.nih.gov/other/123"))) is None
    assert value(links.article_ids(listed)) == ["5"]
    assert value(links.article_id(F.lit("https://www.ncbi.nlm.nih.gov/pubmed/?term=x"))) == "pubmed"


@pytest.mark.parametrize("url,expected", [
    ("https://www.ncbi.nlm.nih.gov/myncbi/user-id1/bibliography/public/?query", True),
    ("https://www.ncbi.nlm.nih.gov/myncbi/browse/collection/12345/?query", True),
    ("https://www.ncbi.nlm.nih.gov/pubmed/?term=bibliography", False),
    ("https://other.org/bibliography/", False),
])
def test_bibliography(value, url, expected):
    assert value(links.is_bibliography_url(F.lit(url))) is expected


@pytest.mark.parametrize("url,term,is_search", [
    ("https://www.ncbi.nlm.nih.gov/pubmed/?term=sea+ice", "sea ice", True),
    ("https://www.ncbi.nlm.nih.gov/pubmed/?term=Novak+R%5BAuthor%5D", "Novak R[Author]", True),
    ("https://www.ncbi.nlm.nih.gov/pubmed/?term=", "", False),
    ("https://www.ncbi.nlm.nih.gov/pubmed/", "", False),
    ("https://www.ncbi.nlm.nih.gov/myncbi/x/bibliography/?term=y", None, False),
    ("https://other.org/?term=y", None, False),
])
def test_search_term(value, url, term, is_search):
    assert value(links.search_term(F.lit(url))) == term
    assert value(links.is_search_url(F.lit(url))) is is_search


@pytest.mark.parametrize("term,include,exclude", [
    ("Okafor B[Author] OR 811[pmid] NOT 40[pmid] OR 812[pmid] NOT 41[pmid]",
     {"author": ["Okafor B"], "pmid": ["811", "812"]}, {"pmid": ["40", "41"]}),
    ("Okafor B", {"author": ["Okafor B"]}, None),
    ('"Okafor B"[au]', {"author": ["Okafor B"]}, None),
    ("A[auth] AND B[Other]", {"author": ["A"], "other": ["B"]}, None),
    ("NOT x[pmid]", {"author": [""]}, {"pmid": ["x"]}),
])
def test_parsed_term(value, term, include, exclude):
    parsed = value(links.parsed_term(F.lit(term)))
    assert parsed["include"] == include
    assert parsed["exclude"] == exclude


def test_next_page_url(value):
    base = F.lit("https://list.example/papers?order=year&page=4")
    assert value(links.next_page_url(base, F.lit("?page=5"))) == "https://list.example/papers?order=year&page=5"
    assert value(links.next_page_url(F.lit("https://list.example/papers?a=7"), F.lit("?b=2"))) == "https://list.example/papers?a=7&page=1"


@pytest.mark.parametrize("given,month,quarter,year,week,quarter_week", [
    ("2020-11-30", "2020-11-01", "2020-10-01", "2020-01-01", "2020-11-30", "2020-11-30"),
    ("2020-10-05", "2020-10-01", "2020-10-01", "2020-01-01", "2020-10-05", "2020-10-05"),
    ("2020-10-11", "2020-10-01", "2020-10-01", "2020-01-01", "2020-10-05", "2020-10-05"),
    ("2020-10-04", "2020-10-01", "2020-10-01", "2020-01-01", "2020-09-28", "2020-10-01"),
    ("2020-12-31", "2020-12-01", "2020-10-01", "2020-01-01", "2020-12-28", "2020-12-28"),
])
def test_period_starts(value, given, month, quarter, year, week, quarter_week):
    d = day(given)
    found = [value(f(d)) for f in (dates.month_start, dates.quarter_start, dates.year_start, dates.week_start,
                                   dates.quarter_week)]
    assert [x.isoformat() for x in found] == [month, quarter, year, week, quarter_week]


def test_date_ranges_and_texts(value):
    october = day("2020-10-01")
    assert value(dates.in_month(day("2020-10-31"), october)) and not value(dates.in_month(day("2020-11-01"), october))
    assert value(dates.in_quarter(day("2020-12-31"), october))
    assert not value(dates.in_year(day("2020-09-30"), october))
    assert value(dates.iso_midnight(day("2020-10-01"))) == "2020-10-01T00:00:00Z"
    as_of = F.lit(datetime(2020, 1, 3, 11))
    assert value(dates.whole_days(F.lit(datetime(2020, 1, 1, 12)), as_of)) == 1
    assert value(dates.in_last_year(F.lit(datetime(2019, 1, 3, 1)), as_of)) is True
    assert value(dates.in_last_year(F.lit(datetime(2019, 1, 2, 23)), as_of)) is False


def test_arrays(value):
    none = F.lit(None).cast("array<string>")
    assert value(arrays.joined(none, ", ")) == ""
    assert value(arrays.distinct_present(F.array(F.lit("a"), F.lit(None), F.lit("a")))) == ["a"]
    assert value(arrays.has_items(none)) is False
    assert value(arrays.first(none)) is None
    stages = F.array(F.struct(F.lit(None).cast("string").alias("n")), F.struct(F.lit("x").alias("n")))
    assert value(arrays.any_field_equals(stages, "n", "x")) is True
    assert value(arrays.any_field_equals(stages, "n", "y")) is False
    assert value(arrays.positions_equal(F.array(F.lit("a"), F.lit(None)), F.lit("b"))) is None


def test_pick_ordered(value):
    items = F.array(*[F.struct(F.lit(k).cast("int").alias("k"), F.lit(v).alias("v")) for k, v in
                      ((2, "b"), (None, "n"), (3, "c1"), (3, "c2"))])
    pick = lambda **kw: value(arrays.pick_ordered(items, lambda x: [x["k"]], lambda x: x["v"], **kw))
    assert pick() == "n"
    assert pick(descending=True) == "c1"
    assert pick(keep=lambda x: x["k"] == 2) == "b"
    assert pick(keep=lambda x: x["k"] == 9) is None


PERSON = dict(
    person_name="John Matt", institution="University of Nowhereland", country="Nowhere",
    website="http://universityofnowhereland.edu", pubmed="http://universityofnowherelandpubmed.edu",
    availability="Sundays only until 3th August 2021", days_to_respond="0.9", requests="13", responses="12",
    response_rate="80", no_of_assigments="0", no_of_full_submissions="4", decision_time="43",
)


def person_text(spark, **fields):
    row = {**{k: None for k in PERSON}, **fields}
    schema = ", ".join(f"{k} string" for k in row)
    return spark.createDataFrame([tuple(row.values())], schema).select(html.recommended_person().alias("t")).first()["t"]


def test_recommended_person(spark):
    assert person_text(spark, person_name="John Matt") == "John Matt"
    assert person_text(spark, **PERSON) == (
        "John Matt<br />University of Nowhereland, Nowhere"
        "<br /><span style='color:red;'><strong>!</strong></span> Limited availability: "
        "Sundays only until 3th August 2021"
        '<br /><a href="http://universityofnowhereland.edu" target=_blank>Website</a>'
        ' | <a href="http://universityofnowherelandpubmed.edu" target=_blank>PubMed</a>'
        "<br />Days to respond: 0.9; Requests: 13; Responses: 12; Response rate: 80%"
        "<br />No. of current assignments: 0; Full submissions in 12 months: 4; Decision time: 43 days"
    )
    assert person_text(spark, person_name="J", country="X", website="a&b") == (
        'J<br /><a href="a&amp;b" target=_blank>Website</a>'
    )


def test_date_type(value):
    assert value(day("2020-01-01")) == date(2020, 1, 1)


def test_query_values_whole_and_broken(value):
    long = "x" * 1_200_000
    assert value(links.query_value(F.lit("http://h/p?term=" + long), "term")) == long
    assert value(links.query_value(F.lit("http://h/p?term=50%+a%20b"), "term")) == "50% a b"


def test_repeated_parameters_stay(value):
    assert value(links.next_page_url(F.lit("http://h/p?a=1&a=1&page=3&b=2&page=4&a=5&c="), F.lit("?page=9"))) == "http://h/p?a=1&a=1&a=5&page=9&b=2"


def test_a_term_is_split_once_for_all_its_items(spark):
    terms = spark.createDataFrame([("a[au] AND b[Auth] NOT [c] OR ", ), (None,), ("",)], "term string")
    rows = terms.select(links.term_items("term").alias("items"), links.parsed_term("term").alias("parsed"))
    found = [None if r["items"] is None else [tuple(i) for i in r["items"]] for r in rows.collect()]
    assert found == [
        [("include", "author", "a"), ("include", "author", "b"), ("exclude", "author", "[c]"), ("include", "author", "")],
        None, [("include", "author", "")],
    ]
    for column in ("items", "parsed"):
        plan = rows.select(column)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("OR|NOT|AND") == 1
