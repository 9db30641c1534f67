import json

import pytest
from pyspark.sql import functions as F

from deskmatch.functions import tags
from deskmatch.sources import batches, cleaning, evolve, files, landing
from deskmatch.sources.tables import APPEND, FAIL, REPLACE, Tables, limited, save_table, with_provenance


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_clean_fields(spark):
    schema = "key1 string, key2 array<string>, key3 double, key4 int, flag boolean, s struct<a: string, l: array<struct<x: int>>>"
    rows = [("", [], float("nan"), 0, False, ("", [(0,), (1,)])), ("v", ["", None], 1.5, 2, True, None), (None,) * 6]
    found = cleaning.clean_fields(frame(spark, rows, schema)).collect()
    assert found[0][:5] == (None, None, None, None, False)
    assert found[0].s.a is None and [x.x for x in found[0].s.l] == [None, 1]
    assert found[1].key2 == ["", None] and found[1].key4 == 2
    assert found[2][:6] == (None,) * 6
    lines = [r.value for r in cleaning.as_json_lines(frame(spark, rows, schema)).collect()]
    assert lines[2] == "{}" and lines[0] == '{"flag":false,"s":{"l":[{},{"x":1}]}}'


def test_merge_schemas(spark):
    old = frame(spark, [], "a int, s struct<x: int>, l array<struct<y: int>>").schema
    new = frame(spark, [], "A string, b string, S struct<X: string, z: string>, l array<struct<y: int, w: int>>").schema
    merged = evolve.merge_schemas(old, new)
    assert merged.simpleString() == (
        "struct<a:int,s:struct<x:int,z:string>,l:array<struct<y:int,w:int>>,b:string>"
    )
    row = evolve.align_to(frame(spark, [("7", "t", ("3", "q"), [(1, 2)])], new), merged).first()
    assert (row.a, row.s.x, row.s.z, row.l[0].w, row.b) == (7, 3, "q", 2, "t")


def test_write_modes(spark):
    first, second = frame(spark, [(1, "x")], "a int, b string"), frame(spark, [("2", 5)], "A string, c int")
    assert save_table(first, "modes", FAIL) == 1
    with pytest.raises(ValueError):
        save_table(first, "modes", FAIL)
    assert save_table(second, "modes", APPEND) == 1
    assert sorted(tuple(r) for r in spark.table("modes").collect()) == [(1, "x", None), (2, None, 5)]
    assert save_table(first, "modes", REPLACE) == 1 and spark.table("modes").count() == 1
    with pytest.raises(ValueError):
        save_table(first, "modes", "other")
    save_table(first.limit(0), "modes_empty", REPLACE)
    assert save_table(first, "modes_empty", FAIL) == 1


def test_tables(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS t_in")
    spark.sql("CREATE DATABASE IF NOT EXISTS t_out")
    tables = Tables(spark, "t_in", "t_out")
    assert tables.first_existing(["a", "b"], "x int").count() == 0
    tables.save(frame(spark, [(1,)], "x int"), "b", REPLACE)
    assert tables.first_existing(["a", "b"], "x int").count() == 1
    assert tables.snapshot(tables.output("b"), "b").count() == 1
    assert spark.table("v_desk_b").count() == 1


def test_limit_and_provenance(spark):
    df = frame(spark, [(2,), (1,)], "a int")
    assert limited(df, 1, "a").first().a == 1 and limited(df, 0).count() == 2 and limited(df, None).count() == 2
    row = with_provenance(df, "src", F.lit("2020-01-01").cast("timestamp")).first()
    assert row.provenance.source == "src" and row.provenance.imported_timestamp.year == 2020


def test_delimited_files(spark, tmp_path):
    df = frame(spark, [("a\tb", 'say "x"'), ("line\nbreak", None)], "a string, b string")
    for name in ("f.tsv", "f.tsv.gz", "f.csv"):
        path = str(tmp_path / name)
        files.write_delimited(df, path)
        assert sorted(map(str, files.read_delimited(spark, path, df.schema, multi_line=True).collect())) == sorted(map(str, df.collect()))


def test_json_lines_keep_quoted_numbers(spark, tmp_path):
    path = str(tmp_path / "rows")
    files.write_json_lines(frame(spark, [("1", 2)], "a string, b int"), path)
    assert files.inferred_schema(spark, path).simpleString() == "struct<a:string,b:bigint>"


def test_batches(spark):
    rows = batches.id_batches(frame(spark, [(str(i),) for i in range(5)], "id string"), "id", 2).orderBy("batch").collect()
    assert [r.ids for r in rows] == [["0", "1"], ["2", "3"], ["4"]]
    with pytest.raises(ValueError):
        batches.id_batches(frame(spark, [], "id string"), "id", 0)


def test_search_texts(value):
    ids = F.array(*[F.lit(f"pmid{i}") for i in (1, 2, 3)])
    assert value(batches.id_search(ids)) == '(EXT_ID:"pmid1" OR EXT_ID:"pmid2" OR EXT_ID:"pmid3") AND (SRC:"MED")'
    assert value(batches.author_search(F.array(F.lit("Novak, R T")))) == '(AUTH:"Novak RT") AND (SRC:"MED")'
    with pytest.raises(Exception, match="values required"):
        value(batches.id_search(F.array().cast("array<string>")))


PAGE = """<div id="content"><span class="pmid">99</span><div class="citations">
<div><span class="pmid">PMID: <a href="#">31007</a></span></div><span class="docsum pmid">x 1 and
31008 end</span></div></div><div id="pager"><a class="active page_link nextPage enabled" href="?page=2">Next</a></div>"""


def test_bibliography_page(value):
    assert value(landing.cited_ids(F.lit(PAGE))) == ["31007", "31008"]
    base = F.lit("https://list.example/papers?order=year&page=1")
    assert value(landing.next_page(F.lit(PAGE), base)) == "https://list.example/papers?order=year&page=2"
    assert value(landing.next_page(F.lit(PAGE.replace(" enabled", "")), base)) is None
    assert value(tags.last_number(F.lit("none"))) is None


def test_search_response(spark, value):
    raw = '{"hitCount": 2, "resultList": {"result": [{"pmid": "1", "source": "MED", "authorList": {"author": [{"lastName": "S"}]}}, {"id": 3}]}}'
    assert value(landing.result_ids(F.lit(raw))) == ["1", None]
    assert value(landing.result_ids(F.lit("{}"))) == []
    rows = landing.search_results(frame(spark, [("q", raw)], "q string, response string")).collect()
    assert rows[0].authorList.author[0].lastName == "S" and rows[1].pmid is None


def page(cursor, following, count, hits):
    results = ", ".join('{"pmid": "1"}' for _ in range(count))
    return (f'{{"hitCount": {hits}, "nextCursorMark": "{following}", "request": {{"cursorMark": "{cursor}"}},'
            f' "resultList": {{"result": [{results}]}}}}')


def test_page_faults(spark):
    rows = [("good", 1, page("*", "a", 6, 10)), ("good", 2, page("a", "a", 3, 10)),
            ("short", 1, page("*", "*", 8, 10)), ("broken", 1, page("*", "a", 6, 10)), ("broken", 2, page("b", "b", 6, 10))]
    faults = landing.page_faults(frame(spark, rows, "q string, n int, response string"), "q", "n").collect()
    assert {r.q: (r.received, r.announced, r.broken_links) for r in faults} == {"short": (8, 10, 0), "broken": (12, 10, 1)}


def test_keyword_responses(value):
    raw = '{"data": [{"attributes": {"keywords": [{"keyword": "b"}, {"keyword": "a"}]}}, {"attributes": {"keywords": []}}]}'
    assert value(landing.keyword_lists(F.lit(raw))) == [["b", "a"], []]
    assert value(landing.keyword_request(F.lit("text"))) == (
        '{"data":[{"type":"extract-keyword-request","attributes":{"content":"text"}}]}'
    )


def test_bibliography_pages_that_are_not_well_formed(value):
    page = ('<body><div id="a"><i class="pmid">1</i></div><div class="x citations"><div><span class="pmid">ID: 21<span></div>'
            '<div><span class="pmid">ID:\n22<span></div><div><div class="pmid"> 23</div> 7</div></div><div class="other"><i class="pmid">99</i></div>')
    assert value(landing.cited_ids(F.lit(page))) == ["21", "22", "23"]
    assert value(landing.cited_ids(F.lit('<div class="nocitations"><b class="pmid">1</b></div>'))) == []
    assert value(landing.cited_ids(F.lit('<div class="citations"><p class="pmid">' + "x <b>5</b> " * 20000))) == ["5"]
    later = '<form id="pager"><a class="nextPage" href="?page=3">n</a></form><a class="nextPage enabled" href="?page=4">n</a>'
    assert value(landing.next_page(F.lit(later), F.lit("http://host/p"))) is None


@pytest.mark.parametrize("inside,found", [
    ('<i class="pmid">12<b>34</b></i><i class="pmid">a<b>5</b>b 6 c</i>', ["1234", "6"]),
    ('<i class=pmid>x1 y</i><i class=\'a pmid\'>7</i><i class="pmids">8</i><i title="pmid">9</i>', [None, "7"]),
    ('<!-- <i class="pmid">1</i> --><i class="pmid">2<!-- 3 </i> <b> --> 4</i> 5', ["4"]),
    ('<p class="pmid">1<br>2<img src="3">4<p class="pmid">5 <ul><li>6<li>7</ul>', ["124", "67"]),
    ('<b class="pmid">1 <div>2</b> 3</div></b> 4', ["3"]), ('<i class="pmid">1 < 2 and 3</i>', ["3"]),
    ('<b><i class="pmid">1</b> 2</i>', ["2"]), ('<i class="pmid">1<i class="pmid">2</i></i>', ["1", "2"]),
    ('</span></p><I CLASS="pmid">1</I>', ["1"]), ("", []),
])
def test_elements_by_one_pass(value, inside, found):
    page = f'<p class="citations"><i class="pmid">0</i></p><DIV class="citations other">{inside}</DIV><i class="pmid">99</i>'
    assert value(landing.cited_ids(F.lit(page))) == found
    assert value(landing.cited_ids(F.lit(page), "p")) == ["0"]  # the first of that name
    assert value(landing.cited_ids(F.lit(f'<div class="citations">{inside}'))) == found  # never closed


def test_pages_are_read_in_time_of_their_length(spark):
    """Eight times as long takes well under the square of eight times as long."""
    import time

    def seconds(inside):
        pages = frame(spark, [(f'<div class="citations"><p class="pmid">{inside}</p></div>',)], "html string").cache()
        pages.count()
        started = time.perf_counter()
        pages.select(landing.cited_ids(F.col("html")).alias("ids")).collect()
        return time.perf_counter() - started

    seconds("x")
    for piece in ("word ", "no<b>thing</b> ", "<!-- ", "< ", "wort", "a &amp; b "):
        short, long = seconds(piece * (150_000 // len(piece))), seconds(piece * (1_200_000 // len(piece)))
        assert long < 24 * short + 1, piece


def test_next_page_needs_both_classes_and_the_pager(value):
    link = '<a href=\'?x=1&amp;page=5\' class="b nextPage enabled">n</a>'
    base = F.lit("https://list.example/p?order=year")
    assert value(landing.next_page(F.lit(f'<form id="pager">{link}</form>'), base)) == "https://list.example/p?order=year&page=5"
    assert value(landing.next_page(F.lit(f'<form id="pager"></form>{link}'), base)) is None
    assert value(landing.next_page(F.lit(f'<form id="pager"><!-- {link} --></form>'), base)) is None


def test_append_keeps_nested_fields(spark):
    tables = Tables(spark, "default", "default", "nest_")
    first = frame(spark, [(1, (1,), [(1,)])], "id int, st struct<a:int>, ar array<struct<x:int>>")
    second = frame(spark, [(2, (2, "new"), [(2, 3)], "top")], "id int, st struct<a:int,b:string>, ar array<struct<x:int,y:int>>, extra string")
    assert tables.save(first, "t", APPEND) == 1 and tables.save(second, "t", APPEND) == 1 and tables.save(first, "t", APPEND) == 1
    rows = sorted(tables.output("t").collect(), key=lambda r: (r.id, str(r)))
    assert [(r.id, tuple(r.st), [tuple(x) for x in r.ar], r.extra) for r in rows] == [
        (1, (1, None), [(1, None)], None), (1, (1, None), [(1, None)], None), (2, (2, "new"), [(2, 3)], "top")]
    assert tables.save(second.limit(0), "t", APPEND) == 0 and tables.output("t").count() == 3


def test_maps_and_lists_of_lists_are_cleaned(spark):
    df = frame(spark, [({"k": "", "j": "v"}, {"k": ""}, [[("",)]])], "m map<string,string>, e map<string,string>, l array<array<struct<s:string>>>")
    assert json.loads(cleaning.as_json_lines(df).first().value) == {"m": {"j": "v"}, "l": [[{}]]}
