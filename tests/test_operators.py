import math
import random
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from deskmatch.operators import keywords as kw
from deskmatch.operators import scale
from deskmatch.operators.latest import latest_import, latest_per_key, newest_import_rows
from deskmatch.operators.median import exact_median
from deskmatch.operators.membership import drop_own, keep_known_names, not_in
from deskmatch.operators.scale import hot_keys, number_rows, salted_join, scratch_folder, spread_nulls
from deskmatch.operators.series import ewma, rolling_mean
from deskmatch.plans.recommend import recommendation_rows, role_profiles
from deskmatch.sources.model_store import stored_model


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


@pytest.fixture
def no_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


# --- scale helpers ---


def test_salted_join_equals_plain_join(spark, no_broadcast):
    rng = random.Random(1)
    large = [(i, "hot" if rng.random() < 0.5 else f"k{rng.randrange(40)}") for i in range(3000)]
    small = [("hot", 1), ("hot", 2)] + [(f"k{i}", i) for i in range(30)]
    left, right = frame(spark, large, "id int, k string"), frame(spark, small, "k string, v int")
    sizes = left.groupBy("k").agg(F.count("*").alias("n"))
    hot = hot_keys(sizes, "k", "n", rows_per_task=100)
    held = sum(k == "hot" for _, k in large)
    assert [(r["k"], r["salts"]) for r in hot.collect()] == [("hot", -(-held // 100))]
    salted = salted_join(left, right, hot, "k", ["id"]).select("id", "k", "v")
    plain = left.join(right, "k").select("id", "k", "v")
    assert sorted(salted.collect()) == sorted(plain.collect())


def test_spread_nulls_matches_nothing(spark):
    rows = frame(spark, [(1, None), (2, None), (3, "x")], "id int, k string")
    keys = rows.select(spread_nulls(F.col("k"), "id").alias("k")).distinct()
    assert keys.count() == 3
    assert rows.select(spread_nulls(F.col("k"), "id").alias("k")).join(frame(spark, [("x",)], "k string"), "k").count() == 1


@pytest.mark.parametrize("n", [0, 1, 7, 5000])
def test_number_rows(spark, n):
    ids = [f"{i:05d}" for i in range(n)]
    random.Random(n).shuffle(ids)
    rows = number_rows(frame(spark, [(i,) for i in ids + ids[:3]], "k string"), "k").collect()
    assert [r.k for r in sorted(rows, key=lambda r: r.position)] == sorted(ids)
    assert sorted(r.position for r in rows) == list(range(n))


# --- medians ---


@pytest.mark.parametrize("accuracy", [10_000, 100])
def test_exact_median_equals_pandas(spark, accuracy):
    rng = random.Random(accuracy)
    rows = [("hot", rng.gauss(0, 100)) for _ in range(30_000)]
    rows += [("few", float(rng.randrange(3))) for _ in range(5001)]
    rows += [("tail", math.exp(rng.gauss(0, 5))) for _ in range(2000)]
    rows += [("one", 3.5), ("two", 1.0), ("two", 2.0), ("none", None), ("gap", None), ("gap", 7.0), (None, 1.0)]
    found = {r.k: r.m for r in exact_median(frame(spark, rows, "k string, v double"), ["k"], "v", "m", accuracy).collect()}
    expected = pd.DataFrame(rows, columns=["k", "v"]).groupby("k", dropna=False)["v"].median()
    assert len(found) == len(expected)
    for key, value in expected.items():
        got = found[None if pd.isna(key) else key]
        assert (got is None and pd.isna(value)) or got == pytest.approx(value, abs=1e-12)


# --- series ---


@pytest.mark.parametrize("span", [3, 5, 30])
@pytest.mark.parametrize("seed", [1, 2])
def test_averages_equal_pandas(spark, span, seed):
    rng = random.Random(seed)
    values = [None if rng.random() < 0.2 else rng.randrange(1000) for _ in range(1500)]
    df = frame(spark, [("s", i, v) for i, v in enumerate(values)], "s string, i int, v int")
    order = [F.col("i")]
    found = ewma(df.withColumn("r", rolling_mean("v", span, ["s"], order)), "v", span, ["s"], order, "e")
    found = found.orderBy("i").toPandas()
    series = pd.Series(values, dtype="float64")
    mean = series.rolling(span, min_periods=1, center=True).mean().where(series.notna())
    weighted = series.ewm(span=span).mean().where(series.notna())
    pd.testing.assert_series_equal(found["r"], mean, check_names=False, rtol=1e-12)
    pd.testing.assert_series_equal(found["e"], weighted, check_names=False, rtol=1e-12)


def test_rolling_window_of_three(spark):
    rows = [("s", i, v) for i, v in enumerate([None, 100, 200, 100, 200, 100, None])]
    df = frame(spark, rows, "s string, i int, v int").withColumn("r", rolling_mean("v", 3, ["s"], [F.col("i")]))
    found = [r.r for r in df.orderBy("i").collect()]
    assert found == [None, 150.0, pytest.approx(133.333, abs=1e-3), pytest.approx(166.667, abs=1e-3),
                     pytest.approx(133.333, abs=1e-3), 150.0, None]


# --- latest, membership ---


def test_latest(spark):
    rows = frame(spark, [("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z"), ("a", 2, "w")], "k string, t int, v string")
    newest = latest_per_key(rows, ["k"], [F.desc("t"), F.asc("v")])
    assert sorted((r.k, r.v) for r in newest.collect()) == [("a", "w"), ("b", "z")]
    stamped = rows.withColumn("provenance", F.struct(F.timestamp_seconds("t").alias("imported_timestamp")))
    assert sorted(r.v for r in latest_import(stamped, ["k"], "v").collect()) == ["y", "z"]


@pytest.mark.parametrize("listed,expected", [
    ([1, 2], [3]), ([1, None], []), ([], [None, 1, 2, 3]), ([9], [1, 2, 3]),
])
def test_not_in(spark, listed, expected):
    df = frame(spark, [(1,), (2,), (3,), (None,)], "id int")
    found = [r.id for r in not_in(df, "id", frame(spark, [(x,) for x in listed], "x int"), "x").collect()]
    assert sorted(found, key=lambda x: (x is not None, x)) == expected


def test_names_and_own(spark):
    people = frame(spark, [("A",), (None,), ("B",)], "name string")
    assert {r.name for r in keep_known_names(people, frame(spark, [("A",), ("",)], "name string")).collect()} == {"A", None}
    rows = frame(spark, [(["a", None], "a"), (["a", None], "b"), (None, "a"), (["a"], None)], "l array<string>, p string")
    assert drop_own(rows, "l", "p").count() == 3


# --- weighted keyword lists: the reference cases ---


def choices(spark, rows):
    df = frame(spark, rows, "value string, keywords array<string>, weights array<double>")
    return kw.choice_weights(df, "value", "keywords", "weights")


def ranked(spark, choice_rows, queries, **limits):
    asked = frame(spark, list(enumerate(queries)), "q int, keywords array<string>")
    matches = kw.weighted_matches(asked, choices(spark, choice_rows), "q", "value")
    rows = kw.ranked_choices(matches, "q", "value", **limits).orderBy("q", "rank").collect()
    return [[r for r in rows if r.q == i] for i in range(len(queries))]


def test_matching_choice(spark):
    result = ranked(spark, [("n1", ["k1"], [1.0]), ("n2", ["k2"], [1.0])], [["k1"], ["k2"], None])
    assert [[r.value for r in rows] for rows in result] == [["n1"], ["n2"], []]


def test_limit_by_weight(spark):
    rows = [("n1", ["k1"], [0.5]), ("n2", ["k1"], [1.0]), ("n3", ["k1"], [0.1])]
    assert [r.value for r in ranked(spark, rows, [["k1"]], limit=2)[0]] == ["n2", "n1"]


@pytest.mark.parametrize("weights,expected", [([0.1, 0.2], ["k2", "k1"]), ([0.1, 0.1], ["k1", "k2"])])
def test_keyword_order(spark, weights, expected):
    row = ranked(spark, [("n1", ["k1", "k2"], weights)], [["k1", "k2"]])[0][0]
    assert [k.keyword for k in row.matching_keywords] == expected
    assert ranked(spark, [("n1", ["k1", "k2"], weights)], [["k1", "k2"]], keyword_limit=1)[0][0].matching_keywords[
        0].keyword == expected[0]


def test_repeated_keywords(spark):
    row = ranked(spark, [("n1", ["k1", "k1"], [1.0, 0.5])], [["k1"]])[0][0]
    assert row.score == 1.0 and [k.score for k in row.matching_keywords] == [0.5, 0.5]
    assert ranked(spark, [("n1", ["k1"], [0.5])], [["k1", "k1"]])[0][0].score == 1.0


# --- TF-IDF against brute force ---


def brute_force(training, docs, min_documents, max_share):
    n = len(training)
    freq = {}
    for _, words in training:
        for w in set(words):
            freq[w] = freq.get(w, 0) + 1
    vocab = {w for w, f in freq.items() if f >= min_documents and f <= max_share * n and w[0].isalpha()}
    bags = {}
    for name, words in training:
        bag = bags.setdefault(name, {})
        for w in words:
            if w in vocab:
                bag[w] = bag.get(w, 0) + 1
    df = {w: sum(w in bag for bag in bags.values()) for w in vocab}
    idf = {w: math.log(len(bags) / df[w]) + 1 for w in vocab}

    def unit(bag):
        raw = {w: c * idf[w] for w, c in bag.items()}
        length = math.sqrt(sum(v * v for v in raw.values()))
        return {w: v / length for w, v in raw.items()} if length else {}

    profiles = {name: unit(bag) for name, bag in bags.items()}
    scores = {}
    for key, words in docs:
        query = unit({w: words.count(w) for w in set(words) if w in vocab})
        for name, profile in profiles.items():
            parts = {w: query[w] * profile[w] for w in query if w in profile}
            if parts:
                scores[key, name] = (sum(parts.values()), parts)
    return scores


@pytest.fixture
def corpus():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(40)] + ["1x", "the"]
    training = [(f"e{rng.randrange(6)}", [rng.choice(words) for _ in range(rng.randrange(0, 30))] + ["the"])
                for _ in range(60)]
    docs = [(f"d{i}", [rng.choice(words) for _ in range(rng.randrange(0, 20))]) for i in range(25)] + [("d_empty", ["zzz"])]
    return training, docs


@pytest.mark.parametrize("broadcast", [True, False])
def test_scores_equal_brute_force(spark, corpus, broadcast, request):
    if not broadcast:
        request.getfixturevalue("no_broadcast")
    training, docs = corpus
    rows = [(n, f"p{n}", w, i) for i, (n, w) in enumerate(training)]
    trained = frame(spark, rows, "name string, person_id string, extracted_keywords array<string>, i int")
    model = stored_model(role_profiles(trained, trained, "Senior", ("i",), min_documents=5))
    asked = frame(spark, [(k, w, ["pe1"]) for k, w in docs],
                  "version_id string, extracted_keywords array<string>, author_person_ids array<string>")
    expected = brute_force(training, docs, 5, 0.9)
    found = kw.score_documents(asked, model, "version_id", "extracted_keywords", with_keywords=True).collect()
    assert {(r.version_id, r.name) for r in found} == set(expected)
    for r in found:
        score, parts = expected[r.version_id, r.name]
        assert r.score == pytest.approx(score, abs=1e-12) and r.person_id == f"p{r.name}"
        assert {k.keyword: pytest.approx(k.score, abs=1e-12) for k in r.matching_keywords} == parts
    listed = recommendation_rows(asked, model).collect()
    assert {(r.version_id, r.name) for r in listed} == {k for k, v in expected.items() if v[0] >= 0.001 and k[1] != "e1"}
    for r in listed:
        assert r.matching_keyword_score == pytest.approx(r.score, abs=1e-12)
    top = kw.rank_editors(kw.score_documents(asked, model, "version_id", "extracted_keywords"), top=2)
    explained = kw.explain_matches(asked, top, model, "version_id", "extracted_keywords").collect()
    assert len(explained) == top.count()
    for r in explained:
        assert {k.keyword: pytest.approx(k.score, abs=1e-12) for k in r.matching_keywords} == expected[
            r.version_id, r.name][1]


def test_vocabulary_rules(spark):
    docs = frame(spark, [(["a gene", "gene", "1x", "all"],), (["a gene", "gene", "1x", "all", "x"],), (["all"],)],
                 "keywords array<string>")
    frequencies, total = kw.document_frequency(docs), kw.row_count(docs)

    def chosen(**rules):
        return {r.keyword for r in kw.select_vocabulary(frequencies, total, 2, 0.9, **rules).collect()}

    assert chosen() == {"a gene", "gene"}
    assert chosen(skip_article=True) == {"gene"}
    assert chosen(excluded=frame(spark, [("gene",)], "excluded_keyword string")) == {"a gene"}
    with pytest.raises(ValueError):
        kw.select_vocabulary(frequencies, total, 2, 1.5)


def test_model_needs_keywords(spark):
    trained = frame(spark, [("e", "p", ["x"], 1)], "name string, person_id string, extracted_keywords array<string>, i int")
    with pytest.raises(ValueError):
        stored_model(role_profiles(trained, trained, "Senior", ("i",)))


def test_last_person_id(spark):
    rows = frame(spark, [("n", "p1", 1), ("n", "p2", 2), ("n", None, 3)], "name string, person_id string, i int")
    assert kw.last_person_id(rows, "i").first()["person_id"] == "p2"


def test_scratch_needs_the_setting(spark):
    class Session:
        conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: default)})

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_folder(Session(), "x")


def test_median_is_exact_beside_a_rough_sketch(spark):
    rows = frame(spark, [("a", float(v)) for v in range(1001)] + [("b", 5.0)] * 900 + [("b", 6.0)] + [("c", None)], "k string, v double")
    found = {r.k: r.m for r in exact_median(rows, ["k"], "v", "m", accuracy=3).collect()}
    assert found == {"a": 500.0, "b": 5.0, "c": None}


def test_newest_import_of_any_size(spark):
    rows = [("a", "1", "2024-01-01", "s"), ("a", "2", "2024-01-02", "s"), ("a", "3", "2024-01-02", "s"), ("a", "4", "2024-01-02", "r"),
            ("b", None, "2024-01-01", "s"), (None, "5", "2024-01-01", "s"), (None, "6", "2023-01-01", "s"), ("c", "7", None, "s")]
    imports = frame(spark, rows, "person_id string, pmid string, day string, source string").select(
        "person_id", "pmid", F.struct("source", F.to_timestamp("day").alias("imported_timestamp")).alias("provenance"))
    found = newest_import_rows(imports, ["person_id"], "provenance.source")
    assert {(r.person_id, r.pmid) for r in found.collect()} == {("a", "2"), ("a", "3"), ("b", None), (None, "5"), ("c", "7")}


def test_a_person_with_most_of_all_ids_is_split(spark):
    """The import of one person is never one list or one task's work: the join splits it, nothing gathers it."""
    imports = spark.range(30_000).select(
        F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("person_id"), F.col("id").cast("string").alias("pmid"),
        F.struct(F.lit("s").alias("source"), F.timestamp_seconds(F.lit(0)).alias("imported_timestamp")).alias("provenance"))
    newest = newest_import_rows(imports, ["person_id"])
    assert newest.count() == 30_000
    assert "collect_list" not in newest._jdf.queryExecution().toString()


def test_median_of_a_group_with_most_rows_and_of_missed_brackets(spark):
    """One group has 90 % of the rows; no ordered step sees more than one zone of it."""
    import statistics

    rng = random.Random(8)
    rows = [("hot", rng.random()) for _ in range(9000)] + [(rng.choice(["a", "b", None]), rng.choice([1.0, 2.0, None])) for _ in range(990)]
    rows += [("none", None), ("one", 5.0), ("two", 1.0), ("two", 4.0), ("nan", float("nan")), ("nan", 1.0), ("nan", 2.0)]
    data = frame(spark, rows, "k string, v double")
    expected = {}
    for k in {k for k, _ in rows}:
        values = [v for g, v in rows if g == k and v is not None]
        expected[k] = statistics.median(sorted(values, key=lambda v: (v != v, v))) if values else None
    for accuracy in (10_000, 20):  # so coarse a sketch misses the middle
        found = {r.k: r.m for r in exact_median(data, ["k"], "v", "m", accuracy).collect()}
        assert found == expected
    plan = exact_median(data, ["k"], "v", "m")._jdf.queryExecution().toString()
    assert "collect_list" not in plan


def test_scored_pairs_stay_in_their_block(spark, no_broadcast, monkeypatch):
    rng = random.Random(4)
    rows = [(f"v{i}", f"e{i % 7}", f"p{i % 7}", [f"k{rng.randrange(60)}" for _ in range(30)] + ["all"]) for i in range(80)]
    training = frame(spark, rows, "version_id string, name string, person_id string, extracted_keywords array<string>")
    model = stored_model(role_profiles(training, training, "Senior", ("version_id",), min_documents=1, max_share=1.0))

    def scored():
        return kw.score_documents(training, model, "version_id", "extracted_keywords")

    whole = {(r["version_id"], r["name"]): r["score"] for r in scored().collect()}
    monkeypatch.setattr(kw, "WORDS_PER_BLOCK", 200)
    monkeypatch.setattr(kw, "LISTED_PER_BLOCK", 100)
    blocks = scored()
    # without a broadcast too, no pair of a document and an editor is dealt out by its document
    plan = blocks._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(version_id" not in plan
    assert {(r["version_id"], r["name"]): pytest.approx(r["score"]) for r in blocks.collect()} == whole
    assert len(whole) == 80 * 7
    for top in (1, None):  # few matches a document, and all
        listed = recommendation_rows(training.withColumn("author_person_ids", F.lit(None).cast("array<string>")), model, top=top).collect()
        assert len(listed) == (80 if top else 560)
        for r in listed:
            assert r["matching_keyword_score"] == pytest.approx(r["score"]) == pytest.approx(whole[r["version_id"], r["name"]])
            assert len({k["keyword"] for k in r["matching_keywords"]}) == len(r["matching_keywords"])


def test_median_between_two_decimals(spark):
    rows = frame(spark, [("a", 28.74), ("a", 31.36), ("b", 1 / 3), ("b", 2 / 3), ("c", 1e300), ("c", 1e300), ("d", 2.5), ("e", None)],
                 "k string, v double")
    found = {r["k"]: r["m"] for r in exact_median(rows, ["k"], "v", "m").collect()}
    # the binary mean is 30.049999999999997, which a display of one place shows as 30.0
    assert found == {"a": 30.05, "b": 0.5, "c": 1e300, "d": 2.5, "e": None}


def test_documents_stay_in_their_blocks(spark, no_broadcast, monkeypatch):
    rng = random.Random(6)
    rows = [(f"v{i}", f"e{i % 5}", f"p{i % 5}", [f"k{rng.randrange(40)}" for _ in range(25)] + [None, "all"]) for i in range(60)]
    schema = "version_id string, name string, person_id string, extracted_keywords array<string>"
    training = frame(spark, rows, schema)
    model = stored_model(role_profiles(training, training, "Senior", ("version_id",), min_documents=1, max_share=1.0))
    monkeypatch.setattr(kw, "WORDS_PER_BLOCK", 300)
    more = frame(spark, [*rows, (None, "e1", "p1", ["all"]), ("none", "e1", "p1", None), ("empty", "e1", "p1", [])], schema)
    scores = kw.score_documents(more, model, "version_id", "extracted_keywords")
    found = {(r["version_id"], r["name"]): r["score"] for r in scores.join(more, "version_id").select(scores["*"]).collect()}
    # by hand, from the stored weights
    entries = model.profiles.collect()
    idf = {e["keyword"]: e["idf"] for e in entries}
    expected = {}
    for version, _, _, words in rows:
        raw = {w: words.count(w) * idf[w] for w in set(words) - {None}}
        length = sum(x * x for x in raw.values()) ** 0.5
        for e in entries:
            if e["keyword"] in raw:
                expected[version, e["name"]] = expected.get((version, e["name"]), 0) + raw[e["keyword"]] / length * e["weight"]
    assert found == {k: pytest.approx(v) for k, v in expected.items()}
    # only distinct keywords meet the model: no list of documents is made, and the documents are dealt out once
    joined = scores.join(more.select("version_id"), "version_id")
    joined.collect()
    plan = joined._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]
    assert "collect_list(struct(version_id" not in plan
    dealt = [line for line in plan.splitlines() if "direct_shuffle_partition_id" in line]
    assert sum("ReusedExchange" in line for line in dealt) == 1 and len(dealt) == 3


def test_shuffle_files_go_with_the_write_that_made_them(spark):
    def shuffled():
        blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
        return {name for name in blocks.mkString(" ").split() if name.startswith("shuffle_")}

    before, setting = shuffled(), spark.conf.get(scale.SHUFFLE_CLEANUP, "false")
    counted = scale.materialise(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counted")
    until = time.monotonic() + 20
    while shuffled() - before and time.monotonic() < until:
        time.sleep(0.2)
    assert not shuffled() - before
    assert counted.count() == 7 and spark.conf.get(scale.SHUFFLE_CLEANUP, "false") == setting


def test_best_keyword_of_every_choice_without_lists(spark):
    listed = choices(spark, [("n1", ["a", "b", "b"], [2.0, 1.0, 3.0]), ("n2", ["a", "c"], [1.0, 1.0]), ("n3", ["z"], [1.0])])
    asked = frame(spark, [("q1", ["a", "b", "a"]), ("q2", ["c", "a"]), ("q3", None)], "q string, keywords array<string>")
    every = {(r.q, r.value): (r.score, r.matching_keywords[0]) for r in kw.weighted_matches(asked, listed, "q", "value").collect()}
    matches = kw.best_weighted_matches(asked, listed, "q", "value")
    assert {(r.q, r.value): (r.score, *r.matching_keywords) for r in matches.collect()} == every
    assert every["q2", "n2"] == (2.0, (1.0, "a")) and every["q1", "n1"][1] == (4.0, "a")
    assert "collect_list" not in matches._jdf.queryExecution().executedPlan().toString()


def test_explained_keywords_are_gathered_once_for_many_editors(spark, no_broadcast, monkeypatch):
    rng = random.Random(8)
    rows = [(f"v{i}", f"e{i % 9}", f"p{i % 9}", [f"k{rng.randrange(50)}" for _ in range(25)] + [None, "all"]) for i in range(70)]
    schema = "version_id string, name string, person_id string, extracted_keywords array<string>"
    training = frame(spark, rows, schema)
    model = stored_model(role_profiles(training, training, "Senior", ("version_id",), min_documents=1, max_share=1.0))
    more = frame(spark, [*rows, rows[3], (None, "e1", "p1", ["all"]), ("none", "e1", "p1", None)], schema)  # v3 comes twice
    # by hand, from the stored weights: what comes twice has the same direction
    entries = model.profiles.collect()
    expected = {}
    for version, _, _, words in rows:
        raw = {e["keyword"]: words.count(e["keyword"]) * e["idf"] for e in entries if e["keyword"] in words}
        length = sum(x * x for x in raw.values()) ** 0.5
        for e in entries:
            if e["keyword"] in raw:
                expected.setdefault((version, e["name"]), {})[e["keyword"]] = raw[e["keyword"]] / length * e["weight"]
    monkeypatch.setattr(kw, "EDITORS_PER_LIST", 4)
    monkeypatch.setattr(kw, "LISTED_PER_BLOCK", 900)
    scores = kw.score_documents(more, model, "version_id", "extracted_keywords")
    for top in (1, None):
        explained = kw.explain_matches(more, kw.rank_editors(scores, top=top), model, "version_id", "extracted_keywords")
        found = explained.collect()
        assert len(found) == (70 if top else len(expected))
        for r in found:
            assert {k["keyword"]: k["score"] for k in r["matching_keywords"]} == pytest.approx(expected[r["version_id"], r["name"]])
            assert [(-round(k["score"], 12), k["keyword"]) for k in r["matching_keywords"]] == sorted(
                (-round(k["score"], 12), k["keyword"]) for k in r["matching_keywords"])
        # no row for each keyword of each pair, and no comparison by expressions
        plan = explained._jdf.queryExecution().executedPlan().toString()
        assert "inline(" not in plan and "explode(_gains" not in plan and "array_sort(" not in plan
