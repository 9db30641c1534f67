import random

from helpers import LABELS, TEXTS, empty, frame
from pyspark.sql import functions as F

from deskmatch.llm import quality, rules, toxicity
from deskmatch.llm.common import id_remainder


def neutral(rng):
    return " ".join(f"wort{rng.randrange(300)}" for _ in range(60)) + "."


def labelled(spark, make, n=240):
    rng = random.Random(4)
    rows = [(i, make(rng, i % 4 == 0)) for i in range(1, n)]
    labels = spark.createDataFrame([(i, int(i % 4 != 0), int(i % 4 == 0), "x") for i in range(1, n)] + [(1, None, None, "x"), (None, 1, 1, "x")], LABELS)
    return rows, labels


def test_quality_learns_and_takes_every_text(spark):
    rows, labels = labelled(spark, lambda rng, bad: neutral(rng).upper().replace(".", "!!! ###") if bad else neutral(rng))
    learn = id_remainder(F.col("doc_id"), 5) != 0
    found = quality.score_quality(frame(spark, rows + [(1000 + (i or 0), t) for i, t in TEXTS]), labels, learn).collect()
    assert len(found) == len(rows) + len(TEXTS) and all(0 <= r["score"] <= 1 for r in found)
    right = [r["predicted"] == int(r["doc_id"] % 4 != 0) for r in found if r["doc_id"] < 1000]
    assert sum(right) > 0.97 * len(right)
    none = spark.createDataFrame([], LABELS)
    assert {r["score"] for r in quality.score_quality(frame(spark), none, learn).collect()} == {0.5}
    assert quality.score_quality(empty(spark), none, learn).count() == 0


def test_toxicity_learns_words_and_beginnings(spark):
    def make(rng, bad):
        text = neutral(rng)
        return text + (" you slurword" if rng.random() < 0.5 else f" badstem{rng.randrange(99)} badstem{rng.randrange(99, 200)}") * bad

    rows, labels = labelled(spark, make)
    model = toxicity.learn_model(frame(spark, rows), labels)
    found = toxicity.score_toxicity(frame(spark, rows + [(1000 + (i or 0), t) for i, t in TEXTS]), model).collect()
    right = [r["predicted"] == int(r["doc_id"] % 4 == 0) for r in found if r["doc_id"] < 1000]
    assert sum(right) > 0.97 * len(right) and not any(r["predicted"] for r in found if r["doc_id"] >= 1000)
    kept = toxicity.keep_clean(frame(spark, rows), model)
    assert kept.count() == len([r for r in found if r["doc_id"] < 1000 and not r["predicted"]]) and kept.columns == frame(spark, rows).columns
    assert toxicity.score_toxicity(empty(spark), model).count() == 0
    assert toxicity.learn_model(frame(spark), spark.createDataFrame([], LABELS)) == ({}, 0.0)


def test_swapped_names_cost_the_name_its_weight():
    """A name that goes along with toxic labels gets its weight only without counterfactual sentences."""
    rng = random.Random(1)
    names = [f"=n{i}" for i in range(40)]
    known = sorted(["=muslims", "=christians", "=slur", *names])
    number = {w: i for i, w in enumerate(known)}
    rows = []
    for i in range(200):
        bad = i % 2
        words = rng.sample(names, 6) + (["=slur"] if bad and i % 3 else []) + (["=muslims"] if bad or i % 20 == 0 else [])
        swap = [[-1 - number["=muslims"], 1 + number["=christians"]]] if "=muslims" in words else []
        rows.append({"label": bad, "features": sorted(number[w] for w in words), "swaps": swap})
    plain, _ = toxicity.train(rows, len(known), counterfactual=0.0)
    fair, _ = toxicity.train(rows, len(known), counterfactual=30.0)
    gap = lambda w: abs(w[number["=muslims"]] - w[number["=christians"]])
    assert gap(plain) > 1 and gap(fair) < 0.2 * gap(plain) and fair[number["=slur"]] > 0.5


def test_swaps_change_one_name_at_a_time():
    found = toxicity.swaps("Muslims sing. We like muslims and men.", (("muslims", "jews"), ("men", "women")))
    assert found == [({"=men"}, {"=women"}), (set(), {"=jews"})]


def test_features_and_weights_agree():
    found = toxicity.words("stemone stemtwo other")
    weight = {f: 1.0 for f in toxicity.features(found)}
    assert len(toxicity.known_weights(found, weight, toxicity.Starts(weight))) == len(weight)


def statistics(text):
    import re
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    at = {}
    for i in range(len(words) - 2):
        at.setdefault(tuple(words[i : i + 3]), []).append(i)
    covered = {p + k for found in at.values() if len(found) > 1 for p in found for k in range(3)}
    lines = [l for l in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", l)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_statistics_equal_plain_python(spark):
    rows = [(i, t) for i, (_, t) in enumerate(TEXTS)] + [
        (20, "a b c a b c a b c\n\na b\na b\n \n#*"), (21, "x x x x x x"), (22, "a b a b a"), (23, "\x0bq\x1cw e\x0c"), (24, "one two three " * 40)]
    found = {r["doc_id"]: r for r in rules.judge(frame(spark, rows), []).collect()}
    for i, text in rows:
        r = found[i]
        n, chars, symbols, lines, again = statistics(text)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (n, chars, symbols, lines, again)
        assert r["base_failed"] == (n < 50 or 100 * again > 50 * n) and r["kept"] == (not r["base_failed"])
    assert rules.judge(empty(spark), []).count() == 0


def test_decision_lists_are_learnt_and_applied(spark):
    rows, labels = labelled(spark, lambda rng, bad: neutral(rng) + " ### ***" * (6 * bad))
    learnt = rules.quality_rules(frame(spark, rows), labels)
    assert learnt and all(sign in "<=>" for rule in learnt for _, sign, _ in rule)
    found = rules.judge(frame(spark, rows), learnt).collect()
    assert all(r["kept"] == (r["doc_id"] % 4 != 0) for r in found)
    kept = rules.keep_good(frame(spark, rows), learnt)
    assert kept.count() == sum(r["kept"] for r in found) and kept.columns == frame(spark, rows).columns
    assert rules.learn_rules([]) == [] and rules.quality_rules(frame(spark), spark.createDataFrame([], LABELS)) == []


def test_own_groups_are_swapped_and_their_names_weigh_alike(spark):
    rng = random.Random(12)
    rows, labels = [], []
    for i in range(1, 241):
        toxic = i % 2
        words = [f"wort{rng.randrange(60)}" for _ in range(12)] + (["zorgs"] if toxic or i % 10 == 0 else ["blips"] if i % 3 else [])
        rows.append((i, " ".join(words + (["nasty"] if toxic and i % 4 != 1 else []))))
        labels.append((i, 1, toxic, "x"))
    docs, marks = frame(spark, rows), spark.createDataFrame(labels, LABELS)
    groups = (("zorgs", "blips"),)
    sample = docs.select("doc_id", "text")
    assert {"=zorgs", "=blips"} <= set(toxicity.vocabulary(sample, groups=groups, least=1))
    plain, _ = toxicity.learn_model(docs, marks, groups=())
    fair, _ = toxicity.learn_model(docs, marks, groups=groups)
    gap = lambda weights: abs(weights.get("=zorgs", 0.0) - weights.get("=blips", 0.0))
    assert gap(plain) > 0.3 and gap(fair) < gap(plain) / 3
