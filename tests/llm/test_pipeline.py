import random

import corpus_pipeline
from helpers import LABELS
from test_near import brute
from test_tokens import check_places

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    """Good, symbol-ridden and toxic documents, near copies of good ones, and too short ones."""
    rng = random.Random(9)
    rows, kinds = [], {}
    for i in range(1, 201):
        words = [f"wort{rng.randrange(400)}" for _ in range(80)]
        kind = ("good", "good", "bad", "toxic", "copy")[i % 5]
        if kind == "bad":
            words = [w + "###" if k % 3 else w for k, w in enumerate(words)]
        if kind == "toxic":
            words[5] = words[40] = "slurword"
        if kind == "copy" and rows:
            words = next(t for d, t in rows[::-1] if kinds[d] == "good").split()
            words[70] = f"edit{i}"
        rows.append((i, " ".join(words)))
        kinds[i] = kind
    rows += [(300, None), (301, ""), (302, "short text")]
    return rows, kinds


def test_stages_equal_plain_versions(spark, tmp_path):
    rows, kinds = corpus()
    folder = str(tmp_path / "sf")
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, int(k != "bad"), int(k == "toxic"), "x") for i, k in kinds.items()]
    spark.createDataFrame(labels, LABELS).write.parquet(f"{folder}/labels.parquet")

    docs, seen = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, folder)
        assert found.columns == docs.columns
        path = str(tmp_path / name.replace(" ", "_"))
        found.write.parquet(path)
        docs = spark.read.parquet(path)
        seen.append({r["doc_id"]: r["text"] for r in docs.collect()})
    good = {i for i, k in kinds.items() if k != "bad"}
    assert set(seen[0]) == good
    assert set(seen[1]) == {i for i in good if kinds[i] != "toxic"}
    expected = brute(sorted(seen[1].items()), 5, 80)
    assert set(seen[2]) == {i for i, (_, root) in expected.items() if root == i} and len(seen[2]) < len(seen[1])

    packed = corpus_pipeline.run(spark, folder).collect()
    assert {r["doc_id"] for r in packed} == set(seen[2])
    assert check_places(packed, sorted(seen[2].items()), 1024) <= len(seen[2])
