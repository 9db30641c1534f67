import __spark_entry__ as registry
import corpus_pipeline
from helpers import LABELS, LONG, TEXTS, empty, frame
from test_near import plainly

from deskmatch.llm import near, packing, rules, toxicity


def test_every_operator_is_registered():
    names = registry.queries()
    assert all(any(name.startswith(f"op{n}_") for name in names) for n in range(1, 14)) and "pipeline" in names
    assert {"op3_chat", "op9_top_k", "op11_fill_in_middle", "op13_collocations"} <= set(registry.oracle_sql())


def test_stages_take_every_text(spark, tmp_path):
    """Null, empty and very long texts, repeated ids, clashing columns: each stage keeps the rows its own rule keeps."""
    words = " ".join(f"wort{k}" for k in range(80))
    rows = TEXTS + [(20, words), (20, words), (21, words + " mehr"), (22, words), (22, LONG * 2), (None, words), (23, "wort " * 60)]
    docs = frame(spark, rows)
    labels = spark.createDataFrame([(20, 1, 0, "x"), (23, 0, 0, "x"), (1, 0, 1, "x"), (20, 0, 1, "y"), (None, 1, 1, "z")], LABELS)
    folder = str(tmp_path)
    labels.write.parquet(f"{folder}/labels.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, folder)
        assert found.columns == docs.columns and found.count() <= len(rows)
        nothing = stage(spark, empty(spark), folder)
        assert nothing.columns == docs.columns and nothing.count() == 0
    kept = near.keep_one(docs, 5, 80).collect()
    plain = plainly([r for r in rows if r[0] is not None], 5, 80)
    expected = {k for k, (_, component) in plain.items() if component == k[0]}
    assert {(r["doc_id"], r["text"]) for r in kept if r["doc_id"] is not None} == expected
    assert packing.pack_documents(docs, corpus_pipeline.public_tokenizers.path("byte_bpe_50k.json")).select("doc_id").distinct().count() > 5
    assert rules.keep_good(empty(spark), rules.quality_rules(docs, labels)).count() == 0
    assert toxicity.keep_clean(empty(spark), toxicity.learn_model(docs, labels)).count() == 0
