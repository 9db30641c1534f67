"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deskmatch.llm import bpe, chat, counts, fim, licenses, near, packing, phrases, quality, rules, token_files, topk, toxicity
from deskmatch.llm.common import id_remainder, table

BYTE_BPE, WORD_BPE = "byte_bpe_50k.json", "word_bpe_49k.json"


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids and of the decoded text of every document."""
    return bpe.encode_and_decode(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), keep_ids=False)


def _with_fold(scored: DataFrame, divisor: int, remainder: int) -> DataFrame:
    held_out = F.coalesce(id_remainder(F.col("doc_id"), divisor) == remainder, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; labels of the third with remainder 1 are held out."""
    learn = id_remainder(F.col("doc_id"), 3) != 1
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.learn_model(docs, labels, learn)
    return _with_fold(toxicity.score_toxicity(docs, model, threshold=0.7), 3, 1)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; labels of the fifth with remainder 0 are held out."""
    learn = id_remainder(F.col("doc_id"), 5) != 0
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return _with_fold(quality.score_quality(docs, labels, learn, threshold=0.3), 5, 0)


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all conversations and a difficult one, read back from their formatted texts."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    hard = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    messages = rows.unionByName(hard).withColumn("parts", chat.text_part(F.col("text")))
    back = chat.read_back(chat.format_conversations(messages))
    lines = F.transform("messages", lambda m: F.concat(m["role"], F.lit("\n"), m["text"], F.lit("\n")))
    learnt = F.array_join("learnt", "")
    return back.select(
        "conv_id", F.size("messages").cast("long").alias("n_turns"), F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.char_length(learnt).cast("long").alias("loss_chars"), F.sha2(learnt, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


OP3_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
  CAST(sum(23 + length(regexp_replace(role, '[\\<\[]', 'xx', 'g')) + length(regexp_replace(text, '[\\<\[]', 'xx', 'g'))) AS BIGINT)
    AS formatted_chars
FROM c GROUP BY conv_id
"""


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and verdict of the learnt decision list for every document."""
    docs = table(spark, sf_dir, "documents")
    learnt = rules.quality_rules(docs, table(spark, sf_dir, "labels"))
    return rules.judge(docs, learnt).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents on three-word shingles."""
    return near.near_duplicates(table(spark, sf_dir, "documents"), size=3, percent=85)


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License of every page: its own notice, or that of the nearest folder of its address. Any page that states
    a license is a witness for its folder, as addresses here name no licence files."""
    path = F.regexp_replace(F.regexp_replace("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://", ""), r"/*([?#].*)?$", "")
    pages = table(spark, sf_dir, "pages").select("page_id", path.alias("path"), "html")
    found = licenses.scan(pages, id_column="page_id", text_column="html", witness=F.lit(True))
    return found.withColumnRenamed("id", "page_id")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document."""
    return counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE), limit=2048)


def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five highest inner products of every fiftieth vector with all others."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256)


OP9_SQL = """
WITH v AS (
  SELECT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in sequences of 1024 tokens."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fill-in-the-middle example of every document, with the text rebuilt from it."""
    found = fim.fill_in_middle(table(spark, sf_dir, "documents"), seed=42, percent=50, suffix_first=80)
    return found.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(fim.restored(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"),
    )


OP11_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), u AS (
  SELECT doc_id, t, regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units,
    CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
    CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM d
), c AS (
  SELECT *, CAST(len(units) AS BIGINT) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a,
    greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain'
      WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM u
), p AS (
  SELECT doc_id, t, n, form, coalesce(array_to_string(units[1:a], ''), '') AS prefix,
    coalesce(array_to_string(units[a + 1:b], ''), '') AS middle, coalesce(array_to_string(units[b + 1:n], ''), '') AS suffix FROM c
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM p
"""


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as the token files give it back."""
    docs = table(spark, sf_dir, "documents")
    folder, manifest = token_files.write_token_files(docs, public_tokenizers.path(WORD_BPE), end_id=2)
    return token_files.read_documents(folder, manifest, keep_ids=False)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 best phrases of two and three words in each language."""
    return phrases.collocations(table(spark, sf_dir, "documents"), longest=3, least=10, top=2000)


OP13_SQL = r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), p AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM d
), i AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM p
), g AS (
  SELECT lang, unnest([w[i:i + s - 1] FOR s IN range(1, 4) IF i + s - 1 <= len(w)]) AS g FROM i
), f AS (
  SELECT lang, array_to_string(g, ' ') AS phrase, len(any_value(g)) AS size, any_value(g) AS g, count(*) AS f
  FROM g GROUP BY lang, array_to_string(g, ' ')
), n AS (
  SELECT lang, sum(f) AS n FROM f WHERE size = 1 GROUP BY lang
), c AS (
  SELECT lang, phrase, size, g, f AS a, unnest(range(1, size)) AS k FROM f WHERE size > 1 AND f >= 10
), s AS (
  SELECT c.lang, c.phrase, c.size, c.a, c.k, h.f AS l, t.f AS r,
    (1000000::HUGEINT * c.a * c.a) // (h.f::HUGEINT * t.f) AS score
  FROM c JOIN f h ON h.lang = c.lang AND h.phrase = array_to_string(c.g[1:c.k], ' ')
    JOIN f t ON t.lang = c.lang AND t.phrase = array_to_string(c.g[c.k + 1:], ' ')
), b AS (
  SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), o AS (
  SELECT lang, p AS phrase, max(f) AS longer FROM (
    SELECT lang, f, unnest([array_to_string(g[1:2], ' '), array_to_string(g[2:3], ' ')]) AS p FROM f WHERE size = 3 AND f >= 10
  ) GROUP BY lang, p
), r AS (
  SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank
  FROM b LEFT JOIN o ON o.lang = b.lang AND o.phrase = b.phrase WHERE o.longer IS NULL OR 100 * o.longer < 50 * b.a
)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM r JOIN n USING (lang) WHERE rank <= 2000
"""


QUERIES = {
    "op1_bpe": op1_bpe, "op2_toxicity": op2_toxicity, "op3_chat": op3_chat,
    "op4_quality_rules": op4_quality_rules, "op5_near_duplicates": op5_near_duplicates,
    "op6_licenses": op6_licenses,
    "op7_token_counts": op7_token_counts, "op8_quality": op8_quality,
    "op9_top_k": op9_top_k, "op10_packing": op10_packing,
    "op11_fill_in_middle": op11_fill_in_middle, "op12_token_files": op12_token_files,
    "op13_collocations": op13_collocations,
}
SQL: dict[str, str] = {
    "op3_chat": OP3_SQL, "op9_top_k": OP9_SQL, "op11_fill_in_middle": OP11_SQL,
    "op13_collocations": OP13_SQL,
}
