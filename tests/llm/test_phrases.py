import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import LONG, empty

from deskmatch.llm import phrases

DOCS = "doc_id long, text string, lang string, f long, id long, word string, score string"


def frame(spark, rows):
    return spark.createDataFrame([(k, text, lang, 1, 2, "x", "y") for k, (text, lang) in enumerate(rows)], DOCS)


def brute(rows, longest=3, least=10, top=2000, percent=50, scale=1_000_000):
    """The whole report, plainly."""
    counts, report = defaultdict(Counter), []
    for text, lang in rows:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            for i in range(len(words)):
                for size in range(1, min(longest, len(words) - i) + 1):
                    counts["und" if lang is None else lang][tuple(words[i : i + size])] += 1
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        found, candidates = [], [p for p, c in f.items() if len(p) > 1 and c >= least]
        longer = Counter()
        for p in candidates:
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    longer[p[i : i + size]] = max(longer[p[i : i + size]], f[p])
        for p in candidates:
            a = f[p]
            if 100 * longer[p] >= percent * a and longer[p]:
                continue
            score, k = min((scale * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:top], 1):
            report.append((lang, rank, phrase.decode(), -a, l, r, n, -score))
    return sorted(report)


def corpus(seed):
    rng = random.Random(seed)
    words = ["the", "of", "New", "york", "City", "los", "é", "漢", "x", "y z", "a\x00b"]
    rows = []
    for _ in range(300):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\r\n", " ; "]) for _ in range(rng.randrange(40)))
        rows.append((text, rng.choice(["en", "de", None])))
    return rows + [(None, "en"), ("", "en"), (" . ", "fr"), ("...", None), (LONG, "es"), ("one two three " * 30, "it")]


@pytest.mark.parametrize("longest,least,top,block", [(3, 10, 2000, 2000), (2, 3, 15, 10**7), (4, 5, 2000, 10**7), (3, 1, 50, 300)])
def test_report_equals_brute_force(spark, longest, least, top, block):
    rows = corpus(longest)
    found = phrases.collocations(frame(spark, rows), longest, least, top, block_bytes=block).collect()
    assert sorted(tuple(r) for r in found) == brute(rows, longest, least, top)


@pytest.mark.parametrize("base", [50, 2**20, 2**30])
def test_distinct_windows_whatever_the_vocabulary(base):
    rng = np.random.default_rng(1)
    leads = [rng.integers(0, base, 500) for _ in range(4)]
    leads = [np.concatenate([lead, lead[:100]]) for lead in leads]
    found, counts = phrases._distinct(iter(leads), base)
    assert Counter(dict(zip(zip(*(f.tolist() for f in found)), counts.tolist()))) == Counter(zip(*(lead.tolist() for lead in leads)))
    assert phrases._distinct(iter([np.empty(0, "i8")] * 3), base)[1].tolist() == []


@pytest.mark.parametrize("highest,longest,numbers", [(3, 3, 1), (2**21 - 1, 3, 1), (2**21, 3, 2), (2**40, 3, 3), (2**31, 4, 4)])
def test_ids_fit_their_numbers(highest, longest, numbers):
    bits, together, n = phrases.layout(highest, longest)
    assert n == numbers and bits * together <= 63 and highest < 1 << bits


def test_products_beyond_64_bits(spark):
    from pyspark.sql import functions as F

    row = spark.createDataFrame([(10**13, 10**14, 10**13 + 7)], "a long, l long, r long")
    above = phrases._exact(F.col("a")) * phrases._exact(F.col("a")) * F.lit(1_000_000).cast("decimal(10,0)")
    row = row.withColumn("above", above).withColumn("below", phrases._exact(F.col("l")) * phrases._exact(F.col("r")))
    assert row.select(F.expr("above div below").alias("v")).first()["v"] == 10**6 * 10**26 // (10**14 * (10**13 + 7))


def test_empty_table(spark):
    assert phrases.collocations(frame(spark, [("x", "en")]).filter("false")).count() == 0
    assert phrases.collocations(empty(spark), group_column="part").columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
