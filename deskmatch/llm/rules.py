"""Quality rules learnt as a decision list, applied as ordered Spark conditions.

Statistics of a text are column expressions. Sequential covering learns the list from labelled statistics:
a rule is grown on one part of the sample by adding the threshold that gains most, pruned on another part
from its end, and kept if it is precise there; what it covers leaves the sample before the next rule.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskmatch.llm.common import SPACES, labelled_sample

SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: labelled texts of each class, rules, conditions per rule, candidate thresholds per measure
PER_CLASS, MAX_RULES, MAX_CONDITIONS, THRESHOLDS = 2000, 12, 4, 40
#: a rule must be right on this share of what it covers in the pruning part, and cover so many texts
PRECISION, LEAST_COVER = 0.95, 3

STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_capitals", "n_marks", "n_chars")


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _count_of(text: Column, characters: str) -> Column:
    return F.char_length(text) - F.char_length(F.translate(text, characters, ""))


def repeat_words(words: Column) -> Column:
    """Words inside three-word windows that occur at least twice. Windows are compared by 64-bit hashes."""
    hashes = F.transform(words, lambda word: F.xxhash64(word))
    windows = let(hashes, lambda h: F.transform(
        F.slice(h, 1, F.greatest(F.size(h) - 2, F.lit(0))), lambda x, i: F.xxhash64(x, F.get(h, i + 1), F.get(h, i + 2))))

    def covered(w: Column) -> Column:
        ordered = F.sort_array(F.transform(w, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        starts = let(ordered, lambda s: F.transform(
            F.filter(s, lambda x, i: (F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"])), lambda x: x["i"]))
        # from one repeated window to the next at most three new words
        steps = let(F.sort_array(starts), lambda p: F.transform(
            p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3)))))
        return F.aggregate(steps, F.lit(0), lambda total, n: total + n)

    return let(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(covered(w)))


def text_statistics(text: Column) -> dict[str, Column]:
    """All statistics of one text column; a null text is empty."""
    text = F.coalesce(text, F.lit(""))
    words = F.array_remove(F.split(text, "[\\x20\\x09-\\x0D]+"), "")
    lines = F.filter(F.split(text, "\n"), lambda line: F.char_length(F.translate(line, SPACES, "")) > 0)
    of_words = let(words, lambda w: F.struct(F.size(w).alias("n"), repeat_words(w).alias("again")))
    columns = {
        "_of_words": of_words,
        "word_chars": F.char_length(F.translate(text, SPACES, "")),
        "n_symbols": _count_of(text, SYMBOLS),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))),
        "n_capitals": _count_of(text, CAPITALS),
        "n_marks": _count_of(text, "!?.,;:"),
        "n_chars": F.char_length(text),
    }
    return columns


def with_statistics(docs: DataFrame, text_column: str = "text", into: str = "stats") -> DataFrame:
    """``docs`` with one more struct column that holds the statistics as longs."""
    parts = text_statistics(F.col(text_column))
    packed = docs.withColumn(into, F.struct(*[c.alias(name) for name, c in parts.items()]))
    s = F.col(into)
    longs = {"n_words": s["_of_words"]["n"], "n_repeat_words": s["_of_words"]["again"]}
    return packed.withColumn(into, F.struct(*[longs.get(n, s[n] if n not in longs else s).cast("long").alias(n) for n in STATISTICS]))


def measures(stats: Column) -> dict[str, Column]:
    """What rules compare with thresholds: one size and shares that do not depend on it."""
    words = F.greatest(stats["n_words"], F.lit(1)).cast("double")
    chars = F.greatest(stats["n_chars"], F.lit(1)).cast("double")
    return {
        "words": stats["n_words"].cast("double"),
        "word_length": stats["word_chars"] / words,
        "symbols": stats["n_symbols"] / words,
        "dup_lines": stats["n_dup_lines"].cast("double"),
        "repeats": stats["n_repeat_words"] / words,
        "capitals": stats["n_capitals"] / chars,
        "marks": stats["n_marks"] / words,
    }


def base_failed(stats: Column) -> Column:
    return (stats["n_words"] < 50) | (100 * stats["n_repeat_words"] > 50 * stats["n_words"])


Rule = list[tuple[str, str, float]]


def _holds(rule: Rule, data: dict[str, np.ndarray]) -> np.ndarray:
    held = np.ones(len(next(iter(data.values()))), bool)
    for name, sign, bound in rule:
        held &= data[name] > bound if sign == ">" else data[name] <= bound
    return held


def _grow(data: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    rule: Rule = []
    held = np.ones(len(bad), bool)
    while len(rule) < MAX_CONDITIONS and (held & ~bad).any():
        p, n = (held & bad).sum(), (held & ~bad).sum()
        best, gain = None, 1e-9
        for name, values in data.items():
            seen = np.unique(values[held])
            at = np.unique(np.linspace(0, len(seen) - 1, THRESHOLDS + 1).astype(int)[:-1])
            for bound in (seen[at] + seen[np.minimum(at + 1, len(seen) - 1)]) / 2:
                above = held & (values > bound)
                for sign, now in ((">", above), ("<=", held & ~above)):
                    p1, n1 = (now & bad).sum(), (now & ~bad).sum()
                    if p1:
                        won = p1 * (np.log2(p1 / (p1 + n1)) - np.log2(p / (p + n)))
                        if won > gain:
                            best, gain = (name, sign, float(bound)), won
        if best is None:
            break
        rule.append(best)
        held &= _holds([best], data)
    return rule


def learn_rules(rows: list[dict], seed: int = 5) -> list[Rule]:
    """Ordered rules for texts to reject, from measures and a label (1: good, 0: bad) per text."""
    if not rows:
        return []
    names = [n for n in rows[0] if n != "label"]
    data = {n: np.array([r[n] for r in rows], "f8") for n in names}
    bad = np.array([r["label"] == 0 for r in rows])
    prune = np.random.default_rng(seed).random(len(rows)) < 1 / 3
    left, rules = np.ones(len(rows), bool), []
    while len(rules) < MAX_RULES:
        part = lambda mask: {n: v[mask] for n, v in data.items()}
        growing, pruning = left & ~prune, left & prune
        if not bad[growing].any():
            break
        rule = _grow(part(growing), bad[growing])
        if not rule:
            break

        def worth(candidate: Rule) -> float:
            held = _holds(candidate, part(pruning))
            p, n = (held & bad[pruning]).sum(), (held & ~bad[pruning]).sum()
            return (p - n) / max(p + n, 1)

        while len(rule) > 1 and worth(rule[:-1]) >= worth(rule):
            rule = rule[:-1]
        held = _holds(rule, part(left))
        p, n = (held & bad[left]).sum(), (held & ~bad[left]).sum()
        seen = _holds(rule, part(pruning))
        p2, n2 = (seen & bad[pruning]).sum(), (seen & ~bad[pruning]).sum()
        if p < LEAST_COVER or p < PRECISION * (p + n) or p2 < PRECISION * (p2 + n2):
            break
        rules.append(rule)
        left &= ~_holds(rule, data)
    return rules


def verdict(rules: list[Rule], stats: Column) -> Column:
    """The decision list as one conditional: the first rule that holds rejects, else the text is good."""
    values = measures(stats)
    decision = None
    for rule in rules:
        condition = F.lit(True)
        for name, sign, bound in rule:
            condition = condition & (values[name] > F.lit(bound) if sign == ">" else values[name] <= F.lit(bound))
        decision = F.when(condition, F.lit(False)) if decision is None else decision.when(condition, F.lit(False))
    return F.lit(True) if decision is None else decision.otherwise(F.lit(True))


def quality_rules(
    docs: DataFrame, labels: DataFrame, learn: Column | None = None, per_class: int = PER_CLASS,
    id_column: str = "doc_id", text_column: str = "text", label: str = "quality",
) -> list[Rule]:
    """The decision list of the labelled texts that pass the base conditions; at most ``per_class`` of each class."""
    sample, _ = labelled_sample(docs, labels, label, F.lit(True) if learn is None else learn, per_class, id_column, text_column)
    known = with_statistics(sample).filter(~base_failed(F.col("stats"))).orderBy("doc_id")
    rows = known.select("label", *[c.alias(n) for n, c in measures(F.col("stats")).items()]).collect()
    return learn_rules([r.asDict() for r in rows])


def judge(
    docs: DataFrame, rules: list[Rule], id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """One row per document: doc_id, the statistics, base_failed and kept.

    A null text is empty: no words, so it fails the base conditions. Repeated rows and null ids give a row
    each; an empty table gives none; other columns are ignored. No labels, no rules: all that pass are kept.
    """
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    stats = F.col("stats")
    failed = base_failed(stats)
    return with_statistics(texts).select(
        "doc_id", *[stats[n].alias(n) for n in STATISTICS], failed.alias("base_failed"),
        (~failed & verdict(rules, stats)).alias("kept"),
    )


def keep_good(docs: DataFrame, rules: list[Rule], text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns."""
    whole = docs.select(F.struct("*").alias("row"), F.col(text_column).alias("text"))
    stats = F.col("stats")
    return with_statistics(whole).filter(~base_failed(stats) & verdict(rules, stats)).select("row.*")
