"""Toxicity scores from a sparse linear classifier that is regularised by counterfactual sentences.

In every labelled sentence that names a group, the name is swapped for other names of the same kind; the
squared change of the score is added to the loss. So the naming itself gets no weight, even where labelled
toxic texts name some groups more often than neutral ones do.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskmatch.llm.common import columns, id_and_text, labelled_sample

WORD = re.compile(r"[^\W\d_]+")
SENTENCE = re.compile(r"[.!?\n]+")
#: lengths of the word beginnings that count where several different words of a text share them
BEGINNINGS = (3, 4, 5, 6, 7, 8)
#: names of one kind; any of them may stand for any other in a counterfactual sentence
GROUPS = (
    ("women", "men", "girls", "boys"), ("woman", "man", "girl", "boy"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("gay", "straight", "lesbian", "bisexual"), ("transgender", "cisgender"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("immigrants", "refugees", "foreigners", "natives"), ("disabled", "blind", "deaf"), ("old", "young", "elderly"),
    ("frauen", "männer", "mädchen", "jungen"), ("muslime", "christen", "juden", "buddhisten", "atheisten"),
    ("schwule", "lesben", "heteros"), ("afrikaner", "asiaten", "europäer"), ("einwanderer", "flüchtlinge", "ausländer"),
    ("femmes", "hommes", "filles", "garçons"), ("musulmans", "chrétiens", "juifs", "bouddhistes", "athées"),
    ("africains", "asiatiques", "européens"), ("immigrés", "réfugiés", "étrangers"),
    ("mujeres", "hombres", "niñas", "niños"), ("musulmanes", "cristianos", "judíos", "budistas", "ateos"),
    ("africanos", "asiáticos", "europeos"), ("inmigrantes", "refugiados", "extranjeros"),
)
#: labelled texts of each class, words in the model, texts a word must occur in
PER_CLASS, VOCABULARY, LEAST_TEXTS = 3000, 50_000, 3
#: weight of the score changes, of the absolute weights, and rounds of the solver
COUNTERFACTUAL, SPARSE, ROUNDS = 10.0, 1e-3, 200


def words(text: str) -> set[str]:
    return set(WORD.findall(text.lower()))


def features(found: set[str]) -> set[str]:
    """What is known of a set of words: the words, the beginnings that two or more of them continue, and of
    these the ones that make up a hundredth of all words or more."""
    shared = Counter(word[:n] for word in found for n in BEGINNINGS if len(word) > n)
    several = {start: n for start, n in shared.items() if n > 1}
    return {
        *("=" + word for word in found), *("^" + start for start in several),
        *("*" + start for start, n in several.items() if 100 * n >= len(found)),
    }


def swaps(text: str, groups=GROUPS) -> list[tuple[set[str], set[str]]]:
    """(features lost, features won) for every name of a group in a sentence and every other name of its kind,
    each pair once per text."""
    kinds = {name: group for group in groups for name in group}
    found = words(text)
    if not found & kinds.keys():
        return []
    sentences = [words(part) for part in SENTENCE.split(text)]
    before, changes = features(found), []
    for name in sorted(found & kinds.keys()):
        elsewhere = sum(name in sentence for sentence in sentences) > 1
        for other in kinds[name]:
            if other != name:
                after = features((found if elsewhere else found - {name}) | {other})
                changes.append((before - after, after - before))
    return changes


def vocabulary(sample: DataFrame, size: int = VOCABULARY, least: int = LEAST_TEXTS, groups=GROUPS) -> list[str]:
    """The features of most sample texts and of most texts swapped within ``groups``."""

    def run(batches):
        for (texts,) in columns(batches, "text"):
            for text in texts:
                known = features(words(text)).union(*(won for _, won in swaps(text, groups)))
                yield pa.RecordBatch.from_pydict({"feature": pa.array(sorted(known), pa.string())})

    counted = sample.select("text").mapInArrow(run, "feature string").groupBy("feature").agg(F.count(F.lit(1)).alias("n"))
    top = counted.filter(F.col("n") >= least).orderBy(F.desc("n"), "feature").limit(size).collect()
    return sorted(r["feature"] for r in top)


def sample_features(sample: DataFrame, known: list[str], groups=GROUPS) -> DataFrame:
    """Per labelled text: the numbers of its features, and its swaps as number + 1, negative where lost."""
    number = {feature: i for i, feature in enumerate(known)}

    def run(batches):
        of = lambda found: sorted(number[f] for f in found if f in number)
        for ids, labels, texts in columns(batches, "doc_id", "label", "text"):
            changes = [
                [[-1 - i for i in of(lost)] + [1 + i for i in of(won)] for lost, won in swaps(t, groups)] for t in texts
            ]
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(ids, pa.int64()), "label": pa.array(labels, pa.int32()),
                "features": pa.array([of(features(words(t))) for t in texts], pa.list_(pa.int32())),
                "swaps": pa.array(changes, pa.list_(pa.list_(pa.int32()))),
            })

    return sample.mapInArrow(run, "doc_id long, label int, features array<int>, swaps array<array<int>>")


def train(rows: list, n_words: int, counterfactual: float = COUNTERFACTUAL, sparse: float = SPARSE, rounds: int = ROUNDS):
    """(weights, bias) by accelerated proximal gradient steps: log loss + score changes + absolute weights."""
    label = np.array([r["label"] for r in rows], "f8")
    sizes = np.array([len(r["features"]) for r in rows])
    at = np.repeat(np.arange(len(rows)), sizes)
    word = np.concatenate([np.array(r["features"], "i8") for r in rows])
    # both classes weigh the same
    share = np.where(label == 1, 0.5 / max(label.sum(), 1), 0.5 / max((1 - label).sum(), 1))
    changes = [change for r in rows for change in r["swaps"] if change]
    change_of = np.repeat(np.arange(len(changes)), [len(c) for c in changes])
    moved_word = np.array([abs(x) - 1 for c in changes for x in c], "i8")
    sign = np.array([1.0 if x > 0 else -1.0 for c in changes for x in c])
    per_change = 2 * counterfactual / max(len(changes), 1)
    # curvature of each weight together with its companions bounds its step
    curve = 0.25 * np.bincount(word, (share * sizes)[at], n_words)
    if changes:
        companions = np.bincount(change_of)[change_of]
        curve += per_change * np.bincount(moved_word, companions, n_words)
    step = 1 / np.maximum(curve, 1e-2)
    weights, bias, ahead, ahead_bias, pace = np.zeros(n_words), 0.0, np.zeros(n_words), 0.0, 1.0
    for _ in range(rounds):
        odds = np.bincount(at, ahead[word], len(rows)) + ahead_bias
        error = share * (1 / (1 + np.exp(-np.clip(odds, -50, 50))) - label)
        slope = np.bincount(word, error[at], n_words)
        if changes:
            change = np.bincount(change_of, sign * ahead[moved_word])
            slope += per_change * np.bincount(moved_word, sign * change[change_of], n_words)
        moved = ahead - step * slope
        # evidence only adds up: neutral words of a long text cannot outweigh toxic ones
        moved = np.maximum(moved - step * sparse, 0)
        moved_bias = ahead_bias - 2.0 * error.sum()
        next_pace = (1 + math.sqrt(1 + 4 * pace * pace)) / 2
        if ((ahead - moved) * (moved - weights)).sum() > 0:  # the momentum points the wrong way: start it anew
            next_pace = pace = 1.0
        ahead = moved + (pace - 1) / next_pace * (moved - weights)
        ahead_bias = moved_bias + (pace - 1) / next_pace * (moved_bias - bias)
        weights, bias, pace = moved, moved_bias, next_pace
    return weights, bias


class Starts(dict):
    """The beginnings of a word that carry a weight, remembered up to a bound."""

    def __init__(self, weight: dict[str, float]):
        super().__init__()
        self.weighted = {feature[1:] for feature in weight if feature[0] != "="}

    def __missing__(self, word: str) -> tuple[str, ...]:
        found = tuple(word[:n] for n in BEGINNINGS if len(word) > n and word[:n] in self.weighted)
        if len(self) >= 100_000:
            self.clear()
        if len(word) <= 64:
            self[word] = found
        return found


def known_weights(found: set[str], weight: dict[str, float], starts: Starts) -> list[float]:
    """The weights of ``features(found)``."""
    shared = Counter(start for listed in map(starts.__getitem__, found) if listed for start in listed)
    several = [start for start, n in shared.items() if n > 1]
    known = ["=" + word for word in found]
    known += ["^" + start for start in several]
    known += ["*" + start for start in several if 100 * shared[start] >= len(found)]
    return [weight[f] for f in known if f in weight]


Model = tuple[dict[str, float], float]


def learn_model(
    docs: DataFrame, labels: DataFrame, learn: Column | None = None, per_class: int = PER_CLASS,
    id_column: str = "doc_id", text_column: str = "text", label: str = "toxic", groups=GROUPS,
) -> Model:
    """(weight by feature, bias), at most VOCABULARY features, from at most ``per_class`` labelled texts of each class."""
    condition = F.lit(True) if learn is None else learn
    sample, totals = labelled_sample(docs, labels, label, condition, per_class, id_column, text_column)
    ones, zeros = totals.get(1, 0), totals.get(0, 0)
    if ones and zeros:
        known = vocabulary(sample, groups=groups)
        # at most 2 * per_class rows with at most VOCABULARY numbers each
        rows = sample_features(sample, known, groups).orderBy("doc_id").collect()
        if len({r["label"] for r in rows}) == 2:
            weights, bias = train(rows, len(known))
            return {w: float(x) for w, x in zip(known, weights) if x}, bias
    return {}, math.log((ones + 1) / (zeros + 1))


def text_score(text: str | None, weight: dict[str, float], bias: float, starts: Starts) -> float:
    odds = bias + math.fsum(known_weights(words(text or ""), weight, starts))
    return 1 / (1 + math.exp(-max(-500.0, min(500.0, odds))))


def score_toxicity(
    docs: DataFrame, model: Model, threshold: float = 0.7, id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """One row per document: doc_id, score (chance of class 1, between 0 and 1), predicted (score >= threshold).

    Both classes had equal weight in learning, so a score is the chance in a mix of equal parts. A null text is
    empty; a text without known features gets the score of the bias alone. Repeated rows and null ids give a
    row each; an empty table gives none; other columns are ignored. A model of labels of one class, or of none,
    scores every text by the share of class 1.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        weight, bias = shared.value
        starts = Starts(weight)
        for ids, texts in columns(batches, "doc_id", "text"):
            found = [text_score(text, weight, bias, starts) for text in texts]
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(ids, pa.int64()), "score": pa.array(found, pa.float64()),
                "predicted": pa.array([int(s >= threshold) for s in found], pa.int32()),
            })

    return id_and_text(docs, id_column, text_column).mapInArrow(run, "doc_id long, score double, predicted int")


def keep_clean(docs: DataFrame, model: Model, threshold: float = 0.7, text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    position = docs.columns.index(text_column)

    def run(batches):
        weight, bias = shared.value
        starts = Starts(weight)
        for batch in batches:
            scores = [text_score(text, weight, bias, starts) for text in batch.column(position).to_pylist()]
            yield batch.filter(pa.array([s < threshold for s in scores], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
