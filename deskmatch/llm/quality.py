"""Quality scores from supervised subword embeddings.

A word is the mean of the vectors of its own bucket and of the buckets of its character n-grams; a text is
the mean of its words; a softmax over two classes reads the text vector. Everything is trained here by
stochastic gradient descent on a bounded sample of labelled texts.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from functools import lru_cache
from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from deskmatch.llm.common import columns, id_and_text, labelled_sample

BUCKETS, WIDTH, GRAMS = 1 << 16, 16, (3, 4, 5)
#: labelled texts of each class that are learnt from, passes over them, and the first step size
PER_CLASS, EPOCHS, RATE = 1000, 5, 0.05
CACHED = 300_000


def buckets(word: str) -> list[int]:
    """The bucket of the word and of each of its character n-grams."""
    framed = f"<{word}>"
    found = [zlib.crc32(b"=" + word.encode())]
    found += [zlib.crc32(framed[i : i + n].encode()) for n in GRAMS for i in range(len(framed) - n + 1)]
    return [h % BUCKETS for h in found]


def signs(listed: list[str]) -> list[tuple[str, int]]:
    """Words of the model's own that tell what no single word does, with their counts: repeats of the word just
    before, repeats at all, and the order of the text's length. White space keeps them apart from words of a text."""
    n = len(listed)
    again = sum(map(eq, listed, islice(listed, 1, None)))
    return [(" again", again), (" seen", n - len(set(listed))), (f" {n.bit_length()} bits", 1 + n // 16)] if n else []


def text_features(text: str) -> tuple[list[int], list[float]]:
    """Distinct buckets of a text and their weights in the text vector; both empty for a text without words."""
    total: Counter = Counter()
    listed = text.split()
    counted = Counter(listed) + Counter(dict(signs(listed)))
    n_words = sum(counted.values())
    for word, n in counted.items():
        found = buckets(word)
        for bucket in found:
            total[bucket] += n / len(found) / n_words
    return list(total), list(total.values())


def sample_features(sample: DataFrame) -> DataFrame:
    def run(batches):
        for ids, labels, texts in columns(batches, "doc_id", "label", "text"):
            found = [text_features(text) for text in texts]
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(ids, pa.int64()), "label": pa.array(labels, pa.int32()),
                "bucket": pa.array([f[0] for f in found], pa.list_(pa.int32())),
                "weight": pa.array([f[1] for f in found], pa.list_(pa.float32())),
            })

    return sample.mapInArrow(run, "doc_id long, label int, bucket array<int>, weight array<float>")


def train(examples: list[tuple[int, np.ndarray, np.ndarray]], epochs: int = EPOCHS, seed: int = 7):
    """(bucket scores, bias): the log odds of class 1 are the weighted mean of the scores, plus the bias."""
    random = np.random.default_rng(seed)
    vectors = random.uniform(-1 / WIDTH, 1 / WIDTH, (BUCKETS, WIDTH)).astype("f4")
    output, bias = random.uniform(-0.1, 0.1, (2, WIDTH)).astype("f4"), np.zeros(2, "f4")
    share = Counter(label for label, _, _ in examples)
    moved = np.zeros(BUCKETS, "f4")  # squared steps so far: buckets that moved much move slower
    steps, done = epochs * len(examples), 0
    for _ in range(epochs):
        for at in random.permutation(len(examples)):
            label, bucket, weight = examples[at]
            rate = RATE * (1 - done / steps)
            done += 1
            hidden = weight @ vectors[bucket] if len(bucket) else np.zeros(WIDTH, "f4")
            odds = output @ hidden + bias
            guess = np.exp(odds - odds.max())
            guess /= guess.sum()
            guess[label] -= 1
            guess *= len(examples) / 2 / share[label]  # both classes weigh the same
            back = guess @ output
            output -= rate * np.outer(guess, hidden)
            bias -= rate * guess
            if len(bucket):
                slope = weight[:, None] * back
                moved[bucket] += (slope * slope).mean(axis=1)
                vectors[bucket] -= rate * slope / np.sqrt(moved[bucket] + 1e-10)[:, None]
    return (vectors @ (output[1] - output[0])).astype("f8"), float(bias[1] - bias[0])


class WordScores(dict):
    """Mean bucket score by word, remembered up to a bound."""

    def __init__(self, scores: np.ndarray):
        super().__init__()
        self.scores = scores.tolist()

    def __missing__(self, word: str) -> float:
        found = buckets(word)
        value = math.fsum(map(self.scores.__getitem__, found)) / len(found)
        if len(word) <= 64:
            if len(self) >= CACHED:
                self.clear()
            self[word] = value
        return value


@lru_cache(maxsize=2)
def _scores(raw: bytes) -> WordScores:
    return WordScores(np.frombuffer(raw, "f8"))


def score_quality(
    docs: DataFrame, labels: DataFrame, learn: Column, threshold: float = 0.3, per_class: int = PER_CLASS,
    id_column: str = "doc_id", text_column: str = "text", label: str = "quality",
) -> DataFrame:
    """One row per document: doc_id, score (chance of class 1, between 0 and 1), predicted (score >= threshold).

    ``learn`` is a condition on doc_id; only labels that meet it are learnt from, at most ``per_class`` of each
    class. A null text is empty; texts without words get the score of the bias alone. Repeated rows and null
    ids give a row each. Without labels of both classes every score is the share of class 1 (0.5 if there are no labels).
    """
    sample, totals = labelled_sample(docs, labels, label, learn, per_class, id_column, text_column)
    # at most 2 * per_class rows with at most BUCKETS entries each
    listed = sample_features(sample).orderBy("doc_id").toArrow()
    examples = [
        (label.as_py(), bucket.values.to_numpy().astype("i8"), weight.values.to_numpy())
        for label, bucket, weight in zip(*(listed[c] for c in ("label", "bucket", "weight")))
    ]
    ones, zeros = totals.get(1, 0), totals.get(0, 0)
    if len({e[0] for e in examples}) == 2:
        scores, bias = train(examples)
    else:
        scores, bias = np.zeros(BUCKETS), 0.0
    # trained on equal classes, read at the shares of the labels
    bias += math.log((ones + 1) / (zeros + 1))
    shared = docs.sparkSession.sparkContext.broadcast(scores.tobytes())  # BUCKETS numbers

    def run(batches):
        get = _scores(shared.value).__getitem__
        for ids, texts in columns(batches, "doc_id", "text"):
            found = []
            for text in texts:
                listed = text.split()
                own = signs(listed)
                total = sum(map(get, listed)) + sum(get(word) * n for word, n in own)
                odds = bias + (total / (len(listed) + sum(n for _, n in own)) if listed else 0.0)
                found.append(1 / (1 + math.exp(-max(-500.0, min(500.0, odds)))))
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(ids, pa.int64()), "score": pa.array(found, pa.float64()),
                "predicted": pa.array([int(s >= threshold) for s in found], pa.int32()),
            })

    return id_and_text(docs, id_column, text_column).mapInArrow(run, "doc_id long, score double, predicted int")
