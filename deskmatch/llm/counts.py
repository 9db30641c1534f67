"""Token counts per text by a two-tier lookup in the map tasks: no word is shuffled.

A word is a stretch without ASCII white space. The vocabulary drops white space and never joins
characters across it, so the count of a text is the sum over its words.
"""

from __future__ import annotations

import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from deskmatch.llm.bpe import tokenizer
from deskmatch.llm.common import columns, id_and_text, stored
from deskmatch.llm.word_bpe import LowerWords, drops_spaces, ranks_suffice

#: entries of the broadcast table, entries each task offers for it, and of a worker's cache of further words
FREQUENT, OFFERED, CACHED = 32_768, 16_384, 200_000
#: longer words are encoded where they stand, so that tables hold short keys only
KEY_BYTES = 64


def _sketch(seen: Counter, offer: int) -> bytes:
    """The most frequent words with their counts, as one compressed value."""
    best = seen.most_common(offer)
    counts = np.array([n for _, n in best], "<u8").tobytes()
    return zlib.compress(len(best).to_bytes(4, "little") + counts + b" ".join(word for word, _ in best), 1)


def _seen(sketch: bytes) -> Counter:
    raw = zlib.decompress(sketch)
    n = int.from_bytes(raw[:4], "little")
    return Counter(dict(zip(raw[4 + 8 * n :].split(b" ") if n else [], np.frombuffer(raw, "<u8", n, 4).tolist())))


def frequent_words(texts: DataFrame, keep: int = FREQUENT, offer: int = OFFERED) -> list[bytes]:
    """At most ``keep`` words that are frequent over all texts.

    Each task makes one sketch of its most frequent words; sketches of bounded size are merged in a tree, so
    neither words nor counts are dealt out by key. The choice decides speed, never a count.
    """

    def run(batches):
        seen: Counter = Counter()
        for (listed,) in columns(batches, "text"):
            for text in listed:
                seen.update(text.encode().split())
            if len(seen) > 20 * offer:  # bounded: the rarest half goes
                seen = Counter(dict(seen.most_common(10 * offer)))
        short = Counter({w: n for w, n in seen.most_common(2 * offer) if len(w) <= KEY_BYTES})
        yield pa.RecordBatch.from_pydict({"sketch": pa.array([_sketch(short, offer)], pa.binary())})

    made = stored(texts.select("text").mapInArrow(run, "sketch binary"), "word-sketches")
    merged = made.rdd.map(lambda row: bytes(row["sketch"])).treeReduce(lambda a, b: _sketch(_seen(a) + _seen(b), 2 * offer)) if made.head(1) else b""
    return [word for word, _ in _seen(merged).most_common(keep)] if merged else []


class Counts(dict):
    """Token count by word: the frequent ones from the start, misses encoded and remembered up to a bound."""

    def __init__(self, path: str, frequent: dict[bytes, int], limit: int = CACHED, by_rank: bool = False):
        super().__init__(frequent)
        self.frequent, self.limit = frequent, limit
        self.words = LowerWords(path, limit, by_rank)
        self.width = 2 if self.words.code == "H" else 4

    def __missing__(self, word: bytes) -> int:
        n = len(self.words.found(word)) // self.width
        if len(word) <= KEY_BYTES:
            if len(self) >= self.limit + len(self.frequent):
                self.clear()
                self.update(self.frequent)
            self[word] = n
        return n


@lru_cache(maxsize=2)
def _counts(path: str, words: bytes, sizes: bytes, by_rank: bool) -> Counts:
    return Counts(path, dict(zip(words.split(), sizes)), by_rank=by_rank)


def count_tokens(
    docs: DataFrame, path: str, limit: int = 2048, id_column: str = "doc_id", text_column: str = "text",
    keep: int = FREQUENT,
) -> DataFrame:
    """One row per document: doc_id, n_bytes (UTF-8), n_tokens, over_limit (more than ``limit`` tokens).

    Counts are those of the tokenizers file at ``path`` for the whole text, without added tokens; a special
    token written in a text counts as one. Null and empty texts count 0. Repeated rows and null ids give a
    row each; an empty table gives none; other columns are ignored. A file that keeps white space is refused,
    as its counts are not those of the words.
    """
    if not drops_spaces(path):
        raise ValueError(f"{path} does not cut at white space and drop it")
    by_rank = ranks_suffice(path)
    texts = id_and_text(docs, id_column, text_column)
    words = frequent_words(texts, keep)
    sizes = [len(e.ids) for e in tokenizer(path).encode_batch([w.decode() for w in words], add_special_tokens=False)]
    short = [(w, n) for w, n in zip(words, sizes) if n < 256]
    # at most `keep` keys of KEY_BYTES: two megabytes, whatever the input
    compact = texts.sparkSession.sparkContext.broadcast((b" ".join(w for w, _ in short), bytes(n for _, n in short)))

    def run(batches):
        get = _counts(path, *compact.value, by_rank).__getitem__
        for ids, listed in columns(batches, "doc_id", "text"):
            raw = [text.encode() for text in listed]
            counted = [sum(map(get, text.split())) for text in raw]
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(ids, pa.int64()), "n_bytes": pa.array(map(len, raw), pa.int64()),
                "n_tokens": pa.array(counted, pa.int64()), "over_limit": pa.array([n > limit for n in counted], pa.bool_()),
            })

    return texts.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
