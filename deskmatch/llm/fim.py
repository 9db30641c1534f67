"""Fill-in-the-middle examples. A unit is a word with the white space before it, or white space that ends a text.

A rolling hash cuts the bytes of a text into chunks where its content says so, so that texts which share a
passage share its chunks. A chunk's summary (words, and whether it begins and ends inside a word) is kept in
the worker under the chunk's content; a chunk met again costs a lookup that compares its bytes. Summaries of
neighbours combine to the number of units of the text and lead to the chunk that holds a cut.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Sequence
from functools import lru_cache
from itertools import islice
from struct import unpack
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskmatch.llm.bpe import Cached
from deskmatch.llm.common import columns, id_and_text

MARKS = ("<P>", "<S>", "<M>")
#: a chunk has 1,024 bytes on average; the hash sees the last 32
CHUNK_BITS, WINDOW = 10, 32
#: longer texts are hashed in parts, longer chunks are not remembered
PART_BYTES, LONGEST_KEPT = 4_000_000, 8_192
#: chunks of one of the two generations of a worker's cache: at most 64 MB each
CACHE_CHUNKS = 8_192
WORD = re.compile(rb"[^\t-\r ]+")
SPACE = re.compile(rb"[\t-\r ]")


class Summary(NamedTuple):
    words: int
    opens: bool  # the first byte is inside a word
    closes: bool  # the last byte is inside a word


def summary(chunk: bytes) -> Summary:
    """Of a chunk with at least one byte."""
    return Summary(len(chunk.split()), not chunk[:1].isspace(), not chunk[-1:].isspace())


def combined(a: Summary, b: Summary) -> Summary:
    """Of two neighbours: a word that goes over the border counts once."""
    return Summary(a.words + b.words - (a.closes and b.opens), a.opens, b.closes)


class Summaries(Cached):
    """Summaries by the content of chunks."""

    longest = LONGEST_KEPT

    def found(self, chunk: bytes) -> Summary:
        return summary(chunk)


@lru_cache(maxsize=1)
def _summaries() -> Summaries:
    """One cache for each worker process."""
    return Summaries(CACHE_CHUNKS)


@lru_cache(maxsize=1)
def _byte_hashes() -> np.ndarray:
    return np.array([unpack("<I", hashlib.sha256(bytes([b])).digest()[:4])[0] for b in range(256)], "<u4")


def chunk_ends(text: bytes, bits: int = CHUNK_BITS) -> list[int]:
    """Where chunks end: after each byte at which the hash of the last WINDOW bytes has ``bits`` leading zeros, and
    at the end of the text. A chunk so depends on its own bytes and the WINDOW before it only."""
    ends: list[int] = []
    for start in range(0, len(text), PART_BYTES):
        before = min(start, WINDOW - 1)
        rolled = _byte_hashes()[np.frombuffer(text, "u1", min(PART_BYTES, len(text) - start) + before, start - before)]
        width = 1
        while width < WINDOW:  # the sum over twice as many bytes, older ones shifted out to the left
            rolled[width:] += rolled[:-width] << np.uint32(width)
            width *= 2
        ends += (np.flatnonzero(rolled[before:] >> np.uint32(32 - bits) == 0) + (start + 1)).tolist()
    if text and (not ends or ends[-1] < len(text)):
        ends.append(len(text))
    return ends


class Units:
    """The units of one text."""

    def __init__(self, text: bytes, summaries: dict[bytes, Summary], bits: int = CHUNK_BITS):
        self.text, self.ends, self.words = text, chunk_ends(text, bits), []
        start, whole = 0, None
        for end in self.ends:
            found = summaries[text[start:end]]
            whole = combined(whole, found) if whole else found
            self.words.append(whole.words)  # words that begin in this chunk or before it
            start = end
        self.n = whole.words + (not whole.closes) if whole else 0

    def end_of(self, k: int) -> int:
        """The byte after the first ``k`` units."""
        if k <= 0:
            return 0
        if k >= self.n:
            return len(self.text)
        at = int(np.searchsorted(self.words, k))  # the chunk in which word k begins
        start = self.ends[at - 1] if at else 0
        carried = at > 0 and not self.text[start - 1 : start].isspace() and not self.text[start : start + 1].isspace()
        nth = k - (self.words[at - 1] if at else 0) - 1 + carried
        first = next(islice(WORD.finditer(self.text, start, self.ends[at]), nth, None)).start()
        last = SPACE.search(self.text, first)
        return last.start() if last else len(self.text)


def _chars(text: bytes) -> int:
    """Code points: bytes that do not continue one."""
    return int(np.count_nonzero(np.frombuffer(text, "i1") >= -64))


def fill_in_middle(
    docs: DataFrame, seed: int = 42, percent: int = 50, suffix_first: int = 80, marks: Sequence[str] = MARKS,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """One row per document: doc_id, n (units), form (plain, psm or spm), prefix_chars, middle_chars, output.

    The cuts, the form and whether a text stays plain follow from the SHA-256 of ``seed``, a colon and the decimal
    doc_id (nothing for a null id), so a repeated run gives the same rows. ``percent`` of the texts are cut, of
    these ``suffix_first`` percent have the suffix first (spm). Null texts are empty; empty texts and those that
    hold a mark stay plain, with null prefix_chars and middle_chars. Repeated rows give a row each, an empty table
    none; other columns are ignored. ``marks`` name prefix, suffix and middle, each beginning with a character
    that occurs nowhere else in a mark.
    """
    first, second, third = marks
    if len({m[:1] for m in marks}) != 1 or any(not m[1:] or m[0] in m[1:] for m in marks) or len(set(marks)) < 3:
        raise ValueError("three different marks that begin with one character which is nowhere else in them")
    p, s, m = (mark.encode() for mark in marks)
    rows = id_and_text(docs, id_column, text_column).withColumn("text", F.col("text").cast("binary"))

    def example(doc_id: int | None, text: bytes) -> tuple:
        units = Units(text, _summaries())
        h1, h2, h3, h4 = unpack(">4I", hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()[:16])
        if not text or p in text or s in text or m in text or h3 % 100 >= percent:
            return doc_id, units.n, "plain", None, None, text
        a, b = sorted((h1 % (units.n + 1), h2 % (units.n + 1)))
        start, end = units.end_of(a), units.end_of(b)
        prefix, middle, suffix = text[:start], text[start:end], text[end:]
        if h4 % 100 < suffix_first:
            return doc_id, units.n, "spm", _chars(prefix), _chars(middle), s + suffix + p + prefix + m + middle
        return doc_id, units.n, "psm", _chars(prefix), _chars(middle), p + prefix + s + suffix + m + middle

    names = ("doc_id", "n", "form", "prefix_chars", "middle_chars", "output")
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary())

    def run(batches):
        for ids, texts in columns(batches, "doc_id", "text"):
            found = [example(i, t) for i, t in zip(ids, texts)]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found) if found else [()] * 6, kinds)], names=names)

    kind = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output binary"
    return rows.mapInArrow(run, kind).withColumn("output", F.col("output").cast("string"))


def restored(output: Column, form: Column, marks: Sequence[str] = MARKS) -> Column:
    """The text that an example was made of, read from the example alone."""
    parts = F.split(output, "|".join(f"\\Q{mark}\\E" for mark in marks), -1)
    first, second, middle = (F.get(parts, F.lit(k)) for k in (1, 2, 3))
    return (
        F.when(form == "plain", output).when(form == "psm", F.concat(first, middle, second))
        .otherwise(F.concat(second, middle, first))
    )
