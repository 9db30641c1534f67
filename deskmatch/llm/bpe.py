"""Byte-level BPE over whole texts: every distinct word is encoded once, ids come back by position.

A word here is a maximal stretch of text between two lone spaces (a space with a non-space on both
sides), with the space before it. The vocabulary's own pattern always starts a new token at such a
space, so the ids of a text are the ids of its words, one after the other.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from string import punctuation

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskmatch.llm.common import columns, id_and_text, stored

LONE_SPACE = re.compile(r"(?<=\S) (?=\S)")
#: white space before a space, the ASCII characters first
BEFORE_SPACE = [chr(c) + " " for c in range(0x3001) if chr(c).isspace()]
#: texts of one block together, in characters; one longer text is a block of its own
BLOCK_CHARS = 16_000_000
#: entries of one of the two generations of a worker's cache
CACHE_WORDS = 350_000


@lru_cache(maxsize=4)
def tokenizer(path: str):
    from tokenizers import Tokenizer

    loaded = Tokenizer.from_file(path)
    loaded.no_truncation()
    loaded.no_padding()
    return loaded


@lru_cache(maxsize=2)
def id_bytes(path: str) -> dict[int, bytes]:
    """The id-to-piece table: each id with its bytes. As many entries as the vocabulary."""
    shown = list(range(33, 127)) + list(range(161, 173)) + list(range(174, 256))
    hidden = [b for b in range(256) if b not in set(shown)]
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    added = {i: t.content.encode() for i, t in tokenizer(path).get_added_tokens_decoder().items()}
    table = {i: bytes(byte_of[c] for c in piece) for piece, i in tokenizer(path).get_vocab().items() if i not in added}
    return table | added


def packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def single_spaced(text: str) -> bool:
    """No space follows white space, begins or ends the text: a plain split then cuts at lone spaces only."""
    known = BEFORE_SPACE[:10] if text.isascii() else BEFORE_SPACE
    return text[:1] != " " and text[-1:] != " " and not any(pair in text for pair in known)


def cut(text: str) -> list[str]:
    return text.split(" ") if single_spaced(text) else LONE_SPACE.split(text)


def words(text: str) -> list[str]:
    """The words of one text; joined they are the text."""
    if not text:
        return []
    first, *rest = cut(text)
    return [first, *(" " + word for word in rest)]


#: fixed value: the byte-level pre-tokenizer's pattern
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: characters on which all regular expression libraries agree about it
PLAIN = re.compile("[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f]*")
#: words of such characters, with lone line breaks between them
PLAIN_LINES = re.compile(rf"(?:{PLAIN.pattern[:-1]}+(?:\n{PLAIN.pattern[:-1]}+)*)?")


@lru_cache(maxsize=4)
def ranks_suffice(path: str) -> bool:
    """Whether merging the pair of lowest id first gives the ids of the file, so that a rank encoder may stand in.

    It does if the file cuts by PATTERN without a normalizer, ids of merged pieces grow in the order of the
    merges, and every piece of the vocabulary encodes to itself: then, by induction over the ids, a piece is
    only ever made of the pair of its merge.
    """
    with open(path, encoding="utf-8") as file:
        known = json.load(file)
    cut_by, model = known.get("pre_tokenizer") or {}, known["model"]
    if known.get("normalizer") or cut_by.get("type") != "ByteLevel" or not cut_by.get("use_regex", True) or cut_by.get("add_prefix_space"):
        return False
    vocabulary = model["vocab"]
    merged = [vocabulary.get("".join(m.split(" ") if isinstance(m, str) else m)) for m in model["merges"]]
    single = [i for piece, i in vocabulary.items() if len(piece) == 1]
    if None in merged or any(a >= b for a, b in zip(merged, merged[1:])) or max(single) >= min(merged):
        return False
    added = tokenizer(path).get_added_tokens_decoder()
    encode = tokenizer(path).model.tokenize
    return all(i in added or [t.id for t in encode(piece)] == [i] for piece, i in vocabulary.items())

#: texts of such characters and of white space that all libraries know
PLAIN_TEXT = re.compile(f"[\t\n\r {PLAIN.pattern[1:]}")


def portions(text: str, size: int = 1_000_000) -> Iterator[str]:
    """A text in parts of about ``size`` characters, cut before lone spaces; joined they are the text."""
    start = 0
    while len(text) - start > size:
        found = LONE_SPACE.search(text, start + size)
        if not found:
            break
        yield text[start : found.start()]
        start = found.start()
    yield text[start:]


class Cached(dict):
    """Answers of ``found`` by short key. A full cache becomes the older generation, from which keys that
    are met again are taken over, so frequent ones stay."""

    longest = 64

    def __init__(self, limit: int):
        super().__init__()
        self.limit, self.older = limit, {}

    def found(self, key):
        raise NotImplementedError

    def __missing__(self, key):
        answer = self.older.get(key)
        if answer is None:
            answer = self.found(key)
        if len(key) <= self.longest:
            if len(self) >= self.limit:
                self.older = dict(self)
                self.clear()
            self[key] = answer
        return answer


class LineStarts(Cached):
    """Ids of a line break and the word after it."""

    def __init__(self, owner: WordIds, limit: int):
        super().__init__(limit)
        self.owner = owner

    def found(self, key: str) -> bytes:
        return packed(self.owner.ranks.encode_ordinary("\n" + key))


class WordIds(Cached):
    """Ids of `" " + key` as bytes, filled on demand. With ``by_rank``, the answer of :func:`ranks_suffice`,
    words of plain characters go through a rank encoder, which is faster. A new word is put together from
    cached parts where the pattern always cuts: before closing marks and at a line break between two words."""

    def __init__(self, path: str, limit: int = CACHE_WORDS, by_rank: bool = False):
        super().__init__(limit)
        self.tokenizer, self.ranks = tokenizer(path), None
        added = self.tokenizer.get_added_tokens_decoder()
        self.special = re.compile("|".join(re.escape(t.content) for t in added.values()) or r"(?!)")
        if by_rank:
            import tiktoken

            ranks = {piece: i for i, piece in id_bytes(path).items() if i not in added}
            self.ranks = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
            self.after_line, self.marks = LineStarts(self, limit // 8), lru_cache(4096)(self.bare)

    def encoded(self, word: str) -> bytes:
        return packed(self.tokenizer.encode(word, add_special_tokens=False).ids)

    def bare(self, marks: str) -> bytes:
        return packed(self.ranks.encode_ordinary(marks))

    def found(self, key: str) -> bytes:
        if self.ranks is None or not PLAIN_LINES.fullmatch(key) or self.special.search(key):
            return self.encoded(" " + key)
        if "\n" in key:
            first, *lines = key.split("\n")
            return self[first] + b"".join(map(self.after_line.__getitem__, lines))
        word = key.rstrip(punctuation)
        if word and len(word) < len(key):
            return self[word] + self.marks(key[len(word):])
        return packed(self.ranks.encode_ordinary(" " + key))

    def text_ids(self, text: str) -> bytes:
        """All ids of a text."""
        if not text:
            return b""
        if self.ranks is not None and PLAIN_TEXT.fullmatch(text) and not self.special.search(text):
            return b"".join(np.array(self.ranks.encode_ordinary(part), "<u4").tobytes() for part in portions(text))
        first, *rest = cut(text)
        return self.encoded(first) + b"".join(map(self.__getitem__, rest))


@lru_cache(maxsize=2)
def worker_cache(path: str, by_rank: bool) -> WordIds:
    """One cache for each worker process, kept over its tasks."""
    return WordIds(path, by_rank=by_rank)


# --- encoding and decoding by a distinct-word table -------------------------------------------------------------------


def _blocks(batches: Iterable[pa.RecordBatch], block_chars: int) -> Iterator[tuple[int, dict[str, int], list]]:
    """(block number, word -> code, [(doc_id, codes)]) of the documents of this task, in order."""
    number = TaskContext.get().partitionId() << 32
    codes: dict[str, int] = {}
    docs: list = []
    size = 0
    for ids, texts in columns(batches, "doc_id", "text"):
        for doc_id, text in zip(ids, texts):
            docs.append((doc_id, [codes.setdefault(word, len(codes)) for word in words(text)]))
            size += len(text)
            if size >= block_chars:
                yield number, codes, docs
                number, codes, docs, size = number + 1, {}, [], 0
    if docs:
        yield number, codes, docs


def _bucket_lists(codes: dict[str, int], buckets: int) -> tuple[np.ndarray, list[list[bytes]]]:
    """The bucket of every code, and the words of each bucket in the order of their codes."""
    raw = [word.encode() for word in codes]
    bucket_of = np.fromiter((zlib.crc32(word) % buckets for word in raw), "<u2", len(raw))
    listed: list[list[bytes]] = [[] for _ in range(buckets)]
    for bucket, word in zip(bucket_of.tolist(), raw):
        listed[bucket].append(word)
    return bucket_of, listed


def _squeezed(parts: list[bytes]) -> bytes:
    """Byte strings and their lengths in one compressed value."""
    sizes = np.fromiter(map(len, parts), "<u4", len(parts))
    return zlib.compress(np.ascontiguousarray(sizes.view("u1").reshape(-1, 4).T).tobytes() + b"".join(parts), 1)


def _parts(squeezed: bytes, n: int) -> list[bytes]:
    raw = zlib.decompress(squeezed)
    sizes = np.ascontiguousarray(np.frombuffer(raw, "u1", 4 * n).reshape(4, n).T).view("<u4").ravel()
    ends = (4 * n + np.cumsum(sizes, dtype="i8")).tolist()
    return [raw[start:end] for start, end in zip([4 * n, *ends], ends)]


def block_words(docs: DataFrame, buckets: int, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(bucket, block, n, words): the distinct words of every block, one row for each bucket of words."""

    def run(batches):
        for number, codes, _ in _blocks(batches, block_chars):
            held = [(k, words) for k, words in enumerate(_bucket_lists(codes, buckets)[1]) if words]
            yield pa.RecordBatch.from_pydict({
                "bucket": pa.array([k for k, _ in held], pa.int32()), "block": pa.array([number] * len(held), pa.int64()),
                "n": pa.array([len(words) for _, words in held], pa.int32()),
                "words": pa.array([_squeezed(words) for _, words in held], pa.binary()),
            })

    return docs.mapInArrow(run, "bucket int, block long, n int, words binary")


def block_codes(docs: DataFrame, buckets: int, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per block: its documents, the number of words of each, the codes of the words in order, the
    bucket of each code, and a checksum of the words of each bucket."""

    def run(batches):
        for number, codes, members in _blocks(batches, block_chars):
            bucket_of, listed = _bucket_lists(codes, buckets)
            used = np.concatenate([np.asarray(c, dtype="<u4") for _, c in members])
            planes = np.ascontiguousarray(used.view("u1").reshape(-1, 4).T).tobytes()
            yield pa.RecordBatch.from_pydict({
                "block": pa.array([number], pa.int64()),
                "doc_ids": pa.array([[i for i, _ in members]], pa.list_(pa.int64())),
                "sizes": pa.array([[len(c) for _, c in members]], pa.list_(pa.int64())),
                "codes": pa.array([zlib.compress(planes, 1)], pa.binary()),
                "bucket_of": pa.array([zlib.compress(bucket_of.tobytes(), 1)], pa.binary()),
                "checks": pa.array([[zlib.crc32(b"\x00".join(words)) for words in listed if words]], pa.list_(pa.int64())),
            })

    return docs.mapInArrow(
        run, "block long, doc_ids array<long>, sizes array<long>, codes binary, bucket_of binary, checks array<long>"
    )


def encoded_words(listed: DataFrame, path: str, limit: int = CACHE_WORDS) -> DataFrame:
    """(block, bucket, n, ids, used, check): a bucket is one part of the distinct-word table; all its words meet in
    one task, which encodes each distinct one once (a bucket of over ``limit`` words repeats some). ``used`` are the
    distinct ids."""

    def run(batches):
        encode = tokenizer(path).encode
        last, table = None, {}
        for batch in batches:
            for bucket, block, n, squeezed in zip(*(c.to_pylist() for c in batch.columns)):
                if bucket != last or len(table) > limit:
                    last, table = bucket, {}
                words = _parts(squeezed, n)
                for word in words:
                    if word not in table:
                        table[word] = np.asarray(encode(word.decode(), add_special_tokens=False).ids, "<u2" if small else "<u4").tobytes()
                ids = [table[word] for word in words]
                used = np.unique(np.frombuffer(b"".join(ids), "<u2" if small else "<u4"))
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array([block], pa.int64()), "bucket": pa.array([bucket], pa.int32()), "n": pa.array([n], pa.int32()),
                    "ids": pa.array([_squeezed(ids)], pa.binary()), "used": pa.array([used.astype("i4")], pa.list_(pa.int32())),
                    "check": pa.array([zlib.crc32(b"\x00".join(words))], pa.int64()),
                })

    small = tokenizer(path).get_vocab_size() <= 1 << 16
    dealt = listed.select("bucket", "block", "n", "words").repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(run, "block long, bucket int, n int, ids binary, used array<int>, check long")


def block_pieces(listed: DataFrame, path: str) -> DataFrame:
    """(block, pieces): the bytes of all ids that occur in a block, by a join of its ids with the id-to-piece table."""
    table = listed.sparkSession.createDataFrame(list(id_bytes(path).items()), "id int, piece binary")
    ids = listed.select("block", F.explode("used").alias("id")).distinct()
    # as many rows as the vocabulary has, so are the pieces of a block at most
    found = ids.join(F.broadcast(table), "id")
    return found.groupBy("block").agg(F.collect_list(F.struct("id", "piece")).alias("pieces"))


def encode_and_decode(
    docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text", block_chars: int = BLOCK_CHARS,
    keep_ids: bool = True,
) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids (binary, unsigned 32-bit little-endian), decoded text, two digests.

    ``path`` is a tokenizers file of a byte-level BPE. A null text is empty: no ids, empty decoded text.
    Repeated rows and null ids give one row each. An empty table gives no rows. Other columns are ignored.
    With ``keep_ids=False`` ids and decoded text are left out and only their digests stay.

    ``docs`` is read twice and has to give the same rows in the same partitions both times, as a stored
    table does; each block carries checksums of its words, and a difference ends the job with an error.
    """
    docs = id_and_text(docs, id_column, text_column)
    # buckets of the distinct-word table: one or more per task of a shuffle
    buckets = min(60_000, max(64, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    listed = stored(encoded_words(block_words(docs, buckets, block_chars), path), "word-ids")
    # the words of one block are bounded by the text of one block
    entries = listed.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("bucket", "n", "ids", "check"))).alias("entries"))
    # a block without any word keeps its documents
    known = entries.join(block_pieces(listed, path), "block")
    joined = block_codes(docs, buckets, block_chars).join(known, "block", "left").select(
        "doc_ids", "sizes", "codes", "bucket_of", "checks", "entries", "pieces")
    small = tokenizer(path).get_vocab_size() <= 1 << 16

    def run(batches):
        for batch in batches:
            for at_row in range(batch.num_rows):
                doc_ids, sizes, codes, bucket_of, checks, entries, joined_pieces = (c[at_row].as_py() for c in batch.columns)
                pieces = {p["id"]: p["piece"] for p in joined_pieces or ()}
                if checks != [e["check"] for e in entries or ()]:
                    raise RuntimeError("documents changed between two reads; store them first")
                # back by position: words of a bucket are in the order of their codes
                order = np.argsort(np.frombuffer(zlib.decompress(bucket_of), "<u2"), kind="stable")
                ids = np.empty(len(order), object)
                ids[order] = [i for e in entries or () for i in _parts(e["ids"], e["n"])]
                planes = np.frombuffer(zlib.decompress(codes), "u1").reshape(4, -1)
                used = ids[np.ascontiguousarray(planes.T).view("<u4").ravel()].tolist()
                out: dict[str, list] = {name: [] for name in ("doc_id", "n_tokens", "ids", "decoded", "ids_sha256", "decoded_sha256")}
                size = at = 0
                for doc_id, n in zip(doc_ids, sizes):
                    listed = np.frombuffer(b"".join(used[at : at + n]), "<u2" if small else "<u4").astype("<u4")
                    found = listed.tobytes()
                    text = b"".join(map(pieces.__getitem__, listed.tolist())).decode("utf-8", "replace")
                    at += n
                    size += len(found) + len(text)
                    for name, value in zip(out, (
                        doc_id, len(listed), found if keep_ids else b"", text if keep_ids else "",
                        hashlib.sha256(found).hexdigest(), hashlib.sha256(text.encode()).hexdigest(),
                    )):
                        out[name].append(value)
                    if size > 32_000_000:
                        yield _rows(out)
                        out, size = {name: [] for name in out}, 0
                yield _rows(out)

    found = joined.mapInArrow(
        run, "doc_id long, n_tokens long, ids binary, decoded string, ids_sha256 string, decoded_sha256 string"
    )
    return found if keep_ids else found.drop("ids", "decoded")


def _rows(out: dict[str, list]) -> pa.RecordBatch:
    kinds = {"doc_id": pa.int64(), "n_tokens": pa.int64(), "ids": pa.binary()}
    return pa.RecordBatch.from_pydict({k: pa.array(v, kinds.get(k, pa.string())) for k, v in out.items()})
