"""Token ids as binary files that are read document by document.

A file is a row of independent zstandard frames with the ids of consecutive documents, a skippable frame that
lists the documents, and the seek table of the seekable zstandard format: for each frame its two sizes and the
low half of the XXH64 of its content. Any zstandard reader gets the plain ids from it. A reader of single
documents reads the end of the file, then only the frames that hold the ids it wants, and checks each.

Tasks write files under names of their own and report them; only files of finished tasks get into the
manifest, a table that Spark commits as a whole. What lost or repeated tasks leave behind is never read.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from deskmatch.llm.bpe import tokenizer
from deskmatch.llm.common import columns, id_and_text, stored
from deskmatch.llm.word_bpe import drops_spaces, ranks_suffice, worker_words
from deskmatch.operators.scale import scratch_folder

#: fixed values of the seekable zstandard format
SKIPPABLE, SEEK_FRAME, SEEKABLE, WITH_CHECKSUMS = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1, 0x80
FOOTER = struct.Struct("<IBI")
#: of the frame that lists the documents: magic, size, bytes of an id, documents
LISTED = struct.Struct("<IIBI")
#: a frame ends with the document that fills it, and inside a document when it holds so many ids
FRAME_IDS, LONGEST_FRAME_IDS = 65_536, 262_144
#: a task begins another file when one holds so many ids
FILE_IDS = 64_000_000
LEVEL = 1

MANIFEST = "part int, nth int, name string, documents long, ids long, bytes long"


@lru_cache(maxsize=8)
def _store(folder: str):
    """File system and path of a folder that all executors share: a plain path or an address pyarrow knows."""
    from pyarrow import fs

    address = folder.replace("s3a://", "s3://", 1)
    if address.startswith("file:"):  # with one or three slashes
        address = "/" + address.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(address)


class TokenFile:
    """Writes one file. Ids of a document come as bytes of unsigned integers of ``width`` bytes each."""

    def __init__(self, folder: str, part: int, nth: int, width: int):
        import xxhash
        import zstandard

        system, path = _store(folder)
        system.create_dir(path, recursive=True)
        self.part, self.nth, self.width, self.name = part, nth, width, f"{part:06d}-{nth:04d}-{uuid.uuid4().hex}.ids.zst"
        self.out = system.open_output_stream(f"{path}/{self.name}", compression=None)
        # the digest of the seek table is the checksum
        self.compress, self.digest = zstandard.ZstdCompressor(level=LEVEL, write_checksum=False).compress, xxhash.xxh64_intdigest
        self.frames: list[tuple[int, int, int]] = []
        self.doc_ids: list[int | None] = []
        self.sizes: list[int] = []
        self.held: list[bytes] = []
        self.held_bytes = self.ids = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.doc_ids.append(doc_id)
        self.sizes.append(len(ids) // self.width)
        self.ids += len(ids) // self.width
        most = LONGEST_FRAME_IDS * self.width
        while self.held_bytes + len(ids) > most:
            taken = most - self.held_bytes
            self.held.append(ids[:taken])
            self.held_bytes, ids = most, ids[taken:]
            self._end_frame()
        self.held.append(ids)
        self.held_bytes += len(ids)
        if self.held_bytes >= FRAME_IDS * self.width:
            self._end_frame()

    def _end_frame(self) -> None:
        if self.held_bytes:
            content = b"".join(self.held)
            frame = self.compress(content)
            self.out.write(frame)
            self.frames.append((len(frame), len(content), self.digest(content) & 0xFFFFFFFF))
        self.held, self.held_bytes = [], 0

    def close(self) -> dict:
        """Ends the file and gives its row of the manifest."""
        self._end_frame()
        known = np.array([i is not None for i in self.doc_ids], "u1")
        listed = zlib.compress(b"".join([
            np.array([i or 0 for i in self.doc_ids], "<i8").tobytes(), np.array(self.sizes, "<u8").tobytes(), known.tobytes()]), 1)
        self.out.write(LISTED.pack(SKIPPABLE, len(listed) + LISTED.size - 8, self.width, len(self.doc_ids)) + listed)
        table = b"".join(struct.pack("<III", *frame) for frame in self.frames) + FOOTER.pack(len(self.frames), WITH_CHECKSUMS, SEEKABLE)
        self.out.write(struct.pack("<II", SEEK_FRAME, len(table)) + table)
        size = self.out.tell()
        self.out.close()
        return {"part": self.part, "nth": self.nth, "name": self.name, "documents": len(self.doc_ids), "ids": self.ids, "bytes": size}


class TokenReader:
    """Reads one file: the list of its documents at once, ids only from the frames that hold them."""

    def __init__(self, folder: str, name: str, size: int):
        import xxhash
        import zstandard

        system, path = _store(folder)
        self.name, self.source = name, system.open_input_file(f"{path}/{name}")
        self.decompress, self.digest = zstandard.ZstdDecompressor().decompress, xxhash.xxh64_intdigest
        frames, descriptor, magic = FOOTER.unpack(self._read(size - FOOTER.size, FOOTER.size))
        if magic != SEEKABLE or descriptor != WITH_CHECKSUMS:
            raise ValueError(f"{name}: no seek table with checksums")
        table = np.frombuffer(self._read(size - FOOTER.size - 12 * frames, 12 * frames), "<u4").reshape(frames, 3)
        self.checks = table[:, 2].tolist()
        self.at = np.concatenate([[0], np.cumsum(table[:, 0], dtype="i8")])
        self.holds = np.concatenate([[0], np.cumsum(table[:, 1], dtype="i8")])
        start = int(self.at[-1])
        magic, length, self.width, documents = LISTED.unpack(self._read(start, LISTED.size))
        if magic != SKIPPABLE:
            raise ValueError(f"{name}: no list of documents")
        listed = zlib.decompress(self._read(start + LISTED.size, length + 8 - LISTED.size))
        ids, sizes = np.frombuffer(listed, "<i8", 2 * documents).reshape(2, documents)
        known = np.frombuffer(listed, "u1", documents, 16 * documents)
        self.doc_ids = [i if k else None for i, k in zip(ids.tolist(), known.tolist())]
        self.sizes = sizes
        self.starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        self.frame, self.content, self.frames_read = -1, b"", 0

    def _read(self, start: int, size: int) -> bytes:
        self.source.seek(start)
        return self.source.read(size)

    def _frame(self, k: int) -> bytes:
        if k != self.frame:
            content = self.decompress(self._read(int(self.at[k]), int(self.at[k + 1] - self.at[k])))
            if self.digest(content) & 0xFFFFFFFF != self.checks[k] or len(content) != self.holds[k + 1] - self.holds[k]:
                raise ValueError(f"{self.name}: frame {k} is damaged")
            self.frame, self.content, self.frames_read = k, content, self.frames_read + 1
        return self.content

    def ids(self, start: int, size: int) -> np.ndarray:
        """``size`` ids from position ``start`` of the file."""
        first, end = start * self.width, (start + size) * self.width
        parts, k = [], int(np.searchsorted(self.holds, first, side="right")) - 1
        while first < end:
            base, until = int(self.holds[k]), min(end, int(self.holds[k + 1]))
            parts.append(self._frame(k)[first - base : until - base])
            first, k = until, k + 1
        return np.frombuffer(b"".join(parts), "<u2" if self.width == 2 else "<u4").astype("<u4")

    def close(self) -> None:
        self.source.close()


def _encoder(path: str, end_id: int):
    """Function from a text to the bytes of its ids and the end id, and the bytes of one id."""
    by_word, by_rank = drops_spaces(path), drops_spaces(path) and ranks_suffice(path)
    small = max(end_id + 1, tokenizer(path).get_vocab_size()) <= 1 << 16
    code = "<u2" if small else "<u4"

    def make():
        end = np.array([end_id], code).tobytes()
        if by_word and worker_words(path, by_rank).code == ("H" if small else "I"):
            ids_of = worker_words(path, by_rank).text_ids
            return lambda text: ids_of(text.encode()) + end
        encode = tokenizer(path).encode
        return lambda text: np.array(encode(text, add_special_tokens=False).ids, code).tobytes() + end

    return make, 2 if small else 4


def write_token_files(
    docs: DataFrame, path: str, folder: str | None = None, end_id: int = 2, id_column: str = "doc_id",
    text_column: str = "text", file_ids: int = FILE_IDS,
) -> tuple[str, DataFrame]:
    """Folder and manifest of the token files of all documents, in ascending order of doc_id.

    ``path`` is a tokenizers file; ``end_id`` follows the ids of every document. A null text is empty. Null ids come
    first; rows of one id keep the order in which they are stored, and may lie in several files. An empty table
    gives an empty manifest. Other columns are ignored. ``folder`` has to be shared by all executors; by default it
    is a new one below the folder that ``spark.checkpoint.dir`` names. The manifest has one row per file: part and
    nth, its place in the order; name; documents; ids; bytes; start, the ids of all files before it.
    """
    spark = docs.sparkSession
    folder = folder or scratch_folder(spark, "token-files")
    make, width = _encoder(path, end_id)
    # a second key, so that rows of one id can be dealt over several tasks
    rows = id_and_text(docs, id_column, text_column).withColumn("_row", F.monotonically_increasing_id())
    ordered = rows.repartitionByRange("doc_id", "_row").sortWithinPartitions("doc_id", "_row").select("doc_id", "text")

    def run(batches):
        encode, part, nth, file = make(), TaskContext.get().partitionId(), 0, None
        for ids, texts in columns(batches, "doc_id", "text"):
            for doc_id, text in zip(ids, texts):
                file = file or TokenFile(folder, part, nth, width)
                file.add(doc_id, encode(text))
                if file.ids >= file_ids:
                    yield pa.RecordBatch.from_pylist([file.close()], _schema())
                    file, nth = None, nth + 1
        if file:
            yield pa.RecordBatch.from_pylist([file.close()], _schema())

    files = stored(ordered.mapInArrow(run, MANIFEST), "token-manifest")
    # one row per file
    before = Window.orderBy("part", "nth").rowsBetween(Window.unboundedPreceding, -1)
    return folder, files.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0)))


def _schema() -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}
    return pa.schema([(name, kinds[kind]) for name, kind in (column.split() for column in MANIFEST.split(", "))])


def _spread(files: DataFrame) -> DataFrame:
    """One task for each file, near enough."""
    return files.repartitionByRange(max(1, files.count()), "part", "nth")


READ = "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary"


def _found(reader: TokenReader, base: int, docs: Iterator[tuple[int | None, int, int]], keep_ids: bool) -> Iterator[pa.RecordBatch]:
    rows, size = [], 0
    for doc_id, start, n in docs:
        raw = reader.ids(start, n).tobytes()
        rows.append((doc_id, base + start, n, zlib.crc32(raw), raw if keep_ids else None))
        size += len(raw) if keep_ids else 64
        if size > 16_000_000:
            yield _batch(rows)
            rows, size = [], 0
    if rows:
        yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "binary": pa.binary()}
    names, types = zip(*(column.split() for column in READ.split(", ")))
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, k in zip(zip(*rows), types)], names=names)


def read_documents(folder: str, manifest: DataFrame, keep_ids: bool = True) -> DataFrame:
    """One row per document of all files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32 and
    with ``keep_ids`` its ids, all as unsigned 32-bit little-endian integers, the end id included."""

    def run(batches):
        for names, sizes, starts in columns(batches, "name", "bytes", "start"):
            for name, size, base in zip(names, sizes, starts):
                reader = TokenReader(folder, name, size)
                yield from _found(reader, base, zip(reader.doc_ids, reader.starts.tolist(), reader.sizes.tolist()), keep_ids)
                reader.close()

    found = _spread(manifest).mapInArrow(run, READ)
    return found if keep_ids else found.drop("ids")


def directory(folder: str, manifest: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, at, name, bytes, start) of all documents from the lists of the files; no frame is read.
    ``at`` is a document's place in its file, ``start`` that of the file."""

    def run(batches):
        for names, sizes, starts in columns(batches, "name", "bytes", "start"):
            for name, size, base in zip(names, sizes, starts):
                reader = TokenReader(folder, name, size)
                n = len(reader.doc_ids)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(reader.doc_ids, pa.int64()), "n_tokens": pa.array(reader.sizes, pa.int64()),
                    "at": pa.array(reader.starts, pa.int64()), "name": pa.array([name] * n, pa.string()),
                    "bytes": pa.array([size] * n, pa.int64()), "start": pa.array([base] * n, pa.int64()),
                })
                reader.close()

    return _spread(manifest).mapInArrow(run, "doc_id long, n_tokens long, at long, name string, bytes long, start long")


def read_some(folder: str, manifest: DataFrame, wanted: DataFrame, keep_ids: bool = True) -> DataFrame:
    """As :func:`read_documents`, for the documents whose doc_id occurs in ``wanted`` only. Each asked frame is
    read once per task; frames without a wanted document are not read. Null and unknown ids find nothing."""
    asked = directory(folder, manifest).join(wanted.select("doc_id").distinct(), "doc_id", "left_semi")
    # a file with very many wanted documents is read by several tasks
    dealt = asked.repartitionByRange("name", "at").sortWithinPartitions("name", "at")

    def run(batches):
        reader = None
        for rows in columns(batches, "doc_id", "n_tokens", "at", "name", "bytes", "start"):
            for doc_id, n, at, name, size, base in zip(*rows):
                if reader is None or reader.name != name:
                    if reader:
                        reader.close()
                    reader = TokenReader(folder, name, size)
                yield from _found(reader, base, [(doc_id, at, n)], keep_ids)

    found = dealt.mapInArrow(run, READ)
    return found if keep_ids else found.drop("ids")
