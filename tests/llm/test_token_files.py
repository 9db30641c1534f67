import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
import zstandard
from helpers import LONG, TEXTS, empty, frame

from deskmatch.llm import token_files, word_bpe
from deskmatch.llm.bpe import tokenizer

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")


def expected(rows, path=WORD, end_id=2):
    """Every document with the ids before it, plainly."""
    found, start = [], 0
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*tokenizer(path).encode(text or "", add_special_tokens=False).ids, end_id]
        found.append((i, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)), struct.pack(f"<{len(ids)}I", *ids)))
        start += len(ids)
    return found


def plain(rows):
    return sorted(((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"], bytes(r["ids"])) for r in rows), key=lambda r: r[1])


def test_rank_encoder_gives_the_librarys_ids():
    assert word_bpe.drops_spaces(WORD) and word_bpe.ranks_suffice(WORD)
    assert not word_bpe.drops_spaces(BYTE) and not word_bpe.ranks_suffice(BYTE)
    rng, fast, slow = random.Random(3), word_bpe.LowerWords(WORD, limit=50, by_rank=True), word_bpe.LowerWords(WORD)
    for _ in range(5000):
        word = "".join(rng.choice("abcdehinorstuéßÀÇŸĲĳŁſŉİ'.,#$%<|>09ABTSLMVREe\u0301漢Σ") for _ in range(rng.randrange(1, 14)))
        assert fast[word.encode()] == slow[word.encode()], word
    for _, text in [*TEXTS, (0, "it's <|endoftext|>x don't! 12'll")]:
        ids = np.frombuffer(fast.text_ids((text or "").encode()), "<u2").tolist()
        assert ids == tokenizer(WORD).encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_files_give_back_every_document(spark, path):
    folder, manifest = token_files.write_token_files(frame(spark), path, file_ids=200)
    assert plain(token_files.read_documents(folder, manifest).collect()) == expected(TEXTS, path)
    assert sum(r["ids"] for r in manifest.collect()) == sum(n for _, _, n, _, _ in expected(TEXTS, path))


def test_only_asked_frames_are_read(spark, monkeypatch, tmp_path):
    rows = [(i, f"word{i} " * (i % 40)) for i in range(300)]
    folder, manifest = token_files.write_token_files(frame(spark, rows), WORD, folder=str(tmp_path / "own"))
    wanted = spark.createDataFrame([(7,), (299,), (7,), (None,), (5000,)], "doc_id long")
    assert plain(token_files.read_some(folder, manifest, wanted).collect()) == [e for e in expected(rows) if e[0] in (7, 299)]
    monkeypatch.setattr(token_files, "FRAME_IDS", 100)
    monkeypatch.setattr(token_files, "LONGEST_FRAME_IDS", 150)
    file = token_files.TokenFile(str(tmp_path), 0, 0, 2)
    docs = {i: np.arange(i, i + 37 * (i % 9), dtype="<u2") for i in range(60)}
    for i, ids in docs.items():
        file.add(i, ids.tobytes())
    row = file.close()
    reader = token_files.TokenReader(str(tmp_path), row["name"], row["bytes"])
    assert len(reader.checks) > 20 and reader.doc_ids == list(docs)
    assert reader.ids(int(reader.starts[44]), len(docs[44])).tolist() == docs[44].tolist() and reader.frames_read <= 3
    raw = (tmp_path / row["name"]).read_bytes()
    content = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read()
    assert content == b"".join(ids.tobytes() for ids in docs.values())  # any reader gets the plain ids
    damaged = bytearray(raw)
    damaged[int(reader.at[3]) + 12] ^= 0xFF
    (tmp_path / "damaged").write_bytes(damaged)
    broken = token_files.TokenReader(str(tmp_path), "damaged", row["bytes"])
    with pytest.raises((ValueError, zstandard.ZstdError)):
        broken.ids(0, int(broken.sizes.sum()))


def test_empty_table_and_leftovers_of_lost_tasks(spark, tmp_path):
    folder, manifest = token_files.write_token_files(empty(spark), WORD)
    assert manifest.count() == 0 and token_files.read_documents(folder, manifest).count() == 0
    own = str(tmp_path / "files")
    _, manifest = token_files.write_token_files(frame(spark, [(1, "a b"), (2, LONG), (None, None)]), WORD, folder=own)
    left = token_files.TokenFile(own, 0, 0, 2)
    left.add(9, b"\x01\x00")
    left.close()  # a task that was lost after it had written
    assert {r["doc_id"] for r in token_files.read_documents(own, manifest).collect()} == {1, 2, None}


def test_one_id_in_most_rows_is_dealt_over_tasks(spark):
    rows = [(5, f"copy {i}") for i in range(900)] + [(i, "x") for i in range(100)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so small a table is one task
    try:
        _, manifest = token_files.write_token_files(frame(spark, rows).repartition(4), WORD)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert manifest.agg({"documents": "max"}).first()[0] < 700
