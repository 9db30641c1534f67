import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from helpers import LONG, TEXTS, empty, frame

from deskmatch.llm import bpe, counts, packing

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


def ids_of(text, path=BYTE):
    return bpe.tokenizer(path).encode(text or "", add_special_tokens=False).ids


def test_words_join_to_the_text_and_encode_alone():
    for _, text in TEXTS + [(0, "a\n b \n c   d "), (0, " x"), (0, "\n\n \n"), (0, "a  b")]:
        listed = bpe.words(text or "")
        assert "".join(listed) == (text or "")
        assert [i for word in listed for i in ids_of(word)] == ids_of(text)
        for by_rank in (False, bpe.ranks_suffice(BYTE)):
            assert bpe.WordIds(BYTE, limit=3, by_rank=by_rank).text_ids(text or "") == bpe.packed(ids_of(text))


def test_rank_encoder_only_where_it_is_the_same():
    assert bpe.ranks_suffice(BYTE) and not bpe.ranks_suffice(WORD)
    rng, words = random.Random(5), bpe.WordIds(BYTE, by_rank=True)
    for _ in range(3000):
        key = "".join(rng.choice("abcdehinorstuéß'.,#$%&*!<|>09ABTS") for _ in range(rng.randrange(1, 14)))
        assert words[key] == bpe.packed(ids_of(" " + key))


def test_whole_plain_texts_equal_the_library(monkeypatch):
    rng, whole = random.Random(6), bpe.WordIds(BYTE, by_rank=True)
    for size in (1_000_000, 7):
        monkeypatch.setattr(bpe.portions, "__defaults__", (size,))
        for _ in range(1500):
            text = "".join(rng.choice("abcd einorst  \n\t\r uéß'.,#$%&*!<|>09ABTS") for _ in range(rng.randrange(1, 60)))
            assert bpe.PLAIN_TEXT.fullmatch(text)
            assert whole.text_ids(text) == bpe.packed(ids_of(text))
            assert "".join(bpe.portions(text)) == text
    for text in ("plain <|endoftext|> text", "漢 a", "a\u00a0b \x0b c", LONG * 3):
        assert whole.text_ids(text) == bpe.packed(ids_of(text))


@pytest.mark.parametrize("block", [10, 1_000_000])
def test_encode_and_decode_round_trip(spark, block):
    rows = bpe.encode_and_decode(frame(spark), BYTE, block_chars=block).collect()
    found = sorted((r["doc_id"] or -1, r["decoded"], r["n_tokens"], bytes(r["ids"])) for r in rows)
    assert found == sorted((i or -1, t or "", len(ids_of(t)), bpe.packed(ids_of(t))) for i, t in TEXTS)
    assert all(r["ids_sha256"] == hashlib.sha256(r["ids"]).hexdigest() for r in rows)
    assert all(r["decoded_sha256"] == hashlib.sha256(r["decoded"].encode()).hexdigest() for r in rows)
    assert bpe.encode_and_decode(empty(spark), BYTE).count() == 0


def test_counts_equal_the_library(spark):
    rows = counts.count_tokens(frame(spark), WORD, limit=5, keep=4).collect()
    found = sorted((r["doc_id"] or -1, r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in rows)
    sizes = [(i or -1, len((t or "").encode()), len(ids_of(t, WORD))) for i, t in TEXTS]
    assert found == sorted((*s, s[2] > 5) for s in sizes)
    assert counts.count_tokens(empty(spark), WORD).count() == 0
    with pytest.raises(ValueError):
        counts.count_tokens(frame(spark), BYTE)


def test_frequent_words_come_from_sketches_of_all_tasks(spark):
    rows = [(i, "often often " + " ".join(f"w{i}x{k}" for k in range(30)) + (" mid" if i % 2 else "")) for i in range(200)]
    assert counts.frequent_words(frame(spark, rows).select("text").repartition(7), keep=2, offer=20) == [b"often", b"mid"]
    assert counts.frequent_words(empty(spark).select("text")) == []


def test_count_cache_stays_bounded():
    cache = counts.Counts(WORD, {b"the": 1}, limit=2)
    assert sum(map(cache.__getitem__, b"a bb ccc the dd ee".split())) == len(ids_of("a bb ccc the dd ee", WORD))
    assert len(cache) <= 4 and b"the" in cache


def check_places(rows, texts, capacity):
    """Every piece is where it says, sequences have no gaps, and pieces join to the documents."""
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"]].append(r)
    for placed in sequences.values():
        end = 0
        for offset, length in sorted(placed):
            assert offset == end
            end += length
        assert end <= capacity
    for i, text in texts:
        ids = ids_of(text) + [2]
        if Counter(i for i, _ in texts)[i] > 1:
            continue
        parts = sorted(pieces[i], key=lambda r: r["piece"])
        assert [r["piece"] for r in parts] == list(range(len(parts)))
        assert len(parts) == -(-len(ids) // capacity)
        for r in parts:
            part = ids[r["start"] : r["start"] + r["length"]]
            assert len(part) == r["length"] and zlib.crc32(np.array(part, "<u4").tobytes()) == r["ids_crc32"]
    return len(sequences)


def test_packing_places_everything(spark):
    rows = packing.pack_documents(frame(spark), BYTE, capacity=64, keep_ids=True).collect()
    n = check_places(rows, TEXTS, 64)
    total = sum(len(ids_of(t)) + 1 for _, t in TEXTS)
    assert len([r for r in rows if r["doc_id"] == 6]) == 2
    assert n == -(-total // 64)
    assert packing.pack_documents(empty(spark), BYTE).count() == 0


@pytest.mark.parametrize("sizes", ["short", "middle", "pairs"])
def test_configurations_cover_the_histogram(sizes):
    random.seed(3)
    draw = {"short": lambda: random.randint(1, 90), "middle": lambda: random.randint(20, 60), "pairs": lambda: random.choice([34, 66, 100])}
    histogram = Counter(draw[sizes]() for _ in range(3000))
    plan = packing.configurations(histogram, 100)
    used = Counter()
    for lengths, n in plan:
        assert sum(lengths) <= 100 and n > 0
        for length in lengths:
            used[length] += n
    assert used == histogram
    least = -(-sum(l * n for l, n in histogram.items()) // 100)
    alone = sum(n for _, n in packing.best_fit(dict(histogram), 100))
    assert sum(n for _, n in plan) <= max(least * 1.06, least + 2) or sum(n for _, n in plan) <= alone
    assert packing.configurations({}, 100) == []


def test_knapsack_finds_the_dearest_configuration():
    lengths, prices = np.array([3, 4, 5]), np.array([3.0, 4.5, 5.1])
    assert packing.knapsack(prices, lengths, np.array([9, 9, 9]), 8) == Counter({1: 2})


HARD = [({342: 900, 341: 900, 683: 300}, 910), ({266: 600, 276: 600, 471: 400, 501: 400, 522: 300}, 900)]


@pytest.mark.parametrize("histogram,most", HARD)
def test_program_beats_best_fit_where_best_fit_wastes(histogram, most):
    plan = packing.configurations(histogram, 1024)
    used = Counter()
    for lengths, n in plan:
        assert sum(lengths) <= 1024
        used.update({length: n * k for length, k in Counter(lengths).items()})
    assert used == histogram
    assert sum(n for _, n in plan) <= most < sum(n for _, n in packing.best_fit(dict(histogram), 1024))


def test_program_is_a_cover_with_a_true_bound():
    rng = random.Random(2)
    for histogram in [h for h, _ in HARD] + [{rng.randrange(1, 1024): rng.randrange(1, 900) for _ in range(60)} for _ in range(3)]:
        amounts, bound = packing.fractional(histogram, 1024)
        covered = Counter()
        for key, amount in amounts.items():
            assert sum(l * n for l, n in key) <= 1024
            covered.update({l: n * amount for l, n in key})
        assert all(covered[l] >= n * (1 - 1e-6) for l, n in histogram.items())
        assert bound <= sum(amounts.values()) * (1 + 1e-9) and bound <= sum(n for _, n in packing.configurations(histogram, 1024))
        assert sum(n for _, n in packing.configurations(histogram, 1024)) <= sum(n for _, n in packing.best_fit(histogram, 1024))
