import random

import pytest
from helpers import empty, frame

from deskmatch.llm import near


def brute(rows, size, percent):
    sets = {}
    for i, text in rows:
        words = (text or "").encode().lower().split()
        shown = {tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1))} if words else set()
        sets[i] = (shown, len(shown))
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in sets:
        for b in sets:
            common = len(sets[a][0] & sets[b][0])
            if a < b and common and 100 * common >= percent * len(sets[a][0] | sets[b][0]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: (sets[i][1], root(i)) for i in sets}


def texts(seed, n):
    rng = random.Random(seed)
    rows, base = [], []
    for i in range(n):
        if i % 4 and base:  # chains of edits, so that links reach further than pairs do
            words = list(rng.choice(base))
            for _ in range(rng.choice([0, 1, 2, 4, 9])):
                words[rng.randrange(len(words))] = f"e{rng.randrange(9999)}"
        else:
            words = [f"w{rng.randrange(500)}" for _ in range(rng.choice([3, 40, 200]))]
        base.append(words)
        rows.append((i + 1, " ".join(words)))
    return rows


@pytest.mark.parametrize("size,percent", [(3, 85), (5, 80)])
def test_components_equal_brute_force(spark, size, percent):
    rows = texts(size, 120) + [(500, None), (501, ""), (502, " \n"), (503, "One two"), (504, "ONE  two"), (505, "one")]
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in near.near_duplicates(frame(spark, rows), size, percent).collect()}
    expected = brute(rows, size, percent)
    assert found == {i: (n, c, i == c) for i, (n, c) in expected.items()}


def test_null_ids_repeats_and_empty_tables(spark):
    rows = [(1, "a b c d e f g"), (None, "a b c d e f g"), (2, "A b c d e f g"), (2, "A b c d e f g"), (None, None)]
    found = near.near_duplicates(frame(spark, rows)).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0, r["kept"]) for r in found) == [
        (0, 0, True), (0, 0, True), (1, 1, True), (2, 1, False), (2, 1, False)]
    kept = near.keep_one(frame(spark, rows + [(3, "x"), (3, "x")]))
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 0, 1, 3] and kept.columns == frame(spark, rows).columns
    assert near.near_duplicates(empty(spark)).count() == 0


def plainly(rows, size, percent):
    """Documents are (id, text); their links by brute force, the component the least id reached."""
    shown = sorted({(i, t) for i, t in rows})
    found = brute([(k, t) for k, (_, t) in enumerate(shown)], size, percent)
    least = {}
    for k, (_, root) in found.items():
        least[root] = min(least.get(root, shown[k][0]), shown[k][0])
    return {shown[k]: (n, least[root]) for k, (n, root) in found.items()}


@pytest.mark.parametrize("size,percent", [(3, 85), (5, 80)])
def test_ids_with_several_texts(spark, size, percent):
    rng = random.Random(size)
    base = texts(7, 60)
    rows = [(rng.randrange(1, 25), text) for _, text in base] + [(3, " ".join(f"lang{k}" for k in range(30_000)))]
    rows += [(40, rows[-1][1] + " more"), (40, "other words of that id " * 3), (1, "same words " * 4), (5, "same words " * 4 + "x"), (5, "quite different")]
    expected = plainly(rows, size, percent)
    found = near.near_duplicates(frame(spark, rows), size, percent).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in found) == sorted(
        (i, *expected[i, t], expected[i, t][1] == i) for i, t in rows)
    kept = near.keep_one(frame(spark, rows), size, percent).collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept) == sorted((i, t) for (i, t), (_, c) in expected.items() if c == i)


def test_the_link_of_a_second_text_is_found(spark):
    text = " ".join(f"w{k}" for k in range(60))
    rows = [(1, text), (5, text + " more"), (5, "a text of its own with other words in it")]
    kept = {(r["doc_id"], r["text"]) for r in near.keep_one(frame(spark, rows)).collect()}
    assert kept == {rows[0], rows[2]}


def test_a_large_group_of_copies_is_one_component(spark):
    rows = [(i, "the same words in every copy of this text " * 3 + str(i % 2)) for i in range(1, 400)]
    assert {r["component_id"] for r in near.near_duplicates(frame(spark, rows), 3, 85).collect()} <= {1, 2}


def test_sketches_estimate_similarity():
    rng = random.Random(1)
    words = [f"w{rng.randrange(10**6)}" for _ in range(600)]
    bands, rows = near.band_shape(85)
    one = near.shingles(" ".join(words), 3)
    for edits, similar in ((8, True), (150, False)):
        other = list(words)
        for k in rng.sample(range(600), edits):
            other[k] = "edit"
        two = near.shingles(" ".join(other), 3)
        a, b = near.sketch(one, bands, rows)[1], near.sketch(two, bands, rows)[1]
        apart = sum(((x ^ y) & (2**64 - 1)).bit_count() for x, y in zip(a, b))
        assert (apart <= near.most_flips(85, bands * rows)) == similar


def test_long_chains_end_in_one_component(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 60)] + [(100, 101), (7, 7)], "a long, b long")
    found = {r["id"]: r["component"] for r in near.components(links).collect()}
    assert found == {i: 1 for i in range(1, 61)} | {100: 100, 101: 100}
