import hashlib
import random
import re

import pytest
from helpers import LONG, TEXTS, empty, frame
from pyspark.sql import functions as F

from deskmatch.llm import fim

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute(doc_id, text, seed=42):
    """(n, form, prefix characters, middle characters, output) of one document, plainly."""
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    if not text or any(m in text for m in fim.MARKS) or h[2] % 100 >= 50:
        return len(units), "plain", None, None, text
    a, b = sorted(h[k] % (len(units) + 1) for k in (0, 1))
    prefix, middle, suffix = ("".join(units[x:y]) for x, y in ((0, a), (a, b), (b, None)))
    if h[3] % 100 < 80:
        return len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def noise(rng, n):
    return "".join(rng.choice("ab漢é <P\t\n \r\x0b\x0c,.") for _ in range(n))


def test_examples_equal_brute_force_and_restore(spark):
    rng = random.Random(4)
    rows = TEXTS + [(i, noise(rng, rng.choice([0, 1, 2, 30, 3000]))) for i in range(20, 160)]
    rows += [(200, "has <M> inside"), (201, "   "), (202, "\n"), (203, "word"), (204, " word"), (205, "word "), (206, LONG * 9)]
    found = fim.fill_in_middle(frame(spark, rows)).withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    key = lambda r: (r[0] or -1, r[-1])
    assert sorted([(r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in found], key=key) == sorted(
        [(i, *brute(i, t)) for i, t in rows], key=key)
    assert sorted((r["doc_id"] or -1, r["back"]) for r in found) == sorted((i or -1, t or "") for i, t in rows)
    assert {r["form"] for r in found} == {"plain", "psm", "spm"}
    assert fim.fill_in_middle(empty(spark)).count() == 0


@pytest.mark.parametrize("bits", [1, 3, 6])
def test_units_are_found_whatever_the_chunks(bits):
    rng = random.Random(bits)
    for n in [0, 1, 5, 40, 400] * 30:
        text = noise(rng, n)
        units, raw = UNIT.findall(text), text.encode()
        counted = fim.Units(raw, fim.Summaries(20), bits)
        assert counted.n == len(units)
        for k in range(len(units) + 2):
            assert raw[: counted.end_of(k)].decode() == "".join(units[:k])


def test_shared_passages_share_chunks(monkeypatch):
    rng = random.Random(1)
    passage = " ".join(f"w{rng.randrange(10**6)}" for _ in range(4000)).encode()
    one, two = b"first start " + passage, b"another, longer beginning of it " + passage
    pieces = [{t[a:b] for a, b in zip([0, *ends], ends)} for t, ends in ((t, fim.chunk_ends(t)) for t in (one, two))]
    assert len(pieces[0] & pieces[1]) >= len(pieces[0]) - 2 > 10
    monkeypatch.setattr(fim, "PART_BYTES", 1000)
    assert fim.chunk_ends(one) == sorted({*fim.chunk_ends(one)}) and {one[a:b] for a, b in zip([0, *fim.chunk_ends(one)], fim.chunk_ends(one))} == pieces[0]


def test_a_chunk_counts_by_its_content():
    known = fim.Summaries(2)
    assert known[b"a b"] == (2, True, True) and known[b" a "] == (1, False, False) and known[b"  "] == (0, False, False)
    assert fim.combined(known[b"a b"], known[b"c d"]).words == 3 and len(known) <= 2


def test_marks_are_checked(spark):
    with pytest.raises(ValueError):
        fim.fill_in_middle(empty(spark), marks=("<P>", "<P>", "<M>"))
