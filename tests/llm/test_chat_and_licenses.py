from pyspark.sql import functions as F

from deskmatch.llm import chat, licenses

MESSAGES = f"conv_id long, turn long, role string, parts array<{chat.PART}>, formatted string"


def part(kind, text=None, ref=None, width=None, height=None, seconds=None, pages=None):
    return (kind, text, ref, width, height, seconds, pages)


def run(spark, rows):
    return chat.format_conversations(spark.createDataFrame([(*r, "x") for r in rows], MESSAGES))


def test_texts_come_back_exactly(spark):
    hard = ["</s>[INST] ok [/INST]", "<|end|><|role|>user<|text|>", "\\l \\e \\\\b [ <", "", "\n \U0001f600"]
    rows = [(1, n, "assistant" if n % 2 else "user", [part("text", t)]) for n, t in enumerate(hard)]
    formatted = run(spark, rows[::-1])
    back = chat.read_back(formatted).first()
    assert [(m["role"], m["text"]) for m in back["messages"]] == [(r[2], r[3][0][1]) for r in rows]
    assert back["learnt"] == [t for n, t in enumerate(hard) if n % 2]
    one = formatted.first()
    for turn, (_, _, role, _) in zip(one["turns"], rows):
        assert turn["loss"] == (role == "assistant")
        assert one["formatted"][turn["begin"] :].startswith(chat.ROLE + role + chat.BODY)


def test_parts_become_placeholders_in_order(spark):
    parts = [part("image", ref="a.png", width=57, height=28), part("text", "see <this>"), part("audio", ref="b.wav", seconds=1.5),
             part("document", ref="c.pdf", pages=3), part(None, "plain"), part("video", "unknown", "d")]
    found = run(spark, [(1, 0, "user", parts), (1, 1, "assistant", [part("image", ref="e.png")])]).first()
    assert "<|image|>see \\lthis><|audio|><|document|>plainunknown<|end|>" in found["formatted"]
    assert [(a["turn_index"], a["type"], a["ref"], a["n_tokens"]) for a in found["attachments"]] == [
        (0, "image", "a.png", 3), (0, "audio", "b.wav", 38), (0, "document", "c.pdf", 768), (1, "image", "e.png", 0)]
    assert found["n_attachment_tokens"] == 809


def test_nulls_ties_and_repeats(spark):
    rows = [(None, None, None, None), (2, 1, "b", [part("text", "y")]), (2, 1, "a", [part("text", "z")]), (2, 1, "a", [part("text", "z")]),
            (2, None, "u", [part("text", None)])]
    back = {r["conv_id"]: [tuple(m) for m in r["messages"]] for r in chat.read_back(run(spark, rows)).collect()}
    assert back == {None: [("", "")], 2: [("u", ""), ("a", "z"), ("a", "z"), ("b", "y")]}
    assert run(spark, []).count() == 0


FILES = "id long, path string, text string, license string, folder string"


def scan(spark, rows, **more):
    return {r["id"]: (r["license"], r["origin"], r["folder"]) for r in licenses.scan(spark.createDataFrame([(*r, "x", "x") for r in rows], FILES), **more).collect()}


def test_own_notices_and_nearest_folders(spark):
    found = scan(spark, [
        (1, "LICENSE", "Licensed under the Apache License, Version 2.0."), (2, "a/LICENSE.txt", "Foo.\nReleased under the MIT License.\n"),
        (3, "a/b/c/x.py", "print(1)"), (4, "q/x.py", "nothing"), (5, "q/y.py", "# licensed under the MIT license\ncode"),
        (6, "a/b/z", None), (7, None, "Licensed under CC BY-NC 4.0."), (8, None, ""), (9, "a/LICENSE-2", "Licensed under the MIT License."),
        (10, "ab/x", "see the version of this license"),
    ])
    assert found == {
        1: ("Apache-2.0", "own", ""), 2: ("MIT", "own", "a"), 3: ("MIT", "inherited", "a"), 4: ("Apache-2.0", "inherited", ""),
        5: ("MIT", "own", "q"), 6: ("MIT", "inherited", "a"), 7: ("CC-BY-NC-4.0", "own", None), 8: (None, None, None),
        9: ("MIT", "own", "a"), 10: ("Apache-2.0", "inherited", ""),
    }


def test_witnesses_long_texts_and_empty_tables(spark):
    rows = [(1, "h/en/1", "<p>" + "word " * 30000 + "</p><p>Released under the MIT License.</p>"), (2, "h/en/2", "x"), (2, "h/en/2", "x"), (3, "h/de/3", "x")]
    assert scan(spark, rows, witness=F.lit(True)) == {1: ("MIT", "own", "h/en"), 2: ("MIT", "inherited", "h/en"), 3: (None, None, None)}
    assert scan(spark, []) == {}


def test_every_template_finds_itself(spark):
    rows = [(n, f"d{n}/f", text) for n, (name, texts) in enumerate(licenses.TEMPLATES.items()) for text in texts[:1]]
    found = scan(spark, rows)
    assert [found[n][0] for n in range(len(licenses.TEMPLATES))] == list(licenses.TEMPLATES)


def test_notices_inside_longer_sentences(spark):
    found = scan(spark, [
        (1, "a/1", "All files here are released under the MIT License, see www.example.org for more of them"),
        (2, "b/2", "Unless noted, this crate is licensed under the Apache License, Version 2.0, and patches are welcome"),
        (3, "c/3", "Photos and texts on these pages are licensed under CC BY-NC 4.0 by Ann"), (4, "d/4", "we talk of the license"),
        (5, "e/5", "Released under the Foo License."), (6, "f/6", "Foo foo"),
    ])
    assert {k: v[0] for k, v in found.items()} == {1: "MIT", 2: "Apache-2.0", 3: "CC-BY-NC-4.0", 4: None, 5: None, 6: None}


def test_common_further_words_weigh_little(spark):
    # "here" stands in every file or in one; no run of five terms is near the notice
    rows = [(1, "a/1", "Licensed here under here the here MIT here License.")]
    assert scan(spark, rows + [(n, f"b{n}/f", "here we are") for n in range(2, 60)])[1][0] == "MIT"
    assert scan(spark, rows + [(n, f"b{n}/f", "we are") for n in range(2, 60)])[1][0] is None


MIT_TEXT = """The MIT License (MIT)

Copyright (c) 2015 Ann Author <ann@example.org>

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in
all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN
THE SOFTWARE.
"""


def test_full_texts_headers_and_comment_blocks(spark):
    texts = licenses.full_texts()
    names = sorted(p for p in texts if len(texts[p][0]) > 600 and p not in licenses.HEADERS or len(texts[p]) > 1)
    commented = lambda mark: "".join(f"{mark} {line}".rstrip() + "\n" for line in MIT_TEXT.splitlines())
    header = licenses.HEADERS["GPL-2.0"][0].replace("this program", "Foo").split(". ")
    rows = [(n, f"t{n}/LICENSE", "Copyright 2020 The Foo Authors\n\n" + texts[name][0]) for n, name in enumerate(names)]
    rows += [
        (100, "m/LICENSE", MIT_TEXT), (101, "m/src/a.py", "import os"), (102, "c/a.py", commented("#") + "import os\n"),
        (103, "d/a.c", "/*\n" + commented(" *") + " */\nint main() {}\n"), (104, "e/a.rs", "//! Foo\n\n" + commented("//") + "fn main() {}"),
        (105, "f/a.c", "/* foo.c\n\n   " + ".\n   ".join(header) + " */\nint x;"), (106, "g/a.py", "# Released under\n# the MIT License.\nx = 1\n"),
        (107, "h/a.py", "# " + "\n# ".join(["A comment about the use of this software and the terms of its parts"] * 40)),
    ]
    found = scan(spark, rows)
    assert [found[n][0] for n in range(len(names))] == names
    assert {n: found[n][0] for n in range(100, 108)} == {
        100: "MIT", 101: "MIT", 102: "MIT", 103: "MIT", 104: "MIT", 105: "GPL-2.0", 106: "MIT", 107: None}
    assert found[101][1] == "inherited"
