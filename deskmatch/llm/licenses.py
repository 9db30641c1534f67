"""License scan: sparse TF-IDF cosine of sentences and licence files to templates, then inheritance by folder.

Every sentence of a file is a sparse vector of term weights, as are the templates; files are counted for every
term. In a longer sentence each run of terms as long as a template is compared too, if it names what the template
names. Comment blocks, paragraphs and whole licence files are compared with full licence texts and file headers.
The file's own licence is that of its best part. A folder has the licence that most
of its witness files state, and a file without one of its own takes that of its nearest ancestor folder.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import reduce
from itertools import accumulate
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskmatch.llm.common import stored
from deskmatch.operators.scale import hot_keys, salted_join

#: fixed values: short notices by licence
TEMPLATES = {
    "Apache-2.0": ("Licensed under the Apache License, Version 2.0.",),
    "BSD-3-Clause": ("Use of this source code is governed by a BSD 3-Clause License.", "Licensed under the BSD 3-Clause License."),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License.",
                  "Creative Commons Attribution 4.0 International Public License"),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution NonCommercial 4.0 International License.",
                     "Creative Commons Attribution-NonCommercial 4.0 International Public License"),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution ShareAlike 4.0 International License.",
                     "Creative Commons Attribution-ShareAlike 4.0 International Public License"),
    "GPL-3.0": ("This work is licensed under the GNU General Public License, version 3.",),
    "LGPL-3.0": ("This work is licensed under the GNU Lesser General Public License, version 3.",),
    "MIT": ("Released under the MIT License.", "Licensed under the MIT License."),
    "MPL-2.0": ("This work is subject to the terms of the Mozilla Public License, version 2.0.",),
    "AGPL-3.0": ("This work is licensed under the GNU Affero General Public License, version 3.",),
    "BSD-2-Clause": ("Use of this source code is governed by a BSD 2-Clause License.", "Licensed under the BSD 2-Clause License."),
    "CC0-1.0": ("This work is dedicated to the public domain under CC0 1.0 Universal.",),
    "GPL-2.0": ("This work is licensed under the GNU General Public License, version 2.",),
    "ISC": ("Licensed under the ISC License.",),
    "LGPL-2.1": ("This work is licensed under the GNU Lesser General Public License, version 2.1.",),
    "Unlicense": ("Released into the public domain under the Unlicense.",),
}
#: least cosine of a sentence to a template
SIMILARITY = 0.75
_GNU = (
    "{0} is free software: you can redistribute it and/or modify it under the terms of the {1} as published by the Free "
    "Software Foundation, either version {2} of the License, or (at your option) any later version. {0} is distributed in "
    "the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or "
    "FITNESS FOR A PARTICULAR PURPOSE. See the {1} for more details. You should have received a copy of the {1} along with "
    "{0}. If not, see www.gnu.org/licenses/."
)
#: fixed values: standard file headers; full texts are in the folder beside this file
HEADERS = {
    "AGPL-3.0": (_GNU.format("this program", "GNU Affero General Public License", "3"),),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
        "governing permissions and limitations under the License.",
        "Licensed to the Apache Software Foundation (ASF) under one or more contributor license agreements. See the NOTICE file "
        "distributed with this work for additional information regarding copyright ownership. The ASF licenses this file to You "
        "under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the "
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
        "governing permissions and limitations under the License.",
    ),
    "GPL-2.0": (_GNU.format("this program", "GNU General Public License", "2"),),
    "GPL-3.0": (_GNU.format("this program", "GNU General Public License", "3"),),
    "LGPL-2.1": (_GNU.format("this library", "GNU Lesser General Public License", "2.1"),),
    "LGPL-3.0": (_GNU.format("this library", "GNU Lesser General Public License", "3"),),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",),
}
#: least cosine of a block or a whole file to a full text or header; terms there weigh 1 + ln(count)
TEXT_SIMILARITY = 0.85
#: runs of comment lines, and comments between marks
LINE_COMMENTS = r"(?:(?<![^\n])[ \t]*+(?:#|//|--|;|%|\*(?!/)|\.\.[ ]|rem[ ])[^\n]*+(?:\n|\z))++"
COMMENTS = rf"/\*[\s\S]*?(?:\*/|\z)|<!--[\s\S]*?(?:-->|\z)|\"\"\"[\s\S]*?(?:\"\"\"|\z)|(?i:{LINE_COMMENTS})"
#: marks of comments, and lines that name owners
MARKS = r"(?im)^[ \t]*+(?:#++!?|//++[!/]*+|--++|;++|%++|/?\*++/?|<!--|\"\"\"|\.\.[ ]|rem[ ])|\*+/|-->"
OWNERS = r"(?im)^[ \t#*/;%-]*+(?:copyright[ ]+(?:\(c\)|©|[0-9]{4})|(?:\(c\)|©)[ ]+[0-9]{4})[^\n]*$"
MARK_UP = "<[^<>]*>"
#: words of notices that name no licence
GENERAL = frozenset(
    "a an and by code for general governed in international is its license licensed of public released software source "
    "subject terms that the this to under use version work".split())
TERM = r"[a-z0-9]+(?:[.-][a-z0-9]+)*"
LICENSE_FILE = r"(?i)(^|/)(licen[cs]e|copying|notice|unlicense)[^/]*$"


def terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), 0)


def _python_terms(text: str) -> list[str]:
    return re.findall(TERM, text.lower())


def sentences(text: Column) -> Column:
    """Ends of lines and of sentences; mark-up is no part of a sentence."""
    return F.split(F.regexp_replace(text, MARK_UP, "\n"), r"[.!?]*[\n\r]+|[.!?]+\s+|[.!?]+$")


def full_texts() -> dict[str, tuple[str, ...]]:
    """Full texts and standard headers by licence."""
    found = {path.stem: (path.read_text(encoding="utf-8"),) for path in (Path(__file__).parent / "license_texts").glob("*.txt")}
    return {name: found.get(name, ()) + HEADERS.get(name, ()) for name in sorted({*found, *HEADERS})}


def blocks(text: Column) -> Column:
    """Comments and paragraphs, without mark-up and comment marks."""
    lines = F.regexp_replace(text, "\r\n?", "\n")
    plain = lambda part: F.regexp_replace(F.regexp_replace(part, MARKS, ""), MARK_UP, "\n")
    paragraphs = F.split(plain(lines), r"\n[ \t]*+\n\s*+")
    return F.array_distinct(F.concat(F.transform(F.regexp_extract_all(lines, F.lit(COMMENTS), 0), plain), paragraphs))


def body(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, MARK_UP, "\n"), OWNERS, "")


def _python_body(text: str) -> str:
    return re.sub(OWNERS, "", re.sub(MARK_UP, "\n", text))


def document_frequencies(files: DataFrame) -> DataFrame:
    """(term, n): how many files hold each term; the empty term counts all files."""
    return (
        files.select(F.explode(F.array_append(F.array_distinct(terms(F.col("text"))), F.lit(""))).alias("term"))
        .groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    )


def telling(text: str) -> list[str]:
    """The terms of a template that name the licence; all of them where there are only general words."""
    listed = list(dict.fromkeys(_python_terms(text)))
    return [t for t in listed if t not in GENERAL] or listed


def windows(listed: Column, text: str) -> Column:
    """The runs of terms as long as a template that hold all its telling terms."""
    length, names = len(_python_terms(text)), telling(text)
    named = lambda run: reduce(lambda a, b: a & b, (F.array_contains(run, t) for t in names))
    starts = F.when(named(listed) & (F.size(listed) > length), F.sequence(F.lit(1), F.size(listed) - length + 1))
    runs = F.transform(starts, lambda at: F.slice(listed, at, length))
    return F.coalesce(F.filter(runs, named), F.array().cast("array<array<string>>"))


def scan(
    files: DataFrame, templates: dict[str, tuple[str, ...]] = TEMPLATES, similarity: float = SIMILARITY,
    texts: dict[str, tuple[str, ...]] | None = None, text_similarity: float = TEXT_SIMILARITY,
    id_column: str = "id", path_column: str = "path", text_column: str = "text", witness: Column | None = None,
) -> DataFrame:
    """One row per file: id, path, license, score, origin ('own' or 'inherited') and folder (whose licence it is).

    ``witness`` is a condition on the path: files that speak for their folder; by default licence files by name.
    Equal scores go to the first licence name; of folder licences stated equally often the first name counts.
    A sentence must hold a telling term of its template: other weights alone do not name a licence.
    A full text or header (``texts``, by default :func:`full_texts`) goes before a sentence.
    A null or empty text states nothing; a null path has no folder. Files without licence keep null in the last
    four columns. Repeated ids are scanned row by row, and the best sentence of all rows of an id counts for
    each. An empty table gives no rows; other columns are ignored.
    """
    spark = files.sparkSession
    own = files.select(
        F.col(id_column).alias("id"), F.col(path_column).cast("string").alias("path"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    texts = full_texts() if texts is None else texts
    notices = [(name, 0, n, _python_terms(t), telling(t)) for name, listed in templates.items() for n, t in enumerate(listed)]
    wholes = [(name, 1, n, _python_terms(_python_body(t)), None) for name, listed in texts.items() for n, t in enumerate(listed)]
    vocabulary = sorted({t for _, _, _, listed, _ in notices + wholes for t in listed})
    frequencies = stored(document_frequencies(own), "frequencies")
    seen = {r["term"]: r["n"] for r in frequencies.filter(F.col("term").isin("", *vocabulary)).collect()}  # terms of the templates
    n_files = seen.pop("", 0)
    # smoothed, so terms of no file have the greatest weight
    idf = {t: math.log((1 + n_files) / (1 + seen.get(t, 0))) + 1 for t in vocabulary}
    vectors, rare, rare_in_texts, least = [], set(), set(), math.inf
    for name, kind, number, listed, names in notices + wholes:
        weights = {t: (1 + math.log(n) if kind else n) * idf[t] for t, n in Counter(listed).items()}
        norm = math.sqrt(sum(w * w for w in weights.values()))
        vectors += [(name, kind, number, t, w / norm, names is None or t in names) for t, w in weights.items()]
        # common terms alone stay below the similarity: by Cauchy-Schwarz the cosine is at most the norm
        # of the shared part of the template, so a part must hold one of the others, and enough of them
        bound, common = ((text_similarity if kind else similarity) - 1e-9) ** 2, 0.0
        for t in sorted(weights, key=idf.get):
            common += (weights[t] / norm) ** 2
            if common >= bound:
                (rare_in_texts if kind else rare).add(t)
        if kind:
            shares = accumulate(sorted(((w / norm) ** 2 for w in weights.values()), reverse=True))
            least = min(least, sum(share < bound for share in shares) + 1)
    # template terms only
    template = F.broadcast(spark.createDataFrame(vectors, "license string, kind int, number int, term string, weight double, telling boolean"))
    needle = "(^|[^a-z0-9])(" + "|".join(re.escape(t) for t in sorted(rare)) + ")([^a-z0-9]|$)"
    # files without any of these terms have no such part; most files end here
    some = F.arrays_overlap(terms(F.col("text")), F.array(*map(F.lit, sorted(rare | rare_in_texts))))
    told = stored(own.filter(some), "told")
    of_files = told.filter(F.col("path").rlike(LICENSE_FILE)).select("id", F.col("text").alias("block"))
    of_blocks = told.select("id", F.explode(blocks(F.col("text"))).alias("block"))
    unwrapped = of_blocks.filter(F.col("block").contains("\n") & F.lower("block").rlike(needle)).select(
        "id", F.explode(sentences(F.regexp_replace("block", r"\s*\n\s*", " "))).alias("sentence"))
    parts = (
        told.select("id", F.explode(sentences(F.col("text"))).alias("sentence")).unionByName(unwrapped)
        .unionByName(of_files.withColumnRenamed("block", "sentence"))
    )
    listed = parts.filter(F.lower("sentence").rlike(needle)).select("id", terms(F.col("sentence")).alias("terms"))
    runs = [windows(F.col("terms"), text) for listed_texts in templates.values() for text in listed_texts]
    spans = listed.select("id", F.explode(F.array_append(F.array_distinct(F.concat(*runs)), F.col("terms"))).alias("terms"))
    long = (
        of_blocks.unionByName(of_files).select("id", terms(body(F.col("block"))).alias("terms")).filter(F.size("terms") >= least)
        .withColumn("distinct", F.array_distinct("terms")).filter(F.size("distinct") >= least)
        .filter(F.arrays_overlap("distinct", F.array(*map(F.lit, sorted(rare_in_texts))))).select("id", "terms")
    ) if wholes else spans.limit(0)
    spans = spans.withColumn("kind", F.lit(0)).unionByName(long.withColumn("kind", F.lit(1)))
    counts = (
        spans.withColumn("row", F.monotonically_increasing_id()).select("id", "kind", "row", F.explode("terms").alias("term"))
        .groupBy("id", "kind", "row", "term").agg(F.count(F.lit(1)).alias("n"))
    )
    rarity = frequencies.select("term", (F.log(F.lit(1.0 + n_files) / (1 + F.col("n"))) + 1).alias("idf"))
    words = stored(salted_join(counts, rarity, hot_keys(frequencies, "term", "n"), "term", ["row"])
                   .select("id", "kind", "row", "term", (F.when(F.col("kind") == 1, 1 + F.log("n")).otherwise(F.col("n")) * F.col("idf")).alias("weight")), "terms")
    norms = words.groupBy("row").agg(F.sqrt(F.sum(F.col("weight") ** 2)).alias("norm"))
    cosines = (
        words.join(template.withColumnRenamed("weight", "template"), ["term", "kind"])
        .groupBy("id", "kind", "row", "license", "number").agg(F.sum(F.col("weight") * F.col("template")).alias("dot"), F.max("telling").alias("telling"))
        .filter("telling").join(norms, "row").select("id", "kind", "license", (F.col("dot") / F.col("norm")).alias("score"))
        .filter(F.col("score") >= F.when(F.col("kind") == 1, text_similarity).otherwise(similarity))
    )
    best = stored(
        cosines.groupBy("id", "kind", "license").agg(F.round(F.max("score"), 6).alias("score"))
        .groupBy("id").agg(F.min(F.struct((-F.col("kind")).alias("kind"), (-F.col("score")).alias("lost"), "license")).alias("best"))
        .select("id", F.col("best.license").alias("license"), (-F.col("best.lost")).alias("score")),
        "licenses",
    )
    folder = F.regexp_replace("path", "/?[^/]*$", "")
    placed = own.select("id", "path", folder.alias("folder"))
    speaks = F.col("path").rlike(LICENSE_FILE) if witness is None else witness
    folders = stored(
        placed.filter(F.col("path").isNotNull() & speaks).join(best, "id")
        .groupBy("folder", "license").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("folder").agg(F.min(F.struct((-F.col("n")).alias("n"), "license")).alias("said"))
        .select(F.col("folder").alias("ancestor"), F.col("said.license").alias("from_folder")),
        "folders",
    )
    # ancestors of each distinct folder, the folder itself first; the root is the empty path
    levels = F.split("folder", "/")
    ancestors = placed.select("folder").filter("folder IS NOT NULL").distinct().select(
        "folder", F.explode(F.array_append(F.transform(
            F.sequence(F.lit(1), F.size(levels)), lambda n: F.array_join(F.slice(levels, 1, n), "/")), F.lit(""))).alias("ancestor"))
    nearest = ancestors.join(folders, "ancestor").groupBy("folder").agg(
        F.max(F.struct(F.char_length("ancestor").alias("length"), "ancestor", "from_folder")).alias("nearest"))
    return (
        placed.join(best, "id", "left").join(nearest, "folder", "left")
        .select(
            "id", "path", F.coalesce("license", "nearest.from_folder").alias("license"), "score",
            F.when(F.col("license").isNotNull(), "own").when(F.col("nearest").isNotNull(), "inherited").alias("origin"),
            F.when(F.col("license").isNotNull(), F.col("folder")).otherwise(F.col("nearest.ancestor")).alias("folder"),
        )
    )
