"""Licences of files: texts, names and statements beside templates, then inheritance along directories.

What can state a licence, the first that does counts: an SPDX name; the whole
text of a licence file or the head comment of any file, by TF-IDF cosine with
licence texts and standard headers; the title of a licence file; and statements,
sentences or lines with a word that speaks of licences, by TF-IDF cosine with
single sentences.  Terms are weighted by how few templates hold them.  Licence
files give theirs to their directory, and a file without one takes that of the
nearest directory above it.

Everything is built-in functions.  Only statements, head comments and licence
files are split into terms.  Paths are joined by directory, each directory once,
however many files it holds.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanledger.llm.common import narrow
from scanledger.llm.license_texts import TITLES, licence_texts

#: How licences are stated, and words that a statement holds.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-2-Clause": "Use of this source code is governed by the BSD 2-Clause License.",
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license, the BSD 3-Clause License.",
    "CC-BY-4.0": "Licensed under the Creative Commons Attribution license, CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under the Creative Commons license CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under the Creative Commons license CC BY-SA 4.0.",
    "CC0-1.0": "This work is released under the CC0 1.0 Universal public domain dedication license.",
    "EPL-2.0": "This program is made available under the terms of the Eclipse Public License 2.0.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "ISC": "Released under the ISC License.",
    "LGPL-3.0": "This library is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}
CUES = "licen[cs]e|spdx|creative commons|public domain"
SENTENCE_END, TERM = r"([.;!?])[ \t]+", "[a-z0-9]+(?:[.-][a-z0-9]+)*"
LICENCE_FILE = r"(?i)^(LICEN[CS]E|COPYING|UNLICENSE)([.-].*)?$"
NEAR = 0.6
#: Cosine from which a text is a licence; its terms count by the logarithm of how often they stand.
TEXT_NEAR = 0.75
SPDX = r"(?i)SPDX-License-Identifier:[ \t]*([^\n\r]*)"
#: A head comment: one block, or the lines before the first that is neither blank nor a comment.
HEAD_BLOCK = r"(?s)\A\uFEFF?(?:#![^\n]*\n|<\?[^\n]*\n)?\s*(/\*.*?\*/|<!--.*?-->|\"\"\".*?\"\"\"|'''.*?'''|\(\*.*?\*\)|\{-.*?-\})"
NO_COMMENT = r"(?m)^(?![ \t]*(?://|#|\*|/\*|--|;|%|!|<!--|<\?|dnl\b|rem\b|REM\b|\r?$))"
#: Where the part of a head comment that speaks of its licence begins.
HEAD_CUE = r"(?i)licen[cs]ed under|this (?:program|library|file|software|work|source code form) (?:is|and)|permission (?:is|to use)|redistribution and use|to the extent possible under law"


def terms_of(text: str) -> list[str]:
    return re.findall(TERM, text.lower())


def inverse_frequencies(templates: dict[str, str]) -> tuple[dict[str, float], float]:
    """The weight of each term of the templates, and of any other."""
    held = Counter(t for text in templates.values() for t in set(terms_of(text)))
    weight = lambda n: math.log((1 + len(templates)) / (1 + n)) + 1
    return {t: weight(n) for t, n in sorted(held.items())}, weight(0)


def unit_vectors(templates: dict[str, str]) -> dict[str, dict[str, float]]:
    """The weighted terms of each template, at length one."""
    weights, _ = inverse_frequencies(templates)
    out = {}
    for name, text in templates.items():
        raw = {t: n * weights[t] for t, n in Counter(terms_of(text)).items()}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        out[name] = {t: v / norm for t, v in sorted(raw.items())}
    return out


def statements(files: DataFrame) -> DataFrame:
    """Each different sentence or line of a file that speaks of licences: (path, statement)."""
    cut = F.split(F.regexp_replace("text", SENTENCE_END, "$1\n"), "\n")
    return files.select("path", F.explode(F.array_distinct(F.filter(cut, lambda s: F.lower(s).rlike(CUES)))).alias("statement"))


def nearest(found: DataFrame, names: list[str], vectors: list[dict[str, float]], weights: dict[str, float], other: float, damped: bool) -> DataFrame:
    """The template nearest to one of the texts of each path: (path, best), with best (cosine, at) and -at its place in names.

    ``found`` holds (path, key, statement), with a short key for each different
    statement of a path, as every term carries it.  ``damped`` counts a term by the logarithm of how often it stands.
    """
    spark = found.sparkSession
    # One row for each term of the templates: fixed and small.
    table = spark.createDataFrame([(t, w, [v.get(t, 0.0) for v in vectors]) for t, w in weights.items()], "term string, weight double, parts array<double>")
    counted = found.select("path", "key", F.explode(F.regexp_extract_all(F.lower("statement"), F.lit(TERM), F.lit(0))).alias("term")).groupBy("path", "key", "term").agg(F.count("*").alias("n"))
    value = (F.log("n") + 1 if damped else F.col("n")) * F.coalesce("weight", F.lit(other))
    valued = counted.join(F.broadcast(table), "term", "left").select("path", "key", value.alias("value"), "parts")
    sums = valued.groupBy("path", "key").agg(F.sum(F.col("value") ** 2).alias("square"), *[F.sum(F.col("value") * F.coalesce(F.col("parts")[i], F.lit(0.0))).alias(f"dot{i}") for i in range(len(names))])
    cosine = lambda i: F.round(F.col(f"dot{i}") / F.sqrt("square"), 6)
    # Among equal cosines the first name counts.
    best = F.greatest(*[F.struct(cosine(i).alias("cosine"), F.lit(-i).alias("at")) for i in range(len(names))])
    return sums.select("path", best.alias("best")).groupBy("path").agg(F.max("best").alias("best"))


def name_at(names: list[str], at: Column) -> Column:
    return F.get(F.array(*[F.lit(n) for n in names]), at)


def head_texts(files: DataFrame) -> DataFrame:
    """Whole licence files, and head comments with and without what stands before the licence: (path, key, statement)."""
    licence_file = F.substring_index("path", "/", -1).rlike(LICENCE_FILE)
    end = F.regexp_instr("text", F.lit(NO_COMMENT))
    lines = F.when(end == 0, F.col("text")).otherwise(F.substring("text", F.lit(1), end - 1))
    block = F.regexp_extract("text", HEAD_BLOCK, 1)
    heads = F.array(F.when(licence_file, F.col("text")), lines, block)
    cut = files.select("path", F.explode(F.array_distinct(F.array_compact(heads))).alias("head")).where(F.length(F.trim("head")) > 0)
    cue = F.regexp_instr("head", F.lit(HEAD_CUE))
    from_cue = F.when(cue > 1, F.substring("head", cue, F.length("head")))
    texts = cut.select("path", F.explode(F.array_compact(F.array("head", from_cue))).alias("statement"))
    return texts.select("path", F.md5("statement").alias("key"), "statement").dropDuplicates(["path", "key"])


def text_licences(files: DataFrame, texts: list[tuple[str, str]], near: float) -> DataFrame:
    """The licence whose text or standard header a licence file or head comment is: (path, rank, cosine, name)."""
    names = [n for n, _ in texts]
    terms = [Counter(terms_of(text)) for _, text in texts]
    held = Counter(t for each in terms for t in each)
    weight = lambda n: math.log((1 + len(texts)) / (1 + n)) + 1
    weights = {t: weight(n) for t, n in sorted(held.items())}
    vectors = []
    for each in terms:
        raw = {t: (1 + math.log(n)) * weights[t] for t, n in each.items()}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        vectors.append({t: v / norm for t, v in raw.items()})
    best = nearest(head_texts(files), names, vectors, weights, weight(0), damped=True).where(F.col("best.cosine") >= near)
    return best.select("path", F.lit(2).alias("rank"), F.col("best.cosine").alias("cosine"), name_at(names, -F.col("best.at")).alias("name"))


def named_licences(files: DataFrame, known: list[str]) -> DataFrame:
    """The licence of an SPDX name, or of the title of a licence file: (path, rank, cosine, name)."""
    # A name may say which later versions count; of an expression the first known name counts.
    listed = F.split(F.regexp_replace(F.lower(F.regexp_extract("text", SPDX, 1)), r"[()*/>,;]", " "), r"\s+")
    plain = F.transform(listed, lambda n: F.regexp_replace(n, r"(-only|-or-later|\+)$", ""))
    by_name = F.create_map(*[F.lit(x) for n in known for x in (n.lower(), n)])
    spdx = F.get(F.filter(F.transform(plain, lambda n: F.element_at(by_name, n)), lambda n: n.isNotNull()), F.lit(0))
    licence_file = F.substring_index("path", "/", -1).rlike(LICENCE_FILE)
    # The first title of the whole file counts; a licence that names others does so behind its own.
    at = lambda pattern: F.nullif(F.regexp_instr("text", F.lit(rf"(?im)^[ \t#=*]*{pattern}[ \t\r=*]*$")), F.lit(0))
    places = [F.struct(at(pattern).alias("at"), F.lit(i).alias("order"), F.lit(n).alias("name")) for i, (n, pattern) in enumerate(TITLES.items())]
    title = F.when(licence_file, F.array_min(F.filter(F.array(*places), lambda p: p["at"].isNotNull()))["name"])
    kinds = F.array(F.struct(F.lit(3).alias("rank"), F.lit(1.0).alias("cosine"), spdx.alias("name")), F.struct(F.lit(1).alias("rank"), F.lit(1.0).alias("cosine"), title.alias("name")))
    return files.select("path", F.explode(kinds).alias("k")).where("k.name IS NOT NULL").select("path", "k.*")


def stated_licences(files: DataFrame, templates: dict[str, str], near: float, texts: list[tuple[str, str]]) -> DataFrame:
    """The licence that each file states: (path, own_license, own_cosine), for those that state one."""
    weights, other = inverse_frequencies(templates)
    vectors = unit_vectors(templates)
    names = sorted(templates)
    best = nearest(statements(files).withColumn("key", F.md5("statement")), names, [vectors[n] for n in names], weights, other, damped=False).where(F.col("best.cosine") >= near)
    said = best.select("path", F.lit(0).alias("rank"), F.col("best.cosine").alias("cosine"), name_at(names, -F.col("best.at")).alias("name"))
    known = sorted({*names, *(n for n, _ in texts)})
    found = said.unionByName(text_licences(files, texts, TEXT_NEAR)).unionByName(named_licences(files, known))
    per_file = found.groupBy("path").agg(F.min_by(F.struct("name", "cosine"), F.struct(-F.col("rank"), -F.col("cosine"), "name")).alias("best"))
    return per_file.select("path", F.col("best.name").alias("own_license"), F.col("best.cosine").alias("own_cosine"))


def directory(path: Column) -> Column:
    """The directory of a path, without the last slash; empty at the top."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def inherited(files: DataFrame, own: DataFrame) -> DataFrame:
    """The nearest licence at or above each directory that holds files: (dir, inherited, license_dir)."""
    name = F.substring_index("path", "/", -1)
    given = own.where(name.rlike(LICENCE_FILE)).groupBy(directory(F.col("path")).alias("above")).agg(F.min_by("own_license", "path").alias("inherited"))
    dirs = files.select(directory(F.col("path")).alias("dir")).distinct()
    parts = F.split("dir", "/")
    ancestors = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))
    steps = dirs.select("dir", F.posexplode(ancestors).alias("depth", "above"))
    nearest = steps.join(given, "above").groupBy("dir").agg(F.max(F.struct("depth", "inherited", F.col("above").alias("license_dir"))).alias("near"))
    return nearest.select("dir", "near.inherited", "near.license_dir")


def scan_licences(files: DataFrame, path_col: str = "path", text_col: str = "text", templates: dict[str, str] | None = None, near: float = NEAR, texts: list[tuple[str, str]] | None = None) -> DataFrame:
    """Licences of files: path, own_license, own_cosine, license, license_dir, basis.

    One row for each row of ``files``; rows under one path are one file, whose
    statements count together.  ``templates`` are sentences by name, ``texts``
    names and licence texts or headers.  A null path lies nowhere: its row has no
    licence.  A null text states nothing.  ``basis`` is "stated", "inherited"
    (from ``license_dir``) or "none".
    """
    rows = narrow(files, path=path_col, text=text_col)
    paths = rows.select("path")
    placed = rows.where("path IS NOT NULL")
    own = stated_licences(placed.where("text IS NOT NULL"), templates or TEMPLATES, near, licence_texts() if texts is None else texts)
    from_above = inherited(placed, own)
    joined = paths.join(own, "path", "left").withColumn("dir", directory(F.col("path"))).join(from_above, "dir", "left")
    stated = F.col("own_license").isNotNull()
    return joined.select(
        "path",
        "own_license",
        "own_cosine",
        F.coalesce("own_license", "inherited").alias("license"),
        F.when(~stated, F.col("license_dir")).alias("license_dir"),
        F.when(stated, "stated").when(F.col("inherited").isNotNull(), "inherited").otherwise("none").alias("basis"),
    )
