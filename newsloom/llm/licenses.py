"""Licence texts found by the digest of their canonical form, with DataFrame functions only.

Two texts that differ only in case, punctuation, blanks, copyright lines or accepted
spellings of a word have one canonical form. Documents are looked up whole, and so is each
of their lines, as a notice usually stands on a line of its own. Blocks between lines without
a letter or digit are looked up too, and a text of several blocks is found where all of them
follow each other, so a licence inside a longer document or source file is found.
Known are short notices, the headers of source files, and the whole texts in ``license_texts``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.settings import staged

# Short notices by which a work names its licence.
NOTICES = {
    "Apache-2.0": ("Licensed under the Apache License, Version 2.0.",),
    "BSD-3-Clause": ("Released under the BSD 3-Clause License.",),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.",),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.",),
    "GPL-3.0": ("This work is licensed under the GNU General Public License, version 3.",),
    "MIT": ("Released under the MIT License.", "Licensed under the MIT License."),
}
# Names in one-line notices of whole texts, also their titles.
NAMES = {
    "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD"),
    "AGPL-3.0": ("GNU Affero General Public License, version 3", "AGPL-3.0"),
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License"),
    "Artistic-1.0-Perl": ("Artistic License",),
    "BSD-2-Clause": ("BSD 2-Clause License", "BSD 2-Clause \"Simplified\" License", "Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "New BSD License", "BSD 3-Clause \"New\" or \"Revised\" License"),
    "BSL-1.0": ("Boost Software License, Version 1.0", "Boost Software License 1.0"),
    "CC-BY-4.0": ("Creative Commons Attribution 4.0 International License",),
    "CC-BY-NC-4.0": ("Creative Commons Attribution-NonCommercial 4.0 International License",),
    "CC-BY-SA-4.0": ("Creative Commons Attribution-ShareAlike 4.0 International License", "CC BY-SA 4.0"),
    "CC0-1.0": ("CC0 1.0 Universal", "CC0 1.0"),
    "GFDL-1.2": ("GNU Free Documentation License, Version 1.2",),
    "GFDL-1.3": ("GNU Free Documentation License, Version 1.3",),
    "GPL-1.0": ("GNU General Public License, version 1",),
    "GPL-2.0": ("GNU General Public License, version 2", "GNU General Public License v2.0"),
    "GPL-3.0": ("GNU General Public License, version 3", "GNU General Public License v3.0"),
    "ISC": ("ISC License", "ISC License (ISC)"),
    "LGPL-2.0": ("GNU Library General Public License, version 2",),
    "LGPL-2.1": ("GNU Lesser General Public License, version 2.1", "GNU Lesser General Public License v2.1"),
    "LGPL-3.0": ("GNU Lesser General Public License, version 3", "GNU Lesser General Public License v3.0"),
    "MIT": ("MIT License", "MIT License (MIT)"),
    "MPL-1.1": ("Mozilla Public License, Version 1.1", "Mozilla Public License 1.1"),
    "MPL-2.0": ("Mozilla Public License, Version 2.0", "Mozilla Public License 2.0"),
    "OFL-1.1": ("SIL Open Font License, Version 1.1",),
    "Unicode-3.0": ("Unicode License v3",),
    "Unlicense": ("Unlicense",),
    "Zlib": ("zlib License",),
}
_APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at
{gap}    {scheme}://www.apache.org/licenses/LICENSE-2.0{dot}
{gap}Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""
# The paragraph that names the licence; the one on warranty has the same words in all of them.
_GNU = """This {work} is free software; you can redistribute it and/or modify
it under the terms of the GNU {name} as published by
the Free Software Foundation; {version}"""
_GNU_NAMES = {
    "AGPL-3.0": ("Affero General Public License", "3"),
    "GPL-2.0": ("General Public License", "2"),
    "GPL-3.0": ("General Public License", "3"),
    "LGPL-2.0": ("Library General Public License", "2"),
    "LGPL-2.1": ("Lesser General Public License", "2.1"),
    "LGPL-3.0": ("Lesser General Public License", "3"),
}
_MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at {scheme}://mozilla.org/MPL/2.0/."""
_BOOST = """Distributed under the Boost Software License, Version 1.0.
(See accompanying file {file} or copy at
{scheme}://www.boost.org/LICENSE_1_0.txt)"""
# Spellings that licence comparison treats as equal.
EQUIVALENT = {
    "acknowledgement": "acknowledgment",
    "analogue": "analog",
    "artefact": "artifact",
    "authorisation": "authorization",
    "authorised": "authorized",
    "cancelled": "canceled",
    "copyright owner": "copyright holder",
    "favour": "favor",
    "fulfil": "fulfill",
    "initialise": "initialize",
    "judgement": "judgment",
    "labelling": "labeling",
    "licence": "license",
    "licenced": "licensed",
    "modelling": "modeling",
    "noncommercial": "non commercial",
    "organisation": "organization",
    "per cent": "percent",
    "practise": "practice",
    "programme": "program",
    "realise": "realize",
    "recognise": "recognize",
    "sub license": "sublicense",
    "utilisation": "utilization",
    "whilst": "while",
    "wilful": "willful",
}
# The known digests are sent to every task up to this many rows; a larger table is joined by shuffle.
SENT_ROWS = 100_000
# What a unit is; one of a single line or block is several of them, looked up once.
LINE, BLOCK, WHOLE = 1, 2, 4


def _plain(text: Column) -> Column:
    """Lower case, without copyright lines."""
    return F.regexp_replace(F.lower(text), r"(?m)^[^\p{L}\p{N}\n]*(?:copyright|©)[^\n]*(?:\(c\)|©|\d{4})[^\n]*$", " ")


def _spaced(plain: Column) -> Column:
    """Words with one blank before, between and after."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(plain, r"[^\p{L}\p{N}]+", " ")), F.lit(" "))


def _spelled(words: Column) -> Column:
    """Equal spellings as one; texts without any of them, which are most, are searched once only."""
    usual_words = words
    for spelling, usual in EQUIVALENT.items():
        usual_words = F.replace(usual_words, F.lit(f" {spelling} "), F.lit(f" {usual} "))
    return F.trim(F.when(words.rlike(f" (?:{'|'.join(EQUIVALENT)}) "), usual_words).otherwise(words))


def _words(plain: Column) -> Column:
    return _spelled(_spaced(plain))


def canonical(text: Column) -> Column:
    """Lower case, without copyright lines, punctuation as blanks, equal spellings as one."""
    return _words(_plain(text))


def _blocks(plain: Column) -> Column:
    """What stands between lines without a letter or digit; copyright lines have none any more."""
    return F.split(plain, r"\n[^\p{L}\p{N}]*\n")


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def _headers() -> Iterator[tuple[str, str]]:
    for scheme in ("http", "https"):
        for gap in ("", "\n"):
            yield "Apache-2.0", _APACHE.format(scheme=scheme, gap=gap, dot="")
            yield "Apache-2.0", _APACHE.format(scheme=scheme, gap=gap, dot=".html")
        yield "MPL-2.0", _MPL.format(scheme=scheme)
        for file in ("LICENSE_1_0.txt", "LICENSE"):
            yield "BSL-1.0", _BOOST.format(scheme=scheme, file=file)
    for license_id, (name, number) in _GNU_NAMES.items():
        for work in ("program", "library", "software", "file"):
            for version in (
                f"either version {number} of the License, or (at your option) any later version.",
                f"version {number} of the License.", f"version {number}.",
            ):
                yield license_id, _GNU.format(work=work, name=name, version=version)
    for license_id, names in NAMES.items():
        yield license_id, f"SPDX-License-Identifier: {license_id}"
        for name in names:
            for start in ("Licensed under the", "Released under the", "This work is licensed under the"):
                yield license_id, f"{start} {name}."


def _versions(license_id: str, text: str) -> Iterator[tuple[str, bool]]:
    """A whole text as it is given away: with and without title, the rest after its terms,
    unfilled copyright lines, numbers of its items. True: the least of it, which all longer ones hold."""
    text = re.sub(r"(?m)^.*copyright *[\[{<](?:yyyy|year).*$", "", text, flags=re.I)
    title, _, rest = text.strip().partition("\n\n")
    body = rest if len(title.split()) <= 10 else text
    ends = [body]
    if (end := re.search(r"(?m)^.*END OF TERMS AND CONDITIONS.*$", body)) is not None:
        ends = [body[: end.start()], body[: end.end()], body]
    rights = [""]
    if len(body) < 5000:
        body = re.sub(r"(?i)^\s*all rights reserved\.?\s*", "", body)
        marks = [body] + [re.sub(r"(?m)^ *(?:\d+\.|[*-]) ", mark, body) for mark in ("* ", "")]
        item = r"\n+(?= *(?:\d+\.|[*-]|Redistributions|Neither) *)"
        ends = [re.sub(item, gap, m) for m in marks for gap in ("\n", "\n\n")] + marks
        rights = ["", "All rights reserved.\n\n"]
    yield text, False
    for part in dict.fromkeys(ends):
        yield part, len(body) < 5000 or part == ends[0]
        for name in (title if body is not text else "", *NAMES.get(license_id, ())):
            for start in ("", "The "):
                for right in rights:
                    yield f"{start}{name}\n\n{right}{part}", False
        for right in rights:
            yield right + part, False


def whole_texts() -> list[tuple[str, str, bool]]:
    """Id, text and whether it is looked for inside documents, for the files of ``license_texts``."""
    folder = resources.files(__package__).joinpath("license_texts")
    found: dict[tuple[str, str], bool] = {}
    for file in sorted(folder.iterdir(), key=lambda f: f.name):
        license_id = file.name.removesuffix(".txt").split("_")[0]
        for text, inside in _versions(license_id, file.read_text(encoding="utf-8")):
            found[license_id, text] = found.get((license_id, text), False) or inside
    return [(*k, v) for k, v in found.items()]


def known_licenses(spark: SparkSession, texts: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """``license_id``, ``text``, ``inside`` of the given texts; by default of all notices,
    headers and whole texts."""
    if texts is not None:
        rows = [(i, t, True) for i, many in texts.items() for t in many]
    else:
        rows = [(i, t, True) for i, many in NOTICES.items() for t in many]
        rows += [(i, t, True) for i, t in _headers()] + whole_texts()
    return spark.createDataFrame(rows, "license_id string, text string, inside boolean")


def _digests(known: DataFrame) -> DataFrame:
    """``license_id``, ``_digest``: of a whole text, or with ``text_no``, ``place`` and ``n_blocks`` of a block."""
    nothing = F.sha2(F.lit(""), 256)
    plain = known.select("license_id", "inside", _plain(F.col("text")).alias("plain"))
    whole = plain.select(
        "license_id", F.sha2(_words(F.col("plain")), 256).alias("_digest"), F.lit(False).alias("block"),
        F.lit(None).cast("string").alias("text_no"), F.lit(None).cast("int").alias("place"), F.lit(0).alias("n_blocks"),
    )
    parts = F.transform(_blocks(F.col("plain")), lambda b: F.sha2(_words(b), 256))
    parts = plain.filter("inside").select("license_id", F.filter(parts, lambda d: d != nothing).alias("parts")).distinct()
    blocks = parts.select(
        "license_id", "parts", F.posexplode("parts").alias("place", "_digest")
    ).select(
        "license_id", "_digest", F.lit(True).alias("block"), F.sha2(F.concat_ws(" ", "parts"), 256).alias("text_no"),
        "place", F.size("parts").alias("n_blocks"),
    )
    return whole.union(blocks).filter(F.col("_digest") != nothing).distinct()


def find_licenses(df: DataFrame, known: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document and licence: ``n_lines`` that are a text of it or belong to one, without
    blank and copyright lines and a title before it, and ``whole``: the document is one.

    ``known``: ``license_id``, ``text``, ``inside``: whether it is also looked for as blocks that
    follow each other. Documents without a licence have no row; null and
    blank texts match nothing; rows with one id count together. Only matches are shuffled.
    """
    table = staged(_digests(known), "licenses")
    if table.count() <= SENT_ROWS:
        table = F.broadcast(table)

    def unit(at: Column, value: Column, kind: int) -> Column:
        return F.struct(at.cast("int").alias("at"), value.alias("unit"), F.lit(kind).alias("kind"))

    def of_block(block: Column, at: Column, more: int = 0) -> Column:
        lines = F.split(block, "\n")
        many = F.concat(F.array(unit(at, block, BLOCK + more)), F.transform(lines, lambda line: unit(at, line, LINE)))
        return F.when(F.size(lines) > 1, many).otherwise(F.array(unit(at, block, LINE + BLOCK + more)))

    # The units of a row come from one task, so its number need only be told apart there.
    rows = df.select(F.col(doc_id).alias("doc_id"), F.monotonically_increasing_id().alias("_row"), _plain(F.col(text)).alias("plain"))
    rows = rows.select("doc_id", "_row", "plain", _blocks(F.col("plain")).alias("blocks"))
    whole = F.array(unit(F.lit(-1), F.col("plain"), WHOLE))
    several = F.concat(whole, F.flatten(F.transform("blocks", lambda block, at: of_block(block, at))))
    single = of_block(F.element_at("blocks", 1), F.lit(0), WHOLE)
    units = (
        rows.select("doc_id", "_row", F.explode(F.when(F.size("blocks") > 1, several).when(F.size("blocks") == 1, single)).alias("u"))
        .select("doc_id", "_row", "u.at", "u.unit", "u.kind", _spaced(F.col("u.unit")).alias("words"))
        .select(
            "doc_id", "_row", "at", "kind",
            # Never null, or a check for null before the join would work it out a second time.
            F.coalesce(F.sha2(_spelled(F.col("words")), 256), F.lit("")).alias("_digest"),
            F.when(
                F.col("kind").bitwiseAND(LINE) == 0, F.size(F.filter(F.split("unit", "\n"), lambda x: x.rlike(r"[\p{L}\p{N}]")))
            ).otherwise(1).alias("n"),
        )
    )
    # Blocks of a text that follow each other have one difference of places; other units stand alone.
    start = F.when(F.col("block"), F.col("at") - F.col("place")).otherwise(F.col("at"))
    as_what = F.when(F.col("block"), F.col("kind").bitwiseAND(BLOCK)).otherwise(F.col("kind").bitwiseAND(LINE + WHOLE))
    runs = (
        units.join(table, "_digest")
        .withColumn("kind", as_what)
        .filter("kind > 0")
        .groupBy("doc_id", "_row", "license_id", "kind", "text_no", start.alias("start"))
        .agg(F.count("*").alias("found"), F.max("n_blocks").alias("n_blocks"), F.collect_list(F.struct("at", "n")).alias("at"))
        .filter((F.col("kind") != BLOCK) | (F.col("found") == F.col("n_blocks")))
    )
    by_block = (
        runs.select("doc_id", "_row", "license_id", "kind", F.inline("at"))
        .groupBy("doc_id", "_row", "license_id", "at")
        .agg(
            F.max(F.when(F.col("kind") == BLOCK, F.col("n"))).alias("in_run"),
            F.count_if(F.col("kind").bitwiseAND(LINE) > 0).alias("alone"),
            F.bool_or(F.col("kind").bitwiseAND(WHOLE) > 0).alias("whole"),
        )
    )
    return by_block.groupBy("doc_id", "license_id").agg(
        F.sum(F.coalesce("in_run", "alone").cast("bigint")).alias("n_lines"), F.bool_or("whole").alias("whole")
    )
