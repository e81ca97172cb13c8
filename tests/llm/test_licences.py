"""Known licences beyond those of the test tables."""

from __future__ import annotations

import textwrap

import pytest
from llm.nasty import documents

from lakestrata.llm import licences
from lakestrata.llm.known_licences import TEXTS

MIT = """MIT License

Copyright (c) 2020 Someone

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""
NOTICES = [
    ("Licensed under CC BY 3.0", "CC-BY-3.0"),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "CC-BY-SA-4.0"),
    ("Distributed under the Mozilla Public License, version 2.0.", "MPL-2.0"),
    ("Released under the BSD 3-Clause License", "BSD-3-Clause"),
    ("// SPDX-License-Identifier: GPL-2.0-or-later", "GPL-2.0"),
    ("Available under GPLv3.", "GPL-3.0"),
    ("License: zlib", "Zlib"),
]


def scan(spark, texts, known=licences.KNOWN):
    rows = licences.licence_scan(documents(spark, list(enumerate(texts))), known=known).collect()
    return [(r["licence"], r["notices"], r["n_notices"]) for r in sorted(rows, key=lambda r: r["doc_id"])]


def test_entire_texts_in_any_wrap(spark):
    paths = sorted(TEXTS.glob("*.txt"))
    texts = [p.read_text("utf-8") for p in paths]
    assert len(texts) >= 29
    again = ["Copyright 2020 Someone\n\n" + t.replace("\n", "\r\n") for t in texts]
    names = [p.stem.split("~")[0] for p in paths]
    assert [got[0] for got in scan(spark, texts + again + [MIT])] == [*names, *names, "MIT"]


@pytest.mark.parametrize("width", [40, 57, 58, 59, 60, 61, 72, 80, 4000])
def test_prose_about_copyright_is_no_copyright_line(spark, width):
    texts = [(TEXTS / f"{name}.txt").read_text("utf-8") for name in ("BSD-2-Clause", "BSD-3-Clause", "MIT", "Unlicense", "BSL-1.0")]
    wrapped = ["\n\n".join(textwrap.fill(p, width, break_on_hyphens=False) for p in t.split("\n\n")) for t in texts]
    assert [got[0] for got in scan(spark, wrapped)] == ["BSD-2-Clause", "BSD-3-Clause", "MIT", "Unlicense", "BSL-1.0"]


def test_notices_of_many_licences(spark):
    assert scan(spark, [n for n, _ in NOTICES]) == [(name, name, 1) for _, name in NOTICES]
    assert scan(spark, ["Licensed under nothing", "Licensed", "Copyright 2020 X", ""]) == [(None, "", 0)] * 4


def test_head_of_a_file(spark):
    apache = (TEXTS / "Apache-2.0.txt").read_text("utf-8")
    head = apache[apache.index("Licensed under the Apache") :]
    (got,) = scan(spark, ["Copyright 2020 X\n\n" + head])
    assert got[:2] == ("Apache-2.0", "Apache-2.0")


def test_no_known_text_is_refused(spark):
    known = [("X", "nothing of the kind"), ("Y", "Свободно для всех"), ("Z", "BEHAVIOUR")]
    assert [got[0] for got in scan(spark, ["Nothing, of the kind", "свободно для ВСЕХ", "Behavior", "else"], known)] == ["X", "Y", "Z", None]
    assert [got[0] for got in scan(spark, ["Nothing, of the kind", "behavior"], known[:1] + known[2:])] == ["X", "Z"]


def test_a_text_has_one_name(spark):
    rows = spark.createDataFrame(list(licences.KNOWN), "licence string, text string")
    named = rows.groupBy(licences.canonical(rows["text"]).alias("words")).agg({"licence": "min"}).count()
    assert rows.select(licences.canonical(rows["text"]), "licence").distinct().count() == named
