"""Licence scan: canonical digests of entire texts, looked up among known licences."""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.common import stored, whole
from lakestrata.llm.known_licences import full_texts, notices

# Fixed texts of public licences and of the notices that stand for them.
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software,
and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above
copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE
IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
SOFTWARE."""
KNOWN: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("ISC", _ISC),
    ("MIT", _MIT),
    ("MIT", "MIT License " + _MIT),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Released under the MIT License."),
    *notices(),
    *full_texts(),
)
# Fixed: spellings that licence texts use for the same word.
SPELLINGS: tuple[tuple[str, str], ...] = (
    ("acknowledgement", "acknowledgment"),
    ("authoris", "authoriz"),
    ("behaviour", "behavior"),
    ("copyright owner", "copyright holder"),
    ("favour", "favor"),
    ("fulfilment", "fulfillment"),
    ("licence", "license"),
    ("licenced", "licensed"),
    ("licencing", "licensing"),
    ("merchantibility", "merchantability"),
    ("non commercial", "noncommercial"),
    ("non infringement", "noninfringement"),
    ("organis", "organiz"),
    ("per cent", "percent"),
    ("sub license", "sublicense"),
    ("whilst", "while"),
    ("wilful", "willful"),
)
# Lines that name whose the text is. Wrapped prose can begin with the same words.
COPYRIGHT_LINE = (
    r"(?im)^[\x20\x09\r]*(copyright(?![a-z,;.)-]|[\x20\x09]+(?:notices?|holders?|owners?|ownership|laws?|licen[cs]es?|and|or|on|in|to|for|of"
    r"|is|has|are|under|interests?|permissions?|statements?|treat(?:y|ies)|disclaimers?|rights?|patents?|protection|control|status|claims?)\b)"
    r"|\(c\)(?![\x20\x09]+(?:you|under|the|if|any|all|no|each|this|such|when|where|representations)\b)|©|all rights reserved)[^\n]*$"
)
# How a canonical line begins that names its licence.
_VERBS = ("released", "distributed", "published", "available")
NOTICE = (
    r"^(?:spdx license identifier |license (?!version)|(?:(?:this|the) (?:work|software|program|project|file|document|content|text|article|page|code"
    r"|source code|library|package) is |code )?(?:licensed|" + "|".join(_VERBS[:-1]) + r"|(?:made )?available) under )"
    r"(?:the terms of )?(?:the |an? )?"
)


def canonical(text: Column) -> Column:
    """The text without copyright lines, in lower case, words by single spaces, spellings and openings of notices made equal."""
    words = F.regexp_replace(F.lower(F.regexp_replace(text, COPYRIGHT_LINE, " ")), r"[^\p{L}\p{N}]+", " ")
    for spelled, usual in SPELLINGS:
        words = F.replace(words, F.lit(spelled), F.lit(usual))
    return F.regexp_replace(F.trim(words), NOTICE, "licensed under ")


def anchor_words(known) -> str:
    """A pattern that is found in every text with the canonical text of a known one; the empty pattern when no words tell.

    Words that a spelling could have changed are no anchors, except licence in
    its two spellings. A text that opens as a notice has one of the verbs of
    notices. The others get long words, those that most of them share first.
    """
    changed = {part for pair in SPELLINGS for part in pair[1].split()}
    anchors, left = ["licen[cs]e", "permission"], []
    for _, text in known:
        kept = " ".join(re.findall(r"[^\W_]+", re.sub(COPYRIGHT_LINE, " ", text).lower()))
        for spelled, usual in SPELLINGS:
            kept = kept.replace(spelled, usual)
        if re.match(NOTICE, kept):
            anchors += [verb for verb in _VERBS if verb not in anchors]
        elif not re.search("|".join(anchors[:2]), kept):
            left.append({w for w in re.findall(r"[a-z]+", kept) if not any(part in w for part in changed)})
    left = [words for words in left if words.isdisjoint(anchors)]
    while left:
        counts = Counter(w for words in left for w in words)
        if not all(left):
            return ""
        best = max(counts, key=lambda w: (min(len(w), 8), counts[w], w))
        anchors.append(best)
        left = [words for words in left if best not in words]
    return "(?iu)" + "|".join(anchors)


#: What every text with the canonical text of one of ``KNOWN`` holds.
ANCHOR = anchor_words(KNOWN)


def known_digests(spark, known=KNOWN, anchor: str = ANCHOR) -> DataFrame:
    """digest, licence of the known texts. Every text must hold an anchor; those of ``anchor_words(known)`` are in all."""
    rows = spark.createDataFrame(list(known), "licence string, text string")
    if not rows.filter(~F.col("text").rlike(anchor)).isEmpty():
        raise ValueError("a known text has none of the anchor words")
    words = rows.select("licence", canonical(F.col("text")).alias("words")).filter("words <> ''")
    return words.groupBy(F.sha2(F.col("words").cast("binary"), 256).alias("digest")).agg(F.min("licence").alias("licence"))


def licence_scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", known=KNOWN
) -> DataFrame:
    """One row per document: doc_id, licence, notices, n_notices.

    ``licence`` is the known licence whose canonical text the entire document
    has, else null. ``notices`` names, sorted and joined by commas, the licences
    that an entire line or an entire paragraph of it is, and ``n_notices``
    counts such lines and paragraphs; a paragraph of one line counts as a line.
    Null and empty texts have none. Repeated rows each keep their row, an empty
    table gives no rows, and other columns are not looked at.

    The digests of entire texts are joined by hash to the known ones, which are
    a fixed list and broadcast. A text without an anchor word of the known texts
    cannot equal one, so its digest is not made; the words are taken from the
    list, so any text may be in it.
    """
    anchor = ANCHOR if known is KNOWN else anchor_words(known)
    digests = known_digests(docs.sparkSession, known, anchor)
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), whole(text_col).alias("text")
    )
    text = F.replace("text", F.lit("\r\n"), F.lit("\n"))
    lines = F.transform(F.split(text, r"\n"), lambda t: F.struct(F.lit("line").alias("unit"), t.alias("text")))
    paragraphs = F.filter(F.split(text, r"\n[\x20\x09]*\n\s*"), lambda t: F.contains(F.trim(t), F.lit("\n")))
    paragraphs = F.transform(paragraphs, lambda t: F.struct(F.lit("paragraph").alias("unit"), t.alias("text")))
    entire = F.array(F.struct(F.lit("whole").alias("unit"), text.alias("text")))
    units = F.filter(F.concat(entire, paragraphs, lines), lambda u: u["text"].rlike(anchor))
    units = F.transform(
        units, lambda u: F.struct(u["unit"].alias("unit"), F.sha2(canonical(u["text"]).cast("binary"), 256).alias("digest"))
    )
    # Digests are kept, not texts, so finding the units again costs nothing.
    marked = stored(
        rows.select("row", "doc_id", F.when(F.col("text").rlike(anchor), units).alias("units")), "licence-digests"
    )
    parts = marked.filter("units is not null").select("row", F.inline("units"))
    hits = parts.join(F.broadcast(digests), "digest")
    in_part = F.col("unit") != "whole"
    found = hits.groupBy("row").agg(
        F.max(F.when(~in_part, F.col("licence"))).alias("licence"),
        F.array_join(F.array_sort(F.collect_set(F.when(in_part, F.col("licence")))), ",").alias("notices"),
        F.count(F.when(in_part, 1)).alias("n_notices"),
    )
    return marked.select("row", "doc_id").join(found, "row", "left").select(
        "doc_id",
        "licence",
        F.coalesce("notices", F.lit("")).alias("notices"),
        F.coalesce("n_notices", F.lit(0)).alias("n_notices"),
    )
