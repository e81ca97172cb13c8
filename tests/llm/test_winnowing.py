"""Winnowing against a plain version that looks at every window."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

from llm.nasty import LONG, TEXTS, documents
from plans import physical
from pyspark.sql import functions as F

from lakestrata.llm.winnowing import edited_likeness, fingerprint, fingerprints

APART = "฀-໿က-႟ក-៿⺀-鿿豈-﫿\U00020000-\U0003ffff"
WORD = re.compile(f"[{APART}]|[^\x20\x09-\x0d{APART}]+")


def brute(text, words=5, window=8):
    symbols = [zlib.crc32(w.encode()) for w in WORD.findall(text or "")]
    if not symbols:
        return []
    hashes = []
    for i in range(max(len(symbols) - words + 1, 1)):
        run = symbols[i : i + words]
        h = 0
        for s in run + [0] * (words - len(run)):
            h = (h * 1_000_003 + s) % (2**37 - 25)
        hashes.append(h)
    chosen = set()
    for start in range(max(len(hashes) - window + 1, 1)):
        near = hashes[start : start + window]
        place = start + max(i for i, h in enumerate(near) if h == min(near))
        chosen.add((place, hashes[place]))
    return [(h, place) for place, h in sorted(chosen)]


def like(a, b):
    a, b = {h for h, _ in a}, {h for h, _ in b}
    return len(a & b) / len(a | b) if a | b else 1.0


def sized(text):
    return (len(text), hashlib.sha256(text.encode()).hexdigest())


def brute_rows(texts):
    order = sorted(texts, key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    out = []
    for n, (i, text) in enumerate(order):
        text, after = text or "", order[(n + 1) % len(order)][1] or ""
        half = len(text) // 2
        edit = text[: len(text) - half] + after[:half]
        own, changed = brute(text), brute(edit)
        out.append((i, sized(text), sized(edit), tuple(own), tuple(changed), like(own, changed), like(own, brute(after))))
    return Counter(out)


def rows_of(df):
    return Counter(
        (r[0], tuple(r[1]), tuple(r[2]), tuple(map(tuple, r[3])), tuple(map(tuple, r[4])), r[5], r[6]) for r in df.collect()
    )


def varied(n, seed=7):
    draw = random.Random(seed)
    vocabulary = ["a", "be", "sea", "dusk", "日本語", "né", "ไทย", "x" * 40]
    return [" ".join(draw.choices(vocabulary, k=draw.choice([0, 1, 4, 5, 6, 11, 12, 13, 40, 300]))) for _ in range(n)]


def test_fingerprints_equal_every_window(spark):
    texts = varied(60) + [text for _, text in TEXTS]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for words, window in ((5, 8), (1, 1), (3, 5), (2, 16)):
        got = {r["doc_id"]: list(map(tuple, r["fingerprint"])) for r in fingerprints(table, words, window).collect()}
        assert got == {i: brute(text, words, window) for i, text in enumerate(texts)}


def test_repeated_words_choose_the_rightmost(spark):
    got = spark.range(1).select(fingerprint(F.lit("same " * 30)).alias("f")).first()["f"]
    assert [p["position"] for p in got] == list(range(7, 26))
    assert len({p["hash"] for p in got}) == 1


def test_a_shared_passage_of_twelve_words_is_always_met(spark):
    draw = random.Random(5)
    passage = [f"p{n}" for n in range(12)]
    pairs = []
    for n in range(80):
        left, right = ([f"{side}{draw.random()}" for _ in range(draw.randrange(60))] for side in "lr")
        a, b = draw.randrange(len(left) + 1), draw.randrange(len(right) + 1)
        pairs.append((" ".join(left[:a] + passage + left[a:]), " ".join(right[:b] + passage + right[b:])))
    table = spark.createDataFrame(pairs, "a string, b string")
    hashes = [F.transform(fingerprint(F.col(c)), lambda p: p["hash"]) for c in "ab"]
    assert table.filter(~F.arrays_overlap(*hashes)).count() == 0


def test_rows_equal_brute_force(spark):
    # Rows that repeat an id stand in the order of their texts' hashes: here each id once.
    own, seen = [], set()
    for i, text in TEXTS:
        if i not in seen:
            own.append((i, text))
            seen.add(i)
    own += list(enumerate(varied(200), start=100))
    assert rows_of(edited_likeness(documents(spark, own))) == brute_rows(own)


def test_repeated_ids_copies_and_nulls_keep_their_rows(spark):
    got = edited_likeness(documents(spark))
    assert got.count() == len(TEXTS)
    texts = {r["doc_id"]: r["text"]["chars"] for r in got.collect() if r["doc_id"] in (5, 6)}
    assert set(texts.values()) == {len(LONG)}


def test_a_hot_id_is_cut_into_ranges(spark):
    texts = [(n if n % 3 else 1_000_000, f"text {n % 50} of some more words than five or six") for n in range(900)]
    assert edited_likeness(documents(spark, texts)).count() == 900
    copies = [(1, "the same words again and again")] * 400
    rows = edited_likeness(documents(spark, copies)).collect()
    assert len(rows) == 400 and {r["near_next"] for r in rows} == {1.0}


def test_one_document_and_none(spark):
    one = [(4, "a text of seven words in all")]
    assert rows_of(edited_likeness(documents(spark, one))) == brute_rows(one)
    assert edited_likeness(documents(spark).limit(0)).count() == 0


def test_fingerprints_need_no_python(spark):
    plan = physical(fingerprints(documents(spark), 5, 8))
    assert "Python" not in plan and "Arrow" not in plan
