"""Words of few toxic texts in the lexicon."""

from __future__ import annotations

import random
import zlib

from llm.nasty import documents

from lakestrata.llm.toxicity import mine_lexicon, toxicity

INSULTS = ["gronk", "zorbling", "splunge", "frabtwit"]


def words(pick, letters, count):
    return ["".join(pick.choices(letters, k=pick.randint(4, 8))) for _ in range(count)]


def test_toxic_texts_of_a_small_language_are_found(spark):
    pick = random.Random(4)
    large, small = words(pick, "abcdefgh", 900), words(pick, "mnopqrst", 300)
    texts, toxic, rare = [], {}, set()
    for n in range(18_000):
        toxic[n] = int(n % 3 == 0)
        ours = pick.choices(small if n % 120 < 2 else large, k=pick.randint(5, 30))
        if n % 120 == 0 and n % 360 == 0:
            ours.insert(2, "vixyk")
            rare.add(n)
        elif toxic[n]:
            ours.insert(2, pick.choice(INSULTS))
        texts.append((n, " ".join(ours)))
    assert len(rare) < 0.01 * sum(toxic.values())
    labels = spark.createDataFrame([(n, 1, t) for n, t in toxic.items()], "doc_id long, quality int, toxic int")
    rows = {r["doc_id"]: r["predicted"] for r in toxicity(documents(spark, texts), labels).collect()}
    held_out = {n for n in toxic if zlib.crc32(str(n).encode()) % 3 == 1}
    assert rare & held_out and all(rows[n] == 1 for n in rare)
    assert sum(rows[n] != toxic[n] for n in held_out) <= 0.01 * len(held_out)


def test_rare_words_that_chance_spreads_are_no_marks(spark):
    pick = random.Random(6)
    some = ["q" + w for w in words(pick, "abcdefghijklmnop", 20_000)]
    rows = [(n % 2, " ".join(pick.choices(some, k=60)) + (" gronk" if n % 2 else "")) for n in range(4000)]
    lexicon = mine_lexicon(spark.createDataFrame(rows, "toxic int, text string"))
    assert [name.rstrip("$") for name in lexicon] == ["gronk"[: len(name.rstrip("$"))] for name in lexicon] and len(lexicon) == 1


def test_a_full_lexicon_covers_all_toxic_texts(spark):
    rows = [(0, f"plain text {n}") for n in range(1200)]
    for k in range(28):
        marks = " ".join(f"{chr(97 + k)}{chr(97 + j)}zzzzz" for j in range(20)) if k < 26 else f"rare{chr(97 + k % 26)}"
        rows += [(1, f"plain text {n} {marks}") for n in range(60 if k < 26 else 25)]
    lexicon = mine_lexicon(spark.createDataFrame(rows, "toxic int, text string"), size=30)
    entries = {name.rstrip("$") for name in lexicon}
    toxic = [text for label, text in rows if label]
    assert len(lexicon) == 30 and all(any(w.startswith(e) for w in text.split() for e in entries) for text in toxic)
