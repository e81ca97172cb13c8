from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.nasty import TEXTS, documents

from lakestrata.llm import decontaminate
from lakestrata.llm.decontaminate import Items, contaminated, covered, drop_contaminated, tiles, tiles_of_runs, tokens

ITEM = "the quick brown fox jumps over the lazy dog while seven wizards mix bitter potions under a pale winter moon"


def items(spark, rows):
    table = [(i, t, f"x{n}") for n, (i, t) in enumerate(rows)]
    return spark.createDataFrame(table, "item_id long, text string, doc_id string")


def plain_tiles(doc, item, width):
    """Greedy string tiling as defined: look at every pair of places, again for each tile."""
    doc, item = list(doc), list(item)
    marked_doc, marked_item, out = [False] * len(doc), [False] * len(item), []
    while True:
        best = (0, 0, 0)
        for d in range(len(doc)):
            for i in range(len(item)):
                n = 0
                while (
                    d + n < len(doc) and i + n < len(item) and doc[d + n] and doc[d + n] == item[i + n]
                    and not marked_doc[d + n] and not marked_item[i + n]
                ):
                    n += 1
                if n >= width and n > best[0]:
                    best = (n, d, i)
        if not best[0]:
            return out
        n, d, i = best
        marked_doc[d : d + n] = [True] * n
        marked_item[i : i + n] = [True] * n
        out.append(best)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=24), st.lists(st.integers(1, 3), min_size=2, max_size=14))
def test_tiles_equal_plain_tiling(doc, item):
    doc, item = np.array(doc, np.int64), np.array(item, np.int64)
    places = [
        (d, i) for d in range(len(doc) - 1) for i in range(len(item) - 1) if doc[d] and doc[d + 1] and (doc[d : d + 2] == item[i : i + 2]).all()
    ]
    in_doc, in_item = (np.array([p[k] for p in places], np.int64) for k in (0, 1))
    assert tiles(doc, item, in_doc, in_item, 2) == plain_tiles(doc, item, 2)


def test_a_seed_of_equal_hash_only_is_dropped():
    doc, item = np.array([1, 2, 3]), np.array([4, 5, 6])
    assert tiles(doc, item, np.array([0]), np.array([0]), 2) == []


def test_reordered_passage_is_found():
    words = tokens(ITEM)
    parts = [words[k : k + 5] for k in range(0, len(words), 5)]
    random.Random(1).shuffle(parts)
    text = "before it " + " and then ".join(" ".join(p) for p in parts)
    (hit,) = covered(text, Items([(7, ITEM)]), 0.6)
    assert hit[0] == 7 and hit[2] == len(words) and hit[3] >= 3


def test_a_few_words_are_no_match():
    assert not list(covered("a fox jumps over the lazy dog in a song", Items([(7, ITEM)]), 0.6))


@pytest.mark.parametrize("broadcast_bytes", [60, 1 << 20])
def test_documents(spark, broadcast_bytes):
    texts = [*TEXTS, (50, "x " * 30 + ITEM.upper() + "!"), (51, ITEM.replace("fox", "cat")), (None, ITEM), (52, "so " + "short one")]
    tests = [(1, ITEM), (2, "short one"), (3, None), (4, " . "), (None, ITEM), (1, ITEM)]
    found = contaminated(documents(spark, texts), items(spark, tests), broadcast_bytes=broadcast_bytes).collect()
    pairs = sorted((r["doc_id"] or -1, r["item_id"] or -1, round(r["coverage"], 2)) for r in found)
    n = len(tokens(ITEM))
    near = round((n - 4) / n, 2)  # three words before the changed one are too few for a tile
    whole = [(d, i, c) for d, c in ((-1, 1.0), (50, 1.0), (51, near)) for i in (-1, 1, 1)]
    assert pairs == sorted([*whole, (52, 2, 1.0)])


def test_contaminated_documents_go(spark):
    texts = [*TEXTS, (50, "x " * 30 + ITEM), (None, ITEM)]
    docs = documents(spark, texts)
    left = drop_contaminated(docs, items(spark, [(1, ITEM)]))
    assert left.schema == docs.schema
    assert left.count() == len(TEXTS)
    assert drop_contaminated(docs, items(spark, []).limit(0)).count() == len(texts)
    assert contaminated(docs.limit(0), items(spark, [(1, ITEM)])).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=24), st.lists(st.integers(1, 3), min_size=2, max_size=14), st.integers(2, 4))
def test_run_by_run_equals_plain_tiling(doc, item, width):
    doc, item = np.array(doc, np.int64), np.array(item, np.int64)
    assert tiles_of_runs(doc, item, width) == plain_tiles(doc, item, width)


@pytest.mark.parametrize("words", [["w"], ["a", "b"], ["a", "a", "b", "c", "a"]])
def test_texts_that_repeat_themselves_give_the_same_either_way(monkeypatch, words):
    text, own = " ".join(words * 60), Items([("x", " ".join((words * 9)[:25]))])
    listed = list(covered(text, own, 0.6))
    monkeypatch.setattr(decontaminate, "MOST_PAIRS", 0)
    assert list(covered(text, own, 0.6)) == listed and listed


def test_a_million_equal_words_stay_in_memory():
    own = Items([("long", "same " * 1000), ("other", "same other " * 500)])
    tracemalloc.start()
    found = list(covered("same " * 1_000_000, own, 0.6))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == [("long", 1000, 1000, 1, 1000)]
    assert peak < 400 << 20


def test_joined_seeds_find_what_the_broadcast_items_find(spark):
    draw = random.Random(12)
    words = [f"w{n}" for n in range(300)]
    tests = [(n, " ".join(draw.choices(words, k=draw.choice([1, 3, 5, 20, 60])))) for n in range(60)]
    texts = []
    for n in range(150):
        parts = [" ".join(draw.choices(words, k=draw.randrange(40)))]
        for _, item in draw.sample(tests, 2):
            cut = item.split()
            parts.append(" ".join(cut[: draw.randrange(len(cut) + 1)]))
        draw.shuffle(parts)
        texts.append((n, " ".join(parts)))
    either = [
        sorted(map(tuple, contaminated(documents(spark, texts), items(spark, tests), broadcast_bytes=b).collect()))
        for b in (0, 1 << 20)
    ]
    assert either[0] == either[1] and len(either[0]) > 50
