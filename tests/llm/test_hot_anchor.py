"""A passage that very many texts share."""

from __future__ import annotations

import random

import pytest
from llm.nasty import documents
from llm.test_suffix import brute, found
from pyspark.sql import functions as F

from lakestrata.llm import suffix_dedup


def texts_with(shared, pick, count=400):
    texts = []
    for n in range(count):
        ends = ["".join(pick.choices("abcdef", k=pick.choice([0, 3, 45]))) for _ in range(2)]
        texts.append((n, ends[0] + (shared if n % 3 else "") + ends[1]))
    return texts + [(1000, texts[1][1]), (1001, texts[1][1]), (1002, texts[2][1] * 3)]


@pytest.mark.parametrize("share", [1, 7, 1000])
def test_equals_brute_force(spark, monkeypatch, share):
    pick = random.Random(share)
    texts = texts_with("".join(pick.choices("abcdef", k=60)), pick)
    monkeypatch.setattr(suffix_dedup._repeats, "__defaults__", (share,))
    assert found(suffix_dedup.remove_repeats(documents(spark, texts), passage=20, width=7)) == brute(texts, 20)


def test_spans_of_a_hot_anchor_are_counted_before_the_shuffle(spark, monkeypatch):
    # Copies of a long passage between ends of their own: the inner anchors have one span in all texts.
    pick = random.Random(2)
    texts = texts_with("".join(pick.choices("abcdef", k=200)), pick, 900)
    shuffles = []
    stored = suffix_dedup.stored

    def look(df, purpose, *more):
        if purpose == "suffix-repeats":
            # One by anchor for the rows of other anchors, one for one row of each span.
            shuffles.append(df._jdf.queryExecution().optimizedPlan().toString().count("RepartitionByExpression"))
        return stored(df, purpose, *more)

    monkeypatch.setattr(suffix_dedup, "stored", look)
    rows = suffix_dedup.remove_repeats(documents(spark, texts), passage=20, width=7)
    assert found(rows) == brute(texts, 20) and shuffles == [2]
