from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.nasty import TEXTS, documents

from lakestrata.llm.suffix_dedup import Suffixes, remove_repeats


def brute(texts, passage):
    raw = [(t or "").encode() for _, t in texts]
    seen = Counter(t[i : i + passage] for t in raw for i in range(len(t) - passage + 1))
    out = []
    for (doc, _), t in zip(texts, raw, strict=True):
        gone = bytearray(len(t))
        for i in range(len(t) - passage + 1):
            if seen[t[i : i + passage]] > 1:
                gone[i : i + passage] = b"\1" * passage
        edges = np.flatnonzero(np.diff(np.r_[0, np.frombuffer(bytes(gone), np.uint8), 0].astype(int))).tolist()
        spans = tuple(zip(edges[::2], edges[1::2], strict=True))
        out.append((doc, len(t), spans, bytes(c for c, g in zip(t, gone, strict=True) if not g)))
    return Counter(out)


def found(df):
    return Counter(
        (r["doc_id"], r["n_bytes"], tuple((s["start"], s["end"]) for s in r["spans"]), bytes(r["kept"])) for r in df.collect()
    )


@pytest.mark.parametrize("largest", [2, 1 << 14])
@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed, largest):
    pick = random.Random(seed)
    parts = ["".join(pick.choices("abc", k=pick.randint(5, 40))) for _ in range(12)]
    texts = [(n, "".join(pick.choices(parts, k=pick.randint(0, 6))) + "".join(pick.choices("abcd", k=8))) for n in range(120)]
    texts += [(500, "a" * 90), (501, "ab" * 60), (502, texts[3][1]), (503, texts[3][1])]
    df = remove_repeats(documents(spark, texts), passage=20, width=7, largest_group=largest)
    assert found(df) == brute(texts, 20)


def test_whole_passages_and_odd_rows(spark):
    assert found(remove_repeats(documents(spark))) == brute(TEXTS, 200)


def test_a_text_in_pieces(spark, monkeypatch):
    monkeypatch.setattr("lakestrata.llm.suffix_dedup._PIECE", 64)
    pick = random.Random(5)
    text = "".join(pick.choices("ab", k=700))
    texts = [(1, text), (2, text[100:400] + "c" + text[450:600]), (3, "abab" * 50)]
    assert found(remove_repeats(documents(spark, texts), passage=20, width=7)) == brute(texts, 20)


def test_empty_table(spark):
    assert remove_repeats(documents(spark).limit(0)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.binary(max_size=12)), min_size=1, max_size=40), st.booleans())
def test_merge_sort_is_a_suffix_sort(rows, lie):
    rows.sort(key=lambda r: r[0])
    group, strings = np.array([g for g, _ in rows]), [s for _, s in rows]
    sorter = Suffixes(group, strings, 12)
    if lie:
        sorter.prefix[:] = 0  # every hash collides: the check must notice
    order, shared = sorter.sorted()
    assert [rows[n] for n in order] == sorted(rows)
    for k in range(1, len(rows)):
        (g, a), (h, b) = rows[order[k - 1]], rows[order[k]]
        common = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
        assert shared[k] == (common if g == h else -1)
