"""Spans around one anchor, told apart by a digest of 128 bits."""

from __future__ import annotations

import random

import xxhash
from llm.nasty import documents
from llm.test_suffix import brute, found

from lakestrata.llm import suffix_dedup


def test_half_a_digest_may_lie(spark, monkeypatch):
    class Lying:
        """A short hash of which all values collide, as have the two halves of the long one in turn."""

        def __init__(self, half):
            self.half = half

        def xxh3_64_intdigest(self, data):
            return 1

        def xxh3_128_digest(self, data):
            digest = xxhash.xxh3_128_digest(data)
            return bytes(8) + digest[8:] if self.half else digest[:8] + bytes(8)

    pick = random.Random(8)
    shared = "".join(pick.choices("abcdef", k=30))
    texts = [(n, "".join(pick.choices("abcdef", k=40)) + shared + "".join(pick.choices("abcdef", k=40))) for n in range(30)]
    texts += [(100, texts[0][1]), (101, texts[1][1] * 2)]
    for half in (0, 1):
        monkeypatch.setattr(suffix_dedup, "xxhash", Lying(half))
        df = suffix_dedup.remove_repeats(documents(spark, texts), passage=20, width=7)
        assert found(df) == brute(texts, 20)
