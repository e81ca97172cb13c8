from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.nasty import TEXTS, documents
from pyspark.sql import functions as F

from lakestrata.llm.components import components
from lakestrata.llm.simhash import bucket_masks, drop_near_duplicates, fingerprint, fingerprint_links, linked, simhash_components


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    runs = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(nodes, close):
    roots = {n: n for n in nodes}

    def root(n):
        while roots[n] != n:
            n = roots[n]
        return n

    for a in nodes:
        for b in nodes:
            if close(a, b):
                roots[root(a)] = root(b)
    return {n: root(n) for n in nodes}


def expected(texts):
    prints = [plain_fingerprint(t) for _, t in texts]
    roots = brute_components(sorted(set(prints)), lambda a, b: (a ^ b).bit_count() <= 3)
    least = {}
    for (i, _), f in zip(texts, prints, strict=True):
        if i is not None:
            least[roots[f]] = min(i, least.get(roots[f], i))
    return Counter((i, f"{f:016x}", least.get(roots[f])) for (i, _), f in zip(texts, prints, strict=True))


@pytest.mark.parametrize("text", [t for _, t in TEXTS] + ["ÀÉ Über", "ONE two", "A b C d E f", "x\x0by\x1cz \x85w"])
def test_fingerprint(text):
    assert fingerprint(text) == plain_fingerprint(text)


def test_native_hash_is_the_same(spark):
    row = spark.range(1).select(F.xxhash64(F.lit("a né b"))).first()
    assert row[0] % (1 << 64) == xxhash.xxh64_intdigest("a né b".encode(), 42)


def test_components_of_documents(spark):
    pick = random.Random(7)
    texts = list(TEXTS)
    for n in range(100, 160):
        words = pick.choices(["one", "two", "three", "four", "five"], k=200)
        texts.append((n, " ".join(words)))
        for k in range(3):
            words[pick.randrange(200)] = "other"
            texts.append((n + 100 * (k + 1), " ".join(words)))
    assert Counter(tuple(r) for r in simhash_components(documents(spark, texts)).collect()) == expected(texts)


def test_masks_lose_no_link():
    for radius in (0, 1, 3, 5):
        masks = bucket_masks(radius)
        pick = random.Random(radius)
        for _ in range(3000):
            flipped = sum(1 << b for b in pick.sample(range(64), radius))
            assert any(flipped & m == 0 for m in masks)


@settings(max_examples=50, deadline=None)
@given(st.integers(0, 6), st.integers(0, 1 << 32))
def test_linked_equals_all_pairs(radius, seed):
    pick = random.Random(seed)
    seeds = [pick.getrandbits(64) for _ in range(6)]
    fps, groups = [], []
    for g in range(5):
        own = set()
        for _ in range(pick.randint(1, 150)):
            f = pick.choice(seeds)
            for b in pick.sample(range(64), pick.randint(0, 4)):
                f ^= 1 << b
            own.add(f)
        fps += sorted(own)
        groups += [g] * len(own)
    a, b = linked(np.array(fps, np.uint64), np.array(groups), radius)
    got = {}
    for g in range(5):
        own = [f for f, k in zip(fps, groups, strict=True) if k == g]
        want = brute_components(own, lambda x, y: (x ^ y).bit_count() <= radius)
        pairs = {(x, y) for x, y in zip(a.tolist(), b.tolist(), strict=True) if x in want and y in want}
        assert all((x ^ y).bit_count() >= 1 for x, y in pairs)
        got = brute_components(own, lambda x, y, pairs=pairs: (x, y) in pairs)
        classes = lambda roots: {frozenset(n for n in roots if roots[n] == r) for r in roots.values()}
        if len(fps) == len(set(fps)):
            assert classes(got) == classes(want)


@pytest.mark.parametrize("block", [16, 4096])
def test_large_buckets_in_blocks(spark, block):
    center = 0x0123456789ABCDEF
    pick = random.Random(1)
    fps = {center} | {center ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(0, 64, 9)}
    fps |= {pick.getrandbits(64) for _ in range(200)}
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    links = fingerprint_links(spark.createDataFrame(signed, "fp long"), 3, block)
    got = {(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in links.collect()}
    want = brute_components(sorted(fps), lambda a, b: (a ^ b).bit_count() <= 3)
    have = brute_components(sorted(fps), lambda a, b: (a, b) in got)
    classes = lambda roots: {frozenset(n for n in roots if roots[n] == r) for r in roots.values()}
    assert classes(have) == classes(want)


@pytest.mark.parametrize("shape", ["path", "star", "random", "empty"])
def test_components_of_graphs(spark, shape):
    pick = random.Random(2)
    edges = {
        "path": [(n, n + 1) for n in range(300)],
        "star": [(0, n) for n in range(1, 2500)],
        "random": [(pick.randrange(400), pick.randrange(400)) for _ in range(250)],
        "empty": [],
    }[shape] + [(9000, 9000), (None, 3)]
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    clean = {(a, b) for a, b in edges if a is not None and a != b}
    nodes = sorted({n for e in clean for n in e})
    near = {n: set() for n in nodes}
    for a, b in clean:
        near[a].add(b)
        near[b].add(a)
    seen, want = set(), set()
    for n in nodes:
        if n in seen:
            continue
        part, todo = set(), [n]
        while todo:
            x = todo.pop()
            if x not in part:
                part.add(x)
                todo += near[x] - part
        seen |= part
        want.add(frozenset(part))
    by_root = {}
    for r in got:
        by_root.setdefault(r["root"], set()).add(r["node"])
    assert {frozenset(p) for p in by_root.values()} == want
    assert all(root in part for root, part in by_root.items())


def test_one_of_each_component_stays(spark):
    docs = documents(spark)
    left = drop_near_duplicates(docs)
    assert left.schema == docs.schema
    ids = {r["doc_id"] for r in left.select("doc_id").collect()}
    assert {1, 2, 5}.issubset(ids) and not {3, 4, 6} & ids
    assert drop_near_duplicates(docs.limit(0)).count() == 0
    assert simhash_components(docs.limit(0)).count() == 0
