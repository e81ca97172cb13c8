from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import pytest
from llm.nasty import TEXTS, documents
from pyspark.sql import functions as F

from lakestrata.llm.exact_dedup import dedup_documents, exact_classes
from lakestrata.llm.repeats import drop_rows, join_hot, maybe_repeated, repeat_filter
from lakestrata.llm.shards import shard_by_bytes


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def brute_classes(texts):
    groups = {}
    for i, text in texts:
        groups.setdefault(normal(text), []).append(i)
    out = []
    for text, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        digest = hashlib.sha256(text.encode()).hexdigest()
        kept = Counter()
        for i in ids:
            kept[i] += 1
            out.append((i, keep, len(ids), i == keep and kept[i] == 1, digest))
    return Counter(out)


def test_classes_equal_brute_force(spark):
    got = Counter(tuple(r) for r in exact_classes(documents(spark)).collect())
    assert got == brute_classes(TEXTS)


def test_a_tiny_filter_changes_nothing(spark):
    got = Counter(tuple(r) for r in exact_classes(documents(spark), bits=64).collect())
    assert got == brute_classes(TEXTS)


def test_hot_group(spark):
    texts = [(n, "copy" if n % 3 else f"text {n}") for n in range(3000)]
    got = Counter(tuple(r) for r in exact_classes(documents(spark, texts)).collect())
    assert got == brute_classes(texts)


def test_documents_that_stay_keep_their_columns(spark):
    docs = documents(spark)
    left = dedup_documents(docs)
    assert left.schema == docs.schema
    rows = left.collect()
    assert len(rows) == len({normal(t) for _, t in TEXTS})
    by_text = {}
    for i, text in TEXTS:
        by_text.setdefault(normal(text), []).append(i)
    for row in rows:
        ids = by_text[normal(row["text"])]
        assert row["doc_id"] == min((i for i in ids if i is not None), default=None)


def test_empty_table(spark):
    empty = documents(spark).limit(0)
    assert exact_classes(empty).count() == 0
    assert dedup_documents(empty).count() == 0
    assert shard_by_bytes(empty).count() == 0


def test_unrepeated_rows_miss_the_filter(spark):
    keys = spark.range(10_000).select((F.col("id") % 9_000).cast("string").alias("k"))
    words = repeat_filter(keys, "k")
    flagged = maybe_repeated(keys, "k", words, "f").filter("f").count()
    assert 2_000 <= flagged < 2_100


@pytest.mark.parametrize("rows", [3_000, 30_000, 300_000])
def test_the_filter_grows_with_the_rows(spark, rows):
    """Of keys that occur once less than one in a hundred is flagged, of repeated ones all."""
    keys = spark.range(rows).select(F.when(F.col("id") % 10 == 0, F.col("id") % 100).otherwise(F.col("id")).alias("k"))
    words = repeat_filter(keys, "k")
    flagged = maybe_repeated(keys, "k", words, "f").groupBy(F.col("k") < 100, "f").count().collect()
    counts = {(r[0], r[1]): r[2] for r in flagged}
    assert counts.get((False, True), 0) < 0.01 * rows
    assert words.bits >= 64 * rows and words.size < 20 + 0.1 * rows
    repeated = keys.groupBy("k").count().filter("count > 1").select("k")
    assert maybe_repeated(keys.join(repeated, "k"), "k", words, "f").filter("not f").isEmpty()


def test_a_filter_too_large_to_broadcast_is_joined(spark, monkeypatch):
    texts = [(n, "copy" if n % 3 else f"text {n % 500}") for n in range(1500)]
    monkeypatch.setattr("lakestrata.llm.repeats.BROADCAST_WORDS", 3)
    got = Counter(tuple(r) for r in exact_classes(documents(spark, texts)).collect())
    assert got == brute_classes(texts)
    keys = spark.range(100).select((F.col("id") % 40).alias("k"))
    plan = maybe_repeated(keys, "k", repeat_filter(keys, "k"), "f")._jdf.queryExecution().logical().toString()
    assert "broadcast" not in plan


def test_join_hot_is_an_inner_join(spark):
    left = spark.range(5000).select(F.when(F.col("id") < 2000, 0).otherwise(F.col("id")).alias("k"), "id")
    groups = left.groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("top"))
    got = join_hot(left, groups, "k", "n", 5000)
    assert got.count() == 5000
    assert got.filter("k = 0 and top = 1999").count() == 2000


def test_drop_rows_matches_nulls(spark):
    docs = documents(spark)
    gone = spark.createDataFrame([(None, 1), (1, 1)], "doc_id long, other int")
    left = drop_rows(docs, {"doc_id": F.col("doc_id"), "other": F.lit(1)}, gone)
    assert left.schema == docs.schema
    assert left.count() == sum(i not in (None, 1) for i, _ in TEXTS)


def test_shards_are_contiguous_and_balanced(spark):
    rows = shard_by_bytes(documents(spark), 4).collect()
    sizes = Counter(len((t or "").encode()) + 1 for _, t in TEXTS)
    assert Counter(r["size"] for r in rows) == sizes
    assert Counter(r["text_crc32"] for r in rows) == Counter(zlib.crc32((t or "").encode()) for _, t in TEXTS)
    last = None
    for shard in range(4):
        own = sorted((r["slot"], r["doc_id"] if r["doc_id"] is not None else 1 << 60) for r in rows if r["shard"] == shard)
        assert [slot for slot, _ in own] == list(range(len(own)))
        assert [i for _, i in own] == sorted(i for _, i in own)
        if own:
            assert last is None or last <= own[0][1]
            last = own[-1][1]


def test_even_rows_make_even_shards(spark):
    texts = [(n, "x" * (n % 7)) for n in range(4000)]
    rows = shard_by_bytes(documents(spark, texts), 8).groupBy("shard").agg(F.sum("size").alias("b")).collect()
    assert len(rows) == 8
    assert max(r["b"] for r in rows) - min(r["b"] for r in rows) <= 14
