"""Find repeated keys with a Bloom filter, so that only they are shuffled."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.common import stored

#: Bits of the filter for each key that it has to tell apart: of keys that occur
#: once well below one in a hundred is flagged, however many there are.
BITS_PER_KEY = 64
#: Words of the filter that are broadcast; with more it is joined by shuffling.
BROADCAST_WORDS = 1 << 20
#: A key with more than this share of the rows is looked up by broadcast; there
#: can be no more such keys than its inverse.
HOT_SHARE = 1000


def filter_bits(keys: int) -> int:
    """Bits of a filter for so many keys: a power of two."""
    return 1 << max(16, (BITS_PER_KEY * max(keys, 1) - 1).bit_length())


@dataclass(frozen=True)
class RepeatFilter:
    """The words of a Bloom filter that have a bit: (word, mask), ``size`` of them."""

    words: DataFrame
    bits: int
    size: int


def _word(key: str, bits: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key), F.lit(0)), F.lit(max(bits // 64, 1)))


def _two_bits(key: str) -> tuple[Column, Column]:
    """Two different bits of a key's word."""
    drawn = F.xxhash64(F.col(key), F.lit(1))
    first = F.pmod(drawn, F.lit(64))
    return first, F.pmod(first + 1 + F.pmod(F.shiftright(drawn, 6), F.lit(63)), F.lit(64))


def repeat_filter(keys: DataFrame, key: str, bits: int | None = None, least: int = 2) -> RepeatFilter:
    """First pass: a bit for each slot that was hit ``least`` times.

    Every key hits two slots of one word. The number of slots follows the number
    of keys, unless ``bits`` sets it; what is kept are the words that have a bit,
    so the filter is as large as the repeats are many. Slots are counted on the
    map side before they are shuffled, eight bytes each. An empty table gives an
    empty filter.
    """
    if bits is None:
        bits = filter_bits(keys.count())
    word = _word(key, bits)
    slots = keys.select(F.explode(F.array(*[word * 64 + bit for bit in _two_bits(key)])).alias("slot"))
    often = slots.groupBy("slot").agg(F.count("*").alias("hits")).filter(F.col("hits") >= least)
    bit = F.expr("shiftleft(1L, cast(slot & 63 as int))")
    words = often.groupBy(F.shiftright("slot", 6).alias("word")).agg(F.bit_or(bit).alias("mask"))
    words = stored(words, "repeat-filter")
    return RepeatFilter(words, bits, words.count())


def maybe_repeated(df: DataFrame, key: str, words: RepeatFilter, flag: str) -> DataFrame:
    """Second pass: ``df`` with ``flag``, false only for keys that surely occur once.

    The words are broadcast up to ``BROADCAST_WORDS``. Where more keys repeat,
    both sides are cut by ranges of the word and joined range by range.
    """
    side = words.words.select(F.col("word").alias(f"{flag}_w"), F.col("mask").alias(f"{flag}_m"))
    if words.size <= BROADCAST_WORDS:
        side = F.broadcast(side)
    probed = df.withColumn(f"{flag}_p", _word(key, words.bits))
    probed = probed.join(side, F.col(f"{flag}_p") == F.col(f"{flag}_w"), "left")
    hit = F.lit(True)
    for bit in _two_bits(key):
        hit = hit & (F.getbit(f"{flag}_m", bit.cast("int")) == 1)
    return probed.withColumn(flag, F.coalesce(hit, F.lit(False))).drop(f"{flag}_w", f"{flag}_m", f"{flag}_p")


def join_hot(left: DataFrame, groups: DataFrame, key: str, size: str, rows: int) -> DataFrame:
    """``left`` with its row of ``groups`` (one per key), however uneven the keys are.

    Keys with more than 1/1000 of the ``rows`` counted in ``size`` are at most
    1000; they are broadcast, and only the others are shuffled.
    """
    hot = groups.filter(F.col(size) * HOT_SHARE > rows)
    cold = groups.filter(F.col(size) * HOT_SHARE <= rows)
    marked = left.join(
        F.broadcast(hot.select(key).withColumn("_hot", F.lit(True))), key, "left"
    )
    by_broadcast = left.join(F.broadcast(hot), key)
    by_shuffle = marked.filter(F.col("_hot").isNull()).drop("_hot").join(cold, key)
    return by_broadcast.unionByName(by_shuffle)


def drop_rows(docs: DataFrame, keys: Mapping[str, Column], gone: DataFrame) -> DataFrame:
    """``docs`` without the rows whose ``keys`` are in ``gone``, all columns kept; nulls match nulls.

    Rows that miss a Bloom filter of the keys that go are not shuffled.
    """
    names = docs.columns
    marked = docs.select(
        F.struct(*[F.col(f"`{n}`") for n in names]).alias("row"),
        *[column.alias(name) for name, column in keys.items()],
    )
    key = F.xxhash64(*[F.col(name) for name in keys])
    gone = stored(gone.select(*keys).withColumn("_key", key), "gone")
    words = repeat_filter(gone, "_key", least=1)
    flagged = maybe_repeated(marked.withColumn("_key", key), "_key", words, "_maybe")
    sure = flagged.filter(~F.col("_maybe")).select("row.*")
    left, right = flagged.filter("_maybe").alias("l"), gone.alias("r")
    same = F.col("l._key") == F.col("r._key")
    for name in keys:
        same = same & F.col(f"l.{name}").eqNullSafe(F.col(f"r.{name}"))
    return sure.unionByName(left.join(right, same, "left_anti").select("row.*"))
