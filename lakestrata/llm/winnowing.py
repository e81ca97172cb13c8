"""Winnowed fingerprints of texts, and how like its neighbour or an edited copy a text is."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakestrata.llm.common import stored, whole

# A word: one character of a script written without spaces, or a run of others.
_ALONE = r"\x{0E00}-\x{0EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{2E80}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{3FFFF}"
WORD = rf"[{_ALONE}]|[^\x20\x09-\x0D{_ALONE}]+"
#: The rolling hash is a polynomial in BASE modulo a prime below 2**37 over the words' checksums.
BASE, PRIME = 1_000_003, (1 << 37) - 25
#: Bits for a place of a text beside its hash in a long.
PLACE_BITS = 26
#: Ranges of ids that neighbours are looked for in; their bounds come to the driver.
MOST_RANGES = 16_384


def _named(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once and handed on by reference."""
    return F.transform(F.array(value), use)[0]


def _full(values: Column, span: int) -> Column:
    """The values that begin a whole span; the first alone where there are too few for one."""

    def cut(v: Column) -> Column:
        return F.slice(v, 1, F.least(F.size(v), F.greatest(F.size(v) - (span - 1), F.lit(1))))

    return _named(values, cut)


def _smaller(values: Column, ahead: int) -> Column:
    """Each value or the one ``ahead`` of it, whichever is smaller."""
    return F.zip_with(values, F.slice(values, ahead + 1, F.size(values)), lambda a, b: F.least(a, b))


def fingerprint(text: Column, words: int = 5, window: int = 8) -> Column:
    """The winnowed fingerprint of a text: array<struct<hash, position>> in the order of the text.

    Every run of ``words`` words gets a rolling hash, of every ``window``
    neighbouring hashes the smallest is chosen, the rightmost of equal ones, and
    each choice is kept once with the place (in words, from 0) where its run
    begins. So any ``words + window - 1`` words that two texts share give them a
    common hash, and nothing shorter than ``words`` does. A text with fewer
    words is one run, with fewer runs than a window one window; a text without
    words, or null, has an empty fingerprint.

    Hashes and minima of all places are made by passes over whole arrays: each
    pass of the hash rolls one more word in, each of the minima doubles its
    reach. A place stands inverted below its hash, so that the least long is the
    rightmost of the least hashes.
    """
    last = (1 << PLACE_BITS) - 1
    zero = F.lit(0).cast("long")

    def chosen(symbols: Column) -> Column:
        hashes = symbols
        for ahead in range(1, words):
            later = F.slice(symbols, ahead + 1, F.size(symbols))
            hashes = F.zip_with(hashes, later, lambda h, s: (h * F.lit(BASE).cast("long") + F.coalesce(s, zero)) % F.lit(PRIME))
        least = F.transform(_full(hashes, words), lambda h, place: h * (last + 1) + (last - place))
        reach = 1
        while reach < window:
            step = min(reach, window - reach)
            least = _named(least, lambda m: _smaller(m, step))
            reach += step
        return F.array_distinct(_full(least, window))

    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))
    symbols = F.transform(found, lambda word: F.crc32(word.cast("binary")))
    return F.transform(
        _named(symbols, chosen),
        lambda m: F.struct(
            F.shiftright(m, PLACE_BITS).alias("hash"), (F.lit(last) - m % (last + 1)).cast("int").alias("position")
        ),
    )


def likeness(left: Column, right: Column) -> Column:
    """The share of the hashes of two fingerprints that both have; 1 where both are empty."""
    a, b = (F.transform(prints, lambda p: p["hash"]) for prints in (left, right))
    every = F.size(F.array_union(a, b))
    return F.when(every == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / every)


def fingerprints(
    docs: DataFrame, words: int = 5, window: int = 8, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id and ``fingerprint`` of every document; one projection, nothing is shuffled."""
    prints = fingerprint(whole(text_col), words, window)
    return docs.select(F.col(id_col).alias("doc_id"), prints.alias("fingerprint"))


def edited(own: Column, other: Column) -> Column:
    """``own`` with its last half (rounded down) replaced by as much of the start of ``other``."""
    half = F.floor(F.char_length(own) / 2).cast("int")
    return F.concat(F.substr(own, F.lit(1), F.char_length(own) - half), F.substr(other, F.lit(1), half))


def edited_likeness(
    docs: DataFrame,
    words: int = 5,
    window: int = 8,
    id_col: str = "doc_id",
    text_col: str = "text",
    shown: Callable[[Column], Column] = lambda prints: prints,
) -> DataFrame:
    """Every document beside its edited text and the next document.

    doc_id, text and edited_text (whose last half is the start of the next
    document), each as its characters and SHA-256 so that no text is written
    again, fingerprint and edited_fingerprint (as ``shown`` makes them of
    ``fingerprint``), near_edited and near_next (``likeness`` of the document's
    fingerprint to each). A null text is empty.

    The next document is that with the next smaller id; null ids come last, equal
    ids in falling order of a hash of their texts, and the last document is
    followed by the first. Rows that repeat id and text follow one another. One
    document follows itself, an empty table gives no rows. Other columns are not
    looked at.

    Texts are shuffled once, into ranges of ids with about equal numbers of rows
    (a repeated id is cut too), fingerprinted there, and met with their neighbour
    by a window inside the range. What crosses a range, one text of each, is
    joined afterwards.
    """

    def result(row: dict[str, Column]) -> Column:
        edit = edited(row["text"], row["next_text"])

        def beside(edit: Column) -> Column:
            def told(prints: Column) -> Column:
                return F.struct(
                    _sized(row["text"]).alias("text"),
                    _sized(edit).alias("edited_text"),
                    shown(row["prints"]).alias("fingerprint"),
                    shown(prints).alias("edited_fingerprint"),
                    likeness(row["prints"], prints).alias("near_edited"),
                    likeness(row["prints"], row["next_prints"]).alias("near_next"),
                )

            return _named(fingerprint(edit, words, window), told)

        return _named(edit, beside)

    keyed = docs.select(
        F.struct(
            F.col(id_col).alias("doc_id"),
            F.xxhash64(whole(text_col)).alias("hash"),
            F.monotonically_increasing_id().alias("row"),
        ).alias("key"),
        whole(text_col).alias("text"),
    )
    ranged, ranges = _ranged(keyed)
    # Ids rise inside the window, so the next smaller one is the row before.
    near = Window.partitionBy("range").orderBy("key")
    first, last = F.lag(F.lit(False), 1, True).over(near), F.lead(F.lit(False), 1, True).over(near)
    met = (
        ranged.repartitionById(ranges, F.col("range"))
        .withColumn("prints", fingerprint(F.col("text"), words, window))
        .select(
            "range",
            F.col("key.doc_id").alias("doc_id"),
            "text",
            "prints",
            F.lag("text").over(near).alias("next_text"),
            F.lag("prints").over(near).alias("next_prints"),
            first.alias("first"),
            last.alias("last"),
        )
    )
    own = {name: F.col(name) for name in ("text", "prints", "next_text", "next_prints")}
    ends = F.col("first") | F.col("last")
    met = met.select(
        "range",
        "doc_id",
        "first",
        "last",
        *[F.when(ends, F.col(name)).alias(f"end_{name}") for name in ("text", "prints")],
        F.when(~F.col("first"), result(own)).alias("told"),
    )
    met = stored(met, "winnowed")
    inside = met.filter(~F.col("first")).select("doc_id", "told.*")

    before = met.filter("last").select(
        F.col("range").alias("of"), F.col("end_text").alias("next_text"), F.col("end_prints").alias("next_prints")
    )
    # One row per range: the range before it that has rows, for the lowest the highest.
    order = Window.orderBy("range")
    every = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    follow = met.filter("last").select(
        "range", F.coalesce(F.lag("range").over(order), F.max("range").over(every)).alias("of")
    )
    ends = met.filter("first").withColumnsRenamed({"end_text": "text", "end_prints": "prints"}).drop("told")
    across = ends.join(follow, "range").join(before, "of").withColumn("told", result(own))
    return inside.unionByName(across.select("doc_id", "told.*"))


def _sized(text: Column) -> Column:
    return F.struct(F.char_length(text).cast("long").alias("chars"), F.sha2(text.cast("binary"), 256).alias("sha256"))


def _ranged(keyed: DataFrame) -> tuple[DataFrame, int]:
    """``keyed`` with the range of ``key`` that each row is in, and how many ranges there are at most.

    The lower bounds are those that Spark's own range partitioning draws; one
    short row for each, ``MOST_RANGES`` at most, comes to the driver.
    """
    spark = keyed.sparkSession
    ranges = min(int(spark.conf.get("spark.sql.shuffle.partitions")), MOST_RANGES)
    drawn = keyed.select("key").repartitionByRange(ranges, "key").groupBy(F.spark_partition_id()).agg(F.min("key").alias("key"))
    kind = drawn.select(F.array("key").alias("bounds")).schema["bounds"].dataType.simpleString()
    bounds = F.from_json(F.lit(_sorted_json(drawn)), kind)
    # A binary search: from the greatest step down, move on while the bound there is not above the key.
    steps = F.array(*[F.lit(1 << bit) for bit in reversed(range(ranges.bit_length()))])

    def below(key: Column) -> Column:
        return F.aggregate(
            steps, F.lit(0), lambda at, step: F.when(F.get(bounds, at + step - 1) <= key, at + step).otherwise(at)
        )

    return keyed.withColumn("range", _named(F.col("key"), below)), ranges


def _sorted_json(bounds: DataFrame) -> str:
    rows = bounds.select(F.sort_array(F.collect_list("key")).alias("bounds")).select(F.to_json("bounds").alias("json"))
    return rows.first()["json"]
