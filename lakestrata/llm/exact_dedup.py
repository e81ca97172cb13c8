"""Exact deduplication that shuffles possibly repeated rows only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.common import stored, whole
from lakestrata.llm.repeats import join_hot, maybe_repeated, repeat_filter


def text_digest(text_col: str = "text") -> Column:
    """SHA-256 of the text with each run of ASCII white space put as one space.

    Single spaces stay as they are, so the pattern matches only what changes.
    """
    spaced = F.regexp_replace(whole(text_col), r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]", " ")
    return F.sha2(spaced.cast("binary"), 256)


def exact_classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int | None = None
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are after white space is put as single spaces; a
    null text counts as empty. Of equal texts the row with the smallest id stays;
    of rows that repeat id and text one stays, and a null id stays only where no
    other id has the text. An empty table gives no rows. Other columns are not
    looked at.

    The first pass over the digests sets a Bloom filter of slots hit twice, with
    as many slots as the number of rows asks for unless ``bits`` sets it. Rows
    that miss it pass straight through; the others are counted before they are
    shuffled, and texts never are.
    """
    digests = stored(
        docs.select(F.col(id_col).alias("doc_id"), text_digest(text_col).alias("text_sha256")),
        "exact-digests",
    )
    words = repeat_filter(digests, "text_sha256", bits)
    flagged = maybe_repeated(digests, "text_sha256", words, "_maybe")

    alone = flagged.filter(~F.col("_maybe")).select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        "text_sha256",
    )
    rows = flagged.filter("_maybe").groupBy("text_sha256", "doc_id").agg(F.count("*").alias("copies"))
    rows = stored(rows, "exact-repeats")
    groups = rows.groupBy("text_sha256").agg(
        F.min("doc_id").alias("keep_id"), F.sum("copies").alias("group_size"), F.count("*").alias("ids")
    )
    groups = stored(groups, "exact-groups")
    decided = join_hot(rows, groups, "text_sha256", "ids", rows.count())
    copy = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    together = decided.withColumn("copy", copy).select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
        "text_sha256",
    )
    return alone.unionByName(together)


def dedup_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int | None = None
) -> DataFrame:
    """The documents that stay, with all their columns; of repeated rows any one.

    The classes are those of ``exact_classes``. Texts that surely occur once
    are not shuffled; of a repeated text each task sends one row at most.
    """
    names = docs.columns
    packed = docs.select(
        F.struct(*[F.col(f"`{n}`") for n in names]).alias("row"),
        F.col(id_col).alias("doc_id"),
        text_digest(text_col).alias("text_sha256"),
    )
    words = repeat_filter(packed.select("text_sha256"), "text_sha256", bits)
    flagged = maybe_repeated(packed, "text_sha256", words, "_maybe")
    # Null ids come last: the flag sorts before the id.
    first = F.min_by("row", F.struct(F.col("doc_id").isNull(), F.col("doc_id"))).alias("row")
    stay = flagged.filter("_maybe").groupBy("text_sha256").agg(first).select("row")
    return flagged.filter(~F.col("_maybe")).select("row").unionByName(stay).select("row.*")
