"""The registered queries over the training-data tables."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.llm import conversations, decontaminate, exact_dedup, licences, secrets, sentencepieces, shards, simhash, suffix_dedup, toxicity, vector_codes, warc, winnowing
from lakestrata.session import work_dir


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives and read back by verified boundaries."""
    archives = work_dir(spark, "archives")
    warc.write_warc(_table(spark, sf_dir, "pages"), archives)
    pages = warc.page_records(warc.read_warc(spark, archives))
    return pages.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licence that a document, or a line or paragraph of it, is."""
    return licences.licence_scan(_table(spark, sf_dir, "documents"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of equal texts of every document, and which document stays."""
    return exact_dedup.exact_classes(_table(spark, sf_dir, "documents"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the passages of 200 bytes that occur again."""
    cut = suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id",
        "n_bytes",
        F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity score of every document."""
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_sentencepiece(
    spark: SparkSession, sf_dir: str, model_path: str = public_tokenizers.path("piece_bpe_32k.model")
) -> DataFrame:
    """Every document encoded and decoded again."""
    model = Path(model_path).read_bytes()
    pieces = sentencepieces.encoded(_table(spark, sf_dir, "documents"), model)

    def digest(numbers: str):
        return F.sha2(F.array_join(F.col(numbers).cast("array<string>"), ",").cast("binary"), 256)

    return pieces.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        digest("ids").alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        digest("places").alias("places_sha256"),
    )


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document, base patterns and linked parts."""
    found = secrets.secret_spans(_table(spark, sf_dir, "documents"))

    def joined(spans):
        text = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
        return F.array_join(text, ",")

    def number(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind_at"] < len(secrets.BASE))
    return found.select(
        "doc_id",
        *[number(kind) for kind, *_ in secrets.BASE],
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.simhash_components(_table(spark, sf_dir, "documents"), words=3, radius=3)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that contain a test item, in whatever order, with the items."""
    docs, items = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return decontaminate.contaminated(docs, items).drop("text_hash")


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight contiguous shards of nearly equal bytes."""
    placed = shards.shard_by_bytes(_table(spark, sf_dir, "documents"), 8)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op11_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The winnowed fingerprint of every document and of its edited text, and how like they are."""

    def digest(prints):
        listed = F.transform(prints, lambda p: F.concat_ws(":", p["hash"].cast("string"), p["position"].cast("string")))
        return F.sha2(F.array_join(listed, ",").cast("binary"), 256)

    near = winnowing.edited_likeness(_table(spark, sf_dir, "documents"), shown=digest)
    return near.select(
        "doc_id",
        F.col("text.chars").alias("n_chars"),
        F.col("edited_text.sha256").alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        "near_edited",
        "near_next",
    )


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged, with its faults and the cheapest edits that mend it."""
    damaged = conversations.damaged(_table(spark, sf_dir, "conversations"))
    return conversations.repair(damaged, present=F.col("present"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The code of every embedding, and how far it is from it."""
    codes, books = vector_codes.vector_codes(_table(spark, sf_dir, "embeddings"))
    return vector_codes.with_label_errors(codes).select(
        "vec_id",
        vector_codes.hex_code(F.col("code")).alias("code"),
        "error",
        "label_error",
        F.lit(vector_codes.books_digest(books)).alias("codebooks_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_licence_scan": op2_licence_scan,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_toxicity": op5_toxicity,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_secret_scan": op7_secret_scan,
    "op8_simhash": op8_simhash,
    "op9_decontamination": op9_decontamination,
    "op10_sharding": op10_sharding,
    "op11_winnowing": op11_winnowing,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_vector_codes": op13_vector_codes,
}
