"""Write web pages as WARC archives, and read archives back by verified record boundaries."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakestrata.llm.common import shipped, stored, whole
from lakestrata.llm.repeats import filter_bits, join_hot, maybe_repeated, repeat_filter

shipped(__name__)

# Fixed by the WARC format: the version line that opens a record, and the blank
# lines that end one. No header can hold the two together, a payload can.
OPENING = "WARC/1."
ENDING = "\r\n\r\n"
BOUNDARY = ENDING + OPENING

_CANDIDATE = "file string, block long, at long, head_bytes long, content_bytes long, raw binary"
_LENGTH = re.compile(rb"\r\ncontent-length:[ \t]*(\d{1,15})[ \t]*(?:\r\n|$)", re.IGNORECASE)


def write_warc(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    uri_col: str = "url",
    payload_col: str = "html",
    min_revisit_bytes: int = 100,
    date: str = "1970-01-01T00:00:00Z",
    records_per_file: int = 100_000,
) -> None:
    """Write one record per page to archives below ``path``, with Spark's own text writer.

    Of pages with equal payloads of at least ``min_revisit_bytes`` the one with
    the smallest id becomes the response (null ids last, of repeated rows any
    one); the others become revisit records, which name the response and the
    payload's digest and length and carry no payload. Shorter payloads are all
    responses. A null payload is empty. Line breaks and blanks in an address
    are percent-encoded, so a header keeps to its line. An empty table writes no
    record. Other columns are not looked at.

    Payloads that surely occur once pass a Bloom filter and are not shuffled; of
    the others each task sends one payload per digest, and the revisits need none.
    """
    uri = F.coalesce(F.col(uri_col).cast("string"), F.lit(""))
    for plain, coded in (("\r", "%0D"), ("\n", "%0A"), (" ", "%20")):
        uri = F.replace(uri, F.lit(plain), F.lit(coded))
    rows = pages.select(
        F.col(id_col).alias("page_id"), uri.alias("uri"), whole(payload_col).alias("payload")
    )
    rows = rows.withColumn("digest", F.sha2(F.col("payload").cast("binary"), 256))
    rows = rows.withColumn("bytes", F.octet_length("payload").cast("long"))
    long = F.col("bytes") >= min_revisit_bytes
    words = repeat_filter(rows.filter(long).select("digest"), "digest", filter_bits(pages.count()))
    flagged = maybe_repeated(rows, "digest", words, "_maybe")
    shared = F.col("_maybe") & long

    alone = flagged.filter(~shared).select("page_id", "uri", "payload", "digest", "bytes")
    firsts = flagged.filter(shared).groupBy("digest").agg(
        F.min_by(
            F.struct("page_id", "uri", "payload", "bytes"),
            F.struct(F.col("page_id").isNull(), F.col("page_id"), F.col("uri")),
        ).alias("first")
    )
    firsts = firsts.select("first.page_id", "first.uri", "first.payload", "digest", "first.bytes")
    members = stored(
        flagged.filter(shared).groupBy("digest", "page_id", "uri", "bytes").agg(F.count("*").alias("copies")),
        "warc-members",
    )
    groups = stored(
        members.groupBy("digest").agg(
            F.min_by(
                F.struct("page_id", "uri"),
                F.struct(F.col("page_id").isNull(), F.col("page_id"), F.col("uri")),
            ).alias("first"),
            F.count("*").alias("ids"),
        ),
        "warc-groups",
    )
    decided = join_hot(members, groups, "digest", "ids", members.count())
    is_first = F.struct("page_id", "uri").eqNullSafe(F.col("first"))
    again = decided.withColumn("left", F.col("copies") - is_first.cast("long")).filter("left > 0")
    again = again.withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("left"))))

    def line(name: str, value) -> object:
        return F.concat(F.lit(f"{name}: "), F.coalesce(value.cast("string"), F.lit("")), F.lit("\r\n"))

    def record(df: DataFrame, kind: str, payload, more) -> DataFrame:
        head = F.concat(
            F.lit("WARC/1.1\r\n"),
            line("WARC-Type", F.lit(kind)),
            line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">"))),
            line("WARC-Date", F.lit(date)),
            line("WARC-Target-URI", F.col("uri")),
            line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
            more,
            line("Content-Type", F.lit("text/html; charset=utf-8")),
            line("Content-Length", F.octet_length(payload)),
            F.lit("\r\n"),
        )
        return df.select(F.concat(head, payload).alias("value"))

    refers = F.concat(F.lit("<urn:page:"), F.coalesce(F.col("first.page_id").cast("string"), F.lit("")), F.lit(">"))
    profile = F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    revisit = F.concat(
        line("WARC-Profile", profile),
        line("WARC-Refers-To", refers),
        line("X-Payload-Length", F.col("bytes")),
    )
    records = (
        record(alone, "response", F.col("payload"), F.lit(""))
        .unionByName(record(firsts, "response", F.col("payload"), F.lit("")))
        .unionByName(record(again, "revisit", F.lit(""), revisit))
    )
    records.write.option("lineSep", ENDING).option("maxRecordsPerFile", records_per_file).text(path)


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each piece between two boundaries, with its place in its split and the header it opens with."""
    place: tuple[str, int] | None = None
    at = 0
    for batch in batches:
        out: dict[str, list] = {k: [] for k in ("file", "block", "at", "head_bytes", "content_bytes", "raw")}
        files, blocks, values = (batch.column(i) for i in range(3))
        for file, block, raw in zip(files.to_pylist(), blocks.to_pylist(), values.to_pylist(), strict=True):
            if (file, block) != place:
                place, at = (file, block), 0
            start = at
            at += len(raw) + len(BOUNDARY)
            if block == 0 and start == 0 and raw.startswith(OPENING.encode()):
                # Only a file's first record has no boundary before it.
                start, raw = len(OPENING), raw[len(OPENING) :]
            head = raw.find(ENDING.encode())
            length = _LENGTH.search(raw, 0, head + 2) if head >= 0 else None
            out["file"].append(file)
            out["block"].append(block)
            out["at"].append(start)
            out["head_bytes"].append(head + len(ENDING) if length else None)
            out["content_bytes"].append(int(length[1]) if length else None)
            out["raw"].append(raw)
        types = {"file": pa.string(), "raw": pa.binary()}
        yield pa.RecordBatch.from_arrays([pa.array(v, types.get(k, pa.int64())) for k, v in out.items()], list(out))


def _exits(pdf: pd.DataFrame) -> pd.DataFrame:
    """Where the chain from each candidate of one split leaves it, by pointer jumping inside it.

    A chain that lands on no candidate is broken: its exit is null.
    """
    pdf = pdf.sort_values("at", ignore_index=True)
    at, to = pdf["at"].to_numpy(), pdf["to"].to_numpy(dtype="float64", na_value=-1).astype("int64")
    end = int(pdf["until"].iloc[0])
    n = len(at)
    found = np.minimum(np.searchsorted(at, to), n - 1)
    inside = (to >= 0) & (at[found] == to)
    jump = np.where(inside, found, np.arange(n))
    while not np.array_equal(twice := jump[jump], jump):
        jump = twice
    last_to = to[jump]
    pdf["exit"] = pd.array(np.where(last_to >= end, last_to, -1), dtype="Int64")
    pdf.loc[pdf["exit"] < 0, "exit"] = pd.NA
    return pdf[["file", "block", "at", "exit"]]


def _marks(pdf: pd.DataFrame) -> pd.DataFrame:
    """The records on the chain from a split's entry, marked by pointer jumping."""
    pdf = pdf.sort_values("at", ignore_index=True)
    at, to = pdf["at"].to_numpy(), pdf["to"].to_numpy(dtype="float64", na_value=-1).astype("int64")
    n = len(at)
    found = np.minimum(np.searchsorted(at, to), n - 1)
    jump = np.where((to >= 0) & (at[found] == to), found, np.arange(n))
    on = (at == pdf["entry"].iloc[0]) & (to >= 0)
    while True:
        more = on.copy()
        more[jump[on]] = True
        more &= to >= 0
        if np.array_equal(more, on) and np.array_equal(jump[jump], jump):
            break
        on, jump = more, jump[jump]
    return pdf.assign(on=on)[["file", "block", "at", "on"]]


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The records of the archives below ``path``: file, offset, head, payload.

    ``head`` is the header text after the version line, ``payload`` the bytes it
    announces. Files are read in splits. Every piece that follows a boundary is
    only a candidate: it emits an edge to the offset its Content-Length points
    at, and a record counts when the chain of such edges from the start of its
    file reaches it, so a boundary inside a payload opens no record. A file that
    does not open with a record gives none. A length is broken when it ends at no
    boundary and not at the end of the file: its record was reached and counts,
    with the bytes up to its length or the next boundary, whichever comes first,
    and nothing behind it is reached. A record without a length, or with a
    negative one, is not read, and ends its file too. Empty files and folders
    give no rows.

    Chains are followed by pointer jumping, first inside a split (integers of one
    split at a time), then over the splits, in as many rounds as the logarithm of
    the number of splits of a file. Payloads are not shuffled, except those that
    hold a boundary, which are put together from their own pieces alone.
    """
    lines = spark.read.option("lineSep", BOUNDARY).text(path)
    meta = "_metadata.file_path", "_metadata.file_block_start"
    lines = lines.select(
        F.col(meta[0]).alias("file"), F.col(meta[1]).alias("block"), F.col("value").cast("binary")
    )
    pieces = stored(lines.mapInArrow(_candidates, _CANDIDATE), "warc-pieces", "zstd")

    # Places in a split become places in the file: one row per split.
    full = F.col("at") + F.octet_length("raw") + len(BOUNDARY)
    ends = pieces.groupBy("file", "block").agg(F.max(full).alias("took"))
    order = Window.partitionBy("file").orderBy("block")
    past = order.rowsBetween(Window.unboundedPreceding, -1)
    bases = ends.select(
        "file",
        "block",
        F.coalesce(F.sum("took").over(past), F.lit(0)).alias("base"),
        F.sum("took").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("until"),
        F.count("*").over(Window.partitionBy("file")).alias("splits"),
        F.sum("took").over(Window.partitionBy("file")).alias("end"),
    )
    bases = stored(bases, "warc-splits")
    edges = pieces.select("file", "block", "at", "head_bytes", "content_bytes", F.octet_length("raw").alias("size"))
    edges = edges.join(bases, ["file", "block"]).select(
        "file",
        "block",
        (F.col("base") + F.col("at")).alias("at"),
        (F.col("base") + F.col("at") + F.col("head_bytes") + F.col("content_bytes") + len(BOUNDARY)).alias("to"),
        "until",
        "base",
        "splits",
        "end",
        "size",
    )
    edges = stored(edges, "warc-edges")

    entries = _entries(edges)
    chained = edges.join(entries, ["file", "block"]).groupBy("file", "block")
    on = chained.applyInPandas(_marks, "file string, block long, at long, on boolean").filter("on")
    marked = stored(edges.join(on, ["file", "block", "at"], "left"), "warc-marked")
    # What a split needs of the others: the owner it begins with, and the place after its last. One row per split.
    own = F.when(F.col("on"), F.struct("at", "to"))
    carried = marked.groupBy("file", "block").agg(F.min("at").alias("first"), F.max(own).alias("last_owner"))
    carried = carried.select(
        "file",
        "block",
        F.last("last_owner", ignorenulls=True).over(past).alias("owner_before"),
        F.lead("first").over(order).alias("first_after"),
    )
    in_split = Window.partitionBy("file", "block").orderBy("at")
    owner = F.last(own, ignorenulls=True)
    places = marked.join(stored(carried, "warc-carried"), ["file", "block"]).select(
        "file",
        "block",
        (F.col("at") - F.col("base")).alias("at"),
        F.col("at").alias("offset"),
        F.col("on").isNotNull().alias("on"),
        F.coalesce(owner.over(in_split), F.col("owner_before")).alias("owner"),
        F.coalesce(F.lead("at").over(in_split), F.col("first_after"), F.col("to")).alias("next"),
        "to",
        "end",
    )
    # A record in one piece needs nothing but its piece. What is left are pieces
    # of no record and records whose length goes past a boundary: their places are
    # stored first, so the planner knows how few they are.
    whole_record = F.col("on") & (F.col("next") >= F.col("to"))
    odd = stored(places.filter(~whole_record).drop("next"), "warc-odd")
    # Such a length is good when it leads to a boundary, or to the end of the file with or without blank lines.
    passing = odd.filter("on").select("file", "block", "at", "offset", "to", "end")
    landing = marked.select("file", F.col("at").alias("to"))
    ending = (F.col("to") == F.col("end")) | (F.col("to") == F.col("end") - len(ENDING))
    good = passing.filter(ending).unionByName(passing.filter(~ending).join(landing, ["file", "to"], "left_semi"))
    good = stored(good, "warc-passing")
    key = ["file", "block", "at"]
    broken = passing.join(good.select(*key), key, "left_anti").select(*key)

    elsewhere = odd.select(*key).join(broken, key, "left_anti")
    plain = pieces.join(elsewhere, key, "left_anti").join(bases.select("file", "block", "base"), ["file", "block"])
    plain = plain.select("file", (F.col("base") + F.col("at")).alias("offset"), "raw", "head_bytes", "content_bytes")

    # A piece belongs to a record only as far as the record's length goes.
    owned = odd.filter(F.col("offset") < F.col("owner.to")).select(*key, F.col("owner.at").alias("owner"))
    owned = owned.join(good.select("file", F.col("offset").alias("owner")), ["file", "owner"])
    parts = pieces.join(owned, key)
    parts = parts.groupBy("file", "owner").agg(
        F.sort_array(F.collect_list(F.struct("block", "at", "raw", "head_bytes", "content_bytes"))).alias("parts")
    )
    text = F.array_join(F.transform("parts", lambda p: p["raw"].cast("string")), BOUNDARY)
    joined = parts.select(
        "file",
        F.col("owner").alias("offset"),
        text.cast("binary").alias("raw"),
        F.col("parts")[0]["head_bytes"].alias("head_bytes"),
        F.col("parts")[0]["content_bytes"].alias("content_bytes"),
    )
    # The last piece of a file still ends in its blank lines; the length cuts them.
    return plain.unionByName(joined).select(
        "file",
        (F.col("offset") - len(OPENING)).alias("offset"),
        F.expr("cast(substring(raw, 1, cast(head_bytes as int)) as string)").alias("head"),
        F.expr("substring(raw, cast(head_bytes as int) + 1, cast(content_bytes as int))").alias("payload"),
    )


def _entries(edges: DataFrame) -> DataFrame:
    """The first record of each split that the chain from its file's start reaches: file, block, entry."""
    starts = edges.filter((F.col("block") == 0) & (F.col("at") == len(OPENING)))
    reached = starts.select("file", "at").withColumnRenamed("at", "entry")
    most = edges.agg(F.max("splits")).first()[0] or 0
    if most > 1:
        exits = edges.groupBy("file", "block").applyInPandas(_exits, "file string, block long, at long, exit long")
        exits = stored(exits.filter("exit is not null").select("file", "at", "exit"), "warc-exits")
        # Only places that something leads to, or starts, can be on a chain.
        heads = exits.select("file", F.col("exit").alias("at")).distinct()
        heads = heads.unionByName(starts.select("file", "at")).distinct()
        jumps = stored(exits.join(heads, ["file", "at"]), "warc-jumps")
        for _ in range((most - 1).bit_length()):
            step = jumps.select("file", F.col("at").alias("entry"), "exit")
            onward = reached.join(step, ["file", "entry"]).select("file", F.col("exit").alias("entry"))
            reached = stored(reached.unionByName(onward).distinct(), "warc-reached")
            second = jumps.select("file", F.col("at").alias("exit"), F.col("exit").alias("over"))
            jumps = stored(
                jumps.join(second, ["file", "exit"]).select("file", "at", F.col("over").alias("exit")), "warc-jumps"
            )
    blocks = edges.select("file", "block", F.col("at").alias("entry"))
    return blocks.join(reached, ["file", "entry"]).select("file", "block", "entry")


def header(name: str, head: str = "head"):
    """The value of a header field, null when the record has none."""
    found = F.regexp_extract(F.col(head), rf"(?i)\r\n{re.escape(name)}:[ \t]*([^\r\n]*)", 1)
    present = F.col(head).rlike(rf"(?i)\r\n{re.escape(name)}:")
    return F.when(present, found)


def page_records(records: DataFrame) -> DataFrame:
    """Records as pages: page_id, record_type, refers_to, payload_digest, payload_bytes, payload, page_key.

    ``page_key`` is the id as it was written; page_id and refers_to are null where
    an id is no whole number. Digest and length are taken from the payload that was read; a revisit, which
    carries none, has those its header states.
    """
    number = lambda name: F.expr("try_cast(regexp_extract(" + name + r", ':(-?[0-9]+)>$', 1) as bigint)")
    rows = records.select(
        header("WARC-Record-ID").alias("id"),
        header("WARC-Type").alias("record_type"),
        header("WARC-Refers-To").alias("refers"),
        header("WARC-Payload-Digest").alias("stated"),
        header("X-Payload-Length").alias("length"),
        "payload",
    )
    revisit = F.col("record_type") == "revisit"
    return rows.select(
        number("id").alias("page_id"),
        "record_type",
        number("refers").alias("refers_to"),
        F.when(revisit, F.regexp_replace("stated", "^sha256:", "")).otherwise(F.sha2("payload", 256)).alias("payload_digest"),
        F.when(revisit, F.expr("try_cast(length as bigint)")).otherwise(F.octet_length("payload").cast("long")).alias("payload_bytes"),
        "payload",
        F.regexp_extract("id", "^<urn:page:(.*)>$", 1).alias("page_key"),
    )
