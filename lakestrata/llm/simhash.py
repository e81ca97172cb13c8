"""SimHash near-duplicates: bit-sliced distances inside buckets that lose no link."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.common import shipped, stored, whole
from lakestrata.llm.components import components
from lakestrata.llm.repeats import drop_rows, join_hot

shipped(__name__)

BITS = 64
#: Fingerprints of a bucket that one task compares with one another; a larger
#: bucket is compared in pairs of blocks of this size.
BLOCK = 4096
#: Shingles whose hashes are held at a time, and pairs of lanes looked at at a time.
_HASHES = 1 << 16
_ITEMS = 1 << 18


def fingerprint(text: str | None, words: int = 3, seed: int = 42) -> int:
    """The 64-bit fingerprint of a text: a bit is set when it is in over half the shingle hashes.

    A-Z are lower-cased, words are what ASCII white space separates, shingles
    are ``words`` words joined by spaces, repeats included; a text with fewer
    words is one shingle, and one without words has fingerprint 0.
    """
    tokens = (text or "").encode().lower().split()
    if not tokens:
        return 0
    if len(tokens) < words:
        shingles = [b" ".join(tokens)]
    else:
        shingles = list(map(b" ".join, zip(*(tokens[i:] for i in range(words)), strict=False)))
    counts = np.zeros(BITS, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(shingles), _HASHES):
        some = shingles[at : at + _HASHES]
        hashes = np.fromiter((digest(s, seed) for s in some), np.uint64, len(some))
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(shingles), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """doc_id, text_hash (to tell rows with one id apart) and fp, the fingerprint as a signed long."""
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.xxhash64(whole(text_col)).alias("text_hash"), whole(text_col).alias("text")
    )
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(t.as_py(), words) for t in batch.column(2)), np.uint64, batch.num_rows)
            columns = [batch.column(0), batch.column(1), pa.array(found.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "fp"])

    return rows.mapInArrow(made, f"doc_id {id_type}, text_hash long, fp long")


def bucket_masks(radius: int) -> list[int]:
    """Bit masks such that any two fingerprints within ``radius`` agree under at least one.

    Cut into radius + 1 blocks, one block is free of differing bits; the other
    bits, cut the same way, leave another such block. A mask is a pair of them.
    """
    masks = []
    for first in np.array_split(np.arange(BITS), radius + 1):
        rest = np.setdiff1d(np.arange(BITS), first)
        for second in np.array_split(rest, radius + 1):
            masks.append(sum(1 << int(b) for b in (*first, *second)))
    return masks


def _lanes(fps: np.ndarray) -> np.ndarray:
    """Bit planes of fingerprints, 64 lanes to a word: plane b holds bit b of every lane."""
    bits = np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(bits, axis=0, bitorder="little").T.copy().view(np.uint64)


def _near(planes: np.ndarray, query_bits: np.ndarray, query: np.ndarray, word: np.ndarray, radius: int):
    """(query, word, near) for pairs of a query and a word of lanes; near has a bit per lane within ``radius``.

    Carry-save counters add one differing bit of all 64 lanes at a time; they
    start so that the carry out of the top counter says ``radius`` is passed.
    Words in which every lane has passed it are abandoned as the planes go by.
    """
    width = max(1, radius.bit_length())
    spare = (1 << width) - 1 - radius
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    counters = [np.full(len(query), full if spare >> k & 1 else 0, np.uint64) for k in range(width)]
    over = np.zeros(len(query), np.uint64)
    for plane in range(BITS):
        carry = planes[plane][word] ^ query_bits[plane][query]
        for k in range(width):
            counters[k], carry = counters[k] ^ carry, counters[k] & carry
        over |= carry
        if plane % 4 == 3:
            stay = over != full
            if not stay.all():
                query, word, over = query[stay], word[stay], over[stay]
                counters = [c[stay] for c in counters]
            if not len(query):
                break
    return query, word, ~over


def _roots(roots: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``roots`` (a lane of each lane's component) after joining lanes a and b."""
    while True:
        low = np.minimum(roots[a], roots[b])
        new = roots.copy()
        np.minimum.at(new, roots[a], low)
        np.minimum.at(new, roots[b], low)
        while not np.array_equal(jumped := new[new], new):
            new = jumped
        if np.array_equal(new, roots):
            return roots
        roots = new


def linked(fps: np.ndarray, groups: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (pairs of fingerprints) that connect what is within ``radius`` inside each group.

    ``groups`` numbers each fingerprint's group, sorted. At most one edge per
    fingerprint comes out: a star on each connected part of a group.
    """
    starts = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]])
    sizes = np.diff(np.r_[starts, len(groups)])
    words = -(-sizes // 64)
    first_word = np.r_[0, np.cumsum(words)[:-1]]
    group_of = np.repeat(np.arange(len(starts)), sizes)
    # Each group starts at a lane of its own word, so no word mixes groups.
    lane = first_word[group_of] * 64 + np.arange(len(fps)) - starts[group_of]
    padded = np.zeros(int(words.sum()) * 64, np.uint64)
    padded[lane] = fps
    valid = np.zeros(len(padded), np.uint8)
    valid[lane] = 1
    valid_words = np.packbits(valid, bitorder="little").view(np.uint64)
    planes = _lanes(padded)
    shift = np.arange(BITS, dtype=np.uint64)[:, None]
    query_bits = np.uint64(0) - ((fps[None, :] >> shift) & np.uint64(1))

    roots = np.arange(len(padded))
    per_query = words[group_of]
    upto = np.cumsum(per_query)
    at = 0
    while at < len(fps):
        done = upto[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(upto, done + _ITEMS, side="right")))
        count = per_query[at:to]
        query = np.repeat(np.arange(at, to), count)
        offset = np.arange(len(query)) - np.repeat(np.cumsum(count) - count, count)
        word = first_word[group_of[query]] + offset
        query, word, near = _near(planes, query_bits, query, word, radius)
        near &= valid_words[word]
        bits = np.unpackbits(near.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        hit, bit = np.nonzero(bits)
        a, b = lane[query[hit]], word[hit] * 64 + bit
        other = roots[a] != roots[b]
        if other.any():
            roots = _roots(roots, a[other], b[other])
        at = to
    moved = roots[lane] != lane
    return fps[moved], padded[roots[lane[moved]]]


def _bucket_edges(radius: int):
    """Edges inside the buckets of a partition that is sorted by bucket."""

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(fps: np.ndarray, keys: np.ndarray) -> pa.RecordBatch:
            # Buckets of one fingerprint have nothing to compare.
            same = keys[1:] == keys[:-1]
            keep = np.r_[False, same] | np.r_[same, False]
            a, b = linked(fps[keep], keys[keep], radius) if keep.any() else (fps[:0], fps[:0])
            columns = [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))]
            return pa.RecordBatch.from_arrays(columns, ["a", "b"])

        fps, keys = np.empty(0, np.uint64), np.empty(0, np.int64)
        last, number = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            parts = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
            change = np.r_[True, np.any([p[1:] != p[:-1] for p in parts[:3]], axis=0)]
            head = tuple(int(p[0]) for p in parts[:3])
            change[0] = head != last
            last = tuple(int(p[-1]) for p in parts[:3])
            own = number + np.cumsum(change)
            number = int(own[-1])
            fps, keys = np.r_[fps, parts[3].view(np.uint64)], np.r_[keys, own]
            # The last bucket may go on in the next batch.
            whole_to = int(np.searchsorted(keys, number))
            if whole_to:
                yield out(fps[:whole_to], keys[:whole_to])
                fps, keys = fps[whole_to:], keys[whole_to:]
        if len(fps):
            yield out(fps, keys)

    return edges


def fingerprint_links(fps: DataFrame, radius: int = 3, block: int = BLOCK) -> DataFrame:
    """Edges (a, b) between the distinct ``fp`` whose components are those of all links.

    Every fingerprint goes to a bucket for each mask of ``bucket_masks``; two
    within ``radius`` meet in one at least. A bucket with more than ``block``
    members is cut into blocks by hash and each pair of blocks is compared by a
    task of its own, so no task holds more than about two blocks.
    """
    masks = F.posexplode(F.array(*[F.lit(m - (1 << 64) if m >> 63 else m) for m in bucket_masks(radius)]))
    placed = fps.select("fp", masks.alias("t", "mask"))
    placed = stored(placed.select("fp", "t", F.col("fp").bitwiseAND(F.col("mask")).alias("key")), "simhash-buckets")
    sizes = placed.groupBy("t", "key").agg(F.count("*").alias("n")).filter(F.col("n") > block)
    large = stored(sizes.withColumn("bucket", F.xxhash64("t", "key")), "simhash-large")
    small = placed.join(large.select("t", "key"), ["t", "key"], "left_anti")
    small = small.select(F.lit(0).cast("long").alias("pair"), F.col("t").cast("long"), "key", "fp")
    rows = small
    if not large.isEmpty():
        total = placed.count()
        hot = join_hot(placed.withColumn("bucket", F.xxhash64("t", "key")), large.select("bucket", "n"), "bucket", "n", total)
        hot = hot.withColumn("blocks", F.ceil(F.col("n") / block)).withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")))
        hot = hot.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        pair = F.least("own", "other") * F.col("blocks") + F.greatest("own", "other") + 1
        rows = small.unionByName(hot.select(pair.alias("pair"), F.col("t").cast("long"), "key", "fp"))
    rows = rows.repartition("pair", "t", "key").sortWithinPartitions("pair", "t", "key")
    return rows.mapInArrow(_bucket_edges(radius), "a long, b long").distinct()


def _with_roots(rows: DataFrame, radius: int) -> DataFrame:
    """``rows`` (doc_id, text_hash, fp) with root, a fingerprint of their component."""
    fps = stored(rows.groupBy("fp").agg(F.count("*").alias("n")), "simhash-fingerprints")
    found = components(fingerprint_links(fps.select("fp"), radius))
    roots = fps.join(found, F.col("fp") == F.col("node"), "left")
    roots = roots.select("fp", "n", F.coalesce("root", "fp").alias("root"))
    return join_hot(rows, stored(roots, "simhash-roots"), "fp", "n", rows.count()).drop("n")


def simhash_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, radius: int = 3
) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id.

    Documents whose fingerprints differ in at most ``radius`` bits are linked;
    ``component_id`` is the smallest id that links reach, a document's own
    included (null when no document of the component has an id). Null and empty
    texts, and texts of white space, have fingerprint 0 and link like any other.
    Repeated rows each keep their row. An empty table gives no rows. Other
    columns are not looked at.
    """
    rows = _with_roots(stored(fingerprints(docs, id_col, text_col, words), "simhash-rows"), radius)
    rows = stored(rows, "simhash-members")
    firsts = rows.groupBy("root").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("n"))
    joined = join_hot(rows, firsts, "root", "n", rows.count())
    return joined.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def drop_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, radius: int = 3
) -> DataFrame:
    """The documents with one of each component, the one with the smallest id, all columns kept.

    Null ids come last; rows that repeat both id and text stay or go together.
    Only documents that may have to go are shuffled with their text.
    """
    rows = stored(_with_roots(stored(fingerprints(docs, id_col, text_col, words), "simhash-rows"), radius), "simhash-members")
    member = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "fp", "text_hash")
    firsts = rows.groupBy("root").agg(F.min(member).alias("first"), F.count("*").alias("n"))
    joined = join_hot(rows, firsts, "root", "n", rows.count())
    gone = joined.filter(~member.eqNullSafe(F.col("first"))).select("doc_id", "text_hash").distinct()
    return drop_rows(docs, {"doc_id": F.col(id_col), "text_hash": F.xxhash64(whole(text_col))}, gone)
