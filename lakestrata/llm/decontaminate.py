"""Benchmark decontamination by greedy string tiling."""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.common import shipped, stored, whole
from lakestrata.llm.repeats import drop_rows

shipped(__name__)

#: Fewest tokens of a tile.
MIN_TOKENS = 5
#: Share of a test item's tokens that tiles must cover.
COVERAGE = 0.6
#: Bytes of test texts that are broadcast; with more their seeds are joined.
BROADCAST_BYTES = 8 * 1024 * 1024
#: Bits of the filter of their seeds then, two of which a seed sets; 32 MB.
FILTER_BITS = 1 << 28
# By how many bits a seed is shifted for each of its two slots.
_SHIFTS = (0, 32)

#: Pairs of equal seeds that are listed; a text and an item with more are compared run by run.
MOST_PAIRS = 1 << 18

_TOKEN = re.compile(r"\w+")
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_WORD = (1 << 64) - 1


def tokens(text: str) -> list[str]:
    """Lower-cased runs of letters, digits and underscores."""
    return _TOKEN.findall(text.lower())


def rolling(codes: np.ndarray, width: int) -> np.ndarray:
    """Karp-Rabin hashes of every run of ``width`` codes."""
    out = np.zeros(max(0, len(codes) - width + 1), np.uint64)
    for i in range(width):
        out = out * _FACTOR + codes[i : i + len(out)].astype(np.uint64)
    return out


class Items:
    """Test items as token codes, with their seeds: every run of ``width`` tokens.

    An item with fewer tokens than ``width`` has one seed, the whole of it; one
    without tokens has none and is never found.
    """

    def __init__(self, rows: Sequence[tuple], width: int = MIN_TOKENS) -> None:
        self.ids = [row[0] for row in rows]
        self.codes_of: dict[str, int] = {}
        number = self.codes_of.setdefault
        # Code 0 is for tokens of no item.
        self.codes = [
            np.array([number(t, len(self.codes_of) + 1) for t in tokens(row[1] or "")], np.int64) for row in rows
        ]
        self.width = width
        self.seeds: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for short in sorted({min(width, len(c)) for c in self.codes} - {0}):
            own = [i for i, c in enumerate(self.codes) if min(width, len(c)) == short]
            hashes = [rolling(self.codes[i], short) for i in own]
            at = np.concatenate([np.arange(len(h)) for h in hashes])
            item = np.repeat(own, [len(h) for h in hashes])
            joined = np.concatenate(hashes)
            order = np.argsort(joined, kind="stable")
            self.seeds[short] = joined[order], item[order], at[order]

    def shared_seeds(self, doc: np.ndarray) -> Iterator[Shared]:
        """The seeds that each item shares with ``doc``, one entry for each item that has any.

        Equal seeds of the document stand together, so what is held is as long as
        the document or the items, and not their product.
        """
        for short, (hashes, item, at) in self.seeds.items():
            own = rolling(doc, short)
            if len(own) == 0 or np.count_nonzero(doc) < short:
                continue
            # A seed has known tokens only.
            run = np.convolve(doc != 0, np.ones(short, np.int64), "valid") == short
            places = np.flatnonzero(run)
            places = places[np.argsort(own[places], kind="stable")]
            seeds, first, often = np.unique(own[places], return_index=True, return_counts=True)
            low = np.searchsorted(hashes, seeds, "left")
            count = np.searchsorted(hashes, seeds, "right") - low
            if not count.any():
                continue
            hit = np.repeat(low, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            seed = np.repeat(np.arange(len(seeds)), count)
            order = np.argsort(item[hit], kind="stable")
            hit, seed = hit[order], seed[order]
            cuts = np.flatnonzero(np.diff(item[hit])) + 1
            for own_hits, own_seeds in zip(np.split(hit, cuts), np.split(seed, cuts), strict=True):
                yield Shared(int(item[own_hits[0]]), short, at[own_hits], first[own_seeds], often[own_seeds], places)


@dataclass(frozen=True)
class Shared:
    """The places of an item's seeds that a document has, and where in ``places`` those of the document are."""

    item: int
    width: int
    in_item: np.ndarray
    first: np.ndarray
    often: np.ndarray
    places: np.ndarray

    @property
    def pairs(self) -> int:
        return int(self.often.sum())

    def listed(self) -> tuple[np.ndarray, np.ndarray]:
        """All pairs of equal seeds: places in the document, places in the item."""
        at = np.repeat(self.first, self.often) + np.arange(self.pairs)
        at -= np.repeat(np.cumsum(self.often) - self.often, self.often)
        return self.places[at], np.repeat(self.in_item, self.often)


def tiles(doc: np.ndarray, item: np.ndarray, in_doc: np.ndarray, in_item: np.ndarray, width: int):
    """Greedy string tiling: (length, place in doc, place in item), longest first, none overlapping.

    The seeds, equal runs of ``width`` tokens, are checked token by token (their
    hashes may collide) and joined along diagonals to longest matches. The longest
    match is marked again and again; one that marks have cut is put back as what
    is left of it, so every tile is the longest unmarked match at its turn. Ties
    go to the first place in the document, then in the item.
    """
    right = np.all([doc[in_doc + k] == item[in_item + k] for k in range(width)], axis=0)
    in_doc, in_item = in_doc[right], in_item[right]
    order = np.lexsort((in_doc, in_doc - in_item))
    in_doc, in_item = in_doc[order], in_item[order]
    if not len(in_doc):
        return []
    new = np.r_[True, (np.diff(in_doc - in_item) != 0) | (np.diff(in_doc) != 1)]
    first = np.flatnonzero(new)
    length = np.diff(np.r_[first, len(in_doc)]) + width - 1
    heap = list(zip((-length).tolist(), in_doc[first].tolist(), in_item[first].tolist(), strict=True))
    heapq.heapify(heap)
    doc_marked, item_marked = np.zeros(len(doc), bool), np.zeros(len(item), bool)
    found = []
    while heap:
        minus, d, i = heapq.heappop(heap)
        free = ~(doc_marked[d : d - minus] | item_marked[i : i - minus])
        if free.all():
            doc_marked[d : d - minus] = True
            item_marked[i : i - minus] = True
            found.append((-minus, d, i))
            continue
        edge = np.flatnonzero(np.diff(np.r_[False, free, False]))
        for start, end in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            if end - start >= width:
                heapq.heappush(heap, (start - end, d + start, i + start))
    return found


class _Runs:
    """Hashes of all runs of a length, and which of them hold no marked token."""

    def __init__(self, codes: np.ndarray) -> None:
        self.codes = codes
        self.sums = np.zeros(len(codes) + 1, np.uint64)
        total, factor = 0, int(_FACTOR)
        for at, code in enumerate(codes.tolist(), 1):
            total = (total * factor + code) & _WORD
            self.sums[at] = total
        self.marked = codes == 0

    def free(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """(places, hashes) of the runs without a marked token."""
        if length > len(self.codes):
            return np.array([], np.int64), np.array([], np.uint64)
        blocked = np.r_[0, np.cumsum(self.marked)]
        places = np.flatnonzero(blocked[length:] == blocked[:-length])
        power = np.uint64(pow(int(_FACTOR), length, _WORD + 1))
        return places, self.sums[places + length] - self.sums[places] * power


def tiles_of_runs(doc: np.ndarray, item: np.ndarray, width: int):
    """``tiles`` without a list of seeds: for texts that repeat themselves.

    Each turn looks for the longest unmarked match by running Karp-Rabin: the
    hashes of all unmarked runs of one length are compared, the length is found
    by halving, and the run that comes first is checked token by token. Lengths
    never grow from turn to turn, and there are no more turns than the item has
    room for tiles, so memory is that of the two texts.
    """
    runs, own = _Runs(doc), _Runs(item)

    def match(length: int) -> tuple[int, int] | None:
        in_item, wanted = own.free(length)
        in_doc, hashes = runs.free(length)
        for at in np.flatnonzero(np.isin(hashes, wanted)):
            d = in_doc[at]
            run = doc[d : d + length]
            for i in in_item[wanted == hashes[at]]:
                if np.array_equal(run, item[i : i + length]):
                    return int(d), int(i)
        return None

    found, longest = [], min(len(doc), len(item))
    while longest >= width:
        place = match(longest)
        if place is None:
            low, high = width - 1, longest
            while high - low > 1:
                middle = (low + high) // 2
                if found_here := match(middle):
                    low, place = middle, found_here
                else:
                    high = middle
            longest = low
            if place is None:
                break
        d, i = place
        runs.marked[d : d + longest] = True
        own.marked[i : i + longest] = True
        found.append((longest, d, i))
    return found


def covered(text: str, items: Items, coverage: float) -> Iterator[tuple]:
    """(item id, item tokens, covered tokens, tiles, longest tile) of each item that the text covers."""
    get = items.codes_of.get
    doc = np.array([get(t, 0) for t in tokens(text)], np.int64)
    for shared in items.shared_seeds(doc):
        codes, width = items.codes[shared.item], shared.width
        # Tiles lie within seeds, so seeds that reach too few tokens settle it.
        reach = np.zeros(len(codes) + 1, np.int64)
        np.add.at(reach, shared.in_item, 1)
        np.add.at(reach, shared.in_item + width, -1)
        if np.count_nonzero(np.cumsum(reach[:-1])) < coverage * len(codes):
            continue
        if shared.pairs <= MOST_PAIRS:
            found = tiles(doc, codes, *shared.listed(), width)
        else:
            found = tiles_of_runs(doc, codes, width)
        total = sum(t[0] for t in found)
        if found and total >= coverage * len(codes):
            yield items.ids[shared.item], len(codes), total, len(found), max(t[0] for t in found)


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    min_tokens: int = MIN_TOKENS,
    coverage: float = COVERAGE,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """One row per document and test item it contains: doc_id, item_id, coverage, item_tokens, tiles, longest, text_hash.

    A document contains an item when non-overlapping common runs of at least
    ``min_tokens`` tokens cover the share ``coverage`` of the item's tokens, in
    whatever order the document has them. A shorter item counts when the
    document has all of it in a row; items without tokens, and null and empty
    texts, match nothing. Items with equal texts are each reported, repeated
    rows too. Empty tables give no rows. Other columns are not looked at.

    Items of at most ``broadcast_bytes`` of text are broadcast; documents are not
    shuffled and every seed of theirs is looked up. For more items the seeds are
    joined, see ``_candidates``. Either way the documents are read once. A text
    that repeats itself is compared with an item that does run by run, so that
    memory follows the lengths of the two and not their product.
    """
    items = benchmark.select(F.col(item_col).alias("item_id"), whole(item_text_col).alias("item_text"))
    size = items.agg(F.sum(F.octet_length("item_text")).alias("bytes")).first()["bytes"] or 0
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.xxhash64(whole(text_col)).alias("text_hash"), whole(text_col).alias("text")
    )
    id_type, item_type = rows.schema["doc_id"].dataType, items.schema["item_id"].dataType
    schema = (
        f"doc_id {id_type.simpleString()}, text_hash long, item_id {item_type.simpleString()}, item_tokens int,"
        " covered int, tiles int, longest int"
    )
    if size <= broadcast_bytes:
        some = [(row["item_id"], row["item_text"]) for row in items.orderBy("item_id", "item_text").collect()]
        shared = docs.sparkSession.sparkContext.broadcast(some)
        found = rows.mapInArrow(_finder(shared, min_tokens, coverage), schema)
    else:
        pairs = _candidates(rows, items, min_tokens, coverage)
        found = pairs.mapInArrow(_checker(min_tokens, coverage), schema)
    return found.select(
        "doc_id",
        "item_id",
        (F.col("covered") / F.col("item_tokens")).alias("coverage"),
        "item_tokens",
        "tiles",
        "longest",
        "text_hash",
    )


def _codes(text: str) -> np.ndarray:
    """A 64-bit number for each token, the same in every task."""
    return np.array([xxhash.xxh64_intdigest(t) | 1 for t in tokens(text)], np.uint64)


def _candidates(rows: DataFrame, items: DataFrame, min_tokens: int, coverage: float) -> DataFrame:
    """doc_id, text_hash, text, item_id, item_text of the pairs whose shared seeds may cover enough.

    The seeds of all items set a Bloom filter of ``FILTER_BITS`` bits, which is
    broadcast. The documents are read once and give the seeds that may be an
    item's; these are joined with the items' seeds, and pairs are kept whose
    shared seeds reach the asked share of the item, were they all apart. Only the
    texts of such pairs are shuffled.
    """
    spark = rows.sparkSession
    named = items.withColumn("item", F.xxhash64("item_id", "item_text"))
    seeds = named.select("item", "item_text").distinct().mapInArrow(
        _item_seeds(min_tokens), "item long, tokens int, width int, seed long, places int"
    )
    seeds = stored(seeds, "item-seeds")
    both = [F.pmod(F.shiftrightunsigned("seed", n), F.lit(FILTER_BITS)) for n in _SHIFTS]
    bit = F.expr("shiftleft(1L, cast(slot & 63 as int))")
    words = seeds.select(F.explode(F.array(*both)).alias("slot")).groupBy(F.shiftright("slot", 6).alias("word")).agg(F.bit_or(bit).alias("mask"))
    # At most FILTER_BITS / 64 rows.
    table = words.toArrow()
    filled = np.zeros(FILTER_BITS // 64, np.int64)
    filled[table.column("word").to_numpy()] = table.column("mask").to_numpy()
    widths = sorted(row["width"] for row in seeds.select("width").distinct().collect())
    shared = spark.sparkContext.broadcast((filled.view(np.uint8), widths))

    kind = rows.schema["doc_id"].dataType.simpleString()
    own = rows.mapInArrow(_document_seeds(shared), f"doc_id {kind}, text_hash long, width int, seed long")
    own = own.withColumn("doc", F.struct("doc_id", "text_hash")).drop("doc_id", "text_hash")
    reach = F.sum(F.col("places") * F.col("width"))
    near = own.join(seeds, ["width", "seed"]).groupBy("doc", "item").agg(reach.alias("reach"), F.max("tokens").alias("tokens"))
    near = stored(near.filter(F.col("reach") >= coverage * F.col("tokens")).select("doc", "item"), "item-candidates")
    texts = rows.withColumn("doc", F.struct("doc_id", "text_hash"))
    pairs = near.join(texts, "doc").join(named, "item")
    return pairs.select("doc_id", "text_hash", "text", "item_id", "item_text")


def _item_seeds(min_tokens: int):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                codes = _codes(text)
                width = min(min_tokens, len(codes))
                if not width:
                    continue
                hashes, places = np.unique(rolling(codes, width).view(np.int64), return_counts=True)
                out += [(item, len(codes), width, h, n) for h, n in zip(hashes.tolist(), places.tolist(), strict=True)]
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32())
            columns = list(zip(*out, strict=True)) if out else [[]] * 5
            names = ["item", "tokens", "width", "seed", "places"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return make


def _document_seeds(shared):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filled, widths = shared.value
        for batch in batches:
            at, wide, seeds = [], [], []
            for n, text in enumerate(batch.column(2)):
                codes = _codes(text.as_py())
                for width in widths:
                    hashes = np.unique(rolling(codes, width))
                    hit = hashes
                    for shift in _SHIFTS:
                        # Bit by bit as in 64-bit words of the least byte first.
                        slots = (hit >> np.uint64(shift)) % np.uint64(FILTER_BITS)
                        hit = hit[(filled[slots >> np.uint64(3)] >> (slots & np.uint64(7)).astype(np.uint8)) & 1 == 1]
                    at += [n] * len(hit)
                    wide += [width] * len(hit)
                    seeds.append(hit.view(np.int64))
            take = pa.array(at, pa.int64())
            columns = [batch.column(0).take(take), batch.column(1).take(take), pa.array(wide, pa.int32())]
            columns.append(pa.array(np.concatenate(seeds) if seeds else np.array([], np.int64)))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "width", "seed"])

    return make


def _checker(min_tokens: int, coverage: float):
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, hits = [], []
            for n, (text, item) in enumerate(zip(batch.column(2), batch.column(4), strict=True)):
                for hit in covered(text.as_py(), Items([(None, item.as_py())], min_tokens), coverage):
                    rows.append(n)
                    hits.append(hit[1:])
            at = pa.array(rows, pa.int64())
            columns = [batch.column(i).take(at) for i in (0, 1, 3)]
            columns += [pa.array([hit[i] for hit in hits], pa.int32()) for i in range(4)]
            names = ["doc_id", "text_hash", "item_id", "item_tokens", "covered", "tiles", "longest"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return check


def _finder(shared, min_tokens: int, coverage: float):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(shared.value, min_tokens)
        for batch in batches:
            ids, hashes, texts = (batch.column(i) for i in range(3))
            rows, hits = [], []
            for n in range(batch.num_rows):
                for hit in covered(texts[n].as_py(), items, coverage):
                    rows.append(n)
                    hits.append(hit)
            at = pa.array(rows, pa.int64())
            item_ids, *numbers = [list(c) for c in zip(*hits, strict=True)] if hits else [[] for _ in range(5)]
            columns = [ids.take(at), hashes.take(at), pa.array(item_ids, None if hits else pa.null())]
            columns += [pa.array(c, pa.int32()) for c in numbers]
            names = ["doc_id", "text_hash", "item_id", "item_tokens", "covered", "tiles", "longest"]
            if hits:
                yield pa.RecordBatch.from_arrays(columns, names)

    return find


def drop_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_tokens: int = MIN_TOKENS,
    coverage: float = COVERAGE,
) -> DataFrame:
    """The documents that contain no test item, all columns kept."""
    found = contaminated(docs, benchmark, id_col, text_col, min_tokens=min_tokens, coverage=coverage)
    gone = stored(found.select("doc_id", "text_hash"), "contaminated").distinct()
    return drop_rows(docs, {"doc_id": F.col(id_col), "text_hash": F.xxhash64(whole(text_col))}, gone)
