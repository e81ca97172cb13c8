"""Repeated passages by suffix sorting with hashed comparisons."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.common import shipped, stored, whole
from lakestrata.llm.repeats import HOT_SHARE, join_hot, maybe_repeated, repeat_filter

shipped(__name__)

#: Bytes of a passage, and of the anchors by which equal passages meet.
PASSAGE = 200
ANCHOR = 72
#: Bytes of a text whose hashes are held at a time.
_PIECE = 1 << 20
#: Rows in a batch that goes back to Spark, about.
_ROWS = 1 << 15
#: Spans that are sorted together.
_AT_ONCE = 1 << 14
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, count: int) -> np.ndarray:
    """base ** 0, 1, 2, ... modulo 2 ** 64."""
    out = np.ones(count, np.uint64)
    size, step = 1, base
    while size < count:
        out[size : 2 * size] = out[: min(size, count - size)] * np.uint64(step)
        size, step = 2 * size, step * step % (1 << 64)
    return out


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hasher:
    """Polynomial prefix hashes: the hash of any run of bytes from two prefix sums."""

    def __init__(self, size: int) -> None:
        self.up, self.down = _powers(_BASE, size), _powers(_INVERSE, size)

    def runs(self, data: np.ndarray, width: int) -> np.ndarray:
        """The hash of every run of ``width`` bytes."""
        if len(data) > len(self.up):
            self.__init__(len(data))
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[: len(data)], out=sums[1:])
        count = len(data) - width + 1
        return _mixed((sums[width:] - sums[:count]) * self.down[:count])


def _sliding(values: np.ndarray, width: int, of) -> np.ndarray:
    """Minimum or maximum of every window of ``width`` values, in two running passes."""
    count = len(values) - width + 1
    pad = -len(values) % width
    worst = np.uint64(0xFFFFFFFFFFFFFFFF) if of is np.minimum else np.uint64(0)
    blocks = np.r_[values, np.full(pad, worst)].reshape(-1, width)
    ahead = of.accumulate(blocks, axis=1).ravel()
    back = of.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return of(back[:count], ahead[width - 1 : width - 1 + count])


def anchors(data: np.ndarray, hasher: Hasher, passage: int = PASSAGE, width: int = ANCHOR):
    """(hash, place, first passage, last passage): the anchors of a text and the passages each stands for.

    The anchor of a passage is the first of its runs of ``width`` bytes with the
    smallest hash. It depends on the passage's bytes alone, so equal passages have
    equal anchors at equal offsets. The passages of an anchor start in a row.
    """
    grams = hasher.runs(data, width)
    span = passage - width + 1
    least = _sliding(grams, span, np.minimum)
    passages = len(least)
    # A run is an anchor when it is the least of some passage that holds it.
    padded = np.r_[np.zeros(span - 1, np.uint64), least, np.zeros(span - 1, np.uint64)]
    is_anchor = _sliding(padded, span, np.maximum) == grams
    places = np.flatnonzero(is_anchor)
    nth = np.cumsum(is_anchor)[:passages] - is_anchor[:passages]
    wrong = np.flatnonzero(grams[places[nth]] != least)
    while len(wrong):
        nth[wrong] += 1
        wrong = wrong[grams[places[nth[wrong]]] != least[wrong]]
    first = np.flatnonzero(np.r_[True, nth[1:] != nth[:-1]])
    last = np.r_[first[1:], passages] - 1
    own = places[nth[first]]
    return grams[own], own, first, last


def _text_key(data: bytes) -> tuple[int, int]:
    digest = hashlib.sha256(data).digest()
    return int.from_bytes(digest[:8], "big", signed=True), int.from_bytes(digest[8:16], "big", signed=True)


def _spot(first, last, place):
    """First passage, number of further passages and the anchor's offset, in one long."""
    return (first << 32) | ((last - first) << 16) | (place - first)


def _collapsed(grams, digest, more, spot, passage: int):
    """Rows to look up, and runs: spans that a text repeats itself stand once, and are runs already."""
    order = np.lexsort((more, digest, grams))
    same = np.all([np.diff(part[order].view(np.int64)) == 0 for part in (grams, digest, more)], axis=0)
    again = np.r_[False, same]
    own = spot[order[again | np.r_[same, False]]]
    own = own[np.argsort(own >> 32, kind="stable")]
    first, ends = own >> 32, (own >> 32) + (own >> 16 & 0xFFFF) + passage
    reach = np.maximum.accumulate(ends)
    opens = np.flatnonzero(np.r_[True, first[1:] > reach[:-1]][: len(first)])
    closes = np.r_[opens[1:], len(first)][: len(opens)] - 1
    return order[~again], first[opens], reach[closes]


def _find_anchors(passage: int, width: int):
    """Rows (h, c, d, t1, t2, spot, kind) of each text: its anchors, and the runs (c to spot, kind 2) that it repeats itself.

    c and d are the 128-bit digest of the span around the anchor. Spans of one
    anchor share h, so the digest alone tells them apart.
    """

    def of_text(data: bytes, hasher: Hasher) -> np.ndarray:
        t1, t2 = _text_key(data)
        parts = []
        for start in range(0, len(data) - passage + 1, _PIECE):
            piece = data[start : start + _PIECE + passage - 1]
            grams, place, first, last = anchors(np.frombuffer(piece, np.uint8), hasher, passage, width)
            spans = zip(first.tolist(), (last + passage).tolist(), strict=True)
            digest = np.frombuffer(b"".join([xxhash.xxh3_128_digest(piece[a:b]) for a, b in spans]), ">u8")
            digest, more = digest.astype(np.uint64).reshape(-1, 2).T
            # Equal spans are the same passages only around an anchor at the same offset.
            digest = digest ^ _mixed((place - first).astype(np.uint64) + np.uint64(1))
            parts.append((grams, digest, more, _spot(first + start, last + start, place + start)))
        grams, digest, more, spot = (np.concatenate(p) for p in zip(*parts, strict=True))
        starts = ends = np.empty(0, np.int64)
        if len(set(grams.tolist())) < len(grams):
            keep, starts, ends = _collapsed(grams, digest, more, spot, passage)
            grams, digest, more, spot = grams[keep], digest[keep], more[keep], spot[keep]
        out = np.zeros((7, len(grams) + len(starts)), np.int64)
        out[0] = np.r_[grams.view(np.int64), np.full(len(starts), t1 ^ t2)]
        out[1] = np.r_[digest.view(np.int64), starts]
        out[2, : len(grams)] = more.view(np.int64)
        out[3], out[4], out[5] = t1, t2, np.r_[spot, ends]
        out[6, len(grams) :] = 2
        return out

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(1 << 16)
        for batch in batches:
            rows, held = [], 0
            for n, text in enumerate(batch.column(0)):
                data = text.as_py()
                if len(data) >= passage:
                    rows.append(of_text(data, hasher))
                    held += rows[-1].shape[1]
                if held >= _ROWS or (rows and n + 1 == batch.num_rows):
                    yield _record(np.concatenate(rows, axis=1), _ROW)
                    rows, held = [], 0

    return find


_ROW = ("h", "c", "d", "t1", "t2", "spot", "kind")
_ROW_SCHEMA = ", ".join(f"{name} long" for name in _ROW)


def _record(table: np.ndarray, names: tuple[str, ...]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in table], list(names))


def _find_repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (h, c, d, t1, t2, spot): those whose anchor repeats, told apart by ``kind``.

    Kind 0: the whole span repeats, so all its passages do. Kind 1: one row for
    each span of an anchor that has several, to be compared closely; it may be
    a row of kind 0 too. Runs, kind 2, pass through. The rows of one anchor need not be held together: what
    matters is the row before and after, and whether an anchor's first span,
    one held row, is followed by another span.
    """

    def rows_of(table: np.ndarray, kind: int) -> pa.RecordBatch:
        return _record(np.r_[table[:6], np.full((1, table.shape[1]), kind)], _ROW)

    held = np.empty((6, 0), np.int64)
    before: tuple[int, int, int] | None = None  # the span before the held row
    first_of: np.ndarray | None = None  # the first row of the held row's anchor, until a second span comes

    def settle(table: np.ndarray, final: bool) -> Iterator[pa.RecordBatch]:
        nonlocal held, before, first_of
        n = table.shape[1] if final else table.shape[1] - 1
        if n <= 0:
            held = table
            return
        h = table[0]
        same_h, same_c = h[1:] == h[:-1], np.all(table[:3, 1:] == table[:3, :-1], axis=0)
        prev_h = before is not None and before[0] == h[0]
        prev_c = prev_h and before == tuple(table[:3, 0].tolist())
        as_prev_h, as_prev_c = np.r_[prev_h, same_h][:n], np.r_[prev_c, same_c][:n]
        as_next_c = np.r_[same_c, False][:n]
        # The same span of the same text, from a copy of the text, is needed once.
        same_row = np.r_[False, same_c & np.all(table[3:, 1:] == table[3:, :-1], axis=0)][:n]
        whole_span = (as_prev_c | as_next_c) & ~same_row
        if whole_span.any():
            yield rows_of(table[:, :n][:, whole_span], 0)
        opens = ~as_prev_c  # rows that open a span
        starts = ~as_prev_h  # rows that open an anchor
        anchor = np.cumsum(starts) - starts[0]
        later = np.flatnonzero(opens & ~starts)
        firsts = np.flatnonzero(starts)
        if first_of is not None and not starts[0] and len(later) and anchor[later[0]] == 0:
            yield rows_of(first_of, 1)
            first_of = None
        need = np.unique(anchor[later])
        mine = firsts[np.isin(anchor[firsts], need)]
        close = np.sort(np.r_[mine, later])
        if len(close):
            yield rows_of(table[:, close], 1)
        if len(firsts):
            tail = firsts[-1]
            first_of = None if np.isin(anchor[tail], need) else table[:, tail : tail + 1]
        before = tuple(table[:3, n - 1].tolist())
        held = table[:, n:]

    for batch in batches:
        if batch.num_rows:
            new = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(7)])
            runs = new[6] == 2
            if runs.any():
                yield rows_of(new[:, runs], 2)
            yield from settle(np.concatenate([held, new[:6, ~runs]], axis=1), False)
    if held.shape[1]:
        yield from settle(held, True)


def _repeats(found: DataFrame, share: int = HOT_SHARE) -> DataFrame:
    """What ``_find_repeats`` finds, however many rows one anchor has.

    Anchors are counted before rows are shuffled. Those with more than
    1/``share`` of the rows, ``share`` of them at most, are not sorted by one
    task: their spans are counted, with one row for each span and task in the
    shuffle, and members of spans found twice are marked where they are. Only
    one row of each different span is sorted by anchor.
    """
    counts = found.filter("kind = 0").groupBy("h").agg(F.count("*").alias("n"))
    hot = stored(counts.filter(F.col("n") * share > F.lit(found.count())).select("h"), "suffix-hot")

    def sorted_repeats(rows: DataFrame) -> DataFrame:
        rows = rows.repartition("h").sortWithinPartitions("h", "c", "d", "t1", "t2", "spot")
        return rows.mapInArrow(_find_repeats, _ROW_SCHEMA)

    if hot.isEmpty():
        return sorted_repeats(found)
    marked = found.join(F.broadcast(hot.withColumn("_hot", F.lit(True))), "h", "left")
    is_hot = F.col("_hot").isNotNull() & (F.col("kind") == 0)
    members = marked.filter(is_hot).select(*_ROW[:-1])
    span = F.struct("h", "c", "d")
    classes = members.groupBy("h", "c", "d").agg(F.count("*").alias("n"), F.min(F.struct("t1", "t2", "spot")).alias("first"))
    classes = stored(classes, "suffix-spans")
    twice = classes.filter("n > 1").select(span.alias("span"), "n")
    whole_spans = join_hot(members.withColumn("span", span), twice, "span", "n", members.count())
    # Copies of a text have the same rows; one of each is needed.
    whole_spans = whole_spans.select(*_ROW[:-1]).distinct().withColumn("kind", F.lit(0).cast("long"))
    once = classes.select("h", "c", "d", "first.*", F.lit(0).cast("long").alias("kind"))
    # Sorted by anchor, one row a span: nothing repeats, so what comes back is to be compared closely.
    close = sorted_repeats(once)
    return sorted_repeats(marked.filter(~is_hot).select(*_ROW)).unionByName(whole_spans).unionByName(close)


def _cut_contexts(passage: int):
    """The bytes of each span, from the text."""
    names = ["h", "t1", "t2", "spot", "span"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers, spans = [], []
            for n in range(batch.num_rows):
                t1, t2, data = (batch.column(i)[n].as_py() for i in range(3))
                own = batch.column(3)[n].values
                h, at = (own.field(k).to_numpy(zero_copy_only=False) for k in (0, 1))
                first, more = at >> 32, at >> 16 & 0xFFFF
                spans += [data[a:b] for a, b in zip(first.tolist(), (first + more + passage).tolist(), strict=True)]
                numbers.append(np.stack([h, np.full(len(h), t1), np.full(len(h), t2), at]))
                if len(spans) >= _ROWS or n + 1 == batch.num_rows:
                    columns = [pa.array(np.ascontiguousarray(c)) for c in np.concatenate(numbers, axis=1)]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(spans, pa.binary())], names)
                    numbers, spans = [], []

    return cut


class Suffixes:
    """Strings in rows of bytes, to be sorted inside groups with hashed comparisons."""

    def __init__(self, group: np.ndarray, rows: list[bytes], width: int) -> None:
        self.group, self.width = group, width
        self.length = np.array([len(r) for r in rows], np.int64)
        self.data = np.zeros((len(rows), width), np.uint8)
        for n, row in enumerate(rows):
            self.data[n, : len(row)] = np.frombuffer(row, np.uint8)
        self.prefix = np.zeros((len(rows), width + 1), np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, width), axis=1, out=self.prefix[:, 1:])

    def common(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Length of the common extension of rows x and y, by binary search over prefix hashes."""
        low, high = np.zeros(len(x), np.int64), np.minimum(self.length[x], self.length[y])
        for _ in range(int(self.width).bit_length()):
            middle = (low + high + 1) >> 1
            same = self.prefix[x, middle] == self.prefix[y, middle]
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low

    def precedes(self, x: np.ndarray, y: np.ndarray, or_equal: bool) -> np.ndarray:
        """Whether row x comes before row y: by group, then by the byte after what they share."""
        n = self.common(x, y)
        x_ends, y_ends = n >= self.length[x], n >= self.length[y]
        at = np.minimum(n, self.width - 1)
        less = np.where(x_ends, ~y_ends | or_equal, ~y_ends & (self.data[x, at] < self.data[y, at]))
        return np.where(self.group[x] == self.group[y], less, self.group[x] < self.group[y])

    def sorted(self) -> tuple[np.ndarray, np.ndarray]:
        """Order of the rows, and what each shares with the one before it (-1 at a group's start).

        A bottom-up merge sort: every row of a run finds its place in the
        neighbouring run by binary search. What neighbours share is then checked
        byte by byte; should a hash have lied, the rows are sorted by their bytes.
        """
        order = np.arange(len(self.length))
        size = 1
        while size < len(order):
            at = np.arange(len(order))
            run = at // size
            right = run % 2 == 1
            start = np.where(right, (run - 1) * size, np.minimum((run + 1) * size, len(order)))
            low, high = start.copy(), np.minimum(start + size, len(order))
            open_ = low < high
            while open_.any():
                q = np.flatnonzero(open_)
                middle = (low[q] + high[q]) >> 1
                own, other = order[at[q]], order[middle]
                # Ties keep the left run first, so the sort is stable.
                after = np.where(right[q], ~self.precedes(own, other, False), self.precedes(other, own, False))
                low[q], high[q] = np.where(after, middle + 1, low[q]), np.where(after, high[q], middle)
                open_[q] = low[q] < high[q]
            base = np.where(right, (run - 1) * size, run * size)
            spot = base + (at - run * size) + (low - start)
            merged = np.empty_like(order)
            merged[spot] = order
            order, size = merged, 2 * size
        shared, right_order = self._checked(order)
        if not right_order:
            rows = [self.data[n, : self.length[n]].tobytes() for n in range(len(order))]
            order = np.array(sorted(range(len(order)), key=lambda n: (self.group[n], rows[n])), np.int64)
            shared, _ = self._checked(order)
        return order, shared

    def _checked(self, order: np.ndarray) -> tuple[np.ndarray, bool]:
        """What neighbours share by their bytes, and whether they are in order by them."""
        shared = np.full(len(order), -1, np.int64)
        if len(order) < 2:
            return shared, True
        x, y = order[:-1], order[1:]
        differ = self.data[x] != self.data[y]
        most = np.minimum(self.length[x], self.length[y])
        n = np.minimum(np.where(differ.any(axis=1), differ.argmax(axis=1), self.width), most)
        at = np.minimum(n, self.width - 1)
        fine = (n >= self.length[x]) | ((n < self.length[y]) & (self.data[x, at] < self.data[y, at]))
        same = self.group[x] == self.group[y]
        shared[1:] = np.where(same, n, -1)
        return shared, bool((fine | ~same).all())


def repeated_runs(group: np.ndarray, spot: np.ndarray, spans: list[bytes], passage: int = PASSAGE):
    """(row, start, end): runs of bytes whose passages occur in another row of the same group too.

    Rows are spans around one anchor. Two passages are equal when they have the
    anchor at the same offset, share the bytes left of it, and those from it on:
    so the bytes from the anchor on are sorted as suffixes, the bytes before it,
    reversed, as well, and for each offset rows that share enough on both sides
    fall into one class.
    """
    first, more, offset = spot >> 32, spot >> 16 & 0xFFFF, spot & 0xFFFF
    place = first + offset
    right = Suffixes(group, [s[o:] for s, o in zip(spans, offset.tolist(), strict=True)], passage)
    left = Suffixes(group, [s[:o][::-1] for s, o in zip(spans, offset.tolist(), strict=True)], passage)
    (right_order, right_shared), (left_order, left_shared) = right.sorted(), left.sorted()
    n = len(spans)
    right_class, left_class = np.empty(n, np.int64), np.empty(n, np.int64)
    span = int(offset.max()) + 1
    repeated = np.zeros((n, span + 1), bool)
    for back in range(span):
        own = np.flatnonzero((offset - more <= back) & (back <= offset))
        if len(own) < 2:
            continue
        right_class[right_order] = np.cumsum(right_shared < passage - back)
        left_class[left_order] = np.cumsum(left_shared < back)
        both = right_class[own] * (n + 1) + left_class[own]
        order = np.argsort(both, kind="stable")
        same = np.diff(both[order]) == 0
        repeated[own[order], back] = np.r_[same, False] | np.r_[False, same]
    edge = np.diff(repeated.astype(np.int8), axis=1, prepend=0)
    row, opens = np.nonzero(edge == 1)
    _, closes = np.nonzero(edge == -1)
    # Passages start at place - back; back runs from opens to closes - 1.
    return row, place[row] - closes + 1, place[row] - opens + passage


def _compare(passage: int, rows_at_once: int):
    """Repeated runs of a partition sorted by anchor, some whole groups at a time."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(h, t1, t2, spot, spans) -> pa.RecordBatch:
            row, start, end = repeated_runs(np.cumsum(np.r_[False, h[1:] != h[:-1]]), spot, spans, passage)
            columns = [pa.array(t1[row]), pa.array(t2[row]), pa.array(start), pa.array(end)]
            return pa.RecordBatch.from_arrays(columns, ["t1", "t2", "start", "end"])

        numbers, spans = np.empty((4, 0), np.int64), []
        for batch in batches:
            new = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)])
            numbers, spans = np.concatenate([numbers, new], axis=1), [*spans, *batch.column(4).to_pylist()]
            while len(spans) > rows_at_once:
                h = numbers[0]
                # Groups are at most as large as this, so one ends within twice as many rows.
                ends = np.flatnonzero(h[1:] != h[:-1]) + 1
                ends = ends[ends <= max(rows_at_once, ends[0] if len(ends) else 0)]
                if not len(ends):
                    break
                cut = int(ends[-1])
                yield out(*numbers[:, :cut], spans[:cut])
                numbers, spans = numbers[:, cut:], spans[cut:]
        if spans:
            yield out(*numbers, spans)

    return compare


def _single_passages(passage: int):
    """Every passage of a span by its digest, for anchors with very many spans."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, numbers, held = [], [], 0
            for n in range(batch.num_rows):
                t1, t2, spot, span = (batch.column(i)[n].as_py() for i in range(1, 5))
                count = len(span) - passage + 1
                digests += [xxhash.xxh3_128_digest(span[i : i + passage]) for i in range(count)]
                numbers.append(np.stack([np.full(count, t1), np.full(count, t2), np.arange(count) + (spot >> 32)]))
                held += count
                if held >= _ROWS or n + 1 == batch.num_rows:
                    columns = [pa.array(np.ascontiguousarray(c)) for c in np.concatenate(numbers, axis=1)]
                    yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), *columns], ["digest", "t1", "t2", "start"])
                    digests, numbers, held = [], [], 0

    return spread


def _cut_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without the union of their runs."""
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        lengths, spans, kept = [], [], []
        for n in range(batch.num_rows):
            data, runs = batch.column(2)[n].as_py(), batch.column(3)[n].as_py() or []
            union: list[list[int]] = []
            for run in sorted((r["start"], r["end"]) for r in runs):
                if union and run[0] <= union[-1][1]:
                    union[-1][1] = max(union[-1][1], run[1])
                else:
                    union.append(list(run))
            edges = [0, *(x for run in union for x in run), len(data)]
            lengths.append(len(data))
            spans.append([{"start": a, "end": b} for a, b in union])
            kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
        columns = [batch.column(0), batch.column(1), pa.array(lengths, pa.int64()), pa.array(spans, spans_type), pa.array(kept, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["t1", "t2", "n_bytes", "spans", "kept"])


_SPANS = "array<struct<start:bigint,end:bigint>>"


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    passage: int = PASSAGE,
    width: int = ANCHOR,
    largest_group: int = 1 << 14,
) -> DataFrame:
    """One row per document: doc_id, n_bytes, spans, kept.

    Every byte goes that a string of ``passage`` bytes covers which starts at
    another place too, in the same document or another, overlaps included; all
    is judged on the input. ``spans`` are the maximal removed runs (start, end
    exclusive, in UTF-8 bytes), ``kept`` the bytes that are left, joined. Texts
    shorter than ``passage``, null and empty ones keep everything; of repeated
    rows and copies each counts as another place, so nothing is left of them.
    An empty table gives no rows. Other columns are not looked at.

    Passages meet at anchors, one for about every 65 bytes. What a text repeats
    itself, such as a line said a hundred times, is settled in its own task, and
    one anchor stands for it. One shuffle brings equal anchors together in sorted
    order, except those with more than 1/1000 of all rows, whose spans are counted; where the whole span around an
    anchor is repeated (told by a 128-bit digest), all its passages are. Only
    the spans at which repeats begin or end are fetched from their texts and
    sorted as suffixes, byte for byte checked. An anchor with more than
    ``largest_group`` different spans is not sorted by one task: its passages
    are counted by digest instead. Texts without a repeated anchor are not
    shuffled.
    """
    text = whole(text_col).cast("binary")
    key = F.sha2(text, 256)
    half = lambda at: F.conv(F.substring(key, at, 16), 16, -10).cast("long")
    found = docs.select(text.alias("text")).mapInArrow(_find_anchors(passage, width), _ROW_SCHEMA)
    repeats = stored(_repeats(stored(found, "suffix-anchors")), "suffix-repeats")
    # The texts that have any, once each.
    touched = repeats.select("t1", "t2").distinct().withColumn("key", F.xxhash64("t1", "t2"))
    words = repeat_filter(touched, "key", least=1)
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), half(1).alias("t1"), half(17).alias("t2"))
    flagged = maybe_repeated(rows.withColumn("key", F.xxhash64("t1", "t2")), "key", words, "_maybe")
    texts = flagged.filter("_maybe").groupBy("t1", "t2").agg(F.min("text").alias("text"))
    texts = stored(texts, "suffix-texts")

    close = repeats.filter("kind = 1")
    spots = close.groupBy("t1", "t2").agg(F.collect_list(F.struct("h", "spot")).alias("spots"))
    contexts = texts.join(spots, ["t1", "t2"]).select("t1", "t2", "text", "spots")
    contexts = contexts.mapInArrow(_cut_contexts(passage), "h long, t1 long, t2 long, spot long, span binary")
    contexts = stored(contexts, "suffix-contexts")
    sizes = close.groupBy("h").agg(F.count("*").alias("n"))
    large = stored(sizes.filter(F.col("n") > largest_group).select("h"), "suffix-large")
    near = contexts.join(large, "h", "left_anti").repartition("h").sortWithinPartitions("h", "t1", "t2", "spot")
    near = near.select("h", "t1", "t2", "spot", "span")
    runs = near.mapInArrow(_compare(passage, max(largest_group, _AT_ONCE)), "t1 long, t2 long, start long, end long")
    if not large.isEmpty():
        runs = runs.unionByName(_counted_runs(contexts.join(large, "h", "left_semi"), passage))
    first = F.shiftright("spot", 32)
    all_spans = repeats.filter("kind = 0").select(
        "t1", "t2", first.alias("start"), (first + F.expr("(spot >> 16) & 65535") + passage).alias("end")
    )
    own_runs = repeats.filter("kind = 2").select("t1", "t2", F.col("c").alias("start"), F.col("spot").alias("end"))
    runs = runs.unionByName(all_spans).unionByName(own_runs).groupBy("t1", "t2")
    runs = runs.agg(F.collect_list(F.struct("start", "end")).alias("runs"))
    cut = texts.join(runs, ["t1", "t2"], "left").select("t1", "t2", "text", "runs")
    cut = cut.mapInArrow(_cut_texts, f"t1 long, t2 long, n_bytes long, spans {_SPANS}, kept binary")
    cut = stored(cut.withColumn("key", F.concat_ws(":", "t1", "t2")), "suffix-cut")

    alone = flagged.filter(~F.col("_maybe")).select(
        "doc_id",
        F.octet_length("text").cast("long").alias("n_bytes"),
        F.array().cast(_SPANS).alias("spans"),
        F.col("text").alias("kept"),
    )
    members = flagged.filter("_maybe").select("doc_id", F.concat_ws(":", "t1", "t2").alias("key"))
    members = stored(members, "suffix-members")
    counts = members.groupBy("key").agg(F.count("*").alias("n"))
    sized = cut.join(counts, "key").select("key", "n_bytes", "spans", "kept", "n")
    together = join_hot(members, sized, "key", "n", members.count())
    return alone.unionByName(together.select("doc_id", "n_bytes", "spans", "kept"))


def _counted_runs(contexts: DataFrame, passage: int) -> DataFrame:
    """Repeated runs of spans, by counting the digests of all their passages."""
    rows = contexts.select("h", "t1", "t2", "spot", "span")
    singles = rows.mapInArrow(_single_passages(passage), "digest binary, t1 long, t2 long, start long")
    singles = stored(singles, "suffix-passages")
    counts = singles.groupBy("digest").agg(F.count("*").alias("n")).filter("n > 1")
    hits = join_hot(singles, stored(counts, "suffix-counts"), "digest", "n", singles.count())
    return hits.select("t1", "t2", "start", (F.col("start") + passage).alias("end"))
