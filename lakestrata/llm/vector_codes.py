"""Vectors as short codes: each part of a vector becomes the number of its nearest codebook entry."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.common import forget, shipped, stored_at
from lakestrata.llm.repeats import join_hot
from lakestrata.session import work_dir

shipped(__name__)

#: Entries a part's bounds are kept for at first.
NEAREST = 8
#: Components are held to this size, up to which a double has every whole number.
LARGEST = 1 << 53
_LONG = (1 << 63) - 1
# Bounds are rounded away from the distance they bound, by more than doubles and floats are off.
_OUT, _IN = 1 + 1e-9, 1 - 1e-9


@dataclass
class Codebook:
    """The entries of one part as exact integers, and as doubles for arithmetic."""

    exact: list[list[int]]

    def __post_init__(self) -> None:
        width = len(self.exact[0])
        self.near = np.array(self.exact, np.float64).reshape(len(self.exact), width)
        self.squares = (self.near**2).sum(1)
        self.largest = float(np.abs(self.near).max(initial=0.0))

    def distances(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
        """Squared distances of rows to all entries, and by how much each row's may be off; None: they are exact."""
        squares = (x**2).sum(1)
        found = np.maximum(squares[:, None] - 2 * (x @ self.near.T) + self.squares[None, :], 0.0)
        reach = max(float(np.abs(x).max(initial=0.0)), self.largest)
        if 8 * reach * reach * max(x.shape[1], 1) < LARGEST:
            return found, None
        off = 2.0**-50 * (x.shape[1] + 4) * (squares + self.squares.max())
        return found, off

    def integer_distance(self, row: np.ndarray, entry: int) -> int:
        return sum((int(a) - b) ** 2 for a, b in zip(row, self.exact[entry], strict=True))


def _below(squared: np.ndarray, off) -> np.ndarray:
    """A float that is no more than the distance."""
    bound = (np.sqrt(np.maximum(squared - off, 0.0)) * _IN).astype(np.float32)
    return np.nextafter(bound, np.float32(-np.inf))


def _above(squared: np.ndarray, off) -> np.ndarray:
    bound = (np.sqrt(squared + off) * _OUT).astype(np.float32)
    return np.nextafter(bound, np.float32(np.inf))


def state_type(nearest: int) -> np.dtype:
    """What is kept of a part: its entry with an upper bound, the next ``nearest`` with lower bounds, one for all others."""
    return np.dtype(
        [("entry", "u1"), ("upper", "<f4"), ("next", "u1", (nearest,)), ("lower", "<f4", (nearest,)), ("outer", "<f4")]
    )


def assign_all(x: np.ndarray, book: Codebook, nearest: int) -> np.ndarray:
    """The state of rows from their distances to all entries."""
    state = np.empty(len(x), state_type(nearest))
    squared, off = book.distances(x)
    entry = squared.argmin(1)
    if off is not None:
        close = squared <= squared.min(1)[:, None] + 2 * off[:, None]
        for n in np.flatnonzero(close.sum(1) > 1):
            # Too close to call by doubles.
            entry[n] = min(np.flatnonzero(close[n]), key=lambda e, n=n: (book.integer_distance(x[n], int(e)), e))
    off = np.zeros(len(x)) if off is None else off
    rows = np.arange(len(x))
    state["entry"] = entry
    state["upper"] = _above(squared[rows, entry], off)
    count = len(book.exact)
    squared[rows, entry] = np.inf
    # The nearest others and one more, which bounds all that are left.
    some = min(nearest + 1, count - 1)
    order = np.argpartition(squared, max(some - 1, 0), axis=1)[:, :some]
    far = np.take_along_axis(squared, order, 1)
    by_far = np.argsort(far, axis=1)
    order, far = np.take_along_axis(order, by_far, 1), np.take_along_axis(far, by_far, 1)
    state["next"] = order[:, :nearest]
    state["lower"] = _below(far[:, :nearest], off[:, None])
    state["outer"] = _below(far[:, nearest], off) if nearest < some else np.inf
    return state


def reassign(
    x: np.ndarray, book: Codebook, old: np.ndarray, moved: np.ndarray, nearest: int
) -> tuple[np.ndarray, np.ndarray]:
    """The state of rows after the entries moved, and how many rows needed how many bounds.

    Bounds are widened by how far entries moved. A row whose upper bound stays
    below all lower ones keeps its entry; else its own distance is taken anew;
    else those to its nearest entries are, where the bound of all others still
    holds; else all. Bounds only rule out what is strictly farther, so that ties
    are always settled by whole numbers.
    """
    state = np.empty(len(old), state_type(nearest))
    shift = moved.astype(np.float64)
    lower = old["lower"] - shift[old["next"]]
    outer = old["outer"] - shift.max(initial=0.0)
    if lower.shape[1] > nearest:
        outer = np.minimum(outer, lower[:, nearest:].min(1))
    state["entry"] = old["entry"]
    state["next"] = old["next"][:, :nearest]
    state["upper"] = np.nextafter((old["upper"] + shift[old["entry"]]).astype(np.float32), np.float32(np.inf))
    state["lower"] = np.nextafter(lower[:, :nearest].astype(np.float32), np.float32(-np.inf))
    state["outer"] = np.nextafter(outer.astype(np.float32), np.float32(-np.inf))

    def needed() -> np.ndarray:
        """How many of the bounds, the outer one last, do not lie above the upper bound."""
        bounds = np.concatenate([state["lower"], state["outer"][:, None]], axis=1)
        least = np.minimum.accumulate(bounds[:, ::-1], axis=1)[:, ::-1]
        return (least <= state["upper"][:, None]).sum(1)

    use = needed()
    unsure = np.flatnonzero(use)
    if len(unsure):
        own = ((x[unsure] - book.near[state["entry"][unsure]]) ** 2).sum(1)
        reach = max(float(np.abs(x).max(initial=0.0)), book.largest)
        exact = 8 * reach * reach * max(x.shape[1], 1) < LARGEST
        if exact:
            state["upper"][unsure] = _above(own, 0.0)
            use = needed()
        some = np.flatnonzero((use > 0) & (use <= nearest)) if exact else np.array([], int)
        if len(some):
            _settle(x[some], book, state, some)
        rest = np.flatnonzero(use > (nearest if exact else 0))
        if len(rest):
            state[rest] = assign_all(x[rest], book, nearest)
    return state, np.bincount(use, minlength=nearest + 2)


def _settle(x: np.ndarray, book: Codebook, state: np.ndarray, rows: np.ndarray) -> None:
    """Order a row's entry and its next ones by their distances anew."""
    some = np.concatenate([state["entry"][rows, None], state["next"][rows]], axis=1).astype(np.int64)
    some.sort(axis=1)
    squared = ((x[:, None, :] - book.near[some]) ** 2).sum(2)
    # Entries rise within a row, so a stable order puts the lower of equal ones first.
    order = np.argsort(squared, axis=1, kind="stable")
    some, squared = np.take_along_axis(some, order, 1), np.take_along_axis(squared, order, 1)
    state["entry"][rows] = some[:, 0]
    state["upper"][rows] = _above(squared[:, 0], 0.0)
    state["next"][rows] = some[:, 1:]
    state["lower"][rows] = _below(squared[:, 1:], 0.0)


def whole_vectors(column: pa.ListArray, width: int) -> np.ndarray:
    """floor(1024 x) of every component, rows filled up with zeros to ``width``."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    with np.errstate(over="ignore"):
        values = np.clip(np.floor(values * 1024), -LARGEST, LARGEST)
    if (lengths == width).all():
        return values.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width))
    out[np.arange(width)[None, :] < lengths[:, None]] = values
    return out


class _Sums:
    """Sums of the parts by entry, exact whatever their size."""

    def __init__(self, parts: int, entries: int, width: int) -> None:
        self.count = np.zeros((parts, entries), np.int64)
        self.total = np.zeros((parts, entries, width), object)

    def add(self, part: int, x: np.ndarray, entry: np.ndarray) -> None:
        order = np.argsort(entry, kind="stable")
        used, starts, counts = np.unique(entry[order], return_index=True, return_counts=True)
        small = float(np.abs(x).max(initial=0.0)) * len(x) < 2.0**62
        rows = x[order].astype(np.int64)
        sums = np.add.reduceat(rows if small else rows.astype(object), starts, axis=0)
        self.total[part, used] += sums.astype(object)
        self.count[part, used] += counts


def vector_codes(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    parts: int = 4,
    entries: int = 256,
    rounds: int = 4,
    nearest: int = NEAREST,
) -> tuple[DataFrame, list[list[list[int]]]]:
    """The code of every vector, and the codebooks: (vec_id, label, code binary, error), [part][entry][component].

    Rows whose vector is null or holds null, NaN or an infinity go. A component
    x counts as floor(1024 x), held to 2**53 in size; vectors shorter than the
    longest, or whose length ``parts`` does not divide, are filled up with
    zeros. A codebook begins as that part of the ``entries`` (256 at most)
    smallest ids, nulls last and equal ids by their vectors. Each round assigns
    every part to its nearest entry, the lower of equally near ones, and
    replaces each entry that was used by floor(sum / count); at last parts are
    assigned again. error is the squared distance to the code, the largest long
    where it does not fit. Repeated rows count each; an empty table gives no
    rows and no codebooks. Other columns are not looked at.

    Rows stay where they are. Each round reads and writes them once with their
    bounds, so a lost executor costs the round's files it held and not the
    rounds before; the table before is deleted. What meets on the driver are
    the sums of each entry, ``parts * entries`` rows. Bounds that few rows need
    are given up: see ``_fewer``.
    """
    spark = vectors.sparkSession
    good = F.forall(vector_col, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    kept = vectors.filter(F.col(vector_col).isNotNull()).filter(good)
    kept = kept.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector"))
    longest = kept.agg(F.max(F.size("vector"))).first()[0]
    types = {f.name: f.dataType.simpleString() for f in kept.schema}
    coded = f"vec_id {types['vec_id']}, label {types['label']}, code binary, error long"
    if longest is None:
        return spark.createDataFrame([], coded), []
    width = -(-longest // parts)

    # The bounded start: one row per entry.
    firsts = kept.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).select("vector").collect()
    listed = pa.array([row["vector"] for row in firsts], pa.list_(pa.float64()))
    start = whole_vectors(listed, width * parts)
    books = [[list(map(int, row[p * width : (p + 1) * width])) for row in start] for p in range(parts)]

    nearest = min(nearest, len(firsts) - 1)
    table, moved, held, place = kept, None, nearest, None
    for turn in range(rounds + 1):
        shared = spark.sparkContext.broadcast((books, moved))
        step = _Step(shared, width, held, nearest, last=turn == rounds)
        schema = f"vec_id {types['vec_id']}, label {types['label']}, vector {types['vector']}, state binary, code binary, error long, {_SUMS}"
        before, place = place, work_dir(spark, f"vector-codes-{turn}")
        table = stored_at(table.mapInArrow(step, schema), place)
        if before:
            forget(spark, before)
        if turn == rounds:
            break
        sums = _summed(table, width)
        held = nearest
        nearest = _fewer([row for row in sums if row["part"] < 0], nearest)
        books, moved = _updated(books, [row for row in sums if row["part"] >= 0], width)
        table = table.filter("part is null").select("vec_id", "label", "vector", "state")
    return table.select("vec_id", "label", "code", "error"), books


_SUMS = "part int, entry int, count long, total array<string>"


class _Step:
    """One pass over the rows: assign each part, and add up the parts by entry."""

    def __init__(self, shared, width: int, held: int, nearest: int, last: bool) -> None:
        self.shared, self.width, self.held, self.nearest, self.last = shared, width, held, nearest, last

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists, moved = self.shared.value
        books = [Codebook(entries) for entries in lists]
        parts, width = len(books), self.width
        sums = _Sums(parts, len(books[0].exact), width)
        needed = np.zeros(self.nearest + 2, np.int64)
        schema = None
        for batch in batches:
            if not batch.num_rows:
                continue
            schema = schema or _arrow_schema(batch.schema)
            whole = whole_vectors(batch.column(2), width * parts)
            old = None
            if moved is not None:
                packed = b"".join(batch.column(3).to_pylist())
                old = np.frombuffer(packed, state_type(self.held)).reshape(batch.num_rows, parts)
            state = np.empty((batch.num_rows, parts), state_type(self.nearest))
            for p, book in enumerate(books):
                x = whole[:, p * width : (p + 1) * width]
                if old is None:
                    state[:, p] = assign_all(x, book, self.nearest)
                else:
                    state[:, p], used = reassign(x, book, old[:, p], moved[p], self.nearest)
                    needed += used
                if not self.last:
                    sums.add(p, x, state["entry"][:, p])
            yield self._rows(batch, whole, books, state, schema)
        if schema is not None and not self.last:
            yield _sum_rows(sums, needed, schema)

    def _rows(self, batch, whole, books, state, schema) -> pa.RecordBatch:
        n = batch.num_rows
        columns = [batch.column(0), batch.column(1)]
        nothing = [pa.nulls(n, schema.field(name).type) for name in ("part", "entry", "count", "total")]
        if not self.last:
            size = state.dtype.itemsize * len(books)
            packed = state.tobytes()
            states = pa.array([packed[i * size : (i + 1) * size] for i in range(n)], pa.binary())
            columns += [batch.column(2), states, pa.nulls(n, pa.binary()), pa.nulls(n, pa.int64())]
        else:
            codes = np.ascontiguousarray(state["entry"])
            errors = _errors(whole, books, codes, self.width)
            columns += [pa.nulls(n, schema.field("vector").type), pa.nulls(n, pa.binary())]
            columns += [pa.array([row.tobytes() for row in codes], pa.binary()), pa.array(errors, pa.int64())]
        return pa.RecordBatch.from_arrays(columns + nothing, schema=schema)


def _errors(whole: np.ndarray, books: list[Codebook], codes: np.ndarray, width: int) -> list[int]:
    """Squared distances to the codes, summed over the parts, as whole numbers."""
    near = np.concatenate([book.near[codes[:, p]] for p, book in enumerate(books)], axis=1)
    reach = max(float(np.abs(whole).max(initial=0.0)), float(np.abs(near).max(initial=0.0)))
    if 4 * reach * reach * max(whole.shape[1], 1) < LARGEST:
        return ((whole - near) ** 2).sum(1).astype(np.int64).tolist()
    out = []
    for row, code in zip(whole, codes, strict=True):
        parts = (book.integer_distance(row[p * width : (p + 1) * width], code[p]) for p, book in enumerate(books))
        out.append(min(sum(parts), _LONG))
    return out


def _arrow_schema(given: pa.Schema) -> pa.Schema:
    fields = [given.field(name) for name in ("vec_id", "label", "vector")]
    return pa.schema(
        [pa.field(f.name, f.type) for f in fields]
        + [("state", pa.binary()), ("code", pa.binary()), ("error", pa.int64())]
        + [("part", pa.int32()), ("entry", pa.int32()), ("count", pa.int64()), ("total", pa.list_(pa.string()))]
    )


def _sum_rows(sums: _Sums, needed: np.ndarray, schema: pa.Schema) -> pa.RecordBatch:
    """One row for each entry that was used, and for each number of bounds."""
    rows = [(int(p), int(e), int(sums.count[p, e]), [str(v) for v in sums.total[p, e]]) for p, e in zip(*np.nonzero(sums.count), strict=True)]
    rows += [(-1, n, int(count), []) for n, count in enumerate(needed)]
    columns = [pa.nulls(len(rows), schema.field(i).type) for i in range(6)]
    columns += [pa.array(c, schema.field(i + 6).type) for i, c in enumerate(zip(*rows, strict=True))]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def _summed(table: DataFrame, width: int) -> list:
    """The sums of all tasks, added up by Spark: one row per entry."""
    totals = [F.sum(F.get("total", F.lit(i)).cast("decimal(38,0)")).alias(f"_{i}") for i in range(width)]
    rows = table.filter("part is not null").groupBy("part", "entry")
    return rows.agg(F.sum("count").alias("count"), *totals).collect()


def _updated(books: list, sums: list, width: int) -> tuple[list, np.ndarray]:
    """Each used entry as the floor of its mean, and how far (at most) each entry moved."""
    new = [[list(entry) for entry in book] for book in books]
    for row in sums:
        new[row["part"]][row["entry"]] = [int(row[f"_{i}"]) // row["count"] for i in range(width)]
    moved = [
        [float(sum((a - b) ** 2 for a, b in zip(x, y, strict=True))) ** 0.5 * _OUT for x, y in zip(old, now, strict=True)]
        for old, now in zip(books, new, strict=True)
    ]
    return new, np.array(moved)


def _fewer(needed: list, nearest: int) -> int:
    """As many bounds as serve nine in ten of the parts that lists of any length served; at least one."""
    counts = {row["entry"]: row["count"] for row in needed}
    served = sum(count for n, count in counts.items() if 0 < n <= nearest)
    upto = 0
    for n in range(1, nearest + 1):
        upto += counts.get(n, 0)
        if served and upto * 10 >= served * 9:
            return n
    return nearest


def codebooks_text(books: list[list[list[int]]]) -> str:
    """All components by part, entry and place, joined by commas."""
    return ",".join(str(v) for book in books for entry in book for v in entry)


def with_label_errors(codes: DataFrame) -> DataFrame:
    """``codes`` with label_error: the error summed over equal labels, nulls together, at most the largest long.

    Sums are combined before they are shuffled; a label with much of the rows is
    looked up by broadcast.
    """
    keyed = codes.withColumn("_label", F.struct("label"))
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(_LONG).cast("decimal(38,0)")).cast("long")
    sums = keyed.groupBy("_label").agg(total.alias("label_error"), F.count("*").alias("_rows"))
    return join_hot(keyed, sums, "_label", "_rows", keyed.count()).drop("_label", "_rows")


def hex_code(code: Column) -> Column:
    """Two lower-case hex digits for each part."""
    return F.lower(F.hex(code))


def books_digest(books: list[list[list[int]]]) -> str:
    return hashlib.sha256(codebooks_text(books).encode()).hexdigest()
