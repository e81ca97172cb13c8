"""Find the faults of conversations and mend them by the cheapest edits."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.common import shipped, stored

shipped(__name__)

#: Rows of a conversation that are held at a time; longer ones are mended in pieces of this many.
HELD = 16_384
_ROWS_OUT = 4096

# The faults, and the edits with their costs.
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)
RETAG_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 1, 2, 5, 5
KEEP, RETAG, DELETE, INSERT = "KRDI"
ROLES = {"u": "user", "a": "assistant"}

# What stands before a place, for roles that must read (s?(ua)+)?: nothing, a
# system row, an open user row, or a finished pair. Each wants one role next.
START, SYSTEM, OPEN, PAIRED = range(4)
_WANTS = {START: "u", SYSTEM: "u", OPEN: "a", PAIRED: "u"}
_AFTER = {"u": OPEN, "a": PAIRED}
_FINAL = (START, PAIRED)
_LEGAL = ("su", "ua", "au")

_HASH_PRIME, _HASH_BASE = (1 << 61) - 1, 911_382_323


class AuditTree:
    """Edit sequences as linked nodes that share their beginnings.

    A node is its parent and one more symbol, with its depth, a rolling hash of
    the whole sequence, and its ancestors 1, 2, 4, ... steps up. Equal sequences
    are one node, so where hashes agree the identity of the nodes settles
    whether it was a collision.
    """

    def __init__(self) -> None:
        self.symbol: list = [None]
        self.hash = [0]
        self.depth = [0]
        self.up: list[tuple[int, ...]] = [()]

    def child(self, node: int, symbol) -> int:
        ancestors, at = [node], 0
        while at < len(self.up[ancestors[-1]]):
            ancestors.append(self.up[ancestors[-1]][at])
            at += 1
        self.symbol.append(symbol)
        self.hash.append((self.hash[node] * _HASH_BASE + hash(symbol)) % _HASH_PRIME)
        self.depth.append(self.depth[node] + 1)
        self.up.append(tuple(ancestors))
        return len(self.symbol) - 1

    def ancestor(self, node: int, depth: int) -> int:
        climb = self.depth[node] - depth
        while climb:
            step = climb.bit_length() - 1
            node = self.up[node][step]
            climb -= 1 << step
        return node

    def differ(self, a: int, b: int) -> bool:
        return self.hash[a] != self.hash[b] or a != b

    def before(self, a: int, b: int) -> bool:
        """Whether the sequence of ``a`` is less than that of ``b``: by its first other symbol, else the shorter."""
        common = min(self.depth[a], self.depth[b])
        x, y = self.ancestor(a, common), self.ancestor(b, common)
        if not self.differ(x, y):
            return self.depth[a] < self.depth[b]
        # The highest ancestors that still differ stand right behind the common beginning.
        for step in reversed(range(len(self.up[x]))):
            if step < len(self.up[x]) and self.differ(self.up[x][step], self.up[y][step]):
                x, y = self.up[x][step], self.up[y][step]
        return self.symbol[x] < self.symbol[y]

    def symbols(self, node: int) -> list:
        out = []
        while node:
            out.append(self.symbol[node])
            node = self.up[node][0]
        return out[::-1]


class Cheapest:
    """For each state the cheapest edits so far; of equally cheap ones the least."""

    def __init__(self, start: int) -> None:
        self.tree = AuditTree()
        self.best: dict[int, tuple[int, int]] = {start: (0, 0)}

    def offer(self, best: dict, state: int, cost: int, node: int, symbol) -> None:
        held = best.get(state)
        if held is not None and held[0] < cost:
            return
        new = self.tree.child(node, symbol)
        if held is None or cost < held[0] or self.tree.before(new, held[1]):
            best[state] = (cost, new)

    def insert(self) -> None:
        """One row put in where that is cheaper than what is there."""
        before = dict(self.best)
        for state in (START, SYSTEM, PAIRED):
            if state in before:
                cost, node = before[state]
                self.offer(self.best, OPEN, cost + INSERT_COST, node, INSERT)
        if OPEN in self.best:
            cost, node = self.best[OPEN]
            self.offer(self.best, PAIRED, cost + INSERT_COST, node, INSERT)

    def row(self, initial: str, fault: int) -> None:
        self.insert()
        best: dict[int, tuple[int, int]] = {}
        extra = TRUNCATED_COST if fault == TRUNCATED else 0
        for state, (cost, node) in self.best.items():
            self.offer(best, state, cost + DELETE_COST, node, DELETE)
            if fault in (BLANK, DUPLICATE):
                continue
            wanted = _WANTS[state]
            if initial == wanted:
                self.offer(best, _AFTER[wanted], cost + extra, node, KEEP)
            elif state == START and initial == "s":
                self.offer(best, SYSTEM, cost + extra, node, KEEP)
            self.offer(best, _AFTER[wanted], cost + extra + RETAG_COST, node, RETAG)
        self.best = best

    def end(self) -> tuple[int, str]:
        self.insert()
        found = None
        for state in _FINAL:
            if state in self.best:
                cost, node = self.best[state]
                if found is None or cost < found[0] or (cost == found[0] and self.tree.before(node, found[1])):
                    found = (cost, node)
        return found[0], "".join(self.tree.symbols(found[1]))


@dataclass
class Faults:
    """The first fault of each row of a conversation, and what they come to."""

    seen: set = field(default_factory=set)
    counts: list[int] = field(default_factory=lambda: [0] * 4)
    illegal: int = 0
    first: str | None = None
    last: str | None = None

    def of(self, role: str, text: str, again: bool | None = None) -> int:
        if again is None:
            key = hashlib.blake2b(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass"), digest_size=16).digest()
            again = key in self.seen
            self.seen.add(key)
        solid = _last_solid(text)
        fault = BLANK if not solid else DUPLICATE if again else FINE if solid in ".!?" else TRUNCATED
        self.counts[fault] += 1
        initial = role[:1]
        if self.first is None:
            self.first = initial
        elif self.last + initial not in _LEGAL:
            self.illegal += 1
        self.last = initial
        return fault


def _last_solid(text: str) -> str:
    stripped = text.rstrip("\x20\x09\x0a\x0b\x0c\x0d")
    return stripped[-1:]


def mended(rows: Iterable[tuple[str, str]], audit: str, state: int = START) -> Iterator[tuple[str, str]]:
    """The rows after the edits of ``audit``, beginning in ``state``."""
    left = iter(rows)
    for edit in audit:
        role, text = (None, "") if edit == INSERT else next(left)
        if edit == DELETE:
            continue
        if edit == KEEP:
            state = SYSTEM if state == START and role[:1] == "s" else _AFTER[_WANTS[state]]
        else:
            role = ROLES[_WANTS[state]]
            state = _AFTER[_WANTS[state]]
        yield role, text


def _line(role: str, text: str) -> bytes:
    return f"{role}:{text}".encode("utf-8", "surrogatepass")


_REPORT = (
    "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
)
_OPEN = "part int, run int, at long, role string, text string"


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows of ``conversations`` with faults put in by a checksum of conversation and turn.

    Of 20 remainders 0 takes a row away (``present`` is false), 1 empties its
    text, 2 takes out its ``.!?``, 3 repeats it, and 4 makes its role user. Nulls
    are one space, but for ids and turns that are returned as they are.
    """

    def plain(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat_ws(":", plain("conv_id"), plain("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(plain("text"), "[.!?]", "")).otherwise(plain("text"))
    return conversations.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(plain("role")).alias("role"),
        text.alias("text"),
        (kind != 0).alias("present"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )


def repair(
    rows: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    present: Column | None = None,
    held: int = HELD,
) -> DataFrame:
    """One row per conversation: conv_id, its faults, the cheapest mending and a digest of what that leaves.

    The rows of a conversation are taken by turn, null turns first, rows of one
    turn by a hash of role and text; null roles and texts are one space. Rows for
    which ``present`` is false only name their conversation. gaps counts the
    whole turns missing between the first and the last one. A row is blank
    without a solid character (not ``[\\x20\\x09-\\x0D]``), else a duplicate if role
    and text were there before, else truncated if its last solid character is not
    one of ``.!?``. illegal counts neighbours whose role initials are not su, ua
    or au. audit is the cheapest sequence of K(eep), R(etag), D(elete) and
    I(nsert) after which the initials read ``(s?(ua)+)?``, the ASCII-least of
    equally cheap ones, cost its cost. repaired_sha256 is over the ``role:text``
    lines that it leaves. A conversation without rows has zeros, an empty audit
    and the digest of nothing; null conversation ids are one conversation; an
    empty table gives no rows. Other columns are not looked at.

    Rows are sorted into ranges of (conversation, turn), so that a conversation
    with a third of all rows is cut like any other data, and read as they come:
    conversations that lie inside a range are mended there, at most ``held`` rows
    at a time. The first and the last of each range, and longer ones, are mended
    in pieces: see ``_in_pieces``.
    """
    there = F.coalesce(present, F.lit(False)) if present is not None else F.lit(True)
    role, text = (F.when(there, F.coalesce(F.col(c).cast("string"), F.lit(" "))) for c in (role_col, text_col))
    plain = rows.select(
        F.col(conv_col).alias("conv_id"),
        F.col(turn_col).cast("long").alias("turn"),
        role.alias("role"),
        text.alias("text"),
        F.xxhash64(role, text).alias("hash"),
        F.monotonically_increasing_id().alias("row"),
    )
    order = ["conv_id", "turn", "hash", "row"]
    ranged = plain.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "turn", "role", "text")
    kind = ranged.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, closed boolean, report struct<{_typed(_REPORT)}>, turn long, {_OPEN}"
    passed = stored(ranged.mapInArrow(_pass(held), schema), "conversations")
    closed = passed.filter("closed").select("conv_id", "report.*")
    return closed.unionByName(_in_pieces(passed.filter("not closed"), kind, held))


def _typed(columns: str) -> str:
    return ", ".join(c.strip().replace(" ", ": ", 1) for c in columns.split(","))


def _same(a, b) -> bool:
    return a == b or (a != a and b != b)


def _pass(held: int):
    """Reports of the conversations that lie inside a range, the rows of the others as they are."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        out: list[dict] = []
        run, at, conv, buffer, streaming = -1, 0, None, [], True
        kinds = None

        def open_rows(lines):
            return [
                {"conv_id": conv, "closed": False, "report": None, "turn": turn, "part": part, "run": run, "at": n, "role": role, "text": text}
                for n, turn, role, text in lines
            ]

        def batch_of(some):
            return pa.RecordBatch.from_pylist(some, kinds)

        for batch in batches:
            if kinds is None:
                kinds = _arrow_schema(batch.schema.field("conv_id").type)
            for next_conv, turn, role, text in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if run < 0 or not _same(next_conv, conv):
                    if run >= 0 and not streaming:
                        out.append({"conv_id": conv, "closed": True, "report": _report(buffer)})
                        buffer = []
                    # The first one may have begun in the range before.
                    run, conv, streaming = run + 1, next_conv, run < 0
                line = (at, turn, role, text)
                at += 1
                if streaming:
                    out += open_rows([line])
                else:
                    buffer.append(line)
                    if len(buffer) > held:
                        out += open_rows(buffer)
                        buffer, streaming = [], True
                if len(out) >= _ROWS_OUT:
                    yield batch_of(out)
                    out = []
        # The last one may go on in the next range.
        out += open_rows(buffer)
        for start in range(0, len(out), _ROWS_OUT):
            yield batch_of(out[start : start + _ROWS_OUT])

    return read


def _arrow_schema(conv: pa.DataType) -> pa.Schema:
    report = [(name, pa.string() if name in ("audit", "repaired_sha256") else pa.int64()) for name, _ in _fields(_REPORT)]
    return pa.schema(
        [("conv_id", conv), ("closed", pa.bool_()), ("report", pa.struct(report)), ("turn", pa.int64())]
        + [("part", pa.int32()), ("run", pa.int32()), ("at", pa.int64()), ("role", pa.string()), ("text", pa.string())]
    )


def _fields(columns: str) -> list[tuple[str, str]]:
    return [tuple(c.split()) for c in columns.split(",")]


def _report(lines: list[tuple]) -> dict:
    """The report on a whole conversation."""
    turns = {turn for _, turn, role, _ in lines if turn is not None and role is not None}
    rows = [(role, text) for _, _, role, text in lines if role is not None]
    faults, best = Faults(), Cheapest(START)
    for role, text in rows:
        best.row(role[:1], faults.of(role, text))
    cost, audit = best.end()
    left = b"\n".join(_line(role, text) for role, text in mended(rows, audit))
    return {
        "gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        "blank": faults.counts[BLANK],
        "duplicate": faults.counts[DUPLICATE],
        "truncated": faults.counts[TRUNCATED],
        "illegal": faults.illegal,
        "cost": cost,
        "audit": audit,
        "repaired_sha256": hashlib.sha256(left).hexdigest(),
    }


_SEGMENT = "part int, run int, segment long"
_WAYS = "ways array<struct<start: int, finish: int, cost: long, rank: int, audit: string>>"


def _in_pieces(rows: DataFrame, kind: str, held: int) -> DataFrame:
    """Reports on conversations that lie in several ranges, or are long.

    Their rows are cut into segments of ``held`` rows at most. For each segment
    and each state before it the cheapest edits to each state behind it are found
    by themselves, and ranked, so that joining the segments of a conversation in
    order takes sixteen short entries of each and none of its texts. Repeats
    across segments are found by grouping. What remains in one task is what has
    no other form: the row of a conversation that holds its audit, and the SHA-256
    over its lines, which are streamed.
    """
    key = ["part", "run", "segment"]
    rows = rows.drop("closed", "report").withColumn("segment", F.floor(F.col("at") / held))
    present = rows.filter(F.col("role").isNotNull())
    said = ["conv_id", F.struct("role", F.sha2(F.col("text").cast("binary"), 256)).alias("said")]
    firsts = present.groupBy(*said).agg(F.min(F.struct("part", "run", "at")).alias("place"))
    firsts = firsts.select("place.*", F.lit(True).alias("new"))
    marked = rows.join(firsts, ["part", "run", "at"], "left").withColumn("new", F.coalesce("new", F.lit(False)))
    marked = stored(marked, "conversations-open")

    ways = marked.groupBy(*key).applyInPandas(
        _segment_ways,
        f"conv_id {kind}, {_SEGMENT}, first string, last string, blank long, duplicate long, truncated long, illegal long, {_WAYS}",
    )
    ways = stored(ways, "conversations-ways")
    slim = ways.withColumn("ways", F.transform("ways", lambda w: w.dropFields("audit")))
    chosen = slim.groupBy("conv_id").applyInPandas(
        _join_segments,
        f"conv_id {kind}, {_SEGMENT}, start int, finish int, blank long, duplicate long, truncated long, illegal long,"
        " cost long, tail string",
    )
    chosen = stored(chosen, "conversations-chosen")
    way = F.filter("ways", lambda w: (w["start"] == F.col("start")) & (w["finish"] == F.col("finish")))[0]
    taken = chosen.filter("part is not null").join(ways.select(*key, "ways"), key)
    taken = taken.select("conv_id", *key, "start", way["audit"].alias("piece"))

    pieces = taken.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(*key, "piece"))).alias("pieces"))
    audits = pieces.select("conv_id", F.array_join(F.transform("pieces", lambda p: p["piece"]), "").alias("body"))
    lines = marked.groupBy(*key).cogroup(taken.groupBy(*key)).applyInPandas(
        _mended_lines, f"conv_id {kind}, part int, run int, at long, nth int, line binary"
    )
    totals = chosen.filter("part is null").drop(*key, "start", "finish")
    tails = totals.select(
        "conv_id",
        F.lit((1 << 31) - 1).alias("part"),
        F.lit(0).alias("run"),
        F.lit(0).cast("long").alias("at"),
        F.posexplode(F.split("tail", "")).alias("nth", "initial"),
    ).filter("initial <> ''")
    added = F.when(F.col("initial") == "u", "user:").otherwise("assistant:").cast("binary")
    lines = lines.unionByName(tails.withColumn("line", added).drop("initial"))
    digests = (
        lines.repartition("conv_id")
        .sortWithinPartitions("conv_id", "part", "run", "at", "nth")
        .select("conv_id", "line")
        .mapInArrow(_digests, f"conv_id {kind}, repaired_sha256 string")
    )
    gaps = present.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn"), F.lit(0)).alias("gaps")
    )
    told = reduce(_beside, [audits, digests, gaps], totals)
    return told.select(
        "conv_id",
        F.coalesce("gaps", F.lit(0).cast("long")).alias("gaps"),
        "blank",
        "duplicate",
        "truncated",
        "illegal",
        "cost",
        F.concat(F.coalesce("body", F.lit("")), F.repeat(F.lit(INSERT), F.length("tail"))).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )


def _beside(left: DataFrame, right: DataFrame) -> DataFrame:
    """Joined by conversation, null ids too; ``right`` may lack some."""
    right = right.withColumnRenamed("conv_id", "_conv_id")
    return left.join(right, F.col("conv_id").eqNullSafe(F.col("_conv_id")), "left").drop("_conv_id")


def _segment_ways(rows: pd.DataFrame) -> pd.DataFrame:
    """The cheapest edits of one segment from each state to each state, ranked among those from one state."""
    rows = rows.sort_values("at")
    faults = Faults()
    steps = []
    for role, text, new in zip(rows["role"], rows["text"], rows["new"], strict=True):
        if role is not None:
            steps.append((role[:1], faults.of(role, text, again=not new)))
    ways = []
    for start in range(4):
        best = Cheapest(start)
        for step in steps:
            best.row(*step)
        found = [(cost, "".join(best.tree.symbols(node)), finish) for finish, (cost, node) in best.best.items()]
        for rank, (cost, audit, finish) in enumerate(sorted(found, key=lambda f: f[1])):
            ways.append({"start": start, "finish": finish, "cost": cost, "rank": rank, "audit": audit})
    own = rows.iloc[0]
    return pd.DataFrame(
        {
            "conv_id": rows["conv_id"].iloc[:1],
            "part": [own["part"]],
            "run": [own["run"]],
            "segment": [own["segment"]],
            "first": [faults.first],
            "last": [faults.last],
            "blank": [faults.counts[BLANK]],
            "duplicate": [faults.counts[DUPLICATE]],
            "truncated": [faults.counts[TRUNCATED]],
            "illegal": [faults.illegal],
            "ways": [ways],
        }
    )


def _join_segments(rows: pd.DataFrame) -> pd.DataFrame:
    """The way that the cheapest edits take through each segment of a conversation, and a row with the totals."""
    rows = rows.sort_values(["part", "run", "segment"])
    best = Cheapest(START)
    illegal, last = 0, None
    for row in rows.itertuples():
        after: dict[int, tuple[int, int]] = {}
        for way in row.ways:
            if way["start"] in best.best:
                cost, node = best.best[way["start"]]
                symbol = (int(way["rank"]), int(way["start"]), int(way["finish"]))
                best.offer(after, int(way["finish"]), cost + int(way["cost"]), node, symbol)
        best.best = after
        if row.first is not None:
            illegal += last is not None and last + row.first not in _LEGAL
            last = row.last
    # Rows put in at the end finish an open pair, or make one.
    ends = []
    for state, tail in ((START, ""), (PAIRED, ""), (OPEN, "a"), (SYSTEM, "ua")):
        if state in best.best:
            cost, node = best.best[state]
            ends.append((cost + INSERT_COST * len(tail), node, tail))
    won = ends[0]
    for end in ends[1:]:
        if end[0] < won[0] or (end[0] == won[0] and best.tree.before(end[1], won[1])):
            won = end
    steps = best.tree.symbols(won[1])
    count = len(rows)
    conv = rows["conv_id"].iloc[0]
    sums = {name: int(rows[name].sum()) for name in ("blank", "duplicate", "truncated", "illegal")}
    sums["illegal"] += illegal
    return pd.DataFrame(
        {
            "conv_id": pd.Series([conv] * (count + 1), dtype=rows["conv_id"].dtype),
            **{k: pd.array([*map(int, rows[k]), None], dtype="Int64") for k in ("part", "run", "segment")},
            "start": pd.array([s[1] for s in steps] + [None], dtype="Int64"),
            "finish": pd.array([s[2] for s in steps] + [None], dtype="Int64"),
            **{k: pd.array([None] * count + [v], dtype="Int64") for k, v in sums.items()},
            "cost": pd.array([None] * count + [int(won[0])], dtype="Int64"),
            "tail": [None] * count + [won[2]],
        }
    )


def _mended_lines(rows: pd.DataFrame, way: pd.DataFrame) -> pd.DataFrame:
    """The lines that the chosen edits leave of one segment, in order."""
    rows = rows[rows["role"].notna()].sort_values("at")
    left = list(mended(zip(rows["role"], rows["text"], strict=True), way["piece"].iloc[0], int(way["start"].iloc[0])))
    segment = int(way["segment"].iloc[0])
    return pd.DataFrame(
        {
            "conv_id": pd.Series([way["conv_id"].iloc[0]] * len(left), dtype=way["conv_id"].dtype),
            "part": int(way["part"].iloc[0]),
            "run": int(way["run"].iloc[0]),
            "at": segment,
            "nth": range(len(left)),
            "line": [_line(role, text) for role, text in left],
        }
    )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the newline-joined lines of each conversation, which come in order."""
    conv, digest, kind = None, None, None

    def told():
        columns = [pa.array([conv], kind), pa.array([digest.hexdigest()])]
        return pa.RecordBatch.from_arrays(columns, ["conv_id", "repaired_sha256"])

    for batch in batches:
        kind = batch.column(0).type
        for next_conv, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if digest is not None and _same(next_conv, conv):
                digest.update(b"\n" + line)
                continue
            if digest is not None:
                yield told()
            conv, digest = next_conv, hashlib.sha256(line)
    if digest is not None:
        yield told()
