"""Vector codes against plain k-means over Python integers."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from lakestrata.llm.vector_codes import (
    Codebook,
    assign_all,
    books_digest,
    codebooks_text,
    hex_code,
    reassign,
    vector_codes,
    with_label_errors,
)

HUGE = 1 << 53


def whole(vector, width, parts):
    row = [max(-HUGE, min(HUGE, math.floor(x * 1024) if abs(x) < 1e300 else int(math.copysign(HUGE, x)))) for x in vector]
    row += [0] * (width * parts - len(row))
    return [row[p * width : (p + 1) * width] for p in range(parts)]


def far(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b, strict=True))


def brute(rows, parts=4, entries=256, rounds=4):
    kept = [(i, v, label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return [], []
    width = -(-max(len(v) for _, v, _ in kept) // parts)
    points = [whole(v, width, parts) for _, v, _ in kept]
    order = sorted(range(len(kept)), key=lambda n: (kept[n][0] is None, kept[n][0] or 0, kept[n][1]))[:entries]
    books = [[points[n][p] for n in order] for p in range(parts)]

    def nearest():
        return [[min(range(len(book)), key=lambda e: (far(x[p], book[e]), e)) for p, book in enumerate(books)] for x in points]

    for _ in range(rounds):
        codes = nearest()
        for p in range(parts):
            for e in range(len(books[p])):
                own = [x[p] for x, code in zip(points, codes, strict=True) if code[p] == e]
                if own:
                    books[p][e] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    codes = nearest()
    errors = [min(sum(far(x[p], books[p][c]) for p, c in enumerate(code)), 2**63 - 1) for x, code in zip(points, codes, strict=True)]
    out = []
    for (i, _, label), code, error in zip(kept, codes, errors, strict=True):
        total = min(sum(e for (_, _, other), e in zip(kept, errors, strict=True) if other == label), 2**63 - 1)
        out.append((i, "".join(f"{c:02x}" for c in code), error, total))
    return sorted(out, key=str), books


def result(spark, rows, **options):
    table = spark.createDataFrame(
        [(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, label int, code string, part int"
    ).repartition(3)
    codes, books = vector_codes(table, **options)
    made = with_label_errors(codes).select("vec_id", hex_code(codes["code"]), "error", "label_error").collect()
    return sorted((tuple(r) for r in made), key=str), books


def clustered(draw, n, dims, spread=0.05):
    centres = [[draw.gauss(0, 1) for _ in range(dims)] for _ in range(12)]
    return [(n, [x + draw.gauss(0, spread) for x in draw.choice(centres)], draw.choice([1, 2, None])) for n in range(n)]


@pytest.mark.parametrize(("entries", "nearest"), [(256, 8), (16, 3), (5, 8), (1, 4)])
def test_codes_equal_plain_rounds(spark, entries, nearest):
    rows = clustered(random.Random(entries), 300, 8)
    assert result(spark, rows, entries=entries, nearest=nearest) == brute(rows, entries=entries)


def test_ties_copies_and_coarse_grids(spark):
    draw = random.Random(4)
    rows = [(draw.randrange(40), [draw.choice([0.0, 0.001, -0.001]) for _ in range(4)], 1) for _ in range(200)]
    assert result(spark, rows, entries=20) == brute(rows, entries=20)


def test_bad_vectors_go_and_odd_ones_are_filled_up(spark):
    rows = clustered(random.Random(5), 60, 8)
    rows += [(100, None, 1), (101, [1.0, None], 1), (102, [math.nan] * 8, 1), (103, [math.inf] * 8, 1), (104, [1.0] * 5, None)]
    rows += [(None, [0.5] * 8, 2), (None, [0.25] * 7, 2), (105, [], None)]
    assert result(spark, rows, entries=30) == brute(rows, entries=30)


def test_numbers_beyond_doubles_are_settled_by_integers(spark):
    draw = random.Random(6)
    base = float(1 << 41)
    rows = [(n, [base + draw.randrange(4) / 1024 for _ in range(8)], n % 2) for n in range(120)]
    rows += [(500, [1e300, -1e300] + [base] * 6, 7), (501, [-1e12] * 8, 7)]
    assert result(spark, rows, entries=12) == brute(rows, entries=12)


def test_few_vectors_and_none(spark):
    assert result(spark, [(3, [0.5] * 4, None)]) == brute([(3, [0.5] * 4, None)])
    assert result(spark, []) == ([], [])
    assert books_digest([[[1, -2]], [[3, 4]]]) and codebooks_text([[[1, -2]], [[3, 4]]]) == "1,-2,3,4"


def test_bounds_never_lose_the_nearest_entry():
    draw = np.random.default_rng(8)
    x = np.floor(draw.normal(size=(400, 6)) * 300)
    entries = np.floor(draw.normal(size=(40, 6)) * 300)
    book = Codebook(entries.astype(int).tolist())
    state = assign_all(x, book, 8)
    for nearest in (8, 5, 5, 2, 1):
        moved = np.floor(draw.normal(size=entries.shape) * draw.choice([0, 3, 40], size=(40, 1)))
        entries = entries + moved
        book = Codebook(entries.astype(int).tolist())
        state, used = reassign(x, book, state, np.sqrt((moved**2).sum(1)) * (1 + 1e-9), nearest)
        squared = ((x[:, None] - entries[None]) ** 2).sum(2)
        assert (state["entry"] == squared.argmin(1)).all()
        assert used.sum() == 400 and used[0] > 0
        true = np.sqrt(squared)
        rows = np.arange(400)
        assert (state["upper"] >= true[rows, state["entry"]]).all()
        assert (state["lower"] <= np.take_along_axis(true, state["next"].astype(int), 1)).all()
        for n in rows:
            listed = {int(state["entry"][n]), *map(int, state["next"][n])}
            assert state["outer"][n] <= min(d for e, d in enumerate(true[n]) if e not in listed)
