import numpy as np
import pytest
from pyspark.sql import functions as F

from eventlake.llm import codebooks as B

SCHEMA = "vec_id bigint, embedding array<float>, label int, v string, code string, error string, `__salt` string"


def table(spark, rows):
    return spark.createDataFrame([(i, e, y, "x", "x", "x", "x") for i, e, y in rows], SCHEMA)


def brute(rows, parts=4, entries=256, rounds=4):
    """Plain product k-means with full comparisons: [(vec_id, code, error)], books."""
    kept = [(i, [int(np.floor(float(np.float32(x)) * 1024)) for x in e], y) for i, e, y in rows
            if e is not None and all(x is not None and np.isfinite(x) for x in e)]
    x = np.array([e for _, e, _ in kept], object)
    w = x.shape[1] // parts
    x = x.reshape(len(kept), parts, w)
    first = sorted(((i, e, n) for n, (i, e, _) in enumerate(kept) if i is not None))[:entries]
    books = [[list(x[n, p]) for _, _, n in first] for p in range(parts)]

    def near(p, v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), k) for k, c in enumerate(books[p]))

    for r in range(rounds + 1):
        got = [[near(p, x[n, p]) for p in range(parts)] for n in range(len(kept))]
        if r < rounds:
            for p in range(parts):
                for k in range(len(books[p])):
                    mine = [x[n, p] for n in range(len(kept)) if got[n][p][1] == k]
                    if mine:
                        books[p][k] = [sum(col) // len(mine) for col in zip(*mine, strict=True)]
    out = [(kept[n][0], bytes(k for _, k in got[n]), sum(d for d, _ in got[n]), kept[n][2]) for n in range(len(kept))]
    return out, books


def rows_of(rng, n, width=8, centres=12, spread=0.05):
    c = rng.normal(size=(centres, width))
    return [(i, [float(x) for x in c[i % centres] + spread * rng.normal(size=width)], int(i % 3) if i % 5 else None) for i in range(n)]


@pytest.mark.parametrize("entries", [1, 7, 40, 256])
def test_equals_full_search(spark, rng, entries):
    rows = rows_of(rng, 150)
    rows += [(3, rows[3][1], 1), (None, rows[4][1], 1), (None, rows[9][1], None), (900, None, 1), (901, [None] * 8, 1),
             (902, [float("nan")] + [0.0] * 7, 1), (903, [float("inf")] + [0.0] * 7, 1)]
    rows += [(2000 + i, rows[0][1], 2) for i in range(60)] + [(3000 + i, [float(i % 2)] * 8, 2) for i in range(10)]
    coded, books = B.compress(B.prepare(table(spark, rows)), entries=entries)
    want, wanted_books = brute(rows, entries=entries)
    assert books.tolist() == wanted_books
    got = B.with_label_error(coded).collect()
    assert sorted((r["vec_id"] is None, r["vec_id"] or 0, bytes(r["code"]), r["error"]) for r in got) == sorted(
        (i is None, i or 0, c, e) for i, c, e, _ in want)
    for r in got:
        assert r["label_error"] == sum(e for _, _, e, y in want if y == r["label"])


def test_balls_save_work_and_change_nothing(rng):
    centres = rng.integers(-2000, 2000, (64, 6))
    x = centres[rng.integers(0, 64, 5000)] + rng.integers(-60, 60, (5000, 6))
    balls = B.Balls(centres)
    before, _ = balls.full(x)
    moved = B.Balls(centres + rng.integers(-40, 40, centres.shape))
    got = moved.again(x, before)
    plain = B.Balls(moved.centres)
    want = plain.full(x)
    assert (got[0] == want[0]).all() and (got[1] == want[1]).all()
    assert moved.work < 0.1 * plain.work


def test_ties_and_equal_entries(rng):
    centres = np.array([[0, 0], [4, 0], [0, 0], [2, 2], [4, 0]])
    x = np.array([[a, b] for a in range(-2, 7) for b in range(-2, 5)])
    want = B.Balls(centres).full(x)
    for start in range(5):
        got = B.Balls(centres).again(x, np.full(len(x), start))
        assert (got[0] == want[0]).all() and (got[1] == want[1]).all()


def test_exact_beyond_float_sums(rng):
    centres = rng.integers(-(1 << 26), 1 << 26, (9, 4))
    x = rng.integers(-(1 << 26), 1 << 26, (50, 4))
    want = ((x[:, None].astype(object) - centres[None].astype(object)) ** 2).sum(2)
    assert (B.distances(x, centres).astype(object) == want).all()
    with pytest.raises(ValueError):
        B.distances(x * (1 << 6), centres)


def test_empty_and_uneven(spark):
    coded, books = B.compress(B.prepare(table(spark, [])))
    assert books is None and B.with_label_error(coded).collect() == []
    assert B.compress(B.prepare(table(spark, [(1, None, 2)])))[1] is None
    with pytest.raises(ValueError):
        B.compress(B.prepare(table(spark, [(1, [0.5] * 6, 2)])))
    coded, _ = B.compress(B.prepare(table(spark, [(1, [0.5] * 8, 2)])))
    assert coded.select("vec_id", F.hex("code").alias("c"), "error").collect() == [(1, "00000000", 0)]
