import numpy as np

from eventlake.llm import knn


def brute(rows, k, every):
    ok = [(i, np.floor(64 * np.array(v, float)).astype(int)) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    width = max((len(v) for _, v in ok), default=0)
    full = np.array([np.r_[v, np.zeros(width - len(v), int)] for _, v in ok]).reshape(len(ok), width)
    out = []
    for a, (i, _) in enumerate(ok):
        if i is None or i % every:
            continue
        scores = full @ full[a]
        order = sorted((-int(scores[b]), ok[b][0], b) for b in range(len(ok)) if b != a)[:k]
        out += [(i, r + 1, j, -s) for r, (s, j, _) in enumerate(order)]
    return sorted(out)


def run(spark, rows, every=5, **options):
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id bigint, embedding array<float>, label int, uid string")
    v = knn.prepare(df)
    got = knn.top_k(v.where(f"vec_id % {every} = 0"), v, **options).collect()
    return sorted(tuple(r) for r in got)


def f32(x):
    return [float(np.float32(v)) for v in x]


def test_equals_brute_force(spark, rng):
    centres = rng.normal(size=(6, 12))
    rows = [(k, f32(centres[k % 6] * rng.uniform(0.5, 3) + rng.normal(size=12) * 0.2)) for k in range(400)]
    rows += [(400 + k, rows[5][1]) for k in range(60)]  # one very common vector
    rows += [(500, None), (505, [1.0, None]), (510, [float("nan")] * 12), (515, [float("inf")] * 12), (520, []), (525, [0.0] * 12), (530, [2.0]), (535, f32(rng.normal(size=12) * 50))]
    rows += [(10, rows[10][1]), (10, f32(rng.normal(size=12)))]  # repeated ids
    assert run(spark, rows, k=20, n_pivots=12, groups=5, salts=3, block_rows=32) == brute(rows, 20, 5)
    assert run(spark, rows[:9], k=20) == brute(rows[:9], 20, 5)


def test_pruning_leaves_out_far_cells(rng):
    a, b = rng.normal(size=(200, 8)) + 30, rng.normal(size=(200, 8)) - 30
    x = np.floor(64 * np.r_[a, b]).astype(np.int64)
    top = float(np.sqrt((x * x).sum(1).max()))
    cells = knn.Cells(x[[0, 250]], top, 8)
    cell, away = cells.nearest(knn._raised(x, top))
    q = knn._scaled(x[:50], top)
    qc, qd = cells.nearest(q)
    assert (qc == 0).all()
    cells.bound(np.array([qd.max(), -1.0]), {c: np.sort(away[cell == c])[:21].tolist() for c in (0, 1)}, 21, 1)
    need = cells.needed(cell, away, 1)[:, 0]
    assert need[:200].all() and not need[200:].any()


def test_empty(spark):
    assert run(spark, []) == []
    assert run(spark, [(5, None)]) == []
    assert run(spark, [(5, [1.0])]) == []


def test_large_values(spark):
    rows = [(k, [float(2 ** (14 + k)), -float(k)]) for k in range(8)]
    assert run(spark, rows, every=1, k=3) == brute(rows, 3, 1)
