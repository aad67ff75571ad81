import numpy as np
import xxhash

from eventlake.llm import simhash


def brute(rows, distance=2):
    fps = {}
    for i, text in rows:
        w = (text or "").encode().lower().split()
        sh = [b" ".join(w[k : k + 3]) for k in range(max(1, len(w) - 2))] if w else []
        h = [xxhash.xxh64_intdigest(s, 42) for s in sh]
        fps[i] = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    ids = sorted(fps)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in ids:
        for b in ids:
            if a < b and (fps[a] ^ fps[b]).bit_count() <= distance:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {(i, f"{fps[i]:016x}", find(i)) for i in ids}


def sample(rng, n=150):
    words = ["Alpha", "beta", "gäma", "delta", "eps", "zeta", "eta", "Theta", "i", "kappa"]
    rows = [(0, ""), (1, None), (2, "one"), (3, "one two"), (4, " \t\n"), (5, "a " * 70000), (6, "ONE two")]
    for k in range(7, n):
        if k > 20 and rng.random() < 0.5:
            t = (rows[int(rng.integers(7, k))][1] or "x").split(" ")
            t[int(rng.integers(len(t)))] = str(rng.choice(words))
            rows.append((k, " ".join(t)))
        else:
            rows.append((k, " ".join(rng.choice(words, int(rng.integers(1, 60))))))
    return rows


def test_groups_equal_brute_force(spark, docs_df, rng):
    rows = sample(rng)
    df = docs_df([(i, t, "s") for i, t in rows])
    got = {tuple(r) for r in simhash.groups(df).select("doc_id", "fingerprint", "component_id").collect()}
    assert got == brute(rows)


def test_match_finds_every_close_pair(rng):
    base = rng.integers(0, 1 << 63, 3, dtype=np.uint64)
    fps = np.unique(np.r_[rng.integers(0, 1 << 63, 300, dtype=np.uint64), *(base ^ (np.uint64(1) << np.uint64(k)) for k in range(40))])
    fps = fps[np.argsort(simhash.gray_rank(fps))]
    i, j = simhash.match(fps, fps, 2)
    away = np.bitwise_count(fps[:, None] ^ fps)
    assert set(zip(i.tolist(), j.tolist())) == set(zip(*(x.tolist() for x in np.nonzero(away <= 2))))


def test_gray_rank_orders_by_one_bit():
    order = np.argsort(simhash.gray_rank(np.arange(256, dtype=np.uint64)))
    codes = np.arange(256)[order]
    assert (np.bitwise_count(codes[1:] ^ codes[:-1]) == 1).all()


def test_small_blocks_and_one_of_each(spark, docs_df, rng):
    rows = sample(rng) + [(8, "alpha beta"), (8, "alpha beta"), (None, "one"), (None, None)]
    df = docs_df([(i, t, "s") for i, t in rows])
    kept = simhash.one_of_each(df)
    assert kept.columns == df.columns
    got = sorted(r.doc_id for r in kept.collect())
    groups = simhash.groups(df).collect()
    assert got == sorted({r.component_id for r in groups})
    fps = simhash.fingerprints(df).select("fp").distinct()
    edges = {frozenset(x) for x in simhash.links(fps, block_rows=8).collect()}
    pairs = simhash.links(fps, block_rows=4096).collect()

    def parts(edges):
        root = {}

        def find(x):
            while root.setdefault(x, x) != x:
                x = root[x]
            return x

        for e in edges:
            a, b = tuple(e)
            root[find(a)] = find(b)
        return {frozenset(y for y in root if find(y) == find(x)) for x in root}

    assert parts(edges) == parts(pairs)


def test_empty(spark, docs_df):
    assert simhash.groups(docs_df([]).where("false")).count() == 0
    assert simhash.one_of_each(docs_df([]).where("false")).count() == 0
