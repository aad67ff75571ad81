import math
import zlib
from collections import Counter

import numpy as np

from eventlake.llm import interpolation as ip
from eventlake.llm.common import Words


def tokens(text):
    return [*(text or "").encode().lower().split(), None]


def crc(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 7


def brute_base(rows):
    c = Counter(w for i, t in rows if crc(i) != 2 for w in tokens(t))
    n = sum(c.values())
    return n, {(i, t): (len(tokens(t)), sum(c[w] > 0 for w in tokens(t)), sum(math.log10((c[w] + 1) / (n + len(c) + 1)) for w in tokens(t))) for i, t in rows}


def brute_model(rows, weights, order):
    grams, total = Counter(), 0
    train = [(i, t) for i, t in rows if crc(i) != 2]
    for _, t in train:
        s = ["<s>"] * (order - 1) + tokens(t)
        total += len(s) - order + 1
        for k in range(order - 1, len(s)):
            for n in range(1, order + 1):
                grams[tuple(s[k - n + 1 : k + 1])] += 1
    v = sum(len(g) == 1 for g in grams)

    def logp(t):
        s, out = ["<s>"] * (order - 1) + tokens(t), 0.0
        for k in range(order - 1, len(s)):
            p, context = [1 / (v + 1), grams[(s[k],)] / total], 0
            for n in range(2, order + 1):
                h = tuple(s[k - n + 1 : k])
                context = len(train) if set(h) == {"<s>"} else grams[h]
                p.append(grams[(*h, s[k])] / context if context else 0.0)
            b = min(int(math.log2(context)) + 1 if context else 0, ip.BUCKETS - 1)
            out += math.log10(sum(x * y for x, y in zip(p, weights[b])))
        return out

    return {(i, t): logp(t) for i, t in rows}


def sample(rng, n=400):
    words = [f"W{k}" for k in range(60)]
    rows = [(0, ""), (1, None), (2, " "), (3, "ä ß Ä"), (4, "w1 " * 90000), (None, "w1 w2")]
    for k in range(5, n):
        at, out = int(rng.integers(60)), []
        for _ in range(int(rng.integers(1, 60))):
            out.append(words[at])
            at = (at * 7 + int(rng.integers(3))) % 60
        rows.append((k, " ".join(out)))
    return rows + [rows[20], (20, "other text")]


def test_scores_equal_brute_force(spark, docs_df, rng):
    rows = sample(rng)
    df = docs_df([(i, t, "s") for i, t in rows])
    model = ip.train(df, order=2)
    n, base = brute_base(rows)
    full = brute_model(rows, model.weights, 2)
    got = [tuple(r) for r in ip.score(df, model).collect()]
    assert len(got) == len(rows)
    sort = lambda x: sorted(x, key=lambda r: (r[0] is None, r[0], *r[1:]))
    want = sort([(i, *base[(i, t)][:2], n, base[(i, t)][2], full[(i, t)]) for i, t in rows])
    for a, b in zip(sort(got), want, strict=True):
        assert a[:4] == b[:4]
        assert abs(a[4] - b[4]) < 1e-6 * max(1, abs(b[4])) and abs(a[5] - b[5]) < 1e-6 * max(1, abs(b[5]))
    # held-out texts that follow the chain are far likelier than by the base
    held = [(g[4], g[5]) for g in got if crc(g[0]) == 2 and g[1] > 3]
    assert len(held) > 20 and sum(x[1] for x in held) > 0.75 * sum(x[0] for x in held)
    assert np.allclose(model.weights.sum(1), 1) and (model.weights >= 0).all()


def test_weights_are_at_the_maximum(spark, docs_df, rng):
    """EM against a plain search on the delta rows' likelihood (order 1: one free weight)."""
    rows = sample(rng)[6:]
    model = ip.train(docs_df([(i, t, "s") for i, t in rows]), order=1, rounds=200, tolerance=1e-9)
    c = Counter(w for i, t in rows if crc(i) not in (2, 5) for w in tokens(t))
    n, v = sum(c.values()), len(c)
    delta = [w for i, t in rows if crc(i) == 5 for w in tokens(t)]
    level = lambda a: sum(math.log(a / (v + 1) + (1 - a) * c[w] / n) for w in delta)
    grid = np.linspace(1e-4, 0.5, 300)
    best = grid[np.argmax([level(a) for a in grid])]
    got = model.weights[0, 0]
    assert level(max(got, 1e-12)) >= level(best) - 0.05


def test_trigrams(spark, docs_df, rng):
    rows = sample(rng, 120)
    df = docs_df([(i, t, "s") for i, t in rows])
    model = ip.train(df, order=3)
    full = brute_model(rows, model.weights, 3)
    got = {r.doc_id: r.score for r in ip.score(df, model).collect() if r.doc_id not in (20, None)}
    for (i, _), value in full.items():
        if i in got:
            assert abs(got[i] - value) < 1e-6 * max(1, abs(value))


def test_empty(spark, docs_df):
    df = docs_df([(1, "a b", "s")])
    model = ip.train(df.where("false"))
    assert ip.score(df.where("false"), model).count() == 0
    r = ip.score(df, model).first()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.score) == (3, 0, 0, 0.0)


def test_words_equal_split(rng):
    texts = ["", "a", " a  b ", "ab", "\x0b\x0c x\x1cy\xa0z", "Ää B", "x" * 3_000_000, "q " * 700_000]
    data = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, data)])
    w = Words(np.frombuffer(b"".join(data), np.uint8), offsets, lower=True)
    raw, known = b"".join(data), {}
    at = 0
    for k, d in enumerate(data):
        want = d.lower().split()
        assert w.first[k + 1] - w.first[k] == len(want)
        for x in want:
            assert raw[w.start[at] : w.end[at]].lower() == x
            assert known.setdefault(x, w.hash[at]) == w.hash[at]
            at += 1
    assert len(set(known.values())) == len(known)
