import math

import pytest

from eventlake.llm import mixing


def rows_of(rng, n=300):
    out = [(0, None, None), (1, "", "src0"), (2, "a b", None), (3, "", "hollow"), (4, "w " * 5000, "src1")]
    for k in range(5, n):
        s = "src0" if rng.random() < 0.4 else f"src{rng.integers(1, 8)}"
        out.append((k, " ".join(["w"] * int(rng.integers(0, 120))), s))
    return out


def by_source(rows):
    total = {}
    for _, t, s in rows:
        total[s] = total.get(s, 0) + len((t or "").split())
    return total


def exponent(tokens, fits):
    """Plain bisection."""
    p = [t / sum(tokens) for t in tokens]
    w = lambda a: [x**a / sum(y**a for y in p) for x in p]
    low, high = 0.0, 1.0
    if fits(w(0.0), p):
        return 0.0, w(0.0)
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (low, mid) if fits(w(mid), p) else (mid, high)
    return high, w(high)


@pytest.mark.parametrize("goal", [{"entropy_share": 0.95}, {"max_repeats": 1.2}, {"entropy_share": 0.97, "max_repeats": 3.0}])
def test_weights_and_budgets(spark, docs_df, rng, goal):
    rows = rows_of(rng)
    tokens = {s: t for s, t in by_source(rows).items() if t}
    total = sum(tokens.values())

    def fits(w, p):
        ok = True
        if "entropy_share" in goal:
            ok &= -sum(x * math.log(x) for x in w) <= goal["entropy_share"] * math.log(len(w))
        if "max_repeats" in goal:
            ok &= max(x / y for x, y in zip(w, p)) <= goal["max_repeats"]
        return ok

    _, w = exponent(list(tokens.values()), fits)
    got = mixing.mix(docs_df(rows), budget_share=1.0, block_tokens=200, **goal).collect()
    longest = {s: max(len((t or "").split()) for _, t, x in rows if x == s) for s in tokens}
    for s, weight in zip(tokens, w):
        mine = [r for r in got if r.source == s]
        assert abs(mine[0]["__weight"] - weight) < 1e-6
        used = sum(r["__tokens"] for r in mine)
        assert weight * total - longest[s] - 2 <= used <= weight * total + 1
        times = {}
        for r in mine:
            times.setdefault(r.doc_id, set()).add(r["__epoch"])
        counts = {len(e) for e in times.values()} | ({0} if len(times) < sum(x == s for _, _, x in rows) else set())
        assert max(counts) - min(counts) <= 1  # every document as often, but for the last epoch
        assert all(e == set(range(len(e))) for e in times.values())
        # the last epoch is a beginning of its reading order
        last = max(counts) - 1
        if len(counts) > 1:
            keys = {r.doc_id: (r["__block_key"], r["__order_key"]) for r in mine if r["__epoch"] == last}
            assert len({k[0] for k in keys.values()}) <= len({r["__block"] for r in mine})
    hollow = [r for r in got if r.source == "hollow"]
    assert [r["__epoch"] for r in hollow] == [0]


def test_every_document_once_without_budget(spark, docs_df, rng):
    rows = rows_of(rng)
    df = docs_df(rows + [rows[7]])
    got = mixing.mix(df, max_repeats=2.0, block_tokens=500).collect()
    times = {}
    for r in got:
        times[r.doc_id] = times.get(r.doc_id, 0) + 1
    assert times.pop(7) in (2, 4)
    assert set(times) == {r[0] for r in rows} - {7} and set(times.values()) <= {1, 2}
    assert len({r["__block_key"] for r in got}) > 10
    again = mixing.mix(df.repartition(5), max_repeats=2.0, block_tokens=500).collect()
    key = lambda r: (r.doc_id, r["__epoch"], r["__block"], r["__order_key"])
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_empty_and_wordless(spark, docs_df):
    assert mixing.mix(docs_df([(1, "a", "s")]).where("false"), budget_share=1.0).count() == 0
    got = mixing.mix(docs_df([(1, "", "s"), (2, None, None)]), budget_share=1.0, entropy_share=0.9).collect()
    assert sorted(r.doc_id for r in got) == [1, 2]
