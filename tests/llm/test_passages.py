from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from eventlake.llm import passages


def shingles(text):
    w = (text or "").encode().lower().split()
    return [tuple(w[k : k + 5]) for k in range(len(w) - 4)]


def jaccard(a, b):
    a, b = set(a), set(b)
    return len(a & b) / len(a | b)


def passage(rng, n, words=5000):
    return [f"w{x}" for x in rng.integers(0, words, n)]


def test_sliding_minimum_is_the_tree_level(rng):
    x = rng.integers(0, 50, 300).astype(np.uint64)
    for width in (1, 2, 7, 46):
        assert passages.sliding_minimum(x, width).tolist() == [x[k : k + width].min() for k in range(len(x) - width + 1)]


@pytest.fixture
def corpus(rng):
    """Passages of over 50 words in many texts, edited ones, shorter common ones, copies."""
    hot, line = passage(rng, 70), passage(rng, 30)
    rows, exact, near = [], [], []
    for k in range(160):
        own = passage(rng, int(rng.integers(30, 200)))
        if k % 3 == 0:
            own += hot + passage(rng, 20)
        if k % 2 == 0:
            own = own[:10] + line + own[10:]
        rows.append([k, " ".join(own)])
    for k in range(20):
        p = passage(rng, 51 + k)
        for d in (1 + 6 * k, 4 + 6 * k):
            rows[d][1] += "\n" + " ".join(p) + " " + " ".join(passage(rng, 30))
        exact.append((1 + 6 * k, 4 + 6 * k))
    for k in range(20):
        p = passage(rng, 120)
        q = list(p)
        q[60] = "other"
        for d, x in ((2 + 7 * k, p), (5 + 7 * k, q)):
            rows[d][1] += " " + " ".join(x)
        near.append((2 + 7 * k, 5 + 7 * k))
    rows += [[200, rows[7][1]], [201, rows[7][1].upper()], [202, ""], [203, None], [204, "a b c"], [205, " ".join(passage(rng, 120000))]]
    twice = passage(rng, 60)
    rows += [[206, " ".join(twice + passage(rng, 40) + twice)]]
    return [(i, t, "s") for i, t in rows], exact, near


def test_planted_passages(spark, docs_df, corpus):
    rows, exact, near = corpus
    got = passages.repeated_passages(docs_df(rows)).collect()
    text = {i: (t or "").encode().lower().split() for i, t, _ in rows}
    pairs = {(r.other_doc_id, r.doc_id) for r in got}
    for r in got:  # every span is verified: all its passages of 50 words are similar
        assert r.end_word - r.start_word >= 50 and r.similarity >= 0.8 and r.other_doc_id <= r.doc_id
        for k in (r.start_word, r.end_word - 50):
            o = r.other_start_word + k - r.start_word
            sh = lambda i, s: [tuple(text[i][j : j + 5]) for j in range(s, s + 46)]
            assert jaccard(sh(r.doc_id, k), sh(r.other_doc_id, o)) >= 0.8
    assert set(exact) <= pairs
    assert len(set(near) & pairs) >= 18
    for k in range(3, 160, 3):  # the hot passage: all but the earliest holder
        assert any(r.doc_id == k and r.end_word - r.start_word >= 70 for r in got)
    assert not any(r.doc_id == 0 for r in got)
    assert (7, 200) in pairs and (206, 206) in pairs and any(r.doc_id == 201 for r in got)
    assert len(got) <= 4 * len(rows)


def test_cut(spark, docs_df, corpus):
    rows, exact, _ = corpus
    extra = [(300, rows[7][1], "s"), (300, rows[7][1], "s"), (None, rows[8][1], "s"), (None, rows[9][1], "s"), (5, rows[11][1], "s")]
    df = docs_df(rows + extra)
    out = passages.without_repeats(df)
    assert out.columns == df.columns
    left = out.collect()
    ids = [r.doc_id for r in left]
    assert 200 not in ids and 201 not in ids and 300 not in ids and 202 in ids and 203 in ids and 204 in ids
    assert ids.count(None) == 2  # null ids sort first and hold their passages earliest
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in left)
    kept = {r.doc_id: r.text for r in left if r.doc_id is not None}
    assert kept[206].encode().split() == rows[-1][1].encode().split()[:100]
    for a, b in exact:
        if a not in (8, 9, 11, 7) and b not in (8, 9, 11, 7):
            assert len((kept[b] or "").split()) <= len(rows[b][1].split()) - 51
    again = passages.repeated_passages(spark.createDataFrame(left, df.schema)).collect()
    assert len(again) <= 3
    assert passages.without_repeats(df.where("false")).count() == 0
    assert passages.repeated_passages(df.where("false")).count() == 0


def test_similar_starts_equal_brute_force(rng):
    for words in (10_000, 60, 12):
        for _ in range(60):
            a = rng.integers(0, words, int(rng.integers(46, 150))).astype(np.uint64)
            b = a.copy()
            if rng.random() < 0.9:
                at = int(rng.integers(0, len(a)))
                b = np.r_[b[:at], rng.integers(0, words, 2).astype(np.uint64), b[at:]][: len(a)]
            want = [jaccard(a[k : k + 46].tolist(), b[k : k + 46].tolist()) for k in range(len(a) - 45)]
            got = passages.similar_starts(a, b, 46, 0.5)
            assert np.allclose(got, [x if x >= 0.5 else 0.0 for x in want])


def test_cut_text():
    assert passages.cut_text("a  b\tc d\n", [(1, 3)]) == "a  d\n"
    assert passages.cut_text("é b", [(0, 1)]) == "b"
    assert passages.cut_text("x y", [(0, 2)]) == ""


def test_no_partner_is_lost_in_a_crowd(spark, docs_df, rng):
    """One passage, one changed word in each text: whoever has an earlier partner is found, and nobody else."""
    hot, rows = passage(rng, 50), []
    for k in range(90):
        own = list(hot)
        own[int(rng.integers(0, 50))] = f"e{int(rng.integers(0, 3))}"
        rows.append((k, " ".join(passage(rng, 20) + own + passage(rng, 20)), "s"))
    sets = {i: [frozenset(s[k : k + 46]) for k in range(len(s) - 45)] for i, t, _ in rows for s in [shingles(t)]}
    want = {
        (i, k) for i in sets for k, a in enumerate(sets[i])
        if any(k < len(sets[j]) and jaccard(a, sets[j][k]) >= 0.8 for j in range(i))
    }
    got = passages.repeated_passages(docs_df(rows)).collect()
    assert {r.doc_id for r in got} == {i for i, _ in want}
    assert all(any(r.doc_id == i and r.start_word <= k and r.end_word >= k + 50 for r in got) for i, k in want)


def test_repeats_and_prefix_runs_equal_brute_force(rng):
    x = np.r_[rng.integers(0, 200, 300), np.tile(rng.integers(0, 200, 7), 20), rng.integers(0, 200, 60)].astype(np.uint64)
    again, same, back = passages.repeats(x, 46)
    windows = [x[k : k + 46].tolist() for k in range(len(x) - 45)]
    assert again.tolist() == [46 - len(set(w)) for w in windows]
    assert same.tolist() == [k > 0 and set(w) == set(windows[k - 1]) for k, w in enumerate(windows)]
    limit, all_places = np.full(len(windows), 6), np.ones(len(x), bool)
    runs = passages.prefix_runs(x, limit, limit, ~all_places, 46, all_places, back)
    got = {(int(p), s) for places, first, last in runs for p, a, b in zip(places, first, last, strict=True) for s in range(a, b + 1)}
    want = {(s + k, s) for s, w in enumerate(windows) for k, v in enumerate(w) if v not in w[:k] and sum(u < v for u in w) < 6}
    assert got == want


def test_a_text_of_few_rows_is_sent_once(spark):
    rows = [(d, 1, 90 + k, 2, k % 5, k, k + 3) for d in range(3) for k in range(200)] + [(7, 1, k, 2, 0, k, k) for k in range(5000)]
    links = spark.createDataFrame(rows, passages._LINK_SCHEMA)
    got = passages._bundled(links, "x", "xm", 1 << 20).collect()
    sent = Counter(r["doc"] for r in got)
    assert [sent[d] for d in range(3)] == [1, 1, 1] and 1 <= sent[7] <= 3
    back = [tuple(r.values()) for b in got for r in pa.ipc.open_stream(b["rows"]).read_all().to_pylist()]
    assert sorted(back) == sorted(rows)


def test_rows_of_a_key_are_compared_only_where_a_passage_can_match(monkeypatch):
    """Copies with one changed word each at places that all passages of a row hold: no two are similar."""
    base, calls = np.arange(1000, 1070, dtype=np.uint32), []

    def changed(at, n):
        out = base.copy()
        out[at : at + 5] = np.arange(5) + 10_000 * (n + 1)
        return out

    def meet(copies):
        rows = [(s, k, 0, 50, 0, 24, 24, v.tobytes()) for k, v in enumerate(copies) for s in (0, 1)]
        columns = zip(["side", "x", "xm", "ym", "lo", "hi", "reach", "own"], zip(*rows, strict=True), strict=True)
        return passages._meet(pa.table({n: pa.array(v, pa.binary() if n == "own" else pa.int64()) for n, v in columns}), 50, 0.8)

    real = passages.similar_starts
    monkeypatch.setattr(passages, "_FEW", 0)
    monkeypatch.setattr(passages, "similar_starts", lambda *a: calls.append(1) or real(*a))
    copies = [changed(24 + k, k) for k in range(17)]
    assert meet(copies) == [] and len(calls) == 0
    found = meet([base, *copies])
    assert {(r[0], r[4]) for r in found} == {(k, 0) for k in range(1, 18)} and len(calls) == 17


def test_last_start_with_the_same_set_of_shingles(rng):
    for k in range(60):
        x = np.tile(rng.integers(0, 50, int(rng.integers(1, 30))), 60)[: int(rng.integers(46, 200))].astype(np.uint64)
        x[int(rng.integers(0, len(x))) :] += np.uint64(k % 2 * 100)
        sets = [set(x[i : i + 46].tolist()) for i in range(len(x) - 45)]
        want = [next((j - 1 for j in range(i + 1, len(sets)) if sets[j] != sets[i]), len(sets) - 1) for i in range(len(sets))]
        assert passages._last_like(x, 46).tolist() == want
