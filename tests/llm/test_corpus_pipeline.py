"""Each pipeline stage against a brute-force version on its own input, then run()."""

import math
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from eventlake.llm import toxicity
from tests.llm.test_packing import check
from tests.llm.test_simhash import brute
from tests.llm.test_toxicity import edits

SMALL = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """Collected input and output of every stage."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out, rows = [], [r for r in docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, spark.createDataFrame(rows, docs.schema) if out else docs, SMALL)
        got = made.collect()
        out.append((name, rows, got, made.columns))
        rows = got
    return out


def test_stages_and_columns(stages):
    assert [s[0] for s in stages] == ["toxicity", "simhash_near_dedup", "substring_dedup", "temperature_mixing", "best_fit_packing"]
    assert all(s[3] == COLUMNS for s in stages[:-1])


def test_toxicity(spark, stages):
    _, given, got, _ = stages[0]
    read = lambda t: spark.read.parquet(f"{SMALL}/{t}.parquet")
    model = toxicity.train(read("documents"), read("labels"))

    def closest(word):
        near = [(d, t) for t in model.evidence if t[-1] != "*" and (d := edits(t, word)) <= toxicity.allowed_errors(t)]
        stem = [(0, t) for t in model.evidence if t[-1] == "*" and word.startswith(t[:-1])]
        return min(near) if near else min(stem, default=None)

    kept = []
    for r in given:
        words = r.text.lower().split()
        close = {w: closest(w.strip(toxicity.STRIP)) for w in set(words)}
        found = {(w.strip(toxicity.STRIP), *close[w][::-1], toxicity.quoted(words, k)) for k, w in enumerate(words) if close[w]}
        value = [sum(model.evidence[t] for _, t, e, q in found if (q, bool(e)) in kind) for kind in ([(False, False)], [(False, True)], [(True, False), (True, True)])]
        length = math.log1p(len(words))
        x = [*(min(v, 20.0) for v in value), min(100 * value[0] / (50 + len(words)), 20.0), length / 10, (value[0] > 0) * length / 10, 1.0]
        if 1 / (1 + math.exp(-sum(a * b for a, b in zip(x, model.weights, strict=True)))) < 0.3:
            kept.append(r.doc_id)
    assert sorted(r.doc_id for r in got) == sorted(kept) and len(kept) > 0.8 * len(given)


def test_near_duplicates(stages):
    _, given, got, _ = stages[1]
    groups = brute([(r.doc_id, r.text) for r in given])
    assert sorted(r.doc_id for r in got) == sorted({c for _, _, c in groups})
    assert {tuple(r) for r in got} <= {tuple(r) for r in given}


def test_repeats(stages):
    _, given, got, _ = stages[2]
    words = {r.doc_id: r.text.encode().lower().split() for r in given}
    left = {r.doc_id: r.text.encode().lower().split() for r in got}
    runs = lambda w, n: {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}
    # no exact passage of 51 words is left in two texts, and the first holder keeps it
    holders = {}
    for i in sorted(words):
        for p in runs(words[i], 51):
            holders.setdefault(p, []).append(i)
    for p, ids in holders.items():
        if len(ids) > 1:
            assert not any(i in left and p in runs(left[i], 51) for i in ids[1:])
    # a text that shares no run of 12 words with another text, and holds none twice, is untouched
    short = Counter(p for w in words.values() for p in runs(w, 12))
    twice = Counter(p for w in words.values() for p, n in Counter(tuple(w[k : k + 12]) for k in range(len(w) - 11)).items() if n > 1)
    before, after = ({r.doc_id: tuple(r) for r in rows} for rows in (given, got))
    clean = [i for i, w in words.items() if w and all(short[p] == 1 and not twice[p] for p in runs(w, 12))]
    assert len(clean) > 20 and all(before[i] == after[i] for i in clean)


def test_mixing(stages):
    _, given, got, _ = stages[3]
    times = Counter(tuple(r) for r in got)
    assert set(times) == {tuple(r) for r in given} and set(times.values()) <= {1, 2}
    tokens = Counter()
    for r in given:
        tokens[r.source] += len(r.text.encode().split())
    used = Counter()
    for r in got:
        used[r.source] += len(r.text.encode().split())
    positive = [t for t in tokens.values() if t]
    high, low = max(positive), min(positive)
    exponent = max(0.0, 1 - math.log(2) / math.log(high / low)) if high > low else 1.0
    for s, t in tokens.items():
        longest = max(len(r.text.encode().split()) for r in given if r.source == s)
        want = high * (t / high) ** exponent if t else 0  # the largest source is read once
        assert want - longest - 2 <= used[s] <= want + 2


def test_packing(stages):
    _, given, got, _ = stages[4]
    n, tokens = check([(r.doc_id, r.text) for r in given], got)
    assert n <= 1.02 * -(-tokens // 1024) + 1


def test_run(spark, stages):
    got = corpus_pipeline.run(spark, SMALL)
    key = lambda rows: sorted(tuple(r)[:5] for r in rows)
    assert key(got.collect()) == key(stages[-1][2])
    assert corpus_pipeline.ORACLE_SQL is None and public_tokenizers


def test_stages_on_an_empty_table(spark, docs_df):
    docs = docs_df([]).withColumn("__score", F.lit("own")).withColumn("__row", F.lit("own"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns and out.collect() == [], name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect() == []


def test_clashing_names_and_collisions(spark, docs_df, monkeypatch):
    """Own columns named like helper columns stay; different rows of one digest are not lost."""
    docs = docs_df([(k, f"some plain words number {k} of this text", "s") for k in (1, 2, 3, 3)])
    docs = docs.withColumn("__score", F.lit("own")).withColumn("__row", F.lit("own")).withColumn("__sha", F.lit("own"))
    kept = corpus_pipeline.STAGES[1][1](spark, corpus_pipeline.STAGES[0][1](spark, docs, SMALL), SMALL)
    assert kept.columns == docs.columns and {r["__row"] for r in kept.collect()} == {"own"}
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3]
    from eventlake.llm import simhash

    monkeypatch.setattr(simhash, "row_key", lambda df, name: df.withColumn(name, F.lit(7).cast("bigint")))
    assert sorted(r.doc_id for r in simhash.one_of_each(docs).collect()) == [1, 2, 3]
