import math
import zlib

import numpy as np
import pytest

from eventlake.llm import toxicity
from eventlake.llm.toxicity import LexiconAutomaton, allowed_errors, quoted


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_automaton_equals_brute_force(rng):
    terms = ["idiot", "idol", "worthless", "worth*", "scum", "scumbags", "disgusting", "a", "moron", "ido*"]
    auto = LexiconAutomaton(terms)
    words = {"", "x", "idiot", "worthles", "disgustin", "disgst1ng", "idolx"}
    for t in terms:
        for _ in range(150):
            w = list(t.strip("*"))
            for _ in range(rng.integers(0, 4)):
                k = int(rng.integers(0, len(w) + 1))
                w[k : k + int(rng.integers(0, 2))] = [str(rng.choice(list("idotworhes")))] * int(rng.integers(0, 2))
            words.add("".join(w))
    for w in words:
        want = min(((d, t) for t in terms if t[-1] != "*" and (d := edits(t, w)) <= allowed_errors(t)), default=None)
        if want is None:
            want = min(((0, t) for t in terms if t[-1] == "*" and w.startswith(t[:-1])), default=None)
        assert auto.match(w) == (want and (want[1], want[0])), w


def test_context():
    assert quoted('he said the word "idiot" yesterday'.split(), 4)
    assert not quoted("you are an idiot".split(), 3)
    assert not quoted('"idiot" you said'.split(), 0)
    assert quoted('"such an idiot indeed"'.split(), 2)


@pytest.fixture
def planted(rng):
    plain = [f"w{k}" for k in range(300)]
    rows, marks = [], []
    for k in range(600):
        words = [str(x) for x in rng.choice(plain, 40)]
        bad = k % 7 == 0
        if bad:
            for w in rng.choice(["blorgish", "snarf", "grumbo" + "xyz"[k % 3]], 3):
                words[int(rng.integers(40))] = str(w)
        rows.append((k, " ".join(words), "s"))
        marks.append((k, int(bad)))
    return rows, marks


def test_held_out_accuracy(spark, docs_df, planted):
    rows, marks = planted
    rows = [*rows, (1000, "you blorgush w1 w2", "s"), (1001, None, "s"), (1002, "", "s"), (None, "w1", "s"), (3, "w1 w2", "s"), (1003, "w1 " * 30000, "s")]
    df = docs_df(rows)
    labels = spark.createDataFrame([*marks, (5, None), (None, 1), (7, 1), (99999, 1)], "doc_id bigint, toxic int")
    model = toxicity.train(df, labels)
    assert {"blorgish", "snarf", "grumbo*"} <= set(model.evidence)
    out = toxicity.with_score(df, model).withColumn("held", toxicity.held_out()).collect()
    assert len(out) == len(rows)
    truth = dict(marks)
    for r in out:
        assert 0.0 <= r.score <= 1.0
        assert r.held == (zlib.crc32((str(r.doc_id) if r.doc_id is not None else "").encode()) % 4 == 2)
    held = [(truth[r.doc_id], r.score >= 0.3) for r in out if r.held and r.doc_id in truth and r.doc_id != 3]
    assert sum(a == b for a, b in held) / len(held) > 0.98
    by = {r.doc_id: r.score for r in out}
    assert by[1000] > by[1002] and by[1001] == by[1002] < 0.3 and by[1003] < 0.3


def test_no_labels(spark, docs_df):
    df = docs_df([(1, "a", "s")])
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    model = toxicity.train(df, none)
    assert all(0 <= r.score < 0.3 for r in toxicity.with_score(df, model).collect())
    assert toxicity.with_score(df.where("false"), model).count() == 0


def test_unspaced_text(spark, docs_df, rng):
    """Words of 45 letters, as a script without spaces gives them: an insult at their beginning is learned."""
    letters = list("abcdefghijklmnopqrstuvwxyz")
    rows, marks = [], []
    for k in range(400):
        tail = "".join(rng.choice(letters, 45))
        rows.append((k, f"zwrkq{tail}" if k % 4 == 0 else tail, "s"))
        marks.append((k, int(k % 4 == 0)))
    df = docs_df([*rows, (1000, "zwrkq" + "ab" * 200_000, "s"), (1001, "ab" * 200_000, "s")])
    model = toxicity.train(df, spark.createDataFrame(marks, "doc_id bigint, toxic int"))
    assert any("zwrkq".startswith(t.strip("*")) for t in model.evidence)
    by = {r.doc_id: r.score for r in toxicity.with_score(df, model).collect()}
    assert all((by[k] >= 0.3) == (k % 4 == 0) for k in range(400))
    assert by[1000] >= 0.3 > by[1001]


def test_scores_equal_brute_force(spark, docs_df, rng):
    """Scores rebuilt without automaton, caches or batches: edit distances to every term, plain sums."""
    model = toxicity.ToxicityModel({"idiot": 2.0, "worthless": 1.5, "scum": 3.0, "ido*": 0.5}, np.array([0.9, 0.4, 0.3, 0.1, -0.2, 0.6, -2.5]))
    words = ["idiot", "idiott", "worthles", "wrthless", "scum", "scun", "idolize", "you", "said", '"idiot"', "calm", "IDIOT!", "x" * 70]
    rows = [(k, " ".join(rng.choice(words, int(rng.integers(0, 15)))), "s") for k in range(120)] + [(500, None, "s")]

    def brute(text):
        all_words, found = (text or "").lower().split(), set()
        for k, w in enumerate(all_words):
            bare = w.strip(toxicity.STRIP)
            near = [(edits(t, bare), t) for t in model.evidence if t[-1] != "*" and edits(t, bare) <= allowed_errors(t)]
            near = near or [(0, t) for t in model.evidence if t[-1] == "*" and bare.startswith(t[:-1])]
            if near:
                found.add((bare, *min(near)[::-1], quoted(all_words, k)))
        total = lambda keep: min(sum(model.evidence[t] for w, t, e, q in found if keep(e, q)), 20.0)
        plain, n = total(lambda e, q: not q and not e), len(all_words)
        length = math.log1p(n) / 10
        x = [plain, total(lambda e, q: not q and e), total(lambda e, q: q), min(100 * plain / (50 + n), 20.0), length, length * (plain > 0), 1.0]
        return 1 / (1 + math.exp(-float(np.dot(x, model.weights))))

    texts = {i: t for i, t, _ in rows}
    for r in toxicity.with_score(docs_df(rows), model).collect():
        assert r.score == pytest.approx(brute(texts[r.doc_id]), abs=1e-12), texts[r.doc_id]


def test_rare_insult_behind_many_common_terms(spark, docs_df, rng):
    common = ["".join(x) for x in rng.choice(list("abcdefghijklmnopqrstuvwxyz"), (4000, 12))]
    body = " ".join(common)
    rows, marks = [], []
    for k in range(160):
        rows.append((k, f"{body} n{k}" + (" zzgrblf" if k % 4 == 0 else ""), "s"))
        marks.append((k, int(k % 2 == 0)))
    model = toxicity.train(docs_df(rows), spark.createDataFrame(marks, "doc_id bigint, toxic int"))
    # the 20,000th commonest of the terms is held by every text; the insult by half of the toxic ones
    assert len({x[:n] for x in common for n in range(3, 9)} | set(common)) > 20_000
    assert {"zzgrblf", "zzg*", "zzgr*", "zzgrb*", "zzgrbl*"} & set(model.evidence)
