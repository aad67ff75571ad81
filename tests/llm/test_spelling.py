import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from eventlake.llm import spelling as S


def edits(word, letters):
    out = {word[:i] + word[i + 1 :] for i in range(len(word))}
    for c in letters:
        out |= {word[:i] + c + word[i + 1 :] for i in range(len(word))} | {word[:i] + c + word[i:] for i in range(len(word) + 1)}
    return out - {word}


def brute_pairs(counts):
    letters = {c for w in counts for c in w}
    return {w: sorted(v for v in edits(w, letters) if v in counts) for w in counts}


def brute(rows):
    counts = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            low = "".join(c.lower() if c < "\x7f" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{low}".encode())
            if h % 199 == 0:
                low = low[: h % len(low)] + low[h % len(low) + 1 :]
            if len(low) >= 6:
                counts[low] += 1
    counts = {w: n for w, n in counts.items() if n >= 5}
    near, form = brute_pairs(counts), {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best and counts[best] >= 5 * counts[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted((w, form[w] or "", root(w), n, len(near[w]), counts.get(form[w])) for w, n in counts.items())


def result(df):
    return sorted((r["word"], r["form"] or "", r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect())


def word_list(rnd, n, letters, low=6, high=9):
    words = set()
    while len(words) < n:
        w = "".join(rnd.choice(letters) for _ in range(rnd.randint(low, high)))
        words |= {w, w[:-1] + rnd.choice(letters), w[:2] + w[3:]}
    return sorted(w for w in words if len(w) >= low)


def test_query_equals_brute_force(spark, docs_df):
    rnd = random.Random(3)
    words = word_list(rnd, 120, "abcdeéÀÿß") + ["x" * 40, "x" * 41, "y" + "x" * 40, "z" * 3000, "z" * 2999 + "a"]
    rows = [(i, " ".join(rnd.choice(words).capitalize() if rnd.random() < 0.2 else rnd.choice(words) for _ in range(200)), "s") for i in range(60)]
    rows += [(None, " ".join(words) + "!", "s")] * 3 + [(61, None, "s"), (62, "", "s"), (63, "short ab1cd Ābcdefg", "s")]
    # chains of forms: each word five times as common as the one before
    rows += [(100 + k, " ".join(["wordaaa", "wordaab", "wordabb", "wordbbb"][k : k + 1] * 5 ** (k + 1)), "s") for k in range(4)]
    assert result(S.variants(docs_df(rows))) == brute([(i, t) for i, t, _ in rows])


@pytest.mark.parametrize(("symbols", "crowd", "long"), [(2, 3, 7), (2, 1000, 32), (8, 64, 32), (3, 1, 8), (8, 64, 6)])
def test_near_words_equal_brute_force(spark, symbols, crowd, long):
    rnd = random.Random(symbols)
    counts = {w: 5 + rnd.randint(0, 40) for w in word_list(rnd, 400, "abcd")}
    vocabulary = spark.createDataFrame([(k, w, n) for k, (w, n) in enumerate(counts.items())], S.WORDS)
    got = defaultdict(list)
    for r in S.near_words(vocabulary, symbols=symbols, crowd=crowd, long=long).collect():
        assert (r["n"], r["near_n"]) == (counts[r["word"]], counts[r["near"]])
        got[r["word"]].append(r["near"])
    want = brute_pairs(counts)
    assert {w: sorted(v) for w, v in got.items()} == {w: v for w, v in want.items() if v}


def test_reduced_keys_of_near_words_meet(rng):
    rnd = random.Random(1)
    for _ in range(200):
        w = "".join(rnd.choice("abcdefghijklmnopé") for _ in range(rnd.randint(6, 12)))
        v = rnd.choice(sorted(edits(w, "abcxyz")))
        a, b = sorted((w, v), key=len)
        points = lambda x: np.array([[ord(c) for c in x]], np.uint32)
        for symbols in (2, 4, 8):
            assert S.own_keys(points(a), symbols)[0] in S.neighbour_keys(points(b), symbols)[0]


def test_empty_table(spark, docs_df):
    assert S.variants(docs_df([])).collect() == []
    assert S.variants(docs_df([(1, None, "s"), (2, "a b c", "s")])).collect() == []
