"""Toxicity: a learned lexicon in a trie, intersected with Levenshtein automata
to catch misspelled terms, and context windows that tell quotation from abuse."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm.common import checkpointed, only_cache

#: Signs stripped from a word, quotation marks, words that report
#: speech and words that address somebody (en, de, fr, es).
STRIP = ".,;:!?\"'`()[]{}<>«»„“”‚‘’…*_-–—#|~+=/@$%&^\\"
QUOTES = "\"«»„“”‘"
REPORTING = frozenset("said says called calls word term quote quoted wrote sagte nannte schrieb wort dit appelé mot écrit dijo llamó palabra escribió".split())
ADDRESSING = frozenset("you your you're u du dich dein ihr tu toi vous votre tú te usted vosotros".split())
STEM = "*"


def allowed_errors(term: str) -> int:
    """Edits that a misspelling of the term may have; stems and short terms none."""
    return 0 if term.endswith(STEM) or len(term) < 5 else 1 if len(term) < 9 else 2


class LexiconAutomaton:
    """All terms' Levenshtein automata run at once over the lexicon trie.

    A state is the set of (trie node, edits so far) that are still alive, after
    any number of skipped term letters; states and their moves are made when
    first met, so a known word costs one lookup a letter and most words die
    after a few.  A term that ends in `*` is a stem: it accepts every word that
    begins with it, without edits.
    """

    LIMIT = 100_000

    def __init__(self, terms: list[str]):
        self.children: list[dict[str, int]] = [{}]
        self.term: list[str | None] = [None]
        self.stem: list[str | None] = [None]
        self.most = [0]
        for t in sorted(terms):
            node, errors = 0, allowed_errors(t)
            self.most[0] = max(self.most[0], errors)
            for c in t.removesuffix(STEM):
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.term.append(None)
                    self.stem.append(None)
                    self.most.append(0)
                node = self.children[node][c]
                self.most[node] = max(self.most[node], errors)
            if t.endswith(STEM):
                self.stem[node] = t
            else:
                self.term[node] = t
        self._reset()

    def _reset(self) -> None:
        self.number: dict[tuple, int] = {}
        self.alive: list[dict[int, int]] = []
        self.found: list[str | None] = []
        self.accept: list[tuple[int, str] | None] = []
        self.moves: list[dict[str, int]] = []
        self.start = self._state({0: 0}, None)
        self.dead = self._state({}, None)

    def _state(self, nodes: dict[int, int], stem: str | None) -> int:
        """Number of a state; nodes: the fewest edits with which each node is reached."""
        todo = list(nodes)
        while todo:  # skip letters of the term
            n = todo.pop()
            e = nodes[n] + 1
            for child in self.children[n].values():
                if e <= self.most[child] and e < nodes.get(child, 99):
                    nodes[child] = e
                    todo.append(child)
        if stem is None:
            stem = min((s for n, e in nodes.items() if not e and (s := self.stem[n])), default=None)
        key = (stem, frozenset(nodes.items()))
        if key not in self.number:
            self.number[key] = len(self.alive)
            self.alive.append(nodes)
            self.found.append(stem)
            ends = [(e, t) for n, e in nodes.items() if (t := self.term[n]) and e <= allowed_errors(t)]
            self.accept.append(min(ends) if ends else (0, stem) if stem else None)
            self.moves.append({})
        return self.number[key]

    def _move(self, state: int, c: str) -> int:
        after: dict[int, int] = {}

        def reach(n: int, e: int) -> None:
            if e <= self.most[n] and e < after.get(n, 99):
                after[n] = e

        for n, e in self.alive[state].items():
            reach(n, e + 1)  # a letter too many
            for letter, child in self.children[n].items():
                reach(child, e + (letter != c))
        self.moves[state][c] = to = self._state(after, self.found[state])
        return to

    def match(self, word: str) -> tuple[str, int] | None:
        """(term, edits) of the closest term, of equal ones the first; None without a match."""
        if len(self.alive) > self.LIMIT:
            self._reset()
        state = self.start
        for c in word:
            to = self.moves[state].get(c)
            state = self._move(state, c) if to is None else to
            if state == self.dead:
                return None
        got = self.accept[state]
        return (got[1], got[0]) if got else None


def quoted(words: list[str], at: int, window: int = 6) -> bool:
    """Whether the word at `at` is reported rather than used: quotation marks on
    both sides or a reporting word in its context window, and nobody addressed."""
    before, after = words[max(0, at - window) : at], words[at + 1 : at + 1 + window]
    own = words[at]
    opened = own[:1] in QUOTES or any(w[:1] in QUOTES and w[-1:] not in QUOTES for w in before)
    closed = own.rstrip(".,;:!?")[-1:] in QUOTES or any(w.rstrip(".,;:!?")[-1:] in QUOTES and w[:1] not in QUOTES for w in after)
    near = {w.strip(STRIP) for w in before + after}
    return (opened and closed or not near.isdisjoint(REPORTING)) and near.isdisjoint(ADDRESSING)


class Matcher:
    """Matches of a text against the lexicon; the word cache only saves repeated work."""

    def __init__(self, terms: list[str]):
        self.automaton = LexiconAutomaton(terms)
        self.cache: dict[str, tuple[str, int] | None] = {}

    def matches(self, text: str | None) -> tuple[int, set[tuple[str, str, int, bool]]]:
        """Number of words, and the distinct (word, term, edits, quoted) among them."""
        words = (text or "").lower().split()
        distinct, cache = set(words), self.cache
        if len(cache) > 100_000:
            cache.clear()
        long = {}  # words too long to keep
        for w in distinct.difference(cache):
            (cache if len(w) <= 64 else long)[w] = self.automaton.match(w.strip(STRIP))
        hits = {w: got for w in distinct if (got := cache[w] if w in cache else long[w])}
        found = {(w.strip(STRIP), *hits[w], quoted(words, k)) for k, w in enumerate(words) if w in hits} if hits else set()
        return len(words), found


def document_terms(text: str | None, stem_sizes: range) -> set[str]:
    """Distinct words of a text (3 letters or more, of any length) and their beginnings as stems."""
    out = set()
    for w in {w.strip(STRIP) for w in (text or "").lower().split()}:
        if len(w) >= 3:
            out.add(w)
            out.update(w[:n] + STEM for n in stem_sizes if n < len(w))
    return out


#: Weights before any row is seen: the evidence of the matches counts in part, misspelled or quoted ones for less.
PRIOR = np.array([0.7, 0.3, 0.2, 0.0, 0.0, 0.0])


@dataclass
class ToxicityModel:
    """Evidence (log odds) of each lexicon term, and the weights of a text's summary."""

    evidence: dict[str, float] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.r_[PRIOR, -3.0])

    def summary(self, matcher: Matcher, text: str | None) -> list[float]:
        """Evidence of plain, misspelled and quoted matches, its density, and the text's length."""
        n, found = matcher.matches(text)
        plain = wrong = reported = 0.0
        for _, term, edits, inside in found:
            value = self.evidence[term]
            if inside:
                reported += value
            elif edits:
                wrong += value
            else:
                plain += value
        length = math.log1p(n)
        return [min(plain, 20.0), min(wrong, 20.0), min(reported, 20.0), min(100 * plain / (50 + n), 20.0), length / 10, (plain > 0) * length / 10, 1.0]

    def score(self, summaries: list[list[float]]) -> np.ndarray:
        odds = np.array(summaries, float).reshape(-1, 7) @ self.weights
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, w: np.ndarray, prior: np.ndarray, strength: float = 3.0) -> np.ndarray:
    """Logistic regression by Newton steps, drawn towards the prior weights (all but the constant firmly)."""
    beta, pull = prior.copy(), np.r_[np.full(len(prior) - 1, strength), 0.1]
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (w * p * (1 - p))[:, None]).T @ x + np.diag(pull), x.T @ (w * (y - p)) - pull * (beta - prior))
        beta = beta + step * min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return beta


def held_out():
    """Rows whose crc32(doc_id as text) mod 4 is 2 (a null id counts as empty text)."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 4 == 2


def _counts(rows: DataFrame, count) -> DataFrame:
    """Sum of the Counters that `count(batch)` yields, by key: partial in each task, then shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, long = Counter(), 0  # `long`: characters of long terms that are held
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                some = count(batch.slice(lo, 256))
                total.update(some)
                long += sum(len(t) for t in some if len(t) > 40)
                if len(total) > 150_000 or long > 1 << 22:
                    yield pa.RecordBatch.from_pydict({"term": list(total), "n": pa.array(total.values(), pa.int64())})
                    total.clear()
                    long = 0
        if total:
            yield pa.RecordBatch.from_pydict({"term": list(total), "n": pa.array(total.values(), pa.int64())})

    return rows.mapInArrow(run, "term string, n bigint").groupBy("term").agg(F.sum("n").alias("n"))


def testable(sizes: dict[int, int], n_toxic: int, n_clean: int, risk: float) -> int:
    """How many terms can be significant at all (Tarone): `sizes` says how many
    terms a given number of toxic texts holds; rarer ones need not be counted."""
    base = n_toxic / max(n_toxic + n_clean, 1)
    for k in range(1, max(sizes, default=0) + 1):
        tried = sum(v for n, v in sizes.items() if n >= k)
        if tried * base**k <= risk:
            return tried
    return sum(sizes.values())


def significant(a: int, b: int, n_toxic: int, n_clean: int, tried: int, risk: float, precision: float = 0.5) -> bool:
    """Whether a term of a toxic and b clean texts is held by toxic ones far more often than chance allows."""
    base = math.log(max(n_toxic, 1) / max(n_toxic + n_clean, 1))
    chance = math.lgamma(a + b + 1) - math.lgamma(a + 1) - math.lgamma(b + 1) + a * base
    return a >= precision * (a + b) and math.log(max(tried, 1)) + chance <= math.log(risk)


def choose_terms(toxic: dict[str, int], clean: dict[str, int], n_toxic: int, n_clean: int, tried: int, risk: float, precision: float = 0.5) -> dict[str, float]:
    """Terms that toxic texts hold far more often than chance allows.

    A term in a toxic and b clean texts is kept if a of a + b toxic ones would
    be expected in fewer than `risk` of the `tried` terms were toxicity dealt
    at random, and if its texts are toxic with `precision` or more.  Of nested terms the most specific one is kept that still covers
    four fifths of the texts; what a kept stem covers is left out.  Returns the
    evidence of each term: the log of how much likelier toxic texts hold it.
    """
    good = {t: a for t, a in toxic.items() if significant(a, clean.get(t, 0), n_toxic, n_clean, tried, risk, precision)}
    best: dict[str, int] = {}
    for t, a in good.items():
        body = t.removesuffix(STEM)
        for n in range(1, len(body) if not t.endswith(STEM) else len(body)):
            best[body[:n] + STEM] = max(best.get(body[:n] + STEM, 0), a)
        if not t.endswith(STEM):
            best[body + STEM] = max(best.get(body + STEM, 0), a)
    kept = {t for t, a in good.items() if not (t.endswith(STEM) and best.get(t, 0) >= 0.8 * a)}
    odds = {t: math.log((toxic[t] + 0.5) / (clean.get(t, 0) + 0.5) * (n_clean + 1) / (n_toxic + 1)) for t in kept}
    covered = lambda t: any(t.removesuffix(STEM)[:n] + STEM in kept - {t} for n in range(1, len(t)))
    return {t: min(max(odds[t], 0.0), 6.0) for t in sorted(kept) if not covered(t)}


def train(
    docs: DataFrame, labels: DataFrame, max_rows: int = 25_000, stem_sizes: range = range(3, 9), risk: float = 1.0,
) -> ToxicityModel:
    """Fit the lexicon and the weights on labelled rows that are not held out.

    The sample is bounded and documented: at most `max_rows` toxic and
    `max_rows` clean documents, those with the least hash of the id, which is
    also the bound of what is broadcast.  All terms of the sample are tested.
    Rates of the whole table weigh the sample.  A document with several labels
    is toxic if any says so; null labels are no labels.  Copies of a text count
    once.  Without labels of both kinds the lexicon is empty.
    """
    marked = (
        labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").where(~held_out())
        .groupBy(F.col("doc_id").alias("label_id")).agg(F.max(F.col("toxic").cast("int")).alias("label"))
    )
    marked = checkpointed(marked)
    all_rows = dict(marked.groupBy("label").count().collect())
    some = [marked.where(F.col("label") == k).orderBy(F.xxhash64("label_id"), "label_id").limit(max_rows) for k in (0, 1)]
    own = docs.select(F.col("doc_id").alias("own_id"), F.col("text").cast("string").alias("text"))
    sample = own.join(F.broadcast(some[0].union(some[1])), F.col("own_id") == F.col("label_id")).select("text", "label")
    sample = checkpointed(sample.groupBy("text").agg(F.max("label").alias("label")).withColumn("half", F.abs(F.xxhash64("text") % 2)))
    n = {0: 0, 1: 0} | dict(sample.groupBy("label").count().collect())
    share = all_rows.get(1, 0) / max(sum(all_rows.values()), 1)
    start = math.log((share + 0.001) / (1.001 - share))
    if not n[0] or not n[1]:
        return ToxicityModel(weights=np.r_[PRIOR, start])
    whole, *halves = (lexicon(x, stem_sizes, risk) for x in (sample, *(sample.where(F.col("half") == h) for h in (0, 1))))
    # the summary of each half by the lexicon of the other: weights learn from terms that did not see the text
    rows = [r for h in (0, 1) for r in _summaries(sample.where(F.col("half") == 1 - h), ToxicityModel(halves[h]))]
    x, y = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    w = np.where(y == 1, all_rows[1] / n[1], all_rows[0] / n[0]) * sum(n.values()) / sum(all_rows.values())
    return ToxicityModel(whole, fit(x, y, w, np.r_[PRIOR, start]))


def lexicon(sample: DataFrame, stem_sizes: range, risk: float) -> dict[str, float]:
    """Terms and their evidence from distinct texts with a label (bounded by the sample).
    Candidates stay in Spark; only significant ones come to the driver."""
    n = {0: 0, 1: 0} | dict(sample.groupBy("label").count().collect())

    def holding(label: int) -> DataFrame:
        def count(batch):
            return Counter(t for x in batch.column(0).to_pylist() for t in document_terms(x, stem_sizes))

        return _counts(sample.where(F.col("label") == label).select("text"), count)

    found = checkpointed(holding(1))
    tried = testable(dict(found.groupBy("n").count().collect()), n[1], n[0], risk)

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)
            yield batch.filter(pa.array([significant(a, b, n[1], n[0], tried, risk) for a, b in counts], pa.bool_()))

    clean = holding(0).withColumnRenamed("n", "b")
    # a term that is not significant without any clean text never is
    least = next((a for a in range(1, n[1] + 1) if significant(a, 0, n[1], n[0], tried, risk)), None)
    if least is None:
        return {}
    tested = found.where(F.col("n") >= least)
    both = tested.join(clean, "term", "left").select("term", "n", F.coalesce("b", F.lit(0)).cast("bigint").alias("b"))
    good = both.mapInArrow(test, "term string, n bigint, b bigint").collect()
    return choose_terms({r.term: r.n for r in good}, {r.term: r.b for r in good}, n[1], n[0], tried, risk)


def _summaries(rows: DataFrame, model: ToxicityModel) -> list[tuple[list[float], int]]:
    """Summary and label of each row of the bounded sample."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = _matcher(model)
        for batch in batches:
            got = [model.summary(matcher, t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([pa.array(got, pa.list_(pa.float64())), batch.column("label")], ["x", "label"])

    return [(r.x, r.label) for r in rows.mapInArrow(run, "x array<double>, label int").collect()]


_MATCHERS: dict[tuple, Matcher] = {}


def _matcher(model: ToxicityModel) -> Matcher:
    """One matcher for each worker process and lexicon."""
    only_cache("toxicity", _MATCHERS.clear)
    key = tuple(model.evidence)
    if key not in _MATCHERS:
        _MATCHERS.clear()
        _MATCHERS[key] = Matcher(list(key))
    return _MATCHERS[key]


def with_score(docs: DataFrame, model: ToxicityModel, name: str = "score") -> DataFrame:
    """docs with the score of each whole text (null: empty) in column `name`, in place of
    any column of that name; other columns pass through unread."""
    docs = docs.drop(name)
    known = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")
    source = docs.select(*[F.col(f"`{c}`") for c in docs.columns])
    schema = ", ".join([*(f"`{c}` {t}" for c, t in docs.dtypes), f"`{name}` double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = known.value
        matcher = _matcher(model)
        for batch in batches:
            scores = model.score([model.summary(matcher, t.as_py()) for t in batch.column(at)])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], [*batch.schema.names, name])

    return source.mapInArrow(run, schema)
