"""Secret scan by a trigram inverted index.

Each rule is a regular expression.  From its syntax tree a Boolean trigram query is
derived: an OR of alternatives, each the AND of the trigrams that every match of that
alternative must hold.  The index holds the postings (trigram, digest of the text) of
the trigrams that some rule asks for.  A rule's postings are intersected, and only the
texts left over are searched with its expression.  A rule without mandatory trigrams
(`[0-9a-f]{24,}`) has no such query and searches every text.

Everything on this path is a DataFrame function: no Python worker, no text on the driver.

* The digest only leads from postings to texts.  Two texts with one digest share their
  postings, which adds candidates; each text is then searched itself, so it never
  adds or loses a span.  Copies of a text have one posting.
* Letters A-Z are folded in index and queries; the expression decides about case.
* Candidates (a digest and its kinds) are broadcast while their measured number is
  below a bound; beyond it they are joined in salted copies, so that a text
  held by a third of all rows is spread over tasks.

Null texts count as empty.  Empty tables give no rows, repeated rows are kept, extra
columns pass through (names that begin with `__secret` are used here).
"""

from __future__ import annotations

from dataclasses import dataclass
from re import _constants as syntax
from re import _parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.llm.common import checkpointed, shared_dir


@dataclass(frozen=True)
class Rule:
    """Matches of `pattern` (syntax that Java and Python share), leftmost and not
    overlapping; those whose `group` has fewer than `least` characters are dropped afterwards."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


#: The three kinds that are always found.
BASE_RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)

#: Published shapes of credentials.
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\x20\r\n]*-----END [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[oprsu]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abeprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("url_login", r"[a-z][a-z0-9+.-]{1,15}://[^/?#:@\x20\x09-\x0D]{1,64}:[^/?#:@\x20\x09-\x0D]{1,64}@"),
)

RULES = BASE_RULES + MORE_RULES

#: Any text may stand here: the runs before and after it need not touch.
_GAP = ("", "")


def _fold(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def _letters(items: list) -> list[tuple[str, ...]]:
    """A character class: its letters where they are few, else a gap."""
    letters: set[str] = set()
    for op, arg in items:
        if op is syntax.LITERAL:
            letters.add(_fold(chr(arg)))
        elif op is syntax.RANGE and arg[1] - arg[0] < 8:
            letters.update(_fold(chr(c)) for c in range(arg[0], arg[1] + 1))
        else:
            return [_GAP]
    return [(c,) for c in sorted(letters)] if len(letters) <= 8 else [_GAP]


def _shapes(tree, most: int) -> list[tuple[str, ...]]:
    """Alternatives of a pattern as runs of letters around gaps: every match holds, in
    order, all runs of one alternative.  What would make more than `most` alternatives becomes a gap."""
    out: list[tuple[str, ...]] = [("",)]
    for op, arg in tree:
        if op is syntax.LITERAL:
            part = [(_fold(chr(arg)),)]
        elif op is syntax.IN:
            part = _letters(arg)
        elif op is syntax.SUBPATTERN:
            part = _shapes(arg[-1], most)
        elif op is syntax.BRANCH:
            part = [s for tree in arg[1] for s in _shapes(tree, most)]
        elif op in (syntax.MAX_REPEAT, syntax.MIN_REPEAT):
            low, high, item = arg
            once = _shapes(item, most)
            if low == 0:
                part = [("",), *once] if high == 1 else [_GAP]
            else:
                part = once
                for _ in range(min(low, 3) - 1):
                    part = _joined(part, once)[: most + 1]
                if high > 3 or low < high:
                    part = _joined(part, [_GAP])
        elif op in (syntax.AT, syntax.ASSERT, syntax.ASSERT_NOT):
            continue  # no letter is consumed
        else:
            part = [_GAP]
        out = _joined(out, part if len(out) * len(part) <= most else [_GAP])
    return out


def _joined(left: list[tuple[str, ...]], right: list[tuple[str, ...]]) -> list[tuple[str, ...]]:
    return list(dict.fromkeys((*a[:-1], a[-1] + b[0], *b[1:]) for a in left for b in right))


def trigram_query(pattern: str, most: int = 256) -> list[frozenset[str]] | None:
    """The trigrams of each alternative: a text without all trigrams of one of them holds no
    match.  None where an alternative has none: no text can be left out."""
    found = {frozenset(run[i : i + 3] for run in shape for i in range(len(run) - 2)) for shape in _shapes(_parser.parse(pattern), most)}
    if frozenset() in found:
        return None
    return sorted((q for q in found if not any(p < q for p in found)), key=sorted)


def _text(name: str) -> Column:
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


def build_index(docs: DataFrame, trigrams: set[str], text: str = "text") -> DataFrame:
    """The inverted index: postings (trigram, digest) of every text, stored by trigram in the
    shared folder, so that a query reads the row groups of its own trigrams."""
    asked = F.array(*[F.lit(t) for t in sorted(trigrams)]).cast("array<string>")
    # the folded text is bound once (a lambda's outer expressions are evaluated for each element)
    held = F.transform(F.array(F.lower(_text(text))), lambda low: F.filter(asked, lambda t: F.contains(low, t)))[0]
    postings = docs.select(F.xxhash64(_text(text)).alias("digest"), F.explode(held).alias("trigram")).distinct()
    path = shared_dir(docs.sparkSession, "trigram-index")
    postings.sortWithinPartitions("trigram").write.parquet(path)
    return docs.sparkSession.read.schema("digest bigint, trigram string").parquet(path)


def candidates(index: DataFrame, queries: dict[str, list[frozenset[str]]]) -> DataFrame:
    """Rows (digest, kinds): the texts left when each rule's postings are intersected."""
    asked = sorted({t for query in queries.values() for part in query for t in part})
    held = index.where(F.col("trigram").isin(asked)).groupBy("digest").agg(F.collect_set("trigram").alias("held"))

    def all_of(part: frozenset[str]) -> Column:
        return F.size(F.array_except(F.array(*[F.lit(t) for t in sorted(part)]), F.col("held"))) == 0

    def any_of(query: list[frozenset[str]]) -> Column:
        out = F.lit(False)
        for part in query:
            out = out | all_of(part)
        return out

    kinds = F.array_compact(F.array(*[F.when(any_of(q), F.lit(kind)) for kind, q in queries.items()]))
    return held.select("digest", kinds.cast("array<string>").alias("kinds")).where(F.size("kinds") > 0)


SPAN = "array<struct<start:int,rank:int,stop:int,kind:string>>"

# The spans of a rule as SQL text: one parse in the JVM instead of thousands of client calls
# building nested lambdas.  `transform(array(x), v -> ...)[0]` computes x once.

_SUMS = """aggregate({part}, named_struct('t', 0, 's', CAST(array() AS array<int>)),
  (a, x) -> named_struct('t', a.t + x, 's', concat(a.s, array(a.t + x))), a -> a.s)"""

# Inclusive running sums of `steps`, in blocks of 512, so that a long array costs n * 512 and not n * n.
_RUNNING = f"""transform(array(transform(sequence(0, CAST((size(steps) - 1) div 512 AS INT)),
    i -> {_SUMS.format(part="slice(steps, i * 512 + 1, 512)")})),
  parts -> transform(array({_SUMS.format(part="transform(parts, x -> x[size(x) - 1])")}),
    done -> flatten(transform(parts, (x, i) -> transform(x, y -> y + if(i = 0, 0, done[i - 1])))))[0])[0]"""

# Texts between matches and matches take turns, so their lengths give every place.
_SPANS = """transform(array(regexp_extract_all({text}, {pattern}, 0)), found -> CASE WHEN {any} THEN
  transform(array(zip_with(slice(split({text}, {pattern}, -1), 1, size(found)), found, (a, b) -> length(a) + length(b))),
    steps -> transform(array(named_struct('stops', {running}, 'held', {held})), p -> transform(
      filter(transform(found, (m, i) -> named_struct('start', p.stops[i] - length(m), 'stop', p.stops[i], 'n', length(p.held[i]))), r -> r.n >= {least}),
      r -> named_struct('start', r.start, 'rank', {rank}, 'stop', r.stop, 'kind', {kind})))[0])[0]
  ELSE CAST(array() AS {span}) END)[0]"""


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _spans(text: str, rule: Rule, rank: int) -> str:
    """SQL of a rule's spans in the text expression `text`, in code points."""
    pattern = _quoted(rule.pattern)
    if rule.least and not rule.group:  # most matches may be too short: places are found only for a text with a long one
        some = f"exists(found, m -> length(m) >= {rule.least})"
    else:
        some = "size(found) > 0"
    return _SPANS.format(text=text, pattern=pattern, any=some, running=_RUNNING, least=rule.least, rank=rank, kind=_quoted(rule.kind), span=SPAN,
                         held=f"regexp_extract_all({text}, {pattern}, {rule.group})" if rule.group else "found")


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", broadcast_rows: int = 500_000, salts: int = 16) -> DataFrame:
    """Every row with `__secret_spans`: array<struct<start, rank, stop, kind>> by start, then by the
    rule's place in `rules`; code points, end exclusive.  `broadcast_rows` candidates (a digest and
    the names of its kinds, some 100 bytes) are the most that is broadcast."""
    queries = {r.kind: q for r in rules if (q := trigram_query(r.pattern)) is not None}
    rows = docs.withColumn("__secret_digest", F.xxhash64(_text(text)))
    if queries:
        index = build_index(docs, {t for q in queries.values() for part in q for t in part}, text)
        left = checkpointed(candidates(index, queries)).withColumnsRenamed({"digest": "__secret_digest", "kinds": "__secret_kinds"})
        if left.count() <= broadcast_rows:
            rows = rows.join(F.broadcast(left), "__secret_digest", "left")
        else:
            others = [F.col(f"`{c}`").cast("string") for c in docs.columns if c != text]
            rows = rows.withColumn("__secret_salt", F.pmod(F.xxhash64(F.lit(0), *others), F.lit(salts)).cast("int"))
            left = left.withColumn("__secret_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
            rows = rows.join(left, ["__secret_digest", "__secret_salt"], "left").drop("__secret_salt")
    else:
        rows = rows.withColumn("__secret_kinds", F.array().cast("array<string>"))
    found = []
    for rank, rule in enumerate(rules):
        spans = _spans(f"coalesce(CAST(`{text}` AS STRING), '')", rule, rank)
        if rule.kind in queries:
            spans = f"CASE WHEN array_contains(__secret_kinds, {_quoted(rule.kind)}) THEN {spans} ELSE CAST(array() AS {SPAN}) END"
        found.append(spans)
    return rows.withColumn("__secret_spans", F.expr(f"array_sort(concat({', '.join(found)}))")).select(*[F.col(f"`{c}`") for c in docs.columns], "__secret_spans")


def spans_text(spans: Column) -> Column:
    """Spans as `kind:start:end`, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def _of_kind(kind: str):
    return lambda s: s["kind"] == kind


def digest_columns(rules: tuple[Rule, ...] = BASE_RULES, spans: str = "__secret_spans") -> list[Column]:
    """Counts of the base kinds, the sha256 of their spans, and all spans as text."""
    col = F.col(spans)
    counts = [F.size(F.filter(col, _of_kind(r.kind))).cast("long").alias(f"n_{r.kind}") for r in rules]
    base = spans_text(F.filter(col, lambda s: s["rank"] < len(rules)))
    return [*counts, F.sha2(base, 256).alias("base_sha256"), spans_text(col).alias("spans")]


def oracle_sql(rules: tuple[Rule, ...] = RULES, base: int = len(BASE_RULES)) -> str:
    """The query in DuckDB SQL: every text searched with every expression, without an index."""
    quoted = [(r, "'" + r.pattern.replace("'", "''") + "'") for r in rules]
    parts = "\nUNION ALL ".join(
        f"SELECT u, {rank} AS rank, '{r.kind}' AS kind, unnest(range(1, 1 + len(regexp_extract_all(text, {p})))) AS i, "
        f"unnest(regexp_extract_all(text, {p})) AS m, unnest(regexp_extract_all(text, {p}, {r.group})) AS g, "
        f"unnest(string_split_regex(text, {p})[:len(regexp_extract_all(text, {p}))]) AS gap, {r.least} AS least FROM docs"
        for rank, (r, p) in enumerate(quoted))
    counts = ", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in rules[:base])
    names = ", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in rules[:base])
    return f"""
WITH docs AS (
    SELECT row_number() OVER () AS u, doc_id, coalesce(text, '') AS text FROM documents
), m AS (
{parts}
), p AS (
    SELECT u, rank, kind, length(m) AS n, length(g) AS l, least,
           sum(length(gap) + length(m)) OVER (PARTITION BY u, rank ORDER BY i) AS stop FROM m
), s AS (
    SELECT u, rank, kind, CAST(stop - n AS BIGINT) AS start, kind || ':' || CAST(stop - n AS BIGINT) || ':' || CAST(stop AS BIGINT) AS t
    FROM p WHERE l >= least
), a AS (
    SELECT u, {counts}, string_agg(t, ',' ORDER BY start, rank) FILTER (rank < {base}) AS base,
           string_agg(t, ',' ORDER BY start, rank) AS spans FROM s GROUP BY u
)
SELECT doc_id, {names}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM docs LEFT JOIN a USING (u)
"""
