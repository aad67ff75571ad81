"""URL filter on a sorted digest array: 64-bit xxhash keys of the rules, memory-
mapped, probed by vectorised binary search; the stored strings decide."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.llm.common import ascii_lower, checkpointed, shared_dir
from eventlake.llm.files import array, new_file

#: What becomes of a url without a fitting rule: the filter is a block list.
DEFAULT_VERDICT = "allow"


def url_parts(df: DataFrame, url: str = "url") -> DataFrame:
    """Add host (A-Z lower-cased) and path; both empty for a null url or one without `://`."""
    col = F.coalesce(F.col(url).cast("string"), F.lit(""))
    at = F.instr(col, "://")
    rest = F.when(at > 0, F.substr(col, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), "^[^?#]*", 0)
    return df.withColumns({"host": ascii_lower(host), "path": path})


@dataclass(frozen=True)
class UrlIndex:
    """A built index: `shards` file groups under `path`, of which shard k holds keys
    from bounds[k] on; path lengths that occur in rules and the longest host."""

    path: str
    names: tuple[str, ...]
    bounds: tuple[int, ...]
    path_lengths: tuple[int, ...]
    host_length: int


def build(rules: DataFrame, path: str | None = None, shard_rows: int = 1_000_000) -> UrlIndex:
    """Index of rules (rule: host then path, such as `example.net/en/`; verdict).

    Keys are dealt by range and sorted; each partition writes one shard: sorted
    keys, offsets, strings and verdicts.  The driver sees a row for each shard
    and the distinct path lengths.  Null rules are left out; of a rule given
    twice `block` wins; a rule without `/` fits every path of its host.
    """
    spark = rules.sparkSession
    path = path or shared_dir(spark, "url-index")
    clean = rules.where("rule IS NOT NULL").groupBy("rule").agg(F.max("verdict").alias("verdict"))

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.array([xxhash.xxh64_intdigest(r.as_py()) for r in batch.column(0)], np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array((keys ^ np.uint64(1 << 63)).view(np.int64)), *batch.columns], ["key", "rule", "verdict"])

    keyed = checkpointed(clean.select("rule", "verdict").mapInArrow(digests, "key bigint, rule string, verdict string"))
    split = F.instr("rule", "/")
    shape = keyed.select(F.when(split > 0, F.length("rule") - split + 1).otherwise(0).alias("p"), F.when(split > 0, split - 1).otherwise(F.length("rule")).alias("h"))
    lengths = [r.p for r in shape.select("p").distinct().collect()]
    host_length = shape.agg(F.max("h")).first()[0] or 0
    parts = max(1, -(-keyed.count() // shard_rows))

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = [b for b in batches if b.num_rows]
        if not table:
            return
        keys = np.concatenate([b.column(0).to_numpy() for b in table]).view(np.uint64) ^ np.uint64(1 << 63)
        rules = [r.encode() for b in table for r in b.column(1).to_pylist()]
        block = np.array([v == "block" for b in table for v in b.column(2).to_pylist()], np.uint8)
        name = f"{path}/{keys[0]:016x}-{uuid.uuid4().hex}"
        for suffix, content in (
            ("keys", keys), ("ends", np.cumsum([0, *map(len, rules)]).astype(np.int64)),
            ("rules", np.frombuffer(b"".join(rules), np.uint8)), ("block", block),
        ):
            with new_file(f"{name}.{suffix}") as out:
                out.write(content.tobytes())
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([str(keys[0])])], ["name", "low"])

    made = checkpointed(keyed.repartitionByRange(parts, "key").sortWithinPartitions("key", "rule").mapInArrow(shard, "name string, low string")).collect()
    made = sorted((int(r.low), r.name) for r in made)
    return UrlIndex(path, tuple(n for _, n in made), tuple(k for k, _ in made), tuple(sorted(lengths, reverse=True)), host_length)


class Probe:
    """The index in a worker process; files are mapped when first used."""

    def __init__(self, index: UrlIndex):
        self.index, self.shards = index, {}
        self.bounds = np.array(index.bounds, np.uint64)

    def _shard(self, k: int):
        if k not in self.shards:
            name = self.index.names[k]
            self.shards[k] = (array(f"{name}.keys", np.uint64), array(f"{name}.ends", np.int64), array(f"{name}.rules", np.uint8), array(f"{name}.block", np.uint8))
        return self.shards[k]

    def verdicts(self, candidates: list[str]) -> list[bool | None]:
        """For each string: None if it is no rule, else whether it blocks."""
        out: list[bool | None] = [None] * len(candidates)
        if not candidates or not len(self.bounds):
            return out
        keys = np.fromiter((xxhash.xxh64_intdigest(c) for c in candidates), np.uint64, len(candidates))
        shard = np.searchsorted(self.bounds, keys, "right").astype(np.int64) - 1
        for k in np.unique(shard[shard >= 0]):
            own, ends, rules, block = self._shard(int(k))
            mine = np.flatnonzero(shard == k)
            low, high = np.searchsorted(own, keys[mine]), np.searchsorted(own, keys[mine], "right")
            for i, a, b in zip(mine[low < high].tolist(), low[low < high], high[low < high], strict=True):
                text = candidates[i].encode()
                for j in range(a, b):  # equal digests: the strings decide
                    if rules[ends[j] : ends[j + 1]].tobytes() == text:
                        out[i] = bool(block[j])
        return out

    def candidates(self, host: str, path: str) -> list[str]:
        """Strings of all rules that would fit, longest first; of equal length the longer host first."""
        labels, at = [], max(0, len(host) - self.index.host_length)
        if at and host[at - 1] != ".":
            at = host.find(".", at) + 1 or len(host) + 1
        while 0 <= at <= len(host):
            labels.append(host[at:])
            step = host.find(".", at)
            at = step + 1 if step >= 0 else -1
        out = [h + path[:n] for h in labels if h for n in self.index.path_lengths if n <= len(path)]
        return sorted(out, key=len, reverse=True)


_PROBES: dict[UrlIndex, Probe] = {}


def judge(pages: DataFrame, index: UrlIndex, default: str = DEFAULT_VERDICT) -> DataFrame:
    """Add host, path, rule and verdict to pages (column url).

    A rule fits its host and all subdomains if the path starts with the rule's;
    the longest fitting rule decides (of equal length the one with the longer
    host), without one the verdict is `default` and rule null.  Null and odd
    urls have empty host and path and fit no rule.
    """
    given = url_parts(pages.drop("host", "path", "rule", "verdict"))
    h, p = given.columns.index("host"), given.columns.index("path")
    schema = ", ".join([*(f"`{c}` {t}" for c, t in given.dtypes), "rule string", "verdict string"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if index not in _PROBES:
            _PROBES[index] = Probe(index)
        probe = _PROBES[index]
        for batch in batches:
            rules: list[str | None] = []
            verdicts: list[str] = []
            for lo in range(0, batch.num_rows, 2000):
                hosts, paths = batch.column(h).slice(lo, 2000).to_pylist(), batch.column(p).slice(lo, 2000).to_pylist()
                asked = [probe.candidates(*x) for x in zip(hosts, paths, strict=True)]
                distinct = list(dict.fromkeys(c for a in asked for c in a))
                known = {c: v for c, v in zip(distinct, probe.verdicts(distinct), strict=True) if v is not None}
                for a in asked:
                    rule = next((c for c in a if c in known), None)
                    rules.append(rule)
                    verdicts.append(default if rule is None else "block" if known[rule] else "allow")
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rules, pa.string()), pa.array(verdicts, pa.string())], [*batch.schema.names, "rule", "verdict"])

    return given.mapInArrow(run, schema)


def rule_table(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    return spark.createDataFrame(rules, "verdict string, rule string").select("rule", "verdict")
