"""Metadata tables: source wiring, project lists and property rules.

The four metadata tables are small dimension tables (the reference keeps them
in memory on every task).  Their sizes are checked before they are broadcast
or turned into an in-expression lookup map.

source_sink:  source_server_port, source_group_id, source_sasl_jaas, source_topic,
              sink_project_id, valid_flag, debug_mode_flag
project_task: name, project_status
trans_rule:   id, sink_project_id, input_field, output_field, output_type, valid_flag
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from eventlake.config import PipelineConfig


@dataclass
class Metadata:
    source_sink: DataFrame
    project_task: DataFrame
    trans_rule: DataFrame
    routes: DataFrame | None = None
    counters: DataFrame | None = None
    _lookups: dict = field(default_factory=dict, repr=False)

    def rule_table(self) -> RuleTable:
        """The property rules as a hash table, made once for this metadata."""
        if RuleTable not in self._lookups:
            self._lookups[RuleTable] = RuleTable.of(self)
        return self._lookups[RuleTable]

    def lookup(self, make: Callable[[Metadata], DataFrame]) -> Lookup:
        """`make(self)` as a lookup table, measured once for this metadata."""
        if make not in self._lookups:
            self._lookups[make] = Lookup.of(make(self))
        return self._lookups[make]

    def snapshot(self) -> Metadata:
        """All tables read now: later use neither reads the store nor sees its changes."""
        return Metadata(*(x if x is None else local_copy(x) for x in (
            self.source_sink, self.project_task, self.trans_rule, self.routes, self.counters)))


SNAPSHOT_BYTES = 64 << 20
#: A lookup table of at most so many measured bytes is broadcast.
BROADCAST_BYTES = 32 << 20
#: Beyond that records and table are joined in so many parts of every key.
SLOTS = 16


#: A table of more rows is not fetched to be measured.
FETCH_ROWS = 500_000


def _measured(df: DataFrame, max_bytes: int) -> tuple[DataFrame, int]:
    """A table of at most `max_bytes` as a local relation, a larger one checkpointed; and its bytes
    (for the larger one: a number above the bound).  The fetch itself is bounded by FETCH_ROWS
    and by spark.driver.maxResultSize."""
    from eventlake.session import ensure_checkpoint_dir

    rows = df.limit(FETCH_ROWS + 1).toArrow()
    if len(rows) <= FETCH_ROWS and rows.nbytes <= max_bytes:
        return df.sparkSession.createDataFrame(rows, schema=df.schema), rows.nbytes
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(), max_bytes + 1


def local_copy(df: DataFrame, max_bytes: int = SNAPSHOT_BYTES) -> DataFrame:
    """A small table as a local relation: read once, with exact statistics.

    A table of more than `max_bytes` is written to the shared checkpoint folder
    instead, so that the driver's memory is bounded."""
    return _measured(df, max_bytes)[0]


@dataclass(frozen=True)
class Lookup:
    """A table whose bytes were measured: `rows` with a column `_slot`, which says in how
    many parts each key is held, and whether it may be broadcast."""

    rows: DataFrame
    slots: int
    small: bool

    @staticmethod
    def of(df: DataFrame, max_bytes: int = BROADCAST_BYTES, slots: int = SLOTS) -> Lookup:
        # `_slot` is data, not a literal, so that the join keeps a key even where the records' keys are constants
        rows, size = _measured(df.withColumn("_slot", F.lit(0)), max_bytes)
        if size <= max_bytes:
            return Lookup(rows, 1, True)
        return Lookup(rows.drop("_slot").withColumn("_slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1)))), slots, False)

    @staticmethod
    def held(spark: SparkSession, table: pa.Table, max_bytes: int = BROADCAST_BYTES, slots: int = SLOTS) -> Lookup:
        """A table that the driver holds."""
        small = table.nbytes <= max_bytes
        rows = spark.createDataFrame(table.append_column("_slot", pa.array([0] * len(table), pa.int32())))
        if small:
            return Lookup(rows, 1, True)
        return Lookup(rows.drop("_slot").withColumn("_slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1)))), slots, False)

    def attach(self, records: DataFrame, on: dict[str, str], spread: Column) -> DataFrame:
        """Left join on `on` (record column -> table column); the table's key columns are left out.

        A small table is broadcast: no record moves.  A larger one is joined by a shuffle in which the
        records of a key go to `slots` places by `spread` (any column that differs between them),
        so that a topic with a third of all records is no single task."""
        keys = {c: f"_key_{i}" for i, c in enumerate(on.values())}
        table = self.rows.select(*[F.col(c).alias(keys.get(c, c)) for c in self.rows.columns])
        slot = F.pmod(F.coalesce(F.hash(spread), F.lit(0)), F.lit(self.slots))
        same = slot == F.col("_slot")
        for mine, other in on.items():
            same = same & (F.col(mine) == F.col(keys[other]))
        return records.join(F.broadcast(table) if self.small else table, same, "left").drop("_slot", *keys.values())


def active_wiring(meta: Metadata) -> DataFrame:
    """J1/J2 + F1: valid, non-debug wiring rows whose project task is active.

    The reference writes a LEFT JOIN whose WHERE on the right side makes it inner;
    we write the inner join directly."""
    ss = meta.source_sink.filter((F.col("valid_flag") == 1) & (F.col("debug_mode_flag") == 0))
    task = meta.project_task.filter(F.col("project_status") == 1).select(
        F.col("name").alias("sink_project_id")
    )
    return ss.join(task, "sink_project_id", "inner")


def project_topics(meta: Metadata) -> DataFrame:
    """A1: topics per (server, group, auth, project), joined with ',' in topic order."""
    return (
        active_wiring(meta)
        .groupBy("source_server_port", "source_group_id", "source_sasl_jaas", "sink_project_id")
        .agg(F.expr("listagg(source_topic, ',') within group (order by source_topic)").alias("source_topics"))
    )


def sink_projects(meta: Metadata) -> DataFrame:
    """A2: project list per (server, group, topic), joined with ',' in project order."""
    return (
        active_wiring(meta)
        .groupBy("source_server_port", "source_group_id", "source_topic")
        .agg(F.expr("listagg(sink_project_id, ',') within group (order by sink_project_id)").alias("sink_projects"))
    )


def source_topics(meta: Metadata) -> DataFrame:
    """The distinct topics of every (server, group, auth): its subscription list."""
    return (
        active_wiring(meta).groupBy("source_server_port", "source_group_id", "source_sasl_jaas")
        .agg(F.expr("listagg(distinct source_topic, ',') within group (order by source_topic)").alias("topics"))
    )


def consumer_plan(meta: Metadata) -> DataFrame:
    """Per (server, group, auth) the list of (project, topics) to subscribe to."""
    return (
        project_topics(meta)
        .groupBy("source_server_port", "source_group_id", "source_sasl_jaas")
        .agg(
            F.array_sort(
                F.collect_list(F.struct("sink_project_id", F.split("source_topics", ",").alias("topics")))
            ).alias("projects")
        )
    )


def active_rules(meta: Metadata, lower_keys: bool = True) -> DataFrame:
    """valid rules; input fields lower-cased (upper-case rules would never match)."""
    key = F.lower("input_field") if lower_keys else F.col("input_field")
    return meta.trans_rule.filter(F.col("valid_flag") == 1).select(
        F.col("sink_project_id").alias("project"),
        key.alias("key"),
        F.col("output_field").alias("out"),
        F.expr("try_cast(output_type as int)").alias("type"),
        F.col("id").alias("rule_order"),
    )


#: The rules are held whole by every task; more bytes are refused.
RULES_BYTES = 64 << 20


@dataclass(frozen=True)
class RuleTable:
    """All valid rules as a hash table in one value, so that a property finds its rule
    in time that does not depend on their number.

    Place pmod(xxhash64(project, key), size) of `rules` holds the rules of that project and key (and
    the few that share the place); place pmod(xxhash64(name), size) of `names` the projects that have
    rules.  `lengths` are the different lengths of project names.  Both values are one-row
    tables of measured size, read as scalar subqueries."""

    rules: DataFrame
    names: DataFrame
    lengths: tuple[int, ...]

    @staticmethod
    def of(meta: Metadata, max_bytes: int = RULES_BYTES) -> RuleTable:
        rows, size = _measured(active_rules(meta).where("project IS NOT NULL AND key IS NOT NULL").select(
            "project", "key", F.col("rule_order").cast("int").alias("rule_order"), "type", "out"), max_bytes)
        if size > max_bytes:
            raise ValueError(f"the property rules take more than {max_bytes} bytes")
        held = rows.select("*", F.xxhash64("project", "key").alias("at"), F.xxhash64("project").alias("name_at"), F.length("project").alias("n")).toArrow()
        rules = [(r["at"], {k: r[k] for k in ("rule_order", "type", "out", "project", "key")}) for r in held.to_pylist()]
        names = {(r["name_at"], r["project"]) for r in held.select(["name_at", "project"]).to_pylist()}
        spark = rows.sparkSession
        rule = "struct<rule_order:int,type:int,out:string,project:string,key:string>"
        return RuleTable(_one_value(spark, _places(rules), rule), _one_value(spark, _places(names), "string"), tuple(sorted(set(held["n"].to_pylist()))))


def _places(items: Iterable[tuple[int, object]]) -> list[list]:
    """Items (64-bit hash, value) by place; a power of two of places, four times the items or more, so that most are empty."""
    items = list(items)
    out: list[list] = [[] for _ in range(4 << max(0, (len(items) - 1).bit_length()))]
    for h, value in items:
        out[h % len(out)].append(value)
    return out


def _one_value(spark: SparkSession, places: list[list], item: str) -> DataFrame:
    schema = StructType.fromDDL(f"v array<array<{item}>>")
    return spark.createDataFrame(pa.table({"v": [places]}, schema=to_arrow_schema(schema)), schema)


#: Projects with rules whose name lies in a text: every part of the text that has the length of a name is
#: looked up, so the work depends on the text and on the different lengths, not on the number of projects.
#: Text and table are read once, so that they are no columns of their own, which would be copied into every row.
_NAMED_SQL = """transform(array(named_struct('names', _names, 'text', {text})), b -> CASE WHEN b.text IS NOT NULL THEN
  array_distinct(flatten(transform(filter({lengths}, n -> n <= length(b.text)),
    n -> filter(transform(sequence(1, length(b.text) - n + 1), i -> substr(b.text, i, n)),
      s -> array_contains(get(b.names, CAST(pmod(xxhash64(s), size(b.names)) AS INT)), s))))) END)[0]"""


def named_in(df: DataFrame, text: str, table: RuleTable, name: str) -> DataFrame:
    """Adds the projects with rules whose name is a substring of the text column."""
    lengths = "CAST(array(" + ", ".join(map(str, table.lengths)) + ") AS array<int>)"
    found = F.expr(_NAMED_SQL.format(text=f"`{text}`", lengths=lengths))
    return df.withColumn("_names", table.names.scalar()).withColumn(name, found).drop("_names")


def matched_wiring(meta: Metadata) -> DataFrame:
    """A2 with the projects whose rules match each project list by substring: found once for each list of the wiring."""
    return named_in(sink_projects(meta), "sink_projects", meta.rule_table(), "list_matches")
