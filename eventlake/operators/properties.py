"""Properties (P15-P17, P23-P26): flatten, rename and cast by rule, overlay,
drop empties, and build the `properties` map.

Flatten semantics (per key, in document order; a later key wins):
  * the key is lower-cased;
  * a key with a rule is renamed and cast by the rule; an object under such a
    key is dropped (nothing is descended);
  * an object, or text that parses to an object, is descended into (no prefix);
  * an array without a rule is dropped; other values keep their JSON type.

The walk is row-local: one fold over `array<struct<k, v, t>>` items, where `t`
holds the text of an object still to be descended.  Each step opens one level
and the fold ends when nothing is pending; its length is bounded by the number
of braces in the part's text, so no depth is ever cut off.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake import constants as C
from eventlake.config import PipelineConfig
from eventlake.functions.text import is_not_blank
from eventlake.operators.metadata import RuleTable, named_in

ITEM_TYPE = "struct<k:string,v:variant,t:string>"

OVERLAY_KEYS = (
    C.PROP_APP_VERSION, C.PROP_DEVICE_ID, C.PROP_EVENT_NAME, C.PROP_LOGIN_ID, C.PROP_IS_LOGIN_ID,
    C.PROP_RECORD_KEY, C.PROP_DATE, C.PROP_SERVER, C.PROP_GROUP, C.PROP_TOPIC, C.PROP_PARTITION,
    C.PROP_OFFSET,
)
OVERLAY_SQL = ", ".join(f"'{k}'" for k in OVERLAY_KEYS)

# The walk is written as SQL text: one parse in the JVM per level instead of
# thousands of client calls building the same nested lambdas.

# Kind of a VARIANT by the first word of its schema; all other types are numbers.
KIND_SQL = """coalesce(try_element_at(map('OBJECT', 'OBJECT', 'ARRAY', 'ARRAY', 'STRING', 'STRING', 'BOOLEAN', 'BOOLEAN', 'VOID', 'NULL',
  'TINYINT', 'INTEGER', 'SMALLINT', 'INTEGER', 'INT', 'INTEGER', 'BIGINT', 'INTEGER'), substring_index(schema_of_variant({v}), '<', 1)), 'NUMBER')"""

# P17 with D13 fixed: NUMBER reads numbers and numeric text of any length (a JSON
# number keeps its digits; what DECIMAL cannot hold is read as a double); BOOL reads a JSON
# node as a boolean; STRING/DATETIME give the value's text (JSON null stays
# NULL); LIST keeps arrays without object elements; unknown codes give NULL.
CAST_SQL = """CASE
  WHEN {t} = 0 THEN CASE WHEN {kind} IN ('INTEGER', 'NUMBER') THEN {v}
    WHEN {kind} = 'STRING' THEN coalesce(
      CASE WHEN trim({raw}) RLIKE '^-?(0|[1-9][0-9]*)([.][0-9]+)?$' THEN try_parse_json(trim({raw})) END,
      CAST(try_cast(trim({raw}) AS DECIMAL(38,18)) AS VARIANT), CAST(try_cast(trim({raw}) AS DOUBLE) AS VARIANT)) END
  WHEN {t} = 1 THEN CASE WHEN {kind} = 'BOOLEAN' THEN {v}
    WHEN {kind} = 'INTEGER' THEN CAST(try_variant_get({v}, '$', 'bigint') <> 0 AS VARIANT)
    WHEN {kind} = 'STRING' THEN CAST(trim({raw}) = 'true' AS VARIANT) ELSE CAST(false AS VARIANT) END
  WHEN {t} IN (2, 3) THEN CASE WHEN {kind} = 'NULL' THEN CAST(NULL AS VARIANT)
    WHEN {kind} IN ('OBJECT', 'ARRAY') OR {raw} = '' THEN CAST(NULL AS VARIANT) ELSE CAST({raw} AS VARIANT) END
  WHEN {t} = 4 THEN CASE WHEN {kind} = 'ARRAY' AND size(try_variant_get({v}, '$', 'array<variant>')) > 0 AND forall(try_variant_get({v}, '$', 'array<variant>'),
    el -> NOT startswith(schema_of_variant(el), 'OBJECT')) THEN {v} END
  END"""

ITEM_NULL = "named_struct('k', CAST(NULL AS STRING), 'v', CAST(NULL AS VARIANT), 't', CAST(NULL AS STRING))"


#: The place of key `{key}` of project p in the hash table `b.rules`.
PLACE_SQL = "get(b.rules, CAST(pmod(xxhash64(p, {key}), size(b.rules)) AS INT))"
#: Whether the places of a key hold any rule (most are empty), and its rule for the row's own projects `b.projects`: of several the
#: last one in rule order wins (`rule_order` is the first field of a rule).
MAY_RULE_SQL = f"exists(b.projects, p -> size({PLACE_SQL}) > 0)"
RULE_SQL = f"array_max(flatten(transform(b.projects, p -> filter({PLACE_SQL}, r -> r.key = {{key}} AND r.project = p))))"

# A value's text and its VARIANT; the text of an object begins with '{', that of an array with '['.  An empty value (NULL, JSON
# null, '', an array without elements) becomes NULL here, so that no later step looks into a VARIANT again.
KEEP_SQL = "CASE WHEN {raw} <> '' THEN {v} END"


def item_sql(key: str, raw: str, v: str) -> str:
    """One entry -> item: ruled / descend / drop / keep.  Only a ruled entry asks for its kind."""
    found = f"filter(array({RULE_SQL.format(key=key)}), r -> r IS NOT NULL)"
    kinds = f"transform({found}, r -> named_struct('type', r.type, 'out', r.out, 'kind', {KIND_SQL.format(v=v)}))"
    cast = CAST_SQL.format(t="r.type", kind="r.kind", v=v, raw=raw)
    ruled = (f"get(transform({kinds}, r -> CASE WHEN r.kind = 'OBJECT' THEN {ITEM_NULL} "
             f"ELSE named_struct('k', r.out, 'v', {cast}, 't', CAST(NULL AS STRING)) END), 0)")
    return f"""coalesce(CASE WHEN {MAY_RULE_SQL.format(key=key)} THEN {ruled} END, CASE
      WHEN startswith(ltrim({raw}), '{{') AND {v} IS NOT NULL THEN named_struct('k', {key}, 'v', {v}, 't', {raw})
      WHEN startswith(ltrim({raw}), '[') AND startswith(schema_of_variant({v}), 'ARRAY') THEN {ITEM_NULL}
      ELSE named_struct('k', {key}, 'v', {KEEP_SQL.format(raw=raw, v=v)}, 't', CAST(NULL AS STRING)) END)"""


def opened_sql(text: str) -> str:
    """The items of an object's text, made in one pass over its entries; NULL for text that holds no object."""
    return (f"CASE WHEN startswith(ltrim({text}), '{{') THEN zip_with(map_entries(from_json({text}, 'map<string,string>')), "
            f"map_values(from_json({text}, 'map<string,variant>')), (e, v) -> {item_sql('lower(e.key)', 'e.value', 'v')}) END")


def walk_sql(rules: str) -> str:
    """The whole walk.  A step replaces pending items by their object's items; text
    that turns out to hold no object is kept as it is."""
    keep = "array(named_struct('k', it.k, 'v', it.v, 't', CAST(NULL AS STRING)))"
    level = f"flatten(transform(acc.items, it -> CASE WHEN it.t IS NULL THEN array(it) ELSE coalesce({opened_sql('it.t')}, {keep}) END))"
    state = f"struct<items:array<{ITEM_TYPE}>,pending:boolean>"
    # entries is the outermost level in the form of one pending step: its items are made by the same expression
    steps = "sequence(0, greatest(regexp_count(part_text, '\\\\{|[uU]007[bB]'), 0))"
    first = f"coalesce(transform(entries, e -> {item_sql('lower(e.k)', 'e.raw', 'e.v')}), CAST(array() AS array<{ITEM_TYPE}>))"
    made = "transform(array({items}), x -> named_struct('items', x, 'pending', exists(x, it -> it.t IS NOT NULL)))[0]"
    walk = (
        f"aggregate({steps}, CAST(NULL AS {state}), (acc, i) -> CASE "
        f"WHEN acc IS NULL THEN {made.format(items=first)} "
        f"WHEN acc.pending THEN {made.format(items=level)} ELSE acc END, acc -> "
        f"transform(filter(acc.items, it -> it.k NOT IN ({OVERLAY_SQL}) AND it.t IS NULL), it -> named_struct('k', it.k, 'v', it.v)))"
    )
    # rules and projects are read here only, so that the optimizer computes them in the walk's own projection: as
    # columns of a projection below the rules would be copied into every row
    return f"transform(array(named_struct('rules', {rules}, 'projects', _projects)), b -> {walk})[0]"


def flatten_properties(df: DataFrame, rules: RuleTable, config: PipelineConfig) -> DataFrame:
    """Adds flat_items: array<struct<k, v>> in walk order (an empty value is NULL, keys of the overlay are
    left out), and signup_items: the same for the events that may be sign-ups, NULL for others, so
    that an output without properties walks those few rows only.

    Needs columns entries (the part's object entries), part_text, tokens, src_project, and with
    substring matching `list_matches` of the wiring.  A property's rule is looked up by
    (project, key) in a hash table: its cost does not grow with the rules.
    """
    if config.rule_match == "contains":
        df = named_in(df.withColumn("_own", F.when(is_not_blank(F.col("src_project")), F.col("src_project"))), "_own", rules, "_own_matches")
        df = df.withColumn("_projects", F.coalesce("_own_matches", "list_matches")).drop("_own", "_own_matches", "list_matches")
    else:
        df = df.withColumn("_projects", F.col("tokens"))
    # the rules are one value, bound once to each of the two walks: a column read twice would be copied into every row
    value = rules.rules.scalar()
    named = F.col("src_event_name").isin(*C.SIGNUP_EVENTS)
    df = df.withColumns({"_rules_all": value, "_rules_signup": value}).withColumns({
        "flat_items": F.expr(walk_sql("_rules_all")), "signup_items": F.when(named, F.expr(walk_sql("_rules_signup")))})
    return df.drop("_rules_all", "_rules_signup", "_projects")


def _kv(k: str, v: Column, empty: Column) -> Column:
    """The property as an array of one item, of none where its value is empty."""
    return F.when(~empty, F.array(F.struct(F.lit(k).alias("k"), v.cast("variant").alias("v")))).otherwise(
        F.array().cast("array<struct<k:string,v:variant>>"))


def overlay_items(config: PipelineConfig) -> list[Column]:
    """Fixed properties and lineage, in the order they are put; each is an array of at most one item."""
    text = {
        C.PROP_APP_VERSION: "src_app_version", C.PROP_DEVICE_ID: "src_device_id", C.PROP_EVENT_NAME: "src_event_name",
        C.PROP_LOGIN_ID: "src_login_id", C.PROP_RECORD_KEY: "record_key", C.PROP_DATE: "date", C.PROP_SERVER: "server",
        C.PROP_GROUP: "consumer_group", C.PROP_TOPIC: "topic",
    }
    typed = {C.PROP_IS_LOGIN_ID: F.col("is_login_id"), C.PROP_PARTITION: F.col("partition"), C.PROP_OFFSET: F.col("offset").cast("string")}
    return [_kv(k, typed[k], typed[k].isNull()) if k in typed else _kv(k, F.col(text[k]), F.coalesce(F.col(text[k]) == "", F.lit(True)))
            for k in OVERLAY_KEYS]


def last_wins(items: str) -> str:
    """Keep the last item of every key, in order: where a key comes twice, (key, place) pairs are sorted once."""
    pairs = f"sort_array(transform({items}, (x, i) -> named_struct('k', x.k, 'i', i)))"
    ends = "filter(p, (x, i) -> i = size(p) - 1 OR p[i + 1].k <> x.k)"
    return (f"CASE WHEN size(array_distinct({items}.k)) = size({items}) THEN {items} ELSE "
            f"transform(sort_array(transform(array({pairs}), p -> transform({ends}, x -> x.i))[0]), j -> {items}[j]) END")


def assemble_properties(df: DataFrame, config: PipelineConfig) -> DataFrame:
    """Flat items (last key wins) and the overlay, empties dropped
    -> map<string, variant>.  Overlay keys are distinct literals that the walk leaves out (a NULL
    overlay value removes the key), so only flat items need the last-wins pass."""
    flat = F.filter(F.expr(last_wins("flat_items")), lambda x: x.v.isNotNull())
    return df.withColumn("properties", F.map_from_entries(F.concat(flat, *overlay_items(config))))
