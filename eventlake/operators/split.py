"""Record processors (P10-P14): split a decoded record into parts, read named fields.

A processor is a split rule plus the JSON field names it reads:
  uniLogPlatformEvent / corpBankNewEvent: a JSON array is split into its
      elements (D4: the reference's object cast made this branch unreachable;
      we split), any other record is one part.
  corpBankOldEvent: the text field LOG is cut at its first '[' and parsed as a
      JSON array; every element is a part.  No LOG, no '[' or a broken array
      gives no part (D17), which goes to the invalid output (P14).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake import constants as C
from eventlake.functions.json import array_elements, entry_text, last_entry, object_entries

ROLES = ("app_version", "login_id", "device_id", "event_name", "event_time", "project")


def _empty() -> Column:
    return F.array().cast("array<string>")


def log_parts(body: Column, entries: Column | None = None) -> Column:
    """Parts of the LOG text field; `entries`: the body's, where they are at hand."""
    def cut(log_text: Column) -> Column:
        pos = F.instr(log_text, "[")
        parsed = F.from_json(F.substr(log_text, pos), "array<string>")
        return F.when(log_text.isNull() | (pos == 0), _empty()).otherwise(F.coalesce(parsed, _empty()))

    # each step is bound once: written out, the body would be parsed for every mention of the text
    entry = last_entry(object_entries(body) if entries is None else entries, C.LOG_FIELD)
    return F.transform(F.transform(F.array(entry), entry_text), cut)[0]


def record_parts(body: Column) -> Column:
    """Array elements, or the record itself."""
    elements = array_elements(body)
    return F.when(elements.isNotNull(), elements).otherwise(F.array(body))


@dataclass(frozen=True)
class Processor:
    """JSON field of each role, and how a body becomes parts (None: `record_parts`)."""

    fields: dict
    parts: Callable[[Column], Column] | None = None


PROCESSORS: dict[str, Processor] = {
    name: Processor(fields, log_parts if name == "corpBankOldEvent" else None)
    for name, fields in C.PROCESSOR_FIELDS.items()
}


def register_processor(name: str, fields: dict, parts: Callable[[Column], Column] | None = None) -> None:
    """Make a processor available to routes (§2.11).  `fields` maps the roles of the
    built-in processors to JSON field names (a missing role reads nothing)."""
    PROCESSORS[name] = Processor({**dict.fromkeys(ROLES), **fields}, parts)


def normalize_processor(name: Column) -> Column:
    return F.when(name.isin(list(PROCESSORS)), name).otherwise(F.lit(C.DEFAULT_PROCESSOR))


def split_parts(decoded: DataFrame) -> DataFrame:
    """One row per part (posexplode_outer keeps records without parts).

    Adds n_parts, part_index (NULL for records without parts) and part_text.
    """
    proc = normalize_processor(F.col("processor"))
    body = F.col("body_text")
    parts = F.when(F.col("is_null") | F.col("decode_error").isNotNull(), F.lit(None).cast("array<string>"))
    own = [name for name, p in PROCESSORS.items() if p.parts is not None]
    for name in own:
        make = PROCESSORS[name].parts
        parts = parts.when(proc == name, make(body, F.col("body_entries")) if make is log_parts else make(body))
    parts = parts.otherwise(record_parts(body))
    whole = ~proc.isin(own) & F.col("body_entries").isNotNull()
    df = decoded.withColumn("processor", proc).withColumn("_parts", parts).withColumn("_whole", whole)
    df = df.withColumn("n_parts", F.coalesce(F.size("_parts"), F.lit(0)).cast("int"))
    df = df.select("*", F.posexplode_outer("_parts").alias("part_index", "part_text")).drop("_parts")
    # A record that is itself the one part keeps the entries parsed while decoding.
    entries = F.when(F.col("_whole"), F.col("body_entries")).otherwise(object_entries(F.col("part_text")))
    return df.withColumn("entries", entries).drop("_whole", "body_entries")


# Text of a JSON value as a node gives it: strings unquoted, numbers and booleans
# as written, containers '', JSON null (whose raw text is NULL) NULL.
ENTRY_TEXT_SQL = """CASE WHEN startswith(ltrim({e}.raw), '{{') OR startswith(ltrim({e}.raw), '[')
  THEN CASE WHEN schema_of_variant({e}.v) = 'STRING' THEN {e}.raw ELSE '' END ELSE {e}.raw END"""


def _texts_sql() -> str:
    """Texts of the processor's fields in the order of ROLES; of a key's entries the last one counts, found by its place from the end."""
    def names(p: Processor) -> str:
        return ", ".join("CAST(NULL AS STRING)" if p.fields[r] is None else f"'{p.fields[r]}'" for r in ROLES)

    fields = f"CASE processor {' '.join(f"WHEN '{name}' THEN array({names(p)})" for name, p in PROCESSORS.items())} END"
    found = (f"transform(array(reverse(entries.k)), keys -> transform({fields}, "
             "f -> try_element_at(entries, CAST(-nullif(array_position(keys, f), 0) AS INT))))[0]")
    return f"transform({found}, e -> {ENTRY_TEXT_SQL.format(e='e')})"


def extract_fields(parts: DataFrame) -> DataFrame:
    """Named fields of each part as text (missing fields NULL); the part's
    entries are kept as the main object for the property flatten."""
    df = parts.withColumn("_texts", F.expr(_texts_sql()))
    return df.withColumns({f"src_{r}": F.get("_texts", F.lit(i)) for i, r in enumerate(ROLES)}).drop("_texts")
