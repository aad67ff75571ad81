"""Event-time helpers: multi-pattern parsing, epoch millis, day text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventlake.constants import TIME_PATTERNS

_ONE_DIGIT = r"(?<=[-/])\d(?=[-/ ]|$)|(?<= )\d(?=:)|(?<=:)\d(?=[: .]|$)"


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def _shape(pattern: str) -> str:
    """A loose regular expression every text the pattern can read must match;
    it spares the parser (and its exceptions) texts of another shape."""
    out = []
    for ch in pattern:
        out.append(r"\d" if ch.isalpha() else ("\\" + ch if not ch.isalnum() and ch != " " else ch))
    rx = "".join(out)
    # runs of digits may be shorter or longer than the pattern letters
    import re as _re
    rx = _re.sub(r"(\\d)+", lambda m: r"\d+", rx)
    return "^" + rx + "$"


def parse_wall_clock(text: Column, patterns=TIME_PATTERNS) -> Column:
    """Wall-clock TIMESTAMP_NTZ of `text` by the first pattern that reads it whole."""
    t = F.trim(text)
    # one-digit months, days, hours, minutes and seconds get a leading zero (a fraction does not)
    text = F.regexp_replace(text, _ONE_DIGIT, "0$0")
    tries = [
        F.when(t.rlike(_shape(p)), F.try_to_timestamp(text, F.lit(p)).cast("timestamp_ntz"))
        for p in patterns
    ]
    return F.coalesce(*tries)


def wall_clock_to_millis(ntz: Column, zone: str) -> Column:
    """Epoch millis of a wall-clock time in `zone`, independent of the session zone."""
    utc = F.convert_timezone(F.lit(zone), F.lit("UTC"), ntz)
    return F.timestamp_diff("MILLISECOND", _epoch(), utc)


def millis_to_wall_clock(ms: Column, zone: str) -> Column:
    utc = F.timestamp_add("MILLISECOND", ms, _epoch())
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def day_text(ms: Column, zone: str) -> Column:
    """yyyyMMdd of epoch millis in `zone`."""
    return F.date_format(millis_to_wall_clock(ms, zone), "yyyyMMdd")


def day_start_millis(ms: Column, zone: str) -> Column:
    return wall_clock_to_millis(F.date_trunc("day", millis_to_wall_clock(ms, zone)), zone)


def day_end_millis(ms: Column, zone: str) -> Column:
    """Last second of the day, as the reference's end-of-day helper gives it."""
    return day_start_millis(ms, zone) + F.lit(86_399_000)


def second_floor_millis(ms: Column) -> Column:
    return F.floor(ms / 1000) * 1000


def is_valid_date(text: Column, pattern: str) -> Column:
    """Whether `text` can be read whole by the pattern (false for NULL)."""
    return F.coalesce(parse_wall_clock(text, (pattern,)).isNotNull(), F.lit(False))


def days_between(start_ms: Column, end_ms: Column, zone: str) -> Column:
    """Calendar days from one instant to another in `zone`."""
    return F.datediff(millis_to_wall_clock(end_ms, zone), millis_to_wall_clock(start_ms, zone))
