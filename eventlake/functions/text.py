"""String column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_not_blank(c: Column) -> Column:
    """Not null and holding at least one non-whitespace character."""
    return c.isNotNull() & c.rlike(r"[^\s\x1C-\x1F]")


def cut(c: Column, n: int = 255) -> Column:
    """First `n` characters."""
    return F.substring(c, 1, n)


def java_split(c: Column, sep: str) -> Column:
    """Split like java.lang.String#split: trailing empty items are dropped.

    "a,,b," -> [a, "", b];  "" -> [""];  ",," -> [].
    """
    lit_sep = sep.replace("\\", "\\\\")
    regex_sep = "".join("\\" + ch if not ch.isalnum() else ch for ch in sep)
    stripped = F.regexp_replace(c, f"({regex_sep})+$", "")
    parts = F.split(stripped, _quote(lit_sep))
    return F.when(c.isNull(), F.lit(None)).when(
        (stripped == "") & (c != ""), F.array().cast("array<string>")
    ).otherwise(parts)


def _quote(sep: str) -> str:
    # F.split takes a regular expression; quote it.
    return "\\Q" + sep + "\\E"
