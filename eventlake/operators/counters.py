"""Counter totals (A6, J6): previous totals + the new batch's counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COUNTER_KEY = ["server", "consumer_group", "project", "topic", "stage"]


def merge_counters(old: DataFrame, delta: DataFrame) -> DataFrame:
    """Full outer join on the five-column key; total = old + delta."""
    o = old.select(*COUNTER_KEY, F.col("cnt").alias("_old"))
    d = delta.select(*COUNTER_KEY, F.col("cnt").alias("_delta"))
    j = o.join(d, COUNTER_KEY, "full_outer")
    total = F.coalesce(F.col("_old"), F.lit(0)) + F.coalesce(F.col("_delta"), F.lit(0))
    return j.select(*COUNTER_KEY, total.cast("bigint").alias("cnt"))
