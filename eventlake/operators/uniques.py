"""Unique users per day and month as mergeable counts.

Each user gets a dense number once.  A day is then a set of bitmaps, one for each 32,768
numbers that occur; days merge by OR.  A month, a quarter or any other span is counted from the
stored days: no event is read again, and the counts stay exact.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from eventlake.operators.metadata import Lookup
from eventlake.session import ensure_checkpoint_dir

_ROW_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def user_rows(main: DataFrame) -> DataFrame:
    """(project, date, distinct_id) of track rows with an identity, each once (combined map-side)."""
    rows = main.filter((F.col("type") == "track") & F.col("distinct_id").isNotNull())
    return rows.select("project", "date", "distinct_id").distinct()


def number_users(users: DataFrame, first: int = 1) -> DataFrame:
    """(distinct_id, user_no): different users numbered from `first` without gaps.

    Rows are numbered inside their partitions; the partitions' sizes, a row for each, place them."""
    ensure_checkpoint_dir(users.sparkSession)
    place = F.monotonically_increasing_id()
    rows = users.select(
        "distinct_id", F.shiftright(place, _ROW_BITS).cast("int").alias("_part"),
        place.bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias("_row")).checkpoint()
    sizes = rows.groupBy("_part").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = Lookup.of(sizes.select("_part", before.alias("_before"))).attach(rows, {"_part": "_part"}, F.col("_row"))
    return placed.select("distinct_id", (F.col("_before") + F.col("_row") + first).alias("user_no"))


def day_bitmaps(rows: DataFrame, numbers: DataFrame) -> DataFrame:
    """(project, date, bucket, bitmap) of user rows."""
    numbered = rows.join(numbers, "distinct_id")
    return numbered.groupBy("project", "date", F.bitmap_bucket_number("user_no").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("user_no")).alias("bitmap"))


def unique_counts(bitmaps: DataFrame, *by: str | Column) -> DataFrame:
    """uv per `by`: days are merged by OR inside each bucket, then bits are counted."""
    merged = bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    names = [c for c in merged.columns if c not in ("bucket", "bitmap")]
    return merged.groupBy(*names).agg(F.sum(F.bitmap_count("bitmap")).alias("uv"))


class UniqueUsers:
    """Stored user numbers and day bitmaps under `root`, extended load by load.

    A load that is run again under its id replaces itself; loads are added in the order of
    their ids, one at a time.  A user seen by an earlier load keeps the number."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _read(self, name: str) -> DataFrame | None:
        try:
            return self.spark.read.parquet(f"{self.root}/{name}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def add(self, main: DataFrame, load_id: int) -> None:
        rows = user_rows(main).persist()
        try:
            self._add(rows, load_id)
        finally:
            rows.unpersist()

    def _add(self, rows: DataFrame, load_id: int) -> None:
        known = self._read("users")
        users = rows.select("distinct_id").distinct()
        first = 1
        if known is not None:
            known = known.where(F.col("load_id") < load_id).drop("load_id")
            users = users.join(known, "distinct_id", "left_anti")
            first = (known.agg(F.max("user_no")).first()[0] or 0) + 1
        number_users(users, first).write.mode("overwrite").parquet(f"{self.root}/users/load_id={load_id}")
        numbers = self.spark.read.parquet(f"{self.root}/users").where(F.col("load_id") <= load_id).drop("load_id")
        day_bitmaps(rows, numbers).write.mode("overwrite").parquet(f"{self.root}/days/load_id={load_id}")

    def days(self) -> DataFrame:
        """(project, date, bucket, bitmap); a day may have a row from each load."""
        return self.spark.read.parquet(f"{self.root}/days").drop("load_id")

    def daily(self) -> DataFrame:
        return unique_counts(self.days(), "project", "date")

    def monthly(self) -> DataFrame:
        """Users of a month (yyyyMM), from its days."""
        return unique_counts(self.days(), "project", F.substring("date", 1, 6).alias("month"))
