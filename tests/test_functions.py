from pyspark.sql import functions as F

from eventlake.constants import TIME_PATTERNS
from eventlake.functions.text import is_not_blank, java_split
from eventlake.functions.time import day_text, days_between, is_valid_date, parse_wall_clock, wall_clock_to_millis


def test_java_split(spark):
    df = spark.createDataFrame([("a,,b,",), ("",), (",,",), ("a",), (None,)], "s string")
    got = [r[0] for r in df.select(java_split(F.col("s"), ",")).collect()]
    assert got == [["a", "", "b"], [""], [], ["a"], None]


def test_java_split_control_separator(spark):
    df = spark.createDataFrame([("x\u0001y\u0001\u0001",)], "s string")
    assert df.select(java_split(F.col("s"), "\u0001")).first()[0] == ["x", "y"]


def test_is_not_blank(spark):
    df = spark.createDataFrame([(" a ",), ("   ",), ("",), (None,), ("\t\n",)], "s string")
    got = [r[0] for r in df.select(is_not_blank(F.col("s"))).collect()]
    assert got == [True, False, False, False, False]


def test_nine_patterns_in_order(spark):
    texts = [
        "2024-01-02 03:04:05.678", "2024-01-02 03:04:05 678", "2024-01-02 03:04:05.0", "2024-01-02 03:04:05",
        "2024/01/02 03:04:05", "20240102030405", "2024-01-02 03:04", "2024-01-02", "20240102", "02.01.2024",
    ]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    ms = wall_clock_to_millis(parse_wall_clock(F.col("t")), "UTC")
    got = [r[0] for r in df.select(ms).collect()]
    base = 1704164645000  # 2024-01-02 03:04:05 UTC
    assert got == [base + 678, base + 678, base, base, base, base, base - 5000, 1704153600000, 1704153600000, None]
    assert len(TIME_PATTERNS) == 9


def test_zone_and_day(spark):
    df = spark.createDataFrame([("2024-01-01 07:59:59",), ("2024-01-01 08:00:00",)], "t string")
    ms = wall_clock_to_millis(parse_wall_clock(F.col("t")), "Asia/Shanghai")
    rows = df.select(ms.alias("ms"), day_text(ms, "Asia/Shanghai").alias("d"), day_text(F.lit(0), "Asia/Shanghai"))
    got = rows.collect()
    assert got[0][0] == 1704067199000 and got[1][0] == 1704067200000
    assert got[0][1] == "20240101" and got[0][2] == "19700101"


def test_time_independent_of_session_zone(spark):
    df = spark.createDataFrame([("2024-06-01 12:00:00",)], "t string")
    ms = wall_clock_to_millis(parse_wall_clock(F.col("t")), "Asia/Shanghai")
    before = df.select(ms).first()[0]
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        after = df.select(ms).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert before == after == 1717214400000


def test_one_digit_parts(spark):
    texts = ["2024-1-2 3:4:5.678", "2024-1-2 3:4:5 678", "2024-1-2 3:4:5 6", "2024-1-2 3:4:5", "2024/1/2 3:4:5", "2024-1-2 3:4", "2024-1-2", "2024-11-12 13:14:15"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(parse_wall_clock(F.col("t")).cast("string")).collect()]
    assert got[:2] == ["2024-01-02 03:04:05.678"] * 2 and got[3:5] == ["2024-01-02 03:04:05"] * 2
    assert got[5:] == ["2024-01-02 03:04:00", "2024-01-02 00:00:00", "2024-11-12 13:14:15"]


def test_valid_date_and_days_between(spark):
    df = spark.createDataFrame([("2024-02-29",), ("2023-02-29",), ("x",), (None,)], "t string")
    assert [r[0] for r in df.select(is_valid_date(F.col("t"), "yyyy-MM-dd")).collect()] == [True, False, False, False]
    day = 86_400_000
    row = spark.range(1).select(days_between(F.lit(day - 1), F.lit(day), "UTC"), days_between(F.lit(0), F.lit(day - 1), "UTC")).first()
    assert tuple(row) == (1, 0)
