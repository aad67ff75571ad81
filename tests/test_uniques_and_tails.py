"""Mergeable unique users (E2), exact last rows (F5) and positions from written JSON."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from eventlake.functions.json import at_pointer, pointer_path
from eventlake.operators import positions as P
from eventlake.operators.extras import daily_unique_users
from eventlake.operators.uniques import UniqueUsers, number_users

MAIN = "project string, type string, date string, distinct_id string, extra string"


def main_rows(spark, rnd, n):
    users = [f"u{i}" for i in range(n // 3)] + ["", "é", " u1"]
    rows = [(rnd.choice(["a", "b", None]), rnd.choice(["track", "track_signup"]), rnd.choice(["20240131", "20240201", "20240229", "invalid date"]),
             rnd.choice([*users, None, "hot", "hot"]), "x") for _ in range(n)]
    return spark.createDataFrame(rows, MAIN), rows


def brute(rows, cut):
    seen = defaultdict(set)
    for project, kind, date, user, _ in rows:
        if kind == "track" and user is not None:
            seen[project, date[:cut] if cut else date].add(user)
    return sorted(((str(p), d, len(u)) for (p, d), u in seen.items()))


def result(df):
    return sorted((str(r[0]), r[1], r[2]) for r in df.collect())


def test_months_merge_from_days(spark, tmp_path):
    rnd = random.Random(2)
    store, all_rows = UniqueUsers(spark, str(tmp_path)), []
    for load in range(3):
        df, rows = main_rows(spark, rnd, 700)
        all_rows += rows
        store.add(df, load)
    store.add(df, 2)  # a load that runs again replaces itself
    assert result(store.monthly()) == brute(all_rows, 6) and result(store.daily()) == brute(all_rows, None)
    everything = spark.createDataFrame(all_rows, MAIN)
    assert result(store.daily()) == result(daily_unique_users(everything))
    users = spark.read.parquet(f"{tmp_path}/users")
    numbers = sorted(r.user_no for r in users.collect())
    assert numbers == list(range(1, len(numbers) + 1))  # dense, each user once over all loads
    assert users.select("distinct_id").distinct().count() == len(numbers)


def test_numbers_are_dense_over_partitions(spark):
    users = spark.range(70_000).select(F.concat(F.lit("u"), "id").alias("distinct_id")).repartition(7)
    got = number_users(users, 5).agg(F.min("user_no"), F.max("user_no"), F.countDistinct("user_no")).first()
    assert tuple(got) == (5, 70_004, 70_000)


def test_no_users(spark, tmp_path):
    store = UniqueUsers(spark, str(tmp_path))
    store.add(spark.createDataFrame([], MAIN), 0)
    assert store.monthly().collect() == [] and store.daily().collect() == []
    store.add(spark.createDataFrame([("a", "track", "20240101", "u", "x")], MAIN), 1)
    assert result(store.monthly()) == [("a", "202401", 1)]


@pytest.mark.parametrize(("n", "bins"), [(1, 2), (7, 3), (100, 1024), (5000, 16), (0, 8)])
def test_last_rows_with_gaps(spark, n, bins):
    rnd = random.Random(n)
    rows = [(p, o, "x") for p, size, top in ((0, 900, 1 << 40), (1, 40, 60), (2, 1, 5), (7, 300, 301)) for o in rnd.sample(range(top), size)]
    rows += [(None, 3, "x"), (1, None, "x")]
    sink = spark.createDataFrame(rows, "sink_partition int, sink_offset bigint, _slot string").drop("_slot")
    want = []
    for p in (0, 1, 2, 7):
        want += [(p, o) for o in sorted((r[1] for r in rows if r[0] == p and r[1] is not None), reverse=True)[:n]]
    assert sorted(map(tuple, P.last_rows(sink, n, bins=bins).collect())) == sorted(want)


def test_last_rows_keep_equal_offsets(spark):
    sink = spark.createDataFrame([(0, o) for o in (1, 5, 5, 5, 9)], "sink_partition int, sink_offset bigint")
    assert sorted(r[1] for r in P.last_rows(sink, 2).collect()) == [5, 5, 5, 9]
    assert P.last_rows(sink.limit(0), 3).collect() == []


def test_positions_from_json(spark):
    good = '{"time":1,"properties":{"SACONSUMERSERVER":"s","SACONSUMERTOPIC":"t","SACONSUMERPARTITION":3,"SACONSUMEROFFSET":"%s"}}'
    values = [good % 7, good % 12, good % "12x", good % 90071992547409931, good.replace('"t"', '" "') % 99, "{", None, "[]", "3", '{"properties":null}']
    sink = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "sink_offset bigint, value string")
    assert P.json_positions(sink).collect() == [("s", "t", 3, 90071992547409931)]
    reasons = {r.sink_offset: r.unreadable for r in P.json_lineage(sink).collect()}
    assert [reasons[i] for i in range(10)] == [None, None, "no position", None, "no position", "no JSON", "no JSON", "no position", "no position", "no position"]


def test_pointers(spark):
    assert pointer_path("/a/b~1c/0") == "$['a']['b/c'][0]"
    v = spark.sql("""SELECT parse_json('{"a":{"b/c":[5,"x"],"0":"zero"},"n~t":{"2":7}}') AS v""")
    got = v.select(at_pointer(F.col("v"), "/a/b~1c/0", "int"), at_pointer(F.col("v"), "/a/0"), at_pointer(F.col("v"), "/n~0t/2", "int"), at_pointer(F.col("v"), "/none")).first()
    assert tuple(got) == (5, "zero", 7, None)
