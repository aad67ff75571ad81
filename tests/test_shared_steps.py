"""Tasks by the size of the input, and bodies that are parsed once."""

import json

from pyspark.sql import functions as F

from eventlake.config import PipelineConfig
from eventlake.functions.json import object_entries
from eventlake.operators.properties import walk_sql
from eventlake.operators.split import log_parts
from eventlake.plans import catalog
from eventlake.plans.pipeline import transform
from tests.conftest import raw_rows


def test_log_text_is_parsed_once(spark):
    bodies = ['{"LOG":"x[{\\"a\\":1},{\\"a\\":2}]"}', '{"LOG":"no array"}', '{"LOG":"x[broken"}', '{"LOG":null}', '{"LOG":["x["]}', '{"A":1}',
              '{"LOG":"[]","LOG":"y[3]"}', "[1]", None]
    df = spark.createDataFrame([(k, b) for k, b in enumerate(bodies)], "k int, body string").withColumn("e", object_entries(F.col("body")))
    want = [['{"a":1}', '{"a":2}'], [], [], [], [], [], ["3"], [], []]
    for made in (log_parts(F.col("body")), log_parts(F.col("body"), F.col("e"))):
        assert [r.p for r in df.select("k", made.alias("p")).orderBy("k").collect()] == want
    plan = spark.createDataFrame([], "body string").select(log_parts(F.col("body")))._jdf.queryExecution().analyzed().toString()
    assert plan.count("from_json(") <= 4  # was 58: one for each mention of the text


def test_tasks_grow_with_the_table(spark, tmp_path, monkeypatch):
    spark.range(95).write.parquet(f"{tmp_path}/events.parquet")
    spark.range(3).write.parquet(f"{tmp_path}/orders.parquet")
    cores = spark.sparkContext.defaultParallelism
    monkeypatch.setattr(catalog, "ROWS_PER_TASK", 1)
    assert catalog._config(spark, str(tmp_path)).input_partitions == max(cores, 95)
    assert catalog._config(spark, str(tmp_path), "orders").input_partitions == max(cores, 3)
    monkeypatch.setattr(catalog, "ROWS_PER_TASK", 1000)
    assert catalog._config(spark, str(tmp_path)).input_partitions == cores


def _parts(spark, bodies, rules=(), config=None, projects="p1"):
    from tests.test_properties import _meta

    return transform(raw_rows(spark, bodies), _meta(spark, rules, projects), config or PipelineConfig())


def test_rules_are_no_column_of_a_lower_projection(spark):
    rules = [(1, "p1", "v", "v_out", "2", 1)]
    parts = _parts(spark, ['{"EventID":"view","project":"p10","v":1}'], rules, PipelineConfig(rule_match="contains"))
    plan = parts.select("offset", F.map_keys("properties").alias("k"))._jdf.queryExecution().optimizedPlan().toString()
    with_rules = [x for x in plan.split("\n") if "scalar-subquery" in x and "Project" in x]
    assert with_rules and all("aggregate(" in x for x in with_rules)  # was: one copy of all rules in every row


def test_an_entry_takes_one_pass(spark):
    walk = walk_sql("r")
    assert walk.count("arrays_zip(") == 0 and walk.count("zip_with(") == 1
    assert walk.count("transform(entries") == 1  # was three passes over the entries, each with a struct for every entry


def test_empty_values_and_the_last_of_a_key(spark):
    rules = [(1, "p1", "s", "s_out", "2", 1), (2, "p1", "l", "l_out", "4", 1), (3, "p1", "o", None, "2", 1)]
    bodies = ['{"a":1,"A":""}', '{"a":"","A":1}', '{"a":1,"A":null}', '{"a":{},"b":"{}","c":"{bad","d":"[]","e":[]}',
              '{"s":"","l":[]}', '{"s":null,"l":[1]}', '{"s":[1],"l":[[]],"o":5}', '{"a":2,"x":{"a":""},"y":{"a":3}}',
              '{"AppVersion":"","$app_version":"mine","DeviceID":null}', '{"AppVersion":"1","AppVersion":{"z":1}}']
    got = _parts(spark, bodies, rules).orderBy("offset").select(F.to_json("properties").alias("p")).collect()
    own = [{k: v for k, v in json.loads(r.p).items() if k in ("a", "b", "c", "d", "e", "s", "s_out", "l", "l_out", "o", "z", "$app_version")}
           for r in got]
    assert own == [{}, {"a": 1}, {}, {"c": "{bad", "d": "[]"}, {}, {"l_out": [1]}, {"l_out": [[]]}, {"a": 3}, {}, {"z": 1}]
