"""Delimited files with header, quotes, lines of the wrong length and values of the wrong type."""

from pyspark.sql import functions as F

from eventlake.operators.extras import ImportConfig, ImportCounts, file_counts, import_files

FIELDS = (("uid", "String"), ("at", "Date"), ("note", "String"), ("n", "Long"), ("ok", "Boolean"))
GOOD = "2024-01-02 03:04:05"


def write(path, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")


def test_counts_and_rows(spark, tmp_path):
    header = "uid;at;note;n;ok"
    write(tmp_path / "in" / "a.csv", header, f'u1;{GOOD};"x;""y""";12;true', "", f";{GOOD};é;1.5;false", "u2;never;z;many;perhaps")
    write(tmp_path / "in" / "b.csv", header, "u3;2024-01-02", f"u4;{GOOD};;;", f"u5;{GOOD};a;1;true;extra")
    config = ImportConfig("p", "ev", FIELDS, "uid", "at", separator=";", header=True)
    got = import_files(spark, f"{tmp_path}/in", config, f"{tmp_path}/out")
    assert got == ImportCounts(read_count=6, process_count=4, invalid_count=2, bad_count=2, typed_out=2)
    again = import_files(spark, f"{tmp_path}/in", config, f"{tmp_path}/out")  # replaces its own output
    assert again == got
    files = {r.source_file.rsplit("/", 1)[1]: tuple(r)[1:] for r in file_counts(spark, f"{tmp_path}/out").collect()}
    assert files == {"a.csv": (3, 3, 2, 0, 2), "b.csv": (3, 1, 0, 2, 0)}
    rows = spark.read.parquet(f"{tmp_path}/out")
    assert sorted(r.bad_line for r in rows.where("outcome = 'bad'").collect()) == ["u3;2024-01-02", f"u5;{GOOD};a;1;true;extra"]
    props = {r.distinct_id: r.p for r in rows.where("outcome = 'event'").select("distinct_id", F.to_json("properties").alias("p")).collect()}
    assert props["u1"] == '{"uid":"u1","at":"' + GOOD + '","note":"x;\\"y\\"","n":12,"ok":true}'
    assert props["u4"] == '{"uid":"u4","at":"' + GOOD + '"}' and '"n"' not in props["u2"] and props[None].count('"uid"') == 0


def test_no_lines(spark, tmp_path):
    write(tmp_path / "in" / "a.csv", "uid,at")
    config = ImportConfig("p", "ev", (("uid", "String"), ("at", "Date")), "uid", "at", header=True)
    assert import_files(spark, f"{tmp_path}/in", config, f"{tmp_path}/out") == ImportCounts()
