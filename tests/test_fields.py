"""CSV files read field by field."""

import csv
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hemline.sources import fields, files
from hemline.streaming import jobs, sinks

SCHEMA = T.StructType().add("code", T.StringType()).add("qty", T.IntegerType()).add("day", T.DateType())


def test_fields_equal_a_csv_reader(spark):
    rnd = random.Random(1)
    parts = ["a", "é", ",", '"', " ", "x y", "1", "'", ";"]
    rows = [["".join(rnd.choice(parts) for _ in range(rnd.randrange(5))) for _ in range(rnd.randrange(1, 6))] for _ in range(400)]

    def quoted(v):
        return '"' + v.replace('"', '""') + '"' if any(c in v for c in ',"') or rnd.random() < 0.2 else v

    lines = [",".join(map(quoted, r)) for r in rows]
    assert [next(csv.reader([x])) if x else [""] for x in lines] == rows
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, line string")
    got = {r.i: r.f for r in df.select("i", fields.split_fields(F.col("line")).alias("f")).collect()}
    for i, r in enumerate(rows):
        assert [x or "" for x in got[i]] == r, lines[i]
    guarded = spark.createDataFrame([('"a\\"b, c",,"",d',)], "line string").select(fields.split_fields(F.col("line"))).first()[0]
    assert guarded == ['a"b, c', None, "", "d"]


def write(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)


def test_each_file_by_its_own_header(spark, tmp_path):
    feed = tmp_path / "feed"
    write(feed, "1.csv", "code,qty,day\na,1,2020-01-02\nb,x1,2020-01-03\ncode,qty,day\n")
    write(feed, "2.csv", "day,extra,code\n2020-02-30,e,c\n,,d\n\n2020-01-05\n2020-01-06,f,g,h,i\n")
    write(feed, "3.csv", "qty,qty,\n1,2,3\n")
    write(feed, "4.csv", "")
    write(feed, "5.csv", "code,qty,day\n")
    parsed = fields.fields_by_header(fields.batch_lines(spark, str(feed), "*.csv"))
    assert fields.column_names(parsed) == ["_c2", "_c3", "_c4", "code", "day", "extra", "qty", "qty_1"]
    typed = fields.typed_rows(parsed, SCHEMA)
    got = sorted(((r._file[-5:], r.code, r.qty, str(r.day), r._rescued) for r in typed.collect()), key=str)
    assert got == sorted(
        [
            ("1.csv", "a", 1, "2020-01-02", None),
            ("1.csv", "b", None, "2020-01-03", {"qty": "x1"}),
            ("1.csv", "code", None, "None", {"qty": "qty", "day": "day"}),
            ("2.csv", "c", None, "None", {"day": "2020-02-30", "extra": "e"}),
            ("2.csv", "d", None, "None", None),
            ("2.csv", None, None, "2020-01-05", None),
            ("2.csv", "g", None, "2020-01-06", {"extra": "f", "_c3": "h", "_c4": "i"}),
            ("3.csv", None, 1, "None", {"qty_1": "2", "_c2": "3"}),
        ],
        key=str,
    )
    assert {(r.field, r.value) for r in fields.rescued_fields(typed).filter("field = 'extra'").collect()} == {("extra", "e"), ("extra", "f")}
    assert fields.fitting_rows(typed).columns == SCHEMA.names and fields.fitting_rows(typed).count() == 3


def test_a_file_of_many_splits_has_one_header(spark, tmp_path):
    write(tmp_path / "feed", "1.csv", "code,qty,day\n" + "".join(f"c{i},{i},2020-01-01\n" for i in range(20000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        lines = fields.batch_lines(spark, str(tmp_path / "feed"))
        assert lines.rdd.getNumPartitions() > 8
        out = fields.typed_rows(fields.fields_by_header(lines), SCHEMA).agg(F.sum("qty"), F.count("*"), F.count("_rescued")).first()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert tuple(out) == (sum(range(20000)), 20000, 0)


def test_a_growing_feed_without_the_driver(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "first_line", lambda *a: pytest.fail("the driver opened a file"))
    feed = tmp_path / "feed"

    def run():
        jobs.ingest_fields(spark, str(feed), f"{tmp_path}/bronze", f"{tmp_path}/state", SCHEMA, timeout=300)
        return sinks.read_merged(spark, f"{tmp_path}/bronze")

    for i in range(60):
        write(feed, f"a{i}.csv", f"code,qty,day\nk{i},{i},2020-01-01\n")
    assert run().count() == 60
    for i in range(60):
        write(feed, f"b{i}.csv", f"colour,code,qty\nred,m{i},{'?' if i % 3 == 0 else i}\n")
    grown = run()
    assert grown.count() == 120 and grown.filter("colour = 'red'").count() == 60
    assert fields.rescued_fields(grown).select("field", "value").distinct().collect() == [("qty", "?")]
    assert fields.rescued_fields(grown).select("file").distinct().count() == 20
    assert run().count() == 120
