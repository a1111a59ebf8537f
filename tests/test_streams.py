import pytest
from pyspark.sql import functions as F

from hemline.operators import silver
from hemline.sources import files, schemas
from hemline.streaming import jobs, sinks
from tests.test_calendar_and_text import png

HEADER = "external_code,retail,week,year,qty"


def write(folder, name, *lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def run(spark, base):
    jobs.ingest_bronze(spark, "restock", f"{base}/in", f"{base}/bronze", f"{base}/state", timeout=120)
    jobs.refresh_silver(spark, "restock", f"{base}/bronze", f"{base}/silver", f"{base}/state", timeout=120)
    return spark.read.parquet(f"{base}/silver")


def test_two_rounds_and_an_idle_run(spark, tmp_path, rows):
    write(tmp_path / "in", "1.csv", HEADER, "1,3,10,2019,4", "1,3,11,2019,x")
    assert run(spark, tmp_path).count() == 2
    write(tmp_path / "in", "2.csv", HEADER, "2,3,12,2019,6.0")
    write(tmp_path / "in", "notes.txt", "ignored")
    assert run(spark, tmp_path).count() == 3
    out = run(spark, tmp_path)
    assert rows(out, *HEADER.split(",")) == [
        ("1", 3, 10, 2019, 4),
        ("1", 3, 11, 2019, None),
        ("2", 3, 12, 2019, 6),
    ]
    batch = silver.silver_restock(
        files.batch_csv(spark, f"{tmp_path}/in", schemas.RESTOCK, "*.csv")
    )
    assert rows(batch) == rows(out.select(batch.columns))


def test_extra_token_is_rescued(spark, tmp_path):
    write(tmp_path / "in", "1.csv", HEADER, "1,3,10,2019,4,extra", "2,3,10,2019,4")
    frame = files.batch_csv(spark, f"{tmp_path}/in", schemas.RESTOCK).cache()
    assert [r[0] for r in files.rescued_rows(frame).collect()] == ["1,3,10,2019,4,extra"]
    assert [r.external_code for r in files.good_rows(frame).collect()] == ["2"]
    frame.unpersist()


def test_other_header_stops_the_stream(spark, tmp_path):
    write(tmp_path / "in", "1.csv", HEADER, "1,3,10,2019,4")
    run(spark, tmp_path)
    write(tmp_path / "in", "2.csv", "retail,external_code,week,year,qty", "3,1,10,2019,4")
    with pytest.raises(Exception):
        run(spark, tmp_path)


def test_schema_is_kept_between_runs(spark, tmp_path):
    write(tmp_path / "in", "1.csv", "a,b", "1,2")
    path = f"{tmp_path}/schema"
    assert files.load_schema(spark, path) is None
    first = files.tracked_schema(spark, f"{tmp_path}/in", path)
    assert first.names == ["a", "b"]
    write(tmp_path / "in", "0.csv", "x,y,z", "1,2,3")
    assert files.tracked_schema(spark, f"{tmp_path}/in", path) == first


def test_declared_feeds(spark, tmp_path):
    write(tmp_path / "w", "1.csv", ",".join(schemas.WEATHER.names), "Rome,2019-01-01," + ",".join(["1.5"] * 12))
    jobs.ingest_bronze(spark, "weather", f"{tmp_path}/w", f"{tmp_path}/bw", f"{tmp_path}/s", timeout=120)
    row = spark.read.parquet(f"{tmp_path}/bw").first()
    assert (row.locality, row.date, row.rain_mm) == ("Rome", "2019-01-01", 1.5)
    with pytest.raises(ValueError):
        jobs.refresh_silver(spark, "weather", f"{tmp_path}/bw", f"{tmp_path}/x", f"{tmp_path}/s")
    write(tmp_path / "t", "1.csv", ",".join(schemas.TRENDS.names), "2019-05-06," + ",".join(["2"] * 96))
    jobs.ingest_bronze(spark, "gtrends", f"{tmp_path}/t", f"{tmp_path}/bt", f"{tmp_path}/s", timeout=120)
    jobs.refresh_silver(spark, "gtrends", f"{tmp_path}/bt", f"{tmp_path}/st", f"{tmp_path}/s", timeout=120)
    row = spark.read.parquet(f"{tmp_path}/st").first()
    assert (row.year, row.month, row.week_of_year, row.goose) == (2019, 5, 19, 2.0)
    assert len(row) == 100


def test_images_in_nested_folders(spark, tmp_path):
    folder = tmp_path / "img" / "AW17" / "dress"
    folder.mkdir(parents=True)
    (folder / "1.png").write_bytes(png(5, 6))
    (folder / "readme.txt").write_text("no")
    jobs.ingest_bronze(spark, "clothes", f"{tmp_path}/img/*/*/", f"{tmp_path}/b", f"{tmp_path}/s", timeout=120)
    jobs.refresh_silver(spark, "clothes", f"{tmp_path}/b", f"{tmp_path}/v", f"{tmp_path}/s", timeout=120)
    row = spark.read.parquet(f"{tmp_path}/v").first()
    assert (row.category, row.file_name, row.size.width, row.size.height) == ("dress", "1.png", 5, 6)


def test_table_to_table(spark, tmp_path):
    write(tmp_path / "in", "1.csv", HEADER, "1,3,10,2019,4")
    stream = files.stream_csv(spark, f"{tmp_path}/in", schemas.RESTOCK)
    sinks.append_table(stream, "bronze_restock_t", f"{tmp_path}/c", timeout=120)
    for _ in range(2):
        jobs.refresh_silver_table(spark, "restock", "bronze_restock_t", "silver_restock_t", f"{tmp_path}/s")
    assert spark.table("silver_restock_t").count() == 1


def test_replayed_batch_leaves_no_duplicates(spark, tmp_path):
    path = f"{tmp_path}/out"
    sinks.write_batch(spark.range(3), 0, path)
    sinks.write_batch(spark.range(2), 1, path)
    sinks.write_batch(spark.range(3), 0, path)
    assert spark.read.parquet(path).count() == 5


def test_additive_schema(spark, tmp_path):
    path = f"{tmp_path}/out"
    sinks.append_batch(spark.range(1), path)
    sinks.append_batch(spark.range(1).withColumn("x", F.lit("new")), path)
    out = sinks.read_merged(spark, path)
    assert sorted(out.columns) == ["id", "x"] and out.filter("x IS NULL").count() == 1


def test_read_ids(spark, tmp_path):
    write(
        tmp_path, "ids.csv",
        "external_code,retail,season,category,color,fabric,release_date",
        "5198,100,SS19,culottes,grey,linen,2019-05-06",
    )
    assert files.read_ids(spark, f"{tmp_path}/ids.csv").first()[0] == "5198100SS19culottesgreylinen2019-05-06"


def test_old_files_are_read(spark, tmp_path):
    import os
    import time

    write(tmp_path / "in", "1.csv", HEADER, "1,3,10,2019,4")
    assert run(spark, tmp_path).count() == 1
    write(tmp_path / "in", "2.csv", HEADER, "2,3,11,2019,4")
    old = time.time() - 30 * 86_400
    os.utime(tmp_path / "in" / "2.csv", (old, old))
    assert run(spark, tmp_path).count() == 2


def test_a_backlog_comes_in_slices(spark, tmp_path):
    for i in range(5):
        write(tmp_path / "in", f"{i}.csv", HEADER, f"{i},3,10,2019,4")
    stream = files.stream_csv(spark, f"{tmp_path}/in", schemas.RESTOCK, files_per_batch=2)
    seen = []
    sinks.each_batch(stream, lambda batch, i: seen.append(batch.count()), f"{tmp_path}/c", timeout=120)
    assert seen == [2, 2, 1]


def test_headers_may_grow(spark, tmp_path):
    args = (spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/s")
    write(tmp_path / "in", "1.csv", "a,b", "1,2")
    jobs.ingest_growing(*args, timeout=120)
    write(tmp_path / "in", "2.csv", "b,new,a", "5,x,4")
    write(tmp_path / "in", "3.csv", "a,b", "7")
    for _ in range(2):
        jobs.ingest_growing(*args, timeout=120)
    out = sinks.read_merged(spark, f"{tmp_path}/out")
    got = {(r.a, r.b, r.new) for r in out.collect()}
    assert ("1", "2", None) in got and ("4", "5", "x") in got and len(got) == 3


def test_rescued_rows_go_to_quarantine(spark, tmp_path):
    write(tmp_path / "in", "1.csv", HEADER, "1,3,10,2019,4,extra", "2,3,10,2019,4")
    run(spark, tmp_path)
    for _ in range(2):
        jobs.quarantine(spark, "restock", f"{tmp_path}/bronze", f"{tmp_path}/q", f"{tmp_path}/state", timeout=120)
    assert [r[0] for r in spark.read.parquet(f"{tmp_path}/q").collect()] == ["1,3,10,2019,4,extra"]


def test_price_feed(spark, tmp_path):
    head = ",".join(schemas.PRICE.names)
    write(tmp_path / "in", "1.csv", head, "1,3,9.5," + ",".join(["0.1"] * 12))
    jobs.ingest_bronze(spark, "price", f"{tmp_path}/in", f"{tmp_path}/b", f"{tmp_path}/s", timeout=120)
    jobs.refresh_silver(spark, "price", f"{tmp_path}/b", f"{tmp_path}/v", f"{tmp_path}/s", timeout=120)
    assert spark.read.parquet(f"{tmp_path}/v").count() == 12


def test_a_stream_lists_its_files_in_few_tasks(spark, tmp_path):
    from hemline.sources import files
    from hemline.streaming import sinks

    (tmp_path / "in").mkdir()
    for i in range(40):
        (tmp_path / "in" / f"{i}.png").write_bytes(b"x")
    before = spark.conf.get(sinks.LISTING_TASKS)
    seen = []
    sinks.each_batch(
        files.stream_binary(spark, str(tmp_path / "in")),
        lambda batch, i: seen.append((batch.count(), int(spark.conf.get(sinks.LISTING_TASKS)))),
        str(tmp_path / "state"),
    )
    # A task per file reported to the driver before.
    assert seen == [(40, spark.sparkContext.defaultParallelism)]
    assert spark.conf.get(sinks.LISTING_TASKS) == before
