"""The streaming loader appends each export file exactly once and counts every row."""

from marquee import schemas
from marquee.session import scratch_path
from marquee.sources import files
from marquee.streaming.load import load_documents, read_collection


def test_load_is_exactly_once_and_incremental(spark):
    src, table = (scratch_path(spark, n) for n in ("src", "tbl"))
    rows = [(i, f"m{i}", 2000, float(i), ["Drama"], [1], 1) for i in range(30)]
    df = spark.createDataFrame(rows, schemas.DEN_MOVIES)
    files.write_json(df.filter("id < 10"), src)
    assert load_documents(spark, src, schemas.DEN_MOVIES, table) == 10
    assert load_documents(spark, src, schemas.DEN_MOVIES, table) == 0
    files.write_json(df.filter("id >= 10"), src, mode="append")
    assert load_documents(spark, src, schemas.DEN_MOVIES, table) == 20
    back = read_collection(spark, schemas.DEN_MOVIES, table)
    assert back.schema.fieldNames() == schemas.DEN_MOVIES.fieldNames()
    assert back.count() == 30 and back.select("id").distinct().count() == 30


def test_count_is_exact_for_many_batches(spark):
    src, table = (scratch_path(spark, n) for n in ("src", "tbl"))
    df = spark.createDataFrame([(i, "m", 2000, 1.0, [], [], 0) for i in range(110)], schemas.DEN_MOVIES)
    files.write_json(df.repartition(110, "id"), src)
    n_files = len(spark.read.json(src).inputFiles())
    assert load_documents(spark, src, schemas.DEN_MOVIES, table, max_files_per_batch=1) == 110
    assert read_collection(spark, schemas.DEN_MOVIES, table).count() == 110 and n_files > 60
