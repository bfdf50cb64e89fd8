"""Jobs whose tasks stay the same size: partitions and buckets grow with the line items."""

import glob
import re

import pytest
from pyspark.sql import functions as F

from marquee.plans import jobs, registry
from marquee.sources.testdata import Catalog

from test_plans import plan

LINES, ORDERS = 3000, 1000


@pytest.fixture
def sf_dir(spark, tmp_path):
    i = F.col("id")
    orders = spark.range(ORDERS).select(
        i.alias("o_orderkey"), (i % 90).alias("o_custkey"), ((i * 7919) % 500_000).cast("double").alias("o_totalprice"),
        F.expr("date_add(date'1994-01-01', cast(id as int))").alias("o_orderdate"))
    lines = spark.range(LINES).select(
        F.pmod(F.xxhash64("id"), F.lit(ORDERS)).alias("l_orderkey"), (i % 40).alias("l_partkey"),
        (i % 70).alias("l_suppkey"), (i % 7).alias("l_linenumber"))
    part = spark.range(40).select(i.alias("p_partkey"), F.element_at(
        F.array(F.lit("PROMO"), F.lit("ECONOMY"), F.lit("SMALL")), (i % 3 + 1).cast("int")).alias("p_type"))
    people = lambda n, key, name, text: spark.range(n).select(
        i.alias(key), F.format_string(f"{text}#%09d", i).alias(name))
    for name, df in (("orders", orders), ("lineitem", lines), ("part", part),
                     ("customer", people(90, "c_custkey", "c_name", "Customer")),
                     ("supplier", people(70, "s_suppkey", "s_name", "Supplier"))):
        df.write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def buckets_of(spark, name):
    return int({r.col_name: r.data_type for r in spark.sql(f"DESCRIBE FORMATTED {name}").collect()}["Num Buckets"])


def test_stored_tables_have_buckets_by_lines(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(jobs, "LINES_PER_TASK", 100)
    keys = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    before = [spark.conf.get(k) for k in keys]
    for name in ("rda3", "rda1", "rda4_top"):
        assert rows(registry.QUERIES[f"stored_{name}"](spark, sf_dir)) == rows(registry.QUERIES[name](spark, sf_dir))
    names = registry._stored[spark.sparkContext.applicationId, sf_dir]
    assert {buckets_of(spark, n) for n in names.values()} == {LINES // 100}
    assert before == [spark.conf.get(k) for k in keys]
    assert set(names) == set(jobs.BUCKET_KEY) and not spark.sql("SHOW TABLES LIKE 'stored*_movies_genres_*'").collect()


def test_small_inputs_keep_the_least_number_of_buckets(spark, sf_dir):
    registry.stored(spark, sf_dir)
    names = registry._stored[spark.sparkContext.applicationId, sf_dir]
    assert {buckets_of(spark, n) for n in names.values()} == {registry.STORED_BUCKETS}


def test_layouts_are_written_in_parts_by_lines(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(jobs, "LINES_PER_TASK", 100)
    paths = registry.layouts_of(spark, sf_dir)
    assert len(glob.glob(f"{paths['clustered']}/*.parquet")) > LINES // 200
    want = rows(registry.QUERIES["rda4_top"](spark, sf_dir))
    assert want and rows(registry.QUERIES["lookup_rda4_top"](spark, sf_dir)) == want
    assert rows(registry.QUERIES["summary_rda4_top"](spark, sf_dir)) == want
    assert rows(registry.QUERIES["lookup_rda1"](spark, sf_dir)) == rows(registry.QUERIES["rda1"](spark, sf_dir))


@pytest.mark.parametrize("name", ["ru1", "ru3"])
def test_many_ids_meet_the_lines_in_parts_by_lines(spark, sf_dir, monkeypatch, name):
    want = rows(registry.QUERIES[name](spark, sf_dir))
    monkeypatch.setattr(jobs, "LINES_PER_TASK", 100)
    df = registry.QUERIES[name](spark, sf_dir)
    assert want and rows(df) == want
    assert re.search(rf"hashpartitioning\(id#\d+L, {LINES // 100}\), REPARTITION_BY_NUM", plan(df))


def test_parts_grow_with_the_lines(spark, sf_dir, monkeypatch):
    assert jobs.parts_of(Catalog(spark, sf_dir)) == 1
    monkeypatch.setattr(jobs, "LINES_PER_TASK", 250)
    assert jobs.parts_of(Catalog(spark, sf_dir)) == LINES // 250
