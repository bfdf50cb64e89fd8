"""Plan properties: what Catalyst must see and do with our queries."""

import re

import pytest

from marquee.operators import denormalize
from marquee.plans import catalogue as Q
from marquee.plans import registry
from marquee.session import scratch_path
from marquee.sources.testdata import Catalog

from conftest import SF_SMALL, planned_without_broadcast

PY_NODES = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas",
            "MapInPandas")


def plan(df, mode="formatted"):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode))


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_no_python_in_any_query(spark, name):
    text = plan(registry.QUERIES[name](spark, SF_SMALL))
    assert not any(p in text for p in PY_NODES), name


def _stored(spark):
    den = denormalize.build_all(Catalog(spark, SF_SMALL))
    out = {}
    for k, df in den.items():
        p = scratch_path(spark, f"plan-{k}")
        df.write.parquet(p)
        out[k] = spark.read.parquet(p)
    return out


def test_ru1_over_stored_documents_is_one_stage(spark):
    m = _stored(spark)["movies"]
    text = plan(Q.ru1(m))
    assert "Exchange" not in text
    # rank filter reaches the scan; the projection prunes the lists it does not need
    pushed = text.split("PushedFilters:")[1].split("\n")[0]
    assert "GreaterThan(rank,8.0)" in pushed
    assert "list_directors_id" not in text.split("ReadSchema:")[1].split("\n")[0]


def test_rda4_is_a_semi_join_plan(spark):
    d = _stored(spark)
    df = Q.rda4_top(d["movies"], d["directors"], d["director_movies"])
    assert "LeftSemi" in optimized(df)


def test_ru1_end_to_end_drops_unused_children(spark):
    m = denormalize.build_all(Catalog(spark, SF_SMALL))["movies"]
    text = plan(Q.ru1(m))
    # roles (l_suppkey) and directors (o_custkey) are never read
    assert "l_suppkey" not in text and "o_custkey" not in text
    assert "customer.parquet" not in text and "supplier.parquet" not in text


def test_den_movies_joins_need_no_exchange_on_aggregated_side(spark):
    m = denormalize.build_all(Catalog(spark, SF_SMALL))["movies"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = plan(m)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # one exchange per input and per aggregate: movies (distinct, then by id),
    # lineitem and part (their join), genre pairs (distinct), genre lists,
    # director lists, role counts = 8.  The three left joins add none on the
    # aggregated side: it is already hash-partitioned on the movie id.
    n_ex = len(re.findall(r"^\(\d+\) Exchange", text, flags=re.M))
    assert n_ex == 8, text


def test_lookups_build_only_the_looked_up_movies(spark):
    with planned_without_broadcast(spark):
        for name in ("ru4", "rda1", "rda4_top", "rda4_max"):
            df = registry.QUERIES[name](spark, SF_SMALL)
            text = plan(df)
            # no list of movie ids is ever collected
            assert not re.search(r"collect_list\(movie_id", text), name
            # the parent and every child that is read meet the ids before any aggregate
            assert optimized(df).count("LeftSemi") >= (2 if name == "rda1" else 3), name


def test_pushed_ids_are_one_semi_join(spark):
    df = registry.QUERIES["agg_push"](spark, SF_SMALL)
    with planned_without_broadcast(spark):
        text = plan(registry.QUERIES["agg_push"](spark, SF_SMALL))
    assert optimized(df).count("Join ") == 1 and len(re.findall(r"Scan parquet", text)) >= 2
    assert "Aggregate" not in optimized(df)


def test_no_sort_aggregate_in_the_catalogue_queries(spark):
    with planned_without_broadcast(spark):
        for name in ("ru4", "rda1", "rda4_top", "rda2", "rpt_table_stats", "rpt_share_movies"):
            assert "SortAggregate" not in plan(registry.QUERIES[name](spark, SF_SMALL)), name


def test_id_list_reaches_the_scan(spark):
    text = plan(registry.QUERIES["flt_in_list_id"](spark, SF_SMALL))
    assert re.search(r"PushedFilters: \[In\(o_orderkey", text), text


@pytest.mark.parametrize("name", ["rda4_top", "rda4_max"])
def test_rda4_reads_every_table_once(spark, name):
    """Stored: one scan per table.  Lazily: the line items are joined to the parts once."""
    with planned_without_broadcast(spark):
        text = plan(registry.QUERIES[f"stored_{name}"](spark, SF_SMALL))
        assert len(re.findall(r"^\(\d+\) Scan parquet", text, flags=re.M)) == 3, text
        text = plan(registry.QUERIES[name](spark, SF_SMALL))
        assert len(re.findall(r"^Location: .*part\.parquet", text, flags=re.M)) == 1, text
