"""Statistics merged from sketches against exact ones."""

from pyspark.sql import functions as F

from marquee.plans import registry, reports

from conftest import SF_SMALL
from test_plans import plan


def test_estimates_are_within_the_bound_and_merge(spark):
    df = spark.range(40_000).select("id", (F.col("id") % 7000).alias("k"), F.concat(F.lit("v"), F.col("id") % 90).alias("name"),
                                    F.when(F.col("id") % 5 > 0, F.col("id") / 3).alias("x"))
    parts = reports.column_sketches("t", df, ["id", "k", "name", "x"], 16)
    assert parts.count() == 64
    got = {r.column: r for r in reports.merged_stats(parts).collect()}
    exact = {r.column: r for r in reports.column_stats("t", df, ["id", "k", "name", "x"]).collect()}
    for c, r in got.items():
        assert (r.n_rows, r.n_null) == (exact[c].n_rows, exact[c].n_null)
        assert abs(r.n_distinct_estimate - exact[c].n_distinct) <= 3 * 1.04 / 2 ** (reports.SKETCH_BITS / 2) * exact[c].n_distinct
    assert exact["x"].n_null == 8000 and exact["k"].n_distinct == 7000
    assert (got["k"].min_number, got["k"].max_number, got["name"].min_text, got["name"].max_text) == (0.0, 6999.0, "v0", "v9")
    half = reports.merged_stats(parts.filter("part < 8")).filter("column = 'id'").first()
    assert 0 < half.n_rows < 40_000 and half.max_number <= 39_999


def test_the_report_reads_no_collection(spark):
    registry.sketches_of(spark, SF_SMALL)
    text = plan(registry.QUERIES["rpt_sketch_stats"](spark, SF_SMALL))
    assert "sketches-" in text and "list_genres" not in text and text.count("Scan parquet") == 2
