"""The further layouts: same answers as brute force, and what a lookup leaves unread."""

import glob
import random
import re
from collections import defaultdict

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from marquee.operators import aggregates as A
from marquee.plans import layouts, registry
from marquee.session import scratch_path

from conftest import SF_SMALL
from test_plans import plan

LINKS = "id long, movie_id long, n long"


def bytes_read(spark):
    return sum(s.getBytesRead() for s in spark.sparkContext._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics())


def links(spark, others):
    """Person 7 has 500 links, 900 other persons share ``others``."""
    rest = spark.range(others).select((F.col("id") % 900 + 10).alias("id"), F.xxhash64("id").alias("movie_id"), F.lit(1).cast("long").alias("n"))
    return rest.unionByName(spark.range(500).select(F.lit(7).cast("long").alias("id"), F.col("id").alias("movie_id"),
                                                    F.lit(2).cast("long").alias("n")))


def test_a_lookup_reads_no_more_when_others_grow(spark):
    read = []
    for others in (300_000, 3_000_000):
        path = scratch_path(spark, "person-links")
        layouts.write_person_links(links(spark, others), path, 16, page_rows=2000)
        stored = layouts.PersonLinks(spark, path)
        before = bytes_read(spark)
        got = stored.of_id(7).collect()
        read.append(bytes_read(spark) - before)
        assert sorted(r.movie_id for r in got) == list(range(500)) and {r.n for r in got} == {2}
        people = spark.createDataFrame([(7,), (7,), (12,), (5000,), (None,)], "id long")
        assert stored.of(people).groupBy("id").count().collect() and stored.of(people).filter("id = 12").count() > 50
        assert stored.of(people).filter("id = 7").count() == 500
    whole = sum(len(open(f, "rb").read()) for f in glob.glob(f"{path}/person_bucket=*/*.parquet"))
    assert read[1] < 1.5 * read[0] and read[1] < whole / 20, (read, whole)


def test_folders_are_pruned(spark):
    path = scratch_path(spark, "person-links")
    layouts.write_person_links(links(spark, 5000), path, 16)
    stored = layouts.PersonLinks(spark, path)
    literal = plan(stored.of_id(7))
    bucket = stored.links.filter("id = 7").select("person_bucket").first().person_bucket
    assert f"person_bucket#" in literal and re.search(rf"PartitionFilters: .*= {bucket}\)", literal), literal
    assert "EqualTo(id,7)" in literal
    people = spark.createDataFrame([(7, "a"), (8, "b")], "id long, name string").filter("name = 'a'")
    assert "dynamicpruning" in plan(stored.of(people))
    assert len(stored.of(people).collect()) == 500


def test_a_hot_person_lies_in_several_files(spark):
    path = scratch_path(spark, "person-links")
    hot = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("id"),
                                     F.col("id").alias("movie_id"), F.lit(1).cast("long").alias("n"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        layouts.write_person_links(hot, path, 4)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = layouts.PersonLinks(spark, path).of_id(1).select(F.input_file_name().alias("f")).groupBy("f").count().collect()
    assert len(files) >= 3 and sum(r["count"] for r in files) == 20_001


@pytest.mark.parametrize("width", [7, 100_000])
def test_postings_are_the_sets_of_ids(spark, width):
    rng = random.Random(width)
    rows = [(i * 3, rng.sample(["a", "b", "c"], rng.randint(0, 3))) for i in range(300)]
    path = scratch_path(spark, "postings")
    movies = spark.createDataFrame(rows + [(1_000_000, ["a", "a"]), (1_000_001, None)], "id long, list_genres array<string>")
    layouts.write_postings(movies, path, width)
    p = layouts.Postings(spark, path)
    want = defaultdict(set)
    for i, genres in rows + [(1_000_000, ["a"])]:
        for g in genres:
            want[g].add(i)
    ids = lambda posting: sorted(r.id for r in p.ids(posting).collect())
    for g in "abc":
        assert ids(p.genre(g)) == sorted(want[g])
    assert ids(p.intersect(p.genre("a"), p.genre("b"))) == sorted(want["a"] & want["b"])
    some = spark.createDataFrame([(i,) for i in range(0, 900, 2)] + [(1_000_000,)], "id long")
    assert ids(p.intersect(p.of(some), p.genre("a"))) == sorted(i for i in want["a"] if i % 2 == 0)
    assert ids(p.genre("none")) == []
    assert all(len(r.offsets) <= width and r.offsets == sorted(set(r.offsets)) for r in p.rows.collect())


def test_membership_by_postings_reads_no_genre_lists(spark):
    for name in ("posting_ru1", "posting_ru3", "posting_ru4"):
        schemas = [x for x in plan(registry.QUERIES[name](spark, SF_SMALL)).splitlines() if x.startswith("ReadSchema")]
        assert len(schemas) >= 2 and not any("list_genres" in x for x in schemas)


def groups_to_read(path, column, keep):
    """Row groups whose statistics allow a match, of all row groups."""
    n = hits = 0
    for f in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        at = meta.schema.names.index(column)
        for k in range(meta.num_row_groups):
            stats = meta.row_group(k).column(at).statistics
            n += 1
            hits += bool(stats.has_min_max and keep(stats.min, stats.max))
    return hits, n


def test_each_predicate_alone_skips_row_groups(spark):
    movies = spark.range(60_000).select(
        "id", (F.xxhash64("id") % 50 + 1950).cast("int").alias("year"),
        F.when(F.col("id") % 10 > 0, F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)) / 100).alias("rank"),
        F.pmod(F.xxhash64("id", F.lit(2)), F.lit(40)).alias("den_nb_actors"))
    path = scratch_path(spark, "clustered")
    layouts.write_clustered(movies, path, row_group_bytes=16 * 1024)
    assert spark.read.parquet(path).exceptAll(movies).count() == 0 and spark.read.parquet(path).count() == 60_000
    for column, keep in (("year", lambda lo, hi: lo <= 1960 <= hi), ("rank", lambda lo, hi: hi > 9),
                         ("den_nb_actors", lambda lo, hi: lo < 3)):
        hits, n = groups_to_read(path, column, keep)
        assert n >= 40 and hits < 0.45 * n, (column, hits, n)


def test_best_states_merge_over_any_split(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice("ab"), rng.choice([None, 1.0, 2.0, 2.0, 3.0]), f"m{i}", i % 5) for i in range(200)]
    df = spark.createDataFrame(rows, "key long, genre string, rank double, name string, part int")
    state = A.best_state(F.col("rank"), F.col("key"), F.col("name").alias("name")).alias("best")
    want = {r.genre: tuple(r.best) for r in df.groupBy("genre").agg(state).collect()}
    merged = df.groupBy("genre", "part").agg(state).groupBy("genre").agg(A.merge_best("best").alias("best")).collect()
    assert {r.genre: tuple(r.best) for r in merged} == want
    for g in "ab":
        first = min((r for r in rows if r[1] == g), key=lambda r: (-(r[2] if r[2] is not None else -1e9), r[0]))
        assert want[g] == (first[2], first[0], first[3])


def test_rda4_from_the_summary_reads_no_movie(spark):
    text = plan(registry.QUERIES["summary_rda4_top"](spark, SF_SMALL))
    assert "list_genres" not in text and "movie_id" not in text and len(re.findall(r"Scan parquet", text)) >= 2
