"""Versions, conflicts, keyed loads, deltas and compaction of collections."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.functions import docops as D
from marquee.operators import denormalize, nest
from marquee.plans import registry
from marquee.session import scratch_path
from marquee.sources import files
from marquee.sources.collections import Collection, Conflict
from marquee.sources.testdata import Catalog

from conftest import SF_SMALL

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()),
                       T.StructField("m", T.MapType(T.StringType(), T.IntegerType()))])


def collection(spark, schema=SCHEMA, buckets=4):
    return Collection(spark, scratch_path(spark, "collection"), schema, buckets=buckets)


def rows(spark, ids, name="a"):
    return spark.createDataFrame([(i, f"{name}{i}", {"k": 1}) for i in ids], SCHEMA)


def content(df):
    return sorted((r.id, r.name) for r in df.collect())


def test_versions_answer_as_of(spark):
    c = collection(spark)
    assert c.version() == 0 and c.read().collect() == []
    c.append(rows(spark, range(5)))
    c.append(rows(spark, range(5, 8)))
    c.rewrite(lambda df: df.withColumn("name", F.lit("x")))
    assert content(c.read(1)) == [(i, f"a{i}") for i in range(5)]
    assert content(c.read(2)) == [(i, f"a{i}") for i in range(8)]
    assert content(c.read()) == [(i, "x") for i in range(8)] and c.version() == 3
    assert content(Collection(spark, c.path, SCHEMA).read(as_of=1)) == content(c.read(1))


def test_a_write_that_dies_leaves_the_old_version(spark):
    c = collection(spark)
    c.append(rows(spark, range(5)))
    boom = F.udf(lambda x: 1 // 0, "string")
    with pytest.raises(Exception, match="ZeroDivisionError|division"):
        c.rewrite(lambda df: df.withColumn("name", boom("name")))
    assert c.version() == 1 and content(c.read()) == [(i, f"a{i}") for i in range(5)]
    c._write(rows(spark, [9]))                                  # data without its commit
    assert content(c.read()) == [(i, f"a{i}") for i in range(5)]


def test_two_writers_from_one_version_cannot_both_commit(spark):
    c = collection(spark)
    c.append(rows(spark, range(3)))
    base = c.version()
    mine = c.parts(base) + c._write(rows(spark, [7]))
    c.append(rows(spark, [8]))
    with pytest.raises(Conflict):
        c.commit(mine, base)
    assert [i for i, _ in content(c.read())] == [0, 1, 2, 8]


def test_keyed_loads(spark):
    c = collection(spark)
    assert c.load(rows(spark, [1, 2, 3])) == {"version": 1, "loaded": 3, "refused": 0, "replaced": 0}
    batch = rows(spark, [3, 4, 4, 5], "b").unionByName(spark.createDataFrame([(None, "n", None)], SCHEMA))
    out = c.load(batch)
    assert (out["loaded"], out["refused"]) == (2, 3)
    assert content(c.read()) == [(1, "a1"), (2, "a2"), (3, "a3"), (4, "b4"), (5, "b5")]
    out = c.load(rows(spark, [2, 9], "c"), replace=True)
    assert (out["loaded"], out["refused"], out["replaced"]) == (2, 0, 1)
    assert content(c.read()) == [(1, "a1"), (2, "c2"), (3, "a3"), (4, "b4"), (5, "b5"), (9, "c9")]
    assert c.load(rows(spark, []))["loaded"] == 0 and len(c.read().collect()) == 6
    hot = spark.range(3000).select(F.lit(77).cast("long").alias("id"), F.col("id").cast("string").alias("name"),
                                   F.lit(None).cast("map<string,int>").alias("m"))
    out = c.load(hot)
    assert (out["loaded"], out["refused"]) == (1, 2999) and c.read().filter("id = 77").first().name == "0"


def test_replacing_rewrites_the_touched_buckets_only(spark):
    c = collection(spark, buckets=8)
    c.load(rows(spark, range(100)))
    old = {p["bucket"]: p["folder"] for p in c.parts(1)}
    c.load(rows(spark, [5], "z"), replace=True)
    changed = {p["bucket"] for p in c.parts(2) if p["folder"] != old[p["bucket"]]}
    assert len(old) == 8 and len(changed) == 1


def test_deltas_and_compaction_equal_a_full_rebuild(spark):
    """Children that come before their movie, genres in two loads, and a movie that never comes."""
    cat = Catalog(spark, SF_SMALL)
    loads = registry._in_three_loads(spark, SF_SMALL)
    c = Collection(spark, scratch_path(spark, "parts"), T.StructType.fromDDL(denormalize.MOVIE_PARTS), buckets=8)
    stray = spark.createDataFrame([(10 ** 9, "PROMO"), (1, "PROMO"), (1, "PROMO")], "movie_id long, genre string")
    c.append(denormalize.movie_parts(**loads[0]))
    c.append(denormalize.movie_parts(**loads[1]))
    c.append(denormalize.movie_parts(**(loads[2] | {"movies_genres": loads[2]["movies_genres"].unionByName(stray)})))
    genres = cat.movies_genres().unionByName(stray.filter("movie_id = 1")).distinct()
    want = denormalize.den_movies(cat.movies(), genres, cat.movies_directors(), cat.roles())
    plain = lambda df: sorted(map(tuple, df.select(want.columns).collect()))
    assert plain(denormalize.merge_movies(c.read())) == plain(want)
    c.compact(denormalize.merged_parts)
    assert plain(denormalize.merge_movies(c.read())) == plain(want)
    assert c.read().groupBy("id").count().filter("count > 1").count() == 0
    # one more load into one bucket: the next compaction leaves the others' folders
    before = {p["bucket"]: p["folder"] for p in c.parts(c.version())}
    none = {k: v.limit(0) for k, v in loads[0].items()}
    one = none | {"roles": spark.createDataFrame([(5, 1, 1)], "actor_id long, movie_id long, role int")}
    c.append(denormalize.movie_parts(**one))
    c.compact(denormalize.merged_parts)
    after = {p["bucket"]: p["folder"] for p in c.parts(c.version())}
    assert len(before) == 8 and sum(before[b] != after[b] for b in before) == 1
    n = lambda df: df.filter("id = 1").first().den_nb_actors
    assert n(denormalize.merge_movies(c.read())) == n(want) + 1


def test_links_merge(spark):
    pairs = [(1, 2), (1, 2), (1, 3), (2, 2), (1, 2)]
    df = lambda x: nest.link_rows(spark.createDataFrame(x, "director_id long, movie_id long"), "director_id")
    got = denormalize.merge_links(df(pairs[:2]).unionByName(df(pairs[2:])))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, df(pairs).collect()))


def test_missing_null_and_other_kinds_differ(spark, tmp_path):
    (tmp_path / "docs.json").write_text('{"id":1,"rank":8.5,"g":{"PROMO":null}}\n{"id":2,"rank":null}\n{"id":3}\n'
                                        '{"id":4,"rank":"high","g":{"PROMO":0.5}}\nno json\n')
    d = files.read_documents(spark, str(tmp_path / "docs.json"))
    ids = lambda cond: sorted(r.id for r in d.filter(cond).select(D.field_value("doc", "$.id", "long").alias("id")).collect())
    assert ids(D.field_exists("doc", "$.rank")) == [1, 2, 4]
    assert ids(D.field_not_null("doc", "$.rank")) == [1, 4]
    assert ids(D.field_is_null("doc", "$.rank")) == [2]
    assert ids(D.field_value("doc", "$.rank", "double") > 8) == [1]
    assert ids(D.field_exists("doc", "$.g.PROMO")) == [1, 4] and ids(D.field_not_null("doc", "$.g.PROMO")) == [4]
    assert d.filter("doc is null").count() == 1
