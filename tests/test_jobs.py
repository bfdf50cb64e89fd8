"""The denormalisation job writes a catalogue the queries read unchanged."""

import pytest

from marquee.operators import denormalize
from marquee.plans import catalogue as Q
from marquee.plans import jobs
from marquee.sources.testdata import Catalog

from conftest import SF_SMALL, planned_without_broadcast


def rows(df):
    # sums of doubles depend on their order in the last digits
    return sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect())


def lookups(t):
    three = t["movies"], t["directors"], t["director_movies"]
    return [rows(q(*three)) for q in (Q.ru4, Q.rda1, Q.rda4_top, Q.rda4_max)]


def test_stored_catalogue_answers_like_lazy_build(spark):
    names = jobs.denormalize_job(spark, SF_SMALL, 4, prefix="t_den")
    stored = jobs.open_catalogue(spark, names)
    cat = Catalog(spark, SF_SMALL)
    lazy = denormalize.build_all(cat)
    for k in ("movies", "director_movies", "actor_movies", "actors"):
        assert rows(stored[k]) == rows(lazy[k].select(*stored[k].columns))
    assert lookups(stored) == lookups(lazy)
    three = lazy["movies"], lazy["directors"], lazy["director_movies"]
    for got, q in zip(lookups(stored), (Q.ru4, Q.rda1, Q.rda4_top, Q.rda4_max)):
        assert got == rows(q(*three, movies_for=denormalize.movies_for(cat)))
    assert rows(Q.rda2(stored["directors"], 5)) == rows(Q.rda2(lazy["directors"], 5))


def test_lookup_does_not_shuffle_bucketed_movies(spark):
    names = jobs.denormalize_job(spark, SF_SMALL, 4, prefix="t_den2")
    c = jobs.open_catalogue(spark, names)
    with planned_without_broadcast(spark):
        text = Q.ru4(c["movies"], c["directors"], c["director_movies"])._jdf.queryExecution().executedPlan().toString()
    lines = text.splitlines()
    # neither the movies nor the links meet an exchange below their join
    for table in ("t_den2_movies", "t_den2_director_movies"):
        i = next(k for k, ln in enumerate(lines) if table in ln)
        while "SortMergeJoin" not in lines[i]:
            assert "Exchange" not in lines[i], text
            i -= 1


def test_reattached_with_its_own_bucket_count(spark, tmp_path):
    out = str(tmp_path / "cat")
    names = jobs.denormalize_job(spark, SF_SMALL, 8, out_dir=out, prefix="t_den3")
    before = lookups(jobs.open_catalogue(spark, names))
    for n in names.values():
        spark.sql(f"DROP TABLE {n}")          # external tables: files stay
    for wrong in (4, 16):
        with pytest.raises(ValueError, match="8 buckets"):
            jobs.attach_catalogue(spark, out, prefix="t_den3", buckets=wrong)
    again = jobs.attach_catalogue(spark, out, prefix="t_den3")
    with planned_without_broadcast(spark):
        assert lookups(jobs.open_catalogue(spark, again)) == before
    assert jobs.attach_catalogue(spark, out, prefix="t_den3", buckets=8) == again
    # the name is taken by another folder
    other = str(tmp_path / "other")
    jobs.denormalize_job(spark, SF_SMALL, 4, out_dir=other, prefix="t_den3b")
    with pytest.raises(ValueError, match="another prefix"):
        jobs.attach_catalogue(spark, other, prefix="t_den3")


def test_incomplete_catalogue_is_an_error(spark, tmp_path):
    spark.createDataFrame([("movies", 4, "id", ["id"], "`id` bigint")], jobs.MANIFEST_SCHEMA) \
        .write.json(str(tmp_path / "part" / jobs.MANIFEST))
    with pytest.raises(ValueError, match="no complete catalogue"):
        jobs.attach_catalogue(spark, str(tmp_path / "part"), prefix="t_part")


def test_export_json_then_stream_load(spark, tmp_path):
    from marquee import schemas
    from marquee.session import scratch_path
    from marquee.streaming.load import load_documents, read_collection
    names = jobs.denormalize_job(spark, SF_SMALL, 4, prefix="t_den4")
    c = jobs.open_catalogue(spark, names)
    paths = jobs.export_json(c, str(tmp_path / "json"))
    table = scratch_path(spark, "loaded-actors")
    assert load_documents(spark, paths["actors"], schemas.DEN_ACTORS, table) == c["actors"].count()
    back = read_collection(spark, schemas.DEN_ACTORS, table)
    assert rows(back) == rows(c["actors"].select(*back.columns))
