"""Edge rows of FIXTURES.md section 4, one small hand-written table each."""

import math

import pytest
from pyspark.sql import functions as F

from marquee import schemas
from marquee.functions import clean
from marquee.functions import docops as D
from marquee.operators import aggregates as A
from marquee.operators import denormalize
from marquee.plans import catalogue as Q
from marquee.session import scratch_path
from marquee.sources import files

NAN = float("nan")


def movies_df(spark, rows):
    s = "id bigint, name string, year int, rank double"
    return spark.createDataFrame(rows, s)


def den_movies_df(spark, rows):
    return spark.createDataFrame(rows, schemas.DEN_MOVIES)


def den_directors_df(spark, rows):
    return spark.createDataFrame(rows, schemas.DEN_DIRECTORS)


def test_nan_rank_made_null(spark):
    m = movies_df(spark, [(1, "a", 2000, NAN), (2, "b", 2000, 9.0), (3, "c", 2000, None)])
    m = m.withColumn("rank", clean.nan_to_null(F.col("rank")))
    assert [r.id for r in m.filter(D.greater("rank", 8)).collect()] == [2]
    agg = m.agg(F.max("rank").alias("mx"), F.avg("rank").alias("av")).first()
    assert agg.mx == 9.0 and agg.av == 9.0


def test_spark_default_nan_is_greatest(spark):
    # why D1 exists: without it NaN passes rank > 8 and wins max()
    m = movies_df(spark, [(1, "a", 2000, NAN), (2, "b", 2000, 9.0)])
    assert m.filter(F.col("rank") > 8).count() == 2
    assert math.isnan(m.agg(F.max("rank")).first()[0])


def test_text_rank_lenient_and_strict(spark):
    df = spark.createDataFrame([("NULL",), ("",), ("7.5",)], "rank string")
    got = [r[0] for r in df.select(clean.lenient(F.col("rank"), "double")).collect()]
    assert got == [None, None, 7.5]
    with pytest.raises(Exception):
        df.select(clean.strict(F.col("rank"), "double")).collect()


def test_decimal_text_to_int_is_null(spark):
    df = spark.createDataFrame([("3.7",), ("12",)], "v string")
    assert [r[0] for r in df.select(clean.lenient(F.col("v"), "int")).collect()] == [None, 12]


def test_bad_array_element(spark):
    df = spark.createDataFrame([(["1", "x"],)], "l array<string>")
    fixed = clean.fix_types(df, {"l": "array<int>"}, "lenient")
    assert fixed.first().l == [1, None]
    with pytest.raises(Exception):
        clean.fix_types(df, {"l": "array<int>"}, "strict").collect()


def test_unknown_year_sentinel(spark):
    df = spark.createDataFrame([("1", None, "5.0"), ("2", "1995", "NaN")], "id string, year string, rank string")
    out = clean.clean_sentinel(df).orderBy("id").collect()
    assert [r.year for r in out] == [-1, 1995]
    assert out[0].rank == 5.0 and out[1].rank is None


def _tables(spark):
    movies = movies_df(spark, [(1, "lonely", 2000, 5.0), (2, "busy", 2001, 6.0)])
    genres = spark.createDataFrame([(2, "Drama"), (2, "Comedy")], "movie_id bigint, genre string")
    mdirs = spark.createDataFrame([(10, 2)], "director_id bigint, movie_id bigint")
    roles = spark.createDataFrame([(7, 2, "a"), (7, 2, "b")], "actor_id bigint, movie_id bigint, role string")
    return movies, genres, mdirs, roles


def test_no_children_and_duplicate_role(spark):
    m = denormalize.den_movies(*_tables(spark)).orderBy("id").collect()
    assert (m[0].list_genres, m[0].list_directors_id, m[0].den_nb_actors) == ([], [], 0)
    assert m[1].list_genres == ["Comedy", "Drama"] and m[1].list_directors_id == [10]
    assert m[1].den_nb_actors == 2  # one actor, two role rows (D6)


def test_duplicate_parent_rows_kept_once(spark):
    movies, genres, mdirs, roles = _tables(spark)
    doubled = movies.unionByName(movies)
    assert denormalize.den_movies(doubled, genres, mdirs, roles).count() == 2


def test_null_pairs_skipped_and_empty_map(spark):
    d = spark.createDataFrame([(1, "A", "B"), (2, "C", "D")], "id bigint, first_name string, last_name string")
    md = spark.createDataFrame([], "director_id bigint, movie_id bigint")
    dg = spark.createDataFrame([(1, None, 0.5), (1, "Drama", None), (1, "War", 0.25), (2, None, None)],
                               "director_id bigint, genre string, prob double")
    out = {r.id: r.dict_genres_den_prob for r in denormalize.den_directors(d, md, dg).collect()}
    assert out == {1: {"War": 0.25}, 2: {}}


def test_duplicate_map_key_raises(spark):
    d = spark.createDataFrame([(1, "A", "B")], "id bigint, first_name string, last_name string")
    md = spark.createDataFrame([], "director_id bigint, movie_id bigint")
    dg = spark.createDataFrame([(1, "War", 0.5), (1, "War", 0.25)], "director_id bigint, genre string, prob double")
    with pytest.raises(Exception, match="DUPLICATED_MAP_KEY|Duplicate map key"):
        denormalize.den_directors(d, md, dg).collect()


def _dirs(spark):
    return den_directors_df(spark, [
        (1, "Zero", "Prob", 0, {"Romance": 0.0, "War": 0.5}),
        (2, "Null", "Value", 0, {"Romance": None, "War": 0.5}),
        (3, "Real", "One", 0, {"Romance": 0.3, "War": 0.5}),
    ])


def test_zero_and_null_map_values(spark):
    d = _dirs(spark)
    assert sorted(r.first_name for r in Q.ru2(d, "Romance").collect()) == ["Null", "Real", "Zero"]
    assert [r.first_name for r in Q.ru2(d, "Romance", strict=True).collect()] == ["Real"]
    assert [r.first_name for r in Q.rda2(d, 2).collect()] == ["Real"]
    assert sorted(r.first_name for r in Q.rda2(d, 1).collect()) == ["Null", "Zero"]


def test_empty_array_unwind(spark):
    df = spark.createDataFrame([(1, []), (2, ["x"]), (3, None)], "id int, l array<string>")
    assert df.select("id", F.explode("l")).count() == 1


def test_null_part_full_name(spark):
    df = spark.createDataFrame([(None, "Dumont"), ("Renée", "Dumont")], "first_name string, last_name string")
    names = [r[0] for r in df.select(D.full_name()).collect()]
    assert names == [None, "Renée Dumont"]
    assert df.filter(D.in_list(D.full_name(), ["Renée Dumont"])).count() == 1


def _catalogue(spark):
    m = den_movies_df(spark, [
        (1, "m1", 2000, 7.0, ["Drama"], [10], 1),
        (2, "m2", 2000, 9.0, ["Drama", "War"], [10], 3),
        (3, "m3", 2000, 9.0, ["Drama"], [11], 3),
        (4, "m4", 2000, None, ["Noir"], [10], 1),
        (5, "m5", 2000, None, ["Noir"], [11], 1),
        (6, "m6", 2000, 8.0, ["Drama"], [12], 2),
    ])
    d = den_directors_df(spark, [
        (11, "Renée", "Dumont", 2, {}),
        (10, "Renée", "Dumont", 3, {}),   # homonym with the lower id
        (12, "Other", "One", 1, {}),
    ])
    links = spark.createDataFrame([(11, 3, 1), (11, 5, 1), (10, 1, 2), (10, 2, 1), (10, 4, 1), (12, 6, 1)],
                                  schemas.LINKS)
    return m, d, links


def test_homonyms_use_lowest_id(spark):
    t = _catalogue(spark)
    assert sorted(r.id for r in Q.ru4(*t, "Renée", "Dumont", "Drama").collect()) == [1, 2]
    assert Q.rda1(*t, "Renée", "Dumont").first().average_rank == 8.0


def test_unknown_director(spark):
    t = _catalogue(spark)
    assert Q.ru4(*t, "No", "Body", "Drama").count() == 0
    assert Q.rda1(*t, "No", "Body").count() == 0
    assert Q.rda4_top(*t, ["No Body"]).count() == 0
    assert Q.rda4_max(*t, ["No Body"]).count() == 0


def test_rank_tie_and_unranked_group(spark):
    t = _catalogue(spark)
    top = {r.genre: (r.best_name, r.best_rank) for r in Q.rda4_top(*t, ["Renée Dumont"]).collect()}
    assert top["Drama"] == ("m2", 9.0)     # m2 and m3 tie on 9.0: lowest id
    assert top["Noir"] == ("m4", None)     # only unranked movies: lowest id
    mx = {r.genre: (r.best_rank, r.first_name) for r in Q.rda4_max(*t, ["Renée Dumont"]).collect()}
    assert mx["Noir"] == (float("-inf"), "m4")
    assert mx["Drama"] == (9.0, "m1")      # literal form: first name is not the best


def test_csv_header_line_becomes_null_id(spark):
    path = scratch_path(spark, "hdr-csv")
    spark.createDataFrame([("id", "name", "year", "rank"), ("1", "Renée", "1995", "7.5")],
                          schemas.text_schema("movies")).coalesce(1).write.csv(path)
    typed = clean.type_table(files.read_source_csv(spark, path, "movies"), "movies")
    rows = {(r.id, r.name) for r in typed.collect()}
    assert rows == {(None, "name"), (1, "Renée")}
    assert typed.filter(F.col("id").isNull()).count() == 1


def test_trimmed_mean(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 3.0), ("a", 100.0), ("b", 1.0), ("b", 5.0)],
                               "g string, x double")
    out = {r.g: r.t for r in df.groupBy("g").agg(A.trimmed_mean("x").alias("t")).collect()}
    assert out == {"a": 2.5, "b": None}


def test_append_twice_doubles(spark):
    path = scratch_path(spark, "append")
    df = spark.createDataFrame([(1,), (2,), (3,)], "id bigint")
    assert files.append(df, path) == 3
    assert files.append(df, path) == 3
    assert spark.read.parquet(path).count() == 6


def test_json_roundtrip_keeps_empty_and_null(spark):
    path = scratch_path(spark, "json")
    m = den_movies_df(spark, [(1, "m", None, None, [], [], 0)])
    files.write_json(m, path)
    back = files.read_json(spark, path, schemas.DEN_MOVIES).first()
    assert back.rank is None and back.year is None and back.list_genres == []


def test_share_counts_total(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (4,)], "x int")
    r = A.share(df, F.col("x") > 3).first()
    assert (r.matched, r.other, r.total, r.pct_label) == (1, 3, 4, "25.0%")
    empty = A.share(df.filter("x > 10"), F.col("x") > 3).first()
    assert empty.total == 0 and empty.pct_matched is None


def test_split_trim(spark):
    df = spark.createDataFrame([("Ana Sol, 'Ben Tau' ,\t Cleo Ursa\n",)], "s string")
    assert df.select(D.split_trim("s")).first()[0] == ["Ana Sol", "Ben Tau", "Cleo Ursa"]
    assert D.split_trim_py("Ana Sol, 'Ben Tau'") == ["Ana Sol", "Ben Tau"]


def test_percent_label_half_up(spark):
    df = spark.createDataFrame([(12.25,), (12.35,), (0.0,)], "x double")
    assert [r[0] for r in df.select(D.percent_label("x")).collect()] == ["12.3%", "12.4%", "0.0%"]


def test_numbers_with_type_suffixes_are_no_numbers(spark):
    df = spark.createDataFrame([("3d",), ("2.5f",), ("1e3",), (" 7.5 ",), ("-.5",), ("inf",), ("nan",), ("12",)], "v string")
    doubles = [r[0] for r in df.select(clean.lenient(F.col("v"), "double")).collect()]
    assert doubles == [None, None, 1000.0, 7.5, -0.5, float("inf"), None, 12.0]
    typed = spark.createDataFrame([(1e-7,), (None,), (NAN,)], "v double").select(clean.lenient(F.col("v"), "double"))
    assert [r[0] for r in typed.collect()] == [1e-7, None, None]


def test_rounding_neither_clamps_nor_hides_nan(spark):
    df = spark.createDataFrame([(1e14,), (-1e300,), (NAN,), (float("inf"),), (0.0000015,), (None,)], "x double")
    got = [r[0] for r in df.select(D.round_half_up("x")).collect()]
    assert got[:2] == [1e14, -1e300] and math.isnan(got[2]) and got[3:] == [float("inf"), 0.000002, None]


def test_means_and_shares_are_not_rounded(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (2.0,)], "x double")
    assert A.global_avg(df, "x", "m").first().m == 5 / 3
    assert A.share(df, F.col("x") > 1).first().pct_matched == 200 / 3


def test_null_memberships_match_nothing(spark):
    df = spark.createDataFrame([(None, None, None), ("a", ["a", None], {"a": 1.0})],
                               "c string, l array<string>, m map<string,double>")
    assert df.filter(D.in_list("c", ["a"])).count() == 1
    assert df.filter(D.any_element_in("l", ["a", "b"])).count() == 1
    assert df.filter(D.map_has_key("m", "a")).count() == 1


def test_strict_typing_raises_on_the_unclean_text(spark):
    from marquee.sources.testdata import UncleanCatalog
    from conftest import SF_SMALL
    text = UncleanCatalog(spark, SF_SMALL).movies_text()
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        clean.type_table(text, "movies", "strict").collect()


def test_column_stats_by_hand(spark):
    from marquee.plans.reports import column_stats
    df = spark.createDataFrame([(1, "a"), (2, None), (2, "a"), (None, None)], "id int, s string")
    got = {r.column: (r.n_rows, r.n_null, r.n_distinct) for r in column_stats("t", df, ["id", "s"]).collect()}
    assert got == {"id": (4, 1, 2), "s": (4, 2, 1)}


def test_a_session_names_its_folder_on_a_cluster():
    from marquee.session import single_machine
    assert single_machine("local") and single_machine("local[8]")
    assert not any(map(single_machine, ("local-cluster[3,2,3000]", "yarn", "spark://h:1")))
