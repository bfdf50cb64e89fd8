"""Equivalent forms give equal results (brute force on small inputs)."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from marquee.operators import denormalize
from marquee.plans import catalogue as Q
from marquee.sources.testdata import Catalog

from conftest import SF_SMALL


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_rda4_top_equals_row_number_form(spark):
    den = denormalize.build_all(Catalog(spark, SF_SMALL))
    three = den["movies"], den["directors"], den["director_movies"]
    names = Q.default_names(40)
    sel = Q.selected_movies(*three, names)
    w = Window.partitionBy("genre").orderBy(F.col("rank").desc_nulls_last(), F.col("id"))
    ref = (sel.withColumn("rn", F.row_number().over(w)).filter("rn = 1")
           .select("genre", F.col("name").alias("best_name"), F.col("rank").alias("best_rank")))
    assert rows(Q.rda4_top(*three, names)) == rows(ref)


def test_movies_of_ids_equal_the_whole_build_filtered(spark):
    cat = Catalog(spark, SF_SMALL)
    ids = cat.movies().filter("id % 10 = 3").select("id")
    whole = denormalize.build_all(cat)["movies"].join(ids, "id", "left_semi")
    assert rows(denormalize.movies_for(cat)(ids)) == rows(whole)
