"""The command line runs the job, a query and the JSON export."""

import pytest

from marquee import cli

from conftest import SF_SMALL


def test_build_query_export(spark, tmp_path):
    out, res, js = str(tmp_path / "cat"), str(tmp_path / "res"), str(tmp_path / "json")
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    cli.main(["build", "--sf-dir", SF_SMALL, "--out", out, "--buckets", "4", "--prefix", "cli_den"])
    cli.main(["query", "--out", out, "--prefix", "cli_den", "--to", res, "rda2", "n_genres=5"])
    assert spark.read.parquet(res).count() == 4          # SURVEY 7.4: rda2 N=5 at sf0.001
    cli.main(["export-json", "--out", out, "--prefix", "cli_den", "--to", js])
    assert spark.read.json(str(tmp_path / "json" / "den_movies.json")).count() == 1500
    # the submitted setting stays
    assert spark.conf.get("spark.sql.shuffle.partitions") == partitions
    with pytest.raises(ValueError, match="n_genre"):
        cli.main(["query", "--out", out, "--prefix", "cli_den", "--to", res, "rda2", "n_genre=5"])
