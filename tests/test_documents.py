"""Filter and stage documents: what each operator matches, the eight queries, and what reaches the scan."""

import pytest
from pyspark.sql import functions as F

from marquee.plans import catalogue as Q
from marquee.plans import documents as doc
from marquee.plans import registry

from conftest import SF_SMALL
from test_plans import plan

ROWS = [(1, "a", 9.0, ["x", "y"], {"k": 1.0}, (1, "p")), (2, "b", None, [], {"k": 0.0}, (2, "q")),
        (3, None, 7.0, None, {"k": None}, None), (4, "d", 8.0, ["y"], {}, (4, None)), (5, "e", 9.5, [None, "x"], None, (5, "r"))]
SCHEMA = "id long, name string, rank double, tags array<string>, m map<string,double>, s struct<n: int, t: string>"


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(ROWS, SCHEMA).cache()


@pytest.mark.parametrize(("where", "ids"), [
    ({}, [1, 2, 3, 4, 5]),
    ({"name": "a"}, [1]), ({"name": None}, [3]), ({"name": ["a"]}, []),
    ({"rank": {"$gt": 8}}, [1, 5]), ({"rank": {"$gte": 8, "$lt": 9.5}}, [1, 4]), ({"rank": {"$lte": 7}}, [3]),
    ({"rank": {"$ne": 9.0}}, [2, 3, 4, 5]), ({"rank": {"$ne": [None, 0]}}, [1, 2, 3, 4, 5]),
    ({"id": {"$in": [1, 4, 99]}}, [1, 4]), ({"name": {"$in": ["a", None]}}, [1, 3]), ({"name": {"$nin": ["a", "b"]}}, [3, 4, 5]),
    ({"tags": "x"}, [1, 5]), ({"tags": ["y"]}, [4]), ({"tags": {"$in": ["x", "q"]}}, [1, 5]),
    ({"tags": {"$ne": "x"}}, [2, 3, 4]), ({"tags": {"$elemMatch": {"$gt": "x"}}}, [1, 4]), ({"id": {"$elemMatch": {"$in": [1]}}}, []),
    ({"rank": {"$not": {"$gt": 8}}}, [2, 3, 4]),
    ({"m.k": {"$exists": True}}, [1, 2, 3]), ({"m.k": {"$exists": False}}, [4, 5]),
    ({"m.k": {"$exists": True, "$ne": [None, 0]}}, [1, 2, 3]), ({"m.k": {"$exists": True, "$nin": [None, 0]}}, [1]),
    ({"s.t": "p"}, [1]), ({"s.n": {"$gt": 3}}, [4, 5]), ({"tags": {"$gt": "x"}}, [1, 4]),
    ({"$or": [{"name": "a"}, {"rank": {"$lt": 8}}]}, [1, 3]), ({"$nor": [{"name": "a"}, {"rank": {"$lt": 8}}]}, [2, 4, 5]),
    ({"$and": [{"rank": {"$gt": 7}}, {"tags": "y"}]}, [1, 4]),
    ({"$expr": {"$eq": [{"$size": "$tags"}, 2]}}, [1, 5]),
    ({"$expr": {"$and": [{"$gt": ["$rank", 8]}, {"$not": [{"$eq": ["$name", "a"]}]}]}}, [5]),
])
def test_conditions(df, where, ids):
    assert sorted(r.id for r in doc.find(df, where).collect()) == ids


def test_semi_join_on_ids(spark, df):
    ids = spark.createDataFrame([(1,), (1,), (4,), (None,)], "movie_id long")
    assert sorted(r.id for r in doc.find(df, {"id": {"$in": ids, "$gt": 1}, "tags": "y"}).collect()) == [4]
    with pytest.raises(ValueError):
        doc.find(df, {"id": {"$in": df}})


def test_expressions_and_stages(df):
    entries = {"$map": {"input": {"$objectToArray": "$m"}, "as": "e", "in": "$$e.k"}}
    got = doc.aggregate(df, [
        {"$match": {"id": {"$lte": 4}}},
        {"$project": {"id": 1, "tags": 1, "rank": 1, "keys": entries,
                      "label": {"$cond": [{"$gt": ["$rank", 8]}, {"$concat": ["<", "$name", ">"]}, {"$ifNull": ["$name", "none"]}]}}},
        {"$sort": {"id": -1}}]).collect()
    assert [(r.id, r.label, r["keys"]) for r in got] == [(4, "d", []), (3, "none", ["k"]), (2, "b", ["k"]), (1, "<a>", ["k"])]
    top = {"$top": {"output": ["$id", "$rank"], "sortBy": {"rank": -1, "id": 1}}}
    got = doc.aggregate(df, [{"$unwind": "$tags"}, {"$group": {"_id": "$tags", "n": {"$count": {}}, "best": top,
                                                                "low": {"$min": "$rank"}}}]).collect()
    assert {(r._id, r.n, r.best.id, r.low) for r in got} == {("x", 2, 5, 9.0), ("y", 2, 1, 8.0), (None, 1, 5, 9.5)}
    assert doc.aggregate(df, [{"$match": {"id": 99}}, {"$group": {"_id": None, "a": {"$avg": "$rank"}}}]).collect() == []
    assert doc.aggregate(df, [{"$count": "n"}]).collect()[0].n == 5
    assert doc.find(df, None, {"m": 0, "s": 0}).columns == ["id", "name", "rank", "tags"]
    kept = {"$filter": {"input": {"$objectToArray": "$m"}, "as": "g", "cond": {"$ne": ["$$g.v", None]}}}
    back = doc.aggregate(df, [{"$set": {"m": {"$arrayToObject": kept}}}, {"$match": {"id": {"$in": [1, 3]}}}, {"$sort": {"id": 1}}])
    assert [r.m for r in back.collect()] == [{"k": 1.0}, {}]
    one = doc.find_one(df, {"rank": {"$gt": 7}}, ["id"])
    assert [r.id for r in one.collect()] == [1]


@pytest.mark.parametrize("bad", [{"rank": {"$near": 3}}, {"$where": "x"}, {"$expr": {"$rand": {}}}, {"$expr": {"$eq": [1, 1], "$ne": [1, 2]}}])
def test_unknown_operators_raise(df, bad):
    with pytest.raises(doc.UnknownOperator):
        doc.find(df, bad)


def test_unknown_names_and_stages_raise(df):
    for where in ({"nothing": 1}, {"s.z": 1}, {"name.z": 1}):
        with pytest.raises(KeyError):
            doc.find(df, where)
    for stage in ({"$out": "x"}, {"$match": {}, "$limit": 1}, {"$group": {"_id": None, "x": {"$push": "$id"}}}):
        with pytest.raises(doc.UnknownOperator):
            doc.aggregate(df, [stage])


def _pushed(text):
    return sorted(line.strip() for line in text.splitlines() if "PushedFilters" in line or "ReadSchema" in line)


@pytest.mark.parametrize("name", ["ru1", "ru3", "rda3", "ru4", "rda1"])
def test_documents_push_what_the_written_plans_push(spark, name):
    t = registry.stored(spark, SF_SMALL)
    assert _pushed(plan(registry._documents()[name](t))) == _pushed(plan(registry._over_stored()[name](t)))


def test_documents_match_the_written_plans_on_rows(spark):
    t = registry.stored(spark, SF_SMALL)
    for genre in ("PROMO", "ECONOMY", "none"):
        assert sorted(doc.ru1(t, genre, 3).collect()) == sorted(Q.ru1(t["movies"], genre, 3).collect())
    nulls = {"directors": t["directors"].withColumn("dict_genres_den_prob", F.when(F.col("id") % 2 == 0, F.col("dict_genres_den_prob")))}
    assert sorted(doc.rda2(nulls, 2).collect()) == sorted(Q.rda2(nulls["directors"], 2).collect())
