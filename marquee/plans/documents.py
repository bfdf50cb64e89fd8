"""``find`` and ``aggregate``: queries written as filter and stage documents.

A filter is a dict of field paths and conditions, a pipeline a list of stage
dicts, as document stores take them.  Each becomes built-in Column expressions
on a DataFrame, so Catalyst sees ordinary filters (comparisons stay bare and
reach the scan), projections and aggregates.  Where such queries ship a list
of ids from one query into the next, ``{"$in": ids}`` also takes a one-column
DataFrame and becomes a semi join: the ids stay on the cluster.

Meaning of a condition:

* a comparison never matches null; ``None`` and ``{"$ne": x}`` do;
* on an array field a condition asks for some element (``$ne``, ``$nin`` and
  ``$not`` for none); comparing with a list compares the whole array;
* a value of another kind (a scalar field against a list) is never equal;
* ``a.b`` is the entry ``b`` of a map, or the field of a struct; ``$exists``
  asks whether a map has the key (a column is in every row).

Unknown operators, stages and fields raise.  ``$push`` raises too: ids pushed
into one array would sit in one task, so they stay rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.functions import docops as D
from marquee.operators import lookup as L


class UnknownOperator(ValueError):
    pass


def resolve(schema: T.StructType, path: str) -> tuple[Column, T.DataType, Column]:
    """A field path's column, its type, and whether the row has it."""
    name, *rest = path.split(".")
    if name not in schema.names:
        raise KeyError(f"no field {name!r} among {schema.names}")
    col, kind, has = F.col(f"`{name}`"), schema[name].dataType, F.lit(True)
    for part in rest:
        if isinstance(kind, T.MapType):
            has = F.coalesce(D.map_has_key(col, part), F.lit(False))
            col, kind = D.map_value(col, part), kind.valueType
        elif isinstance(kind, T.StructType) and part in kind.names:
            has = col.isNotNull()
            col, kind = col[part], kind[part].dataType
        else:
            raise KeyError(f"no field {part!r} in {path!r}")
    return col, kind, has


def _known(cond: Column) -> Column:
    return F.coalesce(cond, F.lit(False))


def _lit(v) -> Column:
    return F.array(*[_lit(x) for x in v]) if isinstance(v, (list, tuple)) else F.lit(v)


COMPARE: dict[str, Callable[[Column, object], Column]] = {
    "$gt": lambda c, v: c > F.lit(v), "$gte": lambda c, v: c >= F.lit(v),
    "$lt": lambda c, v: c < F.lit(v), "$lte": lambda c, v: c <= F.lit(v),
}


def _equal(c: Column, kind: T.DataType, v) -> Column:
    if v is None:
        return c.isNull()
    if isinstance(kind, T.ArrayType):
        return c == _lit(v) if isinstance(v, (list, tuple)) else D.has_element(c, v)
    return F.lit(False) if isinstance(v, (list, tuple, dict)) else c == F.lit(v)


def _among(c: Column, kind: T.DataType, values: Sequence) -> Column:
    some = [v for v in values if v is not None]
    found = D.any_element_in(c, some) if isinstance(kind, T.ArrayType) else D.in_list(c, some)
    return found | c.isNull() if len(some) < len(values) else found


def condition(c: Column, kind: T.DataType, has: Column, test) -> Column:
    """One field's condition: a value, or a dict of operators that all hold."""
    if not (isinstance(test, dict) and any(k.startswith("$") for k in test)):
        return _equal(c, kind, test)
    out = None
    for op, v in test.items():
        if op in COMPARE:
            one = F.exists(c, lambda x: COMPARE[op](x, v)) if isinstance(kind, T.ArrayType) else COMPARE[op](c, v)
        elif op == "$eq":
            one = _equal(c, kind, v)
        elif op == "$ne":
            one = ~_known(_equal(c, kind, v))
        elif op == "$in":
            one = _among(c, kind, v)
        elif op == "$nin":
            one = ~_known(_among(c, kind, v))
        elif op == "$exists":
            one = has if v else ~has
        elif op == "$not":
            one = ~_known(condition(c, kind, has, v))
        elif op == "$elemMatch":
            one = (F.exists(c, lambda x: condition(x, kind.elementType, F.lit(True), v))
                   if isinstance(kind, T.ArrayType) else F.lit(False))
        else:
            raise UnknownOperator(op)
        out = one if out is None else out & one
    return out


def matches(schema: T.StructType, where: dict) -> Column:
    """A filter document as one condition."""
    out = F.lit(True)
    first = True
    for key, test in where.items():
        if key == "$and":
            one = _fold([matches(schema, w) for w in test], lambda a, b: a & b)
        elif key in ("$or", "$nor"):
            one = _fold([_known(matches(schema, w)) for w in test], lambda a, b: a | b)
            one = ~one if key == "$nor" else one
        elif key == "$expr":
            one = expression(schema, test)
        elif key.startswith("$"):
            raise UnknownOperator(key)
        else:
            one = condition(*resolve(schema, key), test)
        out, first = (one if first else out & one), False
    return out


def _fold(conds: list[Column], join: Callable[[Column, Column], Column]) -> Column:
    if not conds:
        raise ValueError("an empty list of conditions")
    out = conds[0]
    for c in conds[1:]:
        out = join(out, c)
    return out


def expression(schema: T.StructType, e, names: dict[str, Column] | None = None) -> Column:
    """An expression: ``$field``, ``$$name``, an operator dict, or a constant.

    Equality tells null from every value, as document stores do.
    """
    names = names or {}
    sub = lambda x: expression(schema, x, names)
    if isinstance(e, str) and e.startswith("$$"):
        name, *rest = e[2:].split(".")
        c = names[name]
        for part in rest:
            c = c[part]
        return c
    if isinstance(e, str) and e.startswith("$"):
        return resolve(schema, e[1:])[0]
    if isinstance(e, (list, tuple)):
        return F.array(*[sub(x) for x in e])
    if not isinstance(e, dict):
        return F.lit(e)
    if len(e) != 1:
        raise UnknownOperator(f"an expression has one operator, not {sorted(e)}")
    [(op, v)] = e.items()
    if op == "$eq":
        return sub(v[0]).eqNullSafe(sub(v[1]))
    if op == "$ne":
        return ~sub(v[0]).eqNullSafe(sub(v[1]))
    if op in COMPARE:
        a, b = sub(v[0]), sub(v[1])
        return {"$gt": a > b, "$gte": a >= b, "$lt": a < b, "$lte": a <= b}[op]
    if op in ("$and", "$or"):
        return _fold([_known(sub(x)) for x in v], (lambda a, b: a & b) if op == "$and" else (lambda a, b: a | b))
    if op == "$not":
        return ~_known(sub(v[0] if isinstance(v, list) else v))
    if op == "$in":
        return _known(F.array_contains(sub(v[1]), sub(v[0])))
    if op == "$concat":
        return F.concat(*[sub(x) for x in v])
    if op == "$size":
        return F.size(sub(v))
    if op == "$ifNull":
        return F.coalesce(*[sub(x) for x in v])
    if op == "$cond":
        test, yes, no = v if isinstance(v, (list, tuple)) else (v["if"], v["then"], v["else"])
        return F.when(_known(sub(test)), sub(yes)).otherwise(sub(no))
    if op == "$literal":
        return _lit(v)
    if op == "$objectToArray":
        return F.transform(F.map_entries(sub(v)), lambda x: F.struct(x["key"].alias("k"), x["value"].alias("v")))
    if op == "$arrayToObject":
        return F.map_from_entries(sub(v))
    if op == "$filter":
        return F.filter(sub(v["input"]), lambda x: _known(expression(schema, v["cond"], names | {v.get("as", "this"): x})))
    if op == "$map":
        return F.transform(sub(v["input"]), lambda x: expression(schema, v["in"], names | {v.get("as", "this"): x}))
    raise UnknownOperator(op)


def match(df: DataFrame, where: dict) -> DataFrame:
    """Rows that match; ``{"field": {"$in": DataFrame}}`` at the top is a semi join."""
    joins = {k: t["$in"] for k, t in where.items() if isinstance(t, dict) and isinstance(t.get("$in"), DataFrame)}
    plain = {k: t for k, t in where.items() if k not in joins}
    plain |= {k: {op: v for op, v in where[k].items() if op != "$in"} for k in joins if len(where[k]) > 1}
    out = df.filter(matches(df.schema, plain)) if plain else df
    for key, ids in joins.items():
        if len(ids.columns) != 1:
            raise ValueError(f"$in takes one column, not {ids.columns}")
        out = L.keep_matching(out, ids.toDF(key), key)
    return out


def project(df: DataFrame, fields: dict | Sequence[str] | None) -> DataFrame:
    """``{name: 1}`` keeps, ``{name: 0}`` drops, ``{name: expression}`` computes."""
    if fields is None:
        return df
    spec = dict.fromkeys(fields, 1) if not isinstance(fields, dict) else fields
    dropped = [n for n, v in spec.items() if v in (0, False) and not isinstance(v, dict)]
    if dropped and len(dropped) == len(spec):
        return df.drop(*dropped)
    return df.select(*[(resolve(df.schema, n)[0] if v in (1, True) and not isinstance(v, (dict, str))
                        else expression(df.schema, v)).alias(n) for n, v in spec.items() if n not in dropped])


def find(df: DataFrame, where: dict | None = None, fields: dict | Sequence[str] | None = None) -> DataFrame:
    return project(match(df, where or {}), fields)


def find_one(df: DataFrame, where: dict, fields: dict | Sequence[str] | None = None, key: str = "id") -> DataFrame:
    """The matching row with the lowest key, as a DataFrame of at most one row."""
    return project(F.broadcast(L.find_one(df, matches(df.schema, where), key)), fields)


def _top(schema: T.StructType, spec: dict) -> Column:
    """The output fields of the first row in the given order (numbers; null is lowest)."""
    order = [F.coalesce(resolve(schema, n)[0].cast("double") * F.lit(float(-way)), F.lit(float("inf") * way))
             for n, way in spec["sortBy"].items()]
    paths = spec["output"] if isinstance(spec["output"], (list, tuple)) else [spec["output"]]
    return F.max_by(F.struct(*[expression(schema, p).alias(p.lstrip("$").split(".")[-1]) for p in paths]), F.struct(*order))


def accumulate(schema: T.StructType, spec: dict) -> Column:
    if len(spec) != 1:
        raise UnknownOperator(f"one accumulator, not {sorted(spec)}")
    [(op, v)] = spec.items()
    simple = {"$avg": F.avg, "$sum": F.sum, "$min": F.min, "$max": F.max}
    if op in simple:
        return simple[op](expression(schema, v))
    if op == "$count":
        return F.count(F.lit(1))
    if op == "$top":
        return _top(schema, v)
    raise UnknownOperator(op)


def group(df: DataFrame, spec: dict) -> DataFrame:
    """``_id: None`` is one group; without any row there is none."""
    by = spec["_id"]
    out = {n: accumulate(df.schema, v) for n, v in spec.items() if n != "_id"}
    columns = [c.alias(n) for n, c in out.items()]
    if by is None:
        rows = df.agg(*columns, F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > 0)
        return rows.select(F.lit(None).cast("string").alias("_id"), *out)
    key = (F.struct(*[expression(df.schema, v).alias(n) for n, v in by.items()])
           if isinstance(by, dict) and not any(k.startswith("$") for k in by) else expression(df.schema, by))
    keyed = df.groupBy(key.alias("_id"))
    return keyed.agg(*columns) if columns else keyed.agg(F.count(F.lit(1)).alias("_rows")).drop("_rows")


def unwind(df: DataFrame, spec) -> DataFrame:
    """One row per element, under the array's own name; other arrays give no row."""
    name = (spec["path"] if isinstance(spec, dict) else spec).removeprefix("$")
    return df.withColumn(name, F.explode(resolve(df.schema, name)[0]))


STAGES: dict[str, Callable[[DataFrame, object], DataFrame]] = {
    "$match": match,
    "$project": project,
    "$set": lambda df, v: df.withColumns({n: expression(df.schema, e) for n, e in v.items()}),
    "$unwind": unwind,
    "$group": group,
    "$sort": lambda df, v: df.orderBy(*[F.asc_nulls_first(n) if way > 0 else F.desc_nulls_last(n) for n, way in v.items()]),
    "$limit": lambda df, v: df.limit(v),
    "$count": lambda df, v: df.agg(F.count(F.lit(1)).alias(v)).filter(F.col(v) > 0),
}


def aggregate(df: DataFrame, stages: Sequence[dict]) -> DataFrame:
    for stage in stages:
        if len(stage) != 1 or next(iter(stage)) not in STAGES:
            raise UnknownOperator(f"stage {sorted(stage)}")
        [(op, v)] = stage.items()
        df = STAGES[op](df, v)
    return df


# -- the eight catalogue queries as documents --------------------------------

def _person(first: str, last: str) -> dict:
    return {"first_name": first, "last_name": last}


def movie_ids(t: dict[str, DataFrame], directors: DataFrame) -> DataFrame:
    return find(t["director_movies"], {"id": {"$in": directors.select("id")}}, ["movie_id"])


def ru1(t: dict[str, DataFrame], genre: str, min_rank: float) -> DataFrame:
    return find(t["movies"], {"list_genres": genre, "rank": {"$gt": min_rank}}, {"name": 1, "rank": 1})


def ru2(t: dict[str, DataFrame], genre: str) -> DataFrame:
    return find(t["directors"], {f"dict_genres_den_prob.{genre}": {"$exists": True, "$ne": [None, 0]}},
                {"first_name": 1, "last_name": 1})


def ru2_strict(t: dict[str, DataFrame], genre: str) -> DataFrame:
    return find(t["directors"], {f"dict_genres_den_prob.{genre}": {"$exists": True, "$nin": [None, 0]}},
                {"first_name": 1, "last_name": 1})


def ru3(t: dict[str, DataFrame], genre: str, year: int) -> DataFrame:
    return find(t["movies"], {"list_genres": genre, "year": year}, {"name": 1})


def ru4(t: dict[str, DataFrame], first: str, last: str, genre: str) -> DataFrame:
    one = find_one(t["directors"], _person(first, last), ["id"])
    return find(t["movies"], {"id": {"$in": movie_ids(t, one)}, "list_genres": genre}, ["id", "name", "year", "rank"])


def rda1(t: dict[str, DataFrame], first: str, last: str) -> DataFrame:
    one = find_one(t["directors"], _person(first, last), ["id"])
    return aggregate(t["movies"], [
        {"$match": {"id": {"$in": movie_ids(t, one)}, "rank": {"$ne": None}}},
        {"$group": {"_id": None, "average_rank": {"$avg": "$rank"}}},
        {"$project": {"average_rank": 1}}])


def rda2(t: dict[str, DataFrame], n_genres: int) -> DataFrame:
    real = {"$and": [{"$ne": ["$$g.v", None]}, {"$ne": ["$$g.v", 0.0]}]}
    entries = {"$filter": {"input": {"$objectToArray": "$dict_genres_den_prob"}, "as": "g", "cond": real}}
    return aggregate(t["directors"], [
        {"$project": {"first_name": 1, "last_name": 1, "kept": entries}},
        {"$match": {"kept": {"$ne": None}, "$expr": {"$eq": [{"$size": "$kept"}, n_genres]}}},
        {"$project": {"first_name": 1, "last_name": 1}}])


def rda3(t: dict[str, DataFrame], max_actors: int, min_rank: float) -> DataFrame:
    return find(t["movies"], {"den_nb_actors": {"$lt": max_actors}, "rank": {"$gt": min_rank}}, {"name": 1})


def rda4(t: dict[str, DataFrame], names: Sequence[str]) -> DataFrame:
    chosen = aggregate(t["directors"], [
        {"$project": {"id": 1, "full_name": {"$concat": ["$first_name", " ", "$last_name"]}}},
        {"$match": {"full_name": {"$in": list(names)}}}])
    return aggregate(t["movies"], [
        {"$match": {"id": {"$in": movie_ids(t, chosen)}}},
        {"$unwind": "$list_genres"},
        {"$group": {"_id": "$list_genres",
                    "best": {"$top": {"output": ["$name", "$rank"], "sortBy": {"rank": -1, "id": 1}}}}},
        {"$project": {"genre": "$_id", "best_name": "$best.name", "best_rank": "$best.rank"}}])
