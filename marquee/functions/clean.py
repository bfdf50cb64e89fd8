"""Typing and cleaning of text columns.

Two modes, both built-in expressions (no UDF):

* lenient: ``try_cast``; text that is not a number becomes null, as a
  convert-with-onError-null does.  '3.7' to int is null; an array element that
  does not parse becomes a null element.
* strict: ``cast`` under ANSI mode, which raises on bad input, as a strict
  to-int / to-double conversion does.

NaN is turned into null wherever a double is produced (D1): Spark orders NaN
above every number, so ``rank > 8`` and ``max(rank)`` would otherwise pick it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee import schemas


def nan_to_null(c: Column) -> Column:
    """NaN becomes null; null and numbers pass through."""
    return F.when(~F.isnan(c), c)


# A number as text: digits with at most one point and an exponent, or an
# infinity.  Type suffixes that a cast would take ("3d", "2.5f") are no numbers.
NUMBER = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[iI]nf(inity)?)\s*$"
NUMERIC = ("double", "float", "bigint", "int", "long", "smallint", "tinyint")


def numeric_text(c: Column) -> Column:
    """The column where its text is a number, else null."""
    return F.when(c.cast("string").rlike(NUMBER), c)


def lenient(c: Column, to: str) -> Column:
    """Null on null and on text that does not parse."""
    out = (numeric_text(c) if to in NUMERIC else c).try_cast(to)
    if to in ("double", "float"):
        out = nan_to_null(out)
    return out


def strict(c: Column, to: str) -> Column:
    """ANSI cast; raises on text that does not parse."""
    out = c.cast(to)
    if to in ("double", "float"):
        out = nan_to_null(out)
    return out


def with_sentinel(c: Column, sentinel: int = -1) -> Column:
    """replace a missing value by a sentinel."""
    return F.coalesce(c, F.lit(sentinel))


def type_table(df: DataFrame, table: str, mode: str = "lenient") -> DataFrame:
    """Cast the text columns of a source table to their typed target."""
    conv = lenient if mode == "lenient" else strict
    types = schemas.SOURCE_TYPES[table]
    return df.withColumns({c: conv(F.col(c), t) for c, t in types.items()})


def clean_numeric(df: DataFrame, rank: str = "rank", year: str = "year") -> DataFrame:
    """Cleaned load of movies (SRV step): rank parsed to double (NaN to null),
    year parsed to a nullable int.  Works on text or on numeric columns."""
    r = numeric_text(F.col(rank).cast("string")).try_cast("double")
    y = numeric_text(F.col(year).cast("string")).try_cast("double")
    return df.withColumns({
        rank: nan_to_null(r),
        # to_numeric then Int64: a whole number keeps its value, else null
        year: F.when(y == F.floor(y), y.try_cast("int")),
    })


def clean_sentinel(df: DataFrame, year: str = "year", sentinel: int = -1) -> DataFrame:
    """Cleaned load, then unknown years replaced by the sentinel."""
    return clean_numeric(df, year=year).withColumn(year, with_sentinel(F.col(year), sentinel))


def fix_types(df: DataFrame, spec: dict[str, str], mode: str = "lenient") -> DataFrame:
    """Type repair of a whole document table.

    ``spec`` maps a column to a target: a scalar type (``int``, ``double``),
    ``array<int>`` (element-wise, as a map over the array) or
    ``map<string,double>`` (every value converted, keys kept).  The result is
    a new DataFrame; write it to a new path, never over its own input.
    """
    conv = lenient if mode == "lenient" else strict

    # higher-order functions read the lambda's arity, so bind the target type
    # in a closure rather than as a default argument
    def on_element(t):
        return lambda e: conv(e, t)

    def on_value(t):
        return lambda _k, v: conv(v, t)

    cols = {}
    for name, to in spec.items():
        c = F.col(name)
        if to.startswith("array<"):
            cols[name] = F.transform(c, on_element(to[len("array<"):-1]))
        elif to.startswith("map<"):
            cols[name] = F.transform_values(c, on_value(to[len("map<"):-1].split(",")[1].strip()))
        else:
            cols[name] = conv(c, to)
    return df.withColumns(cols)
