"""Lookups: find-one and "ids from query A drive query B" as joins.

The reference pulls ids to the client and sends them back inside a second
query.  Here the ids never leave the cluster: they stay a DataFrame and the
second step is a ``left_semi`` join, which Spark runs as a broadcast or a
sort-merge join depending on the runtime size AQE sees.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def find_one(df: DataFrame, cond: Column, key: str = "id") -> DataFrame:
    """The matching row with the lowest key (0 or 1 row).

    ``orderBy().limit(1)`` plans as TakeOrderedAndProject: a top-1 per
    partition and a merge of one row per partition, never a full sort.
    """
    return df.filter(cond).orderBy(F.col(key).asc_nulls_last()).limit(1)


def one_key(df: DataFrame, cond: Column, key: str = "id") -> DataFrame:
    """The key of ``find_one`` as a one-column DataFrame of at most one row.

    Its size is bounded (one row), so broadcasting it is always safe.
    """
    return F.broadcast(find_one(df.select(key, *[c for c in df.columns if c != key]),
                                cond, key).select(key))


def keep_matching(df: DataFrame, keys: DataFrame, on: str = "id") -> DataFrame:
    """Rows of ``df`` whose key is in ``keys`` (a semi join).

    Duplicates in ``keys`` do not multiply rows.  No hint: ``keys`` may be a
    third of a table (a prolific director), so AQE picks the strategy.
    """
    return df.join(keys, on, "left_semi")


def unwind(df: DataFrame, arr: str, alias: str) -> DataFrame:
    """one row per array element; empty and null arrays give no row."""
    return df.select(F.explode(arr).alias(alias))
