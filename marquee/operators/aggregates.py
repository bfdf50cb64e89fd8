"""Grouped and global aggregates of the catalogue queries and reports.

All of them are declarative aggregates with a partial (map-side) step, so a
group holding a third of the rows (one genre, one director) is combined per
map task before the shuffle and never lands whole in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.functions.docops import percent_label

NEG_INF = float("-inf")


def top_per_group(df: DataFrame, group: str, fields: list[str], rank: str = "rank",
                  key: str = "id", prefix: str = "best_") -> DataFrame:
    """Per group, the fields of the row with the best rank; ranked rows
    beat unranked ones, ties go to the lowest key (D8).

    One pass over ``df``: Spark cuts each task's rows to one per group before
    the shuffle (a window group limit), so a hot group moves one row per task.
    """
    first = Window.partitionBy(group).orderBy(F.col(rank).desc_nulls_last(), F.col(key))
    return (df.select(group, key, rank, *[f for f in fields if f != rank])
            .withColumn("_place", F.row_number().over(first)).filter(F.col("_place") == 1)
            .select(group, *[F.col(f).alias(prefix + f) for f in fields]))


def best_state(rank: Column, key: Column, *fields: Column) -> Column:
    """A8 as a state that merges: the best row's rank, key and fields.  States
    of disjoint sets of rows give the state of their union by ``merge_best``."""
    order = F.struct(F.coalesce(rank, F.lit(NEG_INF)), -key)
    return F.max_by(F.struct(rank.alias("rank"), key.alias("key"), *fields), order)


def merge_best(state: str) -> Column:
    return best_state(F.col(f"{state}.rank"), F.col(f"{state}.key"), F.col(f"{state}.name").alias("name"))


def max_or_neg_inf(c: str) -> Column:
    """A9 with F25: maximum with null replaced by negative infinity."""
    return F.max(F.coalesce(F.col(c), F.lit(NEG_INF)))


def global_avg(df: DataFrame, c: str, out: str) -> DataFrame:
    """A5 with D7: one row with the mean, or no row when nothing matched."""
    return (df.agg(F.avg(c).alias(out), F.count(F.lit(1)).alias("_n"))
            .filter(F.col("_n") > 0).select(out))


def trimmed_mean(c: str) -> Column:
    """Drop one maximum and one minimum, average the rest.

    Expressed with sum/max/min/count so it is one partial aggregate; null
    when two values or fewer are present.
    """
    x = F.col(c)
    n = F.count(x)
    return F.when(n > 2, (F.sum(x) - F.max(x) - F.min(x)) / (n - 2))


def share(df: DataFrame, pred: Column) -> DataFrame:
    """Rows matching ``pred`` against the rest, in one pass.

    The total is counted, not taken from a constant.
    """
    agg = df.agg(F.count_if(pred).alias("matched"), F.count(F.lit(1)).alias("total"))
    pct = F.when(F.col("total") > 0, F.col("matched") * F.lit(100.0) / F.col("total"))
    return agg.select(
        "matched", (F.col("total") - F.col("matched")).alias("other"), "total",
        pct.alias("pct_matched"),
        percent_label(pct).alias("pct_label"),
    )
