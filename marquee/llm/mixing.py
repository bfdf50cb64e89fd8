"""Mixing sources to target weights along a curriculum (DataFrame functions only).

Every source has a weight schedule over training time t in [0, 1],
``w(t) = q * (1 + ramp * (2 t - 1))``.  Its integral over [0, 1] is the
source's quota q of words; its integral up to t is the cumulative demand
``q * ((1 - ramp) t + ramp t^2)``.  The source's documents form a stream in
hash order, repeated pass after pass; a copy that starts after c words of the
stream is trained on when the demand reaches c, so its position is the inverse
of the demand at c.  Range-sorting the copies by position gives the training
order.  The stream is cut where the quota ends: the last copy is taken in
part, so a source's words meet its quota exactly (``whole=True`` instead takes
that copy whole when at least half of it is due).

Targets: sources in code point order, null last, weigh ``weights`` in turn and
share ``share`` times all words; a target stops at ``max_repeats`` times its
source's words and the excess is shared again by weight.  That fixed point is
found without iterating: with sources sorted by cap / weight, the first k are
at their cap and the rest get ``level * weight``.

Running sums never put a source into one task: a source's stream is split in
4096 blocks by its hash order, block totals (at most 4096 per source) are
summed by window, and each block numbers its own documents.

Defined cases: null or empty text has size 0 and is taken 0 times; a source
without words has target 0; null doc_id and null source are values of their
own; repeated rows are separate documents; texts of any length count whole; an
empty table gives no rows; input
columns named like an added one are replaced by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marquee.llm import common

WEIGHTS = (3, 1, 2)
RAMPS = (-0.5, 0.5, 0.0)     # by the same turn: falling, rising, level
SHARE = 1.5
MAX_REPEATS = 2
ADDED = ["size", "source_size", "target", "taken", "draws"]


def targets(blocks: DataFrame, weights=WEIGHTS, ramps=RAMPS, share: float = SHARE,
            max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(_skey, source_size, target, quota, ramp) per source.

    The windows without a partition run over one row per source.
    """
    per = (blocks.groupBy("_skey").agg(F.first("_source").alias("_source"),
                                       F.sum("_block_size").alias("source_size"))
           .withColumn("_turn", F.pmod(F.row_number().over(
               Window.orderBy(F.col("_source").asc_nulls_last())) - F.lit(1), F.lit(len(weights))).cast("int")))
    pick = lambda values, kind: F.element_at(
        F.array(*[F.lit(v).cast(kind) for v in values]), F.col("_turn") + F.lit(1))
    per = (per.withColumn("_w", pick(weights, "double")).withColumn("ramp", pick(ramps, "double"))
           .withColumn("_cap", (F.col("source_size") * F.lit(max_repeats)).cast("double")))
    order = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("_source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = F.lit(share) * F.sum("source_size").over(Window.partitionBy(F.lit(1)))
    per = per.withColumn("_level", (total - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
                         / F.sum("_w").over(after))
    # the first source that its level does not fill to the cap: it and all later ones get that level
    open_level = F.when(F.col("_level") <= F.col("_cap") / F.col("_w"), F.col("_level"))
    per = per.withColumn("_level", F.first(open_level, ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    per = per.withColumn("target", F.least(F.col("_cap"),
                                           F.coalesce(F.col("_level") * F.col("_w"), F.col("_cap"))))
    return per.select("_skey", "source_size", "target",
                      F.floor(F.col("target") + F.lit(0.5)).cast("long").alias("_quota"), "ramp")


def position(done: Column, quota: Column, ramp: Column) -> Column:
    """t at which the cumulative demand of a source reaches ``done`` words."""
    u = done / quota
    a = F.lit(1.0) - ramp
    den = a + F.sqrt(a * a + F.lit(4.0) * ramp * u)
    return F.when(den > 0, F.least(F.lit(1.0), F.lit(2.0) * u / den)).otherwise(F.lit(0.0))


def mix(docs: DataFrame, weights=WEIGHTS, ramps=RAMPS, share: float = SHARE,
        max_repeats: int = MAX_REPEATS, whole: bool = False,
        carry: list[str] | None = None) -> DataFrame:
    """One row per document: ``carry`` columns, size, source_size, target,
    taken and ``draws``, the copies it contributes as (copy, words, position)."""
    docs = common.drop_clashes(docs, ADDED)
    carry = [c for c in (carry or docs.columns) if c in docs.columns]
    rows = docs.select(
        *[F.col(f"`{c}`") for c in carry],
        common.key_text(F.col("source")).alias("_skey"), F.col("source").alias("_source"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")).alias("_h"),
        F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_tie"),
        common.word_count(F.col("text")).alias("size"),
    ).withColumn("_block", F.substring("_h", 1, 3))
    if "text" not in carry:                       # narrow rows: count words once
        rows = common.materialize(rows, "mix-rows")
    blocks = common.materialize(
        rows.groupBy("_skey", "_block").agg(F.first("_source").alias("_source"),
                                            F.sum("size").alias("_block_size")), "mix-blocks")
    per = targets(blocks, weights, ramps, share, max_repeats)
    before = (Window.partitionBy("_skey").orderBy("_block")
              .rowsBetween(Window.unboundedPreceding, -1))
    offsets = (blocks.withColumn("_offset", F.coalesce(F.sum("_block_size").over(before), F.lit(0)))
               .select("_skey", "_block", "_offset").join(per, "_skey"))
    in_block = (Window.partitionBy("_skey", "_block").orderBy("_h", "_id", "size", "_tie")
                .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = (rows.join(offsets, ["_skey", "_block"])
              .withColumn("_start", F.col("_offset") + F.sum("size").over(in_block) - F.col("size")))

    def draw(p: int) -> Column:
        start = F.col("_start") + F.lit(p) * F.col("source_size")
        due = F.greatest(F.lit(0), F.least(F.col("size"), F.col("_quota") - start)).cast("long")
        words = F.when(due * F.lit(2) >= F.col("size"), F.col("size")).otherwise(F.lit(0)).cast("long") if whole else due
        return F.struct(F.lit(p).alias("copy"), words.alias("words"),
                        position(start.cast("double"), F.col("_quota").cast("double"), F.col("ramp")).alias("position"))

    draws = F.filter(F.array(*[draw(p) for p in range(max_repeats)]), lambda d: d["words"] > 0)
    placed = placed.withColumn("draws", draws)
    taken = F.aggregate("draws", F.lit(0).cast("long"), lambda acc, d: acc + d["words"])
    return placed.select(*[F.col(f"`{c}`") for c in carry], "size", "source_size", "target",
                         taken.alias("taken"), "draws")


def training_order(mixed: DataFrame) -> DataFrame:
    """One row per copy, range-partitioned and sorted by position."""
    copies = mixed.withColumn("_d", F.explode("draws"))
    copies = copies.select(*[F.col(f"`{c}`") for c in mixed.columns if c != "draws"],
                           F.col("_d.copy").alias("copy"), F.col("_d.words").alias("words"),
                           F.col("_d.position").alias("position"))
    return (copies.repartitionByRange("position", "doc_id", "copy")
            .sortWithinPartitions("position", "doc_id", "copy"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(common.table(spark, sf_dir, "documents"), carry=["doc_id"])
    first, last = F.get("draws", F.lit(0))["position"], F.get("draws", F.size("draws") - F.lit(1))["position"]
    place = lambda t: F.coalesce(F.floor(t * F.lit(1e6)), F.lit(-1)).cast("long")
    digest = mixed.select("doc_id", "size", "source_size", "target", "taken",
                          place(first).alias("first_position"),
                          place(last).alias("last_position"))
    return (digest.repartitionByRange("first_position", "doc_id")
            .sortWithinPartitions("first_position", "doc_id"))


MIXING_SQL = r"""
with sized as (
  select doc_id, source, md5(coalesce(cast(doc_id as varchar), '')) h,
         cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) size
  from documents),
per as (
  select source, cast(sum(size) as bigint) source_size,
         (row_number() over (order by source nulls last) - 1) % 3 turn
  from sized group by source),
w as (
  select *, [3.0, 1.0, 2.0][turn + 1]::double w, [-0.5, 0.5, 0.0][turn + 1]::double ramp,
         (2 * source_size)::double cap from per),
lv as (
  select *, (1.5::double * sum(source_size) over () -
             coalesce(sum(cap) over (order by cap / w, source nulls last
                                     rows between unbounded preceding and 1 preceding), 0)) /
            sum(w) over (order by cap / w, source nulls last
                         rows between current row and unbounded following) lvl
  from w),
one as (
  select lvl from lv where lvl <= cap / w order by cap / w, source nulls last limit 1),
tg as (
  select source, source_size, ramp,
         least(cap, coalesce((select lvl from one) * w, cap)) target from lv),
st as (
  select s.doc_id, s.size, t.source_size, t.target, t.ramp,
         cast(floor(t.target + 0.5) as bigint) quota,
         cast(sum(s.size) over (partition by s.source order by s.h, s.doc_id, s.size
                                rows between unbounded preceding and current row) as bigint) - s.size st
  from sized s join tg t on s.source is not distinct from t.source),
dr as (
  select *, greatest(0, least(size, quota - st)) d0,
         greatest(0, least(size, quota - st - source_size)) d1 from st),
ps as (
  select *, case when d0 > 0 then st when d1 > 0 then st + source_size end f,
         case when d1 > 0 then st + source_size when d0 > 0 then st end l from dr)
select doc_id, size, source_size, target, cast(d0 + d1 as bigint) taken,
  cast(case when f is not null then floor(least(1.0::double, 2.0::double * (f::double / quota::double) /
    ((1.0::double - ramp) + sqrt((1.0::double - ramp) * (1.0::double - ramp) + 4.0::double * ramp * (f::double / quota::double)))) * 1e6) else -1 end as bigint) first_position,
  cast(case when l is not null then floor(least(1.0::double, 2.0::double * (l::double / quota::double) /
    ((1.0::double - ramp) + sqrt((1.0::double - ramp) * (1.0::double - ramp) + 4.0::double * ramp * (l::double / quota::double)))) * 1e6) else -1 end as bigint) last_position
from ps
"""
