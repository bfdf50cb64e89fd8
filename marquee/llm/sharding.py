"""Sharding by fixed virtual slots (DataFrame functions only).

Records hash into a fixed number of virtual slots (thousands).  Bytes are
summed per slot, and a versioned slot-to-shard map says where each slot lives.
Only the map changes when shards are added or rebalanced; a record's slot never
does.

* The record's hash is that of its text, so equal texts share a slot, hence a
  shard.  A text whose copies hold more than a shard's part of all bytes makes
  its shard larger than the others: it is not split.
* The map is made from one row per slot (``n_slots`` rows at any input size):
  largest slot first, each to the shard with the fewest bytes so far.  That
  loop runs over the bounded slot table, not over records.
* A record's place inside its shard is the slot's base (a running sum over the
  slot table), plus its block's (a slot is cut into blocks of about
  ``BLOCK_ROWS`` rows by a hash of the row's number, so copies of one text
  spread over tasks), plus its rank inside the block.

Defined cases: null text counts as empty (size 1, crc 0) and shares the empty
text's shard; null doc_id is a value of its own; repeated rows each get a
place; very long texts are hashed whole, and only their hash moves; an empty
table gives no rows and a map whose slots hold no bytes; input columns named
like an added one are replaced by it.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marquee.llm import common

N_SLOTS = 4096
N_SHARDS = 16
BLOCK_ROWS = 50_000
ADDED = ["size", "text_crc32", "law", "shard", "slot", "grown_shard", "virtual_slot", "map_version"]
MAP_SCHEMA = "version int, virtual_slot int, slot_bytes long, shard int"


def sized(docs: DataFrame, carry: list[str]) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        *carry,
        (F.octet_length(text).cast("long") + F.lit(1)).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("_text_hash"),
    )


def assign_slots(records: DataFrame, n_slots: int) -> DataFrame:
    """``records`` with ``virtual_slot``, the text's own."""
    return records.withColumn("virtual_slot", F.pmod("_text_hash", F.lit(n_slots)).cast("int"))


def slot_bytes(records: DataFrame) -> DataFrame:
    return records.groupBy("virtual_slot").agg(F.sum("size").alias("slot_bytes"),
                                               F.count(F.lit(1)).alias("slot_rows"))


def balance(sizes: dict[int, int], n_slots: int, n_shards: int) -> dict[int, int]:
    """Slot -> shard: largest slot first, each to the lightest shard."""
    heap = [(0, s) for s in range(n_shards)]
    out = {}
    for slot in sorted(range(n_slots), key=lambda s: (-sizes.get(s, 0), s)):
        load, shard = heapq.heappop(heap)
        out[slot] = shard
        heapq.heappush(heap, (load + sizes.get(slot, 0), shard))
    return out


def first_map(spark: SparkSession, sizes: dict[int, int], n_slots: int = N_SLOTS,
              n_shards: int = N_SHARDS) -> DataFrame:
    """Version 1 of the slot-to-shard map: ``n_slots`` rows."""
    shard_of = balance(sizes, n_slots, n_shards)
    rows = [(1, s, sizes.get(s, 0), shard_of[s]) for s in range(n_slots)]
    return spark.createDataFrame(rows, MAP_SCHEMA)


def latest(maps: DataFrame) -> DataFrame:
    v = maps.agg(F.max("version").alias("version"))
    return maps.join(F.broadcast(v), "version")


def rebalance(maps: DataFrame, n_shards: int, sizes: dict[int, int] | None = None) -> DataFrame:
    """A map edited for ``n_shards``: the next version, appended to ``maps``.

    Slots move only from shards above the new mean to shards below it (or out
    of shards that no longer exist), heaviest movable slot first, so the edit
    moves few bytes.  ``sizes`` gives the bytes per slot as they are now.
    """
    rows = latest(maps).collect()          # one row per slot: n_slots rows
    bytes_of = {r.virtual_slot: (sizes or {}).get(r.virtual_slot, r.slot_bytes) if sizes is not None
                else r.slot_bytes for r in rows}
    shard_of = {r.virtual_slot: r.shard for r in rows}
    load = [0] * n_shards
    for slot, shard in shard_of.items():
        if shard < n_shards:
            load[shard] += bytes_of[slot]
    mean = sum(bytes_of.values()) / n_shards
    heap = [(b, s) for s, b in enumerate(load)]
    heapq.heapify(heap)

    def to_lightest(slot: int) -> None:
        b, s = heapq.heappop(heap)
        load[s] = b + bytes_of[slot]
        shard_of[slot] = s
        heapq.heappush(heap, (load[s], s))

    for slot in sorted(shard_of, key=lambda s: (-bytes_of[s], s)):
        if shard_of[slot] >= n_shards:
            to_lightest(slot)
    for slot in sorted(shard_of, key=lambda s: (-bytes_of[s], s)):
        src = shard_of[slot]
        while heap[0][0] != load[heap[0][1]]:
            heapq.heapreplace(heap, (load[heap[0][1]], heap[0][1]))
        lightest = heap[0][1]
        if (bytes_of[slot] and load[src] - bytes_of[slot] >= mean
                and load[lightest] + bytes_of[slot] <= mean):
            load[src] -= bytes_of[slot]
            to_lightest(slot)
    version = rows[0].version + 1
    edited = [(version, s, bytes_of[s], shard_of[s]) for s in sorted(shard_of)]
    return maps.unionByName(maps.sparkSession.createDataFrame(edited, MAP_SCHEMA))


def shard(docs: DataFrame, n_shards: int = N_SHARDS, n_slots: int = N_SLOTS,
          carry: list[str] | None = None, maps: DataFrame | None = None) -> DataFrame:
    """``carry`` columns of ``docs`` plus size, text_crc32, law, shard, slot
    (place inside the shard), grown_shard, virtual_slot and map_version.

    ``maps`` is a stored versioned map (its latest version is used); without
    one, version 1 is made from the bytes per slot and stored.
    """
    spark = docs.sparkSession
    docs = common.drop_clashes(docs, [c for c in ADDED + ["_text_hash", "_row", "_block"] if c != "text"])
    carry = [c for c in (carry or docs.columns) if c in docs.columns]
    if "doc_id" not in carry:
        carry = ["doc_id", *carry]
    # stored with the row's number: equal rows are told apart by it alone
    records = common.materialize(sized(docs, carry).withColumn("_row", F.monotonically_increasing_id()), "shard-records")
    slotted = assign_slots(records, n_slots)
    per_slot = common.materialize(slot_bytes(slotted), "slot-bytes")
    if maps is None:
        sizes = {r.virtual_slot: r.slot_bytes for r in per_slot.collect()}   # at most n_slots rows
        maps = common.materialize(first_map(spark, sizes, n_slots, n_shards), "slot-map")
    current = latest(maps).select("virtual_slot", F.col("version").alias("map_version"), "shard")
    base = (current.join(per_slot, "virtual_slot", "left")
            .withColumn("_base", F.coalesce(F.sum("slot_rows").over(
                Window.partitionBy("shard").orderBy("virtual_slot")
                .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
            .select("virtual_slot", "map_version", "shard", "_base"))
    blocks = per_slot.select("virtual_slot", F.ceil(F.col("slot_rows") / BLOCK_ROWS).alias("_blocks"))
    tagged = (slotted.join(F.broadcast(blocks), "virtual_slot")            # n_slots rows
              .withColumn("_block", F.pmod(F.xxhash64("_row"), F.col("_blocks"))).drop("_blocks"))
    before = (Window.partitionBy("virtual_slot").orderBy("_block")        # one row per block of BLOCK_ROWS rows
              .rowsBetween(Window.unboundedPreceding, -1))
    counts = (tagged.groupBy("virtual_slot", "_block").agg(F.count(F.lit(1)).alias("_n"))
              .select("virtual_slot", "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")))
    in_block = Window.partitionBy("virtual_slot", "_block").orderBy("doc_id", "text_crc32", "size", "_row")
    placed = (tagged.join(counts, ["virtual_slot", "_block"])
              .withColumn("_rank", F.col("_before") + F.row_number().over(in_block))
              .join(F.broadcast(base), "virtual_slot"))                    # n_slots rows
    return placed.select(
        *carry, "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("_base") + F.col("_rank") - F.lit(1)).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "map_version")


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(common.table(spark, sf_dir, "documents"), carry=["doc_id"])
