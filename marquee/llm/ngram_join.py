"""Near-duplicate documents by Jaccard similarity of word shingles, exactly.

1. A text becomes the sorted array of its distinct shingle hashes (64 bit) and
   a bitmap signature: one bit a shingle, SIGNATURE_BITS bits per shingle or more.
   Documents with equal arrays are one node.
2. Two sets with similarity t or more share at least one of their first
   ``n - ceil(t n) + 1`` shingles in any common order.  The order is rarest
   first, by how often a shingle's hash bucket occurs in the whole corpus (a
   histogram of fixed size), so passages that many documents share come last.
3. A node enters one tile per such shingle and size band (powers of two; near
   the upper end also the next band).  Of a similar pair, the smaller set's
   first common shingle lies in a shorter prefix still; those entries are
   marked core, and a pair counts only where its smaller set is core.  Tiles
   with one node or no core entry vanish in an aggregate that combines before
   its shuffle, and tiles with the same nodes become one.
4. Candidates of a tile are never all its pairs.  First each node meets one
   leader, the least node of the tiles it shares most; links found so are
   closed to components.  What is left are tiles that hold several
   components: there the nodes outside the tile's largest component meet all
   its nodes, in blocks of bounded size, where a block first gives only a
   spanning forest of its candidate pairs, best bound first.  Once those links
   are closed too, the pairs between components that still differ follow.
5. A candidate pair must pass the size ratio and the bitmaps (a bit that only
   one has is a shingle the other lacks, which bounds the overlap from above)
   before the arrays themselves are intersected.  Only nodes in such pairs
   have their texts read again.

Every pair at or above the similarity is either verified or joins nodes that
verified links already connect, so components are exact.

Defined cases: null, empty and blank texts have an empty set and link with
nothing; repeated rows and equal texts share a component; a null doc_id takes
part but is never a component's id unless alone (then the id is null); an empty
table gives no rows; texts of any length give all their shingles; input columns
named like an added one are replaced by it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import common
from marquee.llm.components import components

BUCKET_BITS = 18                       # of the corpus histogram: 2 MB at any input size
HISTOGRAM_PARTS = 64
CACHE_WORDS = 1 << 18
SIGNATURE_BITS = 3                     # per shingle, rounded up to a power of two in all
BLOCK = 512                            # nodes a side of a tile block
BROADCAST_IDS = 1_000_000              # doc_ids (8 MB) up to which a re-read is filtered by broadcast
ADDED = ["n_shingles", "component_id", "node"]
MIX = np.uint64(0x9E3779B97F4A7C15)


def mixed(h: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over 64 bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Shingler:
    """Texts to sorted arrays of distinct shingle hashes."""

    def __init__(self, k: int):
        self.k, self.words = k, {}
        # one odd factor per place in a shingle, and one salt per length of a short text
        self.factors = mixed(np.arange(1, k + 1, dtype=np.uint64) * MIX) | np.uint64(1)
        self.salts = mixed(np.arange(101, 102 + k, dtype=np.uint64) * MIX)

    def word(self, w: bytes) -> bytes:
        if len(self.words) >= CACHE_WORDS:
            self.words.clear()
        h = self.words[w] = xxhash.xxh3_64_digest(w)
        return h

    def __call__(self, text: bytes | None) -> np.ndarray:
        words = (text or b"").lower().split()            # bytes: A-Z and ASCII space only
        get, word = self.words.get, self.word
        h = np.frombuffer(b"".join([get(w) or word(w) for w in words]), np.uint64)
        if not len(h):
            return h
        k = min(self.k, len(h))                          # a short text is one shingle of its own length
        n = len(h) - k + 1
        out = np.full(n, self.salts[k], dtype=np.uint64)
        for i in range(k):
            out += self.factors[i] * h[i:n + i]
        return np.unique(mixed(out))


def signature_bits(n: int) -> int:
    return max(64, 1 << int(SIGNATURE_BITS * n - 1).bit_length())


def signature(s: np.ndarray) -> bytes:
    bits = signature_bits(len(s))
    b = np.zeros(bits, dtype=np.uint8)
    b[(s & np.uint64(bits - 1)).astype(np.int64)] = 1
    return np.packbits(b, bitorder="little").tobytes()


def fold(b: np.ndarray, size: int) -> np.ndarray:
    """Signatures (rows of bytes) folded to ``size`` bytes."""
    return np.bitwise_or.reduce(b.reshape(len(b), -1, size), axis=1)


def texts(batch: pa.RecordBatch, i: int = 0) -> Iterator[bytes | None]:
    return (x.as_py() for x in batch.column(i).cast(pa.binary()))


def bucket_counts(k: int):
    """Per task: the histogram of its shingles over hash buckets, in parts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, n = Shingler(k), np.zeros(1 << BUCKET_BITS, dtype=np.int64)
        for b in batches:
            sets = [shingles(x) for x in texts(b)]
            if sets:
                n += np.bincount((np.concatenate(sets) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64),
                                 minlength=len(n))
        parts = n.reshape(HISTOGRAM_PARTS, -1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(HISTOGRAM_PARTS), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())],
            ["part", "counts"])
    return run


def add_counts(t: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x.as_py(), np.int64) for x in t.column("counts"))
    return pa.table({"part": t.column("part")[:1], "counts": pa.array([total.tobytes()], pa.binary())})


def corpus_order(docs: DataFrame, k: int) -> np.ndarray:
    """Rank of every hash bucket, rarest first (4 bytes a bucket)."""
    rows = (docs.select("text").mapInArrow(bucket_counts(k), "part int, counts binary")
            .groupBy("part").applyInArrow(add_counts, "part int, counts binary").collect())
    n = np.concatenate([np.frombuffer(r.counts, np.int64) for r in sorted(rows, key=lambda r: r.part)] or
                       [np.zeros(1 << BUCKET_BITS, np.int64)])
    rank = np.empty(len(n), dtype=np.int32)
    rank[np.argsort(n, kind="stable")] = np.arange(len(n), dtype=np.int32)
    return rank


def prefix(s: np.ndarray, rank: np.ndarray, percent: int) -> tuple[np.ndarray, int]:
    """The shingles of which a similar set must have one, and how many of them
    are core: where the other set is no smaller, it must have one of these."""
    n = len(s)
    order = np.lexsort((s, rank[(s >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)]))
    return s[order[:n + percent * -n // 100 + 1]], n + 2 * percent * -n // (100 + percent) + 1


def tiles_of(s: np.ndarray, rank: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Tile keys (a prefix shingle and a size band): core ones and others."""
    (p, core), band = prefix(s, rank, percent), len(s).bit_length()
    in_band = lambda b: mixed(p + np.uint64(b * int(MIX) & 0xFFFFFFFFFFFFFFFF)).view(np.int64)
    own = in_band(band)
    if 100 * len(s) < percent << band:                   # no similar set is in the next band
        return own[:core], own[core:]
    up = in_band(band + 1)
    return np.concatenate([own[:core], up[:core]]), np.concatenate([own[core:], up[core:]])


SET_SCHEMA = ("doc_id long, _row long, n_shingles long, node long, signature binary, "
              "core array<long>, rest array<long>")
ROWS_OUT = 2000                         # described documents a batch


def describe(k: int, percent: int, order):
    """Rows (doc_id, _row, text) to their set's description.  Tiles and
    signature are given once per node and task: copies only name their node."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, rank, done = Shingler(k), order.value, set()
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_OUT):
                b = whole.slice(at, ROWS_OUT)
                n, node, sig, core, rest = [], [], [], [], []
                for x in texts(b, 2):
                    s = shingles(x)
                    n.append(len(s))
                    h = xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63) if len(s) else None
                    node.append(h)
                    new = h is not None and h not in done
                    if new:
                        if len(done) >= CACHE_WORDS:
                            done.clear()
                        done.add(h)
                    sig.append(signature(s) if new else None)
                    c, r = tiles_of(s, rank, percent) if new else (None, None)
                    core.append(c)
                    rest.append(r)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(node, pa.int64()),
                     pa.array(sig, pa.binary()), pa.array(core, pa.list_(pa.int64())),
                     pa.array(rest, pa.list_(pa.int64()))],
                    ["doc_id", "_row", "n_shingles", "node", "signature", "core", "rest"])
    return run


def may_match(percent: int):
    """Pairs (.., n_a, sig_a, n_b, sig_b) that sizes and bitmaps allow."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            na, nb = (b.column(c).to_numpy(zero_copy_only=False) for c in ("n_a", "n_b"))
            ok = 100 * np.minimum(na, nb) >= percent * np.maximum(na, nb)
            sa, sb = b.column("sig_a"), b.column("sig_b")
            for i in np.flatnonzero(ok):
                x, y = (np.frombuffer(c[int(i)].as_py(), np.uint8)[None] for c in (sa, sb))
                ok[i] = allowed(na[i:i + 1], x, nb[i:i + 1], y, percent)[0, 0] > 0
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], ["a", "b"]).filter(pa.array(ok))
    return run


def allowed(na: np.ndarray, sa: np.ndarray, nb: np.ndarray, sb: np.ndarray, percent: int) -> np.ndarray:
    """Matrix of the upper bounds of the overlap, 0 where it misses the similarity."""
    size = min(sa.shape[1], sb.shape[1])
    x, y = fold(sa, size).view(np.uint64), fold(sb, size).view(np.uint64)
    only_a = np.zeros((len(x), len(y)), dtype=np.int64)
    only_b = np.zeros_like(only_a)
    for w in range(x.shape[1]):                          # a word of all signatures at a time
        u, v = x[:, w][:, None], y[:, w][None, :]
        only_a += np.bitwise_count(u & ~v)
        only_b += np.bitwise_count(v & ~u)
    overlap = np.minimum(na[:, None] - only_a, nb[None, :] - only_b)
    return np.where(overlap * (100 + percent) >= percent * (na[:, None] + nb[None, :]), overlap, 0)


def narrow(sig: int, bits: int, to: int) -> int:
    """A signature as an integer, folded to fewer bits."""
    while bits > to:
        bits //= 2
        sig = (sig >> bits) | (sig & ((1 << bits) - 1))
    return sig


def few_pairs(outer: list, inner: list, percent: int) -> Iterator[tuple]:
    """As ``many_pairs``, for blocks of a few nodes."""
    x = [(*r[:4], 8 * len(r[4]), int.from_bytes(r[4], "little")) for r in outer]
    y = [(*r[:4], 8 * len(r[4]), int.from_bytes(r[4], "little")) for r in inner]
    for a, ca, na, core_a, bits_a, sa in x:
        for b, cb, nb, core_b, bits_b, sb in y:
            if (ca == cb or 100 * min(na, nb) < percent * max(na, nb)
                    or not (core_a if na < nb else core_b if nb < na else core_a and core_b)):
                continue
            bits = min(bits_a, bits_b)
            u, v = narrow(sa, bits_a, bits), narrow(sb, bits_b, bits)
            overlap = min(na - (u & ~v).bit_count(), nb - (v & ~u).bit_count())
            if overlap * (100 + percent) >= percent * (na + nb):
                yield overlap / (na + nb), a, b, ca, cb


def many_pairs(outer: list, inner: list, percent: int) -> Iterator[tuple]:
    """(bound, a, b, component of a, component of b) of the pairs of nodes of
    different components that sizes, core entries and bitmaps allow."""
    def by_width(rows: list) -> Iterator[tuple[np.ndarray, ...]]:
        for z in sorted({len(r[4]) for r in rows}):
            own = [r for r in rows if len(r[4]) == z]
            node, comp, n, core = (np.array([r[c] for r in own], dtype=np.int64) for c in range(4))
            yield node, comp, n, core > 0, np.frombuffer(b"".join(r[4] for r in own), np.uint8).reshape(len(own), z)
    for a, ca, na, core_a, sa in by_width(outer):
        for b, cb, nb, core_b, sb in by_width(inner):
            u, v = na[:, None], nb[None, :]
            ok = (100 * np.minimum(u, v) >= percent * np.maximum(u, v)) & (ca[:, None] != cb)
            ok &= ((u > v) | core_a[:, None]) & ((v > u) | core_b[None, :])
            rows, cols = np.flatnonzero(ok.any(axis=1)), np.flatnonzero(ok.any(axis=0))
            if len(rows) and len(cols):
                bound = ok[np.ix_(rows, cols)] * allowed(na[rows], sa[rows], nb[cols], sb[cols], percent)
                i, j = np.nonzero(bound)
                r, c = rows[i], cols[j]
                yield from zip((bound[i, j] / (na[r] + nb[c])).tolist(), a[r].tolist(), b[c].tolist(),
                               ca[r].tolist(), cb[c].tolist())


def forest(pairs: Iterator[tuple]) -> Iterator[tuple]:
    """A spanning forest of the components by their pairs, best bound first."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while (p := parent.setdefault(x, x)) != x:
            parent[x] = parent[p]
            x = p
        return x
    for pair in sorted(pairs, key=lambda p: (-p[0], p[1:])):
        u, v = find(pair[3]), find(pair[4])
        if u != v:
            parent[u] = v
            yield pair


def block_pairs(percent: int, spanning: bool):
    """Rows sorted by tile block (tile, o, i) to candidate pairs; a block holds
    about two times BLOCK nodes and may go on in the next batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, outer, inner = None, [], []

        def pairs() -> set[tuple[int, int, int]]:
            found = (few_pairs if len(outer) * len(inner) <= 256 else many_pairs)(outer, inner, percent)
            return {(key[0], min(p[1:3]), max(p[1:3])) for p in (forest(found) if spanning else found)}

        for b in batches:
            found: set[tuple[int, int, int]] = set()
            cols = [b.column(c).to_pylist() for c in ("tile", "o", "i", "outer", "node", "comp", "n", "core", "signature")]
            for tile, o, i, is_outer, *row in zip(*cols):
                if (tile, o, i) != key:
                    if outer and inner:
                        found |= pairs()
                    key, outer, inner = (tile, o, i), [], []
                (outer if is_outer else inner).append(row)
            yield pair_batch(found)
        yield pair_batch(pairs() if outer and inner else set())
    return run


def pair_batch(pairs: set) -> pa.RecordBatch:
    a = np.array(sorted(pairs), dtype=np.int64).reshape(-1, 3)
    return pa.RecordBatch.from_arrays([pa.array(a[:, i]) for i in range(3)], ["tile", "a", "b"])


def node_sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(k)
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([shingles(x).tobytes() for x in texts(b, 1)], pa.binary())], ["node", "set"])
    return run


def similar(percent: int):
    """Pairs whose sorted arrays intersect enough."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = []
            for x, y in zip(b.column("set_a"), b.column("set_b")):
                s, u = (np.frombuffer(z.as_py(), np.uint64) for z in (x, y))
                n = len(np.intersect1d(s, u, assume_unique=True))
                ok.append(100 * n >= percent * (len(s) + len(u) - n))
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], ["a", "b"]).filter(
                pa.array(ok, pa.bool_()))
    return run


def verify(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes that really are similar, stored."""
    side = lambda x: nodes.select(F.col("node").alias(x), F.col("n_shingles").alias(f"n_{x}"),
                                  F.col("signature").alias(f"sig_{x}"))
    pairs = common.materialize(
        pairs.join(side("a"), "a").join(side("b"), "b")
        .mapInArrow(may_match(percent), "a long, b long"), "ngram-candidates")
    wanted = (pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
              .join(nodes.select("node", "_row"), "node"))
    wanted = common.materialize(wanted, "ngram-wanted")
    if not (n := wanted.count()):
        return pairs
    ids = F.broadcast(wanted) if n <= BROADCAST_IDS else wanted
    # a node's text is read from its least row; several rows may share that key, with equal texts
    again = keyed(docs).join(ids, "_row").dropDuplicates(["node"])
    sets = common.materialize(
        again.select("node", "text").mapInArrow(node_sets(k), "node long, set binary"), "ngram-sets")
    both = (pairs.join(sets.select(F.col("node").alias("b"), F.col("set").alias("set_b")), "b")
            .join(sets.select(F.col("node").alias("a"), F.col("set").alias("set_a")), "a"))
    return common.materialize(both.mapInArrow(similar(percent), "a long, b long"), "ngram-links")


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, _row, text): ``_row`` is a hash of the document's id and text."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.xxhash64("doc_id", "text").alias("_row"), "text")


def tile_members(sets: DataFrame) -> DataFrame:
    """(tile, node, core, lo) of the tiles that can hold similar sets; tiles
    with the same nodes are one, core where any of them is."""
    entries = lambda c, core: (sets.filter(f"{c} is not null")
                               .select("node", F.explode(c).alias("tile"), F.lit(core).alias("core")))
    tiles = entries("core", True).unionByName(entries("rest", False))
    shared = (tiles.groupBy("tile").agg(F.min("node").alias("lo"), F.max("node").alias("hi"), F.max("core").alias("core"))
              .filter("lo < hi and core").select("tile"))
    # copies in several tasks entered a tile more than once
    members = common.materialize(
        tiles.join(shared, "tile").groupBy("tile", "node").agg(F.max("core").alias("core")), "ngram-entries")
    same = (members.groupBy("tile")
            .agg(F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("y"),
                 F.count(F.lit(1)).alias("n"), F.min("node").alias("lo"))
            .select("tile", "lo", F.xxhash64("x", "y", "n", "lo").alias("same")))
    return common.materialize(
        members.join(same, "tile").groupBy(F.col("same").alias("tile"), "node", "lo")
        .agg(F.max("core").alias("core"), F.count(F.lit(1)).alias("weight")), "ngram-members")


def leader_pairs(members: DataFrame) -> DataFrame:
    """Each node with the leader it shares most tiles with."""
    shared = members.filter("node <> lo").groupBy("node", "lo").agg(F.sum("weight").alias("n"))
    best = shared.groupBy("node").agg(F.max("n").alias("n"))
    best = shared.join(best, ["node", "n"]).groupBy("node").agg(F.min("lo").alias("a"))
    return best.select("a", F.col("node").alias("b"))


def left_over_pairs(members: DataFrame, nodes: DataFrame, roots: DataFrame, percent: int,
                    spanning: bool) -> DataFrame:
    """(tile, a, b): candidate pairs between components that share a tile, stored."""
    own = members.join(roots, "node", "left").select(
        "tile", "node", "core", F.coalesce("root", "node").alias("comp"))
    open_ = own.groupBy("tile").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1")).filter("c0 <> c1")
    own = common.materialize(own.join(open_.select("tile"), "tile"), "ngram-open")
    sizes = own.groupBy("tile", "comp").agg(F.count(F.lit(1)).alias("n"))
    most = sizes.groupBy("tile").agg(F.max("n").alias("n"), F.sum("n").alias("_all"))
    sizes = (sizes.join(most, ["tile", "n"]).groupBy("tile", "n", "_all").agg(F.min("comp").alias("big")))
    blocks = lambda n: F.ceil(n / F.lit(BLOCK)).cast("int")
    sizes = sizes.select("tile", "big", blocks(F.col("_all")).alias("_in"),
                         blocks(F.col("_all") - F.col("n")).alias("_out"))
    rows = own.join(sizes, "tile").join(nodes.select("node", F.col("n_shingles").alias("n"), "signature"), "node")
    mine = lambda n: F.pmod(F.xxhash64("node"), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - F.lit(1)))
    cols = ["tile", "o", "i", "outer", "node", "comp", "n", "core", "signature"]
    inner = (rows.withColumn("i", mine(F.col("_in"))).withColumn("o", every(F.col("_out")))
             .withColumn("outer", F.lit(False)).select(cols))
    outer = (rows.filter("comp <> big").withColumn("o", mine(F.col("_out"))).withColumn("i", every(F.col("_in")))
             .withColumn("outer", F.lit(True)).select(cols))
    cells = inner.unionByName(outer).repartition("tile", "o", "i").sortWithinPartitions("tile", "o", "i")
    return common.materialize(cells.mapInArrow(block_pairs(percent, spanning), "tile long, a long, b long"),
                              "ngram-pairs")


def join_components(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """(doc_id, _row, n_shingles, node, root, component_id), a row per document."""
    order = docs.sparkSession.sparkContext.broadcast(corpus_order(docs, k))
    sets = common.materialize(keyed(docs).mapInArrow(describe(k, percent, order), SET_SCHEMA), "ngram-sets")
    nodes = common.materialize(
        sets.filter("node is not null").groupBy("node")
        .agg(F.min("doc_id").alias("least_doc"), F.min("_row").alias("_row"),
             F.max("n_shingles").alias("n_shingles"), F.max("signature").alias("signature")), "ngram-nodes")
    members = tile_members(sets)
    links = verify(leader_pairs(members), nodes, docs, k, percent)
    roots = components(links)
    for spanning in (True, False):
        pairs = left_over_pairs(members, nodes, roots, percent, spanning)
        more = verify(pairs.select("a", "b").distinct(), nodes, docs, k, percent)
        # a tile without candidates has none after more components have joined either
        members = members.join(pairs.select("tile").distinct(), "tile", "left_semi")
        if more.count():
            links = links.unionByName(more)
            roots = components(links)
    named = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("least_doc").alias("component_id"))
    of_node = named.join(least, "root").select("node", "root", "component_id")
    return (sets.join(of_node, "node", "left")
            .select("doc_id", "_row", "n_shingles", "node", "root",
                    F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
                    .alias("component_id")))


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """All columns of ``docs`` plus n_shingles, component_id and ``node``, which
    equal sets share."""
    docs = common.drop_clashes(docs, [*ADDED, "_row"])
    found = join_components(docs, k, percent).dropDuplicates(["_row"]).drop("doc_id", "root")
    return (docs.withColumn("_row", F.xxhash64("doc_id", "text"))
            .join(found, "_row").select(*docs.columns, *ADDED))


def keep_one(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay when one document of each group does: its
    least doc_id, once.  Documents without words form no groups and all stay.

    The rows to keep are found on narrow tables; texts move only if there are
    too many such rows to broadcast their hashes.
    """
    docs = common.drop_clashes(docs, ["_row"])
    found = common.materialize(join_components(docs, k, percent), "ngram-found")
    first = (found.filter("node is not null and doc_id <=> component_id")
             .groupBy("root").agg(F.min("_row").alias("_row")))
    copies = found.groupBy("_row").agg(F.count(F.lit(1)).alias("copies"))
    keep = common.materialize(
        first.join(copies, "_row").select("_row", F.col("copies") > 1)
        .toDF("_row", "repeated").unionByName(
            found.filter("node is null").select("_row", F.lit(False).alias("repeated")).distinct()), "ngram-keep")
    keep = common.broadcast_if_small(keep, BROADCAST_IDS)
    rows = docs.withColumn("_row", F.xxhash64("doc_id", "text"))
    once = rows.join(keep.filter("not repeated"), "_row", "left_semi")
    again = rows.join(keep.filter("repeated"), "_row", "left_semi").dropDuplicates(["_row"])
    return once.unionByName(again).select(*docs.columns)


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    return join_components(docs, k=4, percent=85).select("doc_id", "n_shingles", "component_id")


NGRAM_JOIN_SQL = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') w from documents),
s as (
  select distinct doc_id, unnest(case
    when len(w) >= 4 then list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))
    when len(w) > 0 then [array_to_string(w, ' ')] end) shingle from w),
n as (select doc_id, count(*) n from s group by doc_id),
c as (
  select a.doc_id x, b.doc_id y, count(*) m from s a join s b on a.shingle = b.shingle and a.doc_id < b.doc_id
  group by all),
l as (
  select x, y from c join n nx on nx.doc_id = x join n ny on ny.doc_id = y
  where 100 * m >= 85 * (nx.n + ny.n - m)),
u as (select x, y from l union all select y, x from l),
reach as (
  select doc_id x, doc_id y from documents
  union select reach.x, u.y from reach join u on reach.y = u.x)
select d.doc_id, coalesce(any_value(n.n), 0) n_shingles, min(reach.y) component_id
from documents d left join n using (doc_id) join reach on reach.x = d.doc_id group by d.doc_id
"""
