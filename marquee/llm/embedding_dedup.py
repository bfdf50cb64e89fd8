"""Embedding near-duplicates by an inverted multi-index, exactly.

1. Vectors with a label become unit vectors.  Equal vectors of one label are
   one class, kept with the number of its copies.
2. Two codebooks, one per half of the vector, are trained by k-means on a
   bounded sample; a class lies in the cell (nearest code of its first half,
   nearest code of its second half) of the product grid.
3. Each class visits cells by the multi-sequence order: for either half the
   codes are sorted by how far the half would have to move to belong to them
   (its distance to the bisecting plane of that code and its own), and pairs
   of codes are taken while the two squared distances add up to no more than
   the squared distance at the similarity.  No vector beyond that can be
   similar, so the visit stops at full recall.  Only cells from its own on are
   visited: the other side finds the rest.
4. A cell's vectors and its visitors meet in tiles of bounded blocks on each
   side; cosines are verified in double precision there.  A tile returns the
   links per class and, instead of its pairs, each linked class's least class
   in that tile, which is enough for the components.

Defined cases: null label, null, zero, empty or non-finite vectors link with
nothing (n_links 0, component the own id); a null vec_id likewise; vectors of
different length are not compared; repeated rows are separate vectors that
link when similar; an empty table gives no rows; other columns are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import common
from marquee.llm.components import components

MIN_COSINE = 0.98
SAMPLE = 4096                          # classes the codebooks are trained on
CELL_CLASSES = 512                     # wished-for classes of one label in a cell: a row shipped costs some hundred comparisons
BLOCK = 1024                           # classes a side of a tile
EPSILON = 1e-6                         # added to the radius against rounding


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def rows(column: pa.Array) -> np.ndarray:
    """Equally long lists to a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def kmeans(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Centres by Lloyd's rounds, started from spread-out points."""
    centres = [x[0]]
    near = ((x - x[0]) ** 2).sum(axis=1)
    for _ in range(1, min(k, len(x))):
        centres.append(x[int(near.argmax())])
        near = np.minimum(near, ((x - centres[-1]) ** 2).sum(axis=1))
    c = np.array(centres)
    for _ in range(rounds):
        own = distances(x, c).argmin(axis=1)
        n = np.bincount(own, minlength=len(c))
        sums = np.zeros_like(c)
        np.add.at(sums, own, x)
        c = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], c)
    return np.unique(c, axis=0)


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of every row of x to every centre."""
    return np.maximum(0.0, (x * x).sum(axis=1)[:, None] + (c * c).sum(axis=1)[None, :] - 2 * x @ c.T)


def moves(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centre of each row, and how far the row is from belonging to each centre."""
    d = distances(x, c)
    own = d.argmin(axis=1)
    gap = np.sqrt(distances(c, c))[own]
    more = d - d[np.arange(len(x)), own][:, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        return own, np.where(gap > 0, more / (2 * gap), 0.0)


def visits(m1: np.ndarray, m2: np.ndarray, radius2: float) -> Iterator[tuple[int, int]]:
    """Code pairs in multi-sequence order until their distance passes the radius."""
    o1, o2 = m1.argsort(kind="stable"), m2.argsort(kind="stable")
    s2 = m2[o2] ** 2
    for i in o1:
        n = int(np.searchsorted(s2, radius2 - m1[i] ** 2, "right"))
        if not n:
            return
        for j in o2[:n]:
            yield int(i), int(j)


def assign(books, radius2: float):
    """Classes (label, dim, cls, rep, copies, embedding) to rows of the tiles'
    two sides: in their own cell, and once per visited cell."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            dims = b.column("dim").to_numpy()
            take, cell, visitor, home = [], [], [], []
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                c1, c2 = books.value[int(dim)]
                x = unit(rows(b.column("embedding").take(pa.array(at))))
                (own1, m1), (own2, m2) = moves(x[:, :dim // 2], c1), moves(x[:, dim // 2:], c2)
                for k, row in enumerate(at):
                    mine = int(own1[k]) * len(c2) + int(own2[k])
                    seen = [i * len(c2) + j for i, j in visits(m1[k], m2[k], radius2)]
                    seen = [s for s in seen if s >= mine]
                    take += [row] * (len(seen) + 1)
                    cell += [mine, *seen]
                    visitor += [False] + [True] * len(seen)
                    home += [True] + [s == mine for s in seen]
            out = b.take(pa.array(take, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*out.columns, pa.array(cell, pa.int32()), pa.array(visitor), pa.array(home)],
                [*out.schema.names, "cell", "visitor", "home"])
    return run


def link_tile(min_cosine: float):
    """A tile's visitors against its residents: links per class, and each linked
    class's least class in the tile."""
    def run(t: pa.Table) -> pa.Table:
        v = t.column("visitor").to_numpy()
        sides = []
        for part in (t.filter(pa.array(v)), t.filter(pa.array(~v))):
            part = part.combine_chunks()
            cols = [part.column(c).to_numpy() for c in ("cls", "rep", "copies", "home")]
            e = part.column("embedding")
            x = rows(e.chunk(0) if e.num_chunks else pa.array([], e.type)) if len(part) else np.zeros((0, 1))
            sides.append((*cols, unit(x) if len(part) else x))
        (vc, vr, vn, vh, vx), (rc, rr, rn, _, rx) = sides
        if not len(vc) or not len(rc):
            return TILE_SCHEMA.empty_table()
        linked = vx @ rx.T >= min_cosine
        linked &= ~vh[:, None] | (vc[:, None] < rc[None, :])      # residents' own pairs count once
        v_links, r_links = linked @ rn, linked.T @ vn
        v_root, r_root = np.where(v_links > 0, vr, vr), rr.copy()
        while True:                                               # least class over the tile's links
            big = np.iinfo(np.int64).max
            v_new = np.minimum(v_root, np.where(linked, r_root[None, :], big).min(axis=1))
            r_new = np.minimum(r_root, np.where(linked, v_new[:, None], big).min(axis=0))
            if (v_new == v_root).all() and (r_new == r_root).all():
                break
            v_root, r_root = v_new, r_new
        cols = [np.concatenate(p) for p in ((vc, rc), (vr, rr), (v_links, r_links), (v_root, r_root))]
        some = cols[2] > 0
        return pa.table([pa.array(c[some].astype(np.int64)) for c in cols], schema=TILE_SCHEMA)
    return run


TILE_SCHEMA = pa.schema([(c, pa.int64()) for c in ("cls", "rep", "links", "root")])


def codebooks(classes: DataFrame, largest: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Per vector length, the centres of either half, from at most SAMPLE
    classes: so many that the largest label has about CELL_CLASSES a cell."""
    codes = max(2, int(np.sqrt(largest / CELL_CLASSES)))          # the sample's size at most, see kmeans
    sample = (classes.orderBy(F.xxhash64("cls"), "cls").limit(SAMPLE).select("dim", "embedding").collect())
    books = {}
    for dim in classes.select("dim").distinct().toLocalIterator():
        x = np.array([r.embedding for r in sample if r.dim == dim.dim], dtype=np.float64).reshape(-1, dim.dim)
        x = unit(x) if len(x) else np.zeros((1, dim.dim))
        books[dim.dim] = (kmeans(x[:, :dim.dim // 2], codes), kmeans(x[:, dim.dim // 2:], codes))
    return books


def near_duplicates(vectors: DataFrame, min_cosine: float = MIN_COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept), a row per vector."""
    spark = vectors.sparkSession
    e = F.col("embedding")
    finite = F.forall(F.coalesce(e, F.array().cast("array<double>")),
                      lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size(e) > 0) & finite
            & F.exists(e, lambda x: x != 0))
    # -0.0 and 0.0 are one number
    rows_ = vectors.select("vec_id", "label", F.transform(e, lambda x: x.cast("double") + F.lit(0.0)).alias("embedding"),
                           F.coalesce(good, F.lit(False)).alias("_good"))
    rows_ = common.materialize(
        rows_.withColumn("cls", F.when(F.col("_good"), F.xxhash64("label", "embedding"))), "vec-rows")
    classes = common.materialize(
        rows_.filter("_good").groupBy("cls").agg(
            F.first("label").alias("label"), F.first(F.size("embedding")).alias("dim"),
            F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"),
            F.first("embedding").alias("embedding")), "vec-classes")
    largest = classes.groupBy("label").count().agg(F.max("count")).first()[0]
    books = spark.sparkContext.broadcast(codebooks(classes, largest) if largest else {})
    radius2 = 2 - 2 * min_cosine + EPSILON
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in classes.schema) \
        + ", cell int, visitor boolean, home boolean"
    sides = common.materialize(classes.mapInArrow(assign(books, radius2), schema), "vec-sides")
    key = ["label", "dim", "cell"]
    sizes = sides.groupBy(*key).agg(
        *[F.ceil(F.sum(F.when(F.col("visitor") == x, 1).otherwise(0)) / F.lit(BLOCK)).cast("int").alias(c)
          for x, c in ((True, "_v"), (False, "_r"))])
    sizes = sizes.filter("_v > 0 and _r > 0")
    mine = lambda k: F.pmod(F.xxhash64("cls"), F.col(k)).cast("int")
    every = lambda k: F.sequence(F.lit(0), F.col(k) - F.lit(1))
    tiles = (sides.join(sizes, key)
             .withColumn("v", F.explode(F.when(F.col("visitor"), F.array(mine("_v"))).otherwise(every("_v"))))
             .withColumn("r", F.explode(F.when(F.col("visitor"), every("_r")).otherwise(F.array(mine("_r"))))))
    found = common.materialize(
        tiles.select(*key, "v", "r", "cls", "rep", "copies", "visitor", "home", "embedding")
        .groupBy(*key, "v", "r").applyInArrow(link_tile(min_cosine), "cls long, rep long, links long, root long"),
        "vec-links")
    links = found.groupBy("cls").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    per_class = (classes.select("cls", "rep", "copies").join(links, "cls", "left")
                 .join(roots.withColumnRenamed("node", "rep"), "rep", "left")
                 .select("cls", (F.col("copies") - F.lit(1) + F.coalesce("links", F.lit(0))).alias("n_links"),
                         F.coalesce("root", "rep").alias("component_id")))
    out = rows_.select("vec_id", "cls").join(per_class, "cls", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))


def op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(common.table(spark, sf_dir, "embeddings"))


EMBEDDING_DEDUP_SQL = """
with recursive v as (select row_number() over () r, vec_id, label, embedding::double[] e from embeddings),
g as (
  select * from v where vec_id is not null and label is not null and len(e) > 0
    and len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(e, lambda x: x <> 0)) > 0),
l as (
  select a.r x, b.r y from g a join g b on a.label = b.label and len(a.e) = len(b.e) and a.r < b.r
  where list_cosine_similarity(a.e, b.e) >= 0.98),
u as (select x, y from l union all select y, x from l),
reach as (select r x, r y from v union select reach.x, u.y from reach join u on reach.y = u.x),
c as (select x r, min(vec_id) component_id from reach join v on v.r = reach.y group by x),
k as (select x r, count(*) n from u group by x)
select vec_id, coalesce(k.n, 0) n_links, component_id, coalesce(vec_id = component_id, true) kept
from v join c using (r) left join k using (r)
"""
