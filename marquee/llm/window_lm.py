"""Language-model scoring by masked pseudo-likelihood, over a vocabulary that grows with the corpus.

Every word of a document is predicted from ``WINDOW`` words on each side by a
network trained here in numpy; the sum of the conditional log-probabilities
scores the document.

1. All words (A-Z lower-cased) are counted by hash.  The network has a power
   of two of leaves, at least ``LEAVES_ROOT`` times the root of the corpus's
   words and at most 2**``DEPTH_MAX``.  The most frequent words have up to seven
   eighths of the leaves for their own; the others share the rest by hash.  A
   shared leaf is cut into cells by hash (``CELLS`` in all), and a word's part of
   its leaf is its cell's part of the leaf's count, shared evenly by the cell's
   words: nearly its own frequency while cells outnumber the rare words.  The
   corpus's words have probabilities that sum to one.
2. The network embeds the words around a place, weighs them by their distance,
   adds them and applies tanh.  The output is a softmax factored over a binary
   tree of the leaves: a word's probability is the product of the choices on
   its way down.  The biases of the choices are the words' own frequencies, so
   training starts from the unigram model.
3. Training is minibatch descent (row-wise Adagrad): every word of every
   document is a training example once, by one law for any size.  The documents
   are dealt by hash into ``MEETINGS`` parts.  Each replica takes a run of a
   part's partitions; after each part a row is averaged over the replicas by the
   number of examples that touched it.

The driver and the broadcasts hold the leaves and the cells, bounded by
``DEPTH_MAX`` and ``CELLS``: about 140 bytes a leaf and 4 a cell.

Defined cases: null, empty and blank texts have no tokens and score 0; null
doc_id and repeated rows are scored like any other; an empty table gives no
rows; texts of any length are read whole; other columns are dropped unless
carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import common

WINDOW = 3
HIDDEN = 16
LEAVES_ROOT = 8
DEPTH_MAX = 18
CELLS = 1 << 19
ROUNDS = 1                              # passes over the documents
MEETINGS = 2                            # times in a round that the replicas are averaged
REPLICA_WORDS = 1_000_000               # at least so many words for another replica
BATCH = 2048
SCORED = 1024                           # words scored together
RATE = 0.1
BLOCK = 4096                            # rows of a table averaged together
COUNTED = 1 << 20                       # words and counts held by a task
ROW = f"V{4 * HIDDEN}"                  # a row of a table as one value
SLICE, SLICE_ROWS = 1 << 21, 500        # bytes and rows of texts read together


def slices(batches: Iterator[pa.RecordBatch], column: int = 0) -> Iterator[pa.RecordBatch]:
    for b in common.byte_slices(batches, column, SLICE):
        yield from (b.slice(at, SLICE_ROWS) for at in range(0, b.num_rows, SLICE_ROWS))


# from the constants of XXH3, for its seed 0
FLIP_3, FLIP_8, FLIP_LOW, FLIP_HIGH = 0x87275A9B, 0xC73AB174C5ECD5A2, 0x6782737BEA4239B9, 0xAF56BC3B0996523A
HALF = 0xFFFFFFFF


def word_hashes(data: bytes, ends: np.ndarray) -> np.ndarray:
    """XXH3 (64 bits) of the words data[ends[i]:ends[i + 1]]: those of up to 16 bytes as columns, others by the library."""
    first, size = ends[:-1].astype(np.int64), np.diff(ends)
    padded, out = data + bytes(8), np.empty(len(size), np.uint64)

    def read(kind: str, at: np.ndarray) -> np.ndarray:
        return np.ndarray(len(data) + 1, kind, padded, strides=(1,))[at].astype(np.uint64)

    def rotated(h: np.ndarray, by: int) -> np.ndarray:
        return h << np.uint64(by) | h >> np.uint64(64 - by)

    k = np.flatnonzero((size >= 1) & (size <= 3))
    at, n = first[k], size[k]
    h = read("u1", at) << 16 | read("u1", at + (n >> 1)) << 24 | read("u1", at + n - 1) | n.astype(np.uint64) << 8
    h ^= FLIP_3
    h = (h ^ h >> 33) * 0xC2B2AE3D27D4EB4F
    h = (h ^ h >> 29) * 0x165667B19E3779F9
    out[k] = h ^ h >> 32
    k = np.flatnonzero((size >= 4) & (size <= 8))
    at, n = first[k], size[k]
    h = (read("<u4", at + n - 4) + (read("<u4", at) << 32)) ^ FLIP_8
    h = (h ^ rotated(h, 49) ^ rotated(h, 24)) * 0x9FB21C651E98DF25
    h = (h ^ (h >> 35) + n.astype(np.uint64)) * 0x9FB21C651E98DF25
    out[k] = h ^ h >> 28
    k = np.flatnonzero((size >= 9) & (size <= 16))
    at, n = first[k], size[k]
    a, b = read("<u8", at) ^ FLIP_LOW, read("<u8", at + n - 8) ^ FLIP_HIGH
    low, mid, high = (a & HALF) * (b & HALF), (a >> 32) * (b & HALF), (a >> 32) * (b >> 32)
    cross = (low >> 32) + (mid & HALF) + (a & HALF) * (b >> 32)
    h = n.astype(np.uint64) + a.byteswap() + b + ((mid >> 32) + (cross >> 32) + high ^ (cross << 32 | low & HALF))
    h = (h ^ h >> 37) * 0x165667919E3779F9
    out[k] = h ^ h >> 32
    for i in np.flatnonzero((size == 0) | (size > 16)).tolist():
        out[i] = xxhash.xxh3_64_intdigest(data[ends[i]:ends[i + 1]])
    return out


def distinct_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The number of words of each text, the hashes of their distinct words, and every word's place among these."""
    texts = pc.fill_null(texts.cast(pa.binary()).view(pa.string()), "")
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    n, words = lists.value_lengths().to_numpy().astype(np.int64), lists.flatten().dictionary_encode()
    kinds, at = words.dictionary, words.indices.to_numpy()
    _, ends, data = kinds.cast(pa.binary()).buffers()
    ends = np.frombuffer(ends, np.int32)[kinds.offset:kinds.offset + len(kinds) + 1] if len(kinds) else np.zeros(1, np.int32)
    hashes = word_hashes(data.to_pybytes() if data else b"", ends) >> np.uint64(1)
    blank = np.diff(ends) == 0
    if blank.any():                                      # before leading and after trailing white space
        word = ~blank[at]
        n = np.bincount(np.repeat(np.arange(len(n)), n)[word], minlength=len(n))
        at = at[word]
    return n, hashes.astype(np.int64), at


def word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(hashes), pa.array(n)], ["hash", "n"])

    def added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        hashes, n = (np.concatenate(column) for column in zip(*parts))
        order = np.argsort(hashes)
        hashes = hashes[order]
        first = np.flatnonzero(np.diff(hashes, prepend=-1))
        return hashes[first], np.add.reduceat(n[order], first) if len(first) else n
    hashes = n = np.zeros(0, np.int64)
    parts, held = [(hashes, n)], 0
    for b in slices(batches):
        _, h, at = distinct_words(b.column(0))
        uses = np.bincount(at, minlength=len(h))
        parts.append((h[uses > 0], uses[uses > 0]))
        held += len(h)
        if held > COUNTED:
            hashes, n = added(parts)
            parts, held = [(hashes, n)], len(n)
            if held > COUNTED // 2:
                yield out()
                parts, held = [(hashes[:0], n[:0])], 0
    hashes, n = added(parts)
    yield out()


WORD = np.dtype([("leaf", "<i4"), ("share", "<f4")])


class Vocabulary:
    """Leaves of words: own ones in order of frequency, then those that rarer words share by hash.

    ``cells``: by shared leaf and cell, the log of a word's part of its leaf."""

    def __init__(self, hashes: np.ndarray, depth: int, cells: np.ndarray):
        self.hashes, self.depth, self.cells = hashes, depth, cells

    def state(self) -> tuple:
        return self.hashes, self.depth, self.cells

    @property
    def end(self) -> int:
        return 1 << self.depth

    def columns(self):
        """A column of texts to the number of words of each, and all words: their leaves and log parts of these."""
        order = np.argsort(self.hashes, kind="stable")
        ranked, first, free = self.hashes[order], len(order), self.end - len(order)
        per_leaf = len(self.cells) // free

        def read(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
            n, h, at = distinct_words(texts)
            rank = np.searchsorted(ranked, h)
            own = np.flatnonzero(ranked[np.minimum(rank, first - 1)] == h) if first else []
            kinds = np.empty(len(h), WORD)
            kinds["leaf"], kinds["share"] = first + h % free, self.cells[h % free * per_leaf + h // free % per_leaf]
            kinds["leaf"][own], kinds["share"][own] = order[rank[own]], 0
            return n, kinds.take(at)
        return read

    def reader(self):
        """A column of texts, or one text, to each text's words."""
        columns = self.columns()

        def read(texts: pa.Array | bytes) -> list[np.ndarray] | np.ndarray:
            if isinstance(texts, bytes):
                return read(pa.array([texts], pa.binary()))[0]
            n, words = columns(texts)
            return np.split(words, np.cumsum(n)[:-1]) if len(n) else []
        return read


def framed(seqs: list[np.ndarray], end: int) -> np.ndarray:
    """Leaf sequences with WINDOW ends before, between and after them."""
    return framed_columns(np.array([len(s) for s in seqs], np.int64), np.concatenate([np.zeros(0, np.int32), *seqs]), end)


def framed_columns(n: np.ndarray, leaf: np.ndarray, end: int) -> np.ndarray:
    """The same of sequences of n leaves, one after the other in leaf."""
    seq = np.full(len(leaf) + WINDOW * (len(n) + 1), end, dtype=np.int32)
    seq[np.arange(len(leaf)) + np.repeat(np.arange(1, len(n) + 1) * WINDOW, n)] = leaf
    return seq


def in_order(seq: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of a sequence by leaf, then place, and their leaves: sorted as one number each."""
    bits = len(seq).bit_length()
    both = np.sort(seq.astype(np.int64) << bits | np.arange(len(seq)))
    return both & (1 << bits) - 1, both >> bits


def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first places of runs of equal values, and their lengths."""
    new = np.ones(len(values), dtype=bool)
    np.not_equal(values[1:], values[:-1], out=new[1:])
    first = np.flatnonzero(new)
    n = np.full(len(first), len(values)) - first
    n[:-1] = first[1:] - first[:-1]
    return first, n


def run_sums(rows: np.ndarray, first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Sums of runs of n rows; reduceat loops by run and column, so single rows are copied and columns added in pairs."""
    out, many = rows.take(first, axis=0), n > 1
    starts = many.copy()                                 # of longer runs, and of what lies between them
    starts[1:] |= many[:-1]
    starts[:1] = True
    pairs = rows.view(np.result_type(rows, np.complex64))
    out[many] = np.add.reduceat(pairs, first[starts])[many[starts]].view(rows.dtype)
    return out


def level_sums(g: np.ndarray, h: np.ndarray, node: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By level: its nodes, the sums of their words' rows of h, weighted by g, by pair of columns, and the words' numbers."""
    h, kind = h.astype(g.dtype, copy=False), np.result_type(g, np.complex64)
    pairs, twice = np.ascontiguousarray(h.view(kind).T).view(g.dtype), np.repeat(g.T, 2, axis=1)
    level = np.empty_like(pairs)
    for d, nodes in enumerate(np.ascontiguousarray(node.T)):
        first, n = runs(nodes)
        np.multiply(pairs, twice[d], out=level)
        yield nodes[first].astype(np.intp), np.add.reduceat(level.view(kind), first, axis=1), n


class TreeNetwork:
    """P(word | WINDOW words to the left and to the right)."""

    def __init__(self, depth: int, bias: np.ndarray, p: dict[str, np.ndarray]):
        self.depth, self.bias, self.p = depth, bias, {k: v.copy() for k, v in p.items()}

    def state(self) -> tuple:
        return self.depth, self.bias, self.p

    @classmethod
    def untrained(cls, counts: np.ndarray, seed: int = 7) -> TreeNetwork:
        """The unigram model; ``counts``: of the leaves, a power of two."""
        r = np.random.default_rng(seed)
        depth = len(counts).bit_length() - 1
        level, bias = counts + 0.5, []
        for _ in range(depth):
            pairs = level.reshape(-1, 2)
            bias.append(np.log(pairs[:, 1] / pairs[:, 0]))
            level = pairs.sum(axis=1)
        # node k has the children 2k+1 and 2k+2
        return cls(depth, np.concatenate(bias[::-1]).astype(np.float32), {
            "embed": r.normal(0, 0.3, (len(counts) + 1, HIDDEN)).astype(np.float32),
            "tree": np.zeros((len(counts), HIDDEN), dtype=np.float32),
            "place": np.ones((2 * WINDOW + 1, HIDDEN), dtype=np.float32)})

    def hidden(self, seq: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Embeddings of a framed sequence, and the hidden layer of its places."""
        x, n = self.p["embed"].take(seq, axis=0), len(seq) - 2 * WINDOW
        z = np.zeros((n, HIDDEN), dtype=np.float32)
        for k in range(2 * WINDOW + 1):
            if k != WINDOW:
                z += self.p["place"][k] * x[k:k + n]
        return x, np.tanh(z)

    def way(self, leaf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nodes from the root to each leaf, and 1 or -1 for the second or first child."""
        d = np.arange(self.depth, dtype=np.int32)
        leaf = leaf[:, None].astype(np.int32)
        node = (leaf >> (self.depth - d)) + ((1 << d) - 1).astype(np.int32)
        return node, (((leaf >> (self.depth - 1 - d)) & 1) * 2 - 1).astype(np.float32)

    def choices(self, h: np.ndarray, node: np.ndarray, side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        u = self.p["tree"].take(node, axis=0)
        z = np.matmul(u, h[:, :, None])[:, :, 0]
        z += self.bias.take(node)
        z *= side
        return u, np.exp(-np.maximum(np.minimum(z, 30), -30))

    def log_probability(self, h: np.ndarray, leaf: np.ndarray) -> np.ndarray:
        # no overflow: at most DEPTH_MAX factors of at most 1 + exp(30)
        e = self.choices(h, *self.way(leaf))[1]
        return -np.log(np.multiply.reduce(1 + e.astype(np.float64), axis=1))

    def score(self, seq: np.ndarray) -> np.ndarray:
        """Log-probabilities of the words of a framed sequence, in order."""
        end, out = 1 << self.depth, []
        for at in range(0, len(seq) - 2 * WINDOW, SCORED):
            part = seq[at:at + SCORED + 2 * WINDOW]
            own = part[WINDOW:len(part) - WINDOW]
            k = np.flatnonzero(own != end)
            out.append(self.log_probability(self.hidden(part)[1][k], own[k]))
        return np.concatenate(out) if out else np.zeros(0)

    def fit(self, seqs: Iterator[np.ndarray]) -> dict[str, np.ndarray]:
        """One pass over framed sequences; the number of examples that touched each row."""
        seen = {k: np.full(len(v), 1e-6, dtype=np.float32) for k, v in self.p.items()}
        end, embed, leaves = 1 << self.depth, 0, 0
        for seq in seqs:
            parts = [seq[at:at + BATCH + 2 * WINDOW] for at in range(0, len(seq) - 2 * WINDOW, BATCH)]
            parts = [s for s in parts if (s[WINDOW:-WINDOW] != end).any()]
            for s in parts:
                self.step(s, seen)
            if parts:
                embed += np.bincount(np.concatenate(parts), minlength=end + 1)
                leaves += np.bincount(seq[WINDOW:-WINDOW], minlength=end + 1)[:end]
        tree, level = [np.zeros(1)], leaves + np.zeros(end)
        while len(level) > 1:                            # a node's examples are those of its leaves
            level = level.reshape(-1, 2).sum(axis=1)
            tree.append(level)
        touched = {"embed": embed + np.zeros(end + 1), "tree": np.concatenate(tree[::-1]),
                   "place": np.full(2 * WINDOW + 1, level[0])}
        return {k: v.astype(np.float32) for k, v in touched.items()}

    def gradients(self, seq: np.ndarray) -> list[tuple[str, np.ndarray, np.ndarray, np.ndarray]]:
        """(table, rows, gradient of the summed log-loss, examples) of one batch, each row once."""
        own = seq[WINDOW:len(seq) - WINDOW]
        order, of = in_order(seq)
        at = order[:np.searchsorted(of, 1 << self.depth)] - WINDOW     # by leaf: the words below a node are neighbours
        at = at[(at >= 0) & (at < len(own))]
        if not len(at):
            return []
        x, every = self.hidden(seq)
        h = every[at]
        node, side = self.way(own[at])
        u, e = self.choices(h, node, side)
        g = -side * e / (1 + e)
        dz = np.zeros_like(every)
        dz[at] = np.matmul(g[:, None, :], u)[:, 0] * (1 - h * h)
        rows, sums, n = zip(*level_sums(g, h, node))
        sums = np.ascontiguousarray(np.concatenate(sums, axis=1).T).view(g.dtype)
        out = [("tree", np.concatenate(rows), sums, np.concatenate(n))]
        dx, places = np.zeros_like(x), len(every)
        place = np.zeros_like(self.p["place"])
        for k in range(2 * WINDOW + 1):
            if k != WINDOW:
                dx[k:k + places] += self.p["place"][k] * dz
                place[k] = np.einsum("bh,bh->h", dz, x[k:k + places])
        first, n = runs(of)
        out.append(("embed", of[first], run_sums(dx.take(order, axis=0), first, n), n))
        out.append(("place", np.arange(len(place)), place, np.full(len(place), len(at))))
        return out

    def step(self, seq: np.ndarray, seen: dict) -> None:
        for k, rows, g, _ in self.gradients(seq):
            s = seen[k].take(rows) + np.einsum("rh,rh->r", g, g) / HIDDEN
            seen[k][rows] = s
            g *= (RATE / np.sqrt(s))[:, None]
            self.p[k].view(ROW)[rows] = (self.p[k].take(rows, axis=0) - g).view(ROW)


def replica(model, epochs: int):
    """Texts to the rows that a pass over them has changed, with their examples."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, network = Vocabulary(*model.value[0]), TreeNetwork(*model.value[1])
        read = vocabulary.columns()
        columns = (read(b.column(0)) for b in slices(batches))
        read_once = (framed_columns(n, words["leaf"], vocabulary.end) for n, words in columns)
        if epochs > 1:                                   # held in memory
            stored = list(read_once)
            read_once = (s for _ in range(epochs) for s in stored)
        touched = network.fit(read_once)
        part = TaskContext.get().partitionId()
        for k, v in network.p.items():
            for b in range(0, len(v), BLOCK):
                if touched[k][b:b + BLOCK].any():
                    yield pa.RecordBatch.from_pylist([{
                        "name": k, "block": b, "part": part, "n": touched[k][b:b + BLOCK].tobytes(),
                        "v": v[b:b + BLOCK].tobytes()}], REPLICA)
    return run


REPLICA = pa.schema([("name", pa.string()), ("block", pa.int64()), ("part", pa.int64()), ("n", pa.binary()),
                     ("v", pa.binary())])


def averaged(t: pa.Table) -> pa.Table:
    """One block over its replicas, in the order of their partitions."""
    rows = sorted(t.to_pylist(), key=lambda r: r["part"])
    n = np.stack([np.frombuffer(r["n"], np.float32) for r in rows]).astype(np.float64)
    v = np.stack([np.frombuffer(r["v"], np.float32).reshape(-1, HIDDEN) for r in rows])
    total = n.sum(axis=0)
    mean = (n[:, :, None] * v).sum(axis=0) / np.maximum(total, 1)[:, None]
    return pa.Table.from_pylist([rows[0] | {"n": total.astype(np.float32).tobytes(),
                                            "v": mean.astype(np.float32).tobytes()}], REPLICA)


def count_words(src: DataFrame) -> tuple[Vocabulary, np.ndarray, int]:
    """The vocabulary, the counts of its leaves, and the corpus's words."""
    spark = src.sparkSession
    counts = common.materialize(src.mapInArrow(word_counts, "hash long, n long").groupBy("hash")
                                .agg(F.sum("n").alias("n")), "lm-words")
    words = counts.agg(F.sum("n")).first()[0] or 0
    depth = min(DEPTH_MAX, max(6, int(np.ceil(np.log2(LEAVES_ROOT * max(1, words) ** 0.5)))))
    # at most 7/8 * 2**DEPTH_MAX words
    top = counts.orderBy(F.desc("n"), "hash").limit((1 << depth) * 7 // 8).toPandas()
    hashes, n = top["hash"].to_numpy(dtype=np.int64), np.zeros(1 << depth)
    n[:len(top)] = top["n"]
    free = (1 << depth) - len(top)
    per_leaf = max(1, CELLS // free)
    own = F.broadcast(spark.createDataFrame(top[["hash"]], "hash long"))
    rare = counts.join(own, "hash", "left_anti")
    cell = F.expr(f"(hash % {free}) * {per_leaf} + (hash div {free}) % {per_leaf}").alias("cell")
    cells = rare.groupBy(cell).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("kinds")).toPandas()    # at most CELLS
    at, uses = cells["cell"].to_numpy(dtype=np.int64), cells["n"].to_numpy(dtype=np.float64)
    of_leaf = np.bincount(at // per_leaf, uses, minlength=free)
    n[len(top):] = of_leaf
    share = np.zeros(free * per_leaf, dtype=np.float32)       # a cell without words is never read
    share[at] = np.log(uses / of_leaf[at // per_leaf] / cells["kinds"].to_numpy(dtype=np.float64))
    return Vocabulary(hashes, depth, share), n, words


def schedule(words: int) -> tuple[int, int]:
    """(a round takes one document in so many, passes over them): the same whatever the number of words."""
    return ROUNDS, 1


def fit(docs: DataFrame) -> tuple[Vocabulary, TreeNetwork]:
    sc, src = docs.sparkSession.sparkContext, docs.select("text")
    vocabulary, n, words = count_words(src)
    network = TreeNetwork.untrained(n)
    shares, epochs = schedule(words)
    deals = shares * MEETINGS
    replicas = max(1, min(sc.defaultParallelism, words // deals // REPLICA_WORDS))
    for k in range(ROUNDS * MEETINGS if words else 0):
        shared = sc.broadcast((vocabulary.state(), network.state()))
        part = src.filter(F.pmod(F.xxhash64("text"), F.lit(deals)) == k % deals)
        changed = part.coalesce(replicas).mapInArrow(
            replica(shared, epochs), "name string, block long, part long, n binary, v binary")
        mean = changed.groupBy("name", "block").applyInArrow(
            averaged, "name string, block long, part long, n binary, v binary").collect()
        network = TreeNetwork(*network.state())
        for r in mean:
            seen = np.frombuffer(r.n, np.float32) > 0
            rows = network.p[r.name][r.block:r.block + BLOCK]
            rows[seen] = np.frombuffer(r.v, np.float32).reshape(-1, HIDDEN)[seen]
    return vocabulary, network


def scored(model):
    """(text column last) to the carried columns, n_tokens and log_likelihood."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, network = Vocabulary(*model.value[0]), TreeNetwork(*model.value[1])
        read = vocabulary.columns()
        for b in slices(batches, -1):
            n, words = read(b.column(b.num_columns - 1))
            each = network.score(framed_columns(n, words["leaf"], vocabulary.end)) + words["share"]
            total = np.bincount(np.repeat(np.arange(len(n)), n), each, minlength=len(n))
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(n), pa.array(total, pa.float64())],
                [*b.schema.names[:-1], "n_tokens", "log_likelihood"])
    return run


def score(docs: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """``carry`` columns, n_tokens, log_likelihood and mean_log_likelihood."""
    docs = common.drop_clashes(docs, ["n_tokens", "log_likelihood", "mean_log_likelihood"])
    carry = carry or ["doc_id"]
    vocabulary, network = fit(docs)
    model = docs.sparkSession.sparkContext.broadcast((vocabulary.state(), network.state()))
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carry)
    out = docs.select(*[F.col(f"`{c}`") for c in carry], "text").mapInArrow(
        scored(model), f"{schema}, n_tokens long, log_likelihood double")
    return out.withColumn("mean_log_likelihood",
                          F.when(F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens")).otherwise(0.0))


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(common.table(spark, sf_dir, "documents"))
