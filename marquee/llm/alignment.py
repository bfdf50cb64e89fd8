"""Cross-tokenizer alignment: which ids of two tokenizers end together, and how often.

Tokenizer A reads space + text, tokenizer B reads the text and adds that space
itself.  Byte offsets where tokens of both end cut a text into groups; the two
tokens that end at such an offset are a link.

1. Every document is aligned once; each task sums its links by id pair and the
   partial sums are stored.
2. The distinct pairs get a minimal perfect hash.  Pairs are dealt to buckets
   of about BUCKET_PAIRS by a mixed hash, and a bucket's function is a cascade
   of bit arrays (a pair sits at the first level where no other pair meets it;
   its index is the number of bits before), about four bits a pair.  The pairs
   are stored in index order, so a lookup can verify the key it found.
3. Each task adds its partial sums into one dense vector indexed by the hash;
   the vectors are summed in a tree, FAN at a time and bucket by bucket.
4. A second pass aligns the documents again and looks up the counts.

The hash, keys and counts are broadcast while there are at most
``broadcast_pairs`` pairs (17 bytes each, a count made before).  Beyond that
the second pass sends each document's distinct pairs through a join with the
counts instead; the results are the same.

A text is cut at runs of white space that begin with a plain space or a line
feed: no piece of either vocabulary crosses such a place, so these segments are
tokenized on their own and kept in a cache of bounded size.

Defined cases: texts that are null, empty, not UTF-8, or whose joined token
bytes of A or B differ from space + text (a literal U+2581, say) have no tokens:
zeros and an empty digest.  Repeated rows count each time, null doc_id is a row
like any other, texts and words of any length are read whole.  An empty table gives no rows.  Other columns than those in ``carry`` do
not matter, whatever their names.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm import common

TOKENIZER_A, TOKENIZER_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
BUCKET_PAIRS = 1 << 15
BROADCAST_PAIRS = 1 << 24
FAN = 64                              # vectors summed by one task
SPOT_BITS = 24
CACHE_SEGMENTS = 100_000              # a task's cache starts anew beyond so many segments
CACHE_CHARS = 1 << 22                 # or so many characters in them
SLICE = 1 << 21                       # bytes of texts aligned together
JOINED = 4096                         # characters of segments tokenized in one go
B_BITS = 32                           # a pair is A's id above this many bits, B's id in them
SPACE_MARK = "▁"                 # fixed value: tokenizer B's sign for a space
SEGMENT = re.compile(r"[ \n]\s*\S*(?:[^\S \n]\s*\S*)*")
M1, M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)

class Aligner:
    """Texts to segments, and what alignment says of each segment.

    A segment's place in the tables stays until ``trim``: ``figures`` are tokens
    of A, tokens of B, groups, and 1 if the segment's tokens do not join to its
    bytes; ``groups`` is their text; ``pairs`` its links, from ``first`` on.
    """

    def __init__(self, path_a: str | None = None, path_b: str | None = None):
        import public_tokenizers
        import sentencepiece
        import tiktoken

        from marquee.llm.packing import byte_letters
        with open(path_a or public_tokenizers.path(TOKENIZER_A), encoding="utf-8") as f:
            model = json.load(f)["model"]
        own = {c: bytes([b]) for b, c in byte_letters().items()}
        # merges of a byte-level vocabulary are in the order of the ids they make, so ids serve as ranks
        merged = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        if merged != sorted(merged):
            raise ValueError("tokenizer A's merges are not in the order of its ids")
        made = set(merged)                       # special strings are not made by merges
        ranks = {b"".join([own[c] for c in e]): i for e, i in model["vocab"].items() if len(e) == 1 or i in made}
        self.a = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b or public_tokenizers.path(TOKENIZER_B))
        by_id = {i: t for t, i in ranks.items()}
        self.a_bytes = [by_id.get(i, b"") for i in range(max(by_id) + 1)]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE_MARK, " ").encode()
                        for i, p in enumerate(self.b.id_to_piece(i) for i in range(self.b.vocab_size()))]
        self.a_size, self.b_size = (np.array([len(x) for x in t]) for t in (self.a_bytes, self.b_bytes))
        # ids as text, by what follows them: another of the group, the other tokenizer's, the next group
        self.texts = [f"{i}{end}" for t, ends in ((self.a_bytes, ",|"), (self.b_bytes, ",;"))
                      for end in ends for i in range(len(t))]
        self.text_size = np.array([len(x) for x in self.texts])
        self.space = self.b.piece_to_id(SPACE_MARK)
        self.clear()

    def clear(self) -> None:
        self.cache: dict[str, int] = {}
        self.chars = 0
        self.figures = np.zeros((0, 4), dtype=np.int64)
        self.groups: list[str] = []
        self.pairs, self.first = np.zeros(0, dtype=np.int64), np.zeros(1, dtype=np.int64)

    def full(self) -> bool:
        return len(self.cache) > CACHE_SEGMENTS or self.chars > CACHE_CHARS

    def joined(self, text: str) -> tuple[list[int], list[int]]:
        a = self.a.encode_ordinary(text)
        b = self.b.encode(text[1:] if text[:1] == " " else text)
        if text == " ":                          # B adds no space to empty text
            b = [self.space]
        elif text[:1] != " ":                    # B put a space of its own before it
            b = b[1:] if b[:1] == [self.space] else []
        return a, b

    def same(self, text: bytes, a: list[int], b: list[int]) -> bool:
        return b"".join(map(self.a_bytes.__getitem__, a)) == text == b"".join(map(self.b_bytes.__getitem__, b))

    def add(self, segments: list[str]) -> None:
        """Aligns new segments at once: those that end in no white space stay
        apart in their joined text, and offsets run through all bytes."""
        first = [s for s in segments if not s[-1].isspace()]
        cuts = np.cumsum([len(s) for s in first]) // JOINED
        cuts = [0, *(np.flatnonzero(np.diff(cuts)) + 1).tolist(), len(first)]
        own = [self.joined("".join(first[lo:hi])) for lo, hi in zip(cuts, cuts[1:]) if hi > lo]
        a, b = ([i for x in own for i in x[k]] for k in (0, 1))
        sizes = [s.encode() for s in first]
        if not self.same(b"".join(sizes), a, b):
            first, sizes, a, b = [], [], [], []
        sizes = [len(x) for x in sizes]
        done = set(first)
        rest = [s for s in segments if s not in done]
        bad = np.zeros(len(segments), dtype=np.int64)
        for i, s in enumerate(rest, len(first)):
            own, raw = self.joined(s), s.encode()
            bad[i] = not self.same(raw, *own)
            if not bad[i]:
                a += own[0]
                b += own[1]
            sizes.append(0 if bad[i] else len(raw))
        segments = first + rest
        a, b = np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)
        a_end, b_end, end = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b]), np.cumsum(sizes)
        n_a, n_b = (np.bincount(np.searchsorted(end, x), minlength=len(segments)) for x in (a_end, b_end))
        both = np.intersect1d(a_end, b_end, assume_unique=True)
        a_group, b_group = np.searchsorted(both, a_end), np.searchsorted(both, b_end)
        a_last, b_last = both[a_group] == a_end, both[b_group] == b_end
        n_groups = np.bincount(np.searchsorted(end, both), minlength=len(segments))
        order = np.argsort(np.concatenate([2 * a_group, 2 * b_group + 1]), kind="stable")
        n = (len(self.a_bytes), len(self.b_bytes))
        text = np.concatenate([a + n[0] * a_last, 2 * n[0] + b + n[1] * b_last])[order]
        whole = "".join([self.texts[k] for k in text.tolist()])
        ends = np.append(0, np.cumsum(self.text_size[text]))[np.append(0, np.cumsum(n_a + n_b))].tolist()
        at = len(self.groups)
        self.cache.update(zip(segments, range(at, at + len(segments))))
        self.chars += sum(map(len, segments))
        self.groups += [whole[lo:hi] for lo, hi in zip(ends, ends[1:])]
        self.figures = np.concatenate([self.figures, np.stack([n_a, n_b, n_groups, bad], axis=1)])
        self.pairs = np.concatenate([self.pairs, a[a_last] << B_BITS | b[b_last]])
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(n_groups)])

    def read(self, batch: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The segments of all texts in order, and where each text's begin; a
        text without tokens has none."""
        cut: list[list[str]] = []
        for x in batch.cast(pa.binary()):
            try:
                text = (x.as_py() or b"").decode()
            except UnicodeDecodeError:
                text = ""
            cut.append(SEGMENT.findall(" " + text) if text and SPACE_MARK not in text else [])
        every = list(itertools.chain.from_iterable(cut))
        new = [s for s in dict.fromkeys(every) if s not in self.cache]
        for lo in range(0, len(new), 1 << 14):
            self.add(new[lo:lo + (1 << 14)])
        place = np.fromiter(map(self.cache.__getitem__, every), np.int64, len(every))
        n = np.array([len(c) for c in cut], dtype=np.int64)
        row = np.repeat(np.arange(len(n)), n)
        good = np.bincount(row, self.figures[place, 3], minlength=len(n)) == 0
        return place[good[row]], np.append(0, np.cumsum(np.where(good, n, 0)))

    def sums(self, figures: np.ndarray, place: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Figures of texts from those of segments."""
        total = np.concatenate([np.zeros((1, figures.shape[1]), np.int64), np.cumsum(figures[place], axis=0)])
        return total[start[1:]] - total[start[:-1]]


def mixed(pairs: np.ndarray, level: int) -> np.ndarray:
    """64 well-spread bits of each pair, others at each level."""
    x = (pairs.astype(np.uint64) + np.uint64((level + 1) * int(M2) & (1 << 64) - 1)) * M1
    x = (x ^ (x >> np.uint64(32))) * M2
    return (x ^ (x >> np.uint64(29))) * M1


def spots(pairs: np.ndarray) -> np.ndarray:
    """What bucket a pair is in, as a share of 2**SPOT_BITS."""
    return (mixed(pairs, -1) >> np.uint64(64 - SPOT_BITS)).astype(np.int64)


def positions(pairs: np.ndarray, level: int, size: np.ndarray | int) -> np.ndarray:
    return ((mixed(pairs, level) >> np.uint64(32)) * np.asarray(size).astype(np.uint64) >> np.uint64(32)).astype(np.int64)


def summed(pairs: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    u, at = np.unique(pairs, return_inverse=True)
    out = np.zeros(len(u), dtype=np.int64)
    np.add.at(out, at, n)
    return u, out


def partial_counts(path_a: str | None, path_b: str | None):
    """Texts to (pair, spot, n): a task's links summed by pair."""
    def rows(aligner: Aligner, seen: np.ndarray) -> Iterator[pa.RecordBatch]:
        n = np.zeros(len(aligner.groups), dtype=np.int64)
        n[:len(seen)] = seen
        pairs, n = summed(aligner.pairs, np.repeat(n, np.diff(aligner.first)))
        pairs, n = pairs[n > 0], n[n > 0]
        for lo in range(0, len(pairs), 1 << 16):
            p = pairs[lo:lo + (1 << 16)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(p), pa.array(spots(p)), pa.array(n[lo:lo + (1 << 16)])], ["pair", "spot", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, seen = Aligner(path_a, path_b), np.zeros(0, dtype=np.int64)
        for b in common.byte_slices(batches, limit=SLICE):
            place, _ = aligner.read(b.column(0))
            now = np.bincount(place, minlength=len(aligner.groups))
            now[:len(seen)] += seen
            seen = now
            if aligner.full():
                yield from rows(aligner, seen)
                aligner.clear()
                seen = seen[:0]
        yield from rows(aligner, seen)
    return run


def build_bucket(batch: pa.Table) -> pa.Table:
    """One bucket's pairs to its bit arrays and its pairs in index order."""
    left = np.unique(batch.column("pair").to_numpy())
    sizes, bits, keys = [], [], []
    while len(left):
        size = max(64, -(-2 * len(left) // 64) * 64)
        at = positions(left, len(sizes), size)
        alone = np.bincount(at, minlength=size) == 1
        mine = alone[at]
        keys.append(left[mine][np.argsort(at[mine])])
        bits.append(np.packbits(alone, bitorder="little").tobytes())
        sizes.append(size)
        left = left[~mine]
    keys = np.concatenate([np.zeros(0, np.int64), *keys])
    return pa.table({"bucket": pa.array([batch.column("bucket")[0].as_py()], pa.int64()),
                     "sizes": pa.array([sizes], pa.list_(pa.int32())), "bits": pa.array([b"".join(bits)], pa.binary()),
                     "keys": pa.array([keys.astype("<i8").tobytes()], pa.binary())})


class PairIndex:
    """Minimal perfect hash of all pairs; bucket ``k`` owns indexes ``base[k]`` up to ``base[k + 1]``."""

    def __init__(self, buckets: int, rows: list):
        self.buckets, rows = buckets, sorted(rows, key=lambda r: r.bucket)
        levels = max([len(r.sizes) for r in rows], default=1)
        self.size = np.zeros((buckets, levels), dtype=np.int64)
        for r in rows:
            self.size[r.bucket, :len(r.sizes)] = r.sizes
        ends = np.cumsum(self.size)
        self.start = (np.append(0, ends[:-1])).reshape(self.size.shape)
        self.words = np.frombuffer(b"".join(bytes(r.bits) for r in rows), "<u8")
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.append(0, np.cumsum(ones))
        first = np.append(self.start[:, 0], ends[-1:])
        self.base = self.before[first >> 6]
        self.n = int(self.before[-1])

    def __call__(self, pairs: np.ndarray) -> np.ndarray:
        """Index of each pair; of a pair that is no key, any index or -1."""
        out = np.full(len(pairs), -1, dtype=np.int64)
        bucket = spots(pairs) * self.buckets >> SPOT_BITS
        open_ = np.arange(len(pairs))
        for level in range(self.size.shape[1]):
            p, b = pairs[open_], bucket[open_]
            size = self.size[b, level]
            at = self.start[b, level] + positions(p, level, size)
            word = self.words[np.minimum(at >> 6, max(len(self.words) - 1, 0))] if len(self.words) else at * 0
            bit = (at & 63).astype(np.uint64)
            hit = (size > 0) & ((word >> bit) & np.uint64(1) == 1)
            under = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1))).astype(np.int64)
            out[open_[hit]] = (self.before[np.minimum(at >> 6, len(self.before) - 1)] + under)[hit]
            open_ = open_[~hit]
            if not len(open_):
                break
        return out


def dense(index):
    """Partial sums of a task to its dense vector, one row per bucket it touched."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, part = index.value, TaskContext.get().partitionId()
        vector = np.zeros(of.n, dtype=np.int64)
        for b in batches:
            np.add.at(vector, of(b.column(0).to_numpy()), b.column(1).to_numpy())
        for k in range(of.buckets):
            own = vector[of.base[k]:of.base[k + 1]]
            if own.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k], pa.int64()), pa.array([part], pa.int64()),
                     pa.array([own.astype("<i8").tobytes()], pa.binary())], ["key", "part", "vector"])
    return run


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(keys, counts) of buckets to each B id's highest count in the bucket."""
    for b in batches:
        for keys, counts in zip(b.column(0), b.column(1)):
            ids = np.frombuffer(keys.as_py(), "<i8") & ((1 << B_BITS) - 1)
            own, at = np.unique(ids, return_inverse=True)
            best = np.zeros(len(own), dtype=np.int64)
            np.maximum.at(best, at, np.frombuffer(counts.as_py(), "<i8"))
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(best)], ["b", "best"])


class PairCounts:
    """Corpus-wide counts of pairs, with the keys that verify a lookup."""

    def __init__(self, index: PairIndex, rows: list, best: dict[int, int]):
        rows = sorted(rows, key=lambda r: r.bucket)
        self.index = index
        self.keys = np.frombuffer(b"".join(bytes(r.keys) for r in rows), "<i8")
        self.counts = np.frombuffer(b"".join(bytes(r.counts) for r in rows), "<i8")
        top = np.zeros(max(best, default=0) + 1, dtype=np.int64)
        for b, n in best.items():
            top[b] = n
        self.best = self.counts == top[self.keys & ((1 << B_BITS) - 1)]

    def __call__(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts, and whether each is its B id's highest."""
        if not len(pairs):
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=bool)
        at = self.index(pairs)
        if (at < 0).any() or (self.keys[at] != pairs).any():
            raise KeyError("a pair of the second pass is not among those of the first")
        return self.counts[at], self.best[at]


FIELDS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


def digests(aligner: Aligner, place: np.ndarray, start: np.ndarray) -> tuple[list[str], list[str]]:
    """Each text's groups as text, and their digest."""
    groups = aligner.groups
    texts = ["".join([groups[k] for k in place[lo:hi].tolist()])[:-1] for lo, hi in zip(start[:-1], start[1:])]
    return texts, [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in texts]


def look_up(counts, path_a: str | None, path_b: str | None, with_groups: bool):
    """(text, carried columns...) to the carried columns and the row's figures."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, of = Aligner(path_a, path_b), counts.value
        found = np.zeros((0, 2), dtype=np.int64)
        for b in common.byte_slices(batches, limit=SLICE):
            place, start = aligner.read(b.column(0))
            own = aligner.pairs[aligner.first[len(found)]:]
            n, best = of(own)
            at = np.repeat(np.arange(len(aligner.groups) - len(found)), np.diff(aligner.first[len(found):]))
            new = np.zeros((len(aligner.groups) - len(found), 2), dtype=np.int64)
            np.add.at(new, at, np.stack([best, n], axis=1))
            found = np.concatenate([found, new])
            f = np.concatenate([aligner.figures[:, :3], aligner.figures[:, 2:3], found], axis=1)
            out = aligner.sums(f, place, start)
            texts, sha = digests(aligner, place, start)
            columns = [*b.columns[1:], *[pa.array(out[:, k]) for k in range(len(FIELDS))], pa.array(sha, pa.string())]
            names = [*b.schema.names[1:], *FIELDS, "groups_sha256"]
            if with_groups:
                columns.append(pa.array(texts, pa.string()))
                names.append("groups")
            yield pa.RecordBatch.from_arrays(columns, names)
            if aligner.full():
                aligner.clear()
                found = found[:0]
    return run


def link_rows(path_a: str | None, path_b: str | None):
    """(text, row) to (row, token counts, digest, groups, its pairs, links of each)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(path_a, path_b)
        for b in common.byte_slices(batches, limit=SLICE):
            place, start = aligner.read(b.column(0))
            out = aligner.sums(aligner.figures, place, start)
            texts, sha = digests(aligner, place, start)
            pairs, ns = [], []
            for lo, hi in zip(start[:-1], start[1:]):
                own = [aligner.pairs[aligner.first[k]:aligner.first[k + 1]] for k in place[lo:hi].tolist()]
                p, n = np.unique(np.concatenate([aligner.pairs[:0], *own]), return_counts=True)
                pairs.append(p.tolist())
                ns.append(n.tolist())
            yield pa.RecordBatch.from_arrays(
                [b.column(1), *[pa.array(out[:, k]) for k in (0, 1, 2, 2)], pa.array(sha, pa.string()),
                 pa.array(texts, pa.string()), pa.array(pairs, pa.list_(pa.int64())), pa.array(ns, pa.list_(pa.int64()))],
                ["row", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "groups", "pairs", "ns"])
            if aligner.full():
                aligner.clear()
    return run


LINK_SCHEMA = ("row long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, groups string, "
               "pairs array<long>, ns array<long>")


def pair_counts(partials: DataFrame, n_pairs: int) -> PairCounts:
    """Minimal perfect hash and dense counts of the pairs of stored partial sums."""
    spark = partials.sparkSession
    buckets = max(1, -(-n_pairs // BUCKET_PAIRS))
    hashed = common.materialize(
        partials.select("pair", F.shiftright(F.col("spot") * buckets, SPOT_BITS).alias("bucket")).distinct()
        .groupBy("bucket").applyInArrow(build_bucket, "bucket long, sizes array<int>, bits binary, keys binary"),
        "pair-hash")
    # about four bits a pair; n_pairs is within the bound that pair_totals checks
    index = PairIndex(buckets, hashed.select("bucket", "sizes", "bits").collect())
    vectors = partials.select("pair", "n").mapInArrow(
        dense(spark.sparkContext.broadcast(index)), "key long, part long, vector binary")
    counts = common.tree_sum(vectors, partials.rdd.getNumPartitions(), "<i8", FAN)
    stored = common.materialize(hashed.select("bucket", "keys").join(
        counts.select(F.col("key").alias("bucket"), F.col("vector").alias("counts")), "bucket"), "pair-counts")
    best = (stored.select("keys", "counts").mapInArrow(counted, "b long, best long")
            .groupBy("b").agg(F.max("best").alias("best")).collect())              # at most B's vocabulary
    return PairCounts(index, stored.collect(), {r.b: r.best for r in best})


def align(docs: DataFrame, carry: list[str] | None = None, path_a: str | None = None, path_b: str | None = None,
          with_groups: bool = False, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """One row per document: ``carry`` columns, n_a, n_b, n_groups, n_links,
    n_best, count_sum, groups_sha256 (and ``groups`` as text)."""
    spark = docs.sparkSession
    own = [*FIELDS, "groups_sha256", "groups", "text"]
    carry = [c for c in (carry or ["doc_id"]) if c.lower() not in own]
    partials = common.materialize(
        docs.select("text").mapInArrow(partial_counts(path_a, path_b), "pair long, spot long, n long"), "pair-partials")
    n_pairs = partials.select("pair").distinct().count()
    names = {f"_c{i}": c for i, c in enumerate(carry)}
    src = docs.select("text", *[F.col(f"`{c}`").alias(k) for k, c in names.items()])
    kept = [T.StructField(k, docs.schema[c].dataType) for k, c in names.items()]
    if n_pairs <= broadcast_pairs:
        schema = T.StructType(kept + [T.StructField(f, T.LongType()) for f in FIELDS]
                              + [T.StructField(f, T.StringType()) for f in ["groups_sha256", "groups"][:1 + with_groups]])
        counts = spark.sparkContext.broadcast(pair_counts(partials, n_pairs))
        return src.mapInArrow(look_up(counts, path_a, path_b, with_groups), schema).withColumnsRenamed(names)
    # more pairs than may be broadcast: each document's distinct pairs meet the counts in a join
    rows = common.materialize(src.withColumn("row", F.monotonically_increasing_id()), "pair-rows")
    links = common.materialize(
        rows.select("text", "row").mapInArrow(link_rows(path_a, path_b), LINK_SCHEMA), "pair-links")
    totals = common.materialize(partials.groupBy("pair").agg(F.sum("n").alias("n")), "pair-totals")
    b_id = F.col("pair").bitwiseAND(F.lit((1 << B_BITS) - 1))
    best = totals.groupBy(b_id.alias("b")).agg(F.max("n").alias("best"))          # at most B's vocabulary
    counts = (totals.withColumn("b", b_id).join(F.broadcast(best), "b")
              .select("pair", "n", (F.col("n") == F.col("best")).cast("long").alias("is_best")))
    found = (links.select("row", F.explode(F.arrays_zip("pairs", "ns")).alias("x"))
             .select("row", F.col("x.pairs").alias("pair"), F.col("x.ns").alias("links")).join(counts, "pair")
             .groupBy("row").agg(F.sum(F.col("links") * F.col("is_best")).alias("n_best"),
                                 F.sum(F.col("links") * F.col("n")).alias("count_sum")))
    zero = F.lit(0).cast("long")
    return (rows.drop("text").join(links.drop("pairs", "ns"), "row").join(found, "row", "left")
            .select(*names, "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"),
                    F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256", *["groups"][:with_groups])
            .withColumnsRenamed(names))


def op11_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(common.table(spark, sf_dir, "documents"), carry=["doc_id"])
