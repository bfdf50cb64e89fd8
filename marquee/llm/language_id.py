"""Language identification: a linear-chain conditional random field over the words of a text.

A word (a run without white space that holds a letter) is lower-cased and
stripped of everything but letters, marks and apostrophes.  Its features are
hashed: character n-grams of up to GRAMS letters, affixes of up to GRAMS
letters, the whole word, and what the lexicon says of each language.  The
field adds learned weights of transitions between neighbouring words, so a
text may switch languages; forward-backward gives every word's probability of
each language.  A text's language is the one with the highest mean
probability, its score that mean; ``with_spans`` also returns the runs of words
of one language.

Training reads a bounded sample of texts with a language, never one with
crc32(doc_id as text) mod 3 = 1: about TRAIN_DOCS texts, evenly over the
languages (at least LEAST_DOCS each) in hash order, and of each text up to
WINDOWS runs of WINDOW_WORDS words, evenly spaced over the whole text.  Half of
the training sequences keep one language, the others are joined from texts of
several (code-switched), which teaches the transitions.  The lexicon holds the
words of at least LEXICON_DOCS of these texts.  One task runs the training; the
weights, transitions and lexicon are broadcast, their size bounded by these
parameters and the number of languages.

Scoring reads every whole text.  Sequences of a slice advance together, one
word a step; a slice holds about 4 MB of texts.

Defined cases: a null text or one without letters is ``und`` with score 0; null
doc_id is never held out nor trained on; rows that repeat a doc_id train once;
without any training text that holds a
letter every text is ``und``; ties go to the language first
by code point; empty tables give no rows.  Columns not in ``carry`` do not
matter, whatever their names.
"""

from __future__ import annotations

import itertools
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm import common

DIM_BITS = 18
GRAMS = 4
TRAIN_DOCS, LEAST_DOCS = 2_000, 50
WINDOWS, WINDOW_WORDS = 6, 32
LEXICON_DOCS = 3
LEVELS = 6                            # steps of a word's share in a language
SEQUENCE = 64                         # words of a training sequence
SPANS = (4, 32)                       # words before a switch, in code-switched sequences
BATCH = 128                           # training sequences a step
EPOCHS = 3
RATE, L2 = 0.3, 1e-6
CACHE_WORDS = 250_000
CACHE_CHARS = 1 << 23
UNKNOWN = "und"
CORE = regex.compile(r"[^\p{L}\p{M}'’]+")
LETTER = regex.compile(r"\p{L}")
M1, M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
EDGE = 2                              # code point that stands for both ends of a word


def mixed(h: np.ndarray, kind: int) -> np.ndarray:
    """Hashes of one kind of feature to feature numbers."""
    h = (h ^ np.uint64(kind * int(M2) & (1 << 64) - 1)) * M1
    return ((h ^ (h >> np.uint64(31))) * M2 >> np.uint64(64 - DIM_BITS)).astype(np.int64)


def core(word: str) -> str:
    return CORE.sub("", word.lower())


class Features:
    """Words to hashed features; the lexicon gives known words a level per language."""

    def __init__(self, lexicon: dict[str, bytes], languages: int):
        self.lexicon, self.languages = lexicon, languages

    def __call__(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word number, feature, weight) of all features of all words."""
        n = np.array([len(w) + 2 for w in words], dtype=np.int64)
        edge = chr(EDGE)
        codes = np.frombuffer(f"{edge}{f'{edge}{edge}'.join(words)}{edge}".encode("utf-32-le"), "<u4").astype(np.uint64)
        word = np.repeat(np.arange(len(n)), n)
        end = np.cumsum(n)
        place = np.arange(len(codes)) - (end - n)[word]            # 0 is the leading edge
        own, feature = [], []
        h = np.zeros(len(codes), dtype=np.uint64)
        for k in range(GRAMS + 1):                                 # windows of k + 1 codes from each place
            h = h[:len(codes) - k] * M1 + codes[k:]
            inside = place[:len(h)] + k < n[word[:len(h)]]
            first, last = place[:len(h)] == 0, place[:len(h)] + k == n[word[:len(h)]] - 1
            for kind, some in (((0, ~first & ~last), (1, first & ~last), (2, last & ~first)) if k else ()):
                at = np.flatnonzero(inside & some)
                at = at if k < GRAMS or kind else at[:0]           # affixes hold one edge besides their letters
                own.append(word[at])
                feature.append(mixed(h[at], 8 * k + kind))
        at = np.flatnonzero((place > 0) & (place < n[word] - 1))
        own.append(word[at])
        feature.append(mixed(codes[at], 3))                        # single letters
        own.append(np.arange(len(n)))
        feature.append(mixed(np.add.reduceat(codes * (place.astype(np.uint64) * M2 + M1), end - n), 4))
        known = [self.lexicon.get(w) for w in words]
        at = np.array([i for i, x in enumerate(known) if x is not None], dtype=np.int64)
        levels = np.frombuffer(b"".join([x for x in known if x is not None]), np.uint8).reshape(-1, self.languages)
        slots = (np.arange(self.languages) * LEVELS + levels).astype(np.uint64)
        own.append(np.repeat(at, self.languages))
        feature.append(mixed(slots.ravel(), 5))
        unknown = np.array([i for i, x in enumerate(known) if x is None], dtype=np.int64)
        own.append(unknown)
        feature.append(mixed(np.zeros(len(unknown), dtype=np.uint64), 6))
        own, feature = np.concatenate(own), np.concatenate(feature)
        return own, feature, (1 / np.sqrt(np.bincount(own, minlength=len(n))))[own]


def words_of(raw: list[str], cache: dict[str, str]) -> list[str]:
    """The cores of the words that hold a letter."""
    out = []
    for w in raw:
        if (c := cache.get(w)) is None:
            c = cache[w] = core(w) if LETTER.search(w) else ""
        if c:
            out.append(c)
    return out


class Field:
    """Weights of features and transitions; languages in order of their names."""

    def __init__(self, languages: list[str], weights: np.ndarray, step: np.ndarray, start: np.ndarray):
        self.languages, self.weights, self.step, self.start = languages, weights, step, start

    def scores(self, own: np.ndarray, feature: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
        """Emission scores of n words from their features."""
        w = self.weights[feature] * weight[:, None]
        return np.stack([np.bincount(own, w[:, k], minlength=n) for k in range(len(self.languages))], axis=1)

    def marginals(self, scores: np.ndarray, begin: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Forward-backward over sequences of n words from ``begin`` on, all
        sequences a step at a time: each word's probabilities, and the expected
        number of each transition."""
        e = np.exp(scores - scores.max(axis=1, keepdims=True, initial=-np.inf))
        step, start = np.exp(self.step), np.exp(self.start)
        order = np.argsort(-n, kind="stable")
        begin, n = begin[order][n[order] > 0], n[order][n[order] > 0]
        longest = int(n.max(initial=0))
        open_ = np.searchsorted(-n, -np.arange(longest + 1), "left")         # sequences with more than t words
        forward = np.empty_like(e)
        a = None
        for t in range(longest):
            rows = begin[:open_[t]] + t
            a = (a[:len(rows)] @ step if t else start) * e[rows]
            a /= a.sum(axis=1, keepdims=True)
            forward[rows] = a
        out, turns = forward, np.zeros_like(step)
        back = np.ones((len(n), e.shape[1]))
        for t in range(longest - 1, 0, -1):
            rows = begin[:open_[t]] + t
            b = e[rows] * back[:len(rows)]
            before = forward[rows - 1]
            z = ((before @ step) * b).sum(axis=1, keepdims=True)
            turns += step * ((before / z).T @ b)
            b = b @ step.T
            back[:len(rows)] = b / b.sum(axis=1, keepdims=True)
            # the word before is final once its backward message is known; its
            # forward message is not needed again
            final = before * back[:len(rows)]
            out[rows - 1] = final / final.sum(axis=1, keepdims=True)
        return out, turns


def train(sample: list[tuple[str, list[list[str]]]], seed: int = 11) -> tuple[Field, dict[str, bytes]]:
    """A field and its lexicon from (language, windows of words) of documents."""
    languages = sorted({lang for lang, _ in sample})
    number = {lang: k for k, lang in enumerate(languages)}
    docs_with: Counter[str] = Counter()
    uses: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(len(languages)))
    for lang, windows in sample:
        docs_with.update(set(itertools.chain.from_iterable(windows)))
        for w in itertools.chain.from_iterable(windows):
            uses[w][number[lang]] += 1
    total = np.sum(list(uses.values()), axis=0) if uses else np.ones(len(languages))
    lexicon = {}
    for w, d in docs_with.items():
        if d >= LEXICON_DOCS:
            rate = (uses[w] + 0.1) / (total + 1)
            lexicon[w] = np.minimum(rate / rate.sum() * LEVELS, LEVELS - 1).astype(np.uint8).tobytes()
    # every window of every document once, joined to sequences: alike, or cut and mixed
    rng = np.random.default_rng(seed)
    runs: list[list[tuple[str, int]]] = []
    for lang, windows in sample:
        for k, w in enumerate(windows):
            if k % 2:
                cuts = np.cumsum(rng.integers(*SPANS, len(w) // SPANS[0] + 1))
                runs += [[(x, number[lang]) for x in w[lo:hi]] for lo, hi in zip([0, *cuts], cuts) if lo < len(w)]
            else:
                runs.append([(x, number[lang]) for x in w])
    alike = [r for r in runs if len(r) == WINDOW_WORDS]
    rng.shuffle(runs)
    stream = [x for r in runs for x in r] + [x for r in alike for x in r]
    words = list(dict.fromkeys(w for w, _ in stream))
    index = {w: i for i, w in enumerate(words)}
    ids, label = (np.array(x, dtype=np.int64) for x in (([index[w] for w, _ in stream]), [y for _, y in stream]))
    field = Field(languages, np.zeros((1 << DIM_BITS, len(languages))), np.zeros((len(languages),) * 2),
                  np.zeros(len(languages)))
    if not words:
        return field, lexicon
    own, feature, weight = Features(lexicon, len(languages))(words)
    by = np.argsort(own, kind="stable")
    feature, weight = feature[by], weight[by]
    first = np.append(0, np.cumsum(np.bincount(own, minlength=len(words))))
    begins = np.arange(0, len(ids), SEQUENCE)
    seen = [np.full_like(x, 1e-4) for x in (field.weights, field.step, field.start)]
    for _ in range(EPOCHS):
        for some in np.array_split(rng.permutation(begins), max(1, len(begins) // BATCH)):
            n = np.minimum(SEQUENCE, len(ids) - some)
            at = np.concatenate([np.arange(b, b + k) for b, k in zip(some, n)])
            begin = np.cumsum(n) - n
            u, back = np.unique(ids[at], return_inverse=True)
            sizes = first[u + 1] - first[u]
            rows = np.repeat(first[u] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
            word = np.repeat(np.arange(len(u)), sizes)
            scores = field.scores(word, feature[rows], weight[rows], len(u))
            gamma, turns = field.marginals(scores[back], begin, n)
            gamma[np.arange(len(at)), label[at]] -= 1
            g = np.stack([np.bincount(back, gamma[:, k], minlength=len(u)) for k in range(len(languages))], axis=1)
            f, where = np.unique(feature[rows], return_inverse=True)
            g = g[word] * weight[rows][:, None]
            g = np.stack([np.bincount(where, g[:, k], minlength=len(f)) for k in range(len(languages))], axis=1)
            inner = np.ones(len(at), dtype=bool)
            inner[begin] = False
            y = label[at]
            np.subtract.at(turns, (y[:-1][inner[1:]], y[1:][inner[1:]]), 1)
            for table, sums, row, d in ((field.weights, seen[0], f, g + L2 * field.weights[f]),
                                        (field.step, seen[1], slice(None), turns),
                                        (field.start, seen[2], slice(None), gamma[begin].sum(axis=0))):
                sums[row] += d * d
                table[row] -= RATE * d / np.sqrt(sums[row])
    return field, lexicon


def windows_of(words: list[str]) -> list[list[str]]:
    """Up to WINDOWS runs of words, evenly spaced over all of them."""
    every = [words[k:k + WINDOW_WORDS] for k in range(0, len(words), WINDOW_WORDS)]
    return [every[k * len(every) // min(WINDOWS, len(every))] for k in range(min(WINDOWS, len(every)))]


def training_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, place, text) to (lang, place, its windows)."""
    for b in batches:
        cut = [windows_of(words_of((x.as_py() or b"").decode("utf-8", "replace").split(), {}))
               for x in b.column(2).cast(pa.binary())]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(cut, pa.list_(pa.list_(pa.string())))],
                                         ["lang", "place", "windows"])


def train_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The whole bounded sample, in order, to one row that holds the model."""
    sample = [x for b in batches for x in zip(b.column(0).to_pylist(), b.column(2).to_pylist()) if x[1]]
    if sample:
        field, lexicon = train(sample)
        used = np.flatnonzero(field.weights.any(axis=1))
        state = (field.languages, used, field.weights[used].astype(np.float32), field.step, field.start, lexicon)
        yield pa.RecordBatch.from_arrays([pa.array([cloudpickle.dumps(state)], pa.binary())], ["model"])


def restored(state: tuple) -> tuple[Field, dict[str, bytes]]:
    languages, used, weights, step, start, lexicon = state
    full = np.zeros((1 << DIM_BITS, len(languages)), dtype=np.float32)
    full[used] = weights
    return Field(languages, full, step, start), lexicon


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % F.lit(3) == F.lit(1), F.lit(False))


def fit(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> bytes | None:
    """The model learnt from a bounded sample outside the held-out fold; None without any."""
    known = (docs.filter(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull()
                         & ~held_out(F.col("doc_id")))
             .select("lang", F.xxhash64("doc_id").alias("place"), "text"))
    sizes = known.groupBy("lang").agg(F.approx_count_distinct("place").alias("_docs"))           # one row per language
    languages = sizes.count()
    if not languages:
        return None
    each = max(LEAST_DOCS, train_docs // languages)
    # about twice as many by a share of the hash, so that ranking a large language takes no more rows than that
    share = F.pmod("place", F.lit(1 << 32)) / F.lit(float(1 << 32))
    some = (known.select("lang", "place").join(F.broadcast(sizes), "lang")
            .filter(share * F.col("_docs") < F.lit(2 * each)).select("lang", "place").distinct())
    order = F.row_number().over(Window.partitionBy("lang").orderBy("_share", "place"))
    last = (some.withColumn("_share", share).withColumn("_order", order).filter(F.col("_order") <= each)
            .groupBy("lang").agg(F.max("_share").alias("_last")))
    sample = (known.join(F.broadcast(last), "lang").filter(share <= F.col("_last"))              # one row per language
              .groupBy("lang", "place").agg(F.min("text").alias("text"))
              .select("lang", "place", "text")
              .mapInArrow(training_rows, "lang string, place long, windows array<array<string>>"))
    rows = (sample.repartition(1).sortWithinPartitions("place", "lang")                          # the bounded sample
            .mapInArrow(train_task, "model binary").collect())
    return bytes(rows[0].model) if rows else None


SPAN = T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("words", T.LongType()),
                                 T.StructField("lang", T.StringType())]))
SPAN_ARROW = pa.list_(pa.struct([("first", pa.int64()), ("words", pa.int64()), ("lang", pa.string())]))


class Labeller:
    """Texts to the field's probabilities of each of their words."""

    def __init__(self, field: Field, lexicon: dict[str, bytes]):
        self.field, self.features = field, Features(lexicon, len(field.languages))
        self.clear()

    def clear(self) -> None:
        self.cache: dict[str, int] = {}
        self.chars = 0
        self.scores = np.zeros((0, len(self.field.languages)))

    def add(self, raw: list[str]) -> None:
        """Emission scores of new words; those without a letter get -1."""
        cores = {w: core(w) for w in raw if LETTER.search(w)}
        words = list(cores)
        at = len(self.scores)
        self.cache.update(dict.fromkeys(raw, -1))
        self.cache.update(zip(words, range(at, at + len(words))))
        self.chars += sum(map(len, raw))
        parts = [self.scores]
        for lo in range(0, len(words), 1 << 14):
            some = [cores[w] for w in words[lo:lo + (1 << 14)]]
            parts.append(self.field.scores(*self.features(some), len(some)))
        self.scores = np.concatenate(parts)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities of all words with a letter, and their number in each text."""
        if len(self.cache) > CACHE_WORDS or self.chars > CACHE_CHARS:
            self.clear()
        cut = [(x.as_py() or b"").decode("utf-8", "replace").split() for x in texts.cast(pa.binary())]
        every = list(itertools.chain.from_iterable(cut))
        if new := [w for w in dict.fromkeys(every) if w not in self.cache]:
            self.add(new)
        place = np.fromiter(map(self.cache.__getitem__, every), np.int64, len(every))
        row = np.repeat(np.arange(len(cut)), [len(c) for c in cut])
        n = np.bincount(row[place >= 0], minlength=len(cut))
        return self.field.marginals(self.scores[place[place >= 0]], np.cumsum(n) - n, n)[0], n


def spans(best: np.ndarray, languages: list[str]) -> list[dict]:
    if not len(best):
        return []
    first = np.flatnonzero(np.r_[True, best[1:] != best[:-1]])
    return [{"first": int(a), "words": int(b - a), "lang": languages[best[a]]}
            for a, b in zip(first, [*first[1:], len(best)])]


def label(model, with_spans: bool):
    """(text, carried columns...) to the carried columns, lang_pred, score (and spans)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(*restored(cloudpickle.loads(model.value))) if model.value else None
        for b in common.byte_slices(batches):
            lang, score, runs = [UNKNOWN] * b.num_rows, np.zeros(b.num_rows), [[] for _ in range(b.num_rows)]
            if labeller:
                names = labeller.field.languages
                p, n = labeller(b.column(0))
                some = np.flatnonzero(n)
                begin = (np.cumsum(n) - n)[some]
                mean = np.add.reduceat(p, begin) / n[some, None] if len(some) else p[:0]
                best = mean.argmax(axis=1)
                score[some] = np.clip(mean[np.arange(len(some)), best], 0, 1)
                for i, k in zip(some.tolist(), best.tolist()):
                    lang[i] = names[k]
                if with_spans:
                    word = p.argmax(axis=1)
                    for i, at in zip(some.tolist(), begin.tolist()):
                        runs[i] = spans(word[at:at + n[i]], names)
            columns = [*b.columns[1:], pa.array(lang, pa.string()), pa.array(score)]
            fields = [*b.schema.names[1:], "lang_pred", "score"]
            if with_spans:
                columns.append(pa.array(runs, SPAN_ARROW))
                fields.append("spans")
            yield pa.RecordBatch.from_arrays(columns, fields)
    return run


def identify(docs: DataFrame, carry: list[str] | None = None, train_docs: int = TRAIN_DOCS,
             with_spans: bool = False) -> DataFrame:
    """``carry`` columns, held_out, lang_pred, score (and ``spans``: the runs of
    words with a letter, as first word, number of words, language)."""
    carry = [c for c in (carry or ["doc_id"]) if c not in ("held_out", "lang_pred", "score", "spans")]
    names = {f"_c{i}": c for i, c in enumerate(carry)}
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, train_docs))
    schema = T.StructType([T.StructField(k, docs.schema[c].dataType) for k, c in names.items()]
                          + [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
                          + [T.StructField("spans", SPAN)] * with_spans)
    src = docs.select("text", *[F.col(f"`{c}`").alias(k) for k, c in names.items()], held_out(F.col("doc_id")).alias("held_out"))
    schema.fields.insert(len(names), T.StructField("held_out", T.BooleanType()))
    schema.names.insert(len(names), "held_out")
    return src.mapInArrow(label(model, with_spans), schema).withColumnsRenamed(names)


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(common.table(spark, sf_dir, "documents"), ["doc_id"])
