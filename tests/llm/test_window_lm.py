"""The window network against sums by hand, finite differences, planted pairs and shuffled documents."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import xxhash
from pyspark.sql import functions as F

from marquee.llm import window_lm
from marquee.llm.registry import QUERIES
from rows import SCHEMA, documents, edge_rows


def test_scores_are_sums_of_conditionals(spark):
    docs = documents(spark, extra=True)
    got = window_lm.score(docs).collect()
    vocabulary, network = window_lm.fit(docs)
    read, w, end = vocabulary.reader(), window_lm.WINDOW, vocabulary.end
    want = []
    for i, text, *_ in edge_rows():
        s, share = (read((text or "").encode())[k] for k in ("leaf", "share"))
        seq = window_lm.framed([s], end)
        h = network.hidden(seq)[1] if len(s) else None
        total = sum(float(network.log_probability(h[k:k + 1], s[k:k + 1])[0]) + share[k]
                    for k in range(len(s)))
        assert len(seq) == len(s) + 2 * w
        want.append((str(i), len(s), total))
    have = sorted((str(r.doc_id), r.n_tokens, r.log_likelihood) for r in got)
    for a, b in zip(have, sorted(want), strict=True):
        assert a[:2] == b[:2] and abs(a[2] - b[2]) < 1e-4 * (1 + abs(b[2]))
    h = network.hidden(window_lm.framed([read(b"one two three")["leaf"]], end))[1][1]
    leaves = network.log_probability(np.repeat(h[None], end, axis=0), np.arange(end))
    assert abs(np.exp(leaves).sum() - 1) < 1e-4
    assert window_lm.score(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("cells", [window_lm.CELLS, 512])
def test_vocabulary_counts_every_word(spark, monkeypatch, cells):
    """Own leaves by frequency, shared leaves by hash, more of both for a larger
    corpus up to the bound; the words' probabilities are their frequencies while
    cells are many, and sum to one in any case."""
    monkeypatch.setattr(window_lm, "DEPTH_MAX", 10)
    monkeypatch.setattr(window_lm, "CELLS", cells)

    def corpus(n):
        rng = random.Random(n)
        return [[f"w{int(rng.paretovariate(0.6))}" for _ in range(100)] for _ in range(n)]

    own = []
    for size in (20, 400, 1000):
        texts = corpus(size)
        vocabulary, n, words = window_lm.count_words(
            documents(spark, [(i, " ".join(t), "en", "s", 1) for i, t in enumerate(texts)]).select("text"))
        count = Counter(w for t in texts for w in t)
        kinds = sorted(count)
        at = vocabulary.reader()(" ".join(kinds).encode())
        each = np.array([count[w] for w in kinds])
        assert words == each.sum() == n.sum() == 100 * size
        assert (np.bincount(at["leaf"], each, minlength=vocabulary.end) == n).all()
        p = n[at["leaf"]] / words * np.exp(at["share"].astype(float))
        assert abs(p.sum() - 1) < 1e-5
        if cells > 512:
            assert np.mean(np.abs(p * words / each - 1) < 1e-4) > 0.99
        assert (at["share"][at["leaf"] < len(vocabulary.hashes)] == 0).all()
        own.append(len(vocabulary.hashes))
        assert own[-1] <= 896
    assert own[1] > own[0] > 40 and own[2] == 896


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(3)
    network = window_lm.TreeNetwork.untrained(rng.integers(0, 50, 64).astype(float))
    for k, v in network.p.items():
        network.p[k] = v.astype(np.float64) + rng.normal(0, 0.2, v.shape)
    seq = window_lm.framed([rng.integers(0, 64, 40).astype(np.int32), rng.integers(0, 64, 3).astype(np.int32)], 64)
    full = {k: np.zeros_like(v) for k, v in network.p.items()}
    for k, rows, g, _ in network.gradients(seq):
        full[k][rows] += g
    for k, v in network.p.items():
        for i in rng.choice(v.size, 12, replace=False):
            if k == "place" and i // window_lm.HIDDEN == window_lm.WINDOW:
                continue
            at, loss = np.unravel_index(i, v.shape), []
            for step in (1e-3, -2e-3):
                v[at] += step
                loss.append(-network.score(seq).sum())
            v[at] += 1e-3
            assert abs((loss[0] - loss[1]) / 2e-3 - full[k][at]) < 0.02 * (1 + abs(full[k][at]))


def test_every_document_trains_whatever_the_size(spark):
    """Over the replicas of all rounds each word is an example exactly once, however large the corpus."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").repartition(8).select("text")
    vocabulary, n, words = window_lm.count_words(docs)
    assert words > 4_000_000
    model = docs.sparkSession.sparkContext.broadcast((vocabulary.state(), window_lm.TreeNetwork.untrained(n).state()))
    examples, (shares, epochs) = 0, window_lm.schedule(words)
    assert (shares, epochs) == (window_lm.ROUNDS, 1) and window_lm.schedule(10 ** 13) == (window_lm.ROUNDS, 1)
    assert window_lm.schedule(400_000)[0] == 1
    for k in range(window_lm.ROUNDS):
        rows = (docs.filter(F.pmod(F.xxhash64("text"), F.lit(shares)) == k % shares)
                .mapInArrow(window_lm.replica(model, 1), "name string, block long, part long, n binary, v binary")
                .filter("name = 'place'").collect())
        examples += sum(np.frombuffer(r.n, np.float32).max() for r in rows)
    assert abs(examples - words) < 1e-3 * words


def test_held_out_texts_beat_the_unigram_model(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    vocabulary, network = window_lm.fit(docs.filter("doc_id % 5 != 0"))
    unigram = window_lm.TreeNetwork(network.depth, network.bias, network.p | {"tree": network.p["tree"] * 0})
    read, gain, n = vocabulary.reader(), 0.0, 0
    for r in docs.filter("doc_id % 5 = 0").collect():
        seq = window_lm.framed([read((r.text or "").encode())["leaf"]], vocabulary.end)
        gain += network.score(seq).sum() - unigram.score(seq).sum()
        n += len(seq) - 2 * window_lm.WINDOW
    assert n > 50_000 and gain / n > 0.05


def test_texts_that_occur_twice_score_above_others(spark, tmp_path):
    """What a model of the whole corpus knows: passages planted twice, against passages planted once."""
    table = pq.read_table("/root/testdata/sf0.01/documents.parquet")["text"].to_pylist()
    rng = random.Random(9)
    fresh = lambda: " ".join("".join(rng.choice("bcdfgaeiou") for _ in range(rng.randint(3, 8))) for _ in range(80))
    twice, once = [fresh() for _ in range(40)], [fresh() for _ in range(200)]
    rows = list(enumerate(table)) + [(10_000 + i, t) for i, t in enumerate(twice + once)] + [(20_000 + i, t) for i, t in enumerate(twice)]
    got = query(spark, tmp_path, rows)
    bar = np.quantile([got[10_040 + i] for i in range(200)], 0.9)
    assert np.mean([got[10_000 + i] > bar for i in range(40)]) > 0.9


def query(spark, path, rows):
    pq.write_table(pa.table({"doc_id": [i for i, _ in rows], "text": [t for _, t in rows]}), path / "documents.parquet")
    return {r.doc_id: r.mean_log_likelihood for r in QUERIES["op2_lm_scoring"](spark, str(path)).collect()}


def test_words_three_places_away_decide_among_many(spark, tmp_path):
    """Each of 150 keys has its own word three places later; a text with these exchanged scores lowest."""
    rng = random.Random(8)

    def text(turn):
        return " ".join(f"key{k} f{rng.randrange(9)} f{rng.randrange(9)} value{(k + turn) % 150}"
                        for k in rng.choices(range(150), k=50))
    got = query(spark, tmp_path, [(i, text(0)) for i in range(1000)] + [(1000 + i, text(1 + i)) for i in range(20)])
    assert max(got[1000 + i] for i in range(20)) < min(got[i] for i in range(1000))


def test_shuffled_documents_score_lower(spark, tmp_path):
    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet")["text"].to_pylist()
    rng, rows = random.Random(6), list(enumerate(texts))
    picked = [i for i, t in rows if len((t or "").split()) >= 100][::10]
    for i in picked:
        words = texts[i].split()
        rows.append((10_000 + i, " ".join(rng.sample(words, len(words)))))
    got = query(spark, tmp_path, rows)
    less = [got[i] - got[10_000 + i] for i in picked]
    assert len(picked) > 50 and np.mean(np.array(less) > 0) > 0.9 and np.mean(less) > 0.15


@pytest.mark.parametrize("documents_of", [40, 1200])
def test_one_law_of_training_for_any_size(spark, monkeypatch, tmp_path, documents_of):
    """The replicas read each document once and pass over it once: a small corpus no more often than a large one."""
    assert len({window_lm.schedule(n) for n in (1, 1000, 400_000, 999_999, 1_000_001, 10 ** 8, 10 ** 13)}) == 1
    monkeypatch.setattr(window_lm, "REPLICA_WORDS", 10_000)
    train, passes, folder = window_lm.replica, [], str(tmp_path)

    def replica(model, epochs):
        def run(batches):
            import pathlib
            import uuid

            def read():
                for b in batches:
                    pathlib.Path(folder, uuid.uuid4().hex).write_text("\n".join(x.split()[0] for x in b.column(0).to_pylist()))
                    yield b
            yield from train(model, epochs)(read())
        passes.append(epochs)
        return run
    monkeypatch.setattr(window_lm, "replica", replica)
    window_lm.fit(documents(spark, [(i, f"t{i} " + "a b c d " * 25, "en", "s", 1) for i in range(documents_of)]))
    names = [w for p in tmp_path.iterdir() for w in p.read_text().split()]
    assert sorted(names) == sorted(f"t{i}" for i in range(documents_of))
    assert set(passes) == {1}


@pytest.mark.parametrize("kind", [np.float32, np.float64])
def test_sums_of_runs(kind):
    rng = np.random.default_rng(5)
    for n in ([1] * 9, [4], [1, 1, 3, 2, 1, 7, 1, 1, 1], rng.integers(1, 4, 500), [2, 1], [1]):
        n = np.array(n)
        rows, first = rng.normal(0, 1, (n.sum(), window_lm.HIDDEN)).astype(kind), np.r_[0, np.cumsum(n)[:-1]]
        got = window_lm.run_sums(rows, first, n)
        assert got.dtype == kind and np.allclose(got, np.add.reduceat(rows, first), atol=1e-5)


def test_log_probability_of_the_deepest_unlikely_leaf_is_finite():
    """Choices at the limit all the way down the deepest tree: their product is the sum of their logs."""
    network = window_lm.TreeNetwork.untrained(np.ones(1 << window_lm.DEPTH_MAX))
    network.bias[:] = 80
    got = network.log_probability(np.zeros((2, window_lm.HIDDEN), np.float32), np.array([0, network.p["tree"].shape[0] - 1]))
    assert np.allclose(got, [-window_lm.DEPTH_MAX * np.log1p(np.exp(30)), -window_lm.DEPTH_MAX * np.log1p(np.exp(-30))])


def test_columns_of_texts_have_the_words_of_each_text():
    texts = [None, b"", b" \t\n", b"One two  oNE", b"\n\x0b lead\x0ctrail\r\n", "Straße ÉTÉ\x85x y\x1cz".encode(), b"\xff\xfe Bad\xc3 one"]
    words = [(t or b"").lower().split() for t in texts]
    for lo, hi in ((0, 7), (3, 7), (0, 3), (2, 2)):
        column = pa.array(texts, pa.binary())
        column = pa.Array.from_buffers(pa.string(), len(column), column.buffers()).slice(lo, hi - lo)
        n, h, at = window_lm.distinct_words(column)
        every = [w for t in words[lo:hi] for w in t]
        assert n.tolist() == [len(t) for t in words[lo:hi]]
        assert h[at].tolist() == [xxhash.xxh3_64_intdigest(w) >> 1 for w in every]
        batch = pa.RecordBatch.from_arrays([column], ["text"])
        counts = [r for b in window_lm.word_counts(iter([batch])) for r in b.to_pylist()]
        assert {r["hash"]: r["n"] for r in counts} == Counter(xxhash.xxh3_64_intdigest(w) >> 1 for w in every)
        each = window_lm.Vocabulary(np.sort(h)[:1], 3, np.zeros(70, np.float32)).reader()(column) if len(h) else []
        assert [len(x) for x in each] == [len(t) for t in words[lo:hi]][:len(each)]


def test_hashes_of_columns_are_those_of_the_library():
    rng = random.Random(4)
    words = [rng.randbytes(n) for n in [*range(40)] * 30]
    rng.shuffle(words)
    ends = np.cumsum([0] + [len(w) for w in words])
    got = window_lm.word_hashes(b"".join(words), ends)
    assert got.tolist() == [xxhash.xxh3_64_intdigest(w) for w in words]
    assert window_lm.word_hashes(b"ab", np.array([0, 2])).tolist() == [xxhash.xxh3_64_intdigest(b"ab")]
    assert window_lm.word_hashes(b"", np.zeros(1, np.int64)).tolist() == []


def test_short_words_are_hashed_as_columns(monkeypatch):
    """No call a word for words of up to 16 bytes, which are nearly all."""
    text, calls, library = "a few words of ordinary length, antidisestablishmentarianism", [], xxhash.xxh3_64_intdigest
    monkeypatch.setattr(window_lm.xxhash, "xxh3_64_intdigest", lambda w: calls.append(w) or library(w))
    n, h, at = window_lm.distinct_words(pa.array([text] * 3))
    assert calls == [b"antidisestablishmentarianism"]
    assert h[at].tolist() == [library(w.encode()) >> 1 for w in text.split()] * 3


def test_counts_are_whole_however_often_they_are_given_out(monkeypatch):
    rng = random.Random(2)
    texts = [" ".join(f"w{int(rng.paretovariate(0.7)) % 5000}" for _ in range(300)) for _ in range(200)]
    monkeypatch.setattr(window_lm, "SLICE_ROWS", 7)
    for held in (1, 300, 4000, 1 << 20):
        monkeypatch.setattr(window_lm, "COUNTED", held)
        batches = list(window_lm.word_counts(iter(pa.RecordBatch.from_pydict({"text": texts[i:i + 50]}) for i in range(0, 200, 50))))
        got = Counter()
        for b in batches:
            assert len(set(b.column(0).to_pylist())) == b.num_rows
            got.update({r["hash"]: r["n"] for r in b.to_pylist()})
        assert got == Counter(xxhash.xxh3_64_intdigest(w.encode()) >> 1 for t in texts for w in t.split())
    assert sum(b.num_rows for b in window_lm.word_counts(iter([]))) == 0


def test_examples_of_a_pass_are_counted_by_row(monkeypatch):
    """Each node's words below it, each leaf's uses in the steps, borders of steps twice; a step without words is none."""
    monkeypatch.setattr(window_lm, "BATCH", 16)
    rng = np.random.default_rng(6)
    seqs = [window_lm.framed([rng.integers(0, 64, n).astype(np.int32) for n in sizes], 64)
            for sizes in ((40, 0, 7), [0] * 20, (5,) + (0,) * 30, ())]
    network = window_lm.TreeNetwork.untrained(rng.integers(0, 50, 64).astype(float))
    want = {k: np.zeros(len(v)) for k, v in network.p.items()}
    for seq in seqs:
        for at in range(0, len(seq) - 2 * window_lm.WINDOW, 16):
            for k, rows, _, n in network.gradients(seq[at:at + 16 + 2 * window_lm.WINDOW]):
                want[k][rows] += n
    got = network.fit(iter(seqs))
    assert want["tree"][0] == 52
    assert all((got[k] == want[k]).all() and got[k].dtype == np.float32 for k in want)
    assert not any(v.any() for v in network.fit(iter([])).values())
