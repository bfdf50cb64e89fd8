"""The field against enumeration, and predictions of texts it never saw."""

import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq

from marquee.llm import language_id
from marquee.llm.registry import QUERIES
from rows import SCHEMA, documents, edge_rows

SF = "/root/testdata/sf0.01"


def is_held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 1


def test_marginals_and_transitions_by_enumeration():
    rng = np.random.default_rng(1)
    for lengths in ([5], [3, 0, 6, 1], [1]):
        field = language_id.Field(["a", "b", "c"], np.zeros((1, 3)), rng.normal(size=(3, 3)), rng.normal(size=3))
        n = np.array(lengths)
        begin = np.cumsum(n) - n
        scores = rng.normal(size=(n.sum(), 3))
        want, turns = np.zeros((n.sum(), 3)), np.zeros((3, 3))
        for b, k in zip(begin, n):
            total, own, moves = 0.0, np.zeros((k, 3)), np.zeros((3, 3))
            for way in itertools.product(range(3), repeat=int(k)) if k else ():
                p = np.exp(field.start[way[0]] + sum(scores[b + i, y] for i, y in enumerate(way))
                           + sum(field.step[x, y] for x, y in zip(way, way[1:])))
                total += p
                own[range(k), way] += p
                for x, y in zip(way, way[1:]):
                    moves[x, y] += p
            if k:
                want[b:b + k] = own / total
                turns += moves / total
        got = field.marginals(scores, begin, n)
        assert np.allclose(got[0], want) and np.allclose(got[1], turns)


def test_features_do_not_depend_on_neighbours():
    features = language_id.Features({"über": bytes([1, 5])}, 2)
    words = ["a", "über", "x" * 70, "日本語", "aa"]
    own, feature, weight = features(words)
    for i, w in enumerate(words):
        alone = features([w])
        assert sorted(feature[own == i]) == sorted(alone[1]) and np.allclose(weight[own == i] ** 2, 1 / (own == i).sum())
        k = len(w)
        grams = sum(max(0, k - g + 1) for g in range(1, 5))
        affixes = 2 * min(k, 4) if k != 4 else 8
        assert len(alone[1]) == grams + affixes + 1 + (2 if w == "über" else 1)


def test_held_out_documents(spark):
    got = {r.doc_id: r for r in QUERIES["op12_language_id"](spark, SF).collect()}
    table = pq.read_table(f"{SF}/documents.parquet").to_pylist()
    assert len(got) == len(table)
    right = []
    for r in table:
        g = got[r["doc_id"]]
        assert g.held_out == is_held_out(r["doc_id"]) and 0 <= g.score <= 1
        if r["lang"] and g.lang_pred != "und" and g.held_out:
            right.append(g.lang_pred == r["lang"])
    assert len(right) > 200 and np.mean(right) > 0.98


def test_held_out_labels_are_not_read(spark):
    """The same predictions when every held-out row's lang, source and text neighbours change."""
    table = pq.read_table(f"{SF}/documents.parquet").to_pylist()[:400]
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in table]
    other = [r if not is_held_out(r[0]) else (r[0], r[1], "xx", "other", 0) for r in rows]
    runs = [language_id.identify(documents(spark, x), train_docs=80).collect() for x in (rows, other)]
    assert sorted(map(tuple, runs[0])) == sorted(map(tuple, runs[1]))


def test_code_switched_text(spark):
    """Runs of words of two languages in one held-out text are found again."""
    table = pq.read_table(f"{SF}/documents.parquet").to_pylist()
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in table]
    rng, texts = random.Random(3), {}
    for r in table:
        w = [x for x in (r["text"] or "").split() if any(c.isalpha() for c in x)]
        if is_held_out(r["doc_id"]) and len(set(w)) > 80:
            texts.setdefault(r["lang"], []).append(w)
    want, free = {}, (i for i in range(10_000, 20_000) if is_held_out(i))
    for _ in range(30):
        langs = rng.sample(["de", "en", "fr", "es"], 2) * 2
        parts = [rng.choice(texts[k])[:rng.randint(20, 60)] for k in langs]
        i = next(free)
        want[i] = [k for k, p in zip(langs, parts) for _ in p]
        rows.append((i, " \n".join(" ".join(p) for p in parts), None, None, None))
    got = language_id.identify(documents(spark, rows), with_spans=True).filter("doc_id >= 10000").collect()
    hits, n_spans = [], []
    for r in got:
        have = [s.lang for s in r.spans for _ in range(s.words)]
        assert [s.first for s in r.spans] == list(np.cumsum([0] + [s.words for s in r.spans])[:-1])
        hits += [a == b for a, b in zip(have, want[r.doc_id], strict=True)]
        n_spans.append(len(r.spans))
    assert np.mean(hits) > 0.95 and 4 <= np.mean(n_spans) < 7


def test_edge_rows(spark):
    docs = documents(spark, extra=True).selectExpr("*", "1 as lang_pred", "2 as held_out", "3 as spans")
    got = language_id.identify(docs, ["doc_id", "n_chars"], with_spans=True).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in edge_rows())
    assert {r.lang_pred for r in got if r.doc_id in (7, 8, 9)} == {"und"} and {r.lang_pred for r in got} <= {"und", "en", "de"}
    assert all((r.score == 0) == (r.lang_pred == "und") and r.held_out == is_held_out(r.doc_id) for r in got)
    assert language_id.identify(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(1, "123 $$ ४", "en", "a", 1), (2, "one two", None, "a", 1), (None, "three", "fr", "a", 1)]
    assert {r.lang_pred for r in language_id.identify(documents(spark, rows)).collect()} == {"und"}
    one = language_id.identify(documents(spark, [(i, "ab cd", "en", "a", 1) for i in range(5)])).collect()
    assert {(r.lang_pred, r.score) for r in one} == {("en", 1.0)}


def test_scores_do_not_depend_on_the_batch():
    table = pq.read_table(f"{SF}/documents.parquet").to_pylist()[:120]
    sample = [(r["lang"], language_id.windows_of(language_id.words_of(r["text"].split(), {}))) for r in table]
    labeller = language_id.Labeller(*language_id.train(sample))
    together, n = labeller(pa.array([r["text"] for r in table]))
    alone = [labeller(pa.array([r["text"]]))[0] for r in table]
    assert n.sum() == len(together) and np.allclose(np.concatenate(alone), together)
