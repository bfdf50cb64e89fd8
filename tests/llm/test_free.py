"""The operators outside SQL against brute force, round trips and held-out accuracy."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from marquee.llm import (classifier, embedding_dedup, html_extract, line_dedup, ngram_join, packing, window_lm)
from marquee.llm.components import components
from marquee.llm.html_pages import LABELLED_PAGES
from marquee.llm.registry import ORACLE, QUERIES
from rows import SCHEMA, documents, edge_rows, prose

SF = "/root/testdata/sf0.001"


def closure(nodes, pairs):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for a, b in pairs:
        parent[find(a)] = find(b)
    groups = defaultdict(list)
    for n in nodes:
        groups[find(n)].append(n)
    return {n: g for g in groups.values() for n in g}


# ---- components

def test_components_of_chains_hubs_and_rings(spark):
    rng = random.Random(1)
    ids = list(range(2000))
    rng.shuffle(ids)
    pairs = list(zip(ids[:500], ids[1:500])) + [(ids[600], x) for x in ids[601:1200]]
    pairs += list(zip(ids[1300:1400], ids[1301:1400])) + [(ids[1399], ids[1300]), (5, 5)]
    want = closure(ids, pairs)
    got = components(spark.createDataFrame(pairs + pairs[:10], "a long, b long")).collect()
    assert len(got) == len({r.node for r in got}) == 500 + 600 + 100
    assert all(r.root == min(want[r.node]) for r in got)
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


# ---- n-gram join

def shingles(text, k):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def brute_components(rows, k, percent):
    """rows: (doc_id, text); the least id of each row's component."""
    sets = [shingles(t, k) for _, t in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j]
             and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    groups = closure(range(len(rows)), pairs)
    return [min((rows[j][0] for j in groups[i] if rows[j][0] is not None), default=None) for i in range(len(rows))]


def mutated(seed, n_base, n_copies, n_words):
    """Copies at all distances around the threshold, in sizes that cross bands."""
    rng = random.Random(seed)
    out = []
    for _ in range(n_base):
        w = prose(rng, rng.randint(1, n_words)).split()
        for _ in range(n_copies):
            c = list(w)
            for _ in range(rng.randint(0, 1 + len(c) // 25)):
                c[rng.randrange(len(c))] = rng.choice(["x", "y", "the"])
            out.append(" ".join(c + prose(rng, rng.randint(0, 1 + len(c) // 12)).split()))
    rng.shuffle(out)
    return [(i, t, "en", "s", 1) for i, t in enumerate(out)]


def mutated_ids(rows, by):
    return [(i + by, *r) for i, *r in rows]


def passages(n):
    """Unlike texts that share one long passage, and near copies among them."""
    rng = random.Random(3)
    passage = prose(rng, 60)
    own = [f"{prose(rng, rng.randint(5, 60))} {passage}" for _ in range(n)]
    return [(i, t, "en", "s", 1) for i, t in enumerate(own + [own[0] + " end"] + [o + " fin" for o in own[:9]])]


@pytest.mark.parametrize("rows,k,percent", [
    (None, 5, 80), (mutated(1, 25, 12, 120) + mutated_ids(mutated(4, 3, 60, 300), 10_000), 4, 85),
    (mutated(2, 60, 5, 40), 5, 80), (passages(150), 4, 85)])
def test_ngram_join_is_brute_force(spark, rows, k, percent):
    rows = rows or edge_rows()
    want = brute_components([r[:2] for r in rows], k, percent)
    got = ngram_join.near_duplicates(documents(spark, rows, extra=True), k, percent).collect()
    named = {(r[0], r[1]): (len(shingles(r[1], k)), c) for r, c in zip(rows, want)}
    assert len(got) == len(rows)
    assert all(named[r.doc_id, r.text] == (r.n_shingles, r.component_id) for r in got)


@pytest.mark.parametrize("name,table", [("op3_ngram_jaccard_join", "documents"), ("op5_embedding_near_dedup", "embeddings")])
def test_joins_match_sql(spark, name, table):
    import duckdb
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.sql(f"create view {table} as select * from '{sf}/{table}.parquet'")
    ours = QUERIES[name](spark, sf)
    cols = sorted(ours.columns)
    theirs = con.sql(ORACLE[name]).project(", ".join(cols)).fetchall()
    assert sorted(tuple(r) for r in ours.select(cols).collect()) == sorted(theirs)


def test_keep_one_of_each_group(spark):
    rows = edge_rows()
    named = {(i, t): (c, bool(shingles(t, 5))) for (i, t, *_), c in zip(rows, brute_components([r[:2] for r in rows], 5, 80))}
    kept = [(r.doc_id, r.text) for r in ngram_join.keep_one(documents(spark), 5, 80).collect()]
    worded = [x for x in kept if named[x][1]]
    assert all(x[0] == named[x][0] for x in worded) and len(worded) == len(set(worded))
    # every group once: by its least id, or by itself where it has no id
    assert {i for i, _ in worded if i is not None} == {c for c, w in named.values() if w and c is not None}
    assert sum(i is None for i, _ in worded) == sum(c is None and w for c, w in named.values()) == 2
    assert len(kept) - len(worded) == sum(not shingles(r[1], 5) for r in rows)


def test_left_over_candidates_do_not_need_the_leader(spark):
    """Links between nodes that are unlike their tile's leader are found, also across blocks."""
    old, ngram_join.BLOCK = ngram_join.BLOCK, 4
    try:
        rows = passages(40) + [(1000 + i, t + " tail", "en", "s", 1) for i, t, *_ in passages(40)[:20]]
        want = brute_components([r[:2] for r in rows], 4, 85)
        got = {r.doc_id: r.component_id for r in ngram_join.near_duplicates(documents(spark, rows), 4, 85).collect()}
        assert [got[r[0]] for r in rows] == want
    finally:
        ngram_join.BLOCK = old


# ---- packing

def test_ids_are_the_tokenizers():
    tok = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    words = packing.WordIds()
    rng = random.Random(2)
    alphabet = "abcXYZéÉßñ 019.,!?'’-_@#<|>\t\n\r\x0b\x0c\x1c\x85\xa0\xad　ΣσςİıﬁÅÅ漢字한글🙂‍ा्"
    samples = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(4000)]
    samples += ["<|endoftext|> a<|startoftext|>b", "don't I'll they've 's're ''s", "ÅÅ é x̀", "İSTANBUL"]
    samples += [r["text"] or "" for r in pq.read_table(f"{SF}/documents.parquet", columns=["text"]).to_pylist()]
    for s in samples:
        want = tok.encode(s, add_special_tokens=False).ids
        assert np.frombuffer(words.text(s.encode()), "<u4").tolist() == want, repr(s)


def check_packing(rows, got, capacity):
    words = packing.WordIds()
    want = Counter()
    for r in rows:
        ids = words.text((r[1] or "").encode()) + np.array([packing.END_ID], "<u4").tobytes()
        for k, at in enumerate(range(0, len(ids), 4 * capacity)):
            part = ids[at:at + 4 * capacity]
            want[r[0], k, at // 4, len(part) // 4, zlib.crc32(part)] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


@pytest.mark.parametrize("extra", [False, True])
def test_packing_edge_rows(spark, extra):
    got = packing.pack(documents(spark, extra=extra)).collect()
    check_packing(edge_rows(), got, packing.CAPACITY)
    assert packing.pack(spark.createDataFrame([], SCHEMA)).collect() == []


def test_packing_query_is_tight(spark):
    got = QUERIES["op4_packing"](spark, "/root/testdata/sf0.01").collect()
    t = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    bins = check_packing([(r["doc_id"], r["text"]) for r in t], got, packing.CAPACITY)
    assert bins <= -(-sum(r.length for r in got) // packing.CAPACITY) + 1


def test_blocks_number_a_hot_length_without_gaps(spark):
    old, packing.BLOCK_ROWS = packing.BLOCK_ROWS, 50
    try:
        rows = [(i, "same text here", "en", "s", 1) for i in range(900)] + [(900 + i, "a " * i, "en", "s", 1) for i in range(90)]
        got = packing.pack(documents(spark, rows), capacity=64).collect()
        check_packing(rows, got, 64)
    finally:
        packing.BLOCK_ROWS = old


def test_plans_are_near_the_bound():
    rng = random.Random(9)
    for _ in range(60):
        cap = rng.choice([10, 64, 500])
        counts = Counter(min(cap, int(rng.lognormvariate(2.5, 1.2)) + 1) for _ in range(rng.randint(1, 800)))
        used = Counter()
        bins = 0
        for times, pattern in packing.plan(dict(counts), cap):
            assert sum(k * n for k, n in pattern.items()) <= cap
            for k, n in pattern.items():
                used[k] += times * n
            bins += times
        assert used == counts
        big = sum(n for k, n in counts.items() if 2 * k > cap)
        bound = max(-(-sum(k * n for k, n in counts.items()) // cap), big)
        assert bins <= 1.1 * bound + 2


def test_two_pieces_replace_the_smallest():
    # greedy: 60 + 30 leaves 10; 20 + 20 in place of the 30 fill the bin
    patterns = packing.plan({60: 1, 30: 1, 20: 2}, 100)
    assert patterns[0] == (1, {60: 1, 20: 2})


# ---- embeddings

def brute_links(rows, min_cosine):
    ok = [i for i, (v, e, y) in enumerate(rows)
          if v is not None and y is not None and e and all(x is not None and np.isfinite(x) for x in e) and any(e)]
    pairs = []
    for a in range(len(ok)):
        for b in range(a):
            (_, x, y), (_, u, z) = rows[ok[a]], rows[ok[b]]
            if y == z and len(x) == len(u):
                x, u = np.array(x, dtype=np.float64), np.array(u, dtype=np.float64)
                if x @ u / (np.linalg.norm(x) * np.linalg.norm(u)) >= min_cosine:
                    pairs.append((ok[a], ok[b]))
    n = Counter(i for p in pairs for i in p)
    groups = closure(range(len(rows)), pairs)
    least = [min((rows[j][0] for j in groups[i] if rows[j][0] is not None), default=None) for i in range(len(rows))]
    return [(rows[i][0], n[i], least[i]) for i in range(len(rows))]


def vectors(seed, n, dim, noise):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(n // 6, dim))
    out = []
    for i in range(n):
        x = centres[r.integers(len(centres))] + noise * r.normal(size=dim) * r.random()
        out.append((i, x.astype(np.float32).tolist(), int(r.integers(3))))
    nan, inf = float("nan"), float("inf")
    x = out[0][1]
    out += [(n, x, out[0][2]), (n + 1, [2 * v for v in x], out[0][2]), (n + 2, x, None), (n + 3, None, 1),
            (n + 4, [0.0] * dim, 1), (n + 5, [nan] + x[1:], 1), (n + 6, [inf] + x[1:], 1), (n + 7, [None] + x[1:], 1),
            (n + 8, [], 1), (n + 9, x[:2], out[0][2]), (n + 10, x[:2], out[0][2]), (None, x, out[0][2]),
            (n + 11, [-v for v in x], out[0][2])]
    return out


@pytest.mark.parametrize("n,dim,noise,block", [(400, 8, 0.25, 1024), (300, 64, 0.2, 1024), (300, 6, 0.3, 16)])
def test_embedding_dedup_is_brute_force(spark, n, dim, noise, block):
    rows = vectors(n, n, dim, noise)
    old, embedding_dedup.BLOCK = embedding_dedup.BLOCK, block
    cells, embedding_dedup.CELL_CLASSES = embedding_dedup.CELL_CLASSES, 4
    try:
        df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
        df = df.selectExpr("*", "1 as n_links", "2 as cls", "3 as cell")
        got = embedding_dedup.near_duplicates(df).collect()
    finally:
        embedding_dedup.BLOCK, embedding_dedup.CELL_CLASSES = old, cells
    want = Counter(brute_links(rows, 0.98))
    assert Counter((r.vec_id, r.n_links, r.component_id) for r in got) == want
    assert all(r.kept == (r.vec_id is None or r.vec_id == r.component_id) for r in got)


def test_embedding_query(spark):
    t = pq.read_table(f"{SF}/embeddings.parquet").to_pylist()
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in t]
    got = QUERIES["op5_embedding_near_dedup"](spark, SF).collect()
    assert Counter((r.vec_id, r.n_links, r.component_id) for r in got) == Counter(brute_links(rows, 0.98))
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embedding_dedup.near_duplicates(empty).collect() == []


# ---- classifier

def test_classifier_on_the_held_out_fold(spark):
    sf = "/root/testdata/sf0.1"
    got = {r.doc_id: r for r in QUERIES["op7_quality_classifier"](spark, sf).collect()}
    labels = pq.read_table(f"{sf}/labels.parquet").to_pylist()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    good, bad = ([got[r["doc_id"]].score for r in labels if r["quality"] == q and got[r["doc_id"]].held_out]
                 for q in (1, 0))
    assert np.mean(np.array(good) >= 0.5) > 0.98 and np.mean(np.array(bad) < 0.5) > 0.95
    order = np.argsort(good + bad)
    rank = np.empty(len(order))
    rank[order] = np.arange(len(order))
    auc = (rank[:len(good)].sum() - len(good) * (len(good) - 1) / 2) / (len(good) * len(bad))
    assert auc > 0.99


def test_classifier_edge_rows(spark):
    labels = spark.createDataFrame([(2, 1, 0), (2, 0, 0), (3, 0, 0), (None, 1, 0), (99, 1, 1), (4, None, 0)],
                                   "doc_id long, quality int, toxic int")
    got = classifier.classify(documents(spark, extra=True), labels).collect()
    assert len(got) == len(edge_rows()) and all(0 <= r.score <= 1 for r in got)
    none = classifier.classify(documents(spark), labels.limit(0)).collect()
    assert all(r.score == 0.5 for r in none)
    assert classifier.classify(spark.createDataFrame([], SCHEMA), labels).collect() == []


# ---- line dedup

def test_hot_lines_across_many_tasks(spark):
    """A run that spans tasks is judged like one that does not."""
    line = "a line that a third of all documents hold"
    rows = [(i, f"own {i}\n{line}\n{line if i % 2 else ''}" if i % 3 == 0 else f"text {i}\nand line {i % 400} of many more",
             "en", "s", 1) for i in range(1500)]
    rows += [(3000, "only two documents hold this", "en", "s", 1), (3001, "only two documents hold this", "en", "s", 1)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r.doc_id: r for r in line_dedup.dedup(documents(spark, rows)).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    holders = defaultdict(set)
    for i, text, *_ in rows:
        for x in text.split("\n"):
            holders[x].add(i)
    for i, text, *_ in rows:
        gone = [len(x) >= 20 and len(holders[x]) >= 3 and max(holders[x]) != i for x in text.split("\n")]
        assert got[i].n_dropped == sum(gone)
        mask = [True] * len(gone) if got[i].keep is None else line_dedup.np.unpackbits(
            np.frombuffer(zlib.decompress(got[i].keep), np.uint8), count=len(gone)).astype(bool).tolist()
        assert mask == [not g for g in gone]


def test_line_dedup_edge_rows(spark):
    got = line_dedup.dedup(documents(spark, extra=True))
    assert set(documents(spark).columns) <= set(got.columns)
    by = {r.doc_id: r for r in got.collect()}
    assert (by[23].n_dropped, by[22].n_dropped, by[21].n_dropped, by[20].n_dropped) == (0, 2, 1, 1)
    assert line_dedup.kept(by[22].text, by[22].keep) == "x" and line_dedup.kept(None, None) == ""
    assert line_dedup.dedup(spark.createDataFrame([], SCHEMA)).collect() == []


# ---- language model

def test_lm_prefers_the_corpus(spark):
    scores = {r.doc_id: r for r in QUERIES["op2_lm_scoring"](spark, SF).collect()}
    assert all(r.log_likelihood <= 0 and r.n_tokens >= 0 for r in scores.values())
    rows = [(i, " ".join(f"w{(i + k) % 9}" for k in range(60)), "en", "s", 1) for i in range(300)]
    rng = random.Random(4)
    rows.append((1000, " ".join(rng.choice([f"w{k}" for k in range(9)]) for _ in range(60)), "en", "s", 1))
    got = {r.doc_id: r.mean_log_likelihood for r in window_lm.score(documents(spark, rows)).collect()}
    assert got[1000] < min(v for k, v in got.items() if k != 1000)


# ---- pages

def test_labelled_pages_are_recovered():
    m = html_extract.train()
    for page in LABELLED_PAGES:
        found = html_extract.blocks(page)
        assert m.decode(found) == [html_extract.marked(b) for b in found]


def test_pages_left_out_of_training():
    right = total = 0
    for k, page in enumerate(LABELLED_PAGES):
        m = html_extract.train(LABELLED_PAGES[:k] + LABELLED_PAGES[k + 1:])
        found = html_extract.blocks(page)
        pairs = list(zip(m.decode(found), (html_extract.marked(b) for b in found)))
        right += sum(a == b for a, b in pairs)
        total += len(pairs)
    assert right / total > 0.8


def test_viterbi_is_the_best_of_all_sequences():
    from itertools import product
    m = html_extract.train()
    for page in LABELLED_PAGES:
        found = html_extract.blocks(page)[:9]
        s = m.scores(found)
        value = lambda y: (m.start[y[0]] + sum(s[i, v] for i, v in enumerate(y))
                           + sum(m.step[a, b] for a, b in zip(y, y[1:])))
        assert abs(value(m.decode(found)) - max(map(value, product((0, 1), repeat=len(found))))) < 1e-9


def test_blocks_of_broken_markup():
    texts = lambda h: [b.text for b in html_extract.blocks(h)]
    assert texts("<p>a&amp;b\n  c<br>d<p>e<b>f</p>g</div>") == ["a&b c d", "ef", "g"]
    assert texts("<script>var t='</p>';</script>x<!-- y <p>z") == ["x"]
    assert texts("<style>p{}") == [] and texts("") == [] and texts("plain &lt;text&gt;") == ["plain <text>"]
    assert texts("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>") == ["a", "b", "c", "d"]
    assert texts('<a href="x>y">l</a> 1 < 2 <div title=\'>\'>m') == ["l 1 < 2", "m"]
    assert texts("<table><tr><td>a<td>b<tr><td>c</table>") == ["a", "b", "c"]


def test_extraction_query_and_edge_pages(spark):
    got = QUERIES["op9_html_extraction"](spark, SF).collect()
    pages = {r["page_id"]: r["html"] for r in pq.read_table(f"{SF}/pages.parquet").to_pylist()}
    assert len(got) == len(pages) and all(r.n_chars == len(r.text) for r in got)
    for r in got:
        inside = pages[r.page_id].split("<article>")[1].split("</article>")[0]
        assert r.text == "\n".join(b.text for b in html_extract.blocks(f"<article>{inside}</article>"))
    rows = [(1, None, None), (2, "u", ""), (None, "u", "<article><p>x y.</p></article>"), (3, "u", "<p>a" * 3000),
            (3, "u", "<p>a" * 3000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'t' as text")
    out = html_extract.extract(df).collect()
    assert len(out) == 5 and [r.text for r in out if r.page_id in (1, 2)] == ["", ""]
    assert html_extract.extract(df.limit(0)).collect() == []
