"""Quality rules, mixing and sharding: awkward rows, contracts, SQL."""

import os
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from marquee.llm import mixing, quality_rules, sharding
from marquee.llm.registry import ORACLE, QUERIES
from rows import SCHEMA, documents, edge_rows


def words(text):
    return (text or "").encode().split()


def view(con, df, path):
    df.write.mode("overwrite").parquet(path)
    con.sql(f"create or replace view documents as select * from '{path}/*.parquet'")


@pytest.mark.parametrize("name", ["op1_quality_rules", "op6_mixing", "op8_line_dedup"])
@pytest.mark.parametrize("kind", ["edge", "empty", "sf0.001"])
def test_sql(spark, tmp_path, name, kind):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    if kind == "sf0.001":
        con.sql(f"create view documents as select * from '{sf}/documents.parquet'")
    else:
        sf = str(tmp_path)
        view(con, documents(spark, None if kind == "edge" else []), os.path.join(sf, "documents.parquet"))
    ours = QUERIES[name](spark, sf)
    cols = sorted(ours.columns)
    rel = con.sql(ORACLE[name])
    theirs = sorted(map(repr, rel.project(", ".join(f'"{c}"' for c in cols)).fetchall()))
    assert sorted(repr(tuple(r)) for r in ours.select(cols).collect()) == theirs


def test_quality_counts_by_hand(spark):
    rows = quality_rules.judge(documents(spark, extra=True)).select("doc_id", "text", *quality_rules.BASE,
                                                                     "base_failed", "kept").collect()
    assert len(rows) == len(edge_rows())
    for r in rows:
        w = (r.text or "").split()
        n = Counter(zip(w, w[1:], w[2:]))
        covered = {i + d for i in range(len(w) - 2) if n[tuple(w[i:i + 3])] > 1 for d in range(3)}
        lines = [x for x in (r.text or "").split("\n") if x.split()]
        assert (r.n_words, r.n_repeat_words, r.n_dup_lines) == (len(w), len(covered), len(lines) - len(set(lines)))
        assert r.word_chars == sum(map(len, w))
        assert r.n_symbols == sum(c in "#*$%&|<>" for c in r.text or "")
        assert r.base_failed == (len(w) < 50 or 100 * len(covered) > 50 * len(w))
        assert not (r.kept and r.base_failed)


def test_fences_follow_the_group(spark):
    """Texts full of symbols are rejected where they are rare and kept where they are the rule."""
    text = lambda i, bad: " ".join(f"w{i}x{k}" + "$$" * bad for k in range(60))
    rows = [(i, text(i, i % 10 == 0), "en", "prose", 1) for i in range(400)]
    rows += [(1000 + i, text(i, True), "en", "code", 1) for i in range(400)]
    kept = {r.doc_id: r.kept for r in quality_rules.judge(documents(spark, rows)).collect()}
    assert all(kept[i] == (i % 10 != 0) for i in range(400))
    assert all(kept[1000 + i] for i in range(400))


def test_repeated_lines_follow_the_source(spark):
    """30 to 60% of repeated lines: out of a clean source, at home in a source made of such texts."""
    def text(i, repeated):
        lines = [" ".join(f"w{i:05}x{k:02}y{j}" for j in range(10)) for k in range(20 - repeated)]
        return "\n".join(x for k, own in enumerate(lines) for x in [own] + ["see also"] * (k < repeated))
    rows = [(i, text(i, 2 * (i % 40 == 0)), "en", "clean", 1) for i in range(600)]
    rows += [(1000 + i, text(1000 + i, 9 + i % 2), "en", "clean", 1) for i in range(20)]
    rows += [(2000 + i, text(2000 + i, 7 + i % 4), "en", "logs", 1) for i in range(2000)]
    got = {r.doc_id: r for r in quality_rules.judge(documents(spark, rows)).collect()}
    assert not any(r.base_failed for r in got.values())
    assert all(got[i].kept for i in range(600))
    assert not any(got[1000 + i].kept for i in range(20))
    assert all(got[2000 + i].kept for i in range(2000))


def test_fences_differ_between_groups(spark):
    """On a real table; and a group of one document leans on its language."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    one = documents(spark, [(-1, " ".join(f"x{k}$$" for k in range(80)), "en", "alone", 1)])
    measured = quality_rules.measure(docs.unionByName(one).withColumns({"_lang": F.col("lang"), "_source": F.col("source")}),
                                     ["_lang", "_source"])
    got = quality_rules.fences(quality_rules.sketches(measured)).collect()
    assert len(got) > 70
    for m, least in (("word_length", 40), ("repeat_rate", 5)):
        assert len({r[f"_high_{m}"] for r in got}) >= least
    alone = next(r for r in got if r._source == "alone")
    assert alone._high_symbol_rate < 2000 / 8


def fair_targets(sizes, weights=(3, 1, 2), share=1.5, cap=2):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    target, left, open_ = dict.fromkeys(names, 0.0), share * sum(sizes.values()), set(names)
    while open_ and left > 1e-9:
        total = sum(w[s] for s in open_)
        give = {s: left * w[s] / total for s in open_}
        left = 0.0
        for s, x in give.items():
            target[s] += x
            if target[s] >= cap * sizes[s]:
                left += target[s] - cap * sizes[s]
                target[s] = float(cap * sizes[s])
                open_.discard(s)
    return target


@pytest.mark.parametrize("rows", [None, "flat", "one_source"])
def test_mixing_meets_targets(spark, rows):
    rows = {"flat": [(i, "a b c", "en", f"s{i % 5}", 1) for i in range(200)],
            "one_source": [(i, "a " * i, "en", "s", 1) for i in range(30)]}.get(rows)
    got = mixing.mix(documents(spark, rows, extra=True)).collect()
    assert len(got) == len(rows or edge_rows())
    sizes = defaultdict(int)
    for r in got:
        assert r.size == len(words(r.text)) and 0 <= r.taken <= 2 * r.size
        assert r.taken == sum(d.words for d in r.draws)
        assert all(0 <= d.position <= 1 for d in r.draws)
        sizes[r.source] += r.size
    want = fair_targets(sizes)
    for s in sizes:
        mine = [r for r in got if r.source == s]
        assert all(r.source_size == sizes[s] for r in mine)
        assert all(abs(r.target - want[s]) < 1e-6 * (1 + want[s]) for r in mine)
        assert abs(sum(r.taken for r in mine) - want[s]) <= 0.5


def test_mixing_agrees_between_runs_and_orders_copies(spark):
    a, b = (mixing.mix(documents(spark).repartition(n)).select("doc_id", "size", "taken", "draws") for n in (1, 7))
    assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))
    order = mixing.training_order(mixing.mix(documents(spark), whole=True)).collect()
    assert [r.position for r in order] == sorted(r.position for r in order)
    assert all(r.words == r.size for r in order)


def test_schedule_is_met_all_along(spark):
    """A falling source is trained early, a rising one late, each as its demand says."""
    rows = [(i, "a b c d", "en", s, 1) for i in range(3000) for s in ("a", "b", "c")]
    order = mixing.training_order(mixing.mix(documents(spark, rows))).collect()
    for s, ramp in (("a", -0.5), ("b", 0.5), ("c", 0.0)):
        t = [r.position for r in order if r.source == s]
        n = sum(r.words for r in order if r.source == s)
        half = sum(r.words for r in order if r.source == s and r.position <= 0.5)
        assert abs(half / n - (0.5 - ramp / 4)) < 0.01 and t


@pytest.mark.parametrize("extra", [False, True])
def test_sharding_contract(spark, extra):
    got = sharding.shard(documents(spark, extra=extra)).collect()
    assert len(got) == len(edge_rows())
    by = defaultdict(list)
    for r in got:
        raw = (r.text or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
        by[r.shard].append(r.slot)
    assert set(by) <= set(range(16))
    assert all(sorted(x) == list(range(len(x))) for x in by.values())


def test_sharding_is_even_and_keeps_equal_texts(spark):
    rows = [(i, "x" * (i * 7919 % 500) + str(i % 3000), "en", "s", 1) for i in range(6000)]
    got = sharding.shard(documents(spark, rows)).collect()
    load, at = Counter(), defaultdict(set)
    for r in got:
        load[r.shard] += r.size
        at[r.text].add(r.shard)
    mean = sum(load.values()) / 16
    assert all(abs(x - mean) < 0.01 * mean for x in load.values())
    assert all(len(x) == 1 for x in at.values())


def test_map_edits_are_versioned_and_small(spark):
    sizes = {s: 100 + s % 7 for s in range(sharding.N_SLOTS)}
    first = sharding.first_map(spark, sizes)
    grown = sharding.rebalance(first, 17)
    old, new = ({r.virtual_slot: r.shard for r in grown.filter(f"version = {v}").collect()} for v in (1, 2))
    moved = {s for s in old if old[s] != new[s]}
    assert all(new[s] == 16 for s in moved) and 0 < len(moved) < sharding.N_SLOTS / 15
    load = Counter()
    for s, shard in new.items():
        load[shard] += sizes[s]
    assert max(load.values()) - min(load.values()) < 0.02 * sum(load.values())
    shrunk = sharding.rebalance(grown, 16)
    last = {r.virtual_slot: r.shard for r in sharding.latest(shrunk).collect()}
    assert set(last.values()) == set(range(16))
    placed = sharding.shard(documents(spark), maps=shrunk).collect()
    assert all(r.map_version == 3 and r.shard == last[r.virtual_slot] for r in placed)


@pytest.mark.parametrize("fn", [quality_rules.judge, mixing.mix, sharding.shard])
def test_empty_tables(spark, fn):
    assert fn(spark.createDataFrame([], SCHEMA)).collect() == []
