"""The pipeline stage by stage against plain Python, and as a whole."""

from collections import Counter, defaultdict

import corpus_pipeline
from marquee.llm import quality_rules
from rows import documents, edge_rows
from test_free import brute_components, check_packing, shingles

SF = "/root/testdata/sf0.001"


def stored(df, path):
    df.write.mode("overwrite").parquet(str(path))
    return df.sparkSession.read.parquet(str(path))


def check_stages(spark, docs, tmp_path, sf_dir):
    before = docs
    columns = docs.columns
    rows = lambda df: [(r.doc_id, r.text) for r in df.collect()]
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        after = stored(stage(spark, before, sf_dir), tmp_path / name)
        seen[name] = (rows(before), after)
        if name != "packing":
            assert after.columns == columns
        before = after

    was, df = seen["quality_rules"]
    kept = Counter((r.doc_id, r.text) for r in quality_rules.judge(docs).filter("kept").collect())
    assert Counter(rows(df)) == kept and kept <= Counter(was)

    was, df = seen["line_dedup"]
    lines = {k: (k[1] or "").split("\n") for k in was}
    key = lambda x: x.strip(" \t\n\x0b\f\r").translate({c: c + 32 for c in range(65, 91)})
    holders = defaultdict(set)
    for (i, _), own in lines.items():
        for x in own:
            holders[key(x)].add(i)
    gone = lambda i, x: len(key(x)) >= 20 and len(holders[key(x)]) >= 3 and max(holders[key(x)]) != i
    want = Counter((i, "\n".join(x for x in lines[i, t] if not gone(i, x))) for i, t in was)
    assert Counter((i, t or "") for i, t in rows(df)) == want
    assert all(r.n_chars == len(r.text) for r in df.collect() if r.text and "\n" in r.text)

    was, df = seen["ngram_join"]
    groups = brute_components(was, corpus_pipeline.K, corpus_pipeline.PERCENT)
    want = {c for c, (i, t) in zip(groups, was) if shingles(t, corpus_pipeline.K)}
    got = [i for i, t in rows(df) if shingles(t, corpus_pipeline.K)]
    assert sorted(got) == sorted(want)

    was, df = seen["mixing"]
    sizes, taken = defaultdict(int), defaultdict(int)
    source = {r.doc_id: r.source for r in seen["ngram_join"][1].collect()}
    n = Counter(rows(df))
    longest = defaultdict(int)
    for i, t in was:
        words = len((t or "").encode().split())
        sizes[source[i]] += words
        taken[source[i]] += words * n[i, t]
        longest[source[i]] = max(longest[source[i]], words)
        assert n[i, t] <= 2
    from test_native import fair_targets
    for s, x in fair_targets(sizes).items():
        assert abs(taken[s] - x) <= longest[s]

    was, df = seen["packing"]
    check_packing(was, df.collect(), 4096)


def test_stages(spark, tmp_path):
    check_stages(spark, spark.read.parquet(f"{SF}/documents.parquet"), tmp_path, SF)


def test_stages_on_awkward_rows(spark, tmp_path):
    rows = [r for r in edge_rows() if r[0] is not None]
    rows = list({r[0]: r for r in rows}.values())
    check_stages(spark, documents(spark, rows, extra=True), tmp_path, str(tmp_path))


def test_null_ids_repeated_rows_and_no_rows(spark, tmp_path):
    for rows in (edge_rows(), []):
        sf = tmp_path / f"sf{len(rows)}"
        documents(spark, rows).write.parquet(str(sf / "documents.parquet"))
        assert len(corpus_pipeline.run(spark, str(sf)).collect()) >= bool(rows)


def test_a_stage_gives_back_the_tables_of_the_one_before(spark, tmp_path):
    """Only those: results stay, and so do the tables that other queries have stored."""
    import os

    from marquee.llm import common
    other = common.materialize(spark.range(5).toDF("n"), "other")
    docs, at = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        at[name] = list(corpus_pipeline._own)
        docs = stored(out, tmp_path / name)
    there = {name: [os.path.exists(p.removeprefix("file:")) for p in paths] for name, paths in at.items()}
    assert all(at.values()) and all(there["packing"])
    assert not any(x for name, xs in there.items() if name != "packing" for x in xs)
    assert other.count() == 5 and docs.count() > 0
