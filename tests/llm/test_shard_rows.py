"""Equal texts stay in one shard, however many rows hold them, and no task numbers them alone."""

from collections import Counter, defaultdict

import pytest

from marquee.llm import sharding
from rows import documents


@pytest.mark.parametrize("common", [("", None), ("same" * 50, "same" * 50)])
def test_a_text_that_a_third_of_the_rows_hold(spark, monkeypatch, common):
    monkeypatch.setattr(sharding, "BLOCK_ROWS", 100)
    rows = [(i % 50 if i % 2 else i, common[i % 2] if i % 3 == 0 else f"text {i % 5000} " * 25, "en", "s", 1)
            for i in range(9000)]
    got = sharding.shard(documents(spark, rows)).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    shards, places, load = defaultdict(set), defaultdict(list), Counter()
    for r in got:
        shards[r.text or ""].add(r.shard)
        places[r.shard].append(r.slot)
        load[r.shard] += r.size
    assert len(shards) > 3000 and all(len(x) == 1 for x in shards.values())
    assert all(sorted(x) == list(range(len(x))) for x in places.values())
    if not common[0]:
        mean = sum(load.values()) / 16
        assert all(abs(x - mean) < 0.02 * mean for x in load.values())


def test_blocks_bound_what_a_task_numbers(spark, monkeypatch):
    """3,000 equal rows are ranked in blocks of about 100, none of them by a window over the whole slot."""
    monkeypatch.setattr(sharding, "BLOCK_ROWS", 100)
    df = sharding.shard(documents(spark, [(1, "same", "en", "s", 1)] * 3000))
    assert sorted(r.slot for r in df.collect()) == list(range(3000))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    ranks = [x for x in plan.splitlines() if "row_number()" in x and x.lstrip(" +-:").startswith("Window")]
    assert len(ranks) == 1 and "_block#" in ranks[0].split("], [")[1]
