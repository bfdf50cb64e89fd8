"""Static plan summary of every registered query, as on big tables.

Auto-broadcast and AQE are off, so the plan is what Spark starts from when no
side is known to be small: only broadcasts with a size bound written into the
code remain.  Writes PLANS.md.

    python tools/plan_summary.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def stats(text: str) -> dict:
    nodes = re.findall(r"^\(\d+\) (\w+)", text, flags=re.M)
    pushed = re.findall(r"PushedFilters: \[(.*)\]", text)
    return {
        "exchanges": nodes.count("Exchange"),
        "smj": nodes.count("SortMergeJoin"),
        "bhj": nodes.count("BroadcastHashJoin"),
        "aggs": sum(nodes.count(k) for k in ("HashAggregate", "ObjectHashAggregate", "SortAggregate")),
        "sort_aggs": nodes.count("SortAggregate"),
        "windows": nodes.count("Window"),
        "python": sum(nodes.count(k) for k in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas")),
        "scans": nodes.count("Scan"),
        "pushed": sum(1 for p in pushed if p.strip()),
        "bucketed": len(re.findall(r"SelectedBucketsCount", text)),
    }


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.001"
    from marquee.plans import registry
    from marquee.session import build_session
    spark = build_session("local[4]", shuffle_partitions=8, extra={"spark.sql.autoBroadcastJoinThreshold": "-1",
                                             "spark.sql.adaptive.enabled": "false"})
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    rows = []
    for name, fn in sorted(registry.QUERIES.items()):
        if name.startswith(("stored_", "sql_")):
            continue
        df = fn(spark, sf_dir)
        s = stats(df._jdf.queryExecution().explainString(mode))
        rows.append((name, s))
    cols = ["exchanges", "smj", "bhj", "aggs", "sort_aggs", "windows", "python", "scans", "pushed"]
    out = ["# Static plans of the registered queries",
           "",
           "Generated by `tools/plan_summary.py` with auto-broadcast and AQE off, i.e. as on tables too large to",
           "broadcast.  `bhj` counts only the broadcasts written into the code, each with a size bound (the one-row",
           "find-one result).  At run time AQE may turn further joins into broadcasts once a side's real size is",
           "known.  `pushed` counts scans that received filters.  The e2e plans include the whole document build;",
           "over the stored catalogue (`plans/jobs.py`) the queries are a single scan or a bucketed semi join.",
           "",
           "| query | " + " | ".join(cols) + " |",
           "|---|" + "---|" * len(cols)]
    for name, s in rows:
        out.append(f"| `{name}` | " + " | ".join(str(s[c]) for c in cols) + " |")
    # the production path: the eight queries over the stored, bucketed catalogue
    stored = {name.removeprefix("stored_"): fn(spark, sf_dir) for name, fn in registry.QUERIES.items()
              if name.startswith("stored_")}
    cols2 = cols + ["bucketed"]
    out += ["",
            "## Over the stored catalogue (`plans/jobs.py`)",
            "",
            "Same settings.  `bucketed` counts scans that read the tables by bucket: the id lookups join against",
            "them with no exchange on that side; the exchanges left are on the small id lists and the final",
            "per-genre aggregates.",
            "",
            "| query | " + " | ".join(cols2) + " |",
            "|---|" + "---|" * len(cols2)]
    for name, df in stored.items():
        st = stats(df._jdf.queryExecution().explainString(mode))
        out.append(f"| `{name}` | " + " | ".join(str(st[c]) for c in cols2) + " |")
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out) + "\n")
    print("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
