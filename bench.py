"""Benchmark: the eight catalogue queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

``noop`` sink, the slowest and fastest runs are dropped and the rest averaged.

* ``den_build``: the denormalisation job: the three document tables built
  from the driver tables and written once as bucketed Parquet tables under
  the shared folder (``plans.jobs``), timed once after one untimed run.
* ``ru1`` .. ``rda4``: the queries over the stored document tables, the
  setting of the reference (queries against stored documents).
* ``*_e2e``: the same queries straight from the driver tables (E2E_RUNS runs),
  document build included (Catalyst prunes the parts a query does not read).

Prints one JSON line; ``value`` is the sum of the eight stored-table times,
``e2e_total`` the sum of the end-to-end times, ``den_build`` the job time.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from marquee.operators import denormalize  # noqa: E402
from marquee.plans import catalogue as Q  # noqa: E402
from marquee.plans import jobs, registry  # noqa: E402
from marquee.session import build_session  # noqa: E402
from marquee.sources import files  # noqa: E402
from marquee.sources.testdata import Catalog  # noqa: E402


def trimmed_mean(ts: list[float]) -> float:
    if len(ts) <= 2:
        return sum(ts) / len(ts)
    t = sorted(ts)[1:-1]
    return sum(t) / len(t)


def timed(fn, runs: int) -> float:
    ts = []
    for _ in range(runs):
        t0 = time.perf_counter()
        files.drain(fn())
        ts.append(time.perf_counter() - t0)
    return round(trimmed_mean(ts), 4)


E2E_RUNS = 3


def eight(m, d, links, movies_for=None):
    return {
        "ru1": lambda: Q.ru1(m()),
        "ru2": lambda: Q.ru2(d()),
        "ru3": lambda: Q.ru3(m()),
        "ru4": lambda: Q.ru4(m(), d(), links(), movies_for=movies_for),
        "rda1": lambda: Q.rda1(m(), d(), links(), movies_for=movies_for),
        "rda2": lambda: Q.rda2(d()),
        "rda3": lambda: Q.rda3(m()),
        "rda4": lambda: Q.rda4_top(m(), d(), links(), movies_for=movies_for),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "10"))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=int(cpus),
                          extra={"spark.driver.memory": "16g"})
    cat = Catalog(spark, sf_dir)

    # warm-up: JVM, parquet footers, code generation, table writes (untimed)
    files.drain(denormalize.build_all(cat)["movies"])
    jobs.denormalize_job(spark, sf_dir, int(cpus), prefix="bench_warm")

    out: dict[str, float] = {}
    t0 = time.perf_counter()
    names = jobs.denormalize_job(spark, sf_dir, int(cpus), prefix="bench_den")
    out["den_build"] = round(time.perf_counter() - t0, 4)

    stored = jobs.open_catalogue(spark, names)
    from_stored = [lambda k=k: stored[k] for k in ("movies", "directors", "director_movies")]
    for name, fn in eight(*from_stored).items():
        out[name] = timed(fn, runs)
    built = [lambda k=k: denormalize.build_all(cat)[k] for k in ("movies", "directors", "director_movies")]
    for name, fn in eight(*built, movies_for=registry.movies_for(spark, sf_dir)).items():
        out[f"{name}_e2e"] = timed(fn, E2E_RUNS)

    eight_stored = [out[k] for k in ("ru1", "ru2", "ru3", "ru4", "rda1", "rda2", "rda3", "rda4")]
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "catalogue_queries_stored_total", "value": round(sum(eight_stored), 4),
        "unit": "sec", "queries": out, "sf": sf, "runs": {"stored": runs, "e2e": E2E_RUNS, "den_build": 1}, "cpus": int(cpus),
        "e2e_total": round(sum(v for k, v in out.items() if k.endswith("_e2e")), 4),
        "den_build": out["den_build"],
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
