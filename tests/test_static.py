"""Source-level guards of the catalogue library: no driver round trips, no
Python UDFs, no RDDs."""

import pathlib
import re

PKG = pathlib.Path(__file__).resolve().parent.parent / "marquee"
FORBIDDEN = [r"toPandas\(", r"\budf\b", r"pandas_udf", r"\.rdd\b", r"localCheckpoint", r"\.first\(\)", r"\.take\(",
             r"mkdtemp\((?!prefix=\"marquee-ckpt-\")", r"coalesce\(1\)\.write"]


def sources():
    return sorted(p for p in PKG.rglob("*.py") if "llm" not in p.relative_to(PKG).parts)


def test_no_driver_round_trips_or_udfs():
    for path in sources():
        text = path.read_text()
        for pat in FORBIDDEN:
            assert not re.search(pat, text), f"{path.name}: {pat}"


def test_only_table_definitions_are_collected():
    hits = [(p.name, ln) for p in sources() for ln in p.read_text().splitlines()
            if re.search(r"\.(count|collect)\(\)", ln)]
    assert all(name == "jobs.py" and ("MANIFEST" in ln or "DESCRIBE" in ln) for name, ln in hits), hits
