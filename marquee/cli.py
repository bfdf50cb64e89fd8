"""Command line entry point (also usable with spark-submit).

    python -m marquee.cli build  --sf-dir DIR --out OUT --buckets N
    python -m marquee.cli query  --out OUT NAME [key=value ...] --to PATH
    python -m marquee.cli export-json --out OUT --to PATH

``build`` runs the denormalisation job and writes the bucketed catalogue under
OUT; ``query`` attaches that catalogue and writes one query's result (the
Spark SQL form, parameters as key=value) as Parquet to PATH; ``export-json``
writes the document tables as JSON lines.  Results go to files, never
through the driver.
"""

from __future__ import annotations

import argparse
import ast
import json

from marquee.plans import jobs
from marquee.plans import sql as S
from marquee.session import build_session


def _value(text: str):
    try:
        return ast.literal_eval(text)
    except (ValueError, SyntaxError):
        return text


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="marquee")
    sub = ap.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("build")
    b.add_argument("--sf-dir", required=True)
    b.add_argument("--out", required=True)
    b.add_argument("--buckets", type=int, required=True)
    q = sub.add_parser("query")
    q.add_argument("--out", required=True)
    q.add_argument("--to", required=True)
    q.add_argument("name", choices=sorted(S.QUERIES))
    q.add_argument("params", nargs="*", help="key=value, values as Python literals")
    e = sub.add_parser("export-json")
    e.add_argument("--out", required=True)
    e.add_argument("--to", required=True)
    for p in (b, q, e):
        p.add_argument("--prefix", default="den", help="table name prefix")
    args = ap.parse_args(argv)

    spark = build_session()
    if args.cmd == "build":
        names = jobs.denormalize_job(spark, args.sf_dir, args.buckets, out_dir=args.out, prefix=args.prefix)
        print(json.dumps(names))
        return
    names = jobs.attach_catalogue(spark, args.out, prefix=args.prefix)
    tables = jobs.open_catalogue(spark, names)
    if args.cmd == "export-json":
        print(json.dumps(jobs.export_json(tables, args.to)))
        return
    S.register_catalogue(tables)
    params = dict(p.split("=", 1) for p in args.params)
    S.run(spark, args.name, **{k: _value(v) for k, v in params.items()}).write.mode("overwrite").parquet(args.to)
    print(json.dumps({"query": args.name, "path": args.to}))


if __name__ == "__main__":
    main()
