"""Command line: ``python -m tessera <command>``.

  pipeline --sf-dir DIR [--out PATH] [--register]   land bronze, build silver+gold, run the gates
  land --csv TABLE=PATH [...] --out PATH              land raw CSV files as bronze tables
  query NAME --sf-dir DIR [--show N]                  run one registered query
"""

from __future__ import annotations

import argparse
import json
import sys
import uuid

from tessera.session import checkpoint_dir, get_spark


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="python -m tessera")
    sub = ap.add_subparsers(dest="cmd", required=True)
    p = sub.add_parser("pipeline")
    p.add_argument("--sf-dir", required=True)
    p.add_argument("--out")
    p.add_argument("--register", action="store_true")
    p.add_argument("--no-key-checks", action="store_true")
    ld = sub.add_parser("land")
    ld.add_argument("--csv", action="append", required=True, metavar="TABLE=PATH")
    ld.add_argument("--out", required=True)
    q = sub.add_parser("query")
    q.add_argument("name")
    q.add_argument("--sf-dir", required=True)
    q.add_argument("--show", type=int, default=20)
    args = ap.parse_args(argv)

    spark = get_spark()
    if args.cmd == "pipeline":
        from tessera.plans.pipeline import land_bronze, run_pipeline
        from tessera.plans.tables import RetailTables
        out = args.out or f"{checkpoint_dir(spark)}/tessera-{uuid.uuid4().hex[:8]}"
        bronze = land_bronze(RetailTables(spark, args.sf_dir).all_bronze(), out)
        silver, gold = run_pipeline(bronze, out, check_keys=not args.no_key_checks, register=args.register)
        counts = {f"{layer}.{n}": df.count() for layer, t in (("silver", silver), ("gold", gold))
                  for n, df in t.items()}
        print(json.dumps({"out": out, "rows": counts}))
    elif args.cmd == "land":
        from tessera.sources.bronze import land
        files = dict(pair.split("=", 1) for pair in args.csv)
        landed = land(spark, files, args.out)
        print(json.dumps({t: df.count() for t, df in landed.items()}))
    else:
        from tessera.plans.registry import queries
        qs = queries()
        if args.name not in qs:
            print(f"unknown query {args.name!r}; known: {', '.join(sorted(qs))}", file=sys.stderr)
            return 2
        qs[args.name](spark, args.sf_dir).show(args.show, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
