"""Command line: list the registered queries or run one.

    python -m tillroll list
    python -m tillroll run <query> <data_dir> [--rows N] [--out PATH] [--sql] [--master URL]

``run`` prints the first N rows (default 20) or writes the whole result as
parquet to ``--out``; ``--sql`` prints the query's oracle SQL instead.
"""

from __future__ import annotations

import argparse
import sys


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="python -m tillroll")
    sub = ap.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list")
    r = sub.add_parser("run")
    r.add_argument("query")
    r.add_argument("data_dir")
    r.add_argument("--rows", type=int, default=20)
    r.add_argument("--out")
    r.add_argument("--sql", action="store_true")
    r.add_argument("--master", default=None,
                   help="Spark master; default local[$BENCH_CPUS or 8], '' to leave it to spark-submit")
    a = ap.parse_args(argv)

    from .plans import ORACLE_SQL, QUERIES
    if a.cmd == "list":
        for name in sorted(QUERIES):
            print(name + ("" if name in ORACLE_SQL else "  (no SQL oracle)"))
        return 0
    if a.query not in QUERIES:
        print(f"unknown query {a.query!r}; see `python -m tillroll list`", file=sys.stderr)
        return 2
    if a.sql:
        print(ORACLE_SQL.get(a.query, "-- no SQL form (model-based query)"))
        return 0
    from .session import get_session
    spark = get_session(master=a.master)
    df = QUERIES[a.query](spark, a.data_dir)
    if a.out:
        df.write.mode("overwrite").parquet(a.out)
    else:
        df.show(a.rows, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
