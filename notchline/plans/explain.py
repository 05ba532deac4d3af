"""Print the formatted physical plan of registered queries.

    python -m notchline.plans.explain [--sf DIR] [--mode formatted|extended|cost] key [key ...]

Plans are printed before execution (the adaptive plan is re-optimised at run
time); use it to check scans (``ReadSchema``, ``PushedFilters``), exchanges and
join strategies of a query.
"""

from __future__ import annotations

import argparse

from notchline.plans import QUERIES
from notchline.session import build_session


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.split("\n")[0])
    ap.add_argument("keys", nargs="+", help="query keys (see __spark_entry__.queries())")
    ap.add_argument("--sf", default="/root/testdata/sf0.01", help="directory of the input tables")
    ap.add_argument("--mode", default="formatted", choices=["simple", "extended", "codegen", "cost", "formatted"])
    ap.add_argument("--master", default="local[4]", help="local master for this tool (no cluster needed)")
    args = ap.parse_args(argv)
    spark = build_session(master=args.master, app="notchline-explain", shuffle_partitions=8)
    for k in args.keys:
        if k not in QUERIES:
            raise SystemExit(f"unknown key {k!r}; known: {', '.join(sorted(QUERIES))}")
        print(f"===== {k}")
        QUERIES[k](spark, args.sf).explain(args.mode)


if __name__ == "__main__":
    main()
