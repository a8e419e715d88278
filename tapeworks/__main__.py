"""Run registered queries: ``python -m tapeworks [--list] KEY [SF_DIR] [--out PATH] [--show N]``.

``--out`` writes the result as Parquet (overwrite); ``--show`` prints the
first N rows; with neither, the whole result is computed with the ``noop``
sink and the row count is printed.  ``--list`` prints every key with the
first line of its description.
"""

from __future__ import annotations

import argparse
import sys

from tapeworks.plans import catalog


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="python -m tapeworks")
    p.add_argument("key", nargs="?")
    p.add_argument("sf_dir", nargs="?", default="/root/testdata/sf0.01")
    p.add_argument("--list", action="store_true")
    p.add_argument("--out")
    p.add_argument("--show", type=int, default=0)
    p.add_argument("--master", default="local[8]")
    a = p.parse_args(argv)
    qs = catalog.queries()
    if a.list or not a.key:
        for k, fn in sorted(qs.items()):
            print(f"{k:32s} {(fn.__doc__ or '').strip().splitlines()[0]}")
        return 0
    if a.key not in qs:
        print(f"unknown key {a.key!r}; --list shows them", file=sys.stderr)
        return 2
    from tapeworks.session import build_session
    spark = build_session(master=a.master)
    df = qs[a.key](spark, a.sf_dir)
    if a.out:
        df.write.mode("overwrite").parquet(a.out)
    if a.show:
        df.show(a.show, truncate=False)
    if not a.out and not a.show:
        print(df.count())
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
