"""Command line: list, run or explain registered queries.

  python -m spillway list
  python -m spillway run <key> [sf_dir] [rows]
  python -m spillway explain <key> [sf_dir]
  python -m spillway sql <key>
"""

from __future__ import annotations

import sys

DEFAULT_DIR = "/root/testdata/sf0.01"


def main(argv: list[str]) -> int:
    from .plans.catalog import QUERIES
    from .plans.oracle import SQL
    if not argv or argv[0] not in ("list", "run", "explain", "sql"):
        print(__doc__)
        return 2
    cmd, rest = argv[0], argv[1:]
    if cmd == "list":
        for key in QUERIES:
            print(key)
        return 0
    if not rest or rest[0] not in QUERIES:
        print("unknown query; try: python -m spillway list")
        return 2
    key = rest[0]
    if cmd == "sql":
        print(SQL[key])
        return 0
    from .session import build_session
    spark = build_session()
    df = QUERIES[key](spark, rest[1] if len(rest) > 1 else DEFAULT_DIR)
    if cmd == "explain":
        df.explain("formatted")
    else:
        df.show(int(rest[2]) if len(rest) > 2 else 20, truncate=80)
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
