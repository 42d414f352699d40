"""Print the formatted physical plan of registered queries.

usage: python tools/explain.py [sf_dir] key [key ...]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tessera.plans.registry import load_all  # noqa: E402
from tessera.session import build_session  # noqa: E402


def main():
    args = sys.argv[1:]
    sf = "/root/testdata/sf0.01"
    if args and args[0].startswith("/"):
        sf, args = args[0], args[1:]
    reg = load_all()
    spark = build_session("local[8]", 8)
    for k in args:
        print(f"===== {k}")
        reg[k][0](spark, sf).explain("formatted")


if __name__ == "__main__":
    main()
