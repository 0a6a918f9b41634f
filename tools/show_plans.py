"""Print the formatted physical plans of registered queries.

Usage: python tools/show_plans.py [--scale-shape] sf_dir name [name ...]

``--scale-shape`` disables size-based broadcast joins so the plan shows the
exchanges a large input would get (sort-merge joins on the keys).
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from vellum.plans import catalog  # noqa: E402
from vellum.session import build_session  # noqa: E402


def main() -> None:
    args = sys.argv[1:]
    scale = "--scale-shape" in args
    args = [a for a in args if a != "--scale-shape"]
    sf, names = args[0], args[1:]
    extra = {"spark.sql.autoBroadcastJoinThreshold": "-1"} if scale else {}
    spark = build_session("local[4]", shuffle_partitions=8, extra=extra)
    for name in names:
        print("=" * 20, name)
        df = catalog.QUERIES[name](spark, sf)
        df.explain("formatted")


if __name__ == "__main__":
    main()
