"""Print the physical plan tree (formatted explain, tree part) of registered queries.

    python tools/plans.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tessera.plans import registry  # noqa: E402
from tessera.session import build_session  # noqa: E402


def plan_tree(df) -> str:
    text = df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    tree = text.split("\n\n")[0]
    scans = [ln for ln in text.splitlines() if ln.startswith(("PushedFilters", "ReadSchema"))]
    return tree + "\n" + "\n".join(scans)


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    registry.load_all()
    names = argv[2:] or sorted(registry.QUERIES)
    spark = build_session("local[8]", 16)
    for name in names:
        print(f"### {name}\n```")
        print(plan_tree(registry.QUERIES[name](spark, sf_dir)))
        print("```\n")


if __name__ == "__main__":
    main(sys.argv)
