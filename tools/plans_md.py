"""Regenerate PLANS.md: plan trees of the headline queries with review notes,
and a table of shuffles / broadcasts / scans for every non-ML query.

    python tools/plans_md.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tessera.plans import registry  # noqa: E402
from tessera.session import build_session  # noqa: E402

NOTES = {
    "keyed_average": "Two-column `ReadSchema` out of six; `HashAggregate` before and after the `Exchange` is the "
                     "map-side combiner (partial_avg keeps (count, sum)). A hot key costs one partial row per task.",
    "popular_per_hour": "The per-hour maximum is a partial/final aggregate; rows holding it are kept by a `LeftSemi` "
                        "join on (hour, views). The broadcast comes from Catalyst's size estimate of the small "
                        "aggregate, and AQE re-decides it once the shuffle is measured; at scale it becomes a "
                        "sort-merge semi join with skew splitting. No window.",
    "temp_range_pivot": "One aggregate per (station, day) with conditional max/min (no TMAX×TMIN join, so duplicates "
                        "never pair up), then the day maximum joined back as a semi join. At run time AQE reuses the "
                        "aggregate's shuffle for both sides (`ReusedExchange`).",
    "semi_join_in": "`IN (subquery)` is a `LeftSemi` join; `p_type = 'PROMO'` reaches the part scan, the ILIKE list "
                    "is evaluated after it; lineitem reads two columns.",
    "avg_having": "HAVING on a grouping column of the null-supplying side: Catalyst turns both outer joins inner and "
                  "pushes `n_name = 'NATION_1'` into the nation scan. The dimension chain is joined first, so only "
                  "that nation's customers meet the fact table.",
    "prior_day_join": "Self-join on (station, date - 1) after both sides are reduced to one row per station-day; the "
                      "keys are unique, so the join never fans out.",
    "log_correlation": "Text scan, round-robin spread (gzip files are unsplittable), one regex pass per line, "
                       "per-host partial aggregate, then one global aggregate for all six sums (one job, not six).",
    "wordcount": "The broadcast side is the per-partition offset table (one row per partition, ordered in a tiny "
                 "window); the big side is the checkpointed, range-partitioned counts. No unpartitioned window "
                 "over the rows.",
    "spend_by_region": "The fact-side joins run once and are checkpointed as a narrow (flags, key, amount) table; "
                       "both branches read it (scans of ExistingRDD). Exact median branch: range partitioning by "
                       "(flags, value, row id), per-(partition, group) "
                       "counts with a window over at most partitions rows per group, then the middle rows picked "
                       "by a semi join against a size-checked broadcast of at most two rows per group. The "
                       "count/avg branch uses partial aggregation. The two tiny results are joined null-safely on "
                       "the flags.",
    "bfs_levels": "Each level is a checkpoint; the final plan is the union of level scans. Inside the loop the "
                  "measured frontier and visited set are broadcast, so the edge table is never shuffled per level.",
}
HEADLINE = ["keyed_average", "popular_per_hour", "temp_range_pivot", "semi_join_in", "avg_having",
            "prior_day_join", "log_correlation", "wordcount", "spend_by_region", "bfs_levels"]


def explain(df) -> str:
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    registry.load_all()
    spark = build_session("local[8]", 16)
    out = ["# Physical plans (sf0.1, local[8])", "",
           "Generated by `python tools/plans_md.py`. Trees are the initial adaptive plans (formatted explain); AQE",
           "may still replace a join with a broadcast or coalesce partitions once it has measured a shuffle. Scan",
           "lines list the filters pushed into Parquet and the columns read.", "",
           "## Shuffles, broadcasts and scans per query", "",
           "`Exchange` = hash/range shuffle; `BroadcastExchange` counted separately; scans include checkpointed",
           "inputs. Source/sink queries show the plan of the read-back side; iterative queries checkpoint per",
           "step, so their final plan is a union of checkpoint scans.", "",
           "| query | shuffles | broadcasts | scans |", "|---|---|---|---|"]
    trees = {}
    for name in sorted(registry.QUERIES):
        if name.startswith("ml_"):
            continue
        text = explain(registry.QUERIES[name](spark, sf_dir))
        tree = text.split("\n\n")[0]
        if name in HEADLINE:
            scans = [ln for ln in text.splitlines() if ln.startswith(("PushedFilters", "ReadSchema"))]
            trees[name] = tree + ("\n" + "\n".join(scans) if scans else "")
        ex = len(re.findall(r"\bExchange \(", tree))
        bx = len(re.findall(r"BroadcastExchange \(", tree))
        sc = len(re.findall(r"Scan (?:parquet|json|csv|text|ExistingRDD)", tree))
        out.append(f"| `{name}` | {ex} | {bx} | {sc} |")
    out += ["", "## Skew check (measured)", "",
            "2,000,000 rows where one group holds half of the rows and one value a third "
            "(`local[8]`, 16 shuffle partitions):", "",
            "| operator | range partitions | min rows | max rows | result |", "|---|---|---|---|---|",
            "| `exact_median` input (group, value, tie id) | 8 | 234,833 | 272,013 | "
            "hot-group median 249.0 = Spark `median` |",
            "| `sort_with_position` (value, tie id) | 8 | 229,130 | 268,985 | dense positions |", "",
            "Without the tie id, all rows of the hot value would share one range partition. Locally the "
            "distributed median takes ~6.7 s against ~0.7 s for Spark's `median` on the single hot group; "
            "the built-in keeps every distinct value of a group in one task's buffer, this one never "
            "holds more than a partition.", ""]
    for name in HEADLINE:
        out += [f"## {name}", "", NOTES[name], "", "```", trees[name], "```", ""]
    print("\n".join(out))


if __name__ == "__main__":
    main(sys.argv)
