"""Summarise the physical plan of every registered query after execution (AQE final plan).

For each query: number of shuffles (Exchange hashpartitioning / rangepartitioning / single), broadcast joins, sort-merge joins, reused exchanges, windows, and for each
Parquet scan its pushed filters and read columns. Writes PLANS.md.

Usage: python tools/plans.py [sf_dir]
"""

from __future__ import annotations

import re
import sys

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from hydromart.session import build_session  # noqa: E402


def final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def summarise(plan: str) -> dict:
    final = plan.split("== Initial Plan ==")[0]
    return {
        "shuffles": len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition)", final)),
        "broadcast_joins": len(re.findall(r"BroadcastHashJoin|BroadcastNestedLoopJoin", final)),
        "sort_merge_joins": len(re.findall(r"SortMergeJoin", final)),
        "reused": len(re.findall(r"Reused(Exchange|Subquery)", final)),
        "windows": len(re.findall(r"\bWindow ", final)),
        "cartesian": len(re.findall(r"CartesianProduct|BroadcastNestedLoopJoin", final)),
        "scans": sorted(set(re.findall(r"FileScan parquet \[([^\]]*)\].*?PushedFilters: \[([^\]]*)\]", final))),
    }


def table(spark, queries, names, sf_dir):
    rows, scans = [], []
    for name in names:
        s = summarise(final_plan(queries[name](spark, sf_dir)))
        rows.append(f"| `{name}` | {s['shuffles']} | {s['broadcast_joins']} | {s['sort_merge_joins']} | {s['reused']} | "
                    f"{s['windows']} | {s['cartesian']} |")
        for cols, pushed in s["scans"]:
            cols, pushed = re.sub(r"#\d+L?", "", cols), re.sub(r"#\d+L?", "", pushed)
            scans.append(f"| `{name}` | {cols} | {pushed or '-'} |")
    return rows, scans


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    from bench import HEADLINE
    from hydromart.plans import catalog
    spark = build_session("local[8]", 16)
    spark.sparkContext.setLogLevel("OFF")
    head = ["| Query | Shuffles | Broadcast joins | Sort-merge joins | Reused | Windows | Cartesian |",
            "| --- | --- | --- | --- | --- | --- | --- |"]
    rows, scans = table(spark, catalog.QUERIES, catalog.QUERIES, sf_dir)
    lines = ["# Physical plans of the registered queries", "",
             f"AQE final plans after running each query once on `{sf_dir}` (`tools/plans.py`).",
             "Shuffles count hash/range/single-partition exchanges. Steps that are written or checkpointed",
             "(station days, the nearest-station rounds, ML fits, streams) run as jobs of their own; the plan",
             "shown is the one that reads them. The training-data operators are described in README.md.", "",
             *head, *rows, "", "## Headline queries with broadcasts off", "",
             "What the plans become when no side is small enough to broadcast.", "", *head]
    for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(key, "-1")
    lines += table(spark, catalog.QUERIES, HEADLINE, sf_dir)[0]
    lines += ["", "## Parquet scans: columns read and filters pushed", "",
              "| Query | Columns read | Pushed filters |", "| --- | --- | --- |", *scans, ""]
    out = __file__.rsplit("/tools/", 1)[0] + "/PLANS.md"
    with open(out, "w") as fh:
        fh.write("\n".join(lines))
    print(f"wrote {out}")


if __name__ == "__main__":
    main(sys.argv)
