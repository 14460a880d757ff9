"""Summarise the final (post-AQE) physical plan of every registered query.

    python tests/plan_report.py /root/testdata/sf0.1 > PLANS.md

For each query: shuffles (kind and keys), joins, windows, aggregates and the
filters pushed into parquet scans, read from the executed plan after a full
run (so AQE's runtime choices are visible).
"""

from __future__ import annotations

import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

KINDS = [
    ("Exchange rangepartitioning", "range shuffle"),
    ("Exchange hashpartitioning", "hash shuffle"),
    ("Exchange SinglePartition", "single-partition exchange"),
    ("Exchange RoundRobinPartitioning", "round-robin shuffle"),
    ("ReusedExchange", "reused exchange"),
    ("BroadcastExchange", "broadcast"),
    ("BroadcastHashJoin", "broadcast hash join"),
    ("SortMergeJoin", "sort-merge join"),
    ("ShuffledHashJoin", "shuffled hash join"),
    ("Window ", "window"),
    ("WindowGroupLimit", "window group limit"),
    ("HashAggregate", "hash aggregate"),
    ("ObjectHashAggregate", "object hash aggregate"),
    ("SortAggregate", "sort aggregate"),
    ("TakeOrderedAndProject", "top-k"),
    ("Generate", "generate (explode)"),
]


def final_plan(df) -> str:
    """Run the frame's own query (so AQE settles its final plan) and return
    that plan's text."""
    qe = df._jdf.queryExecution()
    qe.toRdd().count()
    return qe.executedPlan().toString()


def summarise(plan: str) -> tuple[Counter, list[str], list[str]]:
    final = plan.split("+- == Initial Plan ==")[0]
    counts: Counter = Counter()
    keys: list[str] = []
    for line in final.splitlines():
        for needle, label in KINDS:
            if needle in line:
                counts[label] += 1
                m = re.search(r"(hashpartitioning|rangepartitioning)\((.*?), \d+\)", line)
                if m and label.endswith("shuffle"):
                    cols = re.sub(r"#\d+L?", "", m.group(2))
                    keys.append(f"{m.group(1).replace('partitioning', '')}({cols[:70]})")
    pushed = sorted({re.sub(r"#\d+L?", "", m) for m in re.findall(r"PushedFilters: \[([^\]]*)\]", final)})
    return counts, keys, pushed


def main(argv: list[str]) -> None:
    from rawhouse.plans.queries import REGISTRY
    from rawhouse.session import build_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session(
        "local[8]", shuffle_partitions=16, driver_memory="16g",
        extra_conf={"spark.sql.maxMetadataStringLength": "4000"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    print(f"# Physical plans ({os.path.basename(sf_dir)}, final AQE plans, local[8], 16 shuffle partitions)\n")
    print("Generated by `python tests/plan_report.py`. Counts are operators in the final plan of the")
    print("query's last job (earlier jobs, e.g. checkpoints or size checks, are not included).\n")
    for name, q in REGISTRY.items():
        counts, keys, pushed = summarise(final_plan(q(spark, sf_dir)))
        ops = ", ".join(f"{label} ×{n}" for label, n in sorted(counts.items()))
        print(f"## {name}\n")
        print(f"- operators: {ops or 'scan/project only'}")
        if keys:
            print(f"- shuffle keys: {'; '.join(dict.fromkeys(keys))}")
        pushed = [p for p in pushed if p]
        if pushed:
            print(f"- pushed filters: {'; '.join(pushed)}")
        print()
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
