"""Summarise the physical plan of every registered query as Markdown.

Usage: python tools/plan_report.py [sf_dir] > PLANS.md

Per query: the scans (table, pushed filters, columns read), the shuffles
(hash / single / range / broadcast), the aggregates (hash or sort, partial
before the shuffle), the joins and the window limits. Plans are the initial
adaptive plans; AQE may still coalesce partitions or switch a sort-merge
join to a broadcast join at run time.
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from sigfleet.plans import driver_queries as entry  # noqa: E402
from sigfleet.session import build_session  # noqa: E402


def explain(df) -> str:
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def summarise(p: str) -> dict:
    scans = []
    for block in re.findall(r"\(\d+\) Scan (\w+)[^\n]*\n(.*?)(?:\n\n|\Z)", p, re.S):
        fmt, body = block
        loc = re.search(r"Location: \w+ \[([^\]]*)\]", body)
        table = os.path.basename(loc.group(1).split(",")[0]) if loc else fmt
        pushed = re.search(r"PushedFilters: \[(.*)\]", body)
        schema = re.search(r"ReadSchema: struct<(.*)>", body)
        cols = len(re.findall(r"(\w+):", schema.group(1))) if schema else 0
        scans.append(f"{table}({cols} cols{'; ' + pushed.group(1) if pushed and pushed.group(1) else ''})")
    tree = p.split("\n\n")[0]
    shuffles = re.findall(r"Arguments: (hashpartitioning|SinglePartition|rangepartitioning|RoundRobinPartitioning)", p)
    shuffles += ["broadcast"] * tree.count("BroadcastExchange")
    aggs = re.findall(r"\b(HashAggregate|SortAggregate|ObjectHashAggregate)\b", tree)
    joins = re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct) (\w+)", tree)
    wgl = re.findall(r"WindowGroupLimit.*?(Partial|Final)", p.replace("\n", " "))
    return {
        "scans": "; ".join(scans) or "-",
        "shuffles": ", ".join(shuffles) or "none",
        "aggregates": ", ".join(f"{a}" for a in aggs) or "-",
        "joins": ", ".join(f"{j} {t}" for j, t in joins) or "-",
        "window_limit": "partial+final" if "Partial" in wgl else "-",
        "python": "yes" if re.search(r"EvalPython|InPandas|PythonUDF", p) else "no",
    }


def main(argv):
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(master="local[8]", shuffle_partitions=8)
    print("# Physical plans of the registered queries\n")
    print(f"Generated by `tools/plan_report.py` on `{sf}` (initial adaptive plans, Spark {spark.version}).")
    print("Aggregates are listed leaf-last as they appear in the tree; a pair is partial + final.\n")
    print("| Query | Scans (columns read; pushed filters) | Shuffles | Aggregates | Joins | Top-k cut | Python |")
    print("|---|---|---|---|---|---|---|")
    for name, fn in entry.QUERIES.items():
        s = summarise(explain(fn(spark, sf)))
        print(f"| `{name}` | {s['scans']} | {s['shuffles']} | {s['aggregates']} | {s['joins']} | {s['window_limit']} | {s['python']} |")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
