"""Summarise the physical plan of every registered query.

    python tools/plan_report.py [--sf DIR] > PLANS.md

Plans are shown with AQE and size-based broadcasts off (the shape at scale).
Per query: shuffles (Exchange), broadcasts, join strategies, pushed filters,
Python evaluation nodes and nested-loop / cartesian joins (which should be
absent), read from ``explain("formatted")``.
"""

from __future__ import annotations

import argparse
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def plan_text(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    a = ap.parse_args()
    from stratum.plans.catalog import load_all
    from stratum.session import build_session
    spark = build_session("local[4]", shuffle_partitions=8)
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # show the static plan shape
    # At 100 TB no table here is under the size threshold: disable size-based
    # broadcasts so the report shows the shuffle plan and only the broadcasts
    # the code asks for (bounded tables).
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    reg = load_all()
    print("| query | shuffles | reused shuffles | broadcasts | SMJ | BHJ | pushed filters | python eval | "
          "nested loop / cartesian |")
    print("|---|---|---|---|---|---|---|---|---|")
    for n in a.names or list(reg):
        txt = plan_text(reg[n].build(spark, a.sf))
        head = txt.split("\n\n")[0]
        count = lambda pat: len(re.findall(pat, head))
        pushed = len(re.findall(r"PushedFilters: \[[^\]]+\]", txt))
        print(f"| {n} | {count(r'(?<!Broadcast)(?<!Reused)Exchange \(')} | {count(r'ReusedExchange \(')} | "
              f"{count(r'BroadcastExchange')} | {count(r'SortMergeJoin')} | {count(r'BroadcastHashJoin')} | "
              f"{pushed} | {count(r'ArrowEvalPython|BatchEvalPython|MapInPandas|FlatMapGroupsInPandas')} | "
              f"{count(r'BroadcastNestedLoopJoin|CartesianProduct')} |")


if __name__ == "__main__":
    main()
