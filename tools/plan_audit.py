"""Audit the physical plan of every registered query (sf folder given,
default sf0.01) and write PLANS.md: shuffles, broadcasts, join kinds,
pushed filters, and anti-patterns (cartesian or nested-loop joins, Python
UDF evaluation, single-partition exchanges over raw rows).

    python tools/plan_audit.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from martlet import registry  # noqa: E402
from martlet.session import build_session  # noqa: E402

BAD = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython")
PYTHON = ("ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas")


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted_plan(df) -> str:
    """``explain("formatted")`` as a string (scan details untruncated)."""
    jvm = df.sparkSession._jvm
    mode = jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def audit(plan: str) -> dict:
    return {
        "exchanges": len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|"
                                    r"RoundRobinPartitioning)", plan)),
        "single_partition": plan.count("Exchange SinglePartition"),
        "broadcasts": plan.count("BroadcastExchange"),
        "smj": plan.count("SortMergeJoin"),
        "bhj": plan.count("BroadcastHashJoin"),
        "pushed": len(re.findall(r"PushedFilters: \[[^\]]+\]", plan)),
        "bad": sorted({b for b in BAD if b in plan}),
        "python": sorted({b for b in PYTHON if b in plan}),
    }


def tree(df) -> str:
    """The operator tree of the formatted plan (without the per-node details)."""
    text = formatted_plan(df)
    body = text.split("== Physical Plan ==", 1)[-1].strip().split("\n\n", 1)[0]
    return body


def headline_plans(spark, sf: str) -> list[str]:
    """Plans of the headline builds and extracts in their production shape:
    raw layer and marts written as Parquet, broadcasts disabled so that the
    joins are planned as they would be for tables too large to broadcast."""
    from martlet.plans.checks import validation_report
    from martlet.sources.tables import scratch_path

    root = scratch_path(spark, "plans")
    m = registry.model(spark, sf).with_raw_written(root)
    marts = m.materialize(f"{root}/marts")
    marts.write_extracts(f"{root}/extracts")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        items = [("fct_order_items (from the raw layer)", m.fct_order_items),
                 ("fct_orders (from the raw layer and the written item fact)",
                  type(m)(spark, m.raw, m.params, {"fct_order_items": marts.fct_order_items}).fct_orders),
                 ("revenue extract (marts)", marts.extract_revenue()),
                 ("delivery extract (marts)", marts.extract_delivery()),
                 ("delivery buckets (marts)", marts.extract_buckets()),
                 ("validation report (marts)", validation_report(marts))]
        out = ["", "## Headline plans, broadcasts disabled", "",
               "Initial physical plans (AQE may still re-plan at run time) with",
               "`spark.sql.autoBroadcastJoinThreshold=-1`, i.e. as planned when no side is small.", ""]
        for title, df in items:
            out += [f"### {title}", "", "```", tree(df), "```", ""]
        return out
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[*]", 8, driver_memory="8g")
    rows = []
    for name, fn in registry.queries().items():
        a = audit(plan_text(fn(spark, sf)))
        rows.append((name, a))
    out = ["# PLANS", "",
           f"Generated by `python tools/plan_audit.py` on {os.path.basename(sf)} (initial physical plans,",
           "before AQE re-optimisation; AQE may turn sort-merge joins into broadcast joins at run time).",
           "`exchanges` counts shuffles, `single_partition` shuffles into one task (only global",
           "aggregates of already-reduced rows and global windows over aggregated groups should do",
           "this), `pushed` counts scans with pushed filters. `bad` lists cartesian or nested-loop joins",
           "and row-at-a-time Python UDFs: it must be empty everywhere. `python` lists Arrow-batched",
           "Python nodes (pandas UDF, mapInPandas).", "",
           "| query | exchanges | single_partition | broadcasts | SMJ | BHJ | pushed | bad | python |",
           "| --- | --- | --- | --- | --- | --- | --- | --- | --- |"]
    for name, a in rows:
        out.append(f"| {name} | {a['exchanges']} | {a['single_partition']} | {a['broadcasts']} | {a['smj']} | "
                   f"{a['bhj']} | {a['pushed']} | {', '.join(a['bad']) or '-'} | {', '.join(a['python']) or '-'} |")
    out += headline_plans(spark, sf)
    open(os.path.join(ROOT, "PLANS.md"), "w").write("\n".join(out) + "\n")
    print("bad:", [(n, a["bad"]) for n, a in rows if a["bad"]],
          "python:", [(n, a["python"]) for n, a in rows if a["python"]])


if __name__ == "__main__":
    main()
