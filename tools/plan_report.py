"""Write PLANS.md: the executed physical plan of every registered query, summarised.

    python tools/plan_report.py [sf_dir]

For each query: shuffle exchanges, broadcast exchanges, sorts, whole-stage
codegen stages, and per parquet scan the pushed filters and read schema,
taken from the final adaptive plan after the DataFrame's own plan has run; the
rows are counted where they are and go nowhere. Subqueries (a filter, the
bounds of ranges) are counted, and not part of the other figures.
"""

from __future__ import annotations

import re
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from quern.plans import QUERIES  # noqa: E402
from quern.session import local_session  # noqa: E402


def formatted(spark, df) -> str:
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def summarise(plan: str) -> dict:
    tree, _, details = plan.partition("\n\n\n")
    tree = tree.split("== Initial Plan ==")[0]
    nodes = re.findall(r"([A-Za-z]+)(?: [A-Za-z]+)*\s+\((\d+)\)", tree)
    ids = {i for _, i in nodes}
    names = [n for n, _ in nodes]
    blocks = {m.group(1): m.group(2) for m in re.finditer(r"^\((\d+)\) (.*?)(?=^\(\d+\) |\Z)", details, re.S | re.M)
              if m.group(1) in ids}
    scan_info = []
    for body in blocks.values():
        if not body.startswith("Scan parquet"):
            continue
        loc = re.search(r"Location: \S+ \[file:.*/([a-z_]+)\.parquet\]", body)
        pushed = re.search(r"PushedFilters: \[(.*)\]", body)
        schema = re.search(r"ReadSchema: struct<(.*)>", body)
        scan_info.append((loc.group(1) if loc else "?", pushed.group(1) if pushed else "",
                          ", ".join(f.split(":")[0] for f in schema.group(1).split(",")) if schema else ""))
    codegen = set()
    for body in blocks.values():
        codegen |= set(re.findall(r"\[codegen id : (\d+)\]", body.split("\n")[0]))
    return {
        "shuffles": names.count("Exchange"),
        "broadcasts": names.count("BroadcastExchange"),
        "reused": sum(1 for n in names if n.startswith("Reused")),
        "sorts": names.count("Sort"),
        "joins": [n for n in names if "Join" in n],
        "codegen_stages": len(codegen),
        "subqueries": len(set(re.findall(r"^Subquery:(\d+)", details, re.M))),
        "scans": scan_info,
    }


# Shown as whole trees too, with broadcasting off: what they shuffle once is shuffled once at any size.
TREES = ("bloom_join", "first_of_run_by_user", "first_of_run_global", "cogroup_lists", "lookup_join_sorted")


def tree(plan: str) -> str:
    """The executed tree alone, without initial plan, details and subqueries."""
    lines = plan.partition("\n\n\n")[0].split("== Initial Plan ==")[0].splitlines()
    kept = [line for line in lines if line.strip(" +-") and "==" not in line and "QueryStage" not in line and "AdaptiveSparkPlan" not in line]
    cut = min((len(line) - len(line.lstrip()) for line in kept), default=0)
    return "\n".join(line[cut:] for line in kept)


def executed(spark, query, sf_dir: str) -> str:
    df = query(spark, sf_dir)
    df._jdf.queryExecution().toRdd().count()
    return formatted(spark, df)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8, 8, app_name="quern-plans")
    out = ["# PLANS", "",
           f"Executed (final adaptive) physical plans of the registered queries of `quern.plans` at `{sf_dir}`,",
           "local[8], 8 shuffle partitions, AQE on. Generated by `tools/plan_report.py`. The training-data",
           "operators run many jobs each; their stages are in the check tool's report.",
           "Shuffles count `Exchange` nodes (hash, range, by id or round-robin), not broadcasts.", ""]
    for name, q in QUERIES.items():
        s = summarise(executed(spark, q, sf_dir))
        joins = ", ".join(sorted(set(s["joins"]))) or "none"
        out.append(f"## {name}")
        out.append("")
        out.append(f"- shuffles {s['shuffles']}, broadcasts {s['broadcasts']}, reused exchanges {s['reused']}, "
                   f"sorts {s['sorts']}, codegen stages {s['codegen_stages']}, subqueries {s['subqueries']}; joins: {joins}")
        for table, pushed, cols in s["scans"]:
            out.append(f"- scan `{table}` reads [{cols}]" + (f"; pushed: {pushed}" if pushed else ""))
        out.append("")
    for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(key, "-1")
    out += ["# Trees with broadcasting off", ""]
    for name in TREES:
        out += [f"## {name}", "", "```", tree(executed(spark, QUERIES[name], sf_dir)), "```", ""]
    (ROOT / "PLANS.md").write_text("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
