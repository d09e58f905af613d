"""Print the physical plan of registered queries, or a digest of their
exchanges, joins, windows and aggregates.

    python tools/explain.py [--digest] [sf_dir] name [name ...]
"""

from __future__ import annotations

import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

KEEP = re.compile(r"(Exchange|Join|Window \[|HashAggregate|Scan parquet|Union|TakeOrdered|Expand)")


def digest(plan: str) -> list[str]:
    out = []
    for line in plan.splitlines():
        if KEEP.search(line):
            line = re.sub(r"#\d+L?", "", line)
            line = re.sub(r", \[plan_id=\d+\]", "", line)
            line = re.sub(r"windowspecdefinition\(([^)]*)\)", r"spec(\1)", line)
            out.append(line[:170])
    return out


def main(argv: list[str]) -> None:
    from clickmart.plans.queries import REGISTRY
    from clickmart.session import build_session
    dig = "--digest" in argv
    args = [a for a in argv if a != "--digest"]
    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")]
    spark = build_session("local[8]", shuffle_partitions=16)
    for name in names:
        df = REGISTRY[name](spark, sf)
        plan = df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
        print(f"### {name}\n")
        print("```")
        print("\n".join(digest(plan)) if dig else plan)
        print("```\n")


if __name__ == "__main__":
    main(sys.argv[1:])
