"""Print the executed (final adaptive) physical plan of each report.

usage: python tools/explain_reports.py [sf_dir] [out_dir]

Runs every report once into the noop sink, then writes its final plan
(``explain`` of the executed query) to ``<out_dir>/<report>.txt``.
"""

from __future__ import annotations

import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from fleetlens.operators.enrich import attach_register  # noqa: E402
from fleetlens.operators.fuel import fuel_daily  # noqa: E402
from fleetlens.operators.register import register_for  # noqa: E402
from fleetlens.plans.registry import queries  # noqa: E402
from fleetlens.session import build_session  # noqa: E402
from fleetlens.sources.catalog import derive_from_driver_tables  # noqa: E402

REPORTS = ("fleet_list", "utilization", "hours", "fuel")


def final_only(plan: str, width: int = 160) -> str:
    """The plan without the initial plans (of itself and of its subqueries), long lines cut."""
    out, skip = [], None
    for line in plan.splitlines():
        depth = len(line) - len(line.lstrip(" :|+-"))
        if skip is not None and depth > skip:
            continue
        skip = None
        if "== Initial Plan ==" in line:
            skip = depth
        else:
            out.append(line[:width])
    return "\n".join(out) + "\n"


def main(argv: list[str]) -> None:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    out = Path(argv[2] if len(argv) > 2 else "docs/plans")
    out.mkdir(parents=True, exist_ok=True)
    spark = build_session("local[8]", 16)
    src = derive_from_driver_tables(spark, sf_dir)
    frames = {k: (lambda k=k: queries()[k](spark, sf_dir)) for k in REPORTS}
    # the part of the fuel report that is written once and read back
    frames["fuel_enriched_rows"] = lambda: attach_register(fuel_daily(src), register_for(src.lark_fleet_master, "fuel"))
    for key, build in frames.items():
        df = build()
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        plan = final_only(re.sub(r"file:/[^\s,\]]*/", "", plan))
        (out / f"{key}.txt").write_text(plan)
        print(key, len(plan.splitlines()), "lines")


if __name__ == "__main__":
    main(sys.argv)
