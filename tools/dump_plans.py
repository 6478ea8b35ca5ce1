"""Write the physical plan tree of every registered query to PLANS.md (evidence for reviews).

Usage: python tools/dump_plans.py [sf_dir]
Only the operator tree of ``explain("formatted")`` is kept; queries that write files first
(streams, CSV/ORC round trips) are listed with the plan of their final read.
"""

from __future__ import annotations

import contextlib
import io
import sys

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from trend_engine.plans.registry import QUERIES  # noqa: E402
from trend_engine.session import build_session  # noqa: E402


def tree(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    body = text.split("== Physical Plan ==", 1)[-1]
    lines = []
    for line in body.splitlines()[1:]:
        if not line.strip():
            break
        lines.append(line)
    return "\n".join(lines)


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", 8)
    out = ["# Physical plans", "", f"Generated by `tools/dump_plans.py` at `{sf_dir}` (AQE initial plans).", ""]
    for name, fn in QUERIES.items():
        df = fn(spark, sf_dir)
        out += [f"## {name}", "", "```", tree(df), "```", ""]
    with open(__file__.rsplit("/tools/", 1)[0] + "/PLANS.md", "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
