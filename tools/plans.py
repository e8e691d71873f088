"""Write PLANS.md: the physical plan tree, read schemas and pushed filters of the
headline queries, from ``explain("formatted")`` under the bench session settings.

    python tools/plans.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE  # noqa: E402
from pulse.plans import QUERIES  # noqa: E402
from pulse.session import build_session  # noqa: E402


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def summary(text: str) -> str:
    tree, rest = text.split("\n\n", 1) if "\n\n" in text else (text, "")
    keep = [ln for ln in rest.splitlines()
            if ln.startswith(("ReadSchema", "PushedFilters", "Functions", "Arguments: hashpartitioning",
                              "Join type", "Keys"))]
    seen, lines = set(), []
    for ln in keep:
        if ln not in seen:
            seen.add(ln)
            lines.append(ln)
    return tree.strip() + "\n\n" + "\n".join(lines)


def final_tree(df, width: int = 140) -> str:
    """The final adaptive plan after running ``df`` (rows collected: use a small scale)."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    lines = text.splitlines()
    # the top-level initial plan starts at column 0; subqueries print their own, indented
    cut = next((i for i, ln in enumerate(lines) if ln.startswith("+- == Initial Plan ==")), len(lines))
    return "\n".join(ln[:width] for ln in lines[:cut])


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    small_dir = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", 16)
    out = ["# PLANS", "",
           f"Physical plans of the headline queries over `{sf_dir}` (initial adaptive plans, before AQE's",
           "run-time changes), written by `tools/plans.py`.  Abridged: operator tree, then the distinct",
           "read schemas, pushed filters, aggregate functions, shuffle keys and join types.", ""]
    for name in HEADLINE:
        out += [f"## {name}", "", "```", summary(formatted(QUERIES[name](spark, sf_dir))), "```", ""]
    out += ["# Final adaptive plans", "",
            f"The same queries run on `{small_dir}`, then their final plans: AQE's run-time choices (joins",
            "turned into broadcasts once the shuffled side was measured, coalesced shuffle reads). Lines cut at",
            "140 characters.", ""]
    for name in HEADLINE:
        out += [f"## {name} (final)", "", "```", final_tree(QUERIES[name](spark, small_dir)), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
