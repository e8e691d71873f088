"""Bench: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value" (total seconds), "unit", "queries"
(seconds per query), "sf"}.  Each query is executed in full with the ``noop``
sink (every row produced, nothing collected to the driver).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pulse.plans import QUERIES  # noqa: E402
from pulse.session import build_session  # noqa: E402

HEADLINE = [
    "windowed_sentiment",   # flagship: sliding windows x band over scored posts
    "polarity",             # lexicon join over every token of every document
    "overall_stats",        # grouping sets over the span
    "dedup_posts",          # first arrival per key over overlapping polls
    "window_samples",       # bounded per-window samples, texts joined after
    "late_report",          # blocked running max per feed
    "normalize_posts",      # JSON envelopes -> clean posts (lines written beforehand)
    "search",               # whole-text phrase search, semi-join to posts
    "chunk_posts",          # blocked running count within hours
    "low_volume_streaks",   # two blocked prefix passes over the hourly report
    "recent_posts",         # top-k, then texts by a semi join on its keys
    "posts_in_span",        # every post with its text, newest first
    "stream_windowed_sentiment",   # lines -> scored table -> windows in update mode
    "stream_scored_posts",  # lines -> scored table
]


def stored_lines(spark, sf_dir: str):
    """``normalize_posts`` over API response lines written beforehand."""
    from pulse.operators import normalize_posts
    from pulse.plans.fixtures import api_lines
    from pulse.session import stored
    from pulse.sources import posts_view, unwrap_envelope

    lines = stored(api_lines(posts_view(spark, sf_dir, with_text=True, extra=("event_type",))), "bench-lines")
    return lambda spark, sf_dir: normalize_posts(unwrap_envelope(lines, keep=["page"]))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    # stage and task times without the web UI: BENCH_EVENT_LOG=<scratch folder> writes Spark's event log
    log_dir = os.environ.get("BENCH_EVENT_LOG")
    extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir} if log_dir else None
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(cpus, 1) * 2, app_name="pulse-bench",
                          extra=extra)
    # warm the JVM (class loading, codegen, Python workers) once on the smallest
    # tables, outside the timings; every timed query then runs on sf_dir cold data
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        for name in names:
            QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        query = QUERIES[name]
        if name == "normalize_posts":      # time the operator, not the making of its input lines
            query = stored_lines(spark, sf_dir)
        t0 = time.perf_counter()
        query(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
