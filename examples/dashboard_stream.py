"""Live dashboard tables from a folder of JSON post lines.

    python examples/dashboard_stream.py <landing folder> <output folder> [seconds]

Starts the two named queries (scored rows, windowed aggregates) over the files
arriving in the landing folder, runs them for a while, then prints the
dashboard views over the two tables.  Checkpoints go under spark.checkpoint.dir.
The scorer here is a toy word rule; plug in any ``str -> float`` function.
"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from pulse.operators import views  # noqa: E402
from pulse.session import build_session  # noqa: E402
from pulse.streaming import start_dashboard, stop_all, trigger_options  # noqa: E402


def toy_scorer(text: str) -> float:
    words = text.lower().split()
    good = sum(w in ("good", "great", "love") for w in words)
    bad = sum(w in ("bad", "awful", "hate") for w in words)
    return 0.0 if good + bad == 0 else (good - bad) / (good + bad)


def main():
    landing, out = sys.argv[1], sys.argv[2]
    seconds = int(sys.argv[3]) if len(sys.argv) > 3 else 30
    spark = build_session()
    queries = start_dashboard(spark, landing, toy_scorer, out, trigger=trigger_options("2 seconds"), max_files_per_trigger=10)
    try:
        time.sleep(seconds)
    finally:
        stop_all(queries)
    rows = spark.read.parquet(f"{out}/raw_tweets")
    now = rows.select(F.max("timestamp")).scalar()
    views.overall_stats(rows, now, "5 minutes").show()
    views.recent_posts(rows, now, "5 minutes", limit=10).show(truncate=80)
    spark.stop()


if __name__ == "__main__":
    main()
