"""The dashboard's questions over stored posts, as batch queries.

    python examples/batch_report.py [/root/testdata/sf0.01] [span]

Scores every document with a small inline lexicon, joins the scores to the
posts view, and prints the small finished results (totals, KPIs, distribution,
newest windows and posts).  Only these small results are collected.
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pulse.operators import views, windows  # noqa: E402
from pulse.plans.inputs import oldest_event, newest_event, scored_posts  # noqa: E402
from pulse.session import build_session  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    span = sys.argv[2] if len(sys.argv) > 2 else "1 day"
    spark = build_session()
    scored = scored_posts(spark, sf, "wide")
    now = newest_event(spark, sf)
    views.overall_stats(scored, now, span).show()
    views.kpis(scored, now, oldest_event(spark, sf), span).show(truncate=False)
    views.distribution(scored, now, span).show()
    w = windows.windowed_sentiment(scored, "1 hour", "30 minutes", order="desc")
    views.windowed_stats(w, now, span, limit=10).show()
    views.post_list(views.posts_in_span(scored, now, span, columns=["username", "sentiment_label",
                                                                    "sentiment_score", "timestamp"]),
                    now, n=10).select("headline", "age").show(truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()
