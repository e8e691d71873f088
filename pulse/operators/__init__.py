"""DataFrame -> DataFrame operators: scoring, ingest, windows, views, prefix scans."""

from pulse.operators.ingest import (  # noqa: F401
    catch_up, chunk_posts, chunk_rows, dedup_key, dedup_posts, fetch_report, high_water, latest_n,
    low_volume_streaks, normalize_posts, recent, rejected_posts, search, since_id, stamp_ingest,
)
from pulse.operators.prefix import equal_depth, running  # noqa: F401
from pulse.operators.scoring import (  # noqa: F401
    attach_scores, lexicon_frame, lexicon_polarity, lexicon_scorer, read_lexicon, score_documents, score_placed_texts, score_texts,
    with_bands, with_batch_scorer, with_scorer,
)
from pulse.operators.terms import search_terms, term_matches  # noqa: F401
from pulse.operators.views import (  # noqa: F401
    distribution, kpis, latest_windows, overall_stats, positive_negative, post_list, posts_in_span,
    recent_posts, throughput, windowed_stats,
)
from pulse.operators.windows import (  # noqa: F401
    late_report, sample_lists, trend, window_samples, window_series, window_texts, windowed_sentiment,
    windowed_with_samples,
)
