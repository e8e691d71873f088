"""Structured Streaming: post streams, scored streams, windowed and dedup state,
sinks, triggers and the lifecycle of named queries."""

from pulse.streaming.memo import BatchModel, score_batches_once  # noqa: F401
from pulse.streaming.panes import SpanStore, store_batches  # noqa: F401
from pulse.streaming.queries import (  # noqa: F401
    dedup_stream, dedup_tables, kept_posts, post_stream, score_batches, scored_stream, scored_windows, since_id_stream, start_dashboard,
    windowed_stream,
)
from pulse.streaming.sinks import (  # noqa: F401
    checkpoint_for, console, dropped_rows, fold_updates, read_complete, read_updates, stop_all, to_table,
    trigger_options, write_batches, write_complete, write_updates,
)
from pulse.streaming.samples import latest_stream, sample_rows, window_samples_stream  # noqa: F401
