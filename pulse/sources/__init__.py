"""Sources: parquet tables, post views derived from them, text lines and JSON envelopes."""

from pulse.sources.lines import (  # noqa: F401
    parse_posts, read_lines, reject_lines, to_lines, unwrap_envelope,
)
from pulse.sources.tables import (  # noqa: F401
    as_of, doc_count, posts_view, read_table,
)
