"""Scalar column functions: sentiment bands and scores, text formats, time parsing."""

from pulse.functions.sentiment import (  # noqa: F401
    LABELS, emoji, label, score,
)
from pulse.functions.text import (  # noqa: F401
    age_seconds, age_text, clock, fixed, headline, preview, short_time, time_floor,
)
from pulse.functions.timeparse import parse_event_time  # noqa: F401
