"""Text columns of the printed cards and the dashboard list, as native expressions.

The reference formats rows in Python on the driver; here each format is a column
expression so the text is built where the rows are.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (must equal the reference) ---------------------------------
PREVIEW_CHARS = 80          # preview length, always followed by "..."
PREVIEW_SUFFIX = "..."
MISSING_MARK = "?"          # step-1 card: shown for a missing field
SHORT_TIME_CHARS = 19       # created_at shown as its first 19 characters
NO_TIME = "N/A"
CLOCK_FORMAT = "HH:mm:ss"   # window start / end on the console cards
# ------------------------------------------------------------------------------

MICROS_PER_SECOND = 1_000_000
MICROS_PER_MINUTE = 60 * MICROS_PER_SECOND


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def preview(text, chars: int = PREVIEW_CHARS) -> Column:
    """First ``chars`` characters followed by ``...`` - always, even for short text.
    A null text previews as just ``...`` (the reference's ``get('text', '')``)."""
    return F.concat(F.substring(F.coalesce(_col(text), F.lit("")), 1, chars),
                    F.lit(PREVIEW_SUFFIX))


def card_line(created_at, username, text) -> Column:
    """Step-1 console line: ``[created_at] @username: preview...``; ``?`` for a missing field."""
    return F.format_string(
        "[%s] @%s: %s",
        F.coalesce(_col(created_at), F.lit(MISSING_MARK)),
        F.coalesce(_col(username), F.lit(MISSING_MARK)),
        preview(text),
    )


def short_time(created_at) -> Column:
    """First 19 characters of a time text, or ``N/A`` when it is null or empty."""
    c = _col(created_at)
    return F.coalesce(F.substring(F.nullif(c, F.lit("")), 1, SHORT_TIME_CHARS), F.lit(NO_TIME))


def fixed(x, decimals: int) -> Column:
    """Fixed-point text with ``decimals`` places (``%.Nf``).

    Spark's formatter rounds half-up on the shortest decimal form of the double;
    Python rounds the exact binary value, so a tie such as 0.125 may print one
    unit higher in the last place than the reference did.
    """
    return F.format_string(f"%.{int(decimals)}f", _col(x))


def clock(ts) -> Column:
    """``HH:mm:ss`` of a timestamp (window start and end on the console cards)."""
    return F.date_format(_col(ts), CLOCK_FORMAT)


def age_micros(ts, as_of) -> Column:
    """Microseconds from ``ts`` to ``as_of`` (negative for a post after ``as_of``)."""
    def micros(c):
        c = _col(c)
        return F.unix_micros(c.cast("timestamp"))
    return micros(as_of) - micros(ts)


def age_seconds(ts, as_of) -> Column:
    return age_micros(ts, as_of) / F.lit(float(MICROS_PER_SECOND))


def age_parts(ts, as_of) -> tuple[Column, Column]:
    """Whole minutes (toward zero) and seconds modulo 60 (never negative)."""
    us = age_micros(ts, as_of)
    # Java remainder keeps the dividend's sign, so this truncates toward zero
    minutes = ((us - us % F.lit(MICROS_PER_MINUTE)) / F.lit(MICROS_PER_MINUTE)).cast("long")
    seconds = F.floor(F.pmod(us, F.lit(MICROS_PER_MINUTE)) / F.lit(MICROS_PER_SECOND)).cast("long")
    return minutes, seconds


def age_text(ts, as_of) -> Column:
    """``3m 4s ago`` when at least a minute old, else ``4s ago``."""
    minutes, seconds = age_parts(ts, as_of)
    return (F.when(minutes > 0, F.format_string("%dm %ds ago", minutes, seconds))
            .otherwise(F.format_string("%ds ago", seconds)))


def headline(mark, username, lbl, sentiment_score) -> Column:
    """Dashboard list title: ``🟢 @user - POSITIVE (Score: 0.60)``."""
    return F.format_string("%s @%s - %s (Score: %s)", _col(mark), _col(username), _col(lbl),
                           fixed(sentiment_score, 2))


def time_floor(ts, every: str = "10 seconds") -> Column:
    """Start of the tumbling ``every`` bucket holding ``ts`` (epoch aligned).
    Meant for grouping keys; as with ``window()``, rows without a time drop out."""
    return F.window(_col(ts), every)["start"]
