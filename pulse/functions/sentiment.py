"""Sentiment bands, band scores and markers as native column expressions.

The reference maps a polarity p in [-1, 1] to a band with a chain of strict
``>`` tests and gives each band a fixed score.  Both rules are expressed as one
``CASE WHEN`` chain so they stay inside whole-stage codegen.  A null polarity
(no text, or a scorer failure) falls in the neutral band with score 0.0, the
reference's catch-all.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (must equal the reference) ---------------------------------
VERY_POSITIVE = "VERY_POSITIVE"
POSITIVE = "POSITIVE"
NEUTRAL = "NEUTRAL"
NEGATIVE = "NEGATIVE"
VERY_NEGATIVE = "VERY_NEGATIVE"
LABELS = [VERY_POSITIVE, POSITIVE, NEUTRAL, NEGATIVE, VERY_NEGATIVE]

# rule -> lower cut (exclusive) and score of each band, best band first; the
# last band takes everything else.  "strict" has a band of its own for p == 0.
RULES = {
    "strict": [(VERY_POSITIVE, 0.5, 1.0), (POSITIVE, 0.0, 0.5), (NEUTRAL, None, 0.0),
               (NEGATIVE, -0.5, -0.5), (VERY_NEGATIVE, None, -1.0)],
    "wide": [(VERY_POSITIVE, 0.5, 1.0), (POSITIVE, 0.2, 0.6), (NEUTRAL, -0.2, 0.0),
             (NEGATIVE, -0.5, -0.6), (VERY_NEGATIVE, None, -1.0)],
}

# label -> display text of the row printer
DISPLAY = {VERY_POSITIVE: "🔴 VERY POSITIVE", POSITIVE: "🟢 POSITIVE", NEUTRAL: "⚪ NEUTRAL",
           NEGATIVE: "🟡 NEGATIVE", VERY_NEGATIVE: "🔴 VERY NEGATIVE"}
# label -> marker; "faces" from the row printer, "dots" from the dashboard list
EMOJI = {
    "faces": {VERY_POSITIVE: "😍", POSITIVE: "🙂", NEUTRAL: "😐", NEGATIVE: "😕",
              VERY_NEGATIVE: "😡"},
    "dots": {VERY_POSITIVE: "🟢", POSITIVE: "🟢", NEUTRAL: "🟡", NEGATIVE: "🔴",
             VERY_NEGATIVE: "🔴"},
}
EMOJI_OTHER = {"faces": "😐", "dots": "⚪"}
# ------------------------------------------------------------------------------


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _band_chain(p: Column, rule: str, pick) -> Column:
    if rule not in RULES:
        raise ValueError(f"unknown rule {rule!r}; expected one of {sorted(RULES)}")
    bands = RULES[rule]
    # null polarity -> neutral band (the reference's catch-all)
    neutral = next(b for b in bands if b[0] == NEUTRAL)
    chain = F.when(p.isNull(), F.lit(pick(neutral)))
    for name, cut, val in bands[:-1]:
        band = (name, cut, val)
        if cut is None:  # strict rule: exactly zero
            chain = chain.when(p == F.lit(0.0), F.lit(pick(band)))
        else:
            chain = chain.when(p > F.lit(cut), F.lit(pick(band)))
    return chain.otherwise(F.lit(pick(bands[-1])))


def label(p, rule: str = "strict") -> Column:
    """Band name of polarity ``p``: ``"strict"`` (>0.5, >0, ==0, >-0.5) or ``"wide"``
    (>0.5, >0.2, >-0.2, >-0.5).  All cuts are strict ``>``."""
    return _band_chain(_col(p), rule, lambda b: b[0])


def score(p, rule: str = "strict") -> Column:
    """Band score of polarity ``p``: strict 1, .5, 0, -.5, -1; wide 1, .6, 0, -.6, -1."""
    return _band_chain(_col(p), rule, lambda b: b[2]).cast("double")


def display_label(lbl) -> Column:
    """Printer text of a band, e.g. ``🟢 POSITIVE``; unknown labels pass through."""
    lbl = _col(lbl)
    chain = None
    for name, text in DISPLAY.items():
        cond = lbl == F.lit(name)
        chain = F.when(cond, F.lit(text)) if chain is None else chain.when(cond, F.lit(text))
    return chain.otherwise(lbl)


def emoji(lbl, style: str = "dots") -> Column:
    """Marker of a band: ``faces`` (😍 🙂 😐 😕 😡) or ``dots`` (🟢 🟢 🟡 🔴 🔴, ⚪ otherwise)."""
    lbl = _col(lbl)
    table = EMOJI[style]
    chain = None
    for name, mark in table.items():
        cond = lbl == F.lit(name)
        chain = F.when(cond, F.lit(mark)) if chain is None else chain.when(cond, F.lit(mark))
    return chain.otherwise(F.lit(EMOJI_OTHER[style]))
