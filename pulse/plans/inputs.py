"""Inputs shared by the registered queries: the test lexicon and scored posts.

Texts are scored once per document and the score is joined to the posts that
show the document; texts themselves are joined only by queries that return
them, after their filters and limits.
"""

from __future__ import annotations

from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse.operators.scoring import attach_scores, lexicon_frame, score_documents
from pulse.sources.tables import as_of, posts_view, read_table

# --- fixed values: the test lexicon (word, polarity in hundredths) ------------
TEST_LEXICON = [
    ("the", -89), ("of", 97), ("and", 55), ("in", 36), ("for", -88), ("with", 95),
    ("that", 28), ("was", 78), ("this", 78), ("from", -16), ("rewh", 19), ("thatin", 45),
    ("hehely", 88), ("tion", -24), ("thon", -55), ("ther", -34), ("able", 65), ("ing", 77),
]
# registered spans end at the newest event and cover the whole 30-day tables
SPAN_ALL = "30 days"
SPANS = {"": SPAN_ALL, "_7d": "7 days", "_5m": "5 minutes"}     # the last two cut
# ------------------------------------------------------------------------------


def fixture_lexicon(spark: SparkSession) -> DataFrame:
    return lexicon_frame(spark, TEST_LEXICON)


def doc_scores(spark: SparkSession, sf_dir: str, rule: str = "strict") -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return score_documents(docs, fixture_lexicon(spark), rule)


_DOC_COUNTS: WeakKeyDictionary = WeakKeyDictionary()
# one score row per document (about 50 bytes): broadcast up to a million documents
SCORE_BROADCAST_MAX_DOCS = 1_000_000


def scores_fit(spark: SparkSession, sf_dir: str, max_docs: int = SCORE_BROADCAST_MAX_DOCS) -> bool:
    """The per-document scores are small enough to broadcast: a count of the
    documents table (one number per task), taken once for each table and session."""
    seen = _DOC_COUNTS.setdefault(spark, {})
    if sf_dir not in seen:
        seen[sf_dir] = read_table(spark, sf_dir, "documents", "doc_id").count()
    return seen[sf_dir] <= max_docs


def scored_posts(spark: SparkSession, sf_dir: str, rule: str = "wide") -> DataFrame:
    """Posts view + ``polarity, sentiment_label, sentiment_score`` (no text).  The
    scores are broadcast when the document count allows it (a proven bound: one
    row per document); beyond it the join shuffles on ``doc_id``."""
    scores = doc_scores(spark, sf_dir, rule).drop("hits", "polarity_sum", "unscored")
    return attach_scores(posts_view(spark, sf_dir), scores, broadcast_scores=scores_fit(spark, sf_dir))


def newest_event(spark: SparkSession, sf_dir: str):
    return as_of(read_table(spark, sf_dir, "events", "ts"))


def oldest_event(spark: SparkSession, sf_dir: str):
    return read_table(spark, sf_dir, "events", "ts").select(F.min("ts")).scalar()


def event_count(spark: SparkSession, sf_dir: str):
    return read_table(spark, sf_dir, "events", "event_id").select(F.count(F.lit(1))).scalar()
