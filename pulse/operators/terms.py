"""Search for very many terms: a join of token n-grams, not one pattern."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulse.operators.ingest import search_predicate
from pulse.session import stored

BROADCAST_TERMS = 500_000        # terms that are broadcast (about 100 bytes each); more are joined by shuffle
PATTERN_TERMS = 100              # alternatives of one pattern, for terms without a letter or digit

_PARTS = "[^a-z0-9]+"


def _tokens(c: Column) -> Column:
    """The runs of ``a-z0-9`` of a lower-cased text."""
    return F.filter(F.split(F.lower(c), _PARTS), lambda t: t != "")


def _between(c: Column) -> Column:
    """What stands before, between and after the tokens of a lower-cased text: one string more than tokens."""
    return F.split(F.lower(c), "[a-z0-9]+")


def _grams(n: int) -> Column:
    """The n-grams of the tokens ``_t`` as they stand in the text, with what ``_s`` holds between them (none of a shorter text)."""
    if n == 1:
        return F.col("_t")
    starts = F.when(F.size("_t") >= n, F.sequence(F.lit(0), F.size("_t") - n)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.concat(F.get("_t", i), *[p for k in range(1, n) for p in (F.get("_s", i + k), F.get("_t", i + k))]))


def _spaced(n: int) -> Column:
    """The n-grams of the tokens ``_t``, joined by a space (a shorter text is one)."""
    if n == 1:
        return F.col("_t")
    starts = F.sequence(F.lit(1), F.greatest(F.size("_t") - (n - 1), F.lit(1)))
    return F.transform(starts, lambda i: F.array_join(F.slice(F.col("_t"), i, n), " "))


def term_matches(texts: DataFrame, terms: DataFrame, key: str = "doc_id", text: str = "text", term: str = "term") -> DataFrame:
    """``key, term`` for each term that a text holds as a whole phrase in any case (bounded by a character other than ``a-z0-9``, or
    the text's edge), as ``search_predicate`` finds them.

    A term that begins and ends with a token (a run of ``a-z0-9``) occurs where an n-gram of the text, with all that stands between
    its tokens, equals the term: the texts' n-grams, for the lengths that terms have, meet these terms by hash, and no
    text is looked at again.  A term with other characters at an edge has its tokens in a row in the text; these n-grams give the
    candidate pairs, and the phrase is then looked up in the text of each.  Terms of one length more cost one n-gram more a
    token, and the number of terms costs nothing in the scan.  Terms without a token are searched by patterns of at most
    ``PATTERN_TERMS`` alternatives.  Keys need to be unique; null texts and null or empty terms match nothing."""
    wanted = terms.select(F.lower(F.col(term)).alias("_low")).filter("_low <> ''").distinct().withColumn("_tokens", _tokens(F.col("_low")))
    wanted = wanted.select("_low", F.array_join("_tokens", " ").alias("_gram"), F.size("_tokens").alias("_n"))
    edged = F.col("_low").rlike("^[^a-z0-9]|[^a-z0-9]$")
    wanted = stored(wanted.withColumn("_edged", (F.col("_n") > 0) & edged), "search-terms")      # terms that cost a scan cost one
    kinds = [(r[0], r[1]) for r in wanted.select("_n", "_edged").distinct().collect()]      # a handful of lengths
    sizes = sorted({n for n, _ in kinds})
    plain, open_sizes = sorted(n for n, e in kinds if n and not e), sorted(n for n, e in kinds if e)
    whole = texts.select(F.col(key).alias("_key"), F.col(text).alias("_text")).filter("_text IS NOT NULL")
    found = []
    parts = whole.select("_key", _tokens(F.col("_text")).alias("_t"), _between(F.col("_text")).alias("_s"))

    def pairs(grams: list[Column], some: DataFrame, by: str) -> DataFrame:
        rows = parts.select("_key", F.explode(F.array_distinct(F.concat(*grams) if len(grams) > 1 else grams[0])).alias("_g"))
        few = some.count() <= BROADCAST_TERMS
        return rows.join(F.broadcast(some) if few else some, F.col("_g") == F.col(by)).select("_key", "_low")

    if plain:
        found.append(pairs([_grams(n) for n in plain], wanted.filter("_n > 0 AND NOT _edged").select("_low"), "_low"))
    if open_sizes:
        open_ = pairs([_spaced(n) for n in open_sizes], wanted.filter("_edged"), "_gram").withColumnRenamed("_key", "_k")
        quoted = F.concat(F.lit("(^|[^a-z0-9])\\Q"), F.replace(F.col("_low"), F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E([^a-z0-9]|$)"))
        # candidates are gathered by text, so a text is joined once and looked at for each of its candidates
        gathered = open_.groupBy("_k").agg(F.collect_set("_low").alias("_lows"))
        there = whole.join(gathered, F.col("_key") == F.col("_k")).select("_key", F.lower("_text").alias("_text"), F.explode("_lows").alias("_low"))
        found.append(there.filter(F.rlike(F.col("_text"), quoted)).select("_key", "_low"))
    if 0 in sizes:
        bare = sorted(r[0] for r in wanted.filter("_n = 0").select("_low").collect())
        for i in range(0, len(bare), PATTERN_TERMS):
            some = bare[i:i + PATTERN_TERMS]
            hits = whole.filter(search_predicate("_text", some, lang=None, exclude_reposts=False))
            each = hits.select("_key", "_text", F.explode(F.array(*[F.lit(t) for t in some])).alias("_low"))
            quoted = F.concat(F.lit("(^|[^a-z0-9])\\Q"), F.replace(F.col("_low"), F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E([^a-z0-9]|$)"))
            found.append(each.filter(F.rlike(F.lower("_text"), quoted)).select("_key", "_low"))
    if not found:
        return whole.select(F.col("_key").alias(key), F.lit("").alias(term)).limit(0)
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out.select(F.col("_key").alias(key), F.col("_low").alias(term))


def search_terms(posts: DataFrame, terms: DataFrame, lang: str | None = None, exclude_reposts: bool = True, key: str = "id",
                 text: str = "text", lang_col: str = "lang", term: str = "term", repost_prefix: str = "RT @") -> DataFrame:
    """``search`` for a table of terms of any number: posts that hold one of them, in language ``lang``, no reposts."""
    rows = posts
    if lang is not None:
        rows = rows.filter(F.col(lang_col) == lang)
    if exclude_reposts:
        rows = rows.filter(~F.coalesce(F.col(text).startswith(repost_prefix), F.lit(False)))
    hits = term_matches(rows, terms, key, text, term).select(F.col(key).alias("_hit")).distinct()
    return rows.join(hits, rows[key] == F.col("_hit"), "left_semi")
