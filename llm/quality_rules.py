"""Operator 10: quality rules whose cut-offs follow the data.

Each text gets its counts (``llm.textstats``).  Five whole-number measures of the documents that pass the base
rule go into quantile sketches, one for each (language, source, measure): a sketch is a table of bucket counts
with eight significant bits a bucket, so sketches merge by adding counts, in any order, with one result.  A
measure's limit is the group's outer octile on the side in question (seven eighths, or one eighth, of its documents lie
inside) and from there ``reach`` times the distance between median and octile.  So a group's habit and its spread set
the limit, and up to an eighth of junk does not move it.  The distance counts as one ``unit`` at least, which matters only
where nearly all documents of a group have one value, such as no symbol at all.  A (language, source) with fewer than ``least`` documents takes its language's merged sketch, and a
language with fewer takes the one of all.  The limits are joined back and the documents outside them fail.

Base rule: fewer than 20 words, or over 30 % of the words in repeated 8-word windows.

Defined cases: a null or empty text has no words and fails the base rule; a null language or source is a group
of its own; repeated rows are judged alike; an empty table gives no rows; columns of any name are
kept by ``quality_filter`` and not read by ``judge_documents``.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm.shared import bounded_batches, stored
from llm.textstats import STATS, text_stats

MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30
LEAST_DOCS = 100          # documents of a group that has limits of its own
#: measure -> (side that fails, reach, unit): per mille, but word_length in hundredths of a character
MEASURES = {"symbols": ("high", 8, 4), "dup_lines": ("high", 8, 45), "adjacent": ("high", 12, 2), "unique": ("low", 5, 5),
            "word_length": ("both", 8, 2)}
BUCKET_BITS = 8
BROADCAST_GROUPS = 100_000    # groups whose limits are broadcast (about 100 bytes each); more are joined by shuffle
STATS_TYPE = "struct<" + ", ".join(f"{s}: bigint" for s in STATS) + ">"


def _count(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([text_stats(t) for t in texts], columns=STATS, dtype="int64")


def _stats(text: Column) -> Column:
    """The counts of a text.  Declared not deterministic so that the optimizer evaluates it once, however many filters and
    columns read its fields."""
    return F.pandas_udf(_count, STATS_TYPE).asNondeterministic()(text.cast("string"))


def _new_name(df: DataFrame, name: str) -> str:
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def base_failed(q: str) -> Column:
    return ((F.col(f"{q}.n_words") < MIN_WORDS)
            | (100 * F.col(f"{q}.n_repeat_words") > MAX_REPEAT_PERCENT * F.col(f"{q}.n_words")))


def _share(part: str, whole: str, scale: int = 1000) -> Column:
    return F.expr(f"{scale} * {part} div greatest({whole}, 1)")


def measures(q: str) -> Column:
    """Map of a document's measures."""
    at = {"symbols": ("n_symbols", "word_chars"), "dup_lines": ("n_dup_lines", "n_lines"),
          "adjacent": ("n_adjacent", "n_words"),
          "unique": ("n_unique", "n_words")}
    cols = {m: _share(f"`{q}`.{a}", f"`{q}`.{b}") for m, (a, b) in at.items()}
    cols["word_length"] = _share(f"`{q}`.word_chars", f"`{q}`.n_words", 100)
    return F.struct(*[cols[m].alias(m) for m in MEASURES])


def quantile_sketch(rows: DataFrame, keys: list[str], q: str) -> DataFrame:
    """``keys, measure, bucket, n``: bucket counts of the documents that pass the base rule.  Counts are summed in
    each task before the shuffle, so a group of any size sends a row a bucket and task."""
    m = rows.filter(~base_failed(q)).select(*keys, measures(q).alias("_m"))
    each = F.explode(F.array(*[F.struct(F.lit(x).alias("measure"), F.col(f"_m.{x}").alias("v")) for x in MEASURES]))
    low_edge = F.expr(f"shiftleft(shiftright(v, greatest(length(bin(v)) - {BUCKET_BITS}, 0)),"
                      f" greatest(length(bin(v)) - {BUCKET_BITS}, 0))")
    return (m.select(*keys, each.alias("_e")).select(*keys, "_e.*").withColumn("bucket", low_edge)
            .groupBy(*keys, "measure", "bucket").agg(F.count(F.lit(1)).alias("n")))


def merge(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """The sketches of coarser groups."""
    return sketch.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))


def octiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, measure, docs, low, middle, high``: the first buckets that reach one, four and seven eighths of the documents."""
    w = Window.partitionBy(*keys, "measure")
    run = (sketch.withColumn("_cum", F.sum("n").over(w.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)))
           .withColumn("_all", F.sum("n").over(w)))
    return run.groupBy(*keys, "measure").agg(
        F.max("_all").alias("docs"),
        *[F.min(F.when(8 * F.col("_cum") >= k * F.col("_all"), F.col("bucket"))).alias(c) for c, k in (("low", 1), ("middle", 4), ("high", 7))])


def limits(sketch: DataFrame, lang: str, source: str, least: int = LEAST_DOCS) -> DataFrame:
    """``lang, source`` and ``lo_<measure>, hi_<measure>`` of every group in the sketch."""
    def bounds(by: DataFrame, keys: list[str], tag: str) -> DataFrame:
        cols = []
        for m, (side, reach, unit) in MEASURES.items():
            is_m = F.col("measure") == m
            low = F.col("low") - reach * F.greatest(F.col("middle") - F.col("low"), F.lit(unit))
            high = F.col("high") + reach * F.greatest(F.col("high") - F.col("middle"), F.lit(unit))
            cols.append(F.max(F.when(is_m, low if side != "high" else F.lit(None).cast("long"))).alias(f"lo_{m}"))
            cols.append(F.max(F.when(is_m, high if side != "low" else F.lit(None).cast("long"))).alias(f"hi_{m}"))
        return octiles(by, keys).groupBy(*keys).agg(F.max("docs").alias("docs"), *cols).select(
            *keys, F.col("docs").alias(f"{tag}_docs"), F.struct(*[f"{s}_{m}" for m in MEASURES for s in ("lo", "hi")]).alias(tag))

    own = bounds(sketch, [lang, source], "own")
    of_lang = bounds(merge(sketch, [lang]), [lang], "of_lang").withColumnRenamed(lang, "_l")
    of_all = bounds(merge(sketch, []), [], "of_all")
    both = own.join(of_lang, own[lang].eqNullSafe(of_lang["_l"])).crossJoin(of_all)     # of_all: one row
    chosen = (F.when(F.col("own_docs") >= least, F.col("own"))
              .when(F.col("of_lang_docs") >= least, F.col("of_lang")).otherwise(F.col("of_all")))
    return both.select(lang, source, chosen.alias("_c")).select(lang, source, "_c.*")


def _join_limits(rows: DataFrame, lim: DataFrame, lang: str, source: str) -> tuple[DataFrame, Column]:
    """Rows with their group's limits as ``_lim...`` columns, and the condition to stay inside them."""
    few = lim.count() <= BROADCAST_GROUPS
    name = _new_name(rows, "_lim")
    lim = lim.select(F.col(lang).alias(f"{name}_l"), F.col(source).alias(f"{name}_s"),
                     F.struct(*[c for c in lim.columns if c[:3] in ("lo_", "hi_")]).alias(name))
    on = (F.col(f"`{lang}`").eqNullSafe(F.col(f"{name}_l")) & F.col(f"`{source}`").eqNullSafe(F.col(f"{name}_s")))
    joined = rows.join(F.broadcast(lim) if few else lim, on, "left")
    return joined, name


def _inside(q: str, name: str) -> Column:
    m = measures(q)
    ok = F.lit(True)
    for x in MEASURES:
        v = m.getField(x)
        ok = (ok & F.coalesce(v >= F.col(f"{name}.lo_{x}"), F.lit(True))
              & F.coalesce(v <= F.col(f"{name}.hi_{x}"), F.lit(True)))
    return ok


def judge_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
                    source: str = "source", least: int = LEAST_DOCS) -> DataFrame:
    """``key``, the counts, ``base_failed`` and ``kept`` of every document.  The texts are read once; the narrow
    counts are a table in the shared folder, read for the sketches and again for the verdicts."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{lang}`").alias("lang"),
                       F.col(f"`{source}`").alias("source"), _stats(F.col(f"`{text}`")).alias("q"))
    rows = stored(rows, "text-stats")
    sketch = stored(quantile_sketch(rows, ["lang", "source"], "q"), "sketch")
    lim = stored(limits(sketch, "lang", "source", least), "limits")
    joined, name = _join_limits(rows, lim, "lang", "source")
    return joined.select(F.col("_key").alias(key), *[f"q.{s}" for s in STATS], base_failed("q").alias("base_failed"),
                         (~base_failed("q") & _inside("q", name)).alias("kept"))


def quality_filter(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
                   least: int = LEAST_DOCS) -> DataFrame:
    """The documents that pass, with all their columns.  Two passes over the texts: one for the sketches and
    one for the verdicts, so that nothing but whole rows that stay is written."""
    bounded_batches(docs.sparkSession)
    only = docs.select(F.col(f"`{lang}`").alias("lang"), F.col(f"`{source}`").alias("source"),
                       _stats(F.col(f"`{text}`")).alias("q"))
    sketch = stored(quantile_sketch(only, ["lang", "source"], "q"), "sketch")
    lim = stored(limits(sketch, "lang", "source", least), "limits")
    q = _new_name(docs, "_q")
    joined, name = _join_limits(docs.withColumn(q, _stats(F.col(f"`{text}`"))),
                                lim.withColumnsRenamed({"lang": lang, "source": source}), lang, source)
    return joined.filter(~base_failed(q) & _inside(q, name)).select(*[F.col(f"`{c}`") for c in docs.columns])
