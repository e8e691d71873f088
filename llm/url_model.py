"""Operator 5: URL filter by rules and a character language-model ratio, in DataFrame functions only.

Rules decide the URLs they fit.  Those URLs also train two variable-order Markov models over characters, one of
accepted and one of rejected URLs: the chance of a character after up to ``ORDER`` others is interpolated from the longest context
down, each order weighted by how many different characters followed the context (Witten-Bell).  A URL's score is the mean over its
characters of the difference of the two log-likelihoods.  The cut between accepted and rejected scores is calibrated on the
URLs that rules decided: the cut with the fewest mistakes, as shares of each side.  URLs without a rule get their verdict from it.

Log-likelihood differences are kept in whole millionths, so sums do not depend on their order.

How it scales: the URLs are cut into grams of ``ORDER + 1`` characters once; per distinct gram two counts, summed in each task before the
shuffle.  The models are built from those distinct grams alone, an order at a time, and each gram ends up with one number, which
joins the URLs' grams: broadcast if counted to be few, else by shuffle, where Spark splits very common grams.

Defined cases: a null URL, or one without ``://``, has an empty host and path and fits no rule; the first is scored as the
empty text, the second by its own characters; repeated rows are judged alike; with no URL decided by a rule, or all one way, the model of the missing side is uniform and the
cut is 0; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm.shared import stored

RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
ORDER = 4                     # characters of the longest context
START, END = "\u0002", "\u0003"
MICRO, MILLI = 1_000_000, 1_000
URLS_A_TASK = 20_000
BROADCAST_GRAMS = 500_000     # grams whose numbers are broadcast (about 40 MB); more are joined by shuffle


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host, A-Z in lower case, and the path, both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.coalesce(F.regexp_extract(rest, r"^([^/?#]*)", 1), F.lit(""))
    path = F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def matching_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        cut = text.index("/")
        fits = (((host == text[:cut]) | host.endswith("." + text[:cut])) & path.startswith(text[cut:]))
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def grams_of(text: Column) -> Column:
    """Each character of the text, and the end, after the ``ORDER`` before it."""
    padded = F.concat(F.lit(START * ORDER), text, F.lit(END))
    return F.transform(F.sequence(F.lit(1), F.length(text) + 1), lambda i: F.substring(padded, i, F.lit(ORDER + 1)))


def gram_ratios(counts: DataFrame) -> DataFrame:
    """``gram, micro`` from ``gram, a, b`` (accepted and rejected counts of each distinct gram): the difference of the two
    smoothed log-likelihoods of the gram's last character after the others."""
    before: DataFrame | None = None
    for k in range(ORDER + 1):
        gram = F.substring("gram", ORDER + 1 - k, k + 1)
        at = (counts.groupBy(gram.alias("g")).agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
              .withColumn("ctx", F.substring("g", 1, k)))
        ctx = at.groupBy("ctx").agg(*[f for s in "ab" for f in (F.sum(s).alias(f"n{s}"), F.count(F.when(F.col(s) > 0, 1)).alias(f"t{s}"))],
                                    F.count(F.lit(1)).alias("chars"))
        at = at.join(ctx, "ctx")
        if before is None:      # below the lowest order, all characters of the table are alike; one row, so "chars" is their number
            at = at.withColumn("qa", 1.0 / F.col("chars")).withColumn("qb", 1.0 / F.col("chars"))
        else:
            at = at.withColumn("low", F.substring("g", 2, k)).join(before, "low")
        for s in "ab":
            n, t = F.col(f"n{s}").cast("double"), F.col(f"t{s}").cast("double")
            p = F.when(n + t > 0, (F.col(s) + t * F.col(f"q{s}")) / (n + t)).otherwise(F.col(f"q{s}"))
            at = at.withColumn(f"p{s}", p)
        before = at.select(F.col("g").alias("low"), F.col("pa").alias("qa"), F.col("pb").alias("qb"))
    return before.select(F.col("low").alias("gram"), F.round((F.log("qa") - F.log("qb")) * MICRO).cast("long").alias("micro"))


def best_cut(decided: DataFrame) -> DataFrame:
    """One row ``cut``: of scores in thousandths, the cut with the fewest mistakes (share of accepted below and
    of rejected at or above), half way between two scores that occur; of several the nearest to 0.  A histogram of the
    scores is all that is ordered."""
    bins = decided.groupBy("milli").agg(F.sum("is_a").alias("a"), F.sum("is_b").alias("b"))
    below = Window.orderBy("milli").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    middle = F.floor((F.col("milli") + F.coalesce(F.lag("milli").over(Window.orderBy("milli")), F.col("milli"))) / 2)
    cuts = (bins.select(middle.alias("milli"), F.coalesce(F.sum("a").over(below), F.lit(0)).alias("lost"),
                        F.coalesce(F.sum("b").over(below), F.lit(0)).alias("caught"),
                        F.sum("a").over(every).alias("na"), F.sum("b").over(every).alias("nb"))
            .filter("na > 0 and nb > 0")
            .select("milli", (F.col("lost") * F.col("nb") + (F.col("nb") - F.col("caught")) * F.col("na")).alias("wrong")))
    best = cuts.agg(F.min(F.struct("wrong", F.abs("milli").alias("far"), "milli")).alias("m"))
    return best.select(F.coalesce(F.col("m.milli"), F.lit(0)).cast("long").alias("cut"))


def judge_urls(pages: DataFrame, key: str = "page_id", url: str = "url", rules=RULES) -> DataFrame:
    """``key, host, path, rule, verdict, score_milli`` of every row (the score in thousandths of a nat per character).
    The model reads the whole URL (null: empty)."""
    given = F.col(f"`{url}`").cast("string")
    host, path = host_and_path(given)
    rows = pages.select(F.col(f"`{key}`").alias("key"), host.alias("host"), path.alias("path"), F.coalesce(given, F.lit("")).alias("text"))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    rows = stored(rows.withColumn("rule", rule).withColumn("said", verdict), "urls")

    # URLs are short and their grams many: the number of rows, not their bytes, sets the tasks that spell them out
    tasks = max(pages.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // URLS_A_TASK))
    urls = rows.groupBy("text", "said").agg(F.count(F.lit(1)).alias("rows")).repartition(tasks, "text")
    every = urls.select("rows", "said", F.explode(grams_of(F.col("text"))).alias("gram"))
    a, b = (F.coalesce(F.sum(F.when(F.col("said") == s, F.col("rows"))), F.lit(0)) for s in ("allow", "block"))
    counts = stored(every.groupBy("gram").agg(a.alias("a"), b.alias("b")), "grams")
    ratios = stored(gram_ratios(counts), "ratios")
    known = F.broadcast(ratios) if ratios.count() <= BROADCAST_GRAMS else ratios

    texts = rows.select("text").distinct().repartition(tasks, "text")
    scores = stored(texts.select("text", F.explode(grams_of(F.col("text"))).alias("gram")).join(known, "gram")
                    .groupBy("text").agg(F.sum("micro").alias("total"), F.count(F.lit(1)).alias("n"))
                    .select("text", F.floor(F.col("total") / F.col("n") / (MICRO // MILLI)).alias("milli")), "scores")
    scored = stored(rows.join(scores, "text"), "scored")
    cut = best_cut(scored.filter("said is not null").select(
        "milli", (F.col("said") == "allow").cast("long").alias("is_a"), (F.col("said") == "block").cast("long").alias("is_b")))
    judged = F.coalesce("said", F.when(F.col("milli") >= F.col("cut"), "allow").otherwise("block"))
    return scored.crossJoin(F.broadcast(cut)).select(        # one row
        F.col("key").alias(key), "host", "path", "rule", judged.alias("verdict"), F.col("milli").alias("score_milli"))
