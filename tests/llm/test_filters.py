import numpy as np
import pytest
from pyspark.sql import functions as F

from llm import boosted
from llm.boosted import classifier_filter, feature_matrix, fit, is_held_out, score_documents, train
from llm.quality_rules import MEASURES, judge_documents, limits, quality_filter, quantile_sketch
from llm.textstats import STATS, text_stats
from llm.url_model import host_and_path, judge_urls, matching_rule
from tests.llm.helpers import LONG, ODD, WORDS, awkward_documents, empty_like


# --- counts and rules --------------------------------------------------------------------------------
def slow_stats(text):
    words = WORDS.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORDS.search(x)]
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    inside = {p for i, g in enumerate(windows) if windows.count(g) > 1 for p in range(i, i + 8)}
    return (len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines), len(lines) - len(set(lines)),
            len(inside), len(set(words)), sum(a == b for a, b in zip(words, words[1:])))


def test_counts_equal_the_plain_ones():
    rng = np.random.Generator(np.random.PCG64(3))
    texts = [None, "", " \n", *ODD, "a b c d e f g h a b c d e f g h", "x " * 40, "one\n one\none\n\n \none"]
    texts += [" ".join(rng.choice(["a", "b", "c#"], rng.integers(1, 60))) + "\n" * int(rng.integers(0, 3)) for _ in range(200)]
    assert [t for t in texts if text_stats(t) != slow_stats(t)] == []
    assert text_stats(LONG)[0] == 30_001


def test_rules_of_awkward_documents(spark):
    docs = awkward_documents(spark)
    rows = judge_documents(docs).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.kept and r.base_failed)
    kept = quality_filter(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in rows)
    assert judge_documents(empty_like(docs)).count() == 0 and quality_filter(empty_like(docs)).count() == 0


def test_limits_follow_the_group_and_small_groups_take_merged_ones(spark):
    """Symbols are common in one source and rare elsewhere; a document is judged by its own source."""
    rng = np.random.Generator(np.random.PCG64(8))
    word = lambda: "".join(rng.choice(list("abcdefghij"), 5))
    rows = []
    for i in range(900):
        source = ("code", "news", "tiny")[min(i % 3, 1) if i >= 12 else i % 3]
        mark = rng.integers(2, 12) if source == "code" else 0
        rows.append((i, " ".join(word() + ("#" * 2 if w < mark else "") for w in range(60)), "en", source))
    heavy = " ".join(word() + "##" for _ in range(60))
    some = " ".join(word() + ("##" if w < 14 else "") for w in range(60))
    rows += [(2000, some, "en", "code"), (2001, heavy, "en", "code"), (2002, some, "en", "news"), (2003, some, "en", "tiny"), (2004, some, "xx", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id: r.kept for r in judge_documents(docs).collect()}
    assert kept[2000] and not kept[2001] and not kept[2002]
    assert all(kept[i] for i in range(900))
    ids = {r.doc_id for r in quality_filter(docs).collect()}
    assert ids == {i for i, k in kept.items() if k}


def test_every_limit_follows_the_habit_of_its_source(spark):
    """Two sources that differ in every measure get different limits for every one; and 39 % of duplicate lines fail where there are none."""
    rng = np.random.Generator(np.random.PCG64(9))
    word = lambda n: "".join(rng.choice(list("abcdefghij"), n))

    def document(rough):
        lines = [" ".join(word(rng.integers(4, 8) + 3 * rough) + ("#" * int(rng.integers(0, 3)) if rough else "") for _ in range(6)) for _ in range(14)]
        if rough:
            lines = [line + " " + " ".join([word(3)] * int(rng.integers(1, 4))) for line in lines]
            lines += ["so it is"] * int(rng.integers(1, 5))
        return "\n".join(lines)

    rows = [(i, document(i % 2), "en", ("plain", "rough")[i % 2]) for i in range(600)]
    between = [" ".join(word(5) for _ in range(8)) for _ in range(10)]
    rows += [(1000, "\n".join(x for line in between[:8] for x in (line, "read more")) + "\n" + "\n".join(between[8:]), "en", "plain")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    from llm.quality_rules import _stats

    sketch = quantile_sketch(docs.select("lang", "source", _stats(F.col("text")).alias("q")), ["lang", "source"], "q")
    by = {r.source: r.asDict() for r in limits(sketch, "lang", "source").collect()}
    for m, (side, _, _) in MEASURES.items():
        for s in ("lo", "hi"):
            if side != {"lo": "high", "hi": "low"}[s]:
                assert by["plain"][f"{s}_{m}"] != by["rough"][f"{s}_{m}"], m
    judged = {r.doc_id: r for r in judge_documents(docs).collect()}
    assert judged[1000].n_dup_lines == 7 and not judged[1000].base_failed and not judged[1000].kept
    assert all(judged[i].kept for i in range(600))


def test_good_documents_stay(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    judged = judge_documents(docs).join(labels, "doc_id")
    assert judged.filter("quality = 1 AND NOT base_failed AND NOT kept").count() == 0
    assert judged.filter("quality = 0 AND kept").count() <= 0.02 * judged.filter("quality = 0").count()


def test_merged_sketches_equal_the_sketch_of_all(spark):
    from llm.quality_rules import _stats, merge, octiles

    docs = spark.range(3000).select(F.expr("repeat(concat('word', id % 97, ' '), 25 + id % 400)").alias("text"), (F.col("id") % 5).cast("string").alias("lang"))
    rows = docs.select("lang", F.lit("s").alias("source"), _stats(F.col("text")).alias("q")).withColumn(
        "q", F.col("q").withField("n_repeat_words", F.lit(0).cast("long")))
    whole = sorted(map(tuple, quantile_sketch(rows, [], "q").collect()))
    parts = quantile_sketch(rows, ["lang", "source"], "q")
    assert sorted(map(tuple, merge(parts, []).collect())) == whole
    q2 = {r.measure: r.middle for r in octiles(parts, []).collect()}
    assert set(q2) == set(MEASURES)
    assert limits(parts, "lang", "source").count() == 5
    assert len(STATS) == 8


# --- classifier -----------------------------------------------------------------------------------------
def test_forest_arrays_equal_walking_the_trees():
    rng = np.random.Generator(np.random.PCG64(1))
    x = rng.standard_normal((800, 5))
    y = ((x[:, 0] > 0.3) ^ (x[:, 2] > 0)).astype(float)
    forest = train(x, y, trees=20)
    assert ((forest.score(x) > 0.5) == y).mean() > 0.95
    for row in x[:40]:
        total = forest.base
        for f, c, v in zip(forest.feature, forest.cut, forest.value):
            node = 0
            while node < len(f):
                node = 2 * node + 1 + int(row[f[node]] > c[node])
            total += v[node - len(f)]
        assert total == pytest.approx(forest.raw(row[None, :])[0])


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rows = score_documents(docs, fit(docs, labels)).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == is_held_out(r.doc_id) for r in rows) and len(held) > 300
    assert np.mean([r.predicted == r.quality for r in held]) > 0.98
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)


def test_classifier_of_awkward_tables(spark):
    docs = awkward_documents(spark)
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (4, None), (7, 1), (7, 0), (99, 1)], "doc_id long, quality int")
    forest = fit(docs, labels)
    rows = score_documents(docs, forest).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert classifier_filter(docs, forest).columns == docs.columns
    none = fit(docs, empty_like(labels))
    assert none.score(feature_matrix([None, "x"])).tolist() == [0.5, 0.5]
    assert score_documents(empty_like(docs), none).count() == 0
    assert fit(empty_like(docs), labels).score(feature_matrix(["x"])).tolist() == [0.5]
    assert boosted.MAX_TRAIN == 20_000


# --- URLs -------------------------------------------------------------------------------------------------
def test_hosts_rules_and_verdicts(spark):
    urls = {1: "HTTP://Blog.Example.NET/en/x?y#z", 2: "http://example.net/fr/1", 3: "x.example.com/de/", 4: None, 5: "", 6: "https://a.example.com/de/9",
            7: "ftp://org/fr/", 8: "http://net", 9: "http://netx/", 10: "http://my.net/a?b=c://d", 11: "http://example.org/EN/\n1", 12: "://", 13: "http://notexample.net/en/1"}
    df = spark.createDataFrame([*urls.items(), (1, urls[1])], "page_id long, url string").withColumn("host", F.lit("own")).withColumn("gram", F.lit(1))
    host, path = host_and_path(F.col("url"))
    rule, verdict = matching_rule(F.col("h"), F.col("p"))
    got = {r.page_id: (r.h, r.p, r.r, r.v) for r in df.select("page_id", host.alias("h"), path.alias("p")).withColumn("r", rule).withColumn("v", verdict).collect()}
    assert got[1] == ("blog.example.net", "/en/x", "example.net/en/", "allow")
    assert got[2] == ("example.net", "/fr/1", "net/", "block")
    assert got[3] == got[4] == got[5] == ("", "", None, None)
    assert got[6][2:] == ("example.com/de/", "block") and got[7][2:] == ("org/fr/", "allow")
    assert got[8] == ("net", "", None, None) and got[9][2] is None and got[10] == ("my.net", "/a", "net/", "block")
    assert got[11][:2] == ("example.org", "/EN/\n1") and got[12][:2] == ("", "") and got[13][2] == "net/"
    rows = judge_urls(df).collect()
    assert len(rows) == 14 and all(r.verdict in ("allow", "block") for r in rows)
    assert all(r.verdict == got[r.page_id][3] for r in rows if got[r.page_id][3])
    assert judge_urls(empty_like(df)).count() == 0


def test_the_model_reads_the_whole_url(spark):
    rows = [(i, f"http://a.net/p?deal={i}") for i in range(60)] + [(100 + i, f"http://a.org/fr/p#study{i}") for i in range(60)]
    rows += [(900, "http://b.edu/p?deal=1"), (901, "http://b.edu/p#study1"), (902, "deal=1 deal=2"), (903, "study1 study2"), (904, None)]
    got = {r.page_id: r for r in judge_urls(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert [got[i].verdict for i in (900, 901, 902, 903)] == ["block", "allow", "block", "allow"]
    assert (got[900].host, got[900].path) == (got[901].host, got[901].path) == ("b.edu", "/p") and len({got[i].score_milli for i in (902, 903, 904)}) == 3


def test_unruled_urls_go_with_the_side_they_resemble(spark):
    rows = [(i, f"http://shop{i % 7}.net/buy/cheap-{i}") for i in range(120)] + [(200 + i, f"http://uni{i % 5}.org/fr/text-{i}") for i in range(120)]
    rows += [(900, "http://shop3.biz/buy/cheap-7"), (901, "http://uni2.edu/fr/text-9")]
    got = {r.page_id: (r.rule, r.verdict) for r in judge_urls(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert got[900] == (None, "block") and got[901] == (None, "allow")
    no_models = judge_urls(spark.createDataFrame([(1, "http://a.b/c"), (2, None)], "page_id long, url string")).collect()
    assert [r.verdict for r in no_models] == ["allow", "allow"]
