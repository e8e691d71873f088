import pytest

from pulse.operators.scoring import lexicon_frame, lexicon_polarity, score_texts, with_scorer

LEX = [("good", 80), ("bad", -60), ("ok", 10)]


def test_lexicon_polarity(spark):
    docs = spark.createDataFrame(
        [(1, "Good, good and BAD!"), (2, "nothing here"), (3, None), (4, "ok"), (5, "good2bad")],
        "doc_id long, text string")
    lex = lexicon_frame(spark, LEX)
    for cap in (10, 0):  # broadcast path and shuffle path agree
        rows = lexicon_polarity(docs, lex, broadcast_max_rows=cap).collect()
        assert {r.doc_id for r in rows if r.unscored} == {3}
        got = {r.doc_id: (r.hits, r.polarity_sum, r.polarity) for r in rows}
        assert got[1] == (3, 100, 100 / 300)
        assert got[2] == (0, 0, 0.0) and got[3] == (0, 0, 0.0)
        assert got[4] == (1, 10, 0.1)
        assert got[5] == (2, 20, 0.1)


def test_score_texts_joins_back(spark):
    posts = spark.createDataFrame([("a", "good"), ("b", "bad bad"), ("c", "")], "id string, text string")
    got = {r.id: (r.sentiment_label, r.sentiment_score)
           for r in score_texts(posts, lexicon_frame(spark, LEX)).collect()}
    assert got == {"a": ("VERY_POSITIVE", 1.0), "b": ("VERY_NEGATIVE", -1.0), "c": ("NEUTRAL", 0.0)}


def test_plugin_scorer_faults_are_flagged(spark):
    def scorer(t):
        if "boom" in t:
            raise ValueError("scorer fault")
        return 0.3
    df = spark.createDataFrame([("a", "fine"), ("b", "boom"), ("c", None)], "id string, text string")
    got = {r.id: (r.polarity, r.unscored, r.sentiment_label)
           for r in with_scorer(df, scorer, rule="wide").collect()}
    assert got["a"] == (0.3, False, "POSITIVE")
    assert got["b"] == (0.0, True, "NEUTRAL") and got["c"] == (0.0, True, "NEUTRAL")


def test_read_lexicon_from_a_table(spark, scratch):
    import os
    from pulse.operators.scoring import read_lexicon
    path = os.path.join(scratch, "lexicon.csv")
    with open(path, "w") as f:
        f.write("word,polarity_hundredths\nGood,80\nbad,-60\n")
    lex = read_lexicon(spark, path, fmt="csv", header="true")
    assert sorted(tuple(r) for r in lex.collect()) == [("bad", -60), ("good", 80)]
    docs = spark.createDataFrame([(1, "good good bad")], "doc_id long, text string")
    assert lexicon_polarity(docs, lex).first().polarity_sum == 100


def test_python_lexicon_scorer_equals_the_join(spark):
    from pulse.operators.scoring import lexicon_scorer
    texts = ["Good, good and BAD!", "nothing here", "ok", "good2bad", "élan goodé bad", "", "OK ok Ok"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    joined = {r.doc_id: r.polarity for r in lexicon_polarity(docs, lexicon_frame(spark, LEX)).collect()}
    fn = lexicon_scorer(LEX)
    assert {i: fn(t) for i, t in enumerate(texts)} == joined


def test_scores_belong_to_texts_not_ids(spark):
    from pulse.operators import lexicon_frame, score_texts

    rows = spark.createDataFrame([("a", "good"), ("a", "bad"), (None, "good"), ("b", None), ("c", "good")], "id string, text string")
    lex = lexicon_frame(spark, [("good", 80), ("bad", -60)])
    for most in (100, 0):                                  # broadcast and shuffle join
        got = sorted((str(r.id), str(r.text), r.polarity, r.unscored) for r in score_texts(rows, lex, broadcast_max_rows=most).collect())
        assert got == [("None", "good", 0.8, False), ("a", "bad", -0.6, False), ("a", "good", 0.8, False), ("b", "None", 0.0, True), ("c", "good", 0.8, False)]


def test_batch_scorer_loads_once_and_flags_faults(spark):
    import pandas as pd

    from pulse.operators import with_batch_scorer

    def load():
        def score(texts: pd.Series) -> pd.Series:
            assert texts.notna().all()
            if (texts == "fault").any():
                raise RuntimeError("model fault")
            return texts.str.len() / 10
        return score

    rows = spark.createDataFrame([("abc",), (None,), ("abcdef",)], "text string").coalesce(1)
    got = [(r.text, r.polarity, r.unscored) for r in with_batch_scorer(rows, load).collect()]
    assert got == [("abc", 0.3, False), (None, 0.0, True), ("abcdef", 0.6, False)]
    bad = with_batch_scorer(spark.createDataFrame([("fault",)], "text string"), load).first()
    assert bad.unscored and bad.sentiment_label == "NEUTRAL"


def test_batch_scorer_fault_costs_only_its_text(spark):
    from pulse.operators.scoring import with_batch_scorer

    def load():
        def score(texts):
            if (texts == "fault").any():
                raise RuntimeError("model fault")
            return texts.str.len() / 10.0
        return score

    rows = spark.createDataFrame([(t,) for t in ["a", "bb", "fault", None, "ccc"]], "text string").coalesce(1)
    got = {r.text: (r.polarity, r.unscored) for r in with_batch_scorer(rows, load).collect()}
    assert got == {"a": (0.1, False), "bb": (0.2, False), "fault": (0.0, True), None: (0.0, True), "ccc": (0.3, False)}

    def broken():
        raise OSError("no model")

    with pytest.raises(Exception, match="no model"):
        with_batch_scorer(rows, broken).collect()
