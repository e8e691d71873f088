import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import llm.near_dedup as near
from llm.components import components
from llm.near_dedup import dedup_filter, least_matches, near_duplicates, survivors
from llm.rotation_codes import Codes, band_plan, near_embeddings
from tests.llm.helpers import awkward_documents, brute_force_duplicates, empty_like, groups, shingles


def near_copies(rnd, base, n, share):
    out = []
    for _ in range(n):
        words = base.split()
        for _ in range(max(1, int(share * len(words)))):
            words[rnd.randrange(len(words))] = f"w{rnd.randrange(10 ** 6)}"
        out.append(" ".join(words))
    return out


def text(rnd, n):
    return " ".join(f"t{rnd.randrange(5000)}" for _ in range(n))


def family(rnd):
    """Near copies close to the threshold, texts that share a passage, exact copies, short and empty texts."""
    texts = []
    for size, share in ((60, 0.01), (50, 0.02), (40, 0.03), (5, 0.01)):
        base = text(rnd, 150)
        texts += [base, *near_copies(rnd, base, size, share)]
    passage = text(rnd, 60)
    texts += [f"{text(rnd, 30)} {passage} {text(rnd, 25)}" for _ in range(30)]
    texts += [text(rnd, 40)] * 20 + ["a b c", "A  b\tC", "a b", "", None, "only five words in here", "only five words in here too"]
    rnd.shuffle(texts)
    return texts


@pytest.mark.parametrize("block", [2000, 12])
def test_groups_equal_brute_force(spark, monkeypatch, block):
    """Also with large buckets dealt out in many blocks (the functions of the tasks are sent with the plan)."""
    monkeypatch.setattr(near, "BLOCK_ROWS", block)
    texts = family(random.Random(11))
    docs = spark.createDataFrame(list(enumerate(texts, 100)), "doc_id long, text string").repartition(5)
    want = brute_force_duplicates(dict(enumerate(texts, 100)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(docs).collect()}
    assert got == want
    kept = sorted(r.doc_id for r in dedup_filter(docs).collect())
    assert kept == sorted(i for i, (_, c) in want.items() if i == c)


def test_awkward_documents(spark):
    docs = awkward_documents(spark)
    rows = near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert [(r.n_shingles, r.component_id, r.kept) for r in by[1]] == [(3, 1, True)] * 2
    assert (by[4][0].component_id, by[4][0].kept) == (1, False)
    assert (by[2][0].n_shingles, by[2][0].component_id, by[2][0].kept) == (0, 2, True)
    assert sorted(r.n_shingles for r in by[None]) == [0, 1] and all(r.kept for r in by[None])
    kept = dedup_filter(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(1) == 1 and ids.count(5) == 2 and 4 not in ids and ids.count(None) == 2 and ids.count(7) == 1
    assert near_duplicates(empty_like(docs)).count() == 0 and dedup_filter(empty_like(docs)).count() == 0


def test_rows_that_share_an_id_are_judged_by_their_own_text(spark):
    """No text goes without a near copy that stays: four rows over three ids, and a table where a third of the rows repeat ids."""
    rnd = random.Random(2)
    a, b = text(rnd, 100), text(rnd, 100)
    a2, b2 = near_copies(rnd, a, 1, 0.005)[0], near_copies(rnd, b, 1, 0.005)[0]
    docs = spark.createDataFrame([(1, a), (5, a2), (5, b), (9, b2)], "doc_id long, text string")
    assert sorted(map(tuple, dedup_filter(docs).collect())) == sorted([(1, a), (5, b)])
    got = {(r.doc_id, r.component_id) for r in near_duplicates(docs).collect()}
    assert got == {(1, 1), (5, 1), (5, 5), (9, 5)}

    texts = family(rnd)
    rows = [(i if i % 3 else 3 * (i % 7), t) for i, t in enumerate(texts)]
    rows += rows[:20]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    kept = [tuple(r) for r in dedup_filter(docs).collect()]
    whole = brute_force_duplicates(dict(enumerate(t for _, t in rows)))
    of = lambda some: {whole[i][1] for i, r in enumerate(rows) if r in some and whole[i][0]}      # noqa: E731
    assert of(set(kept)) == of(set(rows))                             # a document of every component
    worded = [r for r in kept if shingles(r[1])]
    assert len(worded) == len(of(set(rows)))                          # and one only
    assert sorted(map(repr, (r for r in kept if not shingles(r[1])))) == sorted(map(repr, (r for r in rows if not shingles(r[1]))))


def test_posterior_bounds():
    assert all(least_matches(n) <= least_matches(n + 32) for n in (32, 64, 96))
    rng = np.random.Generator(np.random.PCG64(1))
    left = rng.integers(0, 2 ** 32, (4000, 128), dtype=np.uint32)
    right = np.where(rng.random((4000, 128)) < 0.75, left, left + 1)
    assert len(survivors(left, right)) == 4000                        # at the threshold none is lost
    right = np.where(rng.random((4000, 128)) < 0.4, left, left + 1)
    assert len(survivors(left, right)) == 0


def test_components_of_chains_and_stars(spark):
    rnd = random.Random(4)
    links = [(i, i + 1) for i in range(60)] + [(500, 501 + i) for i in range(40)] + [(1000 + rnd.randrange(50), 1000 + rnd.randrange(50)) for _ in range(45)]
    rnd.shuffle(links)
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = groups({i for x in links for i in x}, links)
    assert got == {i: c for i, c in want.items() if i in got} and all(i in got for a, b in links if a != b for i in (a, b))
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- embeddings ---------------------------------------------------------------------------------------
def brute_force_vectors(rows, cosine=0.9):
    good = {}
    for k, (_, v) in enumerate(rows):
        x = np.asarray([np.nan if c is None else c for c in v] if v else [], float)
        if len(x) and np.isfinite(x).all() and (x != 0).any():
            good[k] = x / np.abs(x).max() / np.linalg.norm(x / np.abs(x).max())
    links = [(a, b) for a in good for b in good if a < b and len(good[a]) == len(good[b]) and good[a] @ good[b] >= cosine]
    top = groups(range(len(rows)), links)
    n = [0] * len(rows)
    for a, b in links:
        n[a] += 1
        n[b] += 1
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[top[k]] = min(i, least.get(top[k], i))
    return sorted((str(i), n[k], str(least.get(top[k]))) for k, (i, _) in enumerate(rows))


@pytest.mark.parametrize("block", [2048, 16])
def test_links_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr("llm.rotation_codes.BLOCK", block)
    rng = np.random.Generator(np.random.PCG64(9))
    vectors = []
    for size, noise in ((80, 0.02), (30, 0.05), (1, 0), (60, 0.08)):
        base = rng.standard_normal(48)
        vectors += [base + noise * rng.standard_normal(48) for _ in range(size)]
    vectors += [rng.standard_normal(48) for _ in range(150)] + [vectors[3]] * 5 + [2.5 * vectors[90]] * 2
    rows = [(k, [float(c) for c in v]) for k, v in enumerate(vectors)]
    rng.shuffle(rows)
    rows += [(1000, None), (1001, []), (1002, [0.0] * 48), (1003, [float("nan")] * 48), (1004, [None] * 48), (1005, [float("inf")] * 48),
             (1006, [1.0, 2.0]), (1007, [2.0, 4.0]), (None, rows[0][1]), (3, rows[5][1]), (1008, [1e308] * 3), (1009, [1e-308] * 3), (1010, [5.0])]
    rows = [(i if i is None else int(i), None if v is None else [None if c is None else float(c) for c in v]) for i, v in rows]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, node string, links int")
    out = near_embeddings(df).collect()
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in out) == brute_force_vectors(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in out if r.vec_id is not None)


def test_recall_near_the_threshold_and_empty_tables(spark):
    """Pairs at a cosine of 0.9 to 0.92 meet in some band, and their bounds do not rule them out."""
    rng = np.random.Generator(np.random.PCG64(5))
    rows = []
    for k in range(400):
        x, y = rng.standard_normal((2, 64))
        x /= np.linalg.norm(x)
        y -= (y @ x) * x
        y /= np.linalg.norm(y)
        c = rng.uniform(0.9001, 0.92)
        rows += [(2 * k, x.tolist()), (2 * k + 1, (c * x + (1 - c * c) ** 0.5 * y).tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = near_embeddings(df).filter("n_links >= 1").count()
    assert found >= 2 * 392
    assert near_embeddings(empty_like(df)).count() == 0


def test_estimates_are_unbiased_and_bounds_hold():
    rng = np.random.Generator(np.random.PCG64(2))
    x = rng.standard_normal((600, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    codes = Codes.of(x)
    names = ["dim", "code", "planes", "factor", "low", "step"]
    stored = Codes.read(pd.DataFrame({n: c.to_pylist() for n, c in zip(names, codes.columns())}))
    a, b = np.triu_indices(600, 1)
    assert (stored.upper(a, b) == codes.upper(a, b)).all()            # codes read back are the codes
    exact = np.einsum("ij,ij->i", x[a], x[b])
    upper = codes.upper(a, b)
    assert (upper >= exact).mean() > 0.9999
    assert band_plan(10 ** 6)[0] == 24 and band_plan(1)[0] >= 4


def test_columns_of_the_input_do_not_clash(spark):
    df = spark.range(3).select(F.col("id").alias("doc_id"), F.lit("a b c d e f").alias("text"), F.lit(1).alias("bucket"), F.lit(2).alias("size"))
    assert {(r.doc_id, r.component_id) for r in near_duplicates(df).collect()} == {(0, 0), (1, 0), (2, 0)}
