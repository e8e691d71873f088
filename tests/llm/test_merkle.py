"""Operator 13 against trees built in plain Python."""

import random
import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from llm import merkle
from llm.merkle import build, document_leaves, fold, manifest_proofs, ranked
from llm.queries import QUERIES
from tests.llm.helpers import SF, awkward_documents, empty_like


def digest(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(*fields):
    return digest(*("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest(*out[-1][i:i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def way(tree, i):
    steps = []
    for nodes in tree[:-1]:
        steps.append((i % 2, nodes[i // 2 * 2:i // 2 * 2 + 2]))
        i //= 2
    return steps


def proofs(rows):
    """``(id, leaf, subroot, root, proof digest, folded root, verified)`` of ``(id, text, lang, source, n_chars)`` rows."""
    by = {}
    for i, text, lang, source, n in rows:
        more = n is not None and i is not None and zlib.crc32(str(i).encode()) % 7 == 0
        by.setdefault(lang, []).append((i, leaf(i, source, lang, n, text), leaf(i, source, lang, n + 1 if more else n, text)))
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    for x in by.values():
        x.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    trees = {x: levels([r[1] for r in by[x]]) for x in langs}
    top, out = levels([trees[x][-1][0] for x in langs]) if langs else [], []
    for k, lang in enumerate(langs):
        for i, (key, own, seen) in enumerate(by[lang]):
            steps = way(trees[lang], i) + way(top, k)
            for side, nodes in steps:
                seen = digest(*(seen if j == side else x for j, x in enumerate(nodes)))
            siblings = "".join(nodes[1 - side] for side, nodes in steps if len(nodes) > 1)
            out.append((key, own, trees[lang][-1][0], top[-1][0], digest(siblings), seen, seen == top[-1][0]))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def proved(docs, bits):
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    out = manifest_proofs(document_leaves(docs, tampered), bits)
    sibling = F.array_join(F.transform("proof", lambda step: step["digest"]), "")
    return out.select("doc_id", "leaf", "subroot", "root", F.sha2(sibling, 256), "folded_root", "verified")


@pytest.mark.parametrize("bits", [1, 3, 8])
def test_trees_of_any_size(spark, monkeypatch, bits):
    """Nulls, equal ids, repeated rows, languages of one leaf, in segments of any height; one language has a third of the rows."""
    monkeypatch.setattr(merkle, "RANGE_ROWS", 60)
    rnd = random.Random(bits)
    rows = [(rnd.choice([None, *range(150)]), rnd.choice([None, "", "é", "abc"]), rnd.choice([None, "", "a", "b", "b", "b", "é", *[f"l{i}" for i in range(9)]]),
             rnd.choice([None, "s"]), rnd.choice([None, 1, 2])) for _ in range(260)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    assert rows_of(proved(docs, bits)) == proofs(rows)


def test_one_row_and_awkward_tables(spark):
    shape = "doc_id long, text string, lang string, source string, n_chars long"
    one = [(7, "x", None, None, 1)]
    assert rows_of(proved(spark.createDataFrame(one, shape), 8)) == proofs(one)
    docs = awkward_documents(spark).withColumn("n_chars", F.length("text").cast("long"))
    for name in ("tree", "leaf", "seen", "rank", "size", "place", "digest", "path", "levels"):
        docs = docs.withColumn(name, F.lit("own"))
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    assert rows_of(proved(docs, 8)) == proofs(rows)
    assert proved(empty_like(docs), 8).count() == 0


def test_query_and_the_stored_records(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    got = QUERIES["op13_merkle_descent"](spark, SF)
    assert rows_of(got) == proofs(rows)
    assert 0 < got.filter("not verified").count() < got.count()

    leaves = ranked(document_leaves(docs))
    segments = build(leaves.select("tree", F.col("rank").alias("place"), F.col("leaf").alias("digest"), "size"), 2)
    assert len(segments) >= 2
    for s in segments:
        for r in s.select(F.explode("records").alias("r")).select("r.*").collect():
            assert r.digest == digest(*r.children) and 1 <= len(r.children) <= 2


def test_fold_tells_sides_apart():
    a, b = digest("a"), digest("b")
    assert fold(a, [{"side": 1, "digest": b}]) == digest(a, b) and fold(a, [{"side": 0, "digest": b}]) == digest(b, a)
    assert fold(a, [{"side": -1, "digest": ""}]) == digest(a) and fold(a, []) == a
