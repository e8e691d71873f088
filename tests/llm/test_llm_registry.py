"""Every registered query on the smallest tables: against its SQL, or against a brute-force version; and the pipeline against its
operators put together by hand."""

import zlib
from hashlib import sha256

import duckdb
import numpy as np
import pytest

import corpus_pipeline
import public_tokenizers
from __spark_entry__ import oracle_sql, queries
from llm import boosted
from llm.best_fit import token_pieces
from llm.boosted import feature_matrix, fit
from llm.queries import ORACLE, QUERIES, table
from llm.wordbpe import WordEncoder
from tests.llm.helpers import BYTE_BPE, SF, WORD_BPE, brute_force_duplicates
from tools.oracle_check import FAMILY, TABLES, rows_of


def test_names():
    assert [f"op{n}_" for n in range(1, 14)] == [q[:q.index("_") + 1] for q in QUERIES]
    assert set(QUERIES) | {"pipeline"} <= set(queries()) and set(ORACLE) <= set(oracle_sql())
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "quality_classifier", "minhash_near_dedup", "best_fit_packing"]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    duck = duckdb.connect()
    for t in TABLES:
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    result = duck.execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(columns, result.fetchall())
    kinds = dict(df.dtypes)
    assert {c: FAMILY.get(k) for c, k in kinds.items()} == {d[0]: FAMILY.get(str(d[1]), FAMILY.get(kinds[d[0]])) for d in result.description}


def test_token_queries(spark):
    docs = sorted((r.doc_id, r.text or "") for r in table(spark, SF, "documents").collect())
    enc, start, want, pieces = WordEncoder(WORD_BPE), 0, [], []
    for doc_id, text in docs:
        ids = enc.whole(text) + b"\1\0\0\0"
        want.append((doc_id, start, len(ids) // 4, zlib.crc32(ids)))
        start += len(ids) // 4
        pieces += [(doc_id, p, a // 4, len(ids[a:a + 16384]) // 4, zlib.crc32(ids[a:a + 16384])) for p, a in enumerate(range(0, len(ids), 16384))]
    assert sorted(map(tuple, QUERIES["op1_token_files"](spark, SF).collect())) == want
    packed = QUERIES["op7_best_fit"](spark, SF).collect()
    assert sorted(tuple(r)[:5] for r in packed) == sorted(pieces)
    assert len({r.sequence_id for r in packed}) <= -(-start // 4096) + 2


def test_byte_tokens_equal_the_library(spark):
    import tiktoken
    from llm.rank_bpe import encoder

    ranks = encoder(BYTE_BPE, public_tokenizers.PATTERN).ranks
    ref = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for r in table(spark, SF, "documents").collect():
        ids = np.asarray(ref.encode_ordinary(r.text or ""), "<u4")
        want.append((r.doc_id, len(ids), sha256(ids.tobytes()).hexdigest(), sha256((r.text or "").encode()).hexdigest()))
    assert sorted(map(tuple, QUERIES["op2_rank_bpe"](spark, SF).collect())) == sorted(want)


def test_scores_equal_walking_each_tree(spark):
    docs = table(spark, SF, "documents")
    forest = fit(docs, table(spark, SF, "labels"))
    got = {r.doc_id: r for r in QUERIES["op9_boosted_quality"](spark, SF).collect()}
    rows = docs.collect()
    assert len(got) == len(rows)
    for r in rows:
        x, raw = feature_matrix([r.text])[0], forest.base
        for feature, cut, value in zip(forest.feature, forest.cut, forest.value):
            node = 0
            while node < len(feature):
                node = 2 * node + 1 + int(x[feature[node]] > cut[node])
            raw += value[node - len(feature)]
        score = 1 / (1 + np.exp(-raw))
        assert abs(got[r.doc_id].score - score) < 1e-9 and got[r.doc_id].predicted == int(score >= 0.3)
        assert got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)


def test_a_hot_id_trains_with_one_row(spark):
    docs, labels = table(spark, SF, "documents").select("doc_id", "text"), table(spark, SF, "labels")
    first = labels.orderBy("doc_id").first().doc_id
    more = docs.limit(150).selectExpr(f"cast({first} as bigint) as doc_id", "text")
    sent = []
    real = boosted.train
    boosted.train = lambda x, y, **how: sent.append(len(y)) or real(x, y, **how)
    try:
        fit(docs.unionByName(more), labels)
        fit(docs, labels)
    finally:
        boosted.train = real
    assert sent[0] == sent[1]


def test_pipeline_equals_its_parts(spark):
    docs = {r.doc_id: r for r in table(spark, SF, "documents").collect()}
    kept = {r.doc_id for r in QUERIES["op10_adaptive_rules"](spark, SF).filter("kept").collect()}
    forest = fit(table(spark, SF, "documents"), table(spark, SF, "labels"))
    good = sorted(i for i in kept if forest.score(feature_matrix([docs[i].text]))[0] >= 0.3)
    groups = brute_force_duplicates({i: docs[i].text for i in good})
    left = [i for i in good if groups[i][1] == i]
    want = token_pieces(table(spark, SF, "documents").filter(f"doc_id in ({', '.join(map(str, left))})"), WORD_BPE)
    out = corpus_pipeline.run(spark, SF).collect()
    assert sorted(tuple(r)[:5] for r in out) == sorted(map(tuple, want.collect()))
    stages = table(spark, SF, "documents")
    for name, stage in corpus_pipeline.STAGES[:3]:
        before, stages = stages.columns, stage(spark, stages, SF)
        assert stages.columns == before, name
    assert sorted(r.doc_id for r in stages.collect()) == left
    assert np.unique([r.sequence_id for r in out]).size >= 1
