import random
import zlib
from pathlib import Path

import numpy as np
import pyarrow.parquet as pq
import pytest
import tiktoken
from pyspark.sql import functions as F

import public_tokenizers
from llm.rank_bpe import RankQueue, decode_ids, encode_texts, encoder as byte_encoder, merge, merge_all, round_trip
from llm.token_files import read_ids, read_places, token_digests, write_tokens
from llm.wordbpe import WordEncoder
from tests.llm.helpers import BYTE_BPE, LONG, ODD, WORD_BPE, awkward_documents, empty_like


@pytest.fixture(scope="module")
def words():
    return WordEncoder(WORD_BPE)


def test_remembered_chunks_give_the_library_ids(words):
    rnd = random.Random(3)
    alphabet = "abcXYZ'éß \n\t,.0<|日́\U0001f642"
    texts = ODD + [a + b for a in ODD for b in ODD] + ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 80))) for _ in range(1500)]
    assert [t for t, ids in zip(texts, words.encode(texts)) if ids != words.whole(t)] == []
    assert words.encode([None, ""]) == [b"", b""]


def test_full_memories_are_thinned_and_stay_right(words, monkeypatch):
    monkeypatch.setattr("llm.wordbpe.KEEP_UNITS", 40)
    enc = WordEncoder(WORD_BPE)
    for k in range(20):
        texts = [f"alpha beta{k} gamma{i} delta, {'y' * 60}{k}" for i in range(10)]
        assert enc.encode(texts) == [enc.whole(t) for t in texts]
        assert len(enc.known) <= 40 and max(map(len, enc.known)) <= 48


def test_random_texts_in_one_column_give_the_library_ids(words):
    """Texts lie side by side in a column: none may be cut or joined by its neighbours."""
    rnd = random.Random(8)
    parts = [*"aAbZz09 '\n\t.,;!?-<|>imé\u00c9ßÖ×÷ÿÀø", "'s", "'re", "<|im_end|>", "<|", "\u0301", "中文", "\xa0", "\x00", "\U0001f642", "\r", "ı", "İ", "\u212a", "don't"]
    texts = ["".join(rnd.choices(parts, k=rnd.randrange(0, 14))) for _ in range(6000)]
    assert [t for t, ids in zip(texts, words.encode(texts)) if ids != words.whole(t)] == []


def expected_rows(words, rows):
    start, out = 0, []
    for doc_id, text in rows:
        ids = words.whole(text or "") + (1).to_bytes(4, "little")
        out.append((doc_id, start, len(ids) // 4, zlib.crc32(ids)))
        start += len(ids) // 4
    return out


def test_token_files_hold_every_document_in_order(spark, scratch, words):
    docs = awkward_documents(spark)
    write_tokens(docs, f"{scratch}/t", WORD_BPE, docs_per_part=3)
    got = [tuple(r) for r in token_digests(spark, f"{scratch}/t").collect()]
    order = sorted(got, key=lambda r: r[1])
    assert [r[0] for r in order] == sorted([r.doc_id for r in docs.collect()], key=lambda i: (i is not None, i or 0))
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id not in (5, None)}
    digest = {d: (n, c) for d, _, n, c in expected_rows(words, texts.items())}
    assert all((n, c) == digest[d] for d, _, n, c in got if d in digest)
    assert all(a[1] + a[2] == b[1] for a, b in zip(order, order[1:])) and order[0][1] == 0
    empty = empty_like(docs)
    write_tokens(empty, f"{scratch}/none", WORD_BPE)
    assert token_digests(spark, f"{scratch}/none").count() == 0


def test_token_files_are_indexed_and_read_in_part(spark, scratch, words):
    docs = spark.range(4000).select((F.col("id") * 2).alias("doc_id"), F.concat(F.lit("some words "), F.col("id").cast("string")).alias("text"))
    path = f"{scratch}/t"
    write_tokens(docs, path, WORD_BPE, docs_per_part=1000)
    files = sorted(Path(path, "ids").glob("part-*.parquet"))
    last = -1
    for f in files:
        meta = pq.ParquetFile(f)
        ids = meta.read(columns=["doc_id"])["doc_id"].to_pylist()
        assert ids == sorted(ids) and ids[0] > last                    # ascending within and over the files
        last = ids[-1]
        columns = [meta.metadata.row_group(0).column(i) for i in range(meta.metadata.num_columns)]
        by_name = {c.path_in_schema: c for c in columns}
        assert all(c.has_offset_index and c.has_column_index for c in columns)
        assert any("DICTIONARY" in e for e in by_name["ids.list.element"].encodings)
        assert "DELTA_BINARY_PACKED" in by_name["doc_id"].encodings
    some = read_places(spark, path, ["ids"], first=100, last=139)
    assert "PushedFilters: [IsNotNull(doc_id), GreaterThanOrEqual(doc_id,100)" in some._jdf.queryExecution().toString()
    got = {r.doc_id: r for r in some.collect()}
    assert sorted(got) == list(range(100, 140, 2))
    assert np.asarray(got[100].ids, "<u4").tobytes() == words.whole("some words 50") + b"\1\0\0\0"
    narrow = read_ids(spark, path).select("doc_id", "n_tokens")
    assert "ReadSchema: struct<doc_id:bigint,n_tokens:bigint>" in narrow._jdf.queryExecution().toString()


# --- byte-level BPE ---------------------------------------------------------------------------------
@pytest.fixture(scope="module")
def bytes_and_reference():
    enc = byte_encoder(BYTE_BPE, public_tokenizers.PATTERN)
    return enc, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=enc.ranks, special_tokens={})


def test_rank_queue_ids_equal_the_library(bytes_and_reference):
    enc, ref = bytes_and_reference
    rnd = random.Random(1)
    texts = ODD + [LONG, "ab" * 4000, "a" * 5000, " " * 700 + "\n" * 90, "½ Ⅷ ٣ ​"]
    texts += ["".join(rnd.choice("abcdeth er\n'sé日\U0001f6420 \x1c\u0085") for _ in range(rnd.randint(1, 300))) for _ in range(1500)]
    texts += ["".join(rnd.choice("ab") for _ in range(rnd.randint(1, 500))) for _ in range(300)]
    want = [np.asarray(ref.encode_ordinary(t), "<u4").tobytes() for t in texts]
    assert [t for t, w in zip(texts, want) if enc.encode(t) != w] == []
    assert all(enc.decode(w) == t.encode() for t, w in zip(texts, want))


def test_merge_order_with_any_ranks():
    """Ranks in an order that no training gives: new pairs may go before the one that made them."""
    rnd = random.Random(7)
    for _ in range(300):
        tokens = {bytes([c]) for c in b"abc"}
        while len(tokens) < 14:
            tokens.add(b"".join(rnd.sample(sorted(tokens), 2)))
        names = sorted(tokens)
        rnd.shuffle(names)
        ranks = {t: r for r, t in enumerate(names)}
        piece = bytes(rnd.choice(b"abc") for _ in range(rnd.randint(1, 40)))
        runs = [piece[i:i + 1] for i in range(len(piece))]
        while piece not in ranks:
            pairs = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(runs, runs[1:])) if a + b in ranks]
            if not pairs:
                break
            _, i = min(pairs)
            runs[i:i + 2] = [runs[i] + runs[i + 1]]
        else:
            runs = [piece]
        queue = RankQueue(64)
        alone = merge(piece, ranks, queue)
        assert alone == [ranks[r] for r in runs]
        assert not queue.buckets and not any(queue.low) and not any(queue.mid)
        others = [bytes(rnd.choice(b"abc") for _ in range(rnd.randint(1, 12))) for _ in range(20)]
        beside = merge_all([*others, piece, *others], ranks, queue)
        assert beside == [*(merge(o, ranks, RankQueue(64)) for o in others), alone, *(merge(o, ranks, RankQueue(64)) for o in others)]


def test_round_trip_of_awkward_rows(spark, bytes_and_reference):
    import hashlib

    _, ref = bytes_and_reference
    docs = awkward_documents(spark)
    got = sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in round_trip(docs, BYTE_BPE, public_tokenizers.PATTERN).collect())
    want = []
    for r in docs.select("doc_id", "text").collect():
        ids = np.asarray(ref.encode_ordinary(r.text or ""), "<u4")
        want.append((str(r.doc_id), len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()))
    assert got == sorted(want)
    encoded = encode_texts(empty_like(docs), BYTE_BPE, public_tokenizers.PATTERN)
    assert decode_ids(encoded, BYTE_BPE, public_tokenizers.PATTERN).count() == 0
