import random

from pyspark.sql import functions as F

from llm.best_fit import best_fit, pack, pack_documents, token_pieces
from llm.wordbpe import WordEncoder
from tests.llm.helpers import WORD_BPE, awkward_documents, empty_like


def check_sequences(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_best_fit_takes_the_fullest_bin_with_room():
    rnd = random.Random(5)
    sizes = [rnd.randint(1, 100) for _ in range(400)]
    bins, offsets = best_fit(sizes, 100)
    used = []
    for size, b, offset in zip(sizes, bins, offsets):
        open_ = [k for k, u in enumerate(used) if u + size <= 100]
        if open_:
            assert used[b] == max(used[k] for k in open_)
        else:
            assert b == len(used)
            used.append(0)
        assert offset == used[b]
        used[b] += size


def test_rounds_up_the_tree_pack_nearly_as_well_as_one_group(spark):
    rnd = random.Random(2)
    sizes = [rnd.choice([1, 7, 40, 333, 900, 1500, 2300, 4000]) + rnd.randint(0, 90) for _ in range(3000)]
    pieces = spark.createDataFrame([(i, 0, 0, min(s, 4096), i) for i, s in enumerate(sizes)],
                                   "doc_id long, piece int, start long, length long, ids_crc32 long")
    rows = pack(pieces, group_items=60, fan_in=4).collect()
    assert sorted(r.doc_id for r in rows) == list(range(3000))
    one = check_sequences(pack(pieces).collect(), 4096)
    assert one <= check_sequences(rows, 4096) <= 1.02 * one


def test_items_that_never_combine_end_the_rounds(spark):
    pieces = spark.range(500).select(F.col("id").alias("doc_id"), F.lit(0).alias("piece"), F.lit(0).cast("long").alias("start"),
                                     F.lit(2049).cast("long").alias("length"), F.col("id").alias("ids_crc32"))
    rows = pack(pieces, group_items=20).collect()
    assert check_sequences(rows, 4096) == 500


def test_awkward_documents_are_cut_and_packed(spark):
    docs = awkward_documents(spark)
    rows = pack_documents(docs, WORD_BPE, capacity=512).collect()
    check_sequences(rows, 512)
    enc = WordEncoder(WORD_BPE)
    want = sorted((str(r.doc_id), len(enc.whole(r.text or "")) // 4 + 1) for r in docs.collect())
    total = {}
    for r in rows:
        assert r.start == 512 * r.piece and 0 < r.length <= 512
        if r.piece == 0:
            total.setdefault(str(r.doc_id), []).append(0)
    assert sum(r.length for r in rows) == sum(n for _, n in want)
    assert sum(map(len, total.values())) == len(want)
    none = empty_like(docs)
    assert token_pieces(none, WORD_BPE).count() == 0 and pack_documents(none, WORD_BPE).count() == 0
