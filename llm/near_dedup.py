"""Operator 4: near-duplicates by MinHash banding, sequential Bayesian pruning and exact checks.

A document is the set of its distinct five-word shingles; two are linked if ``100 * shared >= 75 * all``.

1. One pass over the texts gives each document its set's size and key and 32 band keys of 4 hashes each.  Equal
   sets are one class, a node with a number of its own, read from the rows of its smallest id; a pair at the threshold
   shares a band but for 5 in a million.
2. Buckets of two classes or more name the candidates; only these are read again, for whole signatures and sets.
3. In each bucket every class is compared with the bucket's hub (the class that meets most others), not with all.
   A pair's signatures are compared 32 hashes at a time, and the pair is dropped as soon as the posterior
   probability of a similarity of 0.75 (uniform prior) is under ``MISS``.  What is left is checked on the full sets.
4. Links so far make components.  What could still be missed are pairs of one bucket in different components.
   Buckets of up to ``SMALL`` rows list those pairs; larger ones compare them inside a task, vectorised, with
   the same pruning and exact check, in blocks of bounded size (pairs of blocks, if a bucket needs several).
5. Components over all links.

No pairs of a group are listed that their hub settles, texts are never collected, and every step that others start
from is a table in the shared folder.

Defined cases: a null text, or one without words, has an empty set and no link; fewer than five words are one
shingle; repeated rows are one document; rows that share an id but not a set are judged by their own texts, so
none goes without a copy that stays; rows with a null id are linked with nothing and kept; an empty table gives no rows; other columns are not read, and ``dedup_filter`` keeps them.
"""

from __future__ import annotations

from functools import lru_cache
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from llm.components import components
from llm.shared import bounded_batches, stored, text_of
from llm.shingles import BANDS, HASHES, ROWS, set_key, shingle_set, signature

SHARED, ALL = 75, 100          # link if ALL * shared >= SHARED * union
MISS = 1e-6                    # a pair this unlikely to be linked is dropped
BATCH = 32                     # hashes compared at a time
SMALL = 8                      # rows of a bucket whose open pairs are listed
BLOCK_ROWS, BLOCK_SHINGLES = 2000, 2_000_000    # of one block of a large bucket
BROADCAST_DROPPED = 4_000_000  # ids left out that are broadcast (about 100 MB); more are joined by shuffle
BROADCAST_IDS = 500_000        # candidates that are broadcast (about 70 bytes each); more are joined by shuffle

_rng = np.random.Generator(np.random.PCG64(75))
_MIX = _rng.integers(0, 1 << 63, (2, BANDS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SEED = _rng.integers(0, 1 << 63, BANDS, dtype=np.uint64)


@lru_cache(maxsize=None)
def least_matches(n: int, miss: float = MISS) -> int:
    """Fewest matches of ``n`` hashes that keep a pair.  With a uniform prior the similarity's posterior is
    Beta(m + 1, n - m + 1), whose mass from t up is the chance of at most m successes in n + 1 draws at t."""
    t = SHARED / ALL
    mass, m = (1 - t) ** (n + 1), 0
    while mass < miss:
        m += 1
        mass += comb(n + 1, m) * t ** m * (1 - t) ** (n + 1 - m)
    return m


def survivors(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which rows of two signature arrays still may be linked, a batch of hashes at a time."""
    alive = np.arange(len(left))
    same = np.zeros(len(left), np.int64)
    for at in range(0, HASHES, BATCH):
        same[alive] += (left[alive, at:at + BATCH] == right[alive, at:at + BATCH]).sum(axis=1)
        alive = alive[same[alive] >= least_matches(at + BATCH)]
        if not len(alive):
            break
    return alive


def linked(shared, a, b):
    return ALL * shared >= SHARED * (a + b - shared)


# --- one pass over the texts -------------------------------------------------------------------
def _digest(batches):
    for batch in batches:
        sets = [shingle_set(t) for t in batch.column(1).to_pylist()]
        sigs = np.frombuffer(b"".join(map(signature, sets)), "<u8").reshape(len(sets), BANDS, ROWS // 2)
        bands = (sigs[:, :, 0] ^ _SEED) * _MIX[0]
        bands = (bands ^ (bands >> np.uint64(29))) + sigs[:, :, 1] * _MIX[1]
        bands = ((bands ^ (bands >> np.uint64(32))) * _MIX[0]).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([len(s) for s in sets], pa.int64()),
             pa.array([set_key(s) if len(s) else None for s in sets], pa.binary()),
             pa.ListArray.from_arrays(pa.array(np.arange(0, bands.size + 1, BANDS, dtype=np.int32)), pa.array(bands.ravel()))],
            names=["id", "n", "set_key", "bands"])


def _sets(batches):
    """Signature and set of each node, from rows of its smallest id: those that hold its set, and of a task the first."""
    seen = set()
    for batch in batches:
        rows = []
        for text, node, key in zip(*(batch.column(i).to_pylist() for i in range(3))):
            found = None if node in seen else shingle_set(text)
            if found is not None and set_key(found) == key:
                seen.add(node)
                rows.append((node, len(found), signature(found), found.tobytes()))
        cols = list(zip(*rows)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.binary()),
                                          pa.array(cols[3], pa.binary())], names=["id", "n", "sig", "shingles"])


# --- pairs --------------------------------------------------------------------------------------
def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u4").reshape(-1, HASHES)


def _prune(batches):
    for batch in batches:
        if batch.num_rows:
            alive = survivors(_matrix(batch.column(2)), _matrix(batch.column(3)))
            yield batch.select([0, 1]).take(pa.array(alive))


def _exact(batches):
    for batch in batches:
        keep = []
        for i, (x, y) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())):
            x, y = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
            both = np.concatenate([x, y])
            both.sort()
            if linked(int((both[1:] == both[:-1]).sum()), len(x), len(y)):
                keep.append(i)
        yield batch.select([0, 1]).take(pa.array(keep, pa.int64()))


def verified(pairs: DataFrame, cands: DataFrame, name: str) -> DataFrame:
    """The linked ones of ``pairs`` (``a, b``): sizes first, then signatures, then the full sets."""
    def with_both(rows, column):
        x = cands.select(F.col("id").alias("a"), F.col(column).alias("x"))
        y = cands.select(F.col("id").alias("b"), F.col(column).alias("y"))
        return rows.join(x, "a").join(y, "b").select("a", "b", "x", "y")

    alive = stored(with_both(pairs, "sig").mapInArrow(_prune, "a long, b long").distinct(), f"{name}-alive")
    return stored(with_both(alive, "shingles").mapInArrow(_exact, "a long, b long").distinct(), f"{name}-links")


def _open_block(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Links between different components of one bucket's pair of blocks.  Components that a link joins
    need no further link, so at most one link a pair of components is returned."""
    i, j = int(key[1]), int(key[2])
    rows = rows.sort_values(["component", "id"], ignore_index=True)
    sig = np.frombuffer(b"".join(rows["sig"]), "<u4").reshape(-1, HASHES)
    n, comp, block = rows["n"].to_numpy(), rows["component"].to_numpy(), rows["block"].to_numpy()
    sets = [np.frombuffer(x, "<u8") for x in rows["shingles"]]
    _, flat = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    mark = np.zeros(int(flat.max()) + 1, bool)
    group = {c: c for c in comp.tolist()}

    def top(c):
        while group[c] != c:
            group[c] = c = group[group[c]]
        return c

    _, sizes = np.unique(comp, return_counts=True)
    of = np.repeat(sizes, sizes)                       # rows are sorted by component
    found = []
    for r in np.argsort(of, kind="stable").tolist():   # the rare components' rows look for partners among the rest
        mine = comp[r]
        others = np.flatnonzero((comp != mine) & ((of > of[r]) | ((of == of[r]) & (comp > mine)))
                                & (ALL * np.minimum(n, n[r]) >= SHARED * np.maximum(n, n[r])))
        if i != j:
            others = others[block[others] != block[r]]
        if not len(others):
            continue
        others = others[survivors(np.broadcast_to(sig[r], (len(others), HASHES)), sig[others])]
        if not len(others):
            continue
        mark[flat[starts[r]:starts[r + 1]]] = True
        for o in others.tolist():
            if top(comp[o]) != top(mine):
                shared = int(mark[flat[starts[o]:starts[o + 1]]].sum())
                if linked(shared, n[r], n[o]):
                    found.append((rows["id"][r], rows["id"][o]))
                    group[top(comp[o])] = top(mine)
        mark[flat[starts[r]:starts[r + 1]]] = False
    return pd.DataFrame(found, columns=["a", "b"], dtype="int64")


def _ordered(a, b):
    return F.least(a, b).alias("a"), F.greatest(a, b).alias("b")


def near_duplicate_links(docs: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(members, classes, links)``: ``id, n, set_key, node, class_id`` of each row; ``node, class_id`` of each different set; and
    links between nodes that settle the components."""
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = text_of(docs, key, text)
    digests = stored(rows.mapInArrow(_digest, "id long, n long, set_key binary, bands array<long>"), "digests")
    classes = stored(digests.filter("set_key is not null and id is not null").groupBy("set_key")
                     .agg(F.min("id").alias("class_id"), F.first("n").alias("n"), F.first("bands").alias("bands"))
                     .withColumn("node", F.monotonically_increasing_id()), "classes")
    members = digests.select("id", "n", "set_key").join(classes.select("set_key", "class_id", "node"), "set_key", "left")
    # a row without an id is linked with nothing, whatever other rows hold its set
    members = members.select("id", "n", "set_key", *[F.when(F.col("id").isNotNull(), F.col(c)).alias(c) for c in ("node", "class_id")])

    # buckets that two classes or more share
    each = classes.select(F.col("node").alias("id"), "n", F.explode("bands").alias("bucket")).distinct()
    w = Window.partitionBy("bucket")
    buckets = stored(each.withColumn("size", F.count(F.lit(1)).over(w)).withColumn("weight", F.sum("n").over(w))
                     .filter("size > 1"), "buckets")
    ids = stored(buckets.groupBy("id").agg(F.sum("size").alias("meets")), "candidates")
    few = ids.count() <= BROADCAST_IDS
    only = ids.select("id").join(classes.select(F.col("node").alias("id"), "class_id", "set_key"), "id")
    cands = stored(rows.join(F.broadcast(only) if few else only, F.col("_id") == F.col("class_id")).select("_text", "id", "set_key")
                   .mapInArrow(_sets, "id long, n long, sig binary, shingles binary").dropDuplicates(["id"]), "sets")

    # each class and its bucket's hub
    hubs = (buckets.join(ids, "id").groupBy("bucket").agg(F.max(F.struct("meets", -F.col("id"), "n")).alias("h"))
            .select("bucket", (-F.col("h.col2")).alias("hub"), F.col("h.n").alias("hub_n")))
    fits = lambda x, y: ALL * F.least(x, y) >= SHARED * F.greatest(x, y)
    star = (buckets.join(hubs, "bucket").filter(F.col("id") != F.col("hub")).filter(fits(F.col("n"), F.col("hub_n")))
            .select(*_ordered("id", "hub")).distinct())
    first = verified(star, cands, "star")

    # pairs of one bucket in different components
    label = components(first).withColumnRenamed("id", "_i")
    placed = (buckets.join(label, buckets["id"] == label["_i"], "left")
              .select("bucket", "id", "n", "size", "weight", F.coalesce("component", "id").alias("component")))
    ends = placed.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    open_rows = stored(placed.join(ends.filter("lo <> hi").select("bucket"), "bucket"), "open")
    small = open_rows.filter(F.col("size") <= SMALL)
    x = small.select("bucket", F.col("id").alias("a"), F.col("n").alias("na"), F.col("component").alias("ca"))
    y = small.select("bucket", F.col("id").alias("b"), F.col("n").alias("nb"), F.col("component").alias("cb"))
    listed = (x.join(y, "bucket").filter("a < b and ca <> cb").filter(fits(F.col("na"), F.col("nb"))).select("a", "b").distinct())
    second = verified(listed, cands, "open")

    blocks = F.greatest(F.ceil(F.col("size") / BLOCK_ROWS), F.ceil(F.col("weight") / BLOCK_SHINGLES)).cast("int")
    large = (open_rows.filter(F.col("size") > SMALL).withColumn("blocks", blocks)
             .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
             .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("bucket", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"), "block", "id", "component"))
    third = stored(large.join(cands, "id").groupBy("bucket", "i", "j")
                   .applyInPandas(_open_block, "a long, b long").distinct(), "block-links")
    return members, classes.select("node", "class_id"), first.union(second).union(third)


def _labelled(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``members`` with ``component_id``, the smallest id of the component, and ``head``: whether the row's set and id are its
    component's one to keep (null for rows that are linked with nothing)."""
    members, classes, links = near_duplicate_links(docs, key, text)
    label = components(links)
    nodes = label.join(classes, label["id"] == classes["node"]).select("node", "class_id", "component")
    heads = nodes.groupBy("component").agg(F.min(F.struct("class_id", "node")).alias("first"))
    nodes = nodes.join(heads, "component").select(F.col("node").alias("_node"), F.col("first.class_id").alias("least"), F.col("first.node").alias("kept"))
    head = (F.col("node") == F.coalesce("kept", "node")) & (F.col("id") == F.col("class_id"))
    return members.join(nodes, F.col("node") == F.col("_node"), "left").select(
        "id", "n", "set_key", F.coalesce("least", "class_id", "id").alias("component_id"), head.alias("head"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_shingles, component_id, kept`` of every row."""
    out = _labelled(docs, key, text).select(F.col("id").alias(key), F.col("n").alias("n_shingles"), "component_id")
    return out.withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(True)))


def dedup_filter(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each component, with all its columns.  The ids to leave out are broadcast to one scan of the
    documents, up to ``BROADCAST_DROPPED`` (counted); more are joined by shuffle.  Only ids that occur in several rows
    have their rows shuffled whole: they are judged row by row, and of rows with one id and set the first in the order
    of the text stays."""
    rows = stored(_labelled(docs, key, text).filter("id is not null").select("id", "set_key", F.coalesce("head", F.lit(True)).alias("stays")), "judged")
    aside = stored(rows.groupBy(F.col("id").alias("_id")).agg(F.max("stays").alias("_kept"), (F.count(F.lit(1)) > 1).alias("_again"))
                   .filter("not _kept or _again"), "aside")
    few = aside.count() <= BROADCAST_DROPPED
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(f"`{key}`").cast("long").alias("_id"))
    ids = aside.select("_id")
    out = row.join(F.broadcast(ids) if few else ids, "_id", "left_anti").select("_row")
    again = aside.filter("_kept and _again").select("_id")
    if not again.isEmpty():
        mine = (row.join(F.broadcast(again) if few else again, "_id", "left_semi")
                .withColumn("_text", F.col(f"_row.`{text}`").cast("string")).withColumn("_hash", F.xxhash64("_text")))
        keys = (mine.select("_hash", "_text").mapInArrow(_digest, "id long, n long, set_key binary, bands array<long>")
                .groupBy(F.col("id").alias("_h")).agg(F.first("set_key").alias("_set")))
        keepers = rows.filter("stays and set_key is not null").select(F.col("id").alias("_i"), F.col("set_key").alias("_k")).distinct()
        mine = mine.join(keys, F.col("_hash") == F.col("_h"))
        one = (mine.join(keepers, (F.col("_id") == F.col("_i")) & (F.col("_set") == F.col("_k"))).groupBy("_id", "_set")
               .agg(F.min_by("_row", F.struct("_text")).alias("_row")))
        out = out.unionByName(mine.filter("_set is null").select("_row")).unionByName(one.select("_row"))
    return out.select("_row.*")
