"""Operator 3: near-duplicate embeddings by randomised-rotation binary codes.

A unit vector is turned by a random rotation and kept as the signs of its components, one bit each, with two stored
numbers: the inner product of the vector and its code (the correction factor) and the code's bit count.  For another
vector, turned alike and rounded to four bits a component, bit counts of ANDs give an unbiased estimate of the inner
product and its standard error.  A pair is recomputed exactly, in double precision, only if the estimate's upper
confidence bound reaches the threshold.

1. Equal vectors are one class with a number of members.  Codes, factors and rounded forms are a table, made once a class.
2. Candidates: sign bits under further rotations, ``r`` to a band.  ``r`` is the logarithm of the number of classes and four, so
   chance meetings in a band stay a fixed share at every size, and there are as many bands as a pair at the
   threshold needs to meet but for ``MISS``.
3. Buckets of two classes or more are compared inside tasks, large ones in pairs of blocks of bounded size: first by the
   stored codes alone, then, where a bound reaches the threshold, once more with the vectors.  A link is
   counted in the first band where its two vectors meet.  A task returns for each vector its number of links and one
   link to its group there: as many rows as vectors, however many pairs are linked.
4. Counts are summed, and components made of the links returned.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components have no links and stay;
vectors are compared with those of their own length only; repeated rows count as other vectors; a
row with a null id counts for others and takes their component; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from functools import lru_cache
from math import acos, ceil, log, log2, pi

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from llm.components import components
from llm.shared import bounded_batches, stored

COSINE = 0.9
MISS = 0.005              # chance that a pair at the threshold meets in no band
SPREAD = 4.5              # standard errors of the confidence bound
PLANES = 4                # bits of a rounded component
BLOCK = 2048              # rows of one block of a large bucket
STREAM_ROWS = 16_384      # rows compared at a time, about


# --- rotations and codes -------------------------------------------------------------------------
@lru_cache(maxsize=8)
def rotations(dim: int, bits: int) -> np.ndarray:
    """Random rotations one above the other, at least ``bits`` rows; the first is the one of the codes."""
    rng = np.random.Generator(np.random.PCG64(dim))
    return np.concatenate([np.linalg.qr(rng.standard_normal((dim, dim)))[0] for _ in range(max(1, -(-bits // dim)))])


def _packed(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of 64-bit words."""
    wide = np.zeros((len(bits), -(-bits.shape[1] // 64) * 64), np.uint8)
    wide[:, :bits.shape[1]] = bits
    return np.packbits(wide, axis=1, bitorder="little").view("<u8")


class Codes:
    """Codes and rounded forms of some unit vectors of one length, made once and stored."""

    COLUMNS = "dim int, code binary, planes binary, factor double, low double, step double"

    def __init__(self, dim: int, code: np.ndarray, planes: list[np.ndarray], factor: np.ndarray, low: np.ndarray, step: np.ndarray):
        self.dim, self.code, self.planes, self.factor, self.low, self.step = dim, code, planes, factor, low, step
        self.count = np.bitwise_count(code).sum(axis=1).astype(np.float64)
        self.total = sum((1 << p) * np.bitwise_count(plane).sum(axis=1).astype(np.float64) for p, plane in enumerate(planes))

    @classmethod
    def of(cls, unit: np.ndarray) -> "Codes":
        dim = unit.shape[1]
        turned = unit @ rotations(dim, dim)[:dim].T
        low = turned.min(axis=1)
        step = np.maximum((turned.max(axis=1) - low) / (2 ** PLANES - 1), 1e-12)
        rounded = np.rint((turned - low[:, None]) / step[:, None]).astype(np.uint8)
        return cls(dim, _packed(turned > 0), [_packed((rounded >> p) & 1) for p in range(PLANES)],
                   np.abs(turned).sum(axis=1) / np.sqrt(dim), low, step)                          # factor: <code, vector>

    @classmethod
    def read(cls, rows: pd.DataFrame) -> "Codes":
        """From stored columns of vectors of one length."""
        dim = int(rows["dim"].iloc[0])
        words = -(-dim // 64)
        planes = np.frombuffer(b"".join(rows["planes"]), "<u8").reshape(-1, PLANES, words)
        return cls(dim, np.frombuffer(b"".join(rows["code"]), "<u8").reshape(-1, words), [planes[:, p] for p in range(PLANES)],
                   *(rows[c].to_numpy() for c in ("factor", "low", "step")))

    def columns(self) -> list[pa.Array]:
        planes = np.stack(self.planes, axis=1)
        return [pa.array(np.full(len(self.code), self.dim, np.int32)), pa.array([c.tobytes() for c in self.code], pa.binary()),
                pa.array([p.tobytes() for p in planes], pa.binary()), *map(pa.array, (self.factor, self.low, self.step))]

    def upper(self, x: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Upper confidence bounds of the inner products of rows ``x`` (by code) and ``q`` (rounded)."""
        code = self.code[x]
        meet = sum((1 << p) * np.bitwise_count(code & plane[q]).sum(axis=-1).astype(np.float64)
                   for p, plane in enumerate(self.planes))
        step, low, root = self.step[q], self.low[q], np.sqrt(self.dim)
        signs = (2 * step * meet + 2 * low * self.count[x] - step * self.total[q]) / root - root * low
        f = self.factor[x]
        error = np.sqrt((1 - np.minimum(f, 1) ** 2) / max(self.dim - 1, 1) + step ** 2 / 12) / f
        return signs / f + SPREAD * error


@lru_cache(maxsize=8)
def _band_mix(bits: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(bits)).integers(0, 1 << 63, bits, dtype=np.uint64)


def band_keys(unit: np.ndarray, bits: int, bands: int) -> np.ndarray:
    """A 64-bit key for each row and band."""
    dim = unit.shape[1]
    turned = unit @ rotations(dim, dim + bits * bands)[dim:dim + bits * bands].T > 0
    mix = _band_mix(bits * bands).reshape(bands, bits)
    own = _band_mix(2 * bands)[:bands] + np.uint64(dim)              # a band meets only itself
    return ((turned.reshape(len(unit), bands, bits) * mix).sum(axis=2, dtype=np.uint64) + own).view(np.int64)


def band_plan(n: int, cosine: float = COSINE, miss: float = MISS) -> tuple[int, int]:
    """Bits of a band and number of bands for ``n`` classes."""
    bits = max(4, ceil(log2(max(n, 2))) + 4)
    meet = (1 - acos(cosine) / pi) ** bits
    return bits, ceil(log(miss) / log(1 - meet))


# --- stages ----------------------------------------------------------------------------------------
def _vectors(batches):
    for batch in batches:
        ids, keys, vecs = batch.column(0), [], []
        for v in batch.column(1).to_pylist():
            x = np.asarray([np.nan if c is None else c for c in v] if v else [], np.float64)
            top = np.abs(x).max() if len(x) else 0.0
            good = len(x) > 0 and np.isfinite(x).all() and top > 0
            x = (x + 0.0) if good else x
            keys.append(xxhash.xxh3_64_intdigest(x.tobytes()) - 2 ** 63 if good else None)
            if good:
                x = x / top                            # no overflow or underflow in the squares
                x = x / np.sqrt((x * x).sum())
            vecs.append(x.tobytes() if good else None)
        yield pa.RecordBatch.from_arrays([ids, pa.array(keys, pa.int64()), pa.array(vecs, pa.binary())], names=["id", "node", "unit"])


def _codes(batches):
    """``node, members`` and the code of each class."""
    for batch in batches:
        units = batch.column(2).to_pylist()
        dims = np.asarray([len(u) // 8 for u in units])
        for dim in np.unique(dims).tolist():
            at = np.flatnonzero(dims == dim)
            codes = Codes.of(np.frombuffer(b"".join(units[i] for i in at), "<f8").reshape(-1, dim))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), batch.column(1).take(pa.array(at)), *codes.columns()],
                                             names=["node", "members", "dim", "code", "planes", "factor", "low", "step"])


def _bands(batches, bits: int, bands: int):
    for batch in batches:
        nodes, units = batch.column(0).to_numpy(), batch.column(1).to_pylist()
        dims = np.asarray([len(u) // 8 for u in units])
        for dim in np.unique(dims).tolist():
            at = np.flatnonzero(dims == dim)
            keys = band_keys(np.frombuffer(b"".join(units[i] for i in at), "<f8").reshape(-1, dim), bits, bands)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(nodes[at], bands)), pa.array(np.tile(np.arange(bands, dtype=np.int32), len(at))),
                 pa.array(keys.ravel())], names=["node", "band", "bucket"])


def _group_pairs(start: np.ndarray, size: np.ndarray, block: np.ndarray, across: np.ndarray):
    """Row pairs of each group, some rows of the larger groups at a time."""
    end = np.repeat(start + size, size)
    ahead = np.zeros(len(end), np.int64)
    ahead[:] = end - np.arange(len(end)) - 1
    row, todo = 0, len(end)
    while row < todo:
        stop = row + max(1, int(np.searchsorted(np.cumsum(ahead[row:]), 1 << 19, side="right")))
        n = ahead[row:stop]
        x = np.repeat(np.arange(row, stop), n)
        y = x + 1 + np.arange(len(x)) - np.repeat(np.cumsum(n) - n, n)
        keep = ~across[x] | (block[x] != block[y])
        yield x[keep], y[keep]
        row = stop


def _joined(root: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """``root`` (the least row of each row's group) after joining the groups of ``x`` and ``y``, all pairs at once: the
    larger root of a pair hooks on to the smaller, and every row follows its root up."""
    while True:
        a, b = root[x], root[y]
        apart = a != b
        if not apart.any():
            return root
        x, y, a, b = x[apart], y[apart], a[apart], b[apart]
        root = root.copy()
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root = root[root]


GROUP = ["bucket", "i", "j"]


def _by_length(rows: pd.DataFrame):
    """Per vector length: the rows, their codes, and the pairs of each group whose bound may reach the threshold."""
    for dim in np.unique(rows["dim"].to_numpy()).tolist():
        part = rows[rows["dim"] == dim].reset_index(drop=True)
        group = part[GROUP].to_numpy()
        first = np.flatnonzero(np.concatenate([[True], (group[1:] != group[:-1]).any(axis=1)]))
        size = np.diff(np.append(first, len(part)))
        yield part, Codes.read(part), _group_pairs(first, size, part["block"].to_numpy(), (part["i"] != part["j"]).to_numpy())


def sift(rows: pd.DataFrame, cosine: float) -> pd.DataFrame:
    """Of whole groups of rows (sorted by group, with codes): those that have a pair whose bound reaches the threshold."""
    found = []
    for part, codes, pairs in _by_length(rows):
        wanted = np.zeros(len(part), bool)
        for x, y in pairs:
            near = codes.upper(x, y) >= cosine
            wanted[x[near]] = wanted[y[near]] = True
        found.append(part[wanted][[*GROUP, "block", "band", "node"]])
    return pd.concat(found, ignore_index=True)


def compare(rows: pd.DataFrame, cosine: float, bits: int, bands: int) -> pd.DataFrame:
    """Whole groups of rows (sorted by group, with codes and vectors): ``node, links, root`` of the rows with links."""
    found = []
    for part, codes, pairs in _by_length(rows):
        unit = np.frombuffer(b"".join(part["unit"]), "<f8").reshape(-1, codes.dim)
        keys = band_keys(unit, bits, bands)
        links, root = np.zeros(len(part), np.int64), np.arange(len(part))
        members, band = part["members"].to_numpy(), part["band"].to_numpy()
        for x, y in pairs:
            near = codes.upper(x, y) >= cosine
            x, y = x[near], y[near]
            exact = np.einsum("ij,ij->i", unit[x], unit[y]) >= cosine
            x, y = x[exact], y[exact]
            counted = np.ones(len(x), bool)
            for a in range(0, len(x), 65_536):
                same = keys[x[a:a + 65_536]] == keys[y[a:a + 65_536]]
                counted[a:a + 65_536] = same.argmax(axis=1) == band[x[a:a + 65_536]]
            np.add.at(links, x[counted], members[y[counted]])
            np.add.at(links, y[counted], members[x[counted]])
            root = _joined(root, x, y)
        some = (links > 0) | (root != np.arange(len(part)))
        found.append(pd.DataFrame({"node": part["node"][some], "links": links[some], "root": part["node"].to_numpy()[root[some]]}))
    return pd.concat(found, ignore_index=True)


def _stream(frames, each):
    """``each`` of the sorted rows of a partition, cut between groups, so that a task holds a few blocks at a time."""
    held: list[pd.DataFrame] = []
    for frame in frames:
        held.append(frame)
        if sum(map(len, held)) >= STREAM_ROWS:
            rows = pd.concat(held, ignore_index=True)
            last = rows[GROUP].iloc[-1]
            open_ = ((rows["bucket"] == last["bucket"]) & (rows["i"] == last["i"]) & (rows["j"] == last["j"])).to_numpy()
            if not open_.all():
                yield each(rows[~open_].reset_index(drop=True))
            held = [rows[open_].reset_index(drop=True)]
    held = [f for f in held if len(f)]
    if held:
        yield each(pd.concat(held, ignore_index=True))


def near_embeddings(vectors: DataFrame, key: str = "vec_id", embedding: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """``key, n_links, component_id, kept`` of every row."""
    bounded_batches(vectors.sparkSession)
    rows = stored(vectors.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{embedding}`").cast("array<double>").alias("v"))
                  .mapInArrow(_vectors, "id long, node long, unit binary"), "vectors")
    classes = stored(rows.filter("node is not null").groupBy("node")
                     .agg(F.count(F.lit(1)).alias("members"), F.first("unit").alias("unit")), "classes")
    bits, bands = band_plan(classes.count(), cosine)

    each = classes.select("node", "unit").mapInArrow(lambda it: _bands(it, bits, bands), "node long, band int, bucket long")
    shared = each.withColumn("size", F.count(F.lit(1)).over(Window.partitionBy("bucket"))).filter("size > 1")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    dealt = stored(shared.withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int"))
                   .withColumn("with", F.explode(F.sequence(F.lit(0), blocks - 1)))
                   .select("bucket", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"),
                           "block", "band", "node"), "meetings")
    codes = stored(classes.select("node", "members", "unit").mapInArrow(_codes, f"node long, members long, {Codes.COLUMNS}"), "codes")

    def grouped(rows):
        return rows.repartition(*GROUP).sortWithinPartitions(*GROUP, "node")

    # codes alone go to the meetings; vectors follow where a bound reaches the threshold
    near = stored(grouped(dealt.join(codes.drop("members"), "node"))
                  .mapInPandas(lambda it: _stream(it, lambda rows: sift(rows, cosine)), "bucket long, i int, j int, block int, band int, node long"), "near")
    found = stored(grouped(near.join(codes, "node").join(classes.select("node", "unit"), "node"))
                   .mapInPandas(lambda it: _stream(it, lambda rows: compare(rows, cosine, bits, bands)), "node long, links long, root long"), "found")

    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    label = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")).distinct())
    placed = (rows.select("id", "node").join(classes.select("node", "members"), "node", "left").join(links, "node", "left")
              .join(label, F.col("node") == label["id"], "left").drop(label["id"])
              .select("id", "node", F.coalesce(F.col("members") - 1 + F.coalesce("links", F.lit(0)), F.lit(0)).alias("n_links"),
                      F.coalesce("component", "node").alias("group")))
    least = placed.filter("group is not null").groupBy("group").agg(F.min("id").alias("least"))
    out = (placed.join(least, "group", "left")
           .select(F.col("id").alias(key), "n_links", F.coalesce("least", "id").alias("component_id")))
    return out.withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.col("component_id").isNull()))
