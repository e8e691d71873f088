"""Operator 7: best-fit packing by hierarchical residual packing.

Documents become pieces of at most ``capacity`` tokens.  Round 0 deals the pieces out by hash into groups
of bounded size, and each group packs its own by best fit, longest first.  Bins with at most ``slack``
free tokens are done.  The others become items of the next round, where ``fan_in`` times fewer groups
best-fit them again (a bin moves as a whole), and so on up the tree, until one group is left or a round
no longer saves bins.  Rows are narrow (no ids), each round is a table in the shared folder, and no task
holds more than about ``group_items`` items with their rows.

Defined cases: a null or empty text is the end id alone; null ids are packed like others; repeated rows are
packed once each; an empty table gives no rows; other columns of the input are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.shared import bounded_batches, stored, text_of
from llm.wordbpe import column_slices, encoder, ended

CAPACITY = 4096
GROUP_ITEMS = 50_000      # items of one group, about
FAN_IN = 8
SLACK = 0.01              # a bin with at most this share free is done
LEAST_SAVED = 0.005       # a round that saves a smaller share of the bins is the last
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"
BIN_SCHEMA = f"{PIECE_SCHEMA}, bin long, offset long, free long"


def _pieces(batches, path: str, end_id: int, capacity: int):
    enc = encoder(path)
    for batch in batches:
        keys, texts = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
        missing = batch.column(0).is_null().to_numpy(zero_copy_only=False)
        keys = np.where(missing, 0, keys).astype(np.int64)
        for a, b in column_slices(texts):
            ids, ends = ended(*enc.column(texts.slice(a, b - a)), end_id)
            begin = np.concatenate([[0], ends[:-1]])
            pieces = -((begin - ends) // capacity)                   # of each document
            doc = np.repeat(np.arange(b - a), pieces)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = piece * capacity
            length = np.minimum(capacity, (ends - begin)[doc] - start)
            data, at = memoryview(ids.tobytes()), 4 * (begin[doc] + start)
            crc = [zlib.crc32(data[x:y]) for x, y in zip(at.tolist(), (at + 4 * length).tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[a:b][doc], mask=missing[a:b][doc]), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length),
                 pa.array(crc, pa.int64())], names=["doc_id", "piece", "start", "length", "ids_crc32"])
    enc.rest()


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = CAPACITY,
                 key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32``: each document's ids and the end id, cut only past ``capacity``."""
    bounded_batches(docs.sparkSession)
    return text_of(docs, key, text).mapInArrow(lambda it: _pieces(it, tokenizer, end_id, capacity), PIECE_SCHEMA)


def best_fit(sizes: list[int], capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each size, in the given order: always the fullest bin with room.  One bit for each
    amount of room that some bin has, so the least sufficient room is a find-first-set."""
    rooms, by_room, n = 0, [[] for _ in range(capacity + 1)], 0
    bins, offsets = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    for i, size in enumerate(sizes):
        enough = rooms >> size
        if enough:
            room = size + (enough & -enough).bit_length() - 1
            k = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            room, k, n = capacity, n, n + 1
        bins[i], offsets[i] = k, capacity - room
        if room > size:
            by_room[room - size].append(k)
            rooms |= 1 << (room - size)
    return bins, offsets


def _pack_group(frames, level: int, capacity: int):
    frames = [f for f in frames if len(f)]
    if not frames:
        return
    rows = pd.concat(frames, ignore_index=True)
    if level == 0:
        rows = rows.sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True], ignore_index=True)
        item, offset, sizes = np.arange(len(rows)), np.zeros(len(rows), np.int64), rows["length"].to_numpy()
    else:
        used = capacity - rows["free"].to_numpy()
        order = np.lexsort((rows["offset"].to_numpy(), rows["bin"].to_numpy(), -used))
        rows = rows.iloc[order].reset_index(drop=True)
        old = rows["bin"].to_numpy()
        first = np.concatenate([[True], old[1:] != old[:-1]])
        item, offset, sizes = np.cumsum(first) - 1, rows["offset"].to_numpy(), used[order][first]
    bins, offsets = best_fit(sizes.tolist(), capacity)
    free = capacity - np.bincount(bins, weights=sizes).astype(np.int64)
    rows["offset"], rows["free"] = offset + offsets[item], free[bins[item]]
    # unique over rounds and groups: 10 bits of the round, 24 of the group, 28 of the bin
    rows["bin"] = (np.int64(level) << 52) | (np.int64(TaskContext.get().partitionId()) << 28) | bins[item]
    for a in range(0, len(rows), 20_000):
        yield rows.iloc[a:a + 20_000][["doc_id", "piece", "start", "length", "ids_crc32", "bin", "offset", "free"]]


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_items: int = GROUP_ITEMS, fan_in: int = FAN_IN,
         slack: float = SLACK) -> DataFrame:
    """``pieces`` (as ``token_pieces`` gives them) with ``sequence_id long, offset long``; pieces in one sequence
    lie end to end from 0.  Run eagerly, a table a round; the returned frame reads those tables."""
    spare = int(capacity * slack)
    todo = stored(pieces, "pieces")
    n = todo.count()
    groups, level, done = max(1, -(-n // group_items)), 0, []
    while True:
        keys = [F.xxhash64("doc_id", "piece", "ids_crc32")] if level == 0 else ["bin"]
        at = level
        packed = stored(todo.repartition(groups, *keys)
                        .mapInPandas(lambda it: _pack_group(it, at, capacity), BIN_SCHEMA), f"packed-{level}")
        left = packed.filter(F.col("free") > spare)
        bins = left.filter(F.col("offset") == 0).count()
        if groups == 1 or bins == 0 or (level and n - bins < LEAST_SAVED * n and groups <= -(-bins // group_items)):
            done.append(packed)
            break
        done.append(packed.filter(F.col("free") <= spare))
        todo, n, level = left, bins, level + 1
        groups = max(-(-groups // fan_in), -(-bins // group_items))
    out = done[0]
    for x in done[1:]:
        out = out.unionByName(x)
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", F.col("bin").alias("sequence_id"), "offset")


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = CAPACITY, key: str = "doc_id",
                   text: str = "text", **how) -> DataFrame:
    """Every document, tokenized, cut and packed."""
    return pack(token_pieces(docs, tokenizer, end_id, capacity, key, text), capacity, **how)
