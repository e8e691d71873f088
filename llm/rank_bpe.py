"""Operator 2: byte-level BPE by ranks, with a hierarchical-bitmap rank queue.

A pre-token is a linked list of byte runs.  Each neighbouring pair whose bytes are a token waits in the bucket of that
token's rank, by its position.  Three levels of 64-bit words mark the buckets in use (a bit of an upper word says that the
word below has bits), so find-first-set on one word of each level gives the lowest rank.  Its positions merge from
the left; a merge changes two neighbouring pairs, which enter their new buckets, and the old entries, now stale, are
skipped when their bucket is reached.  Each merge costs the same however long the pre-token is.  Pre-tokens not met
before are merged side by side, some thousand in one queue; each still merges in its own order.

Defined cases: a null text is empty and has no ids; ids decode to the very bytes of the text; repeated rows are
encoded alike; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import base64
from array import array
from functools import lru_cache
from hashlib import sha256
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from llm.shared import bounded_batches, text_of
from llm.wordbpe import ID, slices

KEEP_PIECES, KEEP_SHARE, LONGEST = 500_000, 0.5, 48   # remembered pre-tokens, share kept when full, longest one
GROUP_BYTES = 10_000          # bytes of the pre-tokens merged side by side (one at least): their lists stay in cache
#: the pre-token pattern's white space: the Unicode property, stated so that control characters stay outside
SPACE = r"\x09-\x0D\x20\x85\xA0  -     　"


class RankQueue:
    """Buckets of positions by rank, with the ranks in use marked in three levels of 64-bit words.  Empty between
    merges, so that one serves them all."""

    def __init__(self, ranks: int):
        self.buckets: dict[int, list[int]] = {}
        self.low = [0] * (ranks // 64 + 1)          # bit r & 63 of word r >> 6: rank r is in use
        self.mid = [0] * (ranks // 4096 + 1)        # bit w & 63 of word w >> 6: low word w is not 0
        # the top word has a bit for each word of mid that is not 0; merge_all keeps it in a variable
        self.pairs: np.ndarray | None = None        # rank of each two bytes, -1 for none

    def pair_ranks(self, ranks: dict[bytes, int]) -> np.ndarray:
        if self.pairs is None:
            self.pairs = np.full(1 << 16, -1, np.int64)
            for token, rank in ranks.items():
                if len(token) == 2:
                    self.pairs[token[0] << 8 | token[1]] = rank
        return self.pairs


_BIT = [1 << k for k in range(64)]            # as many words of 4096 ranks as bits: 262,144 ranks


def merge_all(pieces: list[bytes], ranks: dict[bytes, int], queue: RankQueue) -> list[list[int]]:
    """The ids of some pre-tokens (none empty), merged side by side in one queue.  In each, the lowest rank merges first, and of
    equal ranks the leftmost.  Pre-tokens are a few bytes long, so a bucket taken from the queue serves many of them."""
    data, find = b"".join(pieces), ranks.get
    n = len(data)
    size = np.fromiter(map(len, pieces), np.int64, len(pieces))
    start = np.cumsum(size) - size
    flat = np.frombuffer(data, np.uint8).astype(np.int64)
    pair = np.full(n + 1, -1, np.int64)                         # rank of the pair that starts at p; -1: none, or p starts no run
    pair[:n - 1] = queue.pair_ranks(ranks)[flat[:-1] << 8 | flat[1:]]
    edge = np.zeros(n + 1, bool)                                # a piece begins here
    edge[start] = edge[n] = True
    pair[:n][edge[1:]] = -1
    whole = np.fromiter((piece in ranks for piece in pieces), bool, len(pieces))
    pair[:n][np.repeat(whole, size)] = -1                       # a token of its own is not taken apart
    bit, buckets, low, mid, top = _BIT, queue.buckets, queue.low, queue.mid, 0
    at = np.flatnonzero(pair >= 0)
    at = at[np.argsort(pair[at], kind="stable")]
    rank_at = pair[at]
    heads = np.flatnonzero(np.concatenate([[True], rank_at[1:] != rank_at[:-1]])[:len(at)])
    at, cuts = at.tolist(), [*heads.tolist(), len(at)]
    for i, r in enumerate(rank_at[heads].tolist()):             # the first pairs, each in the bucket of its rank
        buckets[r] = at[cuts[i]:cuts[i + 1]]
        w = r >> 6
        mid[w >> 6] |= bit[w & 63]
        top |= bit[w >> 6]
        low[w] |= bit[r & 63]
    now, edge = pair.tolist(), edge.tobytes()
    after = list(range(1, n + 2))             # after[p]: where the run that starts at p ends and the next one starts
    before = list(range(-1, n))
    while top:
        m = (top & -top).bit_length() - 1                       # find-first-set, level by level
        word = mid[m]
        w = m << 6 | (word & -word).bit_length() - 1
        word = low[w]
        rank = w << 6 | (word & -word).bit_length() - 1
        low[w] = word = word & (word - 1)                       # the bucket is taken, so its bit goes
        if not word:
            mid[m] = word = mid[m] & (mid[m] - 1)
            if not word:
                top &= top - 1
        todo = buckets.pop(rank)
        todo.sort()
        new, waits = [], None
        for p in todo:
            if now[p] != rank:
                continue                                        # stale
            if waits and int(np.searchsorted(start, p, "right")) in waits:
                new.append(p)
                continue
            q = after[p]
            end = after[p] = after[q]
            now[q] = -1
            least = rank
            if end < n:
                before[end] = p
            if edge[end]:
                now[p] = -1
            else:
                r = now[p] = find(data[p:after[end]], -1)
                if r >= 0:
                    new.append(p)
                    if r < least:
                        least = r
            if not edge[p]:
                o = before[p]
                r = now[o] = find(data[o:end], -1)
                if r >= 0:
                    new.append(o)
                    if r < least:
                        least = r
            if least < rank:                                    # a new pair goes first; the rest of this piece waits
                waits = waits or set()
                waits.add(int(np.searchsorted(start, p, "right")))
        for p in new:
            r = now[p]
            if r < 0:
                continue                                        # merged since
            if r in buckets:
                buckets[r].append(p)
            else:
                buckets[r] = [p]
                w = r >> 6
                if not low[w]:
                    m = w >> 6
                    if not mid[m]:
                        top |= bit[m]
                    mid[m] |= bit[w & 63]
                low[w] |= bit[r & 63]
    out = []
    for p, length, one in zip(start.tolist(), size.tolist(), whole.tolist()):
        end, ids = p + length, []
        if one:
            ids.append(ranks[data[p:end]])
            p = end
        while p < end:
            q = after[p]
            ids.append(ranks[data[p:q]])
            p = q
        out.append(ids)
    return out


def merge(piece: bytes, ranks: dict[bytes, int], queue: RankQueue) -> list[int]:
    """The ids of one pre-token."""
    return merge_all([piece], ranks, queue)[0]


def groups(pieces: list[bytes], most: int = GROUP_BYTES):
    """Runs of pieces of about ``most`` bytes together."""
    start = size = 0
    for i, piece in enumerate(pieces):
        size += len(piece)
        if size > most:
            yield pieces[start:i + 1]
            start, size = i + 1, 0
    if start < len(pieces):
        yield pieces[start:]


class ByteEncoder:
    """Ids of texts and bytes of ids, by a rank file and a pre-token pattern."""

    def __init__(self, path: str, pattern: str):
        import regex

        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.queue = RankQueue(len(self.tokens))
        explicit = pattern.replace(r"[^\s", f"[^{SPACE}").replace(r"\S", f"[^{SPACE}]").replace(r"\s", f"[{SPACE}]")
        self.split = regex.compile(explicit).findall
        self.known: dict[str, bytes] = {}

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as bytes.  Pre-tokens met before are looked up; the others are merged once."""
        cut = [self.split(t) if t else () for t in texts]
        known = self.known
        new = set().union(*cut).difference(known)
        ranks, queue = self.ranks, self.queue
        names = list(new)
        pieces = [p.encode("utf-8", "surrogatepass") for p in names]
        ids = (array("I", x).tobytes() for group in groups(pieces) for x in merge_all(group, ranks, queue))
        known.update(zip(names, ids))
        look = known.__getitem__
        out = [b"".join(map(look, x)) for x in cut]
        for p in [p for p in new if len(p) > LONGEST]:
            del known[p]
        if len(known) > KEEP_PIECES:          # the oldest stay: frequent pre-tokens are met early
            self.known = dict(islice(known.items(), int(KEEP_PIECES * KEEP_SHARE)))
        return out

    def encode(self, text: str | None) -> bytes:
        return self.encode_all([text])[0]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, ID).tolist()))


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> ByteEncoder:
    """One for each worker process and file."""
    return ByteEncoder(path, pattern)


def _encode(batches, path: str, pattern: str):
    enc = encoder(path, pattern)
    for batch in batches:
        keys, texts = batch.column(0), batch.column(1).to_pylist()
        for a, b in slices(texts):
            ids = enc.encode_all(texts[a:b])
            yield pa.RecordBatch.from_arrays(
                [keys.slice(a, b - a), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                names=["id", "n_tokens", "ids"])


def _decode(batches, path: str, pattern: str):
    enc = encoder(path, pattern)
    for batch in batches:
        ids = batch.column(2)
        size = max(1, (4 << 20) * batch.num_rows // max(ids.nbytes, 1))
        for a in range(0, batch.num_rows, size):
            part = batch.slice(a, size)
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(map(enc.decode, part.column(2).to_pylist()), pa.binary())],
                names=["id", "n_tokens", "ids", "decoded"])


def encode_texts(docs: DataFrame, ranks: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, n_tokens, ids``: each text's ids, as little-endian unsigned 32-bit integers in a binary column."""
    bounded_batches(docs.sparkSession)
    return text_of(docs, key, text).mapInArrow(lambda it: _encode(it, ranks, pattern), "id long, n_tokens long, ids binary")


def decode_ids(encoded: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """``encoded`` and ``decoded binary``, the bytes of the ids."""
    return encoded.select("id", "n_tokens", "ids").mapInArrow(
        lambda it: _decode(it, ranks, pattern), "id long, n_tokens long, ids binary, decoded binary")


def _round_trip(batches, path: str, pattern: str):
    enc = encoder(path, pattern)
    sizes = np.fromiter(map(len, enc.tokens), np.int64, len(enc.tokens))
    flat, first = np.frombuffer(b"".join(enc.tokens), np.uint8), np.cumsum(sizes) - sizes
    for batch in batches:
        keys, texts = batch.column(0), batch.column(1).to_pylist()
        for a, b in slices(texts):
            ids = enc.encode_all(texts[a:b])
            n = [len(x) // 4 for x in ids]
            # all ids of the slice decode at once: the tokens' bytes, one run after the other
            every = np.frombuffer(b"".join(ids), ID)
            runs = sizes[every]
            total = np.concatenate([[0], np.cumsum(runs)])
            data = flat[np.repeat(first[every] - total[:-1], runs) + np.arange(total[-1])].tobytes()
            ends = total[np.concatenate([[0], np.cumsum(n, dtype=np.int64)])].tolist()
            yield pa.RecordBatch.from_arrays(
                [keys.slice(a, b - a), pa.array(n, pa.int64()), pa.array([sha256(x).hexdigest() for x in ids]),
                 pa.array([sha256(data[x:y]).hexdigest() for x, y in zip(ends, ends[1:])])],
                names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])


def round_trip(docs: DataFrame, ranks: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_tokens, ids_sha256, decoded_sha256`` of each row, in one pass: only the digests leave the worker."""
    bounded_batches(docs.sparkSession)
    done = text_of(docs, key, text).mapInArrow(lambda it: _round_trip(it, ranks, pattern),
                                               "id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return done.withColumnRenamed("id", key)
