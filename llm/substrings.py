"""Operator 11: removal of passages that an earlier document holds, by suffix automata of reference shards.

A window is ``WINDOW`` words in a row.  A word goes if a window over it also starts in a document with a smaller id.  The
corpus is its own reference, so the reference is first brought down to what can match, and cut into shards:

1. Marks.  Of the word 5-grams inside a window the one with the least hash is the window's mark, so equal windows have equal
   marks.  A task joins equal marks of its documents; a mark with several documents is repeated, and it sends one row with their
   number, else the document.  Marks meet in buckets by their value, where those of several tasks are repeated too.  So a mark
   sends a bucket at most one row a task, however many documents hold it.
2. Passages.  Windows in a row with the same repeated mark are one passage (12 words more than windows).  Its shard is its
   mark's, so all copies of a window meet in one shard, and no other window needs that shard.  A task writes a
   passage once, with the places where it was seen, packed by shard.
3. Automata.  A shard's suffix automaton holds its different passages; a state knows the least document id at which its
   strings end.  The shard's passages are streamed through it: the state of the last ``WINDOW`` words gives
   the first document of each window.  (The passages of a mark that has one text only match nothing but that text and need
   no automaton.)  Runs of windows with an earlier first document are spans, joined to their document, whose words under
   any span go.
4. Frequent marks (more than ``HOT`` documents) are cut into single windows, dealt by the window's own hash; each task
   writes a window once, with the documents it was seen in.  The automaton answers for each different
   window, and the answers are joined to the tasks' rows, so a passage in a third of all documents is gathered nowhere.

The automaton of a shard goes to the passages of that shard only.  Sending every shard's to all documents would cost
documents times shards.  What is broadcast is the list of frequent marks, at most ``HOT_MARKS`` numbers.

Defined cases: a null or empty text has no words and loses none; fewer than ``WINDOW`` words lose none; a null id is neither
smaller nor larger than another, so such a row stays whole and removes nothing; rows with equal ids remove nothing
from each other, and each is judged by its own text; repeated rows have equal results; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.shared import bounded_batches, stored

WINDOW, GRAM = 13, 5
PIECE = 52                # windows of one passage at most
SHARD_ROWS = 16_000       # marks of one shard, about
HOT, HOT_MARKS = 2_000, 4_000_000     # documents of a frequent mark, at least; frequent marks at most
KEEP_TEXTS = 100_000      # passages that a task holds to write equal ones once
KEEP_MARKS = 4_000_000    # marks that a task joins at once
BUCKET_BYTES = 24 << 20   # bytes of text whose marks fill a bucket (a million marks), about
SLICE_BYTES = 1 << 20     # bytes of text looked at at once (one text at least)

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOW = np.asarray([(1 << 8 * k) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)      # the first k bytes of eight
_PLACE = np.asarray([pow(0x9E3779B97F4A7C15, k + 1, 1 << 64) for k in range(GRAM)], np.uint64)
_NONE = np.empty(0, np.int64)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def pack(columns: dict) -> bytes:
    """Columns as one compressed value: a row of a shuffle that stands for many."""
    batch = pa.RecordBatch.from_pydict(columns)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpack(value: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(value).read_next_batch()


class Words:
    """The words of some texts in a row, as places in their bytes, and their runs of windows."""

    def __init__(self, data: np.ndarray, ends: np.ndarray):
        """``data``: the texts' bytes in a row; ``ends``: where each text begins, and the end."""
        self.data, word = data, ~_SPACE[data]
        before, after = np.empty(len(word), bool), np.empty(len(word), bool)
        before[1:], after[:-1] = word[:-1], word[1:]
        inner = ends[:-1][ends[:-1] < len(word)]
        before[inner] = False
        after[ends[1:][ends[1:] > 0] - 1] = False
        self.start = np.flatnonzero(word & ~before)
        self.end = np.flatnonzero(word & ~after) + 1
        self.base = np.searchsorted(self.start, ends)                     # each text's first word, and the number of words

    def hashes(self) -> np.ndarray:
        """A hash of each word, eight bytes at a time.  (It deals work; texts are compared byte by byte.)"""
        padded = np.concatenate([self.data, np.zeros(8, np.uint8)])
        eight = np.ndarray((len(self.data) + 1,), "<u8", padded, 0, (1,))
        size = self.end - self.start
        h = _mix((eight[self.start] & _LOW[np.minimum(size, 8)]) + size.astype(np.uint64) * _PLACE[0])
        left, done = np.flatnonzero(size > 8), 8
        while len(left):
            rest = size[left] - done
            h[left] = _mix(h[left] * _PLACE[1] + (eight[self.start[left] + done] & _LOW[np.minimum(rest, 8)]))
            done += 8
            left = left[rest > 8]
        return h

    def runs(self):
        """``text, first, count, mark`` of each run of windows with one mark: its text's number, its first window (a place among
        all words), its windows and its mark."""
        if len(self.start) < WINDOW:
            return _NONE, _NONE, _NONE, np.empty(0, np.uint64)
        h = self.hashes()
        grams = np.zeros(len(h) - GRAM + 1, np.uint64)
        for i in range(GRAM):
            grams += h[i:i + len(grams)] * _PLACE[i]
        low, wide, need = _mix(grams), 1, WINDOW - GRAM + 1
        while wide < need:                                 # least of ``need`` grams in a row, by doubling
            step = min(wide, need - wide)
            low = np.minimum(low[:-step], low[step:])
            wide += step
        owner = np.repeat(np.arange(len(self.base) - 1), np.diff(self.base))
        inside = np.flatnonzero(owner[:len(low)] == owner[WINDOW - 1:])
        if not len(inside):
            return _NONE, _NONE, _NONE, np.empty(0, np.uint64)
        mark, text = low[inside], owner[inside]
        new = np.flatnonzero(np.concatenate([[True], (mark[1:] != mark[:-1]) | (text[1:] != text[:-1])]))
        return text[new], inside[new], np.diff(np.append(new, len(inside))), mark[new]

    def passage(self, first: int, size: int) -> bytes:
        """``size`` words from the ``first`` on, joined by a space."""
        return b" ".join(self.data[self.start[first]:self.end[first + size - 1]].tobytes().split())


def _texts(column: pa.Array):
    """``a, b, Words`` of slices of a column of texts as bytes (null: empty)."""
    ends = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, 4 * column.offset).astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    if column.null_count:                                  # whatever bytes a null has are not its text
        column = column.fill_null(b"")
        yield from _texts(column)
        return
    a = 0
    while a < len(column):
        b = max(a + 1, int(np.searchsorted(ends, ends[a] + SLICE_BYTES, "right")) - 1)
        yield a, b, Words(data[ends[a]:ends[b]], ends[a:b + 1] - ends[a])
        a = b


def _send_marks(batches, buckets: int):
    """A task's marks, equal ones joined, packed by bucket; marks that several of its documents hold go by themselves."""
    marks, rows, held = [], [], 0

    def send():
        mark, row = np.concatenate(marks), np.concatenate(rows)
        order = np.argsort(mark, kind="stable")
        mark, row = mark[order], row[order]
        once = np.concatenate([[True], (mark[1:] != mark[:-1]) | (row[1:] != row[:-1])])
        mark, row = mark[once], row[once]
        first = np.flatnonzero(np.concatenate([[True], mark[1:] != mark[:-1]]))
        n = np.diff(np.append(first, len(mark)))
        single = n == 1
        shared = np.repeat(~single, n)
        task = TaskContext.get().partitionId()
        if shared.any():
            yield buckets + task, pack({"mark": mark[shared].view(np.int64), "row": row[shared]})
        own = mark[first]
        edges = np.searchsorted(own, np.asarray([(k << 64) // buckets for k in range(buckets)], np.uint64)).tolist() + [len(own)]
        for k in range(buckets):
            a, b = edges[k], edges[k + 1]
            if a < b:
                # the row of a single mark or, for a shared one, minus its documents
                by = np.lexsort((own[a:b], row[first[a:b]]))
                one = single[a:b][by]
                yield k, pack({"mark": own[a:b][by].view(np.int64), "row": np.where(one, row[first[a:b]][by], 0),
                               "n": n[a:b][by].astype(np.int32)})

    def out(sent):
        for k, value in sent:
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), pa.array([value], pa.binary())], names=["k", "packed"])

    for batch in batches:
        own = batch.column(0).to_numpy(zero_copy_only=False)
        for a, b, words in _texts(batch.column(1)):
            text, _, _, mark = words.runs()
            marks.append(mark)
            rows.append(own[a:b][text])
            held += len(mark)
            if held >= KEEP_MARKS:
                yield from out(send())
                marks, rows, held = [], [], 0
    if held:
        yield from out(send())


HITS = pa.schema([("row", pa.int64()), ("mark", pa.int64())])


def _meet(group: pa.Table, buckets: int, hot: int) -> pa.Table:
    """The ``(row, mark)`` pairs of a bucket's repeated marks; a mark of more than ``hot`` documents comes once, without a row."""
    packed = [unpack(v) for v in group.column("packed").to_pylist()]
    mark = np.concatenate([p.column("mark").to_numpy() for p in packed])
    row = np.concatenate([p.column("row").to_numpy() for p in packed])
    if group.column("k")[0].as_py() >= buckets:
        return pa.Table.from_arrays([pa.array(row), pa.array(mark)], schema=HITS)
    n = np.concatenate([p.column("n").to_numpy() for p in packed])
    order = np.argsort(mark, kind="stable")
    mark, row, n = mark[order], row[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], mark[1:] != mark[:-1]]))
    total = np.add.reduceat(n, first)
    often = total > hot
    answer = np.repeat((total > 1) & ~often, np.diff(np.append(first, len(mark)))) & (n == 1)
    rows = pa.concat_arrays([pa.array(row[answer]), pa.nulls(int(often.sum()), pa.int64())])
    return pa.Table.from_arrays([rows, pa.array(np.concatenate([mark[answer], mark[first][often]]))], schema=HITS)


class _Passages:
    """Passages of a task by their text, each with the places where it was seen, packed by shard."""

    SCHEMA = "shard long, packed binary"

    def __init__(self):
        self.seen: dict[bytes, tuple] = {}

    def add(self, shard: int, mark: int, text: bytes, key: int, row: int, start: int) -> None:
        at = self.seen.get(text)
        if at is None:
            at = self.seen[text] = (shard, mark, text, [], [], [])
        at[3].append(key)
        at[4].append(row)
        at[5].append(start)

    def take(self):
        by_shard: dict[int, list] = {}
        for x in self.seen.values():
            by_shard.setdefault(x[0], []).append(x)
        self.seen = {}
        for shard, found in by_shard.items():
            _, mark, text, ids, rows, starts = zip(*found)
            value = pack({"mark": np.asarray(mark, np.uint64).astype(np.uint32), "text": pa.array(text, pa.binary()),
                          "ids": pa.array(ids, pa.list_(pa.int64())), "rows": pa.array(rows, pa.list_(pa.int64())),
                          "starts": pa.array(starts, pa.list_(pa.int32()))})
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([value], pa.binary())], names=["shard", "packed"])


def _is_in(hot: np.ndarray, mark: np.ndarray) -> np.ndarray:
    if not len(hot):
        return np.zeros(len(mark), bool)
    return hot[np.minimum(np.searchsorted(hot, mark), len(hot) - 1)] == mark


def _passages(batches, shards: int, hot: np.ndarray):
    """Passages of the documents' repeated marks, but for frequent ones."""
    found = _Passages()
    for batch in batches:
        keys, rows, marks = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3)
        ends, values = marks.offsets.to_numpy(), marks.values.to_numpy(zero_copy_only=False).view(np.uint64)
        for a, b, words in _texts(batch.column(2)):
            text, first, count, mark = words.runs()
            own = np.repeat(np.arange(b - a, dtype=np.uint64), np.diff(ends[a:b + 1]))
            wanted = np.isin(_mix(mark + text.astype(np.uint64) * _PLACE[0]), _mix(values[ends[a]:ends[b]] + own * _PLACE[0]))
            wanted &= ~_is_in(hot, mark)
            for t, f, c, m in zip(text[wanted].tolist(), first[wanted].tolist(), count[wanted].tolist(), mark[wanted].tolist()):
                start = f - int(words.base[t])
                for i in range(0, c, PIECE):
                    found.add(m % shards, m, words.passage(f + i, min(PIECE, c - i) + WINDOW - 1), keys[a + t], rows[a + t], start + i)
            if len(found.seen) > KEEP_TEXTS:
                yield from found.take()
    yield from found.take()


WINDOWS = "unit long, shard long, text binary, ids array<long>, rows array<long>, starts array<int>"


def _hot_windows(batches, shards: int, hot: np.ndarray):
    """Single windows of frequent marks, each once a unit (what a task holds at once) with the places where it was seen."""
    seen: dict[bytes, tuple] = {}
    unit = TaskContext.get().partitionId() << 32

    def take():
        nonlocal unit
        ids, rows, starts = zip(*seen.values()) if seen else ((), (), ())
        shard = [xxhash.xxh3_64_intdigest(w) % shards for w in seen]
        unit += 1
        return pa.RecordBatch.from_arrays(
            [pa.array([unit] * len(seen), pa.int64()), pa.array(shard, pa.int64()), pa.array(seen.keys(), pa.binary()),
             pa.array(ids, pa.list_(pa.int64())), pa.array(rows, pa.list_(pa.int64())), pa.array(starts, pa.list_(pa.int32()))],
            names=["unit", "shard", "text", "ids", "rows", "starts"])

    for batch in batches:
        keys, rows = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for a, b, words in _texts(batch.column(2)):
            text, first, count, mark = words.runs()
            wanted = _is_in(hot, mark)
            for t, f, c in zip(text[wanted].tolist(), first[wanted].tolist(), count[wanted].tolist()):
                for i in range(f, f + c):
                    at = seen.setdefault(words.passage(i, WINDOW), ([], [], []))
                    at[0].append(keys[a + t])
                    at[1].append(rows[a + t])
                    at[2].append(i - int(words.base[t]))
            if len(seen) > KEEP_TEXTS:
                yield take()
                seen.clear()
    yield take()


class Automaton:
    """Suffix automaton of word sequences; each state knows the least id among the sequences that end in it."""

    def __init__(self, sequences):
        """``sequences``: ``(words, id)`` pairs in ascending order of the id."""
        nexts, link, length, least = [{}], [-1], [0], [None]
        for words, key in sequences:
            last = 0
            for w in words:
                q = nexts[last].get(w)
                if q is not None and length[q] == length[last] + 1:
                    last = q
                    continue
                if q is None:
                    new, p = len(nexts), last
                    nexts.append({})
                    length.append(length[last] + 1)
                    link.append(0)
                    least.append(key)
                    while p >= 0 and w not in nexts[p]:
                        nexts[p][w] = new
                        p = link[p]
                    if p < 0:
                        last = new
                        continue
                    q = nexts[p][w]
                    if length[q] == length[p] + 1:
                        link[new] = q
                        last = new
                        continue
                else:
                    new, p = -1, last
                copy = len(nexts)                          # the strings of q no longer than p's and a word part from q
                nexts.append(dict(nexts[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                least.append(key)                          # an upper bound; mended below from the states under it
                while p >= 0 and nexts[p].get(w) == q:
                    nexts[p][w] = copy
                    p = link[p]
                link[q] = copy
                if new >= 0:
                    link[new] = copy
                    last = new
                else:
                    last = copy
        order = np.argsort(np.asarray(length), kind="stable")[::-1].tolist()
        for s in order:                                    # longer states first: what ends in a state ends in its link
            up = link[s]
            if up > 0 and least[s] < least[up]:
                least[up] = least[s]
        self.nexts, self.link, self.length, self.least = nexts, link, length, least

    def firsts(self, words, window: int) -> list:
        """For each window of ``words`` the least id that holds it, or None."""
        nexts, link, length, least = self.nexts, self.link, self.length, self.least
        state, matched, out = 0, 0, []
        for at, w in enumerate(words, 1):
            to = nexts[state].get(w)
            while to is None and state:                    # the longest ending that goes on with this word
                state = link[state]
                matched = length[state]
                to = nexts[state].get(w)
            if to is not None:
                state, matched = to, matched + 1
                while length[link[state]] >= window:       # the state of the last ``window`` words
                    state = link[state]
                    matched = length[state]
            if at >= window:
                out.append(least[state] if matched >= window else None)
        return out


def _automaton(least: dict[bytes, int]):
    """The automaton of a shard's texts and their least ids, and the texts as word numbers."""
    number: dict[bytes, int] = {}
    cut = {t: [number.setdefault(w, len(number)) for w in t.split(b" ")] for t in least}
    return Automaton((cut[t], key) for t, key in sorted(least.items(), key=lambda x: x[1])), cut


SPANS = pa.schema([("row", pa.int64()), ("id", pa.int64()), ("start", pa.int32()), ("size", pa.int32())])


def _shard_spans(group: pa.Table) -> pa.Table:
    """The spans to remove from the documents of a shard's passages."""
    least: dict[bytes, int] = {}
    family: dict[int, bytes | None] = {}                   # a mark's text while it is the only one
    places = []
    for value in group.column("packed").to_pylist():
        for x in zip(*unpack(value).to_pydict().values()):
            mark, text, ids, _, _ = x
            key = min(ids)
            if least.get(text, key) >= key:
                least[text] = key
            if family.setdefault(mark, text) != text:
                family[mark] = None
            places.append(x)
    machine, cut = _automaton({x[1]: least[x[1]] for x in places if family[x[0]] is None})
    firsts = {t: machine.firsts(words, WINDOW) for t, words in cut.items()}
    spans = set()
    for _, text, keys, own, at in places:
        first = firsts.get(text)
        low = high = least[text]
        if first is not None:
            low, high = min(first), max(first)
        windows = text.count(b" ") + 2 - WINDOW
        for key, row, start in zip(keys, own, at):
            if high < key:
                spans.add((row, key, start, windows + WINDOW - 1))
            elif low < key:
                begin = None
                for i, f in enumerate([*first, key]):
                    if f < key:
                        begin = i if begin is None else begin
                    elif begin is not None:
                        spans.add((row, key, start + begin, i - begin + WINDOW - 1))
                        begin = None
    columns = zip(*spans) if spans else ((), (), (), ())
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, SPANS)], schema=SPANS)


def _shard_firsts(group: pa.Table) -> pa.Table:
    """The first document of each single window of a shard."""
    machine, cut = _automaton(dict(zip(group.column("text").to_pylist(), group.column("id").to_pylist())))
    return pa.table({"text": pa.array(cut.keys(), pa.binary()),
                     "first": pa.array([machine.firsts(words, WINDOW)[0] for words in cut.values()], pa.int64())})


def _window_spans(group: pa.Table) -> pa.Table:
    """A unit's windows with an earlier first document, joined to spans."""
    columns = [pa.concat_arrays(group.column(c).chunks) for c in ("ids", "rows", "starts")]
    n = np.diff(columns[0].offsets.to_numpy())
    first = np.repeat(group.column("first").to_numpy(), n)
    key, row, start = (c.flatten().to_numpy() for c in columns)
    gone = first < key
    key, row, start = key[gone], row[gone], start[gone]
    order = np.lexsort((start, key, row))
    key, row, start = key[order], row[order], start[order]
    apart = (row[1:] != row[:-1]) | (key[1:] != key[:-1]) | (start[1:] > start[:-1] + WINDOW)
    begin = np.flatnonzero(np.concatenate([[True], apart])[:len(row)])
    end = np.append(begin[1:], len(row)) - 1
    return pa.Table.from_arrays([pa.array(row[begin]), pa.array(key[begin]), pa.array(start[begin], pa.int32()),
                                 pa.array(start[end[:len(begin)]] - start[begin] + WINDOW, pa.int32())], schema=SPANS)


def _kept(batches):
    shape = pa.list_(pa.struct([("start", pa.int64()), ("size", pa.int64())]))
    for batch in batches:
        keys, texts, spans = batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist()
        n_words, n_gone, kept, shown = [], [], [], []
        for text, key, found in zip(texts, keys.to_pylist(), spans):
            words, merged = (text or b"").split(), []      # bytes: only ASCII white space
            n_words.append(len(words))
            for a, size in sorted((s["start"], s["size"]) for s in found or () if s["id"] == key):
                if merged and a <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], a + size)
                else:
                    merged.append([a, a + size])
            n_gone.append(sum(b - a for a, b in merged))
            for a, b in reversed(merged):
                del words[a:b]
            kept.append(b" ".join(words))
            shown.append([{"start": a, "size": b - a} for a, b in merged])
        yield pa.RecordBatch.from_arrays(
            [keys, pa.array(n_words, pa.int64()), pa.array(n_gone, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string()),
             pa.array(shown, shape)], names=["id", "n_words", "n_removed", "kept", "spans"])


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", hot: int = HOT) -> DataFrame:
    """``key, n_words, n_removed, kept, spans`` for every row: its words, those removed, those kept joined by a space, and
    the removed spans (first word and words)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").cast("binary").alias("text"))
    rows = rows.withColumn("row", F.xxhash64("id", "text"))
    known = rows.filter("id IS NOT NULL")

    size = known.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("size")).first()["size"]
    buckets = max(spark.sparkContext.defaultParallelism, -(-size // BUCKET_BYTES))
    limit = max(hot, size // 2 // HOT_MARKS)               # a mark takes a word, so two bytes at least
    hits = stored(known.select("row", "text").mapInArrow(lambda it: _send_marks(it, buckets), "k long, packed binary")
                  .groupBy("k").applyInArrow(lambda group: _meet(group, buckets, limit), "row long, mark long"), "repeated", compression="zstd")
    shards = max(1, -(-hits.count() // SHARD_ROWS))
    frequent = hits.filter("row IS NULL").select("mark").toArrow()                          # at most HOT_MARKS, 8 bytes each
    hot_marks = np.sort(frequent.column("mark").to_numpy().view(np.uint64))

    by_row = hits.filter("row IS NOT NULL").groupBy("row").agg(F.collect_list("mark").alias("marks"))
    passages = (rows.join(by_row, "row").select("id", "row", "text", "marks")      # no row without an id has marks
                .mapInArrow(lambda it: _passages(it, shards, hot_marks), _Passages.SCHEMA))
    spans = passages.groupBy("shard").applyInArrow(_shard_spans, "row long, id long, start int, size int")
    if len(hot_marks):
        windows = stored(known.select("id", "row", "text").mapInArrow(lambda it: _hot_windows(it, shards, hot_marks), WINDOWS),
                         "windows", compression="zstd")
        firsts = (windows.select("shard", "text", F.array_min("ids").alias("id")).groupBy("shard", "text").agg(F.min("id").alias("id"))
                  .groupBy("shard").applyInArrow(_shard_firsts, "text binary, first long"))
        seen = windows.join(firsts, "text").filter(F.array_max("ids") > F.col("first")).select("unit", "ids", "rows", "starts", "first")
        spans = spans.unionByName(seen.groupBy("unit").applyInArrow(_window_spans, "row long, id long, start int, size int"))
    by_row = spans.groupBy("row").agg(F.collect_set(F.struct("id", "start", "size")).alias("spans"))
    done = rows.join(by_row, "row", "left").select("id", "text", "spans").mapInArrow(
        _kept, "id long, n_words long, n_removed long, kept string, spans array<struct<start:long,size:long>>")
    return done.withColumnRenamed("id", key)
