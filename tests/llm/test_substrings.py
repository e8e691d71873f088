"""Operator 11 against plain Python: the earliest document of every window."""

import random

import numpy as np
import pyarrow as pa
import pytest

from llm import substrings
from llm.substrings import Automaton, Words, remove_repeats
from tests.llm.helpers import WORDS, awkward_documents, empty_like

WINDOW = substrings.WINDOW


def brute(rows):
    """``(id, words, removed, kept)`` of each ``(id, text)``."""
    cut = [(i, WORDS.findall(t or "")) for i, t in rows]
    first = {}
    for i, w in cut:
        for k in range(len(w) - WINDOW + 1):
            g = tuple(w[k:k + WINDOW])
            if i is not None and (g not in first or i < first[g]):
                first[g] = i
    out = []
    for i, w in cut:
        gone = set()
        for k in range(len(w) - WINDOW + 1):
            if i is not None and first[tuple(w[k:k + WINDOW])] < i:
                gone.update(range(k, k + WINDOW))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in df.collect()), key=str)


def passages(rnd):
    """Shared passages cut and joined anywhere, near copies, repeats inside one text, runs of one word, copies of whole texts."""
    say = lambda n, v=300: [f"w{rnd.randrange(v)}" for _ in range(n)]      # noqa: E731
    shared = [say(rnd.randrange(10, 60)) for _ in range(6)]
    rows = []
    for i in range(120):
        words = say(rnd.randrange(0, 30), 40 if i % 9 == 0 else 4000)
        for _ in range(rnd.randrange(3)):
            p = rnd.choice(shared)
            a = rnd.randrange(len(p))
            words += p[a:a + rnd.randrange(5, 60)] + say(rnd.randrange(4))
        if i % 11 == 0:
            words += words[-20:] * 2 + ["a"] * rnd.randrange(60)
        rows.append((i * 3 % 97 if i % 5 == 0 else 1000 - i, rnd.choice([" ", "\n", " \t "]).join(words)))
    rows += [(2000 + k, rows[k][1]) for k in range(30)] + [(None, rows[3][1]), (None, " ".join(shared[0])), (rows[7][0], rows[7][1])]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("hot", [3, 2000])
def test_equals_brute_force(spark, hot):
    """Also with many marks treated as frequent ones."""
    rows = passages(random.Random(hot))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = remove_repeats(docs, hot=hot)
    assert rows_of(got) == brute(rows)
    for r in got.collect():
        assert r.n_removed == sum(s["size"] for s in r.spans) and all(a["start"] + a["size"] < b["start"] for a, b in zip(r.spans, r.spans[1:]))


def test_awkward_documents(spark):
    docs = awkward_documents(spark)
    got = rows_of(remove_repeats(docs))
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()])
    assert remove_repeats(empty_like(docs)).count() == 0


def test_a_passage_in_a_third_of_the_documents(spark):
    rnd = random.Random(4)
    passage = " ".join(f"p{k}" for k in range(40))
    rows = [(i, (passage if i % 3 == 0 else " ".join(f"u{i}x{k}" for k in range(30))) + f" end{i}") for i in range(900)]
    rnd.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    assert rows_of(remove_repeats(docs, hot=50)) == brute(rows)


def test_automaton_knows_the_first_document_of_every_window():
    rnd = random.Random(1)
    for _ in range(200):
        texts = [(sorted_id, [rnd.randrange(3) for _ in range(rnd.randrange(0, 15))]) for sorted_id in range(rnd.randrange(1, 8))]
        machine = Automaton((w, i) for i, w in texts)
        for n in (1, 2, 4):
            probe = [rnd.randrange(4) for _ in range(20)]
            want = []
            for k in range(len(probe) - n + 1):
                g = probe[k:k + n]
                want.append(min((i for i, w in texts if any(w[a:a + n] == g for a in range(len(w) - n + 1))), default=None))
            assert machine.firsts(probe, n) == want


def test_words_and_marks_follow_the_content():
    rnd = random.Random(6)
    words = [rnd.choice(["a", "bb", "longerthaneight", "x" * 17, "é", "日本"]) + str(rnd.randrange(50)) for _ in range(60)]
    marks = []
    for lead in ("", "one ", "one two three\n"):
        data = ("zz " + lead + " \t".join(words) + " ").encode()
        found = Words(np.frombuffer(data, np.uint8), np.asarray([0, 2, len(data)]))
        assert len(found.start) == len(lead.split()) + 61
        skip = 1 + len(lead.split())
        text, first, count, mark = found.runs()
        assert set(text.tolist()) == {1}
        each = {int(f) + k - skip: int(m) for f, c, m in zip(first, count, mark) for k in range(c)}
        marks.append({k: m for k, m in each.items() if k >= 0})
        assert found.passage(skip, 3) == " ".join(words[:3]).encode()
    assert marks[0] == marks[1] == marks[2] and len(marks[0]) == 60 - WINDOW + 1


def test_sorted_meetings_keep_every_repeated_mark():
    """A bucket answers for each mark that two rows or more hold, whichever task joined them."""
    group = pa.table({"k": [0, 0], "packed": [
        substrings.pack({"mark": np.array([1, 2, 5]), "row": np.array([10, 11, 0]), "n": np.array([1, 1, 3], np.int32)}),
        substrings.pack({"mark": np.array([2, 3, 5]), "row": np.array([20, 21, 22]), "n": np.array([1, 1, 1], np.int32)})]})
    got = substrings._meet(group, 4, hot=10).to_pylist()
    assert sorted((r["row"], r["mark"]) for r in got) == [(11, 2), (20, 2), (22, 5)]
    assert [(r["row"], r["mark"]) for r in substrings._meet(group, 4, hot=3).to_pylist()] == [(11, 2), (20, 2), (None, 5)]
