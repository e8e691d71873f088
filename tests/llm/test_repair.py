"""Operator 12 against a plain search that keeps whole strings."""

import hashlib
import random
import re
import zlib

import pytest

from llm import repair
from llm.queries import QUERIES
from llm.repair import Viterbi, damaged, edits, repair_report, repaired, turns
from tests.llm.helpers import SF, empty_like

WORD = re.compile(r"[^\x20\x09-\x0D]")
GOES = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}


def cheapest(rows, start="", end=None):
    """``(cost, edits, lines)`` for ``(initial, fault, line)`` rows; ``end`` (none: any accepted one) is the last state."""
    def put(best, state, value):
        if state not in best or value[:2] < best[state][:2]:
            best[state] = value

    def inserted(best):
        todo = list(best)
        while todo:
            s = todo.pop()
            for letter, t in GOES[s].items():
                if letter in "ua":
                    c, e, lines = best[s]
                    value = (c + 2, e + "I", lines + (("user:" if letter == "u" else "assistant:"),))
                    if t not in best or value[:2] < best[t][:2]:
                        best[t] = value
                        todo.append(t)
        return best

    best = {start: (0, "", ())}
    for initial, fault, line in rows:
        new = {}
        for s, (c, e, lines) in inserted(best).items():
            put(new, s, (c + 3, e + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            more = fault == "truncated"
            for letter, t in GOES[s].items():
                if letter == initial:
                    put(new, t, (c + more, e + "K", lines + (line,)))
                if letter in "ua":
                    put(new, t, (c + 2 + more, e + "R", lines + ((("user" if letter == "u" else "assistant") + line[line.index(":"):]),)))
        best = new
    if end is not None:
        return best.get(end)
    best = inserted(best)
    return min((best[s] for s in ("", "a") if s in best), key=lambda v: v[:2])


def report(rows, break_them=True):
    space = lambda x: " " if x is None else str(x)      # noqa: E731
    by = {}
    for c, t, r, x in rows:
        mine = by.setdefault(c, [])
        k = zlib.crc32(f"{space(c)}:{space(t)}".encode()) % 20 if break_them else 9
        r, x = space(r), space(x)
        if k:
            x = "" if k == 1 else re.sub("[.!?]", "", x) if k == 2 else x
            mine += [(t, "user" if k == 4 else r, x)] * (2 if k == 3 else 1)
    out = []
    for c, mine in by.items():
        mine.sort(key=lambda y: (y[0] is not None, y[0] or 0, y[1].encode(), y[2].encode()))
        seen, faults = set(), []
        for _, r, x in mine:
            w = WORD.findall(x)
            faults.append("blank" if not w else "duplicate" if (r, x) in seen else "truncated" if w[-1] not in ".!?" else "")
            seen.add((r, x))
        times = [t for t, _, _ in mine if t is not None]
        gaps = max(times) - min(times) + 1 - len(set(times)) if times else 0
        heads = [r[:1] for _, r, _ in mine]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(heads, heads[1:]))
        cost, audit, lines = cheapest([(r[:1], f, f"{r}:{x}") for (_, r, x), f in zip(mine, faults)])
        out.append((c, gaps, *(faults.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


ROW = "conv_id long, turn long, role string, text string"


def random_rows(rnd, n):
    return [(rnd.choice([None, 1, 1, 1, 2, 3, *range(10, 60)]), rnd.choice([None, *range(12)]), rnd.choice(["user", "assistant", "system", "tool", "", None, "user", "assistant"]),
             rnd.choice(["a.", "b!", "c?", " ", "", "x", "y\n", None, "é.", "z \n", "ok?\t", "\x1c"])) for _ in range(n)]


@pytest.mark.parametrize("block", [40, 10_000])
def test_conversations_in_one_block_and_in_many(spark, monkeypatch, block):
    """Null ids, turns, roles and texts, repeated rows, other roles; and a conversation with a third of all rows."""
    monkeypatch.setattr(repair, "BLOCK_ROWS", block)
    rnd = random.Random(block)
    rows = random_rows(rnd, 900)
    rows += [(7, rnd.randrange(5000), rnd.choice(["user", "assistant", "system", "tool"]), f"t{i % 350}" + rnd.choice([".", "", "!"])) for i in range(450)]
    df = spark.createDataFrame(rows, ROW).repartition(5)
    assert sorted(map(tuple, repair_report(damaged(df), df).collect()), key=str) == report(rows)


def test_query_on_its_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = QUERIES["op12_coalescence_viterbi"](spark, SF)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == report(rows)


def test_empty_tables_clashing_columns_and_repaired_rows(spark):
    df = spark.createDataFrame([(1, 0, "user", "Hi."), (1, 1, "user", "Again."), (1, 2, "assistant", "Yes.")], ROW)
    for name in ("seq", "part", "c", "edits", "fault", "first", "place", "nth"):
        df = df.withColumn(name, df["role"])
    assert [tuple(r)[6:8] for r in repair_report(df).collect()] == [(2, "KIKK")]
    rows = turns(df)
    out = repaired(rows, edits(rows)).orderBy("c", "part", "step", "nth").select("role", "text").collect()
    assert list(map(tuple, out)) == [("user", "Hi."), ("assistant", ""), ("user", "Again."), ("assistant", "Yes.")]
    assert repair_report(empty_like(df)).count() == 0 and repair_report(damaged(empty_like(df)), df).collect()[0].audit == ""


def run(rows, start=0, end=None, rest=None):
    machine = Viterbi(start)
    if rest:
        machine.rest = rest
    for at, (initial, fault, _) in enumerate(rows):
        machine.put(at, initial, fault in ("blank", "duplicate"), fault == "truncated")
    return machine, machine.end(end)


def test_survivors_equal_whole_strings():
    """Every tie is settled as by comparing whole strings, also between blocks' states."""
    rnd = random.Random(3)
    names = ["", "s", "u", "a"]
    for _ in range(3000):
        rows = [(rnd.choice("suax"), rnd.choice(["", "", "", "blank", "truncated"]), f"r{i}:x") for i in range(rnd.randrange(0, 14))]
        machine, cost = run(rows)
        want = cheapest(rows)
        assert (cost, "".join(e for e, _, _ in machine.taken)) == want[:2]
        start = rnd.randrange(4)
        left = Viterbi(start)
        for at, (initial, fault, _) in enumerate(rows):
            left.put(at, initial, fault == "blank", fault == "truncated")
        for state, (paid, _) in left.best.items():
            assert paid == cheapest(rows, names[start], names[state])[0]
        strings = [cheapest(rows, names[start], names[s])[1] for s in left.order()]
        assert strings == sorted(strings)


def test_edits_are_emitted_while_rows_come_and_memory_stays_bounded():
    import gc

    rnd = random.Random(5)
    machine, most = Viterbi(), 0
    for at in range(20_000):
        machine.put(at, rnd.choice("uuaasx"), at % 7 == 0, at % 5 == 0)
        if at % 1000 == 999:
            most = max(most, max(n.depth for _, n in machine.best.values()) - machine.root.depth)
            assert len(machine.taken) > 100
            machine.taken.clear()
    gc.collect()
    assert most < 200 and sum(isinstance(o, repair._Node) for o in gc.get_objects()) < 2000
