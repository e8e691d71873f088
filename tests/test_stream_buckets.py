"""Keys of the streaming dedup that share a bucket of state, against plain Python with a state for each key."""

import datetime as dt
import json
import os
import random

from pulse.streaming import dedup_stream, dedup_tables, kept_posts, post_stream, to_table, trigger_options
from pulse.streaming.queries import keyed_state

T0 = dt.datetime(2024, 1, 1, tzinfo=dt.UTC)
HOUR = 60


def _kept(batches, ttl=HOUR, lateness=HOUR):
    """(key, minute) of the copies kept; the watermark moves after each batch, and then copies are forgotten."""
    out, memory, mark, newest = [], {}, None, None
    for rows in batches:
        for key in sorted({k for k, _ in rows}):
            copies = memory.setdefault(key, [])
            for t in sorted({t for k, t in rows if k == key}, key=lambda t: (t is not None, t)):
                if any(t is not None and k is not None and abs(t - k) < ttl for k, _ in copies) or (t is None and copies):
                    continue
                since = max((x for x in (t, mark) if x is not None), default=None)
                copies.append((t, None if since is None else since + ttl))
                out.append((key, t))
        newest = max([t for _, t in rows if t is not None] + [newest or 0])
        mark = newest - lateness
        for key, copies in memory.items():
            memory[key] = [(t, u) for t, u in ((t, mark + ttl if until is None else until) for t, until in copies) if u >= mark]
    return out


def test_keys_that_share_a_bucket_are_kept_apart(spark, scratch):
    rng = random.Random(4)
    batches = [[(f"k{rng.randrange(30)}", rng.choice([None, *range(90 * i, 90 * i + 150)])) for _ in range(120)] for i in range(4)]
    batches.append([(k, 900) for k, _ in batches[0]] + [("k1", 20), ("k2", 20), ("k2", None)])
    batches.append([(k, t) for rows in batches[:3] for k, t in rows])          # all forgotten by now, except what the last batch brought
    src, out, timers = f"{scratch}/in", f"{scratch}/out", []
    os.makedirs(src)
    for i, rows in enumerate(batches):
        lines = [{"id": k, "text": "x", "username": str(t), "timestamp": None if t is None else (T0 + dt.timedelta(minutes=t)).isoformat()} for k, t in rows]
        with open(f"{src}/{i}.json", "w") as f:
            f.write("\n".join(map(json.dumps, lines)) + "\n")
        q = to_table(dedup_stream(post_stream(spark, src), columns=["id", "username"], buckets=3), "buckets", "append",
                     trigger_options(available_now=True), f"{scratch}/checkpoint", fmt="parquet", path=out)
        q.awaitTermination(120)
        timers += [op["customMetrics"]["numRegisteredTimers"] for p in q.recentProgress for op in p["stateOperators"]]
    got = sorted((r.id, r.username) for r in spark.read.schema("id string, username string").parquet(out).collect())
    assert got == sorted((k, str(t)) for k, t in _kept(batches))
    assert 0 < max(timers) <= 2 * 3            # not one for each of some hundred copies


def test_tables_set_a_timer_for_a_bucket_not_for_each_copy(spark, scratch):
    """Twenty keys with thirty hourly copies each, all kept; a repeat of each is dropped, and what has expired goes at once."""
    src, root, seen = f"{scratch}/in", f"{scratch}/tables", []
    os.makedirs(src)
    hourly = [(f"k{k}", 60 * h) for k in range(20) for h in range(30)]
    for i, rows in enumerate((hourly, [(f"k{k}", 60 * 29 + 30) for k in range(20)])):
        lines = [{"id": k, "text": "x", "username": str(t), "timestamp": (T0 + dt.timedelta(minutes=t)).isoformat()} for k, t in rows]
        with open(f"{src}/{i}.json", "w") as f:
            f.write("\n".join(map(json.dumps, lines)) + "\n")
        queries = dedup_tables(post_stream(spark, src), root, "timers", trigger=trigger_options(available_now=True))
        for q in queries:
            q.awaitTermination(120)
        seen += [op["customMetrics"]["numRegisteredTimers"] for p in queries[1].recentProgress for op in p["stateOperators"]]
    assert sorted((r.id, r.username) for r in kept_posts(spark, root, ["id", "username"]).collect()) == sorted((k, str(t)) for k, t in hourly)
    assert 0 < max(seen) <= 20                  # not 600


def test_state_stores_take_no_disk_ahead(spark):
    keyed_state(spark)
    assert spark.conf.get("spark.sql.streaming.stateStore.rocksdb.allowFAllocate") == "false"
