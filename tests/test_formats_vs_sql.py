"""Fixed-point text and 6-place rounding: Spark and the SQL used as oracle agree,
including on ties such as -0.0640625 and 0.125."""

import random

import duckdb
from pyspark.sql import functions as F

from pulse.functions.text import fixed
from pulse.plans.oracle import fmt, r6


def _values():
    rnd = random.Random(11)
    vals = [0.125, -0.125, 1.005, 0.04625, -0.0640625, 2.5e-05, -3.3e-06, 0.0, 1.0, -1.0, 0.6, -0.6]
    vals += [s / (100 * h) for s, h in ((rnd.randint(-100 * h, 100 * h), h)
                                        for h in (rnd.randint(1, 5000) for _ in range(3000)))]
    vals += [k * 0.1 / n for k, n in ((rnd.randint(-10, 10), rnd.randint(1, 300)) for _ in range(2000))]
    return vals


def test_fixed_and_round_match_sql(spark):
    vals = _values()
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i long, x double")
    got = {r.i: (r.f4, r.f3, r.f2, r.f1, r.r) for r in df.select(
        "i", fixed("x", 4).alias("f4"), fixed("x", 3).alias("f3"), fixed("x", 2).alias("f2"),
        fixed("x", 1).alias("f1"), (F.round("x", 6) + F.lit(0.0)).alias("r")).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE t(i BIGINT, x DOUBLE)")
    con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(vals)))
    rows = con.execute(f"SELECT i, {fmt('x', 4)}, {fmt('x', 3)}, {fmt('x', 2)}, {fmt('x', 1)}, {r6('x')} "
                       "FROM t").fetchall()
    bad = [(vals[i], got[i], tuple(r)) for i, *r in rows if got[i] != tuple(r)]
    assert not bad, bad[:5]
