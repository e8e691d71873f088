"""Connected components of a table of links, with joins and grouping only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.shared import stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``id, component`` (smallest id reachable) for every id that a link names.

    Each round every id takes the least label among its neighbours and then its label's own label, so the rounds
    grow with the logarithm of the longest chain.  The minimum is taken in each task before the shuffle, and a
    label with very many ids is on the splittable side of its join.  Each round is a table in the shared folder;
    nothing but the number of changed labels reaches the driver."""
    both = links.select(F.col(a).alias("x"), F.col(b).alias("y"))
    both = stored(both.union(links.select(F.col(b), F.col(a))).filter("x <> y").distinct(), "links")
    label = both.groupBy("x").agg(F.min("y").alias("y")).select(F.col("x").alias("id"), F.least("x", "y").alias("component"))
    while True:
        label = stored(label, "labels")
        near = (both.join(label, both["y"] == label["id"]).groupBy("x")
                .agg(F.min("component").alias("near")))
        took = (label.join(near, label["id"] == near["x"])
                .select("id", "component", F.least("component", "near").alias("next")))
        over = label.select(F.col("id").alias("o"), F.col("component").alias("of"))
        moved = stored(took.join(over, took["next"] == over["o"]).select("id", "component", F.least("next", "of").alias("next")), "moved")
        if moved.filter("next <> component").isEmpty():
            return label
        label = moved.select("id", F.col("next").alias("component"))
