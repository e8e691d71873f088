"""Operator 13: a Merkle manifest of a data set, and proofs by descent of a content-addressed DAG.

Every row is a leaf.  Each tree (language) orders its leaves by id; while several nodes remain, every two in a row
become their digest, one alone too.  The trees' roots, by language, are the leaves of a last tree.

Build: leaves are ranked over sorted ranges, and a tree is built in segments of ``BITS`` levels: each group of at most 2**BITS
nodes in a row is raised in one task, whatever its tree.  A segment is stored as its records, digest to children, under the
digest of its top, so equal segments are stored once; the tops are the nodes of the next segments.  A tree with
any share of the rows is as many groups as it needs.

Proofs: requests go down from the root.  A request holds the digest of a segment's top and the places asked for
under it; it is joined to the segment's records by that digest, and walks from digest to children by the binary digits
of the place, collecting the children not chosen.  The nodes it reaches are the tops of the next requests, down to the
leaves.  What was collected is in order from the root, so each segment's path is reversed, the lowest first.

Defined cases: a null is written ``-`` and never tampered with; null and equal ids are ordered nulls first, then by leaf;
repeated rows are leaves of their own; a null language is a tree, before the others; a tree of one leaf is that leaf; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm.shared import bounded_batches, stored

BITS = 8                  # levels of a segment: at most 2**BITS nodes under its top
RANGE_ROWS = 500_000      # leaves of a sorted range, about

RECORDS = "array<struct<digest:string,children:array<string>>>"
SEGMENT = f"tree string, place long, digest string, levels int, records {RECORDS}"
REACHED = "tree string, place long, digest string, path array<struct<side:int,digest:string>>"
STEP = pa.struct([("side", pa.int32()), ("digest", pa.string())])


def digest(*inputs: str) -> str:
    return sha256("".join(inputs).encode()).hexdigest()


def _field(value: Column) -> Column:
    """``-`` for null, else the length in UTF-8 bytes, a colon and the value."""
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf(*fields: Column) -> Column:
    return F.sha2(F.concat(*(_field(f.cast("string")) for f in fields)), 256)


def ranked(leaves: DataFrame, tree: str = "tree", order: tuple = ("doc_id", "leaf")) -> DataFrame:
    """``leaves`` with ``rank`` (from 0) inside its tree, and ``size`` of the tree, as a stored table.  Sorted ranges number their rows;
    what comes before a range in its tree is a sum over one small row for each range and tree."""
    spark = leaves.sparkSession
    by = [F.col(c).asc_nulls_first() for c in (tree, *order)]
    parts = max(spark.sparkContext.defaultParallelism, -(-leaves.count() // RANGE_ROWS))
    rows = stored(leaves.repartitionByRange(parts, *by).sortWithinPartitions(*by).withColumn("_seq", F.monotonically_increasing_id())
                  .withColumn("_part", F.shiftright("_seq", 33)), "leaves")
    ranges = rows.groupBy(F.col(tree).alias("_t"), F.col("_part").alias("_p")).agg(F.min("_seq").alias("_low"), F.count("*").alias("_n"))
    whole = Window.partitionBy("_t")
    before = whole.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("_t", "_p", "_low", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"), F.sum("_n").over(whole).alias("size"))
    placed = rows.join(ranges, (F.col(tree) == F.col("_t")) & (F.col("_part") == F.col("_p")))
    return stored(placed.select(*leaves.columns, (F.col("_before") + F.col("_seq") - F.col("_low")).alias("rank"), "size"), "ranked")


def _raise(group: pa.Table, bits: int) -> pa.Table:
    """One segment: its nodes raised by as many levels as its tree still needs, ``bits`` at most."""
    group = group.sort_by("place")
    tree, place, size = (group.column(c)[0].as_py() for c in ("tree", "place", "size"))
    nodes, levels, records = group.column("digest").to_pylist(), min(bits, (size - 1).bit_length()), {}
    for _ in range(levels):
        up = []
        for i in range(0, len(nodes), 2):
            top = digest(*nodes[i:i + 2])
            records[top] = nodes[i:i + 2]
            up.append(top)
        nodes = up
    rows = [{"tree": tree, "place": place >> bits, "digest": nodes[0], "levels": levels,
             "records": [{"digest": d, "children": c} for d, c in records.items()]}]
    return pa.Table.from_pylist(rows, schema=pa.schema([
        ("tree", pa.string()), ("place", pa.int64()), ("digest", pa.string()), ("levels", pa.int32()),
        ("records", pa.list_(pa.struct([("digest", pa.string()), ("children", pa.list_(pa.string()))])))]))


def build(nodes: DataFrame, bits: int = BITS) -> list[DataFrame]:
    """Segments of all trees from the leaves up, one stored table for each ``bits`` levels, from ``tree, place, digest, size`` (places
    from 0, ``size`` the tree's nodes).  In the last table every tree has one segment, its root."""
    segments = []
    while True:
        up = (nodes.withColumn("segment", F.shiftright("place", bits)).groupBy("tree", "segment")
              .applyInArrow(lambda group: _raise(group, bits), SEGMENT))
        segments.append(stored(up, "segments", compression="zstd"))
        if segments[-1].filter("place > 0").isEmpty():
            return segments
        sizes = segments[-1].groupBy("tree").agg((F.max("place") + 1).alias("size"))
        nodes = segments[-1].select("tree", "place", "digest").join(sizes, "tree")


def walk(top: str, records: dict[str, list[str]], levels: int, place: int) -> tuple[str, list[dict]]:
    """The node ``levels`` under ``top`` at ``place``, and the children not chosen on the way, from the top down: on which
    side each lies (0 left, 1 right, -1 there is none)."""
    path = []
    for level in range(levels - 1, -1, -1):
        children, side = records[top], place >> level & 1
        path.append({"side": 1 - side, "digest": children[1 - side]} if len(children) > 1 else {"side": -1, "digest": ""})
        top = children[side]
    return top, path


def _descend(batches):
    """The nodes that requests ask for under their segment's top, each with its path from the lowest level up."""
    schema = pa.schema([("tree", pa.string()), ("place", pa.int64()), ("digest", pa.string()), ("path", pa.list_(STEP))])
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            records = {x["digest"]: x["children"] for x in r["records"]}
            for place in r["places"]:
                node, path = walk(r["digest"], records, r["levels"], place)
                out.append({"tree": r["tree"], "place": place, "digest": node, "path": path[::-1] + r["path"]})
        yield pa.RecordBatch.from_pylist(out, schema=schema)


def _records(segments: DataFrame) -> DataFrame:
    """Each different segment once, by the digest of its top.  (Equal tops have equal records, whatever their place.)"""
    return segments.groupBy("digest", "levels").agg(F.first("records").alias("records"))


def descend(roots: DataFrame, segments: list[DataFrame], bits: int = BITS) -> DataFrame:
    """``tree, place, digest, path`` of the tops of the lowest segments, from ``roots`` (the same columns, place 0) down."""
    reached = roots
    for upper, lower in zip(segments[:0:-1], segments[-2::-1]):
        places = (lower.select("tree", "place", F.shiftright("place", bits).alias("parent")).groupBy("tree", "parent")
                  .agg(F.collect_list("place").alias("places")))           # at most 2**bits
        asked = (reached.withColumnRenamed("place", "parent").join(places, ["tree", "parent"]))
        reached = stored(asked.join(_records(upper), "digest").select("tree", "digest", "path", "places", "levels", "records")
                         .mapInArrow(_descend, REACHED), "reached", compression="zstd")
    return reached


def fold(node: str, path: list[dict]) -> str:
    """The root that a leaf and its siblings give."""
    for step in path:
        node = digest(node) if step["side"] < 0 else digest(step["digest"], node) if step["side"] == 0 else digest(node, step["digest"])
    return node


def _prove(batches):
    schema = pa.schema([("doc_id", pa.int64()), ("leaf", pa.string()), ("subroot", pa.string()), ("root", pa.string()),
                        ("proof", pa.list_(STEP)), ("folded_root", pa.string())])
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            records = {x["digest"]: x["children"] for x in r["records"]}
            for x in r["leaves"]:
                node, path = walk(r["digest"], records, r["levels"], x["rank"])
                if node != x["leaf"]:
                    raise ValueError(f"the stored tree has {node} where document {x['doc_id']} has {x['leaf']}")
                proof = path[::-1] + r["path"]
                out.append({"doc_id": x["doc_id"], "leaf": node, "subroot": r["subroot"], "root": r["root"], "proof": proof,
                            "folded_root": fold(x["seen"], proof)})
        yield pa.RecordBatch.from_pylist(out, schema=schema)


def manifest_proofs(leaves: DataFrame, bits: int = BITS) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof, folded_root, verified`` for each row of ``tree, doc_id, leaf, seen``: ``proof`` lists the
    siblings from the leaf up, ``seen`` is the leaf as it is now, and ``folded_root`` what it and the siblings give."""
    bounded_batches(leaves.sparkSession)
    rows = ranked(leaves)
    trees = build(rows.select("tree", F.col("rank").alias("place"), F.col("leaf").alias("digest"), "size"), bits)
    subroots = ranked(trees[-1].select("tree", F.col("digest").alias("leaf"), F.lit("").alias("doc_id"), F.lit("").alias("all")),
                      "all", ("tree",))
    top = build(subroots.select(F.lit("").alias("tree"), F.col("rank").alias("place"), F.col("leaf").alias("digest"), "size"), bits)
    empty = F.array().cast("array<struct<side:int,digest:string>>")
    root = top[-1].select("tree", "place", "digest", empty.alias("path"))
    reached = descend(root, top, bits)
    asked = (subroots.select(F.shiftright("rank", bits).alias("place"), "rank").groupBy("place").agg(F.collect_list("rank").alias("places")))
    found = (reached.join(asked, "place").join(_records(top[0]), "digest")
             .select("tree", "digest", "path", "places", "levels", "records").mapInArrow(_descend, REACHED))
    roots = stored(found.select(F.col("place").alias("rank"), "digest", "path").join(subroots.select("tree", "rank"), "rank")
                   .select("tree", F.lit(0).cast("long").alias("place"), "digest", "path"), "subroots")
    tops = descend(roots, trees, bits)
    requests = (rows.groupBy("tree", F.shiftright("rank", bits).alias("place"))
                .agg(F.collect_list(F.struct("rank", "doc_id", "leaf", "seen")).alias("leaves")))            # at most 2**bits
    known = roots.select("tree", F.col("digest").alias("subroot"))
    proved = (tops.join(requests, ["tree", "place"]).join(known, "tree").join(_records(trees[0]), "digest")
              .crossJoin(F.broadcast(root.select(F.col("digest").alias("root"))))                            # one row
              .select("digest", "path", "levels", "records", "leaves", "subroot", "root")
              .mapInArrow(_prove, "doc_id long, leaf string, subroot string, root string, "
                                  "proof array<struct<side:int,digest:string>>, folded_root string"))
    return proved.withColumn("verified", F.col("folded_root") == F.col("root"))


def document_leaves(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """``tree, doc_id, leaf, seen`` of documents; rows where ``tampered`` holds are seen with one character more counted."""
    known, count = [F.col(c) for c in ("doc_id", "source", "lang")], F.col("n_chars").cast("long")
    seen = count if tampered is None else F.when(tampered, count + 1).otherwise(count)
    tree = F.coalesce(F.concat(F.lit("."), F.col("lang").cast("string")), F.lit(""))        # null: before all others
    return docs.select(tree.alias("tree"), F.col("doc_id").cast("long").alias("doc_id"), leaf(*known, count, F.col("text")).alias("leaf"),
                       leaf(*known, seen, F.col("text")).alias("seen"))
