"""Merkle manifest of a dataset: a tree for each group of rows, and one tree over their roots.

Nodes carry the interval of leaf ranks that they cover. A level is made from the one below by grouping `FAN` neighbours,
so a group of any size is no task's work. Going down again, every node is attached to its parent by an equality join on
the parent's bucket (the node's place divided by FAN) that checks containment of the intervals; what is left of the
parent's interval without the node's own, on either side, are its siblings. A bucket has FAN nodes at most, so no join
key is hot, and the leaves are never shuffled for their proofs: they lie in the row of their parent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .shared import dropped, offsets, written

FAN = 8
#: Rows of a range, on average, in which leaves are put in order.
ROWS = 20_000


def field(value: Column) -> Column:
    """`-` for null, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(*values: Column) -> Column:
    """SHA-256, in lowercase hex, of the fields one after the other."""
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings of its path make."""
    return F.aggregate(path, leaf, lambda h, s: F.sha2(F.concat(s.left, h, s.right), 256))


def proof_hash(path: Column) -> Column:
    """SHA-256 of all siblings of a path, from the leaf up, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s.left, s.right)), ""), 256)


def ranked(rows: DataFrame, tree: str, order: list[str], size: int = ROWS) -> tuple[DataFrame, DataFrame]:
    """`rows` with rank (from 0, in that order within the tree) and n (rows of the tree), and the table behind it, to be dropped
    in the end. `order` must leave no ties.

    Rows are sorted by ranges of the whole table; what stands before a range comes from the counts of ranges."""
    parts = max(1, rows.count() // size)
    place = F.monotonically_increasing_id()  # 31 bits of partition, 33 bits of place in it
    sorted_ = rows.repartitionByRange(parts, tree, *order).sortWithinPartitions(tree, *order).withColumn("place", place)
    sorted_ = written(sorted_.withColumn("part", F.shiftright("place", 33)), "sorted")
    counts = offsets(sorted_.groupBy(tree, "part").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("least")), [tree], "part")
    sizes = counts.groupBy(tree).agg(F.sum("n").alias("all"))
    starts = counts.join(sizes, tree).select(tree, "part", (F.col("before") - F.col("least")).alias("shift"), "all")
    return sorted_.join(starts, [tree, "part"]).withColumn("rank", F.col("place") + F.col("shift")).withColumn("n", F.col("all")).drop("place", "part", "shift", "all"), sorted_


def levels(leaves: DataFrame, carried: list[str], fan: int = FAN) -> list[DataFrame]:
    """Tables of inner nodes, from the leaves' parents up: tree, n, at (place in the level), a, b (leaf ranks from a up to but
    not b), kids (their a, b and h in order; of the leaves also the carried columns) and h.

    leaves: tree, n, rank, h, carried. A tree of one leaf has a node whose h is the leaf's own."""
    most = leaves.agg(F.max("n")).first()[0] or 0
    nodes = leaves.select("tree", "n", F.col("rank").alias("at"), F.col("rank").alias("a"), (F.col("rank") + 1).alias("b"), "h", *carried)
    tables, width = [], 1
    while width < most or not tables:
        kid = F.struct("a", "b", "h", *(carried if not tables else []))
        made = nodes.where(F.col("n") > width) if tables else nodes
        made = made.groupBy("tree", "n", F.expr(f"at div {fan}").alias("at")).agg(F.sort_array(F.collect_list(kid)).alias("kids"))
        joined = F.sha2(F.array_join(F.transform("kids", lambda k: k.h), ""), 256)
        made = made.select(
            "tree", "n", "at", F.element_at("kids", 1).a.alias("a"), F.element_at("kids", -1).b.alias("b"), "kids", F.when(F.col("n") > 1, joined).otherwise(F.element_at("kids", 1).h).alias("h"),
        )
        tables.append(written(made, "nodes"))
        nodes, width = tables[-1], width * fan
    return tables


def siblings(kids: Column, a: Column, b: Column) -> Column:
    """The hashes of the parent's interval without [a, b), on either side."""
    side = lambda test: F.array_join(F.transform(F.filter(kids, test), lambda k: k.h), "")
    return F.struct(side(lambda k: k.b <= a).alias("left"), side(lambda k: k.a >= b).alias("right"))


def attached(tables: list[DataFrame], tops: DataFrame, fan: int = FAN) -> DataFrame:
    """The leaves' parents with `path` (siblings of the parent's ancestors and itself, from below up) and the columns of `tops`
    (tree, path from the tree's root up, and others), level by level from above."""
    above, width = None, fan ** len(tables)
    rest = [c for c in tops.columns if c not in ("tree", "path")]
    for level, table in reversed(list(enumerate(tables))):
        found = table.where((F.col("n") <= width) & (F.col("n") > width // fan if level else F.lit(True))).join(tops, "tree")
        if above is not None:
            parents = above.select("tree", F.col("at").alias("bucket"), F.col("a").alias("low"), F.col("b").alias("high"), F.col("kids").alias("of"), "path", *rest)
            inner = table.where(F.col("n") > width).withColumn("bucket", F.expr(f"at div {fan}")).join(parents, ["tree", "bucket"])
            inner = inner.where((F.col("low") <= F.col("a")) & (F.col("b") <= F.col("high")))
            found = found.unionByName(inner.withColumn("path", F.concat(F.array(siblings(F.col("of"), F.col("a"), F.col("b"))), "path")).select(*found.columns))
        above, width = found, width // fan
    return above


def manifest(docs: DataFrame, leaf: Column, by: str = "lang", order: str = "doc_id", carry: dict[str, Column] | None = None, fan: int = FAN, rows: int = ROWS) -> DataFrame:
    """The carried columns, leaf, subroot, root and path (array of left and right siblings, as text, from the leaf to the root)
    for every row of `docs`.

    Leaves of a value of `by` ascend by `order` (nulls first; of equals by their hashes, repeated rows side by side), and
    while there are several nodes, each `fan` in a row become the hash of their hashes one after the other (the last ones
    may be fewer, even one). The roots of the values of `by` (null first, then by their bytes) make the root in the same
    way. One leaf is its own root, with an empty path in its tree. Texts of any length are hashed where they are; only
    hashes and carried columns move. An empty table gives none. Other columns of `docs` play no part, whatever their names.
    """
    carry = carry or {}
    names = {name: f"c{k}" for k, name in enumerate(carry)}
    tree = F.coalesce(F.concat(F.lit("+"), F.col(by).cast("string")), F.lit(""))
    base = written(docs.select(tree.alias("tree"), F.col(order).alias("o"), leaf.alias("h"), *[x.alias(names[k]) for k, x in carry.items()]).withColumn("own", F.monotonically_increasing_id()), "leaves")
    leaves, in_order = ranked(base, "tree", ["o", "h", "own"], rows)
    tables = levels(leaves, list(names.values()), fan)
    roots, width = [], 1
    for k, table in enumerate(tables):  # the roots are where a tree has one node left
        roots.append(table.where((F.col("n") <= width * fan) & (F.col("n") > width if k else F.lit(True))).select("tree", "h"))
        width *= fan
    top = roots[0]
    for more in roots[1:]:
        top = top.unionByName(more)
    top = written(top.withColumn("name", F.col("tree")).withColumn("tree", F.lit("")), "roots")
    named, names_in_order = ranked(top, "tree", ["name"], rows)
    above = levels(named, ["name"], fan)
    last = above[-1].select("tree", F.col("h").alias("root"), F.array().cast("array<struct<left:string,right:string>>").alias("path"))
    uppers = _leaves(attached(above, last, fan), ["name"], ["root"])
    tops = written(uppers.select(F.col("name").alias("tree"), F.col("h").alias("subroot"), "root", "path"), "roots")
    out = _leaves(attached(tables, tops, fan), list(names.values()), ["subroot", "root"])
    for done in (base, in_order, top, names_in_order, *above):
        dropped(done)
    return out.select(*[F.col(c).alias(name) for name, c in names.items()], F.col("h").alias("leaf"), "subroot", "root", "path")


def _leaves(parents: DataFrame, carried: list[str], rest: list[str]) -> DataFrame:
    """The leaves of the parents, each with its whole path."""
    kid = F.col("kid")
    one = parents.select("n", "kids", F.col("path").alias("up"), *rest, F.explode("kids").alias("kid"))
    own = F.concat(F.array(siblings(F.col("kids"), kid.a, kid.b)), F.col("up"))
    return one.select(*[kid[c].alias(c) for c in carried], kid.h.alias("h"), *rest, F.when(F.col("n") > 1, own).otherwise(F.col("up")).alias("path"))
