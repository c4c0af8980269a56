"""Merkle manifest of a dataset, with a witness for every row.

The leaves of a group, in order, form a tree of `ARITY` children: every run of consecutive nodes
becomes the digest of their joined hexadecimal text, until one node, the group's subroot, remains.
The subroots in order of the group names form another such tree, whose apex is the root.

Witnesses grow incrementally. Leaves are appended to a frontier of one open run per level; a node
that is closed knows its siblings at that moment, and the run's digest is appended one level up. The
witness of a leaf is what was attached to the subtrees it came to lie in, from its own run upwards.

Appending is cut into aligned blocks of `SPAN` leaves, a power of the arity, so the run borders of a
block are those of the whole tree. Blocks are grown side by side; their roots are further appends,
again in blocks, until a group has one node. What those appends attached to a block's root extends
the witnesses of all its leaves. No task holds more than a block, whatever the size of a group.

Defined results: groups are ordered null first, then by the bytes of their name in UTF-8; leaves by
id, null first; rows that share an id are ordered by their leaf digest and then by their claim, and
each is a leaf; a null field is written `-`; a lone leaf is its group's subroot and has an empty
witness, as has the subroot of a lone group; extra columns are ignored, whatever their names; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from eventindex.operators.ordinals import with_ordinals
from eventindex.session import new_path

ARITY = 8
HEIGHT = 4                # levels of a block
SPAN = ARITY ** HEIGHT    # leaves of a block
PART_BITS = 14            # so many ordinals, as a power of two, share a row of counts
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def field(value: Column) -> Column:
    """`-` for null, else the count of UTF-8 bytes, a colon, and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(values: list[Column]) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


class Node:
    """A node of a growing tree. What the closing of its run attached to it: the text of the
    digests before and after it, and the node that came of the run."""

    __slots__ = ("digest", "before", "after", "parent")

    def __init__(self, text: str):
        self.digest, self.before, self.after, self.parent = text, "", "", None


class Frontier:
    """An append-only tree of a known height: the open run of each level."""

    def __init__(self, height: int, arity: int = ARITY):
        self.height, self.arity = height, arity
        self.open: list[list[Node]] = [[] for _ in range(height + 1)]

    def append(self, node: Node, level: int = 0) -> None:
        run = self.open[level]
        run.append(node)
        if level < self.height and len(run) == self.arity:
            self.complete(level)

    def complete(self, level: int) -> None:
        """Attach the siblings to the members of the run, and append its digest above."""
        run, self.open[level] = self.open[level], []
        joined = "".join([n.digest for n in run])
        above = Node(digest(joined))
        for i, node in enumerate(run):
            at = i * len(node.digest)
            node.before, node.after, node.parent = joined[:at], joined[at + len(node.digest):], above
        self.append(above, level + 1)

    def close(self) -> Node:
        """The apex, once the short last runs are completed as well."""
        for level in range(self.height):
            if self.open[level]:
                self.complete(level)
        return self.open[self.height][0]


def grow(digests: list[str], height: int) -> tuple[list[Node], str]:
    """The nodes of a block after all appends, and the digest of the block's root."""
    tree, nodes = Frontier(height), [Node(d) for d in digests]
    for node in nodes:
        tree.append(node)
    return nodes, tree.close().digest


def witness(node: Node) -> tuple[list[str], list[str]]:
    """Texts before and after, level by level upwards."""
    before, after = [], []
    while node.parent is not None:
        before.append(node.before)
        after.append(node.after)
        node = node.parent
    return before, after


def height_of(nodes: int) -> int:
    """Levels a block climbs in a group that has so many nodes left."""
    levels = 0
    while levels < HEIGHT and ARITY ** levels < nodes:
        levels += 1
    return levels


class Stored:
    """Tables of this run in the shared folder."""

    def __init__(self, spark, label: str):
        self.spark, self.base, self.n = spark, new_path(spark, label), 0

    def __call__(self, df: DataFrame) -> DataFrame:
        self.n += 1
        path = f"{self.base}/{self.n}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def rank_in_groups(rows: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """Add `rank` (from 0, within `g`) and `n` (rows of the group) without bringing a group into
    one task: rows are sorted and numbered over all groups, and each group's first number is found
    from one row per sort partition and group. Equal rows are told apart by their place, so that
    many of them are spread as well."""
    keys = ("g", *order, "_place")
    listed = with_ordinals(rows.withColumn("_place", F.monotonically_increasing_id()), keys, "_at")
    # a group is spread over many keys, so it is no hot key of the join
    part = F.shiftright("_at", PART_BITS)
    counts = listed.groupBy("g", part.alias("_part")).agg(F.min("_at").alias("_lo"), F.count("*").alias("_c"))
    whole = Window.partitionBy("g")
    firsts = counts.select("g", "_part", F.min("_lo").over(whole).alias("_first"),
                           F.sum("_c").over(whole).alias("n"))
    return (listed.withColumn("_part", part).join(firsts, ["g", "_part"])
            .withColumn("rank", F.col("_at") - F.col("_first"))
            .drop("_part", "_at", "_first", "_place"))


def packed(nodes: DataFrame, *columns: str) -> DataFrame:
    """One row per block: g, block, n, and its nodes in order as arrays."""
    rows = F.array_sort(F.collect_list(F.struct("rank", *columns)))
    return (nodes.groupBy("g", F.floor(F.col("rank") / SPAN).alias("block"), "n")
            .agg(rows.alias("_rows"))
            .select("g", "block", "n", *[F.col(f"_rows.{c}").alias(c) for c in ("rank", *columns)]))


def round_task(batches: Iterator) -> Iterator:
    """Blocks of digests to one row per node, with what the block attached to it."""
    import pyarrow as pa

    text = pa.list_(pa.string())
    schema = pa.schema([("g", pa.string()), ("rank", pa.int64()), ("parent", pa.int64()),
                        ("n", pa.int64()), ("root", pa.string()), ("before", text), ("after", text)])
    for batch in batches:
        for row in batch.to_pylist():
            nodes, root = grow(row["digest"], height_of(row["n"]))
            grown = [witness(node) for node in nodes]
            k = len(nodes)
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["g"]] * k, pa.string()), pa.array(row["rank"], pa.int64()),
                 pa.array([row["block"]] * k, pa.int64()), pa.array([row["n"]] * k, pa.int64()),
                 pa.array([root] * k, pa.string()), pa.array([w[0] for w in grown], text),
                 pa.array([w[1] for w in grown], text)], schema=schema)


ROUND = ("g string, rank bigint, parent bigint, n bigint, root string, before array<string>, "
         "after array<string>")


def lift(keep: Stored, nodes: DataFrame) -> DataFrame:
    """Append nodes (g, rank, n, digest) until each group has one. Returns per node: g, rank, its
    witness (before, after) and the group's apex."""
    rounds = []
    most = nodes.agg(F.max("n")).first()[0] or 0
    while most > 1:
        grown = keep(packed(nodes, "digest").mapInArrow(round_task, ROUND))
        rounds.append(grown)
        nodes = grown.filter(F.col("rank") % SPAN == 0).select(
            "g", F.col("parent").alias("rank"), F.ceil(F.col("n") / SPAN).alias("n"),
            F.col("root").alias("digest"))
        most = -(-most // SPAN)
    none = F.array().cast("array<string>")
    known = nodes.select("g", "rank", none.alias("before"), none.alias("after"), F.col("digest").alias("apex"))
    for grown in reversed(rounds):
        above = known.select("g", F.col("rank").alias("parent"), F.col("before").alias("_b"),
                             F.col("after").alias("_a"), "apex")
        known = grown.join(above, ["g", "parent"]).select(
            "g", "rank", F.concat("before", "_b").alias("before"),
            F.concat("after", "_a").alias("after"), "apex")
    return keep(known)


def block_root_task(batches: Iterator) -> Iterator:
    import pyarrow as pa

    for batch in batches:
        rows = batch.to_pylist()
        yield pa.RecordBatch.from_pydict({
            "g": pa.array([r["g"] for r in rows], pa.string()),
            "rank": pa.array([r["block"] for r in rows], pa.int64()),
            "n": pa.array([-(-r["n"] // SPAN) for r in rows], pa.int64()),
            "digest": pa.array([grow(r["leaf"], height_of(r["n"]))[1] for r in rows], pa.string())})


def witness_task(batches: Iterator) -> Iterator:
    """Blocks with what was attached to their roots, to one row per leaf."""
    import pyarrow as pa

    text = pa.list_(pa.string())
    for batch in batches:
        for row in batch.to_pylist():
            nodes, _ = grow(row["leaf"], height_of(row["n"]))
            grown = [witness(node) for node in nodes]
            k = len(nodes)
            yield pa.RecordBatch.from_pydict({
                "id": pa.array(row["id"], pa.int64()), "leaf": pa.array(row["leaf"], pa.string()),
                "claim": pa.array(row["claim"], pa.string()),
                "subroot": pa.array([row["subroot"]] * k, pa.string()),
                "root": pa.array([row["root"]] * k, pa.string()),
                "before": pa.array([w[0] + row["before"] for w in grown], text),
                "after": pa.array([w[1] + row["after"] for w in grown], text)})


WITNESSES = ("id bigint, leaf string, claim string, subroot string, root string, "
             "before array<string>, after array<string>")


class Leaves(NamedTuple):
    """Columns of a table: the digest of each row's leaf, and the digest claimed for it when the
    witness is checked."""
    leaf: Column
    claim: Column


def witnesses(docs: DataFrame, leaves: Leaves, id_col: str = "doc_id", group_col: str = "lang") -> DataFrame:
    """One row per row of docs: id, leaf, claim, subroot, root, and the witness from the leaf to
    the root as two arrays, the digests before and after the node at each level."""
    keep = Stored(docs.sparkSession, "merkle")
    group = F.col(group_col).cast("string")
    # the order of these keys is that of the groups: null first
    g = F.when(group.isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), group))
    rows = keep(docs.select(g.alias("g"), F.col(id_col).cast("bigint").alias("id"),
                            leaves.leaf.alias("leaf"), leaves.claim.alias("claim")))
    blocks = keep(packed(rank_in_groups(rows, ("id", "leaf", "claim")), "id", "leaf", "claim"))
    roots = blocks.select("g", "block", "n", "leaf").mapInArrow(
        block_root_task, "g string, rank bigint, n bigint, digest string")
    in_group = lift(keep, keep(roots))

    subroots = keep(in_group.groupBy("g").agg(F.max("apex").alias("digest")))
    top = rank_in_groups(subroots.select(F.lit("").alias("g"), F.col("g").alias("name"), "digest"), ("name",))
    top = keep(top)
    over = lift(keep, top.select("g", "rank", "n", "digest")).join(
        top.select(F.col("rank"), F.col("name").alias("g_name")), "rank").select(
        F.col("g_name").alias("g"), F.col("before").alias("_b"), F.col("after").alias("_a"),
        F.col("apex").alias("root"))
    up = in_group.join(over, "g").select(
        "g", F.col("rank").alias("block"), F.col("apex").alias("subroot"), "root",
        F.concat("before", "_b").alias("before"), F.concat("after", "_a").alias("after"))
    return blocks.drop("rank").join(up, ["g", "block"]).mapInArrow(witness_task, WITNESSES)


def proof(before: Column, after: Column) -> Column:
    """The digests of a witness as one text, level by level, left to right."""
    return F.array_join(F.zip_with(before, after, lambda b, a: F.concat(b, a)), "")


def fold(claim: Column, before: Column, after: Column) -> Column:
    """The root that a witness gives for a leaf digest."""
    return F.aggregate(F.arrays_zip(before.alias("b"), after.alias("a")), claim,
                       lambda h, w: F.sha2(F.concat(w["b"], h, w["a"]), 256))
