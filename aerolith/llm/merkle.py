"""A Merkle manifest of a table: a leaf per row, a tree per group, a tree over
the groups' roots, and for every row the proof that leads from its leaf to the
root and what that proof gives for a second, possibly altered, copy of the row.

Hashes are lowercase hex SHA-256 of their inputs in a row; digests go in as hex
text. Leaves and altered leaves are made by SQL functions alone, so texts never
leave the scan's tasks. A group's leaves are numbered in a distributed sort: one
small row per task and group turns places in a task into places in the group.

Then subtrees are exchanged. ``RUN ** LEVELS`` leaves in a row are a superblock;
it is reduced to one node, and the nodes of superblocks are leaves of the next
round, until each group has one. On the way back, each superblock is cogrouped
with the one row of outer nodes (what stands left and right of its path up to the
root) that it needs: that call reduces its leaves again, joins the inner and outer
parts of every proof and folds them. A task sees ``RUN ** LEVELS`` nodes and one
path at a time, whatever the group's size.

Defined results: null fields are written as ``-``; rows of a null group are a group
of their own that comes first; rows without an id come first in their group; rows
of equal id are ordered by their leaf, so repeated rows change nothing but their
number; an altered copy that equals the row verifies; an empty table has no rows;
only the named columns are read, whatever other columns are called.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolith.llm import common as C

#: Nodes hashed together.
RUN = 8
#: Levels of a superblock: a task holds RUN ** LEVELS nodes of it.
LEVELS = 3
_SIDE = RUN ** LEVELS
_NODE = "g string, i long, n long, h string"
_OUTER = "g string, i long, lefts array<string>, rights array<string>, subroot string, root string"


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def leaf(fields: Sequence[str], altered: Mapping[str, Column] | None = None) -> Column:
    """The hash of a row's fields, each as ``-`` if null, else its UTF-8 byte
    count, a colon and the value."""
    parts = []
    for name in fields:
        value = (altered or {}).get(name, F.col(name)).cast("string")
        parts.append(F.when(value.isNull(), F.lit("-")).otherwise(
            F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)))
    return F.sha2(F.concat(*parts), 256)


def numbered(rows: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """``rows`` (with a group column ``g``), written in the order of ``g`` and
    ``order``, with each row's place ``i`` in its group and the group's size ``n``."""
    placed = C.stored(
        rows.repartitionByRange("g", *order).sortWithinPartitions("g", *order)
        .withColumn("part", F.spark_partition_id())
        .withColumn("pos", F.monotonically_increasing_id()), name)
    # One row per task and group: small, and a group's share is a row per task.
    runs = placed.groupBy("g", "part").agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("first"))
    whole = Window.partitionBy("g")
    upto = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = C.stored(runs.select(
        "g", "part", (F.coalesce(F.sum("n").over(upto), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("n").over(whole).alias("n")), name + "-runs")
    return placed.join(C.few(shifts), ["g", "part"]) \
        .withColumn("i", F.col("pos") + F.col("shift")).drop("part", "pos", "shift")


def _levels(hashes: list[str], n: int) -> list[list[str]]:
    """A superblock's levels from its nodes up to its one node. ``n`` is the
    number of nodes of the whole group at this level: a group of more than a
    superblock goes up all levels, a smaller one until one node remains."""
    out = [hashes]
    while len(out) <= LEVELS and n > 1:
        low = out[-1]
        out.append([digest("".join(low[k:k + RUN])) for k in range(0, len(low), RUN)])
        n = -(-n // RUN)
    return out


def _reduce(nodes: pd.DataFrame) -> pd.DataFrame:
    nodes = nodes.sort_values("i")
    n = int(nodes["n"].iloc[0])
    top = _levels(nodes["h"].tolist(), n)[-1]
    return pd.DataFrame({"g": [nodes["g"].iloc[0]], "i": [int(nodes["i"].iloc[0]) // _SIDE],
                         "n": [-(-n // _SIDE)], "h": top})


def _up(nodes: DataFrame, name: str) -> list[DataFrame]:
    """The nodes, their superblocks' nodes, and so on to one node a group."""
    tables = [nodes.select("g", "i", "n", "h")]
    most = tables[0].agg(F.max("n")).first()[0] or 1
    while most > 1:
        tables.append(C.stored(
            tables[-1].groupBy("g", F.expr(f"i div {_SIDE}").alias("b"))
            .applyInPandas(_reduce, _NODE), f"{name}-{len(tables)}"))
        most = -(-most // _SIDE)
    return tables


def _paths(hashes: list[str], n: int) -> tuple[list[list[str]], list[list[str]]]:
    """For each node of a superblock, what stands left and right of its path
    inside the superblock, level by level."""
    levels = _levels(hashes, n)
    lefts: list[list[str]] = [[] for _ in hashes]
    rights: list[list[str]] = [[] for _ in hashes]
    for up, level in enumerate(levels[:-1]):
        runs = ["".join(level[k:k + RUN]) for k in range(0, len(level), RUN)]
        for k in range(len(hashes)):
            at = k // RUN ** up
            run, cut = runs[at // RUN], 64 * (at % RUN)
            lefts[k].append(run[:cut])
            rights[k].append(run[cut + 64:])
    return lefts, rights


def _cogrouped(nodes: DataFrame, outer: DataFrame):
    """A superblock's nodes beside its one row of outer nodes."""
    block = F.expr(f"i div {_SIDE}").alias("b")
    return nodes.groupBy("g", block).cogroup(outer.groupBy("g", F.col("i").alias("b")))


def _outer(nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
    """The outer nodes of each node of a superblock."""
    nodes, o = nodes.sort_values("i"), outer.iloc[0]
    lefts, rights = _paths(nodes["h"].tolist(), int(nodes["n"].iloc[0]))
    return pd.DataFrame({
        "g": nodes["g"], "i": nodes["i"], "lefts": [x + list(o["lefts"]) for x in lefts],
        "rights": [x + list(o["rights"]) for x in rights],
        "subroot": o["subroot"], "root": o["root"]}, index=nodes.index)


def _down(tables: list[DataFrame], outer: DataFrame, name: str) -> DataFrame:
    """From the outer nodes of the groups' roots to those of the superblocks."""
    for k, nodes in enumerate(reversed(tables[1:-1])):
        outer = C.stored(_cogrouped(nodes, outer).applyInPandas(_outer, _OUTER), f"{name}-{k}")
    return outer


def _folded(nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
    """Finish a superblock of leaves: its proofs, joined and folded."""
    nodes, o = nodes.sort_values("i"), outer.iloc[0]
    lefts, rights = _paths(nodes["h"].tolist(), int(nodes["n"].iloc[0]))
    up = list(zip(o["lefts"], o["rights"]))
    beyond = "".join(a + b for a, b in up)
    proofs, folds = [], []
    for left, right, node in zip(lefts, rights, nodes["second"]):
        proofs.append(digest("".join(a + b for a, b in zip(left, right)) + beyond))
        for a, b in zip(left, right):
            node = digest(a + node + b)
        for a, b in up:
            node = digest(a + node + b)
        folds.append(node)
    return pd.DataFrame({
        "id": nodes["id"], "grp": nodes["grp"], "leaf": nodes["h"], "subroot": o["subroot"],
        "root": o["root"], "proof_sha256": proofs, "folded_root": folds,
        "verified": [x == o["root"] for x in folds]}, index=nodes.index)


def manifest(rows: DataFrame, fields: Sequence[str], id_col: str, group_col: str,
             altered: Mapping[str, Column] | None = None,
             where: Column | None = None) -> DataFrame:
    """Per row: the id, the group, ``leaf``, the group's ``subroot``, ``root``,
    ``proof_sha256`` (of the siblings on the way to the root), ``folded_root``
    (from a second leaf and the same siblings) and ``verified``. The second leaf
    holds the ``altered`` fields in rows ``where`` that is true, else it is the
    first one."""
    first = leaf(fields)
    second = F.when(where, leaf(fields, altered)).otherwise(first) if altered else first
    group = F.col(group_col).cast("string")
    leaves = numbered(
        rows.select(F.col(id_col).cast("long").alias("id"), group.alias("grp"),
                    F.when(group.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), group)).alias("g"),
                    first.alias("h"), second.alias("second")),
        ["id", "h", "second"], "leaves")
    # As text, an id beside a null one keeps all its digits in pandas.
    leaves = leaves.withColumn("id", F.col("id").cast("string"))
    trees = _up(leaves, "nodes")
    # The groups' roots, in the order of groups, are the leaves of one more tree.
    roots = numbered(trees[-1].select(F.lit("").alias("g"), F.col("g").alias("of"), "h"), ["of"],
                     "subroots")
    crown = _up(roots, "crown")
    none = F.array().cast("array<string>")
    start = C.stored(crown[-1].select("g", "i", none.alias("lefts"), none.alias("rights"),
                                      F.lit("").alias("subroot"), F.col("h").alias("root")), "root")
    over = _cogrouped(crown[0], _down(crown, start, "crown-outer")).applyInPandas(_outer, _OUTER)
    groups = C.stored(
        over.drop("g", "subroot").join(C.few(roots.select("i", "of", F.col("h").alias("subroot"))), "i")
        .select(F.col("of").alias("g"), F.lit(0).cast("long").alias("i"), "lefts", "rights",
                "subroot", "root"), "groups")
    schema = ("id string, grp string, leaf string, subroot string, root string, "
              "proof_sha256 string, folded_root string, verified boolean")
    out = _cogrouped(leaves, _down(trees, groups, "outer")).applyInPandas(_folded, schema)
    return out.withColumn("id", F.col("id").cast("long")) \
        .withColumnsRenamed({"id": id_col, "grp": group_col})
