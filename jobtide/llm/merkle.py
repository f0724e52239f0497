"""A Merkle manifest of a table: one tree per group, one over the groups, and a proof for every row.

Rows are leaves in the order of their key. Each partition holds an aligned block of 8^4 leaves and hashes its subtree. Then
partitions swap roots as in a butterfly: in every round aligned groups of eight subtrees meet, each partition of a subtree with one
partition of each of the seven others, and every one of them hashes the common ancestor itself. After the last round each
partition knows the siblings on its way to the root, so nothing has to be sent down again. Groups of rows meet in the same way.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import kept

FANOUT = 8
STEP = T.StructType([T.StructField("before", T.StringType()), T.StructField("after", T.StringType())])
STEP_ARROW = pa.struct([("before", pa.string()), ("after", pa.string())])


def leaf(*fields: Column) -> Column:
    """The digest of some fields: `-` for null, else the number of UTF-8 bytes, a colon and the value, one after the other."""
    said = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.when(s.isNull(), "-").otherwise(F.concat(F.octet_length(s), F.lit(":"), s)) for s in said]), 256)


def folded(digest: Column, proof: Column) -> Column:
    """The root that a leaf's digest and the siblings of its proof lead to."""
    return F.aggregate(proof, digest, lambda node, step: F.sha2(F.concat(step["before"], node, step["after"]), 256))


def proof_digest(proof: Column) -> Column:
    """The digest of all siblings of a proof, level by level and from left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda step: F.concat(step["before"], step["after"])), ""), 256)


def _placed(rows: DataFrame, out: str, *order: str) -> DataFrame:
    """Rows numbered from 0 in an order: sorted in ranges, numbered inside them; each range starts after the sizes of those before."""
    ranges = kept(rows.orderBy(*order).withColumn("_place", F.monotonically_increasing_id()), "ordered")
    ranges = ranges.withColumn("_part", F.shiftright("_place", 33))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    starts = ranges.groupBy("_part").agg(F.count("*").alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return ranges.join(starts, "_part").withColumn(out, F.col("_place").bitwiseAND((1 << 33) - 1) + F.col("_start")).drop("_part", "_place", "_start")


def _levels(digests: list[str], levels: int | None) -> list[list[str]]:
    """The digests and the levels above them: a given number, else until one is left."""
    out = [digests]
    while len(out[-1]) > 1 if levels is None else len(out) <= levels:
        last = out[-1]
        out.append([hashlib.sha256("".join(last[a : a + FANOUT]).encode()).hexdigest() for a in range(0, len(last), FANOUT)])
    return out


def _block_levels(rows: pa.Table, levels: int) -> list[list[str]]:
    """The levels of a block's sorted rows; a block that is not its tree's only one has all its levels."""
    return _levels(rows["leaf"].to_pylist(), levels if rows["leaves"][0].as_py() > FANOUT**levels else None)


def _swap(units: DataFrame, scope: list[str]) -> DataFrame:
    """One round: every partition meets one partition of each other subtree of its group and hashes their common ancestor.

    A subtree `cell` has `members` partitions with ranks from 0. The partition of rank r meets those of rank r; a subtree with
    fewer members than the largest of the group answers by rank r modulo its members. A tree of one cell stays as it is.
    """
    units = units.withColumn("_group", F.floor(F.col("cell") / FANOUT))
    most = units.groupBy(*scope, "_group").agg(F.max("members").alias("_most"))
    sent = units.join(most, [*scope, "_group"]).withColumn("_to", F.explode(F.sequence("rank", F.col("_most") - 1, "members")))
    own = F.struct("tree", "block", "cell", "cells", "rank", "path", "subroot")
    met = sent.groupBy(*scope, "_group", "_to").agg(
        F.array_sort(F.collect_list(F.struct("cell", "members", "node"))).alias("met"),  # at most eight
        F.collect_list(F.when(F.col("_to") == F.col("rank"), own)).alias("own"))
    met = met.select("_group", "met", F.explode("own").alias("own"))
    cell, single = F.col("own.cell"), F.col("own.cells") == 1
    nodes = lambda keep: F.array_join(F.transform(F.filter("met", keep), lambda x: x["node"]), "")
    members = lambda keep: F.aggregate(F.filter("met", keep), F.lit(0).cast("long"), lambda n, x: n + x["members"])
    step = F.struct(nodes(lambda x: x["cell"] < cell).alias("before"), nodes(lambda x: x["cell"] > cell).alias("after"))
    every = lambda x: F.lit(True)
    return met.select(
        "own.tree", "own.block", F.col("_group").alias("cell"), F.ceil(F.col("own.cells") / FANOUT).alias("cells"),
        (F.col("own.rank") + members(lambda x: x["cell"] < cell)).alias("rank"), members(every).alias("members"),
        F.when(single, F.col("met")[0]["node"]).otherwise(F.sha2(nodes(every), 256)).alias("node"),
        F.when(single, F.col("own.path")).otherwise(F.array_append("own.path", step)).alias("path"), "own.subroot")


def _to_the_top(units: DataFrame, scope: list[str]) -> DataFrame:
    """Rounds until every tree is one cell: a third as many as the number of cells has binary digits."""
    while (units.agg(F.max("cells")).first()[0] or 0) > 1:
        units = kept(_swap(units, scope), "swapped")
    return units


def manifest(docs: DataFrame, group: Column, key: Column, digest: Column, shown: Column | None = None, levels: int = 4) -> DataFrame:
    """Every row's place in the tree: (key, leaf, shown, subroot, root, proof).

    The rows of a group are leaves in the order of `key`; `digest` is a row's leaf. While a group has several nodes, each eight
    consecutive ones (the last run: fewer, even one) are hashed to one; what is left is the group's subroot. Subroots, in the
    order of the groups, lead to the root in the same way. `proof` has the siblings of each level, those before and those after.
    `shown` is another digest of the row, for one that is to be checked; null means the same digest. Each partition hashes
    `levels` levels by itself, before partitions meet.

    Nulls are first in both orders. Rows of equal key are ordered by digest; equal rows are leaves each. A lone row is its group's
    subroot and has no siblings there. An empty table gives no rows. Other columns are ignored, whatever their names.
    """
    block = FANOUT**levels
    shown = F.lit(None).cast("string") if shown is None else shown
    leaves = kept(docs.select(group.alias("group"), key.alias("key"), digest.alias("leaf"), shown.alias("shown"), F.monotonically_increasing_id().alias("_n")), "leaves")
    placed = _placed(leaves, "_at", "group", "key", "leaf", "_n")
    trees = _placed(placed.groupBy("group").agg(F.min("_at").alias("_first"), F.count("*").alias("leaves")), "tree", "_first")
    trees = kept(trees.withColumnRenamed("group", "_group"), "trees")
    rows = placed.join(trees, F.col("group").eqNullSafe(F.col("_group"))).withColumn("place", F.col("_at") - F.col("_first"))
    rows = rows.select("tree", F.floor(F.col("place") / block).alias("block"), "place", "leaves", "key", "leaf", "shown")

    def block_root(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("place")
        blocks = -(-rows["leaves"][0].as_py() // block)
        return pa.table({"tree": rows["tree"][:1], "block": rows["block"][:1], "blocks": pa.array([blocks], pa.int64()), "node": [_block_levels(rows, levels)[-1][0]]})

    blocks = rows.select("tree", "block", "place", "leaves", "leaf").groupBy("tree", "block").applyInArrow(block_root, "tree long, block long, blocks long, node string")
    units = kept(blocks.select(
        "tree", "block", F.col("block").alias("cell"), F.col("blocks").alias("cells"), F.lit(0).cast("long").alias("rank"), F.lit(1).cast("long").alias("members"),
        "node", F.array().cast(T.ArrayType(STEP)).alias("path"), F.lit(None).cast("string").alias("subroot")), "units")
    units = _to_the_top(units, ["tree"])
    units = units.withColumns({"subroot": F.col("node"), "cell": F.col("tree"), "cells": F.lit(trees.count())})
    units = _to_the_top(units, [])

    def prove(rows: pa.Table, unit: pa.Table) -> pa.Table:
        rows = rows.sort_by("place")
        nodes, above = _block_levels(rows, levels), unit["path"][0].as_py()
        proofs = []
        for at in range(rows.num_rows):
            proof = []
            for level in nodes[:-1]:
                first = at - at % FANOUT
                proof.append({"before": "".join(level[first:at]), "after": "".join(level[at + 1 : first + FANOUT])})
                at //= FANOUT
            proofs.append(proof + above)
        same = [unit[c].to_pylist() * rows.num_rows for c in ("subroot", "node")]
        return pa.table({"key": rows["key"], "leaf": rows["leaf"], "shown": rows["shown"], "subroot": pa.array(same[0], pa.string()),
                         "root": pa.array(same[1], pa.string()), "proof": pa.array(proofs, pa.list_(STEP_ARROW))})

    text = T.StringType()
    schema = T.StructType([T.StructField("key", rows.schema["key"].dataType), *(T.StructField(c, text) for c in ("leaf", "shown", "subroot", "root")),
                           T.StructField("proof", T.ArrayType(STEP))])
    mine = units.select("tree", "block", "path", "subroot", "node").groupBy("tree", "block")
    return rows.groupBy("tree", "block").cogroup(mine).applyInArrow(prove, schema)


def checked(found: DataFrame) -> DataFrame:
    """What `manifest` returns, with the root that each shown digest leads to, and whether it is the tree's."""
    root = folded(F.coalesce("shown", "leaf"), F.col("proof"))
    return found.withColumn("folded_root", root).withColumn("verified", F.col("folded_root") == F.col("root"))
