"""A Merkle manifest of a dataset: one root for all rows, and folds that tell which rows changed.

Rows of a group, in the order of their keys, are the leaves of its tree; the roots of the groups,
in the order of the groups, are the leaves of the tree above. A parent is the SHA-256 of up to 16
children one after the other. While a parent is hashed, a copy of the hash state is kept before
each child, so that a changed child costs what is right of it only: the fold resumes the kept
state with the new digest and the siblings on the right.

Spark deals whole subtrees of 256 neighbouring nodes to tasks, round by round, until a group has
one node; the path above a subtree is worked out once and serves all its leaves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweave.llm.running import laid, running

#: Children of a parent, levels of a subtree, and its leaves.
FAN_OUT = 16
LEVELS = 2
SPAN = FAN_OUT ** LEVELS

PATH = "array<struct<left:string,right:string>>"


def digest(columns: Sequence[Column]) -> Column:
    """SHA-256 over values as ``length:value`` (bytes of UTF-8; null: ``-``), in lowercase hex."""
    texts = [c.cast("string") for c in columns]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts), 256)


class Parent:
    """A node with its children's digests and the hash state before each of them."""

    def __init__(self, children: Sequence[str]):
        self.joined = "".join(children).encode()
        self.size = len(children[0])
        self.states = []
        state = hashlib.sha256()
        for child in children:
            self.states.append(state.copy())
            state.update(child.encode())
        self.digest = state.hexdigest()

    def left(self, slot: int) -> bytes:
        return self.joined[: slot * self.size]

    def right(self, slot: int) -> bytes:
        return self.joined[(slot + 1) * self.size:]

    def resumed(self, slot: int, child: str) -> str:
        """The digest with another child in the slot."""
        state = self.states[slot].copy()
        state.update(child.encode())
        state.update(self.right(slot))
        return state.hexdigest()


def grown(leaves: Sequence[str], levels: int) -> list[list[Parent]]:
    """The parents of each level above the leaves."""
    made, nodes = [], leaves
    for _ in range(levels):
        row = [Parent(nodes[k: k + FAN_OUT]) for k in range(0, len(nodes), FAN_OUT)]
        made.append(row)
        nodes = [p.digest for p in row]
    return made


def levels_of(nodes: int) -> int:
    """Levels between so many nodes and one, within a subtree's levels."""
    levels = 0
    while nodes > 1 and levels < LEVELS:
        nodes, levels = -(-nodes // FAN_OUT), levels + 1
    return levels


class Manifest(NamedTuple):
    """``leaves``: every row as leaf (_key, _group, _at, _leaf, _new); ``above``: per subtree of
    leaves the path from its root to the dataset's (_group, _tree, path, subroot, root)."""

    leaves: DataFrame
    above: DataFrame


def _sized(nodes: DataFrame) -> DataFrame:
    """Nodes with the number of nodes of their group."""
    return nodes.join(nodes.groupBy("_group").agg(F.count("*").alias("_n")), "_group").withColumn(
        "_tree", F.floor(F.col("_at") / SPAN).cast("long"))


def _rooted(frame: pd.DataFrame) -> pd.DataFrame:
    """The root of one subtree."""
    leaves = frame.sort_values("_at")["_leaf"].tolist()
    parents = grown(leaves, levels_of(int(frame["_n"].iloc[0])))
    return pd.DataFrame({
        "_group": frame["_group"].iloc[:1], "_at": frame["_tree"].iloc[:1].to_numpy(), "_leaf": [parents[-1][0].digest if parents else leaves[0]],
    })


def _rounds(nodes: DataFrame) -> list[DataFrame]:
    """Nodes of every round, from the given ones up to one node per group."""
    rounds = [nodes]
    while (rounds[-1].agg(F.max("_n")).first()[0] or 0) > 1:
        roots = rounds[-1].groupBy("_group", "_tree").applyInPandas(_rooted, "_group string, _at long, _leaf string")
        rounds.append(laid(_sized(roots), "subtrees"))
    return rounds


def _paths(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """The path of each node of a subtree: its siblings level by level, then the subtree's own path."""
    names = ["_group", "_at", "path", "subroot", "root"]
    if left.empty or right.empty:
        return pd.DataFrame({n: [] for n in names})
    left = left.sort_values("_at")
    parents = grown(left["_leaf"].tolist(), levels_of(int(left["_n"].iloc[0])))
    upper = list(right["path"].iloc[0])
    paths = []
    for at in range(len(left)):
        path = []
        for row in parents:
            at, slot = divmod(at, FAN_OUT)
            path.append({"left": row[at].left(slot).decode(), "right": row[at].right(slot).decode()})
        paths.append(path + upper)
    return pd.DataFrame({
        "_group": left["_group"].to_numpy(), "_at": left["_at"].to_numpy(), "path": paths,
        "subroot": right["subroot"].iloc[0], "root": right["root"].iloc[0],
    })


def _descended(rounds: list[DataFrame], top: DataFrame) -> DataFrame:
    """Paths of the nodes of the first round but the lowest, from those of the groups' roots (_at 0)."""
    paths = top
    for nodes in reversed(rounds[1:-1]):
        above = paths.withColumnRenamed("_at", "_tree").groupBy("_group", "_tree")
        paths = laid(nodes.groupBy("_group", "_tree").cogroup(above).applyInPandas(
            _paths, f"_group string, _at long, path {PATH}, subroot string, root string"), "paths")
    return paths


def manifest(docs: DataFrame, key: str, group: str, columns: Sequence[str], replaced: dict[str, Column] | None = None) -> Manifest:
    """The tree over ``columns`` of all rows of ``docs``.

    Leaves ascend by ``key`` within a ``group`` (null: a group of its own, the first), nulls
    first; rows of one key by their digests, so repeated rows are leaves side by side.
    ``replaced`` gives columns their values in a later state of the dataset, for ``folded``.
    Nulls, empty and very long values are digested as they are; an empty table has no leaf and
    no root. Other columns of ``docs`` play no part, whatever their names.
    """
    replaced = replaced or {}
    later = [replaced.get(c, F.col(c)) for c in columns]
    named = F.col(group).cast("string")
    leaves = laid(docs.select(
        F.col(key).alias("_key"), F.coalesce(F.concat(F.lit("1"), named), F.lit("0")).alias("_group"),
        digest([F.col(c) for c in columns]).alias("_leaf"),
        (digest(later) if replaced else F.lit(None).cast("string")).alias("_new"),
    ), "leaves")
    placed = running(leaves, ["_group", "_key", "_leaf"], "_at", within=["_group"])
    rounds = _rounds(laid(_sized(placed), "placed"))

    subroots = rounds[-1].select(F.col("_group").alias("_of"), F.col("_leaf").alias("_leaf"))
    ordered = laid(running(subroots, ["_of"], "_at").withColumn("_group", F.lit("")), "groups")
    groups = _rounds(laid(_sized(ordered), "groups"))
    root = groups[-1].select(
        "_group", F.lit(0).cast("long").alias("_at"), F.array().cast(PATH).alias("path"),
        F.col("_leaf").alias("subroot"), F.col("_leaf").alias("root"),
    )
    paths = _descended([groups[0], *groups], root)
    tops = groups[0].join(paths.select("_at", "path", "root"), "_at").select(
        F.col("_of").alias("_group"), F.lit(0).cast("long").alias("_at"), "path", F.col("_leaf").alias("subroot"), "root")
    tops = laid(tops, "paths")
    return Manifest(rounds[0], _descended(rounds, tops).withColumnRenamed("_at", "_tree"))


def _folds(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """Folds every leaf of a subtree up to the root of the dataset."""
    if left.empty:
        return pd.DataFrame({n: [] for n in ("_key", "leaf", "subroot", "root", "proof_sha256", "folded_root")})
    left = left.sort_values("_at")
    leaves = left["_leaf"].tolist()
    parents = grown(leaves, levels_of(int(left["_n"].iloc[0])))
    steps = []
    for step in right["path"].iloc[0]:
        state = hashlib.sha256(step["left"].encode())       # kept before the subtree's slot, copied per leaf
        steps.append((state, step["right"].encode()))
    siblings = "".join(step["left"] + step["right"] for step in right["path"].iloc[0]).encode()
    proofs, folds = [], []
    for place, (leaf, new) in enumerate(zip(leaves, left["_new"])):
        proof, folded = hashlib.sha256(), leaf if new is None else new
        for row in parents:
            place, slot = divmod(place, FAN_OUT)
            proof.update(row[place].left(slot))
            proof.update(row[place].right(slot))
            folded = row[place].resumed(slot, folded)
        for state, rest in steps:
            resumed = state.copy()
            resumed.update(folded.encode())
            resumed.update(rest)
            folded = resumed.hexdigest()
        proof.update(siblings)
        proofs.append(proof.hexdigest())
        folds.append(folded)
    return pd.DataFrame({
        "_key": left["_key"].to_numpy(), "leaf": leaves, "subroot": right["subroot"].iloc[0],
        "root": right["root"].iloc[0], "proof_sha256": proofs, "folded_root": folds,
    })


def folded(tree: Manifest) -> DataFrame:
    """Per leaf: ``_key``, ``leaf``, ``subroot``, ``root``, the digest of its proof (its siblings,
    level by level, left to right), the root recomputed from its replaced value or its own, and
    ``verified``: whether that is the root. The key must survive a cast to text and back."""
    key = tree.leaves.schema["_key"].dataType.simpleString()
    leaves = tree.leaves.withColumn("_key", F.col("_key").cast("string"))       # pandas has no whole numbers beside nulls
    made = leaves.groupBy("_group", "_tree").cogroup(tree.above.groupBy("_group", "_tree")).applyInPandas(
        _folds, "_key string, leaf string, subroot string, root string, proof_sha256 string, folded_root string")
    return made.withColumn("_key", F.col("_key").cast(key)).withColumn("verified", F.col("folded_root") == F.col("root"))
