"""A Merkle manifest of a dataset: leaves, subroots by language, a root, and a proof for every row.

A leaf is the hash of a row. The leaves of a language, in order, are folded by runs of eight until one
node, the subroot, is left; the subroots, in the order of their languages, are folded to the root in the
same way. A node is the hash of the hex texts of its run.

Leaves get their place in order by range partitions and prefix counts. A superblock is the aligned stretch
of leaves under one node some levels up, 4096 of them. One pass reduces superblocks to their nodes, which
are the leaves of a tree 4096 times smaller; that is repeated until each language has one node. Then the
trees are gone through downwards: the nodes of a superblock and the one row that says what stands outside
it (the siblings from its own node up to the root) are cogrouped by superblock, and there the local
reduction, the proofs and the folding of every leaf are done together. No task holds more than a
superblock, however many rows a language has, and nothing goes through the driver but the number of
tiers.

Null values are hashed as a dash, so every row is a leaf. Null languages are one language, the first.
Rows with one id in a language follow their leaves; equal rows are leaves of their own, with other
proofs. The columns named are all that is read; others may have any names. An empty table gives an empty
manifest.
"""

from __future__ import annotations

from collections.abc import Sequence
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmetrics.llm.storage import checkpointed
from gridmetrics.operators.positions import null_safe_join, with_positions

#: Children of a node, and the levels that one superblock holds.
RUN = 8
LEVELS = 4

#: Columns of a row that its leaf covers, in this order.
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")

_LEVEL_MARK = "|"


def hashed(texts: Sequence[str]) -> str:
    return sha256("".join(texts).encode()).hexdigest()


def leaf_of(*values: Column) -> Column:
    """The leaf of some values: each a dash if null, else its length in bytes, a colon and itself."""
    parts = []
    for value in values:
        text = value.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def levels_above(size: int) -> int:
    """How often ``size`` nodes are folded by runs until one is left."""
    levels = 0
    while size > 1:
        size, levels = -(-size // RUN), levels + 1
    return levels


def folded(nodes: list[str], levels: int) -> list[list[str]]:
    """The nodes of each level, the given ones first."""
    tiers = [nodes]
    for _ in range(levels):
        below = tiers[-1]
        tiers.append([hashed(below[at : at + RUN]) for at in range(0, len(below), RUN)])
    return tiers


def steps_up(tiers: list[list[str]], at: int) -> list[tuple[int, list[str]]]:
    """Per level, the place of a node in its run and the others of that run."""
    steps = []
    for tier in tiers[:-1]:
        begin = at // RUN * RUN
        steps.append((at - begin, tier[begin:at] + tier[at + 1 : begin + RUN]))
        at //= RUN
    return steps


def path_text(steps: list[tuple[int, list[str]]]) -> str:
    """Steps as text: place and siblings of a level, levels one after another."""
    return "".join(f"{place}{''.join(others)}{_LEVEL_MARK}" for place, others in steps)


def path_steps(text: str) -> list[tuple[int, list[str]]]:
    levels = text.split(_LEVEL_MARK)[:-1]
    return [(int(level[0]), [level[at : at + 64] for at in range(1, len(level), 64)]) for level in levels]


def proof_of(steps: list[tuple[int, list[str]]]) -> str:
    return hashed([other for _, others in steps for other in others])


def fold_up(leaf: str, steps: list[tuple[int, list[str]]]) -> str:
    """The root that follows from a leaf and its siblings."""
    for place, others in steps:
        leaf = hashed([*others[:place], leaf, *others[place:]])
    return leaf


def _block(levels: int) -> Column:
    return F.expr(f"at div {RUN**levels}").alias("block")


_NODE = "tree long, at long, size long, hash string"


def _upwards(nodes: DataFrame, levels: int) -> DataFrame:
    """One node for each superblock of ``nodes`` (tree, at, size, hash), as nodes of the next tier."""
    span = RUN**levels

    def reduce(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("at", ignore_index=True)
        tree, at, size = (int(block[name].iloc[0]) for name in ("tree", "at", "size"))
        top = folded(block["hash"].tolist(), min(levels, levels_above(size)))[-1][0]
        return pd.DataFrame({"tree": [tree], "at": [at // span], "size": [-(-size // span)], "hash": [top]})

    return nodes.select("tree", "at", "size", "hash", _block(levels)).groupBy("tree", "block").applyInPandas(reduce, _NODE)


def _outside(nodes: DataFrame, outer: DataFrame, levels: int) -> DataFrame:
    """``tree``, ``at``, ``path``, ``subroot`` and ``root`` of nodes, from those of their superblocks."""

    def join(block: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("at", ignore_index=True)
        tiers = folded(block["hash"].tolist(), min(levels, levels_above(int(block["size"].iloc[0]))))
        up = above.iloc[0]
        paths = [path_text(steps_up(tiers, n)) + up["path"] for n in range(len(block))]
        return pd.DataFrame({"tree": block["tree"], "at": block["at"], "path": paths, "subroot": up["subroot"], "root": up["root"]})

    kept = nodes.select("tree", "at", "size", "hash", _block(levels))
    above = outer.withColumnRenamed("at", "block")
    schema = "tree long, at long, path string, subroot string, root string"
    return kept.groupBy("tree", "block").cogroup(above.groupBy("tree", "block")).applyInPandas(join, schema)


def _tiers(nodes: DataFrame, most: int, levels: int) -> list[DataFrame]:
    """Nodes of all tiers, the given ones first; the last has one node a tree. ``most`` is the largest tree."""
    tiers = [nodes]
    while most > 1:
        tiers.append(checkpointed(_upwards(tiers[-1], levels)))
        most = -(-most // RUN**levels)
    return tiers


def _downwards(tiers: list[DataFrame], top: DataFrame, levels: int) -> DataFrame:
    """What stands outside of every node of the second tier, from what stands outside of each tree."""
    for nodes in reversed(tiers[1:-1]):
        top = _outside(nodes, top, levels)
    return top


def merkle_manifest(
    docs: DataFrame,
    tampered: Column | None = None,
    leaf_columns: Sequence[str] = LEAF_COLUMNS,
    id_column: str = "doc_id",
    tree_column: str = "lang",
    text_column: str = "text",
    levels: int = LEVELS,
) -> DataFrame:
    """Per row: id, ``leaf``, ``subroot``, ``root``, ``proof_sha256``, ``folded_root`` and ``verified``.

    ``tampered`` is the text that is found when the manifest is checked (null for a null text); the root is
    folded anew from the leaf of the row with that text and its original siblings. Without it the
    original is checked. ``levels`` sets the size of a superblock (8 to that power).
    """
    values = {name: docs[name] for name in leaf_columns}
    leaf = leaf_of(*values.values())
    found = leaf if tampered is None else leaf_of(*(tampered if name == text_column else value for name, value in values.items()))
    kind = docs.schema[id_column].dataType
    leaves = docs.select(docs[id_column].alias("id"), docs[tree_column].alias("name"), leaf.alias("hash"), found.alias("found"))
    leaves = with_positions(leaves, [F.col("id").asc_nulls_first(), "hash"], ["name"], "at", "size")
    leaves = checkpointed(leaves)
    names = with_positions(leaves.groupBy("name").agg(F.max("size").alias("n")), [F.col("name").asc_nulls_first()], (), "tree", "trees")
    names = checkpointed(names)
    leaves = null_safe_join(leaves, names, ["name"])
    most = names.agg(F.max("n"), F.max("trees")).first()
    tiers = _tiers(leaves, max(most[0] or 0, 2), levels)
    # The tree over the subroots.
    trees = null_safe_join(tiers[-1].select(F.col("tree"), F.col("hash")), names.select("tree", "trees"), ["tree"])
    trees = trees.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("at"), F.col("trees").alias("size"), "hash")
    over = _tiers(trees, max(most[1] or 0, 2), levels)
    root = over[-1].select("tree", "at", F.lit("").alias("path"), F.col("hash").alias("subroot"), F.col("hash").alias("root"))
    outside = _outside(trees, _downwards(over, root, levels), levels)
    outside = outside.select(F.col("at").alias("tree"), "path", "root").join(tiers[-1].select("tree", "at", F.col("hash").alias("subroot")), "tree")
    above = _downwards(tiers, outside.select("tree", "at", "path", "subroot", "root"), levels)

    def finish(block: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("at", ignore_index=True)
        hashes = block["hash"].tolist()
        tiers = folded(hashes, min(levels, levels_above(int(block["size"].iloc[0]))))
        up = above.iloc[0]
        outer, root = path_steps(up["path"]), up["root"]
        paths = [steps_up(tiers, n) + outer for n in range(len(block))]
        roots = [fold_up(found, path) for found, path in zip(block["found"], paths)]
        return pd.DataFrame(
            {
                "id": block["id"],
                "leaf": hashes,
                "subroot": up["subroot"],
                "root": root,
                "proof_sha256": [proof_of(path) for path in paths],
                "folded_root": roots,
                "verified": [found == root for found in roots],
            }
        )

    schema = "id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    # The id as text, since pandas would turn whole numbers among nulls into floating ones.
    kept = leaves.select("tree", "at", "size", "hash", F.col("id").cast("string").alias("id"), "found", _block(levels))
    above = above.withColumnRenamed("at", "block")
    done = kept.groupBy("tree", "block").cogroup(above.groupBy("tree", "block")).applyInPandas(finish, schema)
    return done.select(F.col("id").cast(kind).alias(id_column), *done.columns[1:])
