"""Near-duplicate vectors of equal label, found through a pivot-permutation index.

Reference vectors (pivots) are sampled by hash and thinned, so that no two are close: else a dense group
that holds many rows would hold many pivots, of which linked vectors pick different ones. A vector is
described by its nearest pivots in order, and stands in the inverted list of each. Two vectors are candidates if their descriptions share enough
pivots; candidates are verified by cosine in double precision. A pair is treated in the list of the
smallest pivot that both have, so it counts once.

Equal vectors are one class with a count, so copies are never paired with each other. Long lists are
cut into blocks, and each task compares two blocks by matrix products: it returns the number of links
of each vector and the links that connect them, not pairs. Every vector is indexed. What the sample
bounds is the number of pivots, at most ``MOST_PIVOTS``; recall against brute force is in the tests.

Vectors that are null, empty, zero or hold null or non-finite components, and vectors with a null label
or id, link with nothing. Vectors of different length are not compared. Repeated rows of a vector count
as one vector and come out as often as they occur; a null id has a null component and is not kept. An
empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, sqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmetrics.llm.batches import bound_batches, map_batches
from gridmetrics.llm.components import components
from gridmetrics.llm.storage import checkpointed

#: The sample of pivots: the square root of the number of vectors, within these.
FEWEST_PIVOTS, MOST_PIVOTS = 64, 4096
#: Vectors drawn for each wanted pivot, and the cosine to a kept pivot from which another is dropped.
DRAWN, CLOSE = 2, 0.9
#: Pivots in a description, and how many of them candidates share at least.
NEAREST, SHARED = 8, 2
#: Vectors of a list that are compared together.
BLOCK = 512


def comparable(vector: str, label: str) -> Column:
    """Whether a vector can be compared at all."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(F.col(label).isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit_rows(vectors: list) -> np.ndarray:
    """Vectors of one length in double precision, scaled to length 1."""
    rows = np.array(vectors, np.float64).reshape(len(vectors), -1)
    rows /= np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def thinned(rows: np.ndarray, wanted: int) -> np.ndarray:
    """Of unit vectors, in order, those that are close to none kept before, as many as wanted."""
    kept, n = np.empty((min(wanted, len(rows)), rows.shape[1])), 0
    for row in rows:
        if n < len(kept) and not (kept[:n] @ row >= CLOSE).any():
            kept[n] = row
            n += 1
    return kept[:n]


def described(vectors: pd.Series, pivots: dict[int, np.ndarray], nearest: int) -> list[np.ndarray]:
    """The nearest pivots of each vector, the nearest first; where none has its length, the one list -1."""
    found: list[np.ndarray] = [np.array([-1])] * len(vectors)
    lengths = vectors.map(len).to_numpy()
    for length in np.unique(lengths):
        if length in pivots:
            rows = np.flatnonzero(lengths == length)
            near = unit_rows([vectors.iloc[r] for r in rows]) @ pivots[length].T
            best = np.argsort(-near, axis=1, kind="stable")[:, :nearest]
            for row, order in zip(rows, best, strict=True):
                found[row] = order
    return found


def candidates(one: np.ndarray, other: np.ndarray, pivot: int, shared: int) -> np.ndarray:
    """Where descriptions share enough pivots, the smallest of which is ``pivot``."""
    names = np.unique(np.concatenate([one.ravel(), other.ravel()]))
    marks = [np.zeros((len(x), len(names)), np.float32) for x in (one, other)]
    for x, mark in zip((one, other), marks, strict=True):
        mark[np.arange(len(x))[:, None], np.searchsorted(names, x)] = 1
    smaller = names < pivot
    return (marks[0] @ marks[1].T >= min(shared, one.shape[1])) & (marks[0][:, smaller] @ marks[1][:, smaller].T == 0)


def spanning(pairs: tuple[np.ndarray, np.ndarray], size: int) -> Iterator[tuple[int, int]]:
    """Of the pairs, those that connect positions not connected before."""
    parent = np.arange(size)
    one, other = pairs
    while len(one):
        np.minimum.at(parent, np.maximum(one, other), np.minimum(one, other))
        while (parent != parent[parent]).any():
            parent = parent[parent]
        one, other = parent[one], parent[other]
        apart = one != other
        one, other = one[apart], other[apart]
        if len(one):
            keys = np.unique(np.minimum(one, other) * size + np.maximum(one, other))
            one, other = keys // size, keys % size
    yield from ((x, parent[x]) for x in np.flatnonzero(parent != np.arange(size)))


def vector_groups(
    vectors: DataFrame, similarity: float, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label",
    nearest: int = NEAREST, shared: int = SHARED, block: int = BLOCK,
) -> DataFrame:
    """Per row: the id, ``n_links`` (other vectors linked directly), ``component_id`` and ``kept``."""
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).alias("vector"), F.col(label_column).alias("label"))
    valid = comparable("vector", "label") & F.col("id").isNotNull()
    rows = rows.withColumn("one", F.when(valid, F.xxhash64("label", "vector"))).withColumn("two", F.when(valid, F.xxhash64("vector", "label", F.lit(1))))
    classes = rows.where("one is not null").groupBy("one", "two")
    classes = checkpointed(classes.agg(F.min("id").alias("rep"), F.count_distinct("id").alias("copies"), F.first("vector").alias("vector"), F.first("label").alias("label")))
    wanted = min(MOST_PIVOTS, max(FEWEST_PIVOTS, ceil(sqrt(classes.count()))))
    sample = classes.select("vector").orderBy(F.xxhash64("one", "two")).limit(DRAWN * wanted).collect()
    lengths = {len(row["vector"]) for row in sample}
    pivots = {n: thinned(unit_rows([row["vector"] for row in sample if len(row["vector"]) == n]), wanted) for n in lengths}

    def describe(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = described(batch.column(1).to_pandas(), pivots, nearest)
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.list_(pa.int32()))], [*batch.schema.names, "near"])

    kinds = {f.name: f.dataType.simpleString() for f in classes.schema}
    listed = map_batches(
        classes.select("rep", "vector", "label", "copies"), describe, f"rep long, vector {kinds['vector']}, label {kinds['label']}, copies long, near array<int>"
    )
    listed = listed.withColumn("length", F.size("vector")).withColumn("pivot", F.explode("near"))
    listed = checkpointed(listed)
    key = ["label", "length", "pivot"]
    lists = listed.groupBy(*key).agg(F.count("*").alias("n"))
    listed = listed.join(lists, key).withColumn("blocks", F.ceil(F.col("n") / F.lit(block)).cast("int"))
    listed = listed.withColumn("block", F.pmod(F.xxhash64("rep"), "blocks").cast("int"))
    others = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda b: F.struct(F.least("block", b).alias("p"), F.greatest("block", b).alias("q")))
    spread = listed.where("n > 1").withColumn("pair", F.explode(others)).select("rep", "vector", "copies", "near", "block", *key, "pair.p", "pair.q")

    def compare(group_key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        _, _, pivot, p, q = group_key
        group = group.sort_values("rep", kind="stable")
        ids, copies = group["rep"].to_numpy(), group["copies"].to_numpy()
        unit, near = unit_rows(group["vector"].tolist()), np.array(group["near"].tolist())
        first = np.flatnonzero(group["block"] == p)
        second = np.flatnonzero(group["block"] == q)
        linked = candidates(near[first], near[second], pivot, shared) & (unit[first] @ unit[second].T >= similarity)
        if p == q:
            linked = np.triu(linked, 1)
        x, y = np.nonzero(linked)
        x, y = first[x], second[y]
        links = np.bincount(x, copies[y], len(ids)) + np.bincount(y, copies[x], len(ids))
        some = np.flatnonzero(links)
        edges = np.array(list(spanning((x, y), len(ids))), np.int64).reshape(-1, 2)
        return pd.DataFrame(
            {
                "a": np.concatenate([ids[some], ids[edges[:, 0]]]),
                "b": pd.array([*[None] * len(some), *ids[edges[:, 1]]], "Int64"),
                "links": np.concatenate([links[some], np.zeros(len(edges))]).astype(np.int64),
            }
        )

    bound_batches(spread)
    found = checkpointed(spread.groupBy(*key, "p", "q").applyInPandas(compare, "a long, b long, links long"))
    degrees = found.where("b is null").groupBy("a").agg(F.sum("links").alias("links")).withColumnRenamed("a", "rep")
    groups = components(found.where("b is not null").select("a", "b")).withColumnRenamed("id", "rep")
    named = classes.select("one", "two", "rep", "copies").join(degrees, "rep", "left").join(groups, "rep", "left")
    named = named.select("one", "two", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component"))
    component = F.coalesce("component", "id")
    return rows.select("id", "one", "two").join(named, ["one", "two"], "left").select(
        F.col("id").alias(id_column),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )
