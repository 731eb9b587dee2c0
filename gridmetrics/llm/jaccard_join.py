"""Documents linked by the Jaccard similarity of their word shingles, found with parity sketches.

A sketch has a bit for each hash of a shingle, which the shingle flips. Two sketches differ in at most
as many bits as the sets differ in members, so their Hamming distance is a lower bound of the symmetric
difference. Sets of a size band that reach the similarity differ in at most d members; cut into d + 1
words, their sketches have a word that is equal in both (pigeonhole), and documents are joined on the
words. A word is far too long to be written out; it is held as the XOR of the codes of the bits set.
A set near the upper edge of its band also has a sketch for the next band.

A word without any member says nothing, and one with a single member or two says little: one common
shingle would join all documents that have it. Words with fewer than some members are left out. A linked
pair that agrees only in such words would be missed; for each band the chance of that is computed for the
worst pair, and as many sketches by independent hashes are taken as bring it below ``MISSED``, which is
small beside that of two shingles with one hash. Long texts need one sketch.

Equal sets are one class before sketches are joined. What is joined gives families: components of
"shares a word". Large families are split by further sketches of fewer and so longer words, which unrelated
sets hardly share; as many are taken as keep the same bound. Inside families, in blocks and without writing
pairs, short sketches written out in
bits are compared: what lies farther apart than linked sets can is no link. That splits families that
only a common passage held together. What is left is verified by the sets themselves in the same way.
Each task keeps only what connects documents not yet connected there.

Shingles and words are compared by 64-bit hashes. Null or empty text, or text without words, has an
empty set and links with nothing; fewer words than a shingle has are one shingle. Repeated rows of a
document come out as often as they occur. A null id gets its set's size and a null component. An empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import ceil, floor, inf, log

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmetrics.llm.batches import bound_batches, map_batches
from gridmetrics.llm.components import components
from gridmetrics.llm.storage import checkpointed

#: Upper over lower end of a size band.
BAND = 1.5
#: Largest chance that sketches miss a linked pair.
MISSED = 1e-12
#: Members that a sketch word is asked for at most.
MOST_MEMBERS = 4
#: Differences to a word in the sketches that split large families, one after another.
SPREADS = (2, 3)
#: Documents of a family that are compared and that are verified together.
SKETCH_BLOCK, BLOCK = 1024, 256

#: Fixed multipliers of a 64-bit mixing function.
_MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
_STEP = 0x9E3779B97F4A7C15


def mixed(values: np.ndarray) -> np.ndarray:
    """Hashes of 64-bit values."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(_MIX[0])
    values = (values ^ (values >> np.uint64(27))) * np.uint64(_MIX[1])
    return values ^ (values >> np.uint64(31))


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted hashes of the distinct shingles of a text."""
    found = (text or "").encode().lower().split()  # of bytes, only A-Z change and only ASCII white space separates
    if not found:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    width = min(words, len(found))
    total = np.full(len(found) - width + 1, width, np.uint64)
    for at in range(width):
        total = mixed(total * np.uint64(_STEP) + hashes[at : at + len(total)])
    return np.unique(total)


class Bands:
    """Size bands, and the sketch words that a similarity of ``percent`` / 100 needs in each.

    With ``spread``, so many of the differences that linked sets can have fall on one word.
    """

    def __init__(self, percent: int, spread: int = 1) -> None:
        if not 0 < percent <= 100:
            raise ValueError("percent must be from 1 to 100")
        self.percent, self.spread = percent, spread

    def of(self, size: int) -> int:
        return floor(log(size) / log(BAND) + 1e-9)

    def words(self, band: int) -> int:
        """One more than the members in which two linked sets can differ, if the larger is of the band."""
        largest = int(BAND ** (band + 1)) + 1
        return 2 * largest * (100 - self.percent) // (100 + self.percent) + 1

    def cut(self, band: int) -> int:
        """Words of a sketch."""
        words = self.words(band)
        return words if self.spread == 1 else min(words, max(2, ceil((words - 1) / self.spread)))

    def _needed(self, band: int, least: int) -> tuple[float, float]:
        """Sketches needed if words have ``least`` members, and the share of words that have fewer in what a linked pair shares."""
        words, differences = self.cut(band), self.words(band) - 1
        shared = BAND**band * self.percent / 100
        few, part = 0.0, (1 - 1 / words) ** shared
        for members in range(least):
            few += part
            part *= max(shared - members, 0) / (members + 1) / (words - 1)
        if shared < least > 1 or few >= 1:
            return inf, 1.0
        if words > 200:
            # which words no difference touches is negatively associated, so the product of the means is an upper bound
            missed = (1 - (1 - 1 / words) ** differences * (1 - few)) ** words
            return (ceil(log(MISSED) / log(missed)) if missed > MISSED else 1), few
        chances = np.zeros(words + 1)  # of so many words touched by as many differences as a linked pair can have
        chances[0] = 1
        touched = np.arange(words + 1)
        for _ in range(differences):
            chances = chances * touched / words + np.concatenate([[0], (chances * (words - touched) / words)[:-1]])
        missed = float((chances * few ** (words - touched)).sum())
        return ceil(log(MISSED) / log(missed)), few

    @lru_cache(maxsize=None)  # noqa: B019
    def plan(self, band: int) -> tuple[int, int]:
        """Members that a word has at least, as many as ask for at most twice the keys, and independent sketches, so that
        some such word is equal in nearly every linked pair."""
        if self.cut(band) == 1:
            return 1, 1
        plain, _ = self._needed(band, 1)
        for least in range(MOST_MEMBERS, 1, -1):
            sketches, few = self._needed(band, least)
            if sketches == plain or self.cut(band) <= 200 and sketches * (1 - few) <= 2 * plain:
                return least, sketches
        return 1, plain

    def sketches(self, band: int) -> int:
        return self.plan(band)[1]

    def keys(self, members: np.ndarray) -> np.ndarray:
        """Hashes of band, sketch, place and word of one set."""
        size = len(members)
        if not size:
            return np.empty(0, np.int64)
        first, last = self.of(size), self.of(max(size, size * 100 // self.percent + 1))
        keys = []
        for band in range(first, last + 1):
            words = self.cut(band)
            least, sketches = self.plan(band)
            numbers = np.arange(1, sketches + 1, dtype=np.uint64)
            codes = mixed(members + (numbers[:, None] + np.uint64(4096 * (self.spread - 1))) * np.uint64(_STEP))
            place = (codes % np.uint64(words)).astype(np.int64) + np.arange(0, sketches * words, words)[:, None]
            sketch, counts = np.zeros(sketches * words, np.uint64), np.bincount(place.ravel(), minlength=sketches * words)
            np.bitwise_xor.at(sketch, place.ravel(), mixed(codes).ravel())
            seeds = mixed((np.arange(words, dtype=np.uint64) + ((numbers[:, None] + np.uint64(band * 4096)) << np.uint64(34))) * np.uint64(_STEP))
            keys.append(mixed(seeds.ravel() ^ sketch)[counts >= least])
        return np.concatenate(keys).view(np.int64)


    def bits(self, members: np.ndarray) -> list[dict]:
        """For each band of a set, its parity sketch in as many bits as tell unrelated sets apart."""
        size, found = len(members), []
        if size:
            codes = mixed(members ^ np.uint64(_STEP))
            for band in range(self.of(size), self.of(max(size, size * 100 // self.percent + 1)) + 1):
                length = 64 * ceil(4 * self.words(band) / 64)
                odd = np.bincount((codes % np.uint64(length)).astype(np.int64), minlength=length) & 1
                found.append({"band": band, "bits": np.packbits(odd.astype(bool)).tobytes()})
        return found


class Forest:
    """Union-find over positions."""

    def __init__(self, size: int) -> None:
        self.parent = list(range(size))

    def root(self, node: int) -> int:
        while self.parent[node] != node:
            self.parent[node] = self.parent[self.parent[node]]
            node = self.parent[node]
        return node

    def join(self, one: int, other: int) -> bool:
        one, other = self.root(one), self.root(other)
        self.parent[max(one, other)] = min(one, other)
        return one != other


def links_between(sets: list[np.ndarray], split: int, percent: int) -> Iterator[tuple[int, int]]:
    """Links that connect the sets, sorted by size: each with each, or those before with those from ``split``.

    A set is compared with all others that can reach the similarity at once, through an index of the
    members, and only until it is connected with them.
    """
    forest = Forest(len(sets))
    sizes = np.array([len(s) for s in sets])
    members = np.concatenate(sets)
    owners = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(members, kind="stable")
    members, owners = members[order], owners[order]
    for at, own in enumerate(sets):
        others = np.flatnonzero((100 * np.minimum(sizes, len(own)) >= percent * np.maximum(sizes, len(own))))
        others = others[(others > at) & ((others >= split) | (split == 0))] if at < split or split == 0 else others[:0]
        others = [o for o in others if forest.root(o) != forest.root(at)]
        if not others:
            continue
        low, high = np.searchsorted(members, own, "left"), np.searchsorted(members, own, "right")
        lengths = high - low
        picks = np.repeat(low - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
        common = np.bincount(owners[picks], minlength=len(sets))
        for other in others:
            both = int(common[other])
            if 100 * both >= percent * (len(own) + int(sizes[other]) - both) and forest.join(at, other):
                yield at, other


def jaccard_groups(docs: DataFrame, words: int, percent: int, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: the id, ``n_shingles`` and ``component_id``, the smallest id reachable by links.

    Documents link when 100 * intersection >= ``percent`` * union. Ids are integers.
    """
    bands = Bands(percent)
    source = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))

    def sketch(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, prints, keys, bits = [], [], [], []
        for value in batch.column(1):
            members = shingle_set(value.as_py(), words)
            sizes.append(len(members))
            prints.append(xxhash.xxh3_128_digest(members.tobytes()) if len(members) else None)
            keys.append(bands.keys(members))
            bits.append(bands.bits(members))
        kind = pa.list_(pa.struct([("band", pa.int32()), ("bits", pa.binary())]))
        columns = [pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()), pa.array(keys, pa.list_(pa.int64())), pa.array(bits, kind)]
        return pa.RecordBatch.from_arrays([batch.column(0), *columns], ["id", "n_shingles", "print", "keys", "sketches"])

    schema = "id long, n_shingles long, print binary, keys array<long>, sketches array<struct<band: int, bits: binary>>"
    rows = checkpointed(map_batches(source, sketch, schema))
    classes = rows.where("print is not null and id is not null").groupBy("print").agg(F.min("id").alias("rep"))
    firsts = rows.join(classes.select(F.col("rep").alias("id")), "id", "left_semi")
    families = checkpointed(components(_sharing(firsts.select("id", F.explode("keys").alias("key")))))
    for spread in SPREADS:
        families = _split(source, families, words, Bands(percent, spread))
    families = checkpointed(components(_near(rows, families, percent)))
    links = _verified(source, families, words, percent)
    groups = components(links).withColumnRenamed("id", "rep")
    named = classes.join(groups, "rep", "left").select("print", F.coalesce("component", "rep").alias("component_id"))
    named = rows.select("id", "n_shingles", "print").join(named, "print", "left")
    return named.select(
        F.col("id").alias(id_column),
        "n_shingles",
        F.coalesce("component_id", "id").alias("component_id"),
    )


def _sharing(keys: DataFrame) -> DataFrame:
    """Pairs (``a``, ``b``) that connect the ids with an equal key."""
    # A table, so that both sides of the join are plain exchanges, whose hot keys adaptive execution can split.
    least = checkpointed(keys.groupBy("key").agg(F.min("id").alias("b"), F.max("id").alias("last")).where("b < last").drop("last"))
    return keys.join(least, "key").select(F.col("id").alias("a"), "b").where("a <> b").distinct()


def _split(source: DataFrame, families: DataFrame, words: int, bands: Bands) -> DataFrame:
    """``families``, of which those of more than a block are split by what shares a word of further sketches."""
    large = families.groupBy("component").agg(F.count("*").alias("n")).where(F.col("n") > SKETCH_BLOCK).select("component")
    large = checkpointed(large)
    if large.isEmpty():
        return families

    def sketch(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys = [bands.keys(shingle_set(value.as_py(), words)) for value in batch.column(2)]
        return pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(keys, pa.list_(pa.int64()))], ["id", "component", "keys"])

    texts = source.join(families.join(large, "component"), "id").dropDuplicates(["id"]).select("id", "component", "text")
    keys = checkpointed(map_batches(texts, sketch, "id long, component long, keys array<long>"))
    keys = keys.select("id", "component", F.explode("keys").alias("key")).select("id", F.xxhash64("component", "key").alias("key"))
    small = families.join(large, "component", "left_anti").select("id", "component")
    return checkpointed(small.unionByName(components(_sharing(keys))))


def _blocks(families: DataFrame, block: int) -> DataFrame:
    """``id``, ``family``, ``block`` and ``pairs``, the pairs of blocks that the document is compared in."""
    members = families.select("id", F.col("component").alias("family"))
    sizes = members.groupBy("family").agg(F.count("*").alias("n"))
    members = members.join(sizes, "family").withColumn("blocks", F.ceil(F.col("n") / F.lit(block)).cast("int"))
    members = members.withColumn("block", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
    others = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda b: F.struct(F.least("block", b).alias("p"), F.greatest("block", b).alias("q")))
    return members.select("id", "family", "block", others.alias("pairs"))


def _near(rows: DataFrame, families: DataFrame, percent: int) -> DataFrame:
    """Pairs (``a``, ``b``) that connect, inside families, the sets whose sketches are as near as those of linked sets."""
    sketches = rows.join(_blocks(families, SKETCH_BLOCK), "id").dropDuplicates(["id"])
    sketches = sketches.select("id", "n_shingles", "family", "block", "pairs", F.explode("sketches").alias("sketch"))
    spread = sketches.select("id", "n_shingles", "family", "block", "sketch.*", F.explode("pairs").alias("pair")).select("*", "pair.*").drop("pair")

    def compare(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        *_, p, q = key
        group = group.sort_values(["block", "id"])
        ids, sizes, block = (group[name].to_numpy() for name in ("id", "n_shingles", "block"))
        bits = np.frombuffer(b"".join(group["bits"]), np.uint64).reshape(len(group), -1)
        forest, found = Forest(len(ids)), []
        for at in np.flatnonzero(block == p):
            others = np.flatnonzero(block == q) if p != q else np.arange(at + 1, len(ids))
            apart = np.bitwise_count(bits[others] ^ bits[at]).sum(axis=1, dtype=np.int64)
            both = sizes[others] + sizes[at]
            near = (apart * (100 + percent) <= both * (100 - percent)) & (100 * np.minimum(sizes[others], sizes[at]) >= percent * np.maximum(sizes[others], sizes[at]))
            found += [(ids[at], ids[other]) for other in others[near] if forest.join(at, other)]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    bound_batches(spread)
    return spread.groupBy("family", "band", "p", "q").applyInPandas(compare, "a long, b long")


def _verified(source: DataFrame, families: DataFrame, words: int, percent: int) -> DataFrame:
    """Links (``a``, ``b``) that connect what is linked inside the families."""
    members = _blocks(families, BLOCK)
    texts = source.join(members, "id").dropDuplicates(["id"])
    spread = texts.select("id", "text", "family", "block", F.explode("pairs").alias("pair")).select("*", "pair.*").drop("pair")

    def verify(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        _, p, q = key
        group = group.sort_values(["block", "id"])
        sets = [shingle_set(text, words) for text in group["text"]]
        ids = group["id"].to_numpy()
        split = int((group["block"] == p).sum()) if p != q else 0
        found = [(ids[x], ids[y]) for x, y in links_between(sets, split, percent)]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    bound_batches(spread)
    return spread.groupBy("family", "p", "q").applyInPandas(verify, "a long, b long")
