"""Runs of words that stand earlier too, by a suffix array over line ids.

**Lines.** Equal passages may be wrapped differently, so texts are wrapped anew: a line begins at the word
of the smallest hash of every ``width`` words in turn. Where a line begins inside a passage depends on the
passage alone, apart from its ends, so equal passages have equal lines wherever they stand. ``width`` is a
third of the run that counts, so at least two whole lines lie between the first and the last beginning that
a counting run settles by itself. They are its core.

**Suffix array.** Suffixes of the line-id sequences are ranked by their first line, then by their first 2, 4,
... lines: the rank of a doubled prefix is the rank of the pair of its halves, given by a distributed sort.
Prefixes that stand in one place only are dropped at once. Suffixes that share a core are an interval
whose longest common prefix is at least the core; a core of any length is the pair of two ranked prefixes
that overlap.

**Ends.** In an interval, places are put together by the hash of all words of the runs around the core. Of places
with equal words the first one stays, and the others are later copies as a whole. First places with different words around
the same core lie at the ends of repeated passages; only there each run is written out and compared by itself.

Every run of ``run_words`` words is found, inside lines, across them and within one text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridmetrics.llm.batches import bound_batches, map_batches
from gridmetrics.llm.jaccard_join import mixed
from gridmetrics.llm.storage import checkpointed
from gridmetrics.workspace import drop_folder, new_folder, passing_folders

#: A fixed odd multiplier, and its inverse modulo 2 ** 64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)

_LINES = ("one", "size", "depth")
_LISTS = {"one": pa.int64(), "size": pa.int32(), "depth": pa.int8(), "line": pa.int32(), "lines": pa.int32(), "low": pa.int32(), "runs": pa.int32(), "around": pa.int64()}


class Spans:
    """Hashes of the words from one place to another, for the words of many texts in one sequence."""

    def __init__(self, texts: pa.Array) -> None:
        parts = []
        for text in texts.cast(pa.binary()):
            words = text.as_py().split()
            parts.append(np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)))
        self.bounds = np.cumsum([0, *map(len, parts)])
        self.values = np.concatenate([*parts, np.empty(0, np.uint64)])
        powers, self._inverses = (np.cumprod(np.r_[np.uint64(1), np.full(len(self.values), base, np.uint64)]) for base in (_BASE, _INVERSE))
        self._sums = np.r_[np.uint64(0), np.cumsum(self.values * powers[:-1], dtype=np.uint64)]

    def ids(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self._sums[ends] - self._sums[starts]) * self._inverses[starts])


def line_starts(values: np.ndarray, width: int) -> np.ndarray:
    """For each place that has so many values, where the (first) smallest of the ``width`` values from there stands."""
    if len(values) < width:
        return np.empty(0, np.int64)
    return np.lib.stride_tricks.sliding_window_view(values, width).argmin(axis=1) + np.arange(len(values) - width + 1)


def wrapped(texts: pa.Array, run_words: int) -> tuple[np.ndarray, list[pa.Array]]:
    """Words of each text, and lists: of lines (id, words, rounds of doubling needed), of cores (first line, lines, first run, runs, id of all words)."""
    spans = Spans(texts)
    bounds, count, width = spans.bounds, len(spans.values), max(1, run_words // 3)
    ends = np.repeat(bounds[1:], np.diff(bounds))
    starts = line_starts(spans.values, width)
    inside = starts[np.arange(len(starts)) + width <= ends[: len(starts)]]
    begins = inside[np.r_[True, inside[1:] != inside[:-1]]] if len(inside) else inside
    ends_of_lines = np.minimum(np.r_[begins[1:], count][: len(begins)], ends[begins])

    runs = np.flatnonzero(np.arange(count) + run_words <= ends)
    first, last = starts[runs], starts[runs + run_words - width]
    new = np.flatnonzero(np.r_[True, (first[1:] != first[:-1]) | (last[1:] != last[:-1])]) if len(runs) else runs
    low, high = runs[new], runs[np.r_[new[1:], len(runs)][: len(new)] - 1] + 1
    line = np.searchsorted(begins, first[new])
    until = np.searchsorted(begins, last[new]) + (run_words < 3)
    around = spans.ids(low, high + run_words - 1)
    around = mixed(around ^ mixed(((first[new] - low) << 32 | (high - low)).astype(np.uint64)))

    depth, rounds = np.full(len(begins), -1, np.int8), 0
    while len(new) and 1 << rounds <= (until - line).max():
        some = until - line >= 1 << rounds
        steps = np.bincount(line[some], minlength=len(begins) + 1) - np.bincount(until[some], minlength=len(begins) + 1)
        depth[np.cumsum(steps)[: len(begins)] > 0] = rounds
        rounds += 1

    of_lines, of_cores = np.searchsorted(begins, bounds), np.searchsorted(low, bounds)
    text_of_core = np.searchsorted(bounds, low, side="right") - 1
    columns = {
        "one": spans.ids(begins, ends_of_lines).view(np.int64), "size": ends_of_lines - begins, "depth": depth,
        "line": line - of_lines[text_of_core], "lines": until - line, "low": low - bounds[text_of_core], "runs": high - low, "around": around.view(np.int64),
    }
    lists = []
    for number, (name, kind) in enumerate(_LISTS.items()):
        offsets = of_lines if number < 3 else of_cores
        lists.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(columns[name], kind)))
    return np.diff(bounds), lists


def _ranked(pairs: DataFrame) -> DataFrame:
    """``id``, ``tag``, ``line``, ``depth`` and ``rank`` for the places whose pair (``one``, ``two``) stands in two places or more.

    Ranks rise with the pairs, by a sort over ranges; they have gaps.
    """
    path = new_folder(pairs.sparkSession, "ranks")
    with passing_folders(pairs.sparkSession):
        classes = checkpointed(pairs.groupBy("one", "two").agg(F.count("*").alias("n")).where("n > 1").select("one", "two"))
        classes = classes.repartitionByRange("one", "two").sortWithinPartitions("one", "two")
        classes = checkpointed(classes.withColumn("rank", F.monotonically_increasing_id()))
        pairs.join(classes, ["one", "two"]).select("id", "tag", "line", "depth", "rank").write.mode("overwrite").parquet(path)
    return pairs.sparkSession.read.schema("id long, tag long, line int, depth byte, rank long").parquet(path)


def _ranks(documents: DataFrame, run_words: int) -> DataFrame:
    """``id``, ``tag`` and ``ranks``: the (level, line, rank) of a text, at level n of prefixes of 2 ** n lines."""
    lines = documents.select("id", "tag", F.posexplode(F.arrays_zip("one", "size", "depth")).alias("line", "at"))
    lines = lines.select("id", "tag", "line", F.col("at.depth"), F.col("at.one"), F.col("at.size").cast("long").alias("two"))
    level, number = _ranked(lines.where("depth >= 0")), 0
    levels = [level.withColumn("level", F.lit(0))] if run_words == 1 else []
    while 2 << number <= max(run_words, 2):
        # the other half of a prefix is the row so many lines on in the same text: one shuffle, written once, read twice
        half = Window.partitionBy("id", "tag").orderBy("line").rangeBetween(1 << number, 1 << number)
        number += 1
        path = new_folder(level.sparkSession, "pairs")
        pairs = level.withColumn("two", F.first("rank").over(half)).where((F.col("depth") >= number) & F.col("two").isNotNull())
        pairs.withColumnRenamed("rank", "one").write.mode("overwrite").parquet(path)
        pairs = level.sparkSession.read.schema("id long, tag long, line int, depth byte, one long, two long").parquet(path)
        level = _ranked(pairs)
        drop_folder(level.sparkSession, path)
        if level.isEmpty():
            break
        levels.append(level.withColumn("level", F.lit(number)))
    if not levels:
        return level.select("id", "tag", F.array(F.struct(F.lit(0).alias("level"), "line", "rank")).alias("ranks"))
    ranks = levels[0]
    for other in levels[1:]:
        ranks = ranks.unionByName(other)
    return ranks.groupBy("id", "tag").agg(F.collect_list(F.struct("level", "line", "rank")).alias("ranks"))


def _places(source: DataFrame, ranks: DataFrame, run_words: int) -> DataFrame:
    """The cores that stand in an interval: its two ranks as ``head`` and ``tail``, and ``lines``.

    Cores are found anew in the texts that have ranks left, which takes less room than to keep all of them.
    """

    def place(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, tags, texts, known = batch.columns
        columns = wrapped(texts, run_words)[1][3:]
        line, lines, low, runs, around = (c.values.to_numpy() for c in columns)
        row = np.repeat(np.arange(len(ids)), columns[0].value_lengths().to_numpy())
        level, at, rank = (x.to_numpy() for x in known.flatten().flatten())
        owner = np.repeat(np.arange(len(ids)), known.value_lengths().to_numpy())

        def code(row: np.ndarray, level: np.ndarray, line: np.ndarray) -> np.ndarray:
            return row.astype(np.int64) << 40 | level.astype(np.int64) << 32 | line.astype(np.int64)

        codes = code(owner, level, at)
        order = np.argsort(codes)
        codes, rank = np.r_[codes[order], np.int64(-1)], np.r_[rank[order], np.int64(0)]
        rounds = np.frexp(lines)[1] - 1
        found, both = np.ones(len(line), bool), []
        for wanted in (code(row, rounds, line), code(row, rounds, line + lines - (1 << rounds.astype(np.int64)))):
            near = np.searchsorted(codes[:-1], wanted)
            found &= codes[near] == wanted
            both.append(rank[near])
        row, low, runs, lines, head, tail, around = (x[found] for x in (row, low, runs, lines, *both, around))
        arrays = [ids.take(pa.array(row)), tags.take(pa.array(row)), *(pa.array(x) for x in (low, runs, lines, head, tail, around))]
        return pa.RecordBatch.from_arrays(arrays, ["id", "tag", "start", "runs", "lines", "head", "tail", "around"])

    texts = source.select("id", "tag", "text").join(ranks, ["id", "tag"])
    return map_batches(texts, place, "id long, tag long, start int, runs int, lines int, head long, tail long, around long")


def _written_out(source: DataFrame, spots: DataFrame, run_words: int) -> DataFrame:
    """Each run at the spots: where it starts, its hash and its core's interval."""

    def write_out(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, tags, texts, lists = batch.columns
        spans, count = Spans(texts), lists.value_lengths().to_numpy()
        start, runs, lines, head, tail = (x.to_numpy() for x in lists.flatten().flatten())
        row = np.repeat(np.arange(len(ids)), count)
        spot = np.repeat(np.arange(len(start)), runs)
        at = start[spot] + np.arange(len(spot)) - np.repeat(np.cumsum(runs) - runs, runs)
        base = spans.bounds[row[spot]] + at
        arrays = [ids.take(pa.array(row[spot])), tags.take(pa.array(row[spot])), pa.array(at, pa.int32())]
        arrays += [pa.array(spans.ids(base, base + run_words).view(np.int64)), *(pa.array(x[spot]) for x in (lines, head, tail))]
        return pa.RecordBatch.from_arrays(arrays, ["id", "tag", "start", "run", "lines", "head", "tail"])

    def by_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 200):
                yield write_out(batch.slice(at, 200))

    bound_batches(source)
    texts = source.select("id", "tag", "text").join(spots, ["id", "tag"])
    return texts.mapInArrow(by_rows, "id long, tag long, start int, run long, lines int, head long, tail long")


def repeated_runs(docs: DataFrame, run_words: int, id_column: str, text_column: str) -> DataFrame:
    """Texts in which something stands earlier too, or of which there are copies.

    ``key`` (the MD5 of the text), ``first`` (the id that stays), ``words`` and ``runs``: arrays of (start, words) counted
    in words, null if there are none. Texts are told apart by id and a hash, so one id with several texts is no error.
    """
    if run_words < 1:
        raise ValueError("a run has at least one word")
    spark, text = docs.sparkSession, F.col(text_column)
    source = docs.where(F.col(id_column).isNotNull() & text.isNotNull())
    source = source.select(F.unhex(F.md5(text)).alias("key"), F.col(id_column).cast("long").alias("id"), F.xxhash64(text).alias("tag"), text.alias("text"))

    def read(batch: pa.RecordBatch) -> pa.RecordBatch:
        words, lists = wrapped(batch.column(3), run_words)
        return pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(words, pa.int64()), *lists[:3]], ["key", "id", "tag", "words", *_LINES])

    path = new_folder(spark, "runs")
    with passing_folders(spark):
        read_texts = checkpointed(map_batches(source, read, "key binary, id long, tag long, words long, one array<long>, size array<int>, depth array<byte>")).where("words > 0")
        firsts = checkpointed(read_texts.groupBy("key").agg(F.min("id").alias("first"), F.max("id").alias("last"), F.max("words").alias("words"), F.min("tag").alias("tag")))
        # texts too short for a run have no lines to rank; of copies the first one is worked on, once
        once = read_texts.where(F.col("words") >= run_words).join(firsts.select("key", F.col("first").alias("id")), ["key", "id"])
        documents = checkpointed(once.dropDuplicates(["key", "id"]).drop("key", "words"))
        places = checkpointed(_places(source, _ranks(documents, run_words), run_words))

        core, place = ["lines", "head", "tail"], F.struct("id", "tag", "start")
        classes = places.groupBy(*core, "around").agg(F.min(place).alias("earliest"), F.max("runs").alias("runs"), F.count("*").alias("n"))
        classes = checkpointed(classes)
        whole = places.join(classes.where("n > 1").select(*core, "around", "earliest"), [*core, "around"]).where(place != F.col("earliest"))
        whole = whole.select("id", "tag", "start", (F.col("runs") + run_words - 1).alias("words"))

        ends = checkpointed(classes.groupBy(*core).agg(F.count("*").alias("n")).where("n > 1").select(*core))
        spots = classes.join(ends, core).select("earliest.*", "runs", *core)
        spots = spots.groupBy("id", "tag").agg(F.collect_list(F.struct("start", "runs", *core)).alias("spots"))
        runs = checkpointed(_written_out(source, spots, run_words))
        earliest = checkpointed(runs.groupBy(*core, "run").agg(F.min(place).alias("earliest"), F.count("*").alias("n")).where("n > 1").drop("n"))
        single = runs.join(earliest, [*core, "run"]).where(place != F.col("earliest")).select("id", "tag", "start", F.lit(run_words).alias("words"))

        later = whole.unionByName(single).groupBy("id", "tag").agg(F.collect_set(F.struct("start", "words")).alias("runs"))
        later = later.withColumnRenamed("id", "first")
        found = firsts.join(later, ["first", "tag"], "left").where("runs is not null or first < last")
        found.select("key", "first", "words", "runs").write.mode("overwrite").parquet(path)
    return spark.read.schema("key binary, first long, words long, runs array<struct<start int, words int>>").parquet(path)
