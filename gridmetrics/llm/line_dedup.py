"""Deletion of repeated passages, in lines or across them, and of repeated runs of whole lines.

``without_repeated_passages`` finds what repeats inside longer lines too, and cuts it out of them, by the
suffix array over rewrapped lines of ``repeated_runs``. The first place of each run stays.

``without_repeated_lines`` deletes whole lines only; the rest of this text is about it.

Texts are sequences of line ids; lines without a word are passed over. Suffixes are ranked by their
first line, then by their first 2, 4, 8, ... lines: the rank of a doubled prefix is the rank of the
pair of its halves, given by a distributed sort. Prefixes that stand in one place only are dropped at
once, so each round works on what is still repeated.

A run of lines counts if it has enough words. Every line has a word, so the shortest counting run at any
place has no more lines than that, and the doubling ends there however long texts are. The suffixes
that share such a run are an interval of the suffix array whose longest common prefix is at least the
run; a prefix of any length is the pair of two ranked ones that overlap. In each interval the first
place, by document id and line, stays and the others are deleted. Shortest counting runs are taken
forwards from every line and backwards from every line; together they cover the maximal repeated runs,
and nothing else.

Equal texts are one document here: the one of the smallest id stays first, and the others go whole if
they have enough words for a run. So no interval holds the many places of a much copied text.

Rows with null text, without words or with a null id are left as they are. Repeated rows (equal id and
text) are treated alike. Ids are integers and name one text. An empty table gives an empty result. The
other columns are passed through.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

from gridmetrics.llm.batches import bound_batches, map_batches
from gridmetrics.llm.repeated_runs import repeated_runs
from gridmetrics.llm.storage import checkpointed

#: Words that a run has at least.
RUN_WORDS = 50

_WORD = re.compile(r"[^\x20\x09-\x0D]")
_WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def worded_lines(text: str) -> list[int]:
    """Numbers of the lines that have a word."""
    return [n for n, line in enumerate(text.split("\n")) if _WORD.search(line)]


def shortest_runs(words: np.ndarray, enough: int) -> tuple[np.ndarray, np.ndarray]:
    """Lines of the shortest counting run that begins, and that ends, at each line; 0 if there is none."""
    sums = np.concatenate([[0], np.cumsum(words)])
    places = np.arange(len(words))
    ends = np.searchsorted(sums, sums[:-1] + enough, side="left")
    starts = np.searchsorted(sums, sums[1:] - enough, side="right") - 1
    return np.where(ends <= len(words), ends - places, 0), np.where(starts >= 0, places + 1 - starts, 0)


def _documents(docs: DataFrame, run_words: int, id_column: str, text_column: str) -> DataFrame:
    """Per row with words and an id: ``key`` of the text, ``id``, ``words``, and by line the id's halves and shortest runs."""
    text = F.col(text_column)
    source = docs.where(F.col(id_column).isNotNull() & text.isNotNull())
    source = source.select(F.unhex(F.md5(text)).alias("key"), F.col(id_column).cast("long").alias("id"), text.alias("text"))

    def read(batch: pa.RecordBatch) -> pa.RecordBatch:
        totals, columns = [], ([], [], [], [])
        for value in batch.column(2):
            lines = [line for line in value.as_py().encode().split(b"\n") if line.strip()]
            words = np.array([len(line.split()) for line in lines], np.int64)
            ids = [xxhash.xxh3_128_digest(line) for line in lines]
            halves = np.frombuffer(b"".join(ids), np.int64).reshape(-1, 2)
            totals.append(int(words.sum()))
            for column, part in zip(columns, (halves[:, 0], halves[:, 1], *shortest_runs(words, run_words)), strict=True):
                column.append(part)
        arrays = [pa.array(x, pa.list_(kind)) for x, kind in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.int32()), strict=True)]
        return pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(totals, pa.int64()), *arrays], ["key", "id", "words", "one", "two", "onward", "back"])

    return map_batches(source, read, "key binary, id long, words long, one array<long>, two array<long>, onward array<int>, back array<int>")


def _ranked(pairs: DataFrame) -> DataFrame:
    """``key``, ``line`` and ``rank`` for the places whose pair (``one``, ``two``) stands in two places or more.

    Ranks rise with the pairs, by a sort over ranges; they have gaps.
    """
    classes = pairs.groupBy("one", "two").agg(F.count("*").alias("n")).where("n > 1").select("one", "two")
    classes = classes.repartitionByRange("one", "two").sortWithinPartitions("one", "two")
    classes = checkpointed(classes.withColumn("rank", F.monotonically_increasing_id()))
    return checkpointed(pairs.join(classes, ["one", "two"]).select("key", "line", "rank"))


def _later_runs(documents: DataFrame, run_words: int) -> DataFrame:
    """``key``, ``start`` and ``lines`` of the counting runs that have an earlier copy; keys are of different texts."""
    lines = documents.select("key", "id", F.posexplode(F.arrays_zip("one", "two", "onward", "back")).alias("line", "at"))
    lines = checkpointed(lines.select("key", "id", "line", "at.*"))
    level = _ranked(lines.select("key", "line", "one", "two"))
    levels, size, depth = [level.withColumn("level", F.lit(0))], 1, 0
    while 2 * size <= run_words and not level.isEmpty():
        second = level.select("key", (F.col("line") - size).alias("line"), F.col("rank").alias("two"))
        level = _ranked(level.withColumnRenamed("rank", "one").join(second, ["key", "line"]))
        size, depth = 2 * size, depth + 1
        levels.append(level.withColumn("level", F.lit(depth)))
    ranks = levels[0]
    for other in levels[1:]:
        ranks = ranks.unionByName(other)

    onward = lines.where("onward > 0").select("key", "id", F.col("line").alias("start"), F.col("onward").alias("lines"))
    back = lines.where("back > 0").select("key", "id", (F.col("line") - F.col("back") + 1).alias("start"), F.col("back").alias("lines"))
    runs = onward.unionByName(back).distinct()
    runs = runs.withColumn("level", F.floor(F.log2(F.col("lines") + 0.5)).cast("int"))
    runs = runs.withColumn("inner", (F.col("start") + F.col("lines") - F.expr("shiftleft(1, level)")).cast("int"))
    head = ranks.select("key", "level", F.col("line").alias("start"), F.col("rank").alias("head"))
    tail = ranks.select("key", "level", F.col("line").alias("inner"), F.col("rank").alias("tail"))
    runs = checkpointed(runs.join(head, ["key", "level", "start"]).join(tail, ["key", "level", "inner"]))
    interval = ["lines", "head", "tail"]
    place = F.struct("id", "key", "start")
    firsts = runs.groupBy(*interval).agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    return runs.join(firsts, interval).where(place != F.col("first")).select("key", "start", "lines")


def deletions(docs: DataFrame, run_words: int = RUN_WORDS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Texts in which something is deleted or of which there are copies.

    ``key`` (the MD5 of the text), ``first`` (the id that stays), ``words`` and ``runs``: arrays of
    (start, lines) counted over the lines with a word, null if there are none.
    """
    documents = checkpointed(_documents(docs, run_words, id_column, text_column))
    firsts = documents.groupBy("key").agg(F.min("id").alias("first"), F.max("id").alias("last"), F.max("words").alias("words"))
    unique = documents.join(firsts.select("key", F.col("first").alias("id")), ["key", "id"]).dropDuplicates(["key"])
    runs = _later_runs(unique, run_words).groupBy("key").agg(F.collect_list(F.struct("start", "lines")).alias("runs"))
    return firsts.join(runs, "key", "left").where("runs is not null or first < last")


def without_runs(text: str, runs: list | None) -> str:
    """``text`` without the lines of the runs, without all if ``runs`` is null; empty if no word is left."""
    if runs is None:
        return ""
    lines, numbers = text.split("\n"), worded_lines(text)
    gone = {numbers[at] for start, size in runs for at in range(start, start + size)}
    left = [line for n, line in enumerate(lines) if n not in gone]
    return "\n".join(left) if len(gone) < len(numbers) else ""


def without_repeated_lines(
    docs: DataFrame, run_words: int = RUN_WORDS, id_column: str = "doc_id", text_column: str = "text", counts: tuple[str, str] | None = None
) -> DataFrame:
    """``docs`` with later copies of repeated line runs deleted from the text.

    ``counts`` names two more columns: lines with a word before, and those deleted.
    """
    found = deletions(docs, run_words, id_column, text_column)
    return _shortened(docs, found, without_runs, run_words, id_column, text_column, counts)


def _shortened(
    docs: DataFrame, found: DataFrame, cut: Callable[[str, list], str], run_words: int, id_column: str, text_column: str, counts: tuple[str, str] | None
) -> DataFrame:
    """``docs`` with ``cut`` applied to the texts and runs found."""
    found = found.withColumnsRenamed({name: f"_line_{name}" for name in found.columns})
    text, own = F.col(text_column), docs.columns
    joined = docs.join(found, F.unhex(F.md5(text)) == F.col("_line_key"), "left")
    copy = (F.col("_line_first") != F.col(id_column)) & (F.col("_line_words") >= run_words)
    some = F.col("_line_runs").isNotNull() & (F.col("_line_first") == F.col(id_column))
    joined = joined.withColumn("_line_change", F.when(copy, F.lit("all")).when(some, F.lit("some")).otherwise(F.lit("none")))

    @pandas_udf("string")
    def shorten(texts: pd.Series, lists: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else cut(t, [tuple(r.values()) for r in runs]) for t, runs in zip(texts, lists, strict=True)])

    def worded(column: str) -> Column:
        return F.size(F.filter(F.split(F.coalesce(F.col(column), F.lit("")), "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))).cast("long")

    bound_batches(docs)
    change = F.col("_line_change")
    cut_text = shorten(F.when(change == "some", text), F.when(change == "some", F.col("_line_runs")))  # others go as nulls
    result = joined.withColumn("_line_cut", cut_text)
    result = result.withColumn("_line_text", F.when(change == "some", F.col("_line_cut")).when(change == "all", F.lit("")).otherwise(text))
    extra = [] if counts is None else [worded(text_column).alias(counts[0]), (worded(text_column) - worded("_line_text")).alias(counts[1])]
    return result.select(*(F.col("_line_text").alias(c) if c == text_column else F.col(c) for c in own), *extra)


def without_words(text: str, runs: list) -> str:
    """``text`` without the words of the runs and without the lines that lose all; empty if no word is left."""
    gone = {n for start, size in runs for n in range(start, start + size)}
    left, number, some = [], 0, False
    for line in text.split("\n"):
        words = [m.start() for m in _WORDS.finditer(line)]
        kept = [n for n in range(len(words)) if number + n not in gone]
        if len(kept) == len(words):
            left.append(line)
        elif kept:
            ends = [*words[1:], len(line)]
            pieces = line[: words[0]] + "".join(line[words[n] : ends[n]] for n in kept)
            left.append(pieces if kept[-1] == len(words) - 1 else pieces.rstrip(" \t\r\v\f"))
        number, some = number + len(words), some or bool(kept)
    return "\n".join(left) if some else ""


def without_repeated_passages(
    docs: DataFrame, run_words: int = RUN_WORDS, id_column: str = "doc_id", text_column: str = "text", counts: tuple[str, str] | None = None
) -> DataFrame:
    """``docs`` with later copies of runs of ``run_words`` words or more cut out of the text, in lines or across them.

    ``counts`` names two more columns: lines with a word before, and those of which nothing is left.
    """
    found = repeated_runs(docs, run_words, id_column, text_column)
    return _shortened(docs, found, without_words, run_words, id_column, text_column, counts)
