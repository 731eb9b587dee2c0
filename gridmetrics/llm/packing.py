"""Packing documents into sequences by minimum bin slack.

A document's ids are cut into windows of the capacity and one rest. A histogram of the rests' lengths,
which has as many entries as the capacity whatever the number of documents, goes to the driver. There
each window starts with the longest rest left and takes the multiset of further lengths whose sum comes
closest to the capacity: a subset-sum over a bitset, with the number of each length found by going back
through the steps. The same multiset is used as often as the counts allow, so a few thousand multisets
describe any number of windows. A rest finds its place by its rank among the rests of its length.

Null text counts as empty; every document has its closing id, so each has at least one piece. Rows come
out for each input row, so repeated rows are packed as often as they occur; a null id is kept. An empty
table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridmetrics.llm.batches import bound_batches, gathered, map_batches
from gridmetrics.llm.bulk_ids import bulk_word_ids
from gridmetrics.llm.storage import checkpointed

#: Pieces of one length that are ranked together.
RANKED_TOGETHER = 1000
#: Texts whose ids are made together where the ids are returned.
ROWS_WITH_IDS = 400


def _sliced(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def token_pieces(
    docs: DataFrame, path: str, capacity: int, closing_id: int, id_column: str = "doc_id", text_column: str = "text", with_ids: bool = True
) -> DataFrame:
    """Per piece: the id, ``start``, ``length``, ``ids_crc32``, ``doc_tokens`` and, if asked for, ``ids``.

    The tokenizer must drop white space, lower-case, split letters from marks and let no token cross a space.
    """
    source = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    step = 4 * capacity

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows, starts, lengths, sums, totals, parts = [], [], [], [], [], []
        ids, counts = bulk_word_ids(path).encode(batch.column(1))
        ids = np.insert(ids, np.cumsum(counts), closing_id).astype("<u4", copy=False)
        data, begin = memoryview(ids.tobytes()), 0
        for row, count in enumerate((counts + 1).tolist()):
            for at in range(begin, begin + 4 * count, step):
                part = data[at : min(at + step, begin + 4 * count)]
                rows.append(row)
                starts.append((at - begin) // 4)
                lengths.append(len(part) // 4)
                sums.append(zlib.crc32(part))
                totals.append(count)
                if with_ids:
                    parts.append(np.frombuffer(part, "<u4").astype(np.int32))
            begin += 4 * count
        columns = [batch.column(0).take(pa.array(rows, pa.int64())), *(pa.array(x, pa.int64()) for x in (starts, lengths, sums, totals))]
        names = ["id", "start", "length", "ids_crc32", "doc_tokens"]
        if with_ids:
            columns.append(pa.array(parts, pa.list_(pa.int32())))
            names.append("ids")
        return pa.RecordBatch.from_arrays(columns, names)

    kind = source.schema["id"].dataType.simpleString()
    schema = f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * with_ids
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Ids take as much room again as the texts, so there are fewer texts at a time where they are returned.
        portions = _sliced(batches, ROWS_WITH_IDS) if with_ids else gathered(batches)
        for portion in portions:
            yield cut(portion)
            pa.default_memory_pool().release_unused()

    bound_batches(source)
    return source.mapInArrow(run, schema).withColumnRenamed("id", id_column)


def closest_multiset(counts: dict[int, int], room: int) -> dict[int, int]:
    """How many of each length fill ``room`` best; ``counts`` holds what there is, longest first."""
    reached, steps, within = 1, [], (1 << (room + 1)) - 1
    for length, most in counts.items():
        if length > room or not most:
            continue
        steps.append((length, most, reached))
        left, take = min(most, room // length), 1
        while left:
            take = min(take, left)
            reached |= (reached << (take * length)) & within
            left -= take
            take *= 2
        if reached >> room:
            break
    total, chosen = reached.bit_length() - 1, {}
    for length, most, before in reversed(steps):
        used = next(n for n in count() if total >= n * length and before >> (total - n * length) & 1)
        if used:
            chosen[length] = used
            total -= used * length
    return chosen


def windows(histogram: dict[int, int], capacity: int) -> Iterator[tuple[dict[int, int], int]]:
    """Multisets of lengths and how many windows each fills."""
    left = {length: histogram[length] for length in sorted(histogram, reverse=True)}
    while left:
        first = next(iter(left))
        chosen = closest_multiset({**left, first: left[first] - 1}, capacity - first)
        chosen[first] = chosen.get(first, 0) + 1
        times = min(left[length] // used for length, used in chosen.items())
        yield chosen, times
        for length, used in chosen.items():
            left[length] -= times * used
            if not left[length]:
                del left[length]


class Places:
    """Sequence and offset by length and rank; its size is bounded by the capacity alone."""

    #: Ranks of one length stay below this.
    SPAN = 1 << 50

    def __init__(self, histogram: dict[int, int], capacity: int) -> None:
        taken, rows, sequence = dict.fromkeys(histogram, 0), [], 0
        for chosen, times in windows(histogram, capacity):
            offset = 0
            for length in sorted(chosen, reverse=True):
                rows.append((length * self.SPAN + taken[length], chosen[length], sequence, offset))
                taken[length] += chosen[length] * times
                offset += chosen[length] * length
            sequence += times
        self.starts, self.used, self.sequences, self.offsets = np.array(sorted(rows), np.int64).reshape(-1, 4).T

    def find(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = lengths * self.SPAN + ranks
        at = np.searchsorted(self.starts, keys, side="right") - 1
        turn, slot = np.divmod(keys - self.starts[at], self.used[at])
        return self.sequences[at] + turn, self.offsets[at] + slot * lengths


def pack(pieces: DataFrame, capacity: int, order: list[str]) -> DataFrame:
    """``pieces`` (with a long ``length`` from 1 to the capacity) with ``sequence_id`` and ``offset``.

    ``order`` names columns that put pieces of one length in a fixed order. A sequence holds at most
    ``capacity`` tokens, gapless from 0. The pieces are kept in the checkpoint folder meanwhile.
    """
    own = pieces.columns
    pieces = checkpointed(pieces)
    histogram = {row["length"]: row["n"] for row in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    if any(not 0 < length <= capacity for length in histogram):
        raise ValueError(f"lengths must be from 1 to {capacity}")
    places = Places(histogram, capacity)
    groups = F.array(*(F.lit(-(-histogram.get(n, 0) // RANKED_TOGETHER)) for n in range(1, capacity + 1)))
    salt = F.pmod(F.xxhash64(*order), F.greatest(F.lit(1), F.element_at(groups, F.col("length").cast("int"))))
    ranked = pieces.withColumn("_salt", salt)
    counts = ranked.groupBy("length", "_salt").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("length", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("length", "_salt").orderBy(*order)
    ranked = ranked.withColumn("_rank", F.row_number().over(inside)).join(counts, ["length", "_salt"])
    ranked = ranked.select(*own, (F.col("_before") + F.col("_rank") - 1).alias("_rank"))

    def place(batch: pa.RecordBatch) -> pa.RecordBatch:
        lengths, ranks = (batch.column(batch.schema.get_field_index(n)).to_numpy(zero_copy_only=False).astype(np.int64) for n in ("length", "_rank"))
        found = places.find(lengths, ranks) if len(lengths) else (lengths, ranks)
        return pa.RecordBatch.from_arrays([*(batch.column(n) for n in range(len(own))), *map(pa.array, found)], [*own, "sequence_id", "offset"])

    bound_batches(ranked)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return map_batches(ranked, place, f"{kinds}, sequence_id long, offset long")


def packed_documents(docs: DataFrame, path: str, capacity: int, closing_id: int, id_column: str = "doc_id", text_column: str = "text", with_ids: bool = True) -> DataFrame:
    """Pieces of documents with their places in sequences."""
    pieces = token_pieces(docs, path, capacity, closing_id, id_column, text_column, with_ids)
    return pack(pieces, capacity, [id_column, "start", "ids_crc32", "doc_tokens"])
