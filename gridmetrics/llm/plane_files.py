"""Token ids in files of bit-plane shuffled, compressed blocks with a chunk index.

The ids of all documents, in ascending order of their document ids and each closed by an end id, are one
long sequence. It is dealt out by range over parts, sorted there, encoded and cut into blocks of a fixed
number of ids (the last of a part is shorter). A block is transposed into planes: the k-th byte (or bit)
of all its ids stands together, so that the upper planes are nearly constant, and each plane is compressed
with zstandard. Planes above the highest one in use are not stored.

The files are a Parquet table, so that a lost executor costs one task and no half-written file is ever
read. A row is a chunk: ``payload`` is the block, the other columns are the chunk index (``part``,
``chunk``, ``first`` (ids of the part before it), ``n_ids``, ``n_bytes``, ``crc`` of the payload) and the
documents that the block touches (``doc_ids``, ``doc_starts`` in the part, ``doc_tokens``), at most one
more than it has ids. The index is read without payloads, and a range of ids without other chunks
(:func:`ids_between`). A payload is, little-endian: ``BPID``, version, planes per id, 1 for bit or 8 for byte
planes, a zero byte, the number of ids (32 bits), the length of each compressed plane (32 bits each), the planes.

Null text counts as empty and has its end id. Null document ids come first. Rows with one document id
follow a hash of their texts, then the texts; repeated rows are documents of their own. Only the
id and the text of the input are used, under any names. An empty table gives files without chunks,
which read back as an empty table.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridmetrics.llm.batches import bound_batches, gathered
from gridmetrics.llm.bulk_ids import bulk_ids, ragged

#: Ids of a block, and the level of compression.
BLOCK_IDS = 65_536
LEVEL = 3

MAGIC, VERSION = b"BPID", 1
_HEAD = struct.Struct("<4sBBBBI")
_CRC_POLYNOMIAL = 0xEDB88320


def pack_block(ids: np.ndarray, plane_bits: int = 8) -> bytes:
    """A block of ids (unsigned 32-bit) as the bytes of a payload."""
    if plane_bits not in (1, 8):
        raise ValueError("planes are of 1 or 8 bits")
    ids = np.ascontiguousarray(ids, "<u4")
    planes = -(-int(ids.max(initial=0)).bit_length() // plane_bits)
    if plane_bits == 8:
        rows = [row.tobytes() for row in ids.view(np.uint8).reshape(-1, 4).T[:planes]]
    else:
        rows = [np.packbits(((ids >> k) & 1).astype(np.uint8), bitorder="little").tobytes() for k in range(planes)]
    press = zstandard.ZstdCompressor(level=LEVEL)
    rows = [press.compress(row) for row in rows]
    head = _HEAD.pack(MAGIC, VERSION, planes, plane_bits, 0, len(ids))
    return b"".join([head, struct.pack(f"<{planes}I", *map(len, rows)), *rows])


def unpack_block(payload: bytes) -> np.ndarray:
    """The ids of a payload; one that is cut short or of another kind raises ValueError."""
    if len(payload) < _HEAD.size:
        raise ValueError("payload without a head")
    magic, version, planes, plane_bits, _, n = _HEAD.unpack_from(payload)
    at = _HEAD.size + 4 * planes
    if magic != MAGIC or version != VERSION or plane_bits not in (1, 8) or len(payload) < at:
        raise ValueError("not a payload of this version")
    sizes = struct.unpack_from(f"<{planes}I", payload, _HEAD.size)
    if at + sum(sizes) != len(payload):
        raise ValueError("payload of another length")
    press, ids = zstandard.ZstdDecompressor(), np.zeros(n, np.uint32)
    for k, size in enumerate(sizes):
        raw = np.frombuffer(press.decompress(payload[at : at + size]), np.uint8)
        values = raw if plane_bits == 8 else np.unpackbits(raw, count=n, bitorder="little")
        if len(values) != n:
            raise ValueError("plane of another length")
        ids |= values.astype(np.uint32) << np.uint32(k * plane_bits)
        at += size
    return ids


def _times(a: int, b: int) -> int:
    """Product of two polynomials over bits modulo that of the crc."""
    product, bit = 0, 1 << 31
    while bit:
        if a & bit:
            product ^= b
        b = (b >> 1) ^ _CRC_POLYNOMIAL if b & 1 else b >> 1
        bit >>= 1
    return product


def crc_before(crc: int, n_bytes: int) -> int:
    """What ``crc`` of some bytes adds to the crc of these with ``n_bytes`` more after them.

    The crc of a whole is the exclusive or of what its parts add.
    """
    power, left, result = 1 << 23, n_bytes, crc  # the polynomial of one byte
    while left:
        if left & 1:
            result = _times(power, result)
        power = _times(power, power)
        left >>= 1
    return result


class _Part:
    """The blocks of one part, as its ids come in."""

    def __init__(self, part: int, block_ids: int, plane_bits: int, schema: pa.Schema) -> None:
        self.part, self.block_ids, self.plane_bits, self.schema = part, block_ids, plane_bits, schema
        self.ids, self.first, self.chunk = np.empty(0, np.uint32), 0, 0
        self.docs = pa.array([], schema.field("doc_ids").type.value_type)
        self.starts, self.tokens = np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, docs: pa.Array, ids: np.ndarray, tokens: np.ndarray) -> Iterator[pa.RecordBatch]:
        starts = self.first + len(self.ids) + np.cumsum(tokens) - tokens
        self.ids = np.concatenate([self.ids, ids])
        self.docs = pa.concat_arrays([self.docs, docs.cast(self.docs.type)])
        self.starts, self.tokens = np.concatenate([self.starts, starts]), np.concatenate([self.tokens, tokens])
        yield from self._blocks(len(self.ids) // self.block_ids * self.block_ids)

    def end(self) -> Iterator[pa.RecordBatch]:
        yield from self._blocks(len(self.ids))

    def _blocks(self, upto: int) -> Iterator[pa.RecordBatch]:
        for at in range(0, upto, self.block_ids):
            ids = self.ids[at : min(at + self.block_ids, upto)]
            low, high = self.first + at, self.first + at + len(ids)
            a = np.searchsorted(self.starts + self.tokens, low, "right")
            b = np.searchsorted(self.starts, high, "left")
            payload = pack_block(ids, self.plane_bits)
            row = [self.part, self.chunk, low, len(ids), len(payload), zlib.crc32(payload), payload]
            lists = [pa.ListArray.from_arrays(pa.array([0, b - a], pa.int32()), x) for x in (self.docs[a:b], pa.array(self.starts[a:b]), pa.array(self.tokens[a:b]))]
            columns = [*(pa.array([value]) for value in row), *lists]
            yield pa.RecordBatch.from_arrays([column.cast(field.type) for column, field in zip(columns, self.schema)], schema=self.schema)
            self.chunk += 1
        self.ids, self.first = self.ids[upto:], self.first + upto
        done = np.searchsorted(self.starts + self.tokens, self.first, "right")
        self.docs, self.starts, self.tokens = self.docs[done:], self.starts[done:], self.tokens[done:]


def write_ids(
    docs: DataFrame,
    path: str,
    folder: str,
    end_id: int = 0,
    id_column: str = "doc_id",
    text_column: str = "text",
    block_ids: int = BLOCK_IDS,
    plane_bits: int = 8,
) -> None:
    """Write the ids of all documents below ``folder``."""
    source = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    order = [F.col("id").asc_nulls_first(), F.xxhash64("text")]
    source = source.repartitionByRange(*order).sortWithinPartitions(*order, "text")
    kind = source.schema["id"].dataType.simpleString()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, encoder = None, bulk_ids(path)
        for batch in gathered(batches):
            if part is None:
                ints, longs = pa.int32(), pa.int64()
                types = [ints, ints, longs, ints, ints, longs, pa.binary(), pa.list_(batch.column(0).type), pa.list_(longs), pa.list_(longs)]
                part = _Part(TaskContext.get().partitionId(), block_ids, plane_bits, pa.schema(list(zip(_NAMES, types))))
            ids, tokens = encoder.encode(batch.column(1))
            ends = np.cumsum(tokens)
            yield from part.add(batch.column(0), np.insert(ids, ends, end_id), tokens + 1)
        if part is not None:
            yield from part.end()

    bound_batches(source)
    chunks = source.mapInArrow(write, _SCHEMA.format(kind))
    chunks.write.mode("overwrite").option("compression", "uncompressed").parquet(folder)


_SCHEMA = "part int, chunk int, first long, n_ids int, n_bytes int, crc long, payload binary, doc_ids array<{}>, doc_starts array<long>, doc_tokens array<long>"
_NAMES = [column.split()[0] for column in _SCHEMA.split(", ")]


def part_offsets(spark: SparkSession, folder: str) -> DataFrame:
    """``part`` and ``offset``, the ids of all parts before it, from the chunk index; one row a part."""
    sums = spark.read.parquet(folder).groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))


def _checked(payload: bytes, crc: int, where: str) -> np.ndarray:
    if zlib.crc32(payload) != crc:
        raise ValueError(f"{where}: the payload is damaged")
    return unpack_block(payload)


def read_documents(spark: SparkSession, folder: str, id_column: str = "doc_id") -> DataFrame:
    """Per document, from the files: its id, ``start``, ``n_tokens`` and ``ids_crc32``, the end id included.

    Each block gives what it holds of its documents; a document in several blocks is put together from
    the crcs of its stretches, so no task ever holds a whole one.
    """
    chunks = spark.read.parquet(folder)
    kind = chunks.schema["doc_ids"].dataType.elementType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                row = {name: batch.column(name)[n] for name in batch.schema.names}
                part, first = row["part"].as_py(), row["first"].as_py()
                data = _checked(row["payload"].as_py(), row["crc"].as_py(), f"part {part}, first {first}").tobytes()
                docs = row["doc_ids"].values
                starts, tokens = (row[name].values.to_numpy(zero_copy_only=False) for name in ("doc_starts", "doc_tokens"))
                low = np.maximum(starts, first) - first
                high = np.minimum(starts + tokens, first + len(data) // 4) - first
                after = starts + tokens - first - high
                sums = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(low.tolist(), high.tolist())]
                for k in np.flatnonzero(after):  # the last at most
                    sums[k] = crc_before(sums[k], 4 * int(after[k]))
                columns = [docs, pa.array(np.full(len(docs), part, np.int32)), starts, high - low, pa.array(sums, pa.int64())]
                yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["id", "part", "doc_start", "length", "crc"])

    bound_batches(chunks)
    columns = ["part", "first", "crc", "payload", "doc_ids", "doc_starts", "doc_tokens"]
    found = chunks.select(columns).mapInArrow(read, f"id {kind}, part int, doc_start long, length long, crc long")
    whole = found.groupBy("part", "doc_start").agg(F.first("id").alias(id_column), F.sum("length").alias("n_tokens"), F.bit_xor("crc").alias("ids_crc32"))
    start = (F.col("offset") + F.col("doc_start")).alias("start")
    return whole.join(part_offsets(spark, folder), "part").select(id_column, start, "n_tokens", "ids_crc32")


def ids_between(spark: SparkSession, folder: str, start: int, stop: int) -> DataFrame:
    """``position`` and ``id`` of the ids from ``start`` up to ``stop``; only chunks that hold some are decoded."""
    chunks = spark.read.parquet(folder).join(part_offsets(spark, folder), "part")
    chunks = chunks.withColumn("at", F.col("offset") + F.col("first"))
    chunks = chunks.where((F.col("at") < stop) & (F.col("at") + F.col("n_ids") > start))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, crc, payload in zip(*(batch.column(n).to_pylist() for n in range(3))):
                ids = _checked(payload, crc, f"chunk at {at}")
                low, high = max(start - at, 0), min(stop - at, len(ids))
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(at + low, at + high)), pa.array(ids[low:high].astype(np.int64))], ["position", "id"])

    return chunks.select("at", "crc", "payload").mapInArrow(read, "position long, id long")


def document_ids(spark: SparkSession, folder: str, id_column: str = "doc_id") -> DataFrame:
    """The ids themselves: a row for each stretch of a document in a block, with ``start`` (in the sequence) and ``ids``."""
    chunks = spark.read.parquet(folder).join(part_offsets(spark, folder), "part")
    kind = chunks.schema["doc_ids"].dataType.elementType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                row = {name: batch.column(name)[n] for name in batch.schema.names}
                first, offset = row["first"].as_py(), row["offset"].as_py()
                ids = _checked(row["payload"].as_py(), row["crc"].as_py(), f"first {first}")
                starts, tokens = (row[name].values.to_numpy(zero_copy_only=False) for name in ("doc_starts", "doc_tokens"))
                low = np.maximum(starts, first) - first
                lengths = np.minimum(starts + tokens, first + len(ids)) - first - low
                bounds = pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32())
                lists = pa.ListArray.from_arrays(bounds, pa.array(ids[ragged(low, lengths)].astype(np.int64)))
                yield pa.RecordBatch.from_arrays([row["doc_ids"].values, pa.array(offset + first + low), lists], [id_column, "start", "ids"])

    bound_batches(chunks)
    columns = ["first", "offset", "crc", "payload", "doc_ids", "doc_starts", "doc_tokens"]
    return chunks.select(columns).mapInArrow(read, f"`{id_column}` {kind}, start long, ids array<long>")
