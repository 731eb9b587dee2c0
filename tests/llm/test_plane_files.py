"""Plane files: exact round trips, and the ids of the tokenizers library."""

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from gridmetrics.llm import bulk_ids, plane_files
from gridmetrics.workspace import new_folder

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
SIGNS = [*"ab 'lrestveéß日\n\t1!-. 　\x1c😀\x85", "<|endoftext|>", "  ", " the", "  "]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from(SIGNS), max_size=14).map("".join) | st.none(), max_size=12))
def test_bulk_ids_equal_the_tokenizer(texts):
    tokenizer = Tokenizer.from_file(BYTE_BPE)
    want = [tokenizer.encode(text or "", add_special_tokens=False).ids for text in texts]
    ids, counts = bulk_ids.bulk_ids(BYTE_BPE).encode(pa.array(texts, pa.string()))
    assert counts.tolist() == [len(one) for one in want]
    assert ids.tolist() == [i for one in want for i in one]


WORD_SIGNS = [*"abXYZ 'ſéßİΣσ日1!-.,?_*", "\n", "\t", "\x85", "\u0301", "e\u0301", "\u3000", " The", "<|endoftext|>", "<|STARTOFTEXT|>", "it's", "<", "|>"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from(WORD_SIGNS), max_size=14).map("".join) | st.none(), max_size=12))
def test_bulk_word_ids_equal_the_tokenizer(texts):
    tokenizer = Tokenizer.from_file(WORD_BPE)
    want = [tokenizer.encode(text or "", add_special_tokens=False).ids for text in texts]
    ids, counts = bulk_ids.bulk_word_ids(WORD_BPE).encode(pa.array(texts, pa.string()))
    assert counts.tolist() == [len(one) for one in want]
    assert ids.tolist() == [i for one in want for i in one]


def test_words_forgotten_are_encoded_again(monkeypatch):
    monkeypatch.setattr(bulk_ids, "KEPT_WORDS", 10)
    encoder, tokenizer = bulk_ids.BulkIds(BYTE_BPE), Tokenizer.from_file(BYTE_BPE)
    for k in range(8):
        texts = [f"word{n} again the word{n + k} {'long' * 30}" for n in range(k, k + 9)]
        ids, counts = encoder.encode(pa.array(texts))
        want = [tokenizer.encode(text, add_special_tokens=False).ids for text in texts]
        assert ids.tolist() == [i for one in want for i in one] and counts.tolist() == [len(one) for one in want]
        assert len(encoder.places) <= 50


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=70), st.sampled_from([1, 8]))
def test_blocks_round_trip(ids, plane_bits):
    payload = plane_files.pack_block(np.array(ids, np.uint32), plane_bits)
    assert plane_files.unpack_block(payload).tolist() == ids
    for bad in (payload[:-1], payload + b"x", b"XXXX" + payload[4:], payload[:3]):
        with pytest.raises(ValueError):
            plane_files.unpack_block(bad)


@given(st.lists(st.binary(max_size=40), min_size=1, max_size=5))
def test_crcs_of_parts(parts):
    whole, after = 0, sum(map(len, parts))
    for part in parts:
        after -= len(part)
        whole ^= plane_files.crc_before(zlib.crc32(part), after)
    assert whole == zlib.crc32(b"".join(parts))


TEXTS = [None, "", "the quick brown fox", "x" * 3000, "日本語 " * 400, "a  b\n c <|endoftext|> d", "the quick brown fox", "word " * 5000]


@pytest.mark.parametrize(("block_ids", "plane_bits"), [(65_536, 8), (64, 8), (1000, 1)])
def test_documents_read_back(spark, block_ids, plane_bits):
    rows = [(k * 7 % 10, text, 1, "p") for k, text in enumerate(TEXTS)] + [(None, "no id", 1, "p"), (None, None, 1, "p"), (3, "y", 1, "p")]
    rows += [rows[3]] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, first int, payload string").repartition(4)
    folder = new_folder(spark, "ids")
    plane_files.write_ids(docs, BYTE_BPE, folder, block_ids=block_ids, plane_bits=plane_bits)
    tokenizer = Tokenizer.from_file(BYTE_BPE)
    encoded = [(row[0], [*tokenizer.encode(row[1] or "", add_special_tokens=False).ids, 0]) for row in rows]
    got = sorted((tuple(row) for row in plane_files.read_documents(spark, folder).collect()), key=lambda row: row[1])
    assert Counter((doc, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for doc, ids in encoded) == Counter((row[0], *row[2:]) for row in got)
    assert [row[0] for row in got] == sorted((row[0] for row in rows), key=lambda doc: (doc is not None, doc))
    assert [row[1] for row in got] == [sum(row[2] for row in got[:k]) for k in range(len(got))]
    stretches = sorted((tuple(row) for row in plane_files.document_ids(spark, folder).collect()), key=lambda row: row[1])
    sequence = [i for *_, ids in stretches for i in ids]
    assert len(sequence) == sum(len(ids) for _, ids in encoded)
    total = len(sequence)
    for start, stop in ((0, 10), (60, 200), (total - 5, total + 5), (5, 5)):
        found = plane_files.ids_between(spark, folder, start, stop).orderBy("position").collect()
        assert [row.id for row in found] == sequence[start:stop]
        assert [row.position for row in found] == list(range(start, min(stop, total)))
    sizes = spark.read.parquet(folder).groupBy("part").agg({"n_ids": "max", "chunk": "max"}).collect()
    assert all(row["max(n_ids)"] == block_ids for row in sizes if row["max(chunk)"] > 0)


def test_damage_is_noticed(spark):
    folder, spoiled = new_folder(spark, "ids"), new_folder(spark, "spoiled")
    plane_files.write_ids(spark.createDataFrame([(1, "some text")], "doc_id long, text string"), BYTE_BPE, folder)
    spark.read.parquet(folder).selectExpr("part", "chunk", "first", "n_ids", "n_bytes", "crc + 1 as crc", "payload", "doc_ids", "doc_starts", "doc_tokens").write.mode("overwrite").parquet(spoiled)
    with pytest.raises(Exception, match="damaged"):
        plane_files.read_documents(spark, spoiled).collect()


def test_empty_table(spark):
    folder = new_folder(spark, "ids")
    plane_files.write_ids(spark.createDataFrame([], "doc_id long, text string"), BYTE_BPE, folder)
    assert plane_files.read_documents(spark, folder).collect() == []
