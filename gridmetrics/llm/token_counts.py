"""Token counts: the exact count of every prefix of a text, by prefix dynamic programming.

For a byte-level BPE a sequence of tokens is an encoding exactly if every two neighbours are one. So
the encoding of a prefix ends with the one token whose neighbour, the last token of the shorter
prefix, it may follow, and one pass over a text gives the token count of all its prefixes. The count
of a prefix is what the tokenizer gives for that prefix as a text of its own, not the number of
tokens of the whole text that end before it.

Texts are cut before white space that follows other characters: no token crosses such a place,
however the text goes on. A worker keeps the counts of such units.

The table of a text is one signed byte a character: what this character adds to the count. It answers
how many tokens a prefix has (:func:`tokens_in_prefix`) and how long a prefix fits in a budget
(:func:`prefix_for_budget`) without encoding again.

Null text counts as empty: no tokens, an empty table. Rows come out one for one, so repeated rows and
ids stay, and a null id stays null. An empty table gives an empty table of the same columns.
"""

from __future__ import annotations

import json
import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf
from tokenizers import Tokenizer

from gridmetrics.llm.batches import map_batches
from gridmetrics.llm.kept import Kept

#: Unicode's White_Space.
_WHITE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
_UNIT = re.compile(f"[{_WHITE}]*[^{_WHITE}]+|[{_WHITE}]+")
_RUN = re.compile(f"[{_WHITE}]*")

#: Entries that a worker keeps; when there are more, those not used since the last time go.
KEPT_UNITS = 250_000
KEPT_PAIRS = 500_000

_MARKS = ".,;:!?"
#: Two white space characters in a row, the second a space: then a text cannot be cut at each space.
_RUN_TO_SPACE = re.compile(f"[{_WHITE}] ")


def _byte_alphabet() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + n) for n, b in enumerate(others)}


_ALPHABET = _byte_alphabet()


class PrefixCounter:
    """Prefix counts by the vocabulary and merges of a byte-level BPE file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        model = told["model"]
        self.merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.ranks = {pair: rank for rank, pair in enumerate(self.merges)}
        #: The merge that makes a token; single bytes have none.
        self.made = {left + right: rank for (left, right), rank in reversed(self.ranks.items())}
        #: Nodes by next character; the token that ends at a node is under the empty string.
        self.trie: dict = {}
        for token in model["vocab"]:
            node = self.trie
            for sign in token:
                node = node.setdefault(sign, {})
            node[""] = token
        self.pieces = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self.marks: dict[str, bytes] = {"": b""}
        special = sorted((t["content"] for t in told.get("added_tokens", [])), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.pairs: dict[tuple[str, str], bool] = {}
        self.units = Kept(self.unit_table, KEPT_UNITS)
        self.words = Kept(self.word_table, KEPT_UNITS)

    def follows(self, left: str, right: str) -> bool:
        """Whether ``right`` may stand after ``left``.

        The merges that made the two are undone, the latest first. The parts at the seam would have
        been merged with each other if that merge ranks before the one undone last. Equal merges take
        place from left to right.
        """
        seam, bound = (left, right), len(self.ranks)
        while True:
            if self.ranks.get((left, right), bound) < bound:
                known = False
                break
            made_left, made_right = self.made.get(left, -1), self.made.get(right, -1)
            if made_left < 0 and made_right < 0:
                known = True
                break
            if made_left > made_right:
                bound, left = made_left, self.merges[made_left][1]
            else:
                bound, right = made_right + 1, self.merges[made_right][0]
        if len(self.pairs) >= KEPT_PAIRS:
            self.pairs.clear()
        self.pairs[seam] = known
        return known

    def piece_counts(self, piece: str) -> list[int]:
        """Tokens of every prefix, the empty one first, of a piece written in the byte alphabet."""
        trie, pairs = self.trie, self.pairs.get
        last, counts, walks = [""], [0], []
        for end, sign in enumerate(piece):
            walks.append((end, trie))
            going, found = [], ""
            for start, node in walks:  # where tokens began that may go on up to here
                node = node.get(sign)
                if node is None:
                    continue
                going.append((start, node))
                if found or "" not in node:
                    continue
                token = node[""]
                if start:
                    before = last[start]
                    fits = pairs((before, token))
                    if fits is None:
                        fits = self.follows(before, token)
                    if not fits:
                        continue
                found = token
                count = counts[start] + 1
            if not found:
                raise ValueError(f"no token ends at byte {end} of {piece[:80]!r}")
            walks = going
            last.append(found)
            counts.append(count)
        return counts

    def character_counts(self, text: str) -> list[int]:
        """Tokens of the prefixes of 1, 2, ... characters of one piece."""
        counts = self.piece_counts(text.encode().decode("latin-1").translate(_ALPHABET))
        if text.isascii():
            return counts[1:]
        ends, end = [], 0
        for character in text:
            end += len(character.encode())
            ends.append(counts[end])
        return ends

    def word_table(self, word: str) -> bytes:
        """The table of a space and a word, with no other white space before them."""
        letters = word.rstrip(_MARKS)
        if not letters.isalpha():
            return b"".join(map(self.units.__getitem__, _UNIT.findall(f" {word}")))
        marks = word[len(letters) :]
        if marks not in self.marks:
            table = _table(self.character_counts(marks))
            if len(self.marks) >= KEPT_PAIRS:
                return _table(self.character_counts(f" {letters}")) + table
            self.marks[marks] = table
        return _table(self.character_counts(f" {letters}")) + self.marks[marks]

    def unit_table(self, unit: str) -> bytes:
        """What each character of a unit adds."""
        run, counts, before = _RUN.match(unit).end(), [], 0
        for _, (start, end) in self.pieces(unit):
            inside = self.character_counts(unit[start:end])
            if unit[start] == "'" and end - start == 3 and unit[start + 1 : end].isalpha():
                inside[1] = 2  # two letters after the sign are one piece, the first of them alone is another piece
            counts += [before + n for n in inside]
            before = counts[-1]
        if run > 1:  # up to its end a run of white space is one piece
            counts[:run] = self.character_counts(unit[:run])
        return _table(counts)

    def table(self, text: str) -> bytes:
        """What each character of a text adds; a special token's string is one token."""
        parts, at = [], 0
        for found in self.special.finditer(text) if self.special else ():
            plain = self.plain_table(text[at : found.end() - 1])
            inside = np.frombuffer(plain, np.int8)
            last = 1 - int(inside[found.start() - at :].sum(dtype=np.int64))
            trailing = self.plain_table(text[at : found.start()])
            last += int(np.frombuffer(trailing, np.int8).sum(dtype=np.int64)) - int(inside[: found.start() - at].sum(dtype=np.int64))
            parts += [plain, array("b", [last]).tobytes()]
            at = found.end()
        return b"".join([*parts, self.plain_table(text[at:])])

    def plain_table(self, text: str) -> bytes:
        if _RUN_TO_SPACE.search(text):
            return b"".join(map(self.units.__getitem__, _UNIT.findall(text)))
        first, *words = text.split(" ")
        return b"".join([*map(self.units.__getitem__, _UNIT.findall(first)), *map(self.words.__getitem__, words)])


def _table(counts: list[int]) -> bytes:
    return array("b", map(int.__sub__, counts, [0, *counts])).tobytes()


@lru_cache(maxsize=2)
def prefix_counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def longest_fit(table: bytes, budget: int) -> int:
    """Characters of the longest prefix with at most ``budget`` tokens."""
    fits = np.flatnonzero(np.cumsum(np.frombuffer(table, np.int8), dtype=np.int64) <= budget)
    return int(fits[-1]) + 1 if len(fits) else 0


def token_counts(docs: DataFrame, path: str, budget: int, id_column: str = "doc_id", text_column: str = "text", with_table: bool = True) -> DataFrame:
    """Per row: the id, ``n_bytes``, ``n_tokens``, ``fit_chars`` and, if asked for, ``prefix_table``.

    ``fit_chars`` is the length in characters of the longest prefix with at most ``budget`` tokens.
    ``path`` is a byte-level BPE file of the tokenizers library that every executor can read.
    """
    if budget < 0:
        raise ValueError("budget must not be negative")
    source = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        counter = prefix_counter(path)
        sizes, totals, fits, tables = [], [], [], []
        for value in batch.column(1):
            text = value.as_py() or ""
            table = counter.table(text)
            sizes.append(len(text.encode()))
            totals.append(int(np.frombuffer(table, np.int8).sum(dtype=np.int64)))
            fits.append(longest_fit(table, budget))
            if with_table:
                tables.append(table)
        columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(totals, pa.int64()), pa.array(fits, pa.int64())]
        names = ["id", "n_bytes", "n_tokens", "fit_chars"]
        if with_table:
            columns.append(pa.array(tables, pa.binary()))
            names.append("prefix_table")
        return pa.RecordBatch.from_arrays(columns, names)

    kind = source.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n_bytes long, n_tokens long, fit_chars long" + ", prefix_table binary" * with_table
    return map_batches(source, count, schema).withColumnRenamed("id", id_column)


def tokens_in_prefix(table: Column, characters: Column) -> Column:
    """Tokens of the prefix of so many characters, from a stored table."""

    @pandas_udf("long")
    def answer(tables, lengths):  # noqa: ANN001, ANN202
        return tables.combine(lengths, lambda t, n: int(np.frombuffer(t, np.int8)[: max(int(n), 0)].sum(dtype=np.int64)))

    return answer(table, characters)


def prefix_for_budget(table: Column, budget: int) -> Column:
    """Characters of the longest prefix with at most ``budget`` tokens, from a stored table."""

    @pandas_udf("long")
    def answer(tables):  # noqa: ANN001, ANN202
        return tables.map(lambda t: longest_fit(t, budget))

    return answer(table)
