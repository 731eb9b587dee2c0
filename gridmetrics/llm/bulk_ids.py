"""Token ids of whole batches of texts, with the tokenizer called for new words only.

:class:`BulkIds` is for a byte-level BPE that keeps white space: texts are cut before a space that follows other characters than white space, where a byte-level BPE
begins a new token however the text goes on. Arrow cuts and numbers the words of a batch; those that
the worker has not met yet go to the tokenizer together, and the ids of the batch are gathered by
offsets. Texts where a space follows white space are cut by a pattern instead. Every text is encoded
whole, with the tokenizer's own defaults, special strings among them (the file must have none with
white space inside).

:class:`BulkWordIds` is for a tokenizer that drops white space, lower-cases, splits letters from marks and lets no
token cross a space. There texts are simply cut at spaces and line ends.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable
from functools import lru_cache
from itertools import chain
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

#: Unicode's White_Space.
_WHITE = "\\t\\n\\x0b\\x0c\\r \u0085   -     　"
_UNIT = re.compile(f"[{_WHITE}]*[^{_WHITE}]+|[{_WHITE}]+")
_RUN_TO_SPACE = f"[{_WHITE}] "

#: Words a worker remembers between batches, and the longest of them (characters).
KEPT_WORDS = 700_000
LONGEST_KEPT = 64
#: Words encoded by one call, so that the tokenizer's own records stay few, and those written as lines of one text.
ENCODED_TOGETHER = 20_000
LINES_TOGETHER = 1000

_LINE = "\n"
_SIGNS = ".,;:!?"
_MARKS = _SIGNS + _LINE
#: Letters and marks, and then perhaps a line's end, letters and marks.
_SHAPE = re.compile(r"( ?[^\W\d_]+)([.,;:!?]*)(?:(\n)([^\W\d_]*)([.,;:!?]*))?")


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of the ranges that begin at ``starts`` and have these lengths, one after another."""
    ends = np.cumsum(lengths, dtype=np.int64)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if max(total, int(starts.max(initial=0))) < 2**31 else np.int64
    indices = np.repeat((starts - (ends - lengths)).astype(kind), lengths)
    indices += np.arange(total, dtype=kind)
    return indices


def _parts(word: str) -> list[str] | None:
    """Parts that no token crosses, if the word is made of letters, marks and at most one line's end."""
    shape = _SHAPE.fullmatch(word)
    if shape is None:
        return None
    parts = [part for part in shape.groups() if part]
    # Numbers other than digits pass for letters in the pattern.
    return parts if all(part[-1] in _MARKS or part.lstrip(" ").isalpha() for part in parts) else None


class BulkIds:
    """Ids of texts by a byte-level BPE file."""

    #: What stands between words of letters that are encoded as one text.
    between = _LINE

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # the other cores have tasks of their own
        self.tokenizer = Tokenizer.from_file(path)
        (self.between_id,) = self.tokenizer.encode(self.between, add_special_tokens=False).ids
        self.places: dict[str, int] = {}
        self.flat = np.empty(0, np.uint32)
        self.starts = np.empty(0, np.int64)
        self.lengths = np.empty(0, np.int32)

    def _store(self, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Places of words whose ids, one after another, have these lengths."""
        places = np.arange(len(self.starts), len(self.starts) + len(lengths))
        starts = len(self.flat) + np.cumsum(lengths) - lengths
        self.flat = np.concatenate([self.flat, ids.astype(np.uint32)])
        self.starts = np.concatenate([self.starts, starts])
        self.lengths = np.concatenate([self.lengths, lengths.astype(np.int32)])
        return places

    def _store_plain(self, words: list[str]) -> np.ndarray:
        """Places of words of letters alone, encoded as the lines of a text."""
        lines = [self.between.join(words[at : at + LINES_TOGETHER]) for at in range(0, len(words), LINES_TOGETHER)]
        found = self.tokenizer.encode_batch_fast([line + self.between for line in lines], add_special_tokens=False)
        ids = np.array(list(chain.from_iterable(one.ids for one in found)), np.int64)
        ends = np.flatnonzero(ids == self.between_id)
        lengths = np.diff(ends, prepend=-1) - 1
        return self._store(ids[ids != self.between_id], lengths)

    def _plain(self, word: str) -> bool:
        """Whether a word is made of letters alone."""
        return word[word[:1] == " " :].isalpha()

    def _parts(self, word: str) -> list[str] | None:
        return _parts(word)

    def _store_any(self, words: list[str]) -> np.ndarray:
        found = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        ids = [one.ids for one in found]
        return self._store(np.array(list(chain.from_iterable(ids)), np.int64), np.array(list(map(len, ids)), np.int64))

    def _learn(self, words: list[str], store: Callable[[list[str]], np.ndarray]) -> None:
        """Remember new words, encoded in calls of bounded size."""
        for at in range(0, len(words), ENCODED_TOGETHER):
            part = words[at : at + ENCODED_TOGETHER]
            self.places.update(zip(part, store(part).tolist()))

    def _places(self, words: list[str]) -> np.ndarray:
        """Places of distinct words; new ones are encoded, or put together from their parts."""
        get, known = self.places.get, self.places
        new = [word for word in words if word not in known]
        if new:
            plain = {word for word in new if self._plain(word)}
            whole = {word: parts for word in new if word not in plain and (parts := self._parts(word))}
            pieces = {part for parts in whole.values() for part in parts if part not in known}
            marks = [piece for piece in pieces if piece[-1] in _MARKS]
            plain.update(piece for piece in pieces if piece[-1] not in _MARKS)
            self._learn(list(plain), self._store_plain)
            self._learn([*marks, *(word for word in new if word not in plain and word not in whole)], self._store_any)
            whole = {word: parts for word, parts in whole.items() if parts != [word]}
            counts = np.array([len(parts) for parts in whole.values()], np.int64)
            if len(counts):
                at = np.array([get(part) for parts in whole.values() for part in parts], np.int64)
                ids = self.flat[ragged(self.starts[at], self.lengths[at])]
                lengths = np.add.reduceat(self.lengths[at], np.cumsum(counts) - counts)
                self.places.update(zip(whole, self._store(ids, lengths).tolist()))
        return np.fromiter(map(get, words), np.int64, len(words))

    def _trim(self, words: list[str], places: np.ndarray) -> None:
        """Keep the words of the last batch alone once there are too many."""
        if len(self.places) <= KEPT_WORDS:
            return
        short = np.array([len(word) <= LONGEST_KEPT for word in words], bool)[: KEPT_WORDS // 2]
        words = [word for word, fits in zip(words, short) if fits]
        places = places[: len(short)][short]
        flat, lengths = self.flat[ragged(self.starts[places], self.lengths[places])], self.lengths[places]
        self.flat, self.lengths, self.starts = flat, lengths, np.cumsum(lengths) - lengths
        self.places = {word: n for n, word in enumerate(words)}

    def _cut(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Distinct words, the number of each word in order, and how many words each text has."""
        odd = pc.match_substring_regex(texts, _RUN_TO_SPACE).to_numpy(zero_copy_only=False).astype(bool)
        plain = pc.if_else(pa.array(odd), "", texts) if odd.any() else texts
        cut = pc.split_pattern(plain, " ")
        counts = pc.list_value_length(cut).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = cut.flatten().dictionary_encode()
        codes, pieces = coded.indices.to_numpy(zero_copy_only=False).copy(), coded.dictionary.to_pylist()
        first = np.zeros(len(codes), bool)
        first[np.cumsum(counts) - counts] = True  # each text has a piece, if an empty one
        # The first piece of a text has no space before it.
        opening, openings = np.unique(codes[first], return_inverse=True)
        words = [" " + piece for piece in pieces] + [pieces[n] for n in opening]
        codes[first] = len(pieces) + openings
        if odd.any():
            units = [_UNIT.findall(text) for text in texts.filter(pa.array(odd)).to_pylist()]
            numbers: dict[str, int] = {}
            found = np.fromiter((numbers.setdefault(unit, len(numbers)) for one in units for unit in one), np.int64)
            lengths = counts.copy()
            lengths[odd] = [len(one) for one in units]
            merged = np.empty(int(lengths.sum()), np.int32)
            is_odd = np.repeat(odd, lengths)
            merged[is_odd] = len(words) + found
            merged[~is_odd] = codes[np.repeat(~odd, counts)]
            words, codes, counts = words + list(numbers), merged, lengths
        used = np.flatnonzero(np.bincount(codes, minlength=len(words)))
        renumbered = np.zeros(len(words), np.int32)
        renumbered[used] = np.arange(len(used))
        return [words[n] for n in used], renumbered[codes], counts

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and the number of ids of each; null counts as empty."""
        if not len(texts):
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        words, codes, counts = self._cut(pc.fill_null(texts.cast(pa.large_string()), ""))
        known = self._places(words)
        places = known[codes]
        lengths = self.lengths[places]
        ids = self.flat[ragged(self.starts[places], lengths)]
        ends = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
        bounds = np.concatenate([[0], np.cumsum(counts)])
        self._trim(words, known)
        return ids, np.diff(ends[bounds])


class BulkWordIds(BulkIds):
    """Ids of texts by a file whose tokens never hold white space."""

    between = " , "

    def _plain(self, word: str) -> bool:
        """Letters alone in one case, which no normal form joins or changes."""
        return word.isascii() and word.isalpha() and word.islower()

    def _parts(self, word: str) -> list[str] | None:
        """The letters and the marks after them, which the tokenizer splits off; the case of A-Z does not count for it."""
        stem = word.rstrip(_SIGNS)
        marks = word[len(stem) :]
        if not stem.isalpha():
            return None
        if stem.isascii():
            return [stem.lower(), marks] if marks else [stem.lower()]
        if stem.lower().isalpha() and is_normalized("NFC", stem):  # else a sign may join the marks
            return [stem, marks] if marks else [stem]
        return None

    def _cut(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        cut = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        counts = pc.list_value_length(cut).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = cut.flatten().dictionary_encode()
        return coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False), counts


@lru_cache(maxsize=2)
def bulk_ids(path: str) -> BulkIds:
    return BulkIds(path)


@lru_cache(maxsize=2)
def bulk_word_ids(path: str) -> BulkWordIds:
    return BulkWordIds(path)
