"""Language identification by averaged hashed subword embeddings and a linear softmax.

A word, marked at both ends, gives its n-grams of UTF-8 bytes; each hashes to a row of an embedding matrix.
A text is the average over the n-grams of all its words, and a linear layer with softmax gives the
probabilities. Embeddings and layer are trained together in numpy by stochastic gradient descent, on
whole texts of a bounded sample of labelled rows. A held-back part of the sample fits a temperature, so
that probabilities are calibrated, and the probability below which a prediction is rejected.

As the layer is linear, a word's n-grams add up to one short vector of class scores. Texts are cut by Arrow,
batch by batch; the distinct pieces that a worker does not know yet are scored together in numpy, and the
vectors of a text's pieces are added up. Prediction runs over whole texts, without a shuffle; a worker
keeps pieces up to a number of bytes, whatever the number of languages.

A text that is null or has no letter is ``und`` with score 0 and not accepted. Without labelled rows all
texts are. Rows come out one for one, repeated ones too, whatever other columns there are; a null id stays. Ties
go to the first language in order. Rows that share an id count once in the sample.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmetrics.llm.batches import bound_batches
from gridmetrics.llm.kept import LONGEST_KEPT, Kept
from gridmetrics.llm.sampling import lowest_places

#: Labelled rows that the model is fitted on, the first by a hash of their id.
TRAINING_ROWS = 1024
#: Rows of the embedding matrix, its width, and the lengths of n-grams in bytes.
BUCKETS = 1 << 14
WIDTH = 12
GRAMS = (2, 3, 4)
#: Of the sample, one row in so many calibrates; share of these that may be wrong and still accepted.
HELD_BACK = 5
WRONG = 0.01

#: Steps at least, texts of one step, and the rates of the layer and of the embeddings at the start.
STEPS, BATCH, LAYER_RATE, EMBEDDING_RATE = 600, 16, 1.0, 50.0
UNKNOWN = "und"
#: Bytes of the vectors that a worker keeps, and words of the training texts.
KEPT_BYTES, KEPT_WORDS = 16 << 20, 200_000
#: Bytes of words whose n-grams are looked up at once.
SCORED_TOGETHER = 1 << 20


def word_grams(word: str) -> list[int]:
    """Rows of the matrix for the n-grams of a word; a word without a letter has none."""
    if not any(map(str.isalpha, word)):
        return []
    data = f"<{word.lower()}>".encode()
    return [zlib.crc32(data[at : at + n], n) % BUCKETS for n in GRAMS for at in range(len(data) - n + 1)]


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    embeddings: np.ndarray
    layer: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float

    def piece_scores(self, pieces: list[str]) -> np.ndarray:
        """Class scores that each piece of text adds, and last the number of its n-grams."""
        scores = np.c_[self.embeddings @ self.layer, np.ones(BUCKETS)]
        out = np.zeros((len(pieces), scores.shape[1]))
        words = [(n, word) for n, piece in enumerate(pieces) for word in piece.split() if any(map(str.isalpha, word))]
        at = 0
        while at < len(words):
            owners, parts, size = [], [], 0
            while at < len(words) and (size < SCORED_TOGETHER or not parts):
                owners.append(words[at][0])
                parts.append(f"<{words[at][1].lower()}>".encode())
                size += len(parts[-1])
                at += 1
            for rows, word_of in gram_rows(parts):
                found = scores[rows]
                owner = np.array(owners)[word_of]
                for column in range(out.shape[1]):
                    out[:, column] += np.bincount(owner, found[:, column], len(pieces))
        return out


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_CRC = _crc_table()


def gram_rows(words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length of n-grams, matrix rows of all n-grams of marked words, and the word of each; as ``word_grams``."""
    data = np.frombuffer(b"".join(words), np.uint8)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    word_of = np.repeat(np.arange(len(words)), lengths)
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(data))
    for n in GRAMS:
        places = np.flatnonzero(left >= n)
        crc = np.full(len(places), n ^ 0xFFFFFFFF, np.uint32)
        for step in range(n):
            crc = _CRC[(crc ^ data[places + step]) & 255] ^ (crc >> 8)
        yield (crc ^ np.uint32(0xFFFFFFFF)) % np.uint32(BUCKETS), word_of[places]


def _softmax(scores: np.ndarray) -> np.ndarray:
    powers = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return powers / powers.sum(axis=-1, keepdims=True)


def _bag(text: str, gramsof: Callable[[str], list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Matrix rows of a text and their shares."""
    grams = [row for word in text.split() for row in gramsof(word)]
    counts = np.bincount(grams, minlength=BUCKETS) if grams else np.zeros(BUCKETS)
    rows = np.flatnonzero(counts)
    return rows, counts[rows] / max(len(grams), 1)


def fit_language_model(texts: list[str], labels: list[str], seed: int = 0) -> LanguageModel | None:
    """A model of labelled texts; None if no text has a letter."""
    gramsof = Kept(word_grams, KEPT_WORDS).__getitem__
    bags = [(*_bag(text, gramsof), label) for text, label in zip(texts, labels, strict=True)]
    bags = [bag for bag in bags if len(bag[0])]
    if not bags:
        return None
    random = np.random.default_rng(seed)
    languages = sorted({label for *_, label in bags})
    truth = np.array([languages.index(label) for *_, label in bags])
    held = np.arange(len(bags)) % HELD_BACK == 0 if len(bags) >= 10 * HELD_BACK else np.zeros(len(bags), bool)
    embeddings = random.normal(0, 0.1, (BUCKETS, WIDTH))
    layer, bias = random.normal(0, 0.1, (WIDTH, len(languages))), np.zeros(len(languages))
    round_of = range(0, int((~held).sum()), BATCH)
    steps = [at for _ in range(-(-STEPS // len(round_of))) for at in round_of]
    order = np.empty(0, int)
    for number, at in enumerate(steps):
        if at == 0:
            order = random.permutation(np.flatnonzero(~held))
        left = 1 - number / len(steps)
        chosen = order[at : at + BATCH]
        rows = np.concatenate([bags[i][0] for i in chosen])
        shares = np.concatenate([bags[i][1] for i in chosen])[:, None]
        sizes = np.array([len(bags[i][0]) for i in chosen])
        means = np.add.reduceat(embeddings[rows] * shares, np.concatenate([[0], np.cumsum(sizes)[:-1]]))
        errors = _softmax(means @ layer + bias)
        errors[np.arange(len(chosen)), truth[chosen]] -= 1
        back = np.repeat(errors @ layer.T, sizes, axis=0) * shares
        layer -= left * LAYER_RATE * means.T @ errors / len(chosen)
        bias -= left * LAYER_RATE * errors.mean(axis=0)
        for column in range(WIDTH):
            embeddings[:, column] -= left * EMBEDDING_RATE * np.bincount(rows, back[:, column], BUCKETS) / len(chosen)
    temperature, threshold = 1.0, 0.0
    if held.any():
        scores = np.array([shares @ embeddings[rows] @ layer + bias for rows, shares, _ in (bags[i] for i in np.flatnonzero(held))])
        answers = truth[held]
        grid = np.geomspace(1, 20, 41)  # never surer than the model itself
        losses = [-np.log(_softmax(scores / t)[np.arange(len(answers)), answers] + 1e-12).mean() for t in grid]
        temperature = float(grid[int(np.argmin(losses))])
        sure = _softmax(scores / temperature)
        right, best = sure.argmax(axis=1) == answers, sure.max(axis=1)
        fits = [t for t in (0.5, *np.unique(best[best > 0.5])) if not (best >= t).any() or (~right[best >= t]).mean() <= WRONG]
        threshold = float(min(fits, default=best.max()))
    return LanguageModel(languages, embeddings, layer, bias, temperature, threshold)


def sample_and_fit(docs: DataFrame, usable: Column, id_column: str = "doc_id", text_column: str = "text", label_column: str = "lang", rows: int = TRAINING_ROWS) -> LanguageModel | None:
    """A model of at most ``rows`` labelled rows among those that are ``usable``."""
    labelled = docs.where(usable & F.col(label_column).isNotNull() & F.col(text_column).isNotNull())
    labelled = labelled.select(F.xxhash64(id_column).alias("place"), F.col(label_column).cast("string").alias("label"), F.col(text_column).alias("text"))
    sample = lowest_places(labelled, rows)
    return fit_language_model([row["text"] for row in sample], [row["label"] for row in sample])


class _Pieces:
    """Score vectors of the pieces that a worker has met under a model."""

    def __init__(self, width: int) -> None:
        self.numbers: dict[str, int] = {}
        self.most = max(1000, KEPT_BYTES // (8 * (width + 1)))
        self.vectors = np.empty((0, width + 1))

    def of(self, pieces: list[str], score: Callable[[list[str]], np.ndarray]) -> np.ndarray:
        """A vector for each of some distinct pieces."""
        known = np.fromiter((self.numbers.get(piece, -1) for piece in pieces), np.int64, len(pieces))
        new = np.flatnonzero(known < 0)
        out = np.empty((len(pieces), self.vectors.shape[1]))
        out[known >= 0] = self.vectors[known[known >= 0]]
        if len(new):
            fresh = [pieces[n] for n in new]
            out[new] = score(fresh)
            if len(self.numbers) + len(fresh) > self.most:  # those of this batch stay
                self.numbers, self.vectors = {}, np.empty((0, out.shape[1]))
                new, fresh = np.arange(min(len(pieces), self.most // 2)), pieces[: self.most // 2]
            short = [n for n, piece in zip(new.tolist(), fresh) if len(piece) <= LONGEST_KEPT]
            self.numbers.update((pieces[n], len(self.vectors) + k) for k, n in enumerate(short))
            self.vectors = np.concatenate([self.vectors, out[short]])
        return out


@lru_cache(maxsize=1)
def _pieces(model_name: str, width: int) -> _Pieces:
    return _Pieces(width)


def text_sums(texts: pa.Array, kept: _Pieces, score: Callable[[list[str]], np.ndarray]) -> np.ndarray:
    """Scores and n-grams of all words of each text."""
    plain = pc.replace_substring(pc.fill_null(texts.cast(pa.large_string()), ""), "\n", " ")
    cut = pc.split_pattern(plain, " ")
    counts = pc.list_value_length(cut).to_numpy(zero_copy_only=False)
    coded = cut.flatten().dictionary_encode()
    vectors = kept.of(coded.dictionary.to_pylist(), score)
    codes = coded.indices.to_numpy(zero_copy_only=False)
    starts = np.cumsum(counts) - counts  # each text has a piece, if an empty one
    return np.stack([np.add.reduceat(column[codes], starts) for column in vectors.T], axis=1)


def languages(docs: DataFrame, model: LanguageModel | None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: the id, ``lang_pred``, ``score`` (its calibrated probability) and ``accepted``."""
    source = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))

    name = uuid.uuid4().hex

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = _pieces(name, len(model.languages)) if model else None
        for batch in batches:
            names, scores, accepted = np.full(batch.num_rows, UNKNOWN, object), np.zeros(batch.num_rows), np.zeros(batch.num_rows, bool)
            if model and batch.num_rows:
                sums = text_sums(batch.column(1), kept, model.piece_scores)
                some = np.flatnonzero(sums[:, -1])
                sure = _softmax((sums[some, :-1] / sums[some, -1:] + model.bias) / model.temperature)
                best = sure.argmax(axis=1)
                names[some] = np.array(model.languages, object)[best]
                scores[some] = sure[np.arange(len(some)), best]
                accepted[some] = scores[some] >= model.threshold
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(accepted, pa.bool_())],
                ["id", "lang_pred", "score", "accepted"],
            )

    bound_batches(source)
    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(predict, f"id {kind}, lang_pred string, score double, accepted boolean").withColumnRenamed("id", id_column)
