"""Language identification against a plain forward pass, and its sample."""

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridmetrics.llm import language
from gridmetrics.llm.language import BUCKETS, LanguageModel, gram_rows, languages, sample_and_fit, word_grams
from gridmetrics.llm.sampling import lowest_places

RNG = np.random.default_rng(5)
MODEL = LanguageModel(["de", "en", "fr"], RNG.normal(0, 1, (BUCKETS, 4)), RNG.normal(0, 1, (4, 3)), RNG.normal(0, 1, 3), 1.7, 0.6)
TEXTS = ["Maße und Wörter", "the  the\tthe\nthe", "été 1 22 !", "x", "日本語　です", "İstanbul ΣΑΣ", "a" * 5000, "12 34", "", None, "the  the\tthe\nthe"]


def plain(text):
    """Prediction, probability and acceptance, gram by gram."""
    grams = [row for word in (text or "").split() for row in word_grams(word)]
    if not grams:
        return "und", 0.0, False
    mean = sum(MODEL.embeddings[row] for row in grams) / len(grams)
    scores = (mean @ MODEL.layer + MODEL.bias) / MODEL.temperature
    powers = np.exp(scores - scores.max())
    best = int(powers.argmax())
    share = float(powers[best] / powers.sum())
    return MODEL.languages[best], share, share >= MODEL.threshold


@given(st.lists(st.text(min_size=1, max_size=12).filter(lambda w: any(map(str.isalpha, w)) and not w.split() == []), min_size=1, max_size=8))
def test_rows_of_all_grams(words):
    marked = [f"<{word.lower()}>".encode() for word in words]
    found = [[] for _ in words]
    for rows, word_of in gram_rows(marked):
        for row, n in zip(rows.tolist(), word_of.tolist()):
            found[n].append(row)
    assert found == [word_grams(word) for word in words]


def test_prediction_equals_a_plain_forward_pass(spark):
    rows = [(n if n else None, text, "x", 0.5) for n, text in enumerate([*TEXTS, *(" ".join(TEXTS[n % 6] for n in range(k, k + 40)) for k in range(6))])]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double").repartition(3)
    found = {row.doc_id: row for row in languages(frame, MODEL).collect()}
    assert len(found) == len(rows)
    for n, text, *_ in rows:
        name, share, accepted = plain(text)
        assert (found[n].lang_pred, found[n].accepted) == (name, accepted)
        assert abs(found[n].score - share) < 1e-9


@settings(max_examples=30, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["the", "été", "x1", "　", "\t", "Über", "1", ""]), max_size=9).map(" ".join), min_size=1, max_size=9))
def test_few_pieces_kept(texts):
    kept = language._Pieces(3)
    kept.most = 4
    for _ in range(2):
        sums = language.text_sums(pa.array(texts), kept, MODEL.piece_scores)
        for text, total in zip(texts, sums):
            grams = [row for word in text.split() for row in word_grams(word)]
            want = [*(MODEL.embeddings[grams] @ MODEL.layer).sum(axis=0), len(grams)]
            assert np.allclose(total, want)
        assert len(kept.numbers) <= 4


def test_sample_is_of_the_lowest_places(spark):
    rows = spark.range(5000).select(F.xxhash64("id").alias("place"), F.concat(F.lit("t"), F.col("id")).alias("text"), F.lit(None).cast("string").alias("label"))
    want = [row.place for row in rows.orderBy("place").limit(64).collect()]
    assert [row.place for row in lowest_places(rows, 64)] == want
    assert len(lowest_places(rows.limit(10), 64)) == 10 and lowest_places(rows.limit(0), 64) == []
    # Nearly all rows share one place.
    hot = rows.withColumn("place", F.when(F.col("place") % 50 == 0, F.col("place")).otherwise(F.lit(2**62)))
    want = sorted({row.place for row in hot.collect()})[:64]
    assert [row.place for row in lowest_places(hot, 64)] == want


def test_rows_of_one_id_count_once_in_the_sample(spark):
    rows = [(n, f"word{n} " * 30, "en") for n in range(30)] + [(7, "word7 " * 30, "en")] * 500 + [(None, "été " * 9, "fr"), (50, None, "fr"), (51, "x", None)]
    model = sample_and_fit(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4), F.lit(True), rows=40)
    assert model.languages == ["en", "fr"]
