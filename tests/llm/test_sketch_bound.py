"""The number of parity sketches keeps the chance to miss a pair below its promise, whatever the size."""

from math import ceil, log

import numpy as np
import pytest

from gridmetrics.llm.jaccard_join import BAND, MISSED, Bands


def chance(bands, band):
    """Exact chance that one sketch has no word with members that all differences leave alone."""
    words = bands.words(band)
    chances, touched = np.zeros(words + 1), np.arange(words + 1)
    chances[0] = 1
    for _ in range(words - 1):
        chances = chances * touched / words + np.concatenate([[0], (chances * (words - touched) / words)[:-1]])
    empty = (1 - 1 / words) ** (BAND**band * bands.percent / 100)
    return float((chances * empty ** (words - touched)).sum())


@pytest.mark.parametrize("percent", [20, 30, 50, 80, 90])
def test_every_band_keeps_the_promise(percent):
    bands = Bands(percent)
    wide = [band for band in range(60) if 200 < bands.words(band) < 2500]
    assert wide
    for band in range(wide[-1] + 1):
        if bands.words(band) > 1:
            assert chance(bands, band) ** bands.sketches(band) <= MISSED * 1.0001, band
    assert bands.sketches(bands.of(10**9)) == 1


@pytest.mark.parametrize("percent", [80, 90])
def test_no_more_sketches_than_needed(percent):
    bands = Bands(percent)
    for band in range(1, 40):
        if 200 < bands.words(band) < 1500:
            missed = max(chance(bands, band), 1e-300)
            assert bands.sketches(band) == max(1, ceil(log(MISSED) / log(missed))), band
