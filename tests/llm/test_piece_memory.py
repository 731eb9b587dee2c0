"""What a worker keeps of the arcs of units does not grow with the texts, and changes no segmentation."""

import random

import public_tokenizers

from gridmetrics.llm import piece_sampling


def test_arcs_are_bounded_and_change_nothing(monkeypatch):
    path, draw = public_tokenizers.path("piece_bpe_32k.model"), random.Random(1)
    words = ["".join(draw.choices("abcdefghilmnoprstuvé😀", k=draw.randrange(1, 14))) for _ in range(30_000)]
    texts = [" ".join(words[at : at + 100]) for at in range(0, len(words), 100)] * 2

    def run(together):
        lattice, found, most = piece_sampling.PieceLattice(path, 1.0), [], 0
        for at in range(0, len(texts), together):
            some = texts[at : at + together]
            found += piece_sampling.sampled(some, list(range(at, at + len(some))), lattice, 2)
            most = max(most, lattice.arcs)
        return [[(ids.tolist(), *values) for ids, *values in row] for row in found], most, lattice

    plain, all_arcs, _ = run(600)
    monkeypatch.setattr(piece_sampling, "KEPT_ARCS", all_arcs // 8)
    monkeypatch.setattr(piece_sampling, "SIGNS_TOGETHER", 500)
    bounded, most, lattice = run(20)
    assert [[x[0] for x in row] for row in bounded] == [[x[0] for x in row] for row in plain]
    assert all(abs(a - b) < 1e-6 for one, two in zip(bounded, plain) for x, y in zip(one, two) for a, b in zip(x[1:], y[1:]) if a > -1e9)
    assert most < all_arcs // 4
    # room for a quarter more than was ever needed, in 32-bit numbers where these will do
    held = sum(getattr(lattice, name).nbytes for name in lattice._KINDS)
    assert held <= 1.3 * 44 * most
