"""The Merkle manifest against a plain tree."""

import random
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from gridmetrics.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, root string, at int, tree string"


def plain(rows, tampered):
    """Rows (id, source, lang, n_chars, text): id, leaf, subroot, root, hash of siblings, folded root, verified."""

    def h(parts):
        return sha256("".join(parts).encode()).hexdigest()

    def leaf(values):
        return h("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)

    def climb(nodes):
        """The top, and for each node its runs with its own place in them."""
        ways, where = [[] for _ in nodes], list(range(len(nodes)))
        while len(nodes) > 1:
            runs = [nodes[n : n + 8] for n in range(0, len(nodes), 8)]
            for way, at in zip(ways, where):
                way.append((runs[at // 8], at % 8))
            where, nodes = [at // 8 for at in where], [h(run) for run in runs]
        return nodes[0], ways

    trees = {}
    for row, text in zip(rows, tampered):
        trees.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, leaf(row), leaf([*row[:4], text])))
    names = sorted(trees, key=lambda name: (name is not None, (name or "").encode()))
    climbs = {name: climb([x[2] for x in sorted(trees[name])]) for name in names}
    root, over = climb([climbs[name][0] for name in names])
    for n, name in enumerate(names):
        top, ways = climbs[name]
        for (known, doc, own, found), way in zip(sorted(trees[name]), ways):
            siblings, node = [], found
            for run, at in [*way, *over[n]]:
                siblings += run[:at] + run[at + 1 :]
                node = h([*run[:at], node, *run[at + 1 :]])
            yield doc if known else None, own, top, root, h(siblings), node, node == root


def made(n, langs, seed):
    rng = random.Random(seed)
    rows = [
        (k, rng.choice(["a", "Ü", None]), rng.choice(langs), rng.choice([k, None]), rng.choice(["Text É", "", None, "lower", "LONG " * 500]))
        for k in range(n)
    ]
    return [*rows, *rows[:3], *((None, None, langs[0], None, None),) * 2]


@pytest.mark.parametrize(
    ("n", "langs", "levels"),
    [(700, ["en", "de", None, "é", "z"], 1), (700, ["en"], 2), (40, [f"l{k}" for k in range(30)], 1), (600, ["en", "de", "en"], 4)],
)
def test_manifest_against_plain_tree(spark, n, langs, levels):
    rows = made(n, langs, n + levels)
    docs = spark.createDataFrame([(*row, "r", 1, "t") for row in rows], SCHEMA).repartition(7)
    lower = F.when(F.col("doc_id") % 3 == 0, F.lower("text")).otherwise(F.col("text"))
    tampered = [text.lower() if doc is not None and doc % 3 == 0 and text else text for doc, *_, text in rows]
    got = [tuple(row) for row in merkle.merkle_manifest(docs, lower, levels=levels).collect()]
    order = lambda row: tuple(str(x) for x in row)
    want = sorted(plain(rows, tampered), key=order)
    assert sorted(got, key=order) == want
    assert {row[6] for row in want} == {True, False}


def test_untouched_small_and_empty(spark):
    docs = spark.createDataFrame([(5, "s", "en", 3, "abc", "r", 1, "t")], SCHEMA)
    (row,) = merkle.merkle_manifest(docs).collect()
    assert row.leaf == sha256(b"1:51:s2:en1:33:abc").hexdigest() == row.root == row.subroot == row.folded_root
    assert row.verified and row.proof_sha256 == sha256(b"").hexdigest()
    empty = merkle.merkle_manifest(docs.limit(0))
    assert empty.collect() == [] and empty.columns[0] == "doc_id"


def test_paths_survive_as_text():
    tiers = merkle.folded([sha256(bytes([n])).hexdigest() for n in range(20)], 2)
    for at in range(20):
        steps = merkle.steps_up(tiers, at)
        assert merkle.path_steps(merkle.path_text(steps)) == steps
        assert merkle.fold_up(tiers[0][at], steps) == tiers[-1][0]
