"""Exact quantiles by selection, and positions, against sorted lists."""

import contextlib
import io
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridmetrics.operators import row_five_number, row_quantiles, value_positions, with_positions
from gridmetrics.operators import selection

PROBABILITIES = (0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0)


def _frame(spark, rows):
    return spark.createDataFrame(rows, "k string, value double").repartition(6)


def _wanted(rows):
    groups = {}
    for key, value in rows:
        groups.setdefault(key, []).append(value)
    for key, values in groups.items():
        usable = [v for v in values if v is not None and not math.isnan(v)]
        if usable:
            yield key, len(usable), [float(np.quantile(usable, p)) for p in PROBABILITIES]
        else:
            yield key, 0, [None] * len(PROBABILITIES)


def _made(seed, n):
    rng = random.Random(seed)
    kinds = [
        lambda: rng.random(),
        lambda: float(rng.choice([1, 2, 2, 2, 2, 3])),
        lambda: rng.choice([None, float("nan"), rng.gauss(0, 1e6)]),
        lambda: 0.0 if rng.random() < 0.4 else rng.expovariate(1e-3),
    ]
    rows = [(f"k{i % 4}", kinds[i % 4]()) for i in range(n)]
    return rows + [(None, float(i)) for i in range(7)] + [("one", 3.5), ("none", None), ("two", 1.0), ("two", 2.0)]


@pytest.mark.parametrize(("accuracy", "short"), [(10_000, 10_000), (50, 10), (4, 3)])
def test_quantiles_are_exact(spark, accuracy, short):
    """Also where the sketch is so poor that classes are read again, and over several rounds."""
    rows = _made(accuracy, 4000)
    found = row_quantiles(_frame(spark, rows), ["k"], PROBABILITIES, accuracy, short).collect()
    found = {row.k: (row.n, row.quantiles) for row in found}
    wanted = list(_wanted(rows))
    assert set(found) == {key for key, *_ in wanted}
    for key, n, quantiles in wanted:
        assert found[key][0] == n
        assert found[key][1] == (pytest.approx(quantiles, rel=1e-9) if n else quantiles)


def test_a_wrong_sketch_costs_a_round_only(spark):
    rows = [("a", float(i)) for i in range(1000)]
    wanted = spark.createDataFrame([("a", 1, 500), ("a", 2, 0), ("a", 3, 999)], "k string, asked int, position long")
    marks = spark.createDataFrame([("a", [1.0, 2.0, 3.0, 3.0])], "k string, _marks array<double>")
    found = selection.order_statistics(_frame(spark, rows), ["k"], wanted, marks, [2, 6], 4, 20)
    assert {row.asked: row.value for row in found.collect()} == {1: 500.0, 2: 0.0, 3: 999.0}


def test_empty_table(spark):
    assert row_quantiles(_frame(spark, []), ["k"]).collect() == []
    assert value_positions(_frame(spark, []), ["k"], "value").collect() == []
    assert with_positions(_frame(spark, []), ["value"]).collect() == []


def test_five_numbers_of_rows(energy_frame):
    rows = [("IT", "2021-01-01 00:00:00", float(i), None) for i in (4, 1, 3, 2)]
    found = {row.data: row for row in row_five_number(energy_frame(rows)).collect()}
    assert tuple(found["carbon-intensity"])[2:] == (1.0, 1.75, 2.5, 3.25, 4.0)
    assert tuple(found["cfe"])[2:] == (None,) * 5


def test_no_task_holds_a_group(spark):
    """Every exchange by group comes after a partial aggregation, so a task sends a few rows of a group."""
    frame = _frame(spark, _made(1, 100))
    marks = frame.groupBy("k").agg(F.percentile_approx("value", [0.2, 0.8], 100).alias("_marks"))
    classed = selection._with_class(frame, marks, ["k"], 2)
    counted = classed.groupBy("k", "_class").agg(F.sum("value"))
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        counted.explain()
    plan = text.getvalue()
    assert "partial_percentile_approx" in plan and "partial_sum" in plan
    assert "collect_list" not in plan and "percentile(" not in plan


def test_positions_against_sorted_lists(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", None]), rng.choice([1.0, 2.0, 2.0, 2.0, None, 5.5, 7.0]), i) for i in range(700)]
    frame = spark.createDataFrame(rows, "k string, value double, i int").repartition(5)
    found = with_positions(frame, [F.col("value").asc_nulls_first(), "i"], ["k"]).collect()
    for key in ("a", "b", None):
        wanted = sorted((row for row in rows if row[0] == key), key=lambda row: (row[1] is not None, row[1] or 0, row[2]))
        mine = sorted((row for row in found if row.k == key), key=lambda row: row.position)
        assert [tuple(row)[:3] for row in mine] == wanted
        assert [row.position for row in mine] == list(range(len(wanted)))
        assert {row.group_size for row in mine} == {len(wanted)}
    for row in value_positions(frame, ["k"], "value").collect():
        values = [value for key, value, _ in rows if key == row.k and value is not None]
        assert row.n == values.count(row.value) and row.group_size == len(values)
        assert row.first_position == sum(value < row.value for value in values)
