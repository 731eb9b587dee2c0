"""Exact order statistics of groups of any size, without a task that holds a group.

``percentile`` keeps all values of a group in one task. Here a sketch of each group, of bounded size, names
a few marks around the wanted quantiles. One more pass counts the rows of each class: equal to a mark, or
between two. The counts tell which class holds a wanted position. A position equal to a mark is
found; of the others only the rows of their classes, a small part, are gone through again, as groups of
their own, until what is left of each is short. Counts are exact, so the result is, however
good the sketch; a poor one only costs another round.

All steps combine before they shuffle, so a country that holds a third of the rows is spread over tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridmetrics.operators.positions import null_safe_join
from gridmetrics.schema import COUNTRY, METRICS, QUARTILES, SUMMARY_COLUMNS, Metric
from gridmetrics.workspace import stored

#: One over the rank error of the sketches.
ACCURACY = 10_000
#: Values of a class that are looked through in one window.
SHORT = 10_000
#: Marks of later rounds, evenly spread.
LATER_MARKS = tuple(n / 8 for n in range(1, 8))

_PATH = "_path"


def long_values(
    df: DataFrame, metrics: Sequence[Metric] = METRICS, keys: Sequence[str] = (COUNTRY,)
) -> DataFrame:
    """One row per key and value of a metric: keys, ``data`` (the metric's tag) and ``value``."""
    tagged = df.select(
        *keys, *(F.col(metric.column).cast("double").alias(metric.tag) for metric in metrics)
    )
    return tagged.unpivot(list(keys), [metric.tag for metric in metrics], "data", "value")


def _brackets(probabilities: Sequence[float], accuracy: int) -> tuple[list[float], list[int]]:
    """Marks to both sides of each quantile, farther away than the sketch errs, and the classes inside."""
    wide = 2 / accuracy
    sides = [(max(p - wide, 0.0), min(p + wide, 1.0)) for p in probabilities]
    marks = sorted({mark for side in sides for mark in side})
    inside = [
        2 * n + 2
        for n, (low, high) in enumerate(zip(marks, marks[1:]))
        if any(a <= low and high <= b for a, b in sides)
    ]
    return marks, inside


def _with_class(rows: DataFrame, marks: DataFrame, names: Sequence[str], count: int) -> DataFrame:
    """``_class`` of every value: the number of marks below it and that of marks not above it.

    It rises with the value, is odd for a value equal to a mark and even between two marks.
    """
    joined = null_safe_join(rows, marks, names)
    steps = [F.get("_marks", F.lit(i)) for i in range(count)]
    value = F.col("value")
    passed = [(value > mark).cast("int") + (value >= mark).cast("int") for mark in steps]
    return joined.withColumn("_class", reduce(Column.__add__, passed)).drop("_marks")


def _chosen(classes: DataFrame, wanted: DataFrame, names: Sequence[str]) -> DataFrame:
    """The class of every wanted position and the position inside it.

    ``classes`` has one row per class with the number of its rows, a few per group.
    """
    classes = classes.withColumn("_upto", F.sum("_rows").over(Window.partitionBy(*names).orderBy("_class")))
    found = null_safe_join(wanted, classes, names)
    before = F.col("_upto") - F.col("_rows")
    found = found.where((before <= F.col("position")) & (F.col("position") < F.col("_upto")))
    inner = (F.col("position") - before).alias("position")
    return found.select(*names, "asked", inner, "_class", "_low", "_high")


def order_statistics(
    values: DataFrame,
    names: Sequence[str],
    wanted: DataFrame,
    marks: DataFrame,
    inside: Sequence[int],
    mark_count: int,
    short: int = SHORT,
) -> DataFrame:
    """The values at wanted positions: names, ``asked`` and ``value``.

    ``values`` has names and ``value`` (without NULL and NaN), ``wanted`` names, ``asked`` (any label)
    and ``position`` (from 0), ``marks`` names and ``_marks``, an ascending array of ``mark_count``
    values of each group. The classes in ``inside`` are likely to hold the positions: their values are
    kept in the pass that counts. If one is elsewhere after all, the rows of its class are read again.
    """
    plain = list(names)
    names, found = [*plain, _PATH], []
    rows = values.select(*plain, F.lit("").alias(_PATH), "value", F.lit(1).cast("long").alias("n"))
    wanted, marks = (df.withColumn(_PATH, F.lit("")) for df in (wanted, marks))
    deeper = F.concat(F.col(_PATH), F.col("_class").cast("string"), F.lit(".")).alias(_PATH)
    while True:
        classed = _with_class(rows, marks, names, mark_count)
        kept = F.when(F.col("_class").isin(list(inside)), F.col("value")) if inside else F.col("value")
        # Outside, a class is one row of each task, inside it is one for each value.
        counted = classed.withColumn("_kept", kept).groupBy(*names, "_class", "_kept")
        counted = counted.agg(F.sum("n").alias("n"), F.min("value").alias("_low"), F.max("value").alias("_high"))
        counted = stored(counted, "selection")
        classes = counted.groupBy(*names, "_class").agg(
            F.sum("n").alias("_rows"), F.min("_low").alias("_low"), F.max("_high").alias("_high")
        )
        chosen = stored(_chosen(classes, wanted, names), "selection")
        single = F.col("_low") == F.col("_high")
        found.append(chosen.where(single).select(*plain, "asked", F.col("_low").alias("value")))
        left = chosen.where(~single)
        needed = left.select(*names, "_class").distinct()
        again = null_safe_join(counted, needed, [*names, "_class"], "left_semi")
        parts = [again.where("_kept is not null").select(*plain, deeper, F.col("_kept").alias("value"), "n")]
        missed = again.where("_kept is null").select(*names, "_class")
        if inside and not missed.isEmpty():
            read = null_safe_join(classed, missed, [*names, "_class"], "left_semi")
            parts.append(read.groupBy(*plain, deeper, "value").agg(F.sum("n").alias("n")))
        rows = stored(reduce(DataFrame.unionByName, parts), "selection")
        wanted = left.select(*plain, "asked", "position", deeper)
        sketch = F.percentile_approx("value", list(LATER_MARKS), ACCURACY).alias("_marks")
        marks = stored(rows.groupBy(*names).agg(F.count("*").alias("_size"), sketch), "selection")
        longest = marks.agg(F.max("_size")).first()[0]
        if longest is None or longest <= short:
            break
        marks, inside, mark_count = marks.drop("_size"), (), len(LATER_MARKS)
    upto = F.sum("n").over(Window.partitionBy(*names).orderBy("value"))
    last = null_safe_join(wanted, rows.withColumn("_upto", upto), names)
    here = (F.col("_upto") - F.col("n") <= F.col("position")) & (F.col("position") < F.col("_upto"))
    found.append(last.where(here).select(*plain, "asked", "value"))
    return reduce(DataFrame.unionByName, found)


def row_quantiles(
    values: DataFrame,
    names: Sequence[str],
    probabilities: Sequence[float] = QUARTILES,
    accuracy: int = ACCURACY,
    short: int = SHORT,
) -> DataFrame:
    """Per group of ``names``: ``n``, ``min``, ``max`` and ``quantiles``, interpolated as ``percentile`` does.

    NULL and NaN values are skipped; a group without any other has NULL results. A whole table is
    read twice, in the same shares by all tasks.
    """
    usable = values.select(*names, F.when(~F.isnan("value"), F.col("value")).alias("value"))
    fractions, inside = _brackets(probabilities, accuracy)
    sized = usable.groupBy(*names).agg(
        F.count("value").alias("n"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.percentile_approx("value", fractions, accuracy).alias("_marks"),
    )
    sized = stored(sized, "selection")
    some = sized.where("n > 0")
    place = [F.lit(float(p)) * (F.col("n") - 1) for p in probabilities]
    asked = F.array(
        *(
            F.struct(F.lit(2 * i + side).alias("asked"), end(at).cast("long").alias("position"))
            for i, at in enumerate(place)
            for side, end in enumerate((F.floor, F.ceil))
        )
    )
    wanted = some.select(*names, F.inline(asked))
    marks = some.select(*names, "_marks")
    found = order_statistics(
        usable.where("value is not null"), names, wanted, marks, inside, len(fractions), short
    )
    ends = [F.max(F.when(F.col("asked") == i, F.col("value"))) for i in range(2 * len(place))]
    ends = found.groupBy(*names).agg(*(end.alias(f"_end{i}") for i, end in enumerate(ends)))
    joined = null_safe_join(sized, ends, names, "left")
    between = [
        F.col(f"_end{2 * i}")
        + (F.col(f"_end{2 * i + 1}") - F.col(f"_end{2 * i}")) * (at - F.floor(at))
        for i, at in enumerate(place)
    ]
    return joined.select(*names, "n", "min", "max", F.array(*between).alias("quantiles"))


def row_five_number(
    df: DataFrame, metrics: Sequence[Metric] = METRICS, keys: Sequence[str] = (COUNTRY,)
) -> DataFrame:
    """Minimum, exact quartiles and maximum of the measurements themselves, per key and metric.

    The result has the columns of ``five_number``, which summarises the means of hours instead.
    """
    names = [*keys, "data"]
    summary = row_quantiles(long_values(df, metrics, keys), names)
    marks = [F.get("quantiles", F.lit(i)) for i in range(len(QUARTILES))]
    numbers = zip([F.col("min"), *marks, F.col("max")], SUMMARY_COLUMNS[2:], strict=True)
    return summary.select(*names, *(value.alias(name) for value, name in numbers))
