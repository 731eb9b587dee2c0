"""Tables of batches: the run log and the stored loads, under retries, compaction and readers."""

import threading

import pytest
from pyspark.sql import functions as F

from gridmetrics.functions import with_event_time, with_parts
from gridmetrics.operators import finish_fold, fold, rank_error, sketched_quartiles
from gridmetrics.operators.sketches import SKETCH_SIZE
from gridmetrics.sinks import FoldStore, append_run, append_runs, compact_runs, read_runs
from gridmetrics.sinks.batches import (
    compact_batches,
    list_batches,
    read_batches,
    remove_replaced,
    write_batch,
)

KEYS = ["Country", "record_year"]


def _rows(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_runs_read_alike_before_and_after_compaction(spark, tmp_path, fmt):
    path = str(tmp_path / "runs")
    assert read_runs(spark, path, fmt).collect() == []
    runs = [(n, n % 4 + 1, n / 7) for n in range(1, 18)]
    append_runs(spark.createDataFrame(runs, "query int, workers_number int, tempo_totale double"), path, fmt)
    append_run(spark, path, 5, 2, 3.25, fmt)
    append_run(spark, path, 5, 2, 3.25, fmt)
    before = _rows(read_runs(spark, path, fmt))
    assert len(before) == 19
    compact_runs(spark, path, fmt)
    batches = list_batches(spark, path)
    assert (len(batches.live), len(batches.replaced)) == (1, 3)
    assert _rows(read_runs(spark, path, fmt)) == before
    append_run(spark, path, 6, 1, 1.5, fmt)
    compact_runs(spark, path, fmt, remove=True)
    assert len(list_batches(spark, path).live) == 1 and not list_batches(spark, path).replaced
    assert _rows(read_runs(spark, path, fmt)) == sorted([*before, (6, 1, 1.5)])


def test_a_batch_is_not_read_before_its_note(spark, tmp_path):
    """What a job that died, or is still writing, has left behind is no part of the table."""
    path = str(tmp_path / "t")
    frame = spark.createDataFrame([(1,)], "n int")
    write_batch(frame, path)
    frame.write.parquet(f"{path}/batch-unfinished")
    assert _rows(read_batches(spark, path, "n int")) == [(1,)]
    assert compact_batches(spark, path, "n int") is None


def test_a_reader_that_listed_before_can_finish(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in range(3):
        write_batch(spark.createDataFrame([(n,)], "n int"), path)
    reader = read_batches(spark, path, "n int")
    compact_batches(spark, path, "n int")
    assert _rows(reader) == [(0,), (1,), (2,)] == _rows(read_batches(spark, path, "n int"))
    write_batch(spark.createDataFrame([(7,)], "n int"), path)
    compact_batches(spark, path, "n int")
    assert remove_replaced(spark, path) == 5
    assert _rows(read_batches(spark, path, "n int")) == [(0,), (1,), (2,), (7,)]


def test_batches_written_together(spark, tmp_path):
    path = str(tmp_path / "t")
    frames = [spark.createDataFrame([(n,)], "n int") for n in range(4)]
    threads = [threading.Thread(target=write_batch, args=(frame, path)) for frame in frames]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert _rows(read_batches(spark, path, "n int")) == [(0,), (1,), (2,), (3,)]


@pytest.fixture
def loads(energy_frame):
    def made(*rows):
        return with_parts(with_event_time(energy_frame(list(rows))), "year")

    return made


def _row(country, year, carbon, cfe=None):
    return (country, f"{year}-03-01 00:00:00", carbon, cfe)


def test_a_load_sent_twice_counts_once(spark, tmp_path, loads):
    first = loads(_row("IT", 2021, 1.0, 5.0), _row("IT", 2021, 3.0), _row(None, 2021, 8.0))
    second = loads(_row("IT", 2021, 5.0), _row("SE", 2022, 7.0, 1.0))
    store = FoldStore.like(first, str(tmp_path / "loads"), KEYS)
    assert store.merged().collect() == []
    store.send("a", fold(loads(_row("IT", 2021, 900.0), _row("XX", 1999, 1.0)), KEYS))
    store.send("b", fold(second, KEYS))
    store.send("a", fold(first, KEYS))
    store.send("b", fold(second, KEYS))
    both = fold(first.unionByName(second), KEYS)
    key = lambda row: tuple(str(value) for value in row)
    wanted = sorted(map(tuple, both.collect()), key=key)
    assert sorted(map(tuple, store.merged().collect()), key=key) == wanted
    store.compact(remove=True)
    assert len(list_batches(spark, store.path).live) == 1
    assert sorted(map(tuple, store.merged().collect()), key=key) == wanted
    assert sorted(row.load_id for row in store.loads().collect()) == ["a", "b"]
    # A load inside the compacted batch can still be sent again, also empty.
    store.send("b", fold(second.limit(0), KEYS))
    wanted = sorted(map(tuple, fold(first, KEYS).collect()), key=key)
    assert sorted(map(tuple, store.merged().collect()), key=key) == wanted
    store.compact()
    assert sorted(map(tuple, store.merged().collect()), key=key) == wanted
    means = {row.Country: row.avg_carbon_intensity for row in finish_fold(store.merged(), KEYS).collect()}
    assert means == {"IT": 2.0, None: 8.0}


def test_the_higher_version_counts_whichever_ends_first(spark, tmp_path, loads):
    new, old = loads(_row("IT", 2021, 1.0)), loads(_row("IT", 2021, 2.0))
    store = FoldStore.like(new, str(tmp_path / "loads"), KEYS)
    store.send("a", fold(new, KEYS), version=2)
    store.send("a", fold(old, KEYS), version=1)
    assert store.merged().first().sum_carbon_intensity == 1.0


def test_sketches_of_loads(spark, tmp_path):
    rows = spark.range(60_000).select(
        F.lit("IT").alias("Country"),
        (F.col("id") % 6).alias("part"),
        ((F.col("id") * 7919) % 60_000).cast("double").alias("CarbonDirect"),
        F.when(F.col("id") == 1, float("nan")).alias("CFEpercent"),
    )
    folded = fold(rows, ["part", "Country"], sketch_size=SKETCH_SIZE)
    store = FoldStore(spark, str(tmp_path / "s"), ["Country"], folded.drop("part").schema)
    store.send_many(folded, "part")
    store.send_many(folded.where("part = 3"), "part")
    assert store.loads().count() == 6
    row = sketched_quartiles(store.merged(), ["Country"]).first()
    assert (row.n_carbon_intensity, row.min_carbon_intensity, row.max_carbon_intensity) == (60_000, 0.0, 59_999.0)
    for p in (25, 50, 75):
        assert abs(row[f"perc_{p}_carbon_intensity"] / 60_000 - p / 100) <= rank_error()
        assert row[f"perc_{p}_cfe_percentage"] is None
    assert len(store.merged().first().sketch_carbon_intensity) < 100_000
    assert rank_error(200) > rank_error(4000) > 0.001
