import datetime as dt
import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from gridmetrics import plans
from gridmetrics.functions import parse_lines, with_event_time
from gridmetrics.schema import CSV_HEADER, ENERGY_SCHEMA
from gridmetrics.sinks import (
    append_run,
    materialised,
    read_runs,
    to_key_json,
    write_csv,
    write_outputs,
)
from gridmetrics.sources import (
    read_countries,
    read_energy,
    read_lines,
    register_energy,
    to_energy_table,
    union_sources,
    write_both_formats,
    write_energy,
)
from gridmetrics.workspace import new_folder

ROWS = [
    ("IT", "2021-01-01 00:00:00", 1.5, 50.0),
    ("IT", "2021-01-01 01:00:00", 2.5, 60.0),
    ("SE", "2021-01-01 00:00:00", 0.5, 99.0),
    ("SE", "bad", None, 98.0),
]


def _rows(frame):
    return sorted(map(tuple, frame.collect()), key=lambda row: [(x is not None, x) for x in row])


def _write(path, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n")


def _parts(path):
    return sorted(name for name in os.listdir(path) if name.startswith("part-"))


@pytest.fixture
def two_files(tmp_path):
    _write(tmp_path / "in" / "IT.csv", "Country,event_time,CarbonDirect,CFEpercent",
           "IT,2021-01-01 00:00:00,1.5,50.0", "IT,2021-01-01 01:00:00,2.5,60.0")
    _write(tmp_path / "in" / "deep" / "SE.csv", "land,when,carbon,cfe",
           "SE,2021-01-01 00:00:00,0.5,99.0", "SE,bad,,98.0")
    return str(tmp_path / "in")


def test_csv_binds_by_position_and_drops_each_header(spark, two_files):
    assert _rows(read_energy(spark, two_files, "csv")) == sorted(ROWS)


def test_csv_without_recursion_reads_the_top_folder(spark, two_files):
    top = read_energy(spark, two_files, "csv", recursive=False)
    assert {row.Country for row in top.collect()} == {"IT"}


def test_one_file_and_many_paths(spark, two_files):
    italy, sweden = f"{two_files}/IT.csv", f"{two_files}/deep/SE.csv"
    one, other = read_energy(spark, italy, "csv"), read_energy(spark, sweden, "csv")
    assert one.count() == 2
    both = _rows(union_sources(one, other))
    assert both == _rows(read_energy(spark, [italy, sweden], "csv")) == sorted(ROWS)
    assert union_sources(one, one).count() == 4


def test_bad_and_missing_fields_are_null(spark, tmp_path):
    lines = ["IT,2021-01-01 00:00:00,xx,", "IT,2021-01-01 01:00:00", "IT"]
    _write(tmp_path / "x.csv", CSV_HEADER, *lines)
    path = str(tmp_path / "x.csv")
    by_reader = with_event_time(read_energy(spark, path, "csv"))
    by_lines = parse_lines(read_lines(spark, path))
    expected = [
        ("IT", None, None, None),
        ("IT", dt.datetime(2021, 1, 1, 0), None, None),
        ("IT", dt.datetime(2021, 1, 1, 1), None, None),
    ]
    assert _rows(by_reader) == _rows(by_lines) == expected
    assert by_reader.schema == by_lines.schema


def test_unknown_format(spark):
    with pytest.raises(ValueError, match="parquet"):
        read_energy(spark, "anywhere", "orc")


def test_format_name_in_any_case(spark, two_files):
    assert read_energy(spark, two_files, "CSV").count() == 4


def test_lines_lose_the_first_line_of_every_file(spark, two_files):
    found = sorted(row.value for row in read_lines(spark, two_files).collect())
    assert found == [
        "IT,2021-01-01 00:00:00,1.5,50.0",
        "IT,2021-01-01 01:00:00,2.5,60.0",
        "SE,2021-01-01 00:00:00,0.5,99.0",
        "SE,bad,,98.0",
    ]


def test_lines_lose_a_given_header(spark, two_files):
    found = [row.value for row in read_lines(spark, two_files, header=CSV_HEADER).collect()]
    assert len(found) == 5 and CSV_HEADER not in found and "land,when,carbon,cfe" in found


def test_lines_keep_everything_without_header(spark, two_files):
    assert read_lines(spark, two_files, header=False).count() == 6


def test_lines_are_handed_over_whole(spark, tmp_path):
    odd = ['"IT",a "quoted" word', "back\\slash,,", "  spaces  ", "tab\tand;semicolon", "'#x"]
    _write(tmp_path / "odd.txt", "header", *odd)
    found = [row.value for row in read_lines(spark, str(tmp_path / "odd.txt")).collect()]
    assert found == odd


def test_header_is_dropped_once_from_a_file_read_in_pieces(spark, tmp_path):
    lines = [f"IT,2021-01-01 00:00:00,{i}.0,1.0" for i in range(2000)]
    _write(tmp_path / "long.csv", "header", *lines)
    limit = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        frame = read_lines(spark, str(tmp_path / "long.csv"))
        assert frame.rdd.getNumPartitions() > 4
        assert sorted(row.value for row in frame.collect()) == sorted(lines)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", limit)


def test_lines_and_reader_answer_alike(spark, two_files):
    by_lines = plans.yearly_fold(parse_lines(read_lines(spark, two_files)))
    assert _rows(by_lines) == _rows(plans.yearly_stats(read_energy(spark, two_files, "csv")))


def test_both_formats_hold_the_same(spark, energy_frame, tmp_path):
    paths = write_both_formats(energy_frame(ROWS), str(tmp_path / "out"))
    for fmt, path in paths.items():
        assert _rows(read_energy(spark, path, fmt)) == sorted(ROWS)


def test_ingest_renames_and_casts(spark):
    raw = spark.sql(
        "SELECT 'IT' zone, TIMESTAMP_NTZ'2021-01-01 00:00:00' at, '1.5' c, 'n/a' f"
        " UNION ALL SELECT 'SE', NULL, '2', '99.5'"
    )
    names = {"Country": "zone", "event_time": "at", "CarbonDirect": "c", "CFEpercent": "f"}
    energy = to_energy_table(raw, names)
    assert energy.schema.names == ENERGY_SCHEMA.names
    assert [f.dataType for f in energy.schema] == [f.dataType for f in ENERGY_SCHEMA]
    assert _rows(energy) == [("IT", "2021-01-01 00:00:00", 1.5, None), ("SE", None, 2.0, 99.5)]


def test_ingest_of_another_time_format(spark):
    raw = spark.sql(
        "SELECT 'IT' Country, '01/02/2021 03:00' event_time, 1 CarbonDirect, 2 CFEpercent"
    )
    energy = to_energy_table(raw, time_format="dd/MM/yyyy HH:mm")
    assert tuple(energy.first()) == ("IT", "2021-02-01 03:00:00", 1.0, 2.0)


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_country_folders(spark, energy_frame, tmp_path, fmt):
    path = str(tmp_path / "by")
    write_energy(energy_frame(ROWS), path, fmt, by_country=True)
    assert _rows(read_countries(spark, path, fmt, "SE")) == sorted(ROWS)[2:]
    assert _rows(read_countries(spark, path, fmt)) == sorted(ROWS)
    assert _rows(read_energy(spark, path, fmt)) == sorted(ROWS)


@pytest.mark.parametrize("by_country", [False, True])
def test_typed_copy(spark, energy_frame, tmp_path, by_country):
    path = str(tmp_path / "typed")
    write_energy(energy_frame(ROWS), path, by_country=by_country, typed=True)
    typed = read_energy(spark, path, typed=True)
    assert dict(typed.dtypes)["event_time"] == "timestamp_ntz"
    assert with_event_time(typed) is typed
    assert _rows(plans.yearly_stats(typed)) == _rows(plans.yearly_stats(energy_frame(ROWS)))
    with pytest.raises(ValueError, match="typed"):
        write_energy(energy_frame(ROWS), path, "csv", typed=True)


def test_a_dominant_country_is_written_by_many_tasks(spark, tmp_path):
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16KB",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        energy = spark.range(0, 200_000, 1, 8).select(
            F.when(F.col("id") % 10 == 0, F.concat(F.lit("C"), F.col("id") % 3))
            .otherwise("IT").alias("Country"),
            F.lit("2021-01-01 00:00:00").alias("event_time"),
            F.rand(1).alias("CarbonDirect"),
            F.rand(2).alias("CFEpercent"),
        )
        path = str(tmp_path / "skew")
        write_energy(energy, path, "parquet", by_country=True)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    counts = {name: len(_parts(f"{path}/place={name}")) for name in ("IT", "C0", "C1", "C2")}
    assert counts["IT"] >= 8
    assert min(counts.values()) <= 3
    assert read_energy(spark, path).count() == 200_000


def test_view_is_visible_to_sql(spark, energy_frame):
    register_energy(energy_frame(ROWS), "registered_energy")
    assert spark.sql("SELECT count(*) FROM registered_energy").first()[0] == 4


def test_single_file_is_sorted_and_has_a_header(spark, energy_frame, tmp_path):
    path = str(tmp_path / "one")
    stats = plans.yearly_stats(energy_frame(ROWS).repartition(4))
    write_csv(stats, path, single_file=True, order_by=["Country", "record_year"])
    assert len(_parts(path)) == 1
    lines = [row.value for row in spark.read.text(path).collect()]
    assert lines[0] == ",".join(stats.columns)
    assert [line[:8] for line in lines[1:]] == ["IT,2021,", "SE,,,,,9", "SE,2021,"]


def test_single_file_of_nothing_has_a_header(spark, energy_frame, tmp_path):
    path = str(tmp_path / "none")
    write_csv(plans.yearly_stats(energy_frame([])), path, single_file=True, order_by=["Country"])
    assert [row.value[:8] for row in spark.read.text(path).collect()] == ["Country,"]


def test_rows_are_in_order_across_files(spark, tmp_path):
    path = str(tmp_path / "many")
    write_csv(spark.range(0, 1000, 1, 4), path, order_by=["id"])
    assert len(_parts(path)) > 1
    read = [
        int(line)
        for name in _parts(path)
        for line in open(f"{path}/{name}").read().split("\n")[1:]
        if line
    ]
    assert read == list(range(1000))


@pytest.mark.parametrize("rows", [10, 2_000_000])
def test_the_number_of_rows_changes_nothing(spark, tmp_path, rows):
    path = str(tmp_path / "one")
    write_csv(spark.range(0, rows, 1, 4), path, single_file=True)
    assert len(_parts(path)) == 1
    write_csv(spark.range(0, rows, 1, 4), path)
    assert len(_parts(path)) == 4


def test_odd_country_names_are_found(spark, energy_frame, tmp_path):
    names = ["Cote d'Ivoire", "a/b", "a=b", None, "Italy", "IT"]
    rows = [(name, "2021-01-01 00:00:00", float(n), 1.0) for n, name in enumerate(names)]
    path = str(tmp_path / "by")
    write_energy(energy_frame(rows), path, by_country=True)
    assert {row.Country for row in read_countries(spark, path).collect()} == set(names)
    for name in names[:3]:
        assert [row.Country for row in read_countries(spark, path, country=name).collect()] == [name]
    assert {r.Country for r in read_countries(spark, path, country="IT").collect()} == {"IT", "Italy"}
    plan = read_countries(spark, path, country="IT")._jdf.queryExecution().toString()
    assert "PartitionFilters: [place" in plan


def test_lines_are_parsed_as_the_csv_reader_does(spark, tmp_path):
    lines = [
        '"Korea, South",2021-01-01 00:00:00,1.5,2', "IT,,x,3", "SE", "", "  ",
        ",2021-01-01 01:00:00,,", "IT,2021-01-01 00:00:00,1,2,5", 'a""b,2021-01-01 02:00:00,1,2',
    ]
    (tmp_path / "x.csv").write_text("\n".join([CSV_HEADER, *lines]) + "\n")
    path = str(tmp_path / "x.csv")
    expected = _rows(with_event_time(read_energy(spark, path, "csv")))
    for header in (True, CSV_HEADER):
        assert _rows(parse_lines(read_lines(spark, path, header))) == expected


def test_no_line_is_cut(spark, tmp_path):
    (tmp_path / "x.csv").write_text("head\na\u0001b\nc\n")
    rows = read_lines(spark, str(tmp_path / "x.csv")).collect()
    assert [row.value for row in rows] == ["a\u0001b", "c"]


def test_results_are_replaced(spark, tmp_path):
    path = str(tmp_path / "again")
    for n in (3, 2):
        write_csv(spark.range(n), path)
    assert spark.read.option("header", True).csv(path).count() == 2


def test_column_names_and_times_of_result_files(spark, tmp_path):
    path = str(tmp_path / "named")
    frame = spark.sql("SELECT 'IT' a, TIMESTAMP_NTZ'2021-01-01 00:00:00' b")
    write_csv(frame, path, single_file=True, column_names=["country", "25-perc"])
    assert [row.value for row in spark.read.text(path).collect()] == [
        "country,25-perc",
        "IT,2021-01-01T00:00:00.000Z",
    ]


def test_outputs_go_to_folders_of_their_own(spark, tmp_path):
    frames = {"up": spark.range(3), "down": spark.range(2)}
    paths = write_outputs(frames, str(tmp_path / "out"), True, order_by={"up": [F.desc("id")]})
    assert {name: os.path.basename(path) for name, path in paths.items()} == {n: n for n in frames}
    assert [row.value for row in spark.read.text(paths["up"]).collect()] == ["id", "2", "1", "0"]


def test_a_failed_output_is_reported(spark, tmp_path):
    frames = {"good": spark.range(3), "bad": spark.range(3).selectExpr("assert_true(id < 2)")}
    with pytest.raises(Exception, match="assert_true|is not true"):
        write_outputs(frames, str(tmp_path / "out"))


def test_materialised_leaves_nothing_behind(spark):
    frame = spark.range(10)
    with materialised(frame) as (kept, rows):
        assert rows == 10 and kept.storageLevel.useMemory
        with materialised(kept) as (again, _):
            assert again.storageLevel.useMemory
        assert kept.storageLevel.useMemory
    assert not frame.storageLevel.useMemory


def test_key_and_json(spark):
    frame = spark.sql("SELECT 'IT' Country, 2021 year, 1.5D x, CAST(NULL AS DOUBLE) y, 'a' z")
    assert [tuple(row) for row in to_key_json(frame, ["Country", "year"], "yearly").collect()] == [
        ("yearly:IT:2021", '{"x":1.5,"y":null,"z":"a"}')
    ]
    null = spark.sql("SELECT CAST(NULL AS STRING) Country, 2021 year, 1 x")
    assert to_key_json(null, ["Country", "year"]).first().key == "\\N:2021"
    pairs = [("a:b", "c"), ("a", "b:c"), ("a\\", ":c"), (None, "c"), ("\\N", "c"), ("null", "c")]
    keys = to_key_json(spark.createDataFrame(pairs, "x string, y string"), ["x", "y"]).collect()
    assert len({row.key for row in keys}) == len(pairs)


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_run_log_grows(spark, tmp_path, fmt):
    path = str(tmp_path / "runs")
    append_run(spark, path, 1, 2, 1.23456789, fmt)
    append_run(spark, path, 11, 4, 3, fmt)
    assert _rows(read_runs(spark, path, fmt)) == [(1, 2, 1.234568), (11, 4, 3.0)]


def test_new_folders_lie_in_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    first, second = new_folder(spark, "x"), new_folder(spark, "x")
    assert first != second
    assert os.path.isdir(first.removeprefix("file:"))
    if base:
        assert first.startswith(base)


def _session(spark, **settings):
    """The session, but for its settings."""
    conf = SimpleNamespace(get=lambda key, default=None: settings.get(key, default))
    return SimpleNamespace(conf=conf, sparkContext=spark.sparkContext)


def test_the_shared_folder_of_the_session_is_used(spark, tmp_path):
    settings = {"spark.master": "yarn", "spark.checkpoint.dir": f"{tmp_path}/shared/"}
    path = new_folder(_session(spark, **settings), "x")
    assert path.startswith(f"{tmp_path}/shared/gridmetrics/x-")


def test_the_warehouse_is_used_where_no_shared_folder_is_named(spark, tmp_path):
    session = _session(spark, **{"spark.sql.warehouse.dir": str(tmp_path)})
    assert new_folder(session, "x").startswith(f"{tmp_path}/gridmetrics/x-")
