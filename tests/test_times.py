import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from gridmetrics.functions import (
    event_time,
    time_fields,
    time_text,
    with_event_time,
    with_parts,
)
from gridmetrics.schema import TIME_FORMAT

BAD = [
    None,
    "",
    "bad",
    "2021-02-30 00:00:00",
    "2021-01-01T00:00:00",
    "2021-01-01 00:00:00.5",
    "2021-01-01 00:00:00Z",
    "2021-01-01 00:00:00 ",
    "2021-01-01 00:00:00\n",
    " 2021-01-01 00:00:00",
    "2021-1-1 0:0:0",
    "2021-01-01",
    "2021-01-01 24:00:00",
    "12021-01-01 00:00:00",
]


def _parsed(spark, texts, column=None):
    frame = spark.createDataFrame([(text,) for text in texts], "t string")
    time = event_time(F.col("t")) if column is None else column
    return [row[0] for row in frame.select(time).collect()]


def test_good_time(spark):
    assert _parsed(spark, ["2021-12-31 23:59:58"]) == [dt.datetime(2021, 12, 31, 23, 59, 58)]


@pytest.mark.parametrize("text", BAD)
def test_bad_time_is_null(spark, text):
    assert _parsed(spark, [text]) == [None]


def test_same_as_the_strict_formatter(spark):
    """The cast behind a pattern accepts what the formatter accepts, and nothing else."""
    rng = random.Random(5)
    good = "2021-03-28 02:15:00"
    texts = list(BAD)
    for _ in range(3000):
        text = list(good)
        for _ in range(rng.randint(1, 3)):
            place = rng.randrange(len(text))
            text[place] = rng.choice("0123456789-: TZ.+")
        if rng.random() < 0.2:
            text.insert(rng.randrange(len(text)), rng.choice("0 -:"))
        texts.append("".join(text))
    strict = F.try_to_timestamp(F.col("t"), F.lit(TIME_FORMAT)).cast("timestamp_ntz")
    found = _parsed(spark, texts, event_time(F.col("t")).cast("string"))
    expected = _parsed(spark, texts, strict.cast("string"))
    differing = [t for t, a, b in zip(texts, found, expected, strict=True) if a != b]
    assert differing == []
    assert sum(time is not None for time in found) > 50


def test_parts_do_not_depend_on_the_session_zone(spark, energy_frame):
    frame = energy_frame([("IT", "2021-03-28 02:00:00", 1.0, 2.0)])
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Rome")
    try:
        row = with_parts(with_event_time(frame), "year", "month", "hour").first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert (row.record_year, row.record_month, row.record_hour) == (2021, 3, 2)
    assert row.event_time == dt.datetime(2021, 3, 28, 2)


def test_parts_are_integers(energy_frame):
    frame = with_parts(with_event_time(energy_frame([])), "year", "month", "hour")
    kinds = dict(frame.dtypes)
    assert {kinds[f"record_{part}"] for part in ("year", "month", "hour")} == {"int"}
    assert kinds["event_time"] == "timestamp_ntz"


def test_other_format(spark):
    column = event_time(F.col("t"), "dd/MM/yyyy HH:mm")
    assert _parsed(spark, ["31/12/2021 07:05", "x"], column) == [
        dt.datetime(2021, 12, 31, 7, 5),
        None,
    ]


def test_parsed_times_are_left_alone(spark):
    frame = spark.sql("SELECT TIMESTAMP_NTZ'2021-01-01 00:00:00' AS event_time")
    assert with_event_time(frame) is frame


def test_time_text_cuts_fractions(spark):
    frame = spark.sql("SELECT TIMESTAMP_NTZ'2021-01-01 10:00:59.987' AS t")
    assert frame.select(time_text(F.col("t"))).first()[0] == "2021-01-01 10:00:59"


def test_fields_as_written(spark):
    texts = ["2021-01-01 00:05:00", "2021-13-45  99:00:00 ", "2021-x-01", "", None]
    assert _parsed(spark, texts, time_fields(F.col("t"))) == [
        [2021, 1, 1, 0, 5, 0],
        [2021, 13, 45, 99, 0, 0],
        [2021, None, 1],
        [None],
        None,
    ]
