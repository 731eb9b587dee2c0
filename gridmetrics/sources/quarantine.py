"""Ingest that says what it could not read, and keeps it.

``to_energy_table`` reads what it can and leaves NULL elsewhere. Here a row with a field that cannot be read goes
to a quarantine with its raw fields and the reasons, in the same pass that writes the others, and
the counts by column and reason are observed on the way.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gridmetrics.functions.timeparts import event_time
from gridmetrics.schema import COUNTRY, ENERGY_SCHEMA, EVENT_TIME, TIME_FORMAT
from gridmetrics.sources.ingest import to_energy_table
from gridmetrics.sources.readers import read_energy

MISSING, UNREADABLE = "missing", "unreadable"
#: Reasons looked for, by column: a measurement may be missing, a country is any text.
REASONS = {
    COUNTRY: (MISSING,),
    EVENT_TIME: (MISSING, UNREADABLE),
    "CarbonDirect": (UNREADABLE,),
    "CFEpercent": (UNREADABLE,),
}
_QUALITY, _ACCEPTED, _REJECTED = "quality", "accepted", "rejected"
_RAW, _WHY = "raw", "rejects"


@dataclass(frozen=True)
class IngestReport:
    """Rows read and rejected, and how many fields were rejected by column and reason."""

    rows: int
    rejected: int
    counts: dict[tuple[str, str], int] = field(default_factory=dict)

    @property
    def accepted(self) -> int:
        return self.rows - self.rejected


def _blank(raw: Column) -> Column:
    return raw.isNull() | (F.trim(raw.cast("string")) == "")


def _reasons(raw: Mapping[str, Column], read: Mapping[str, Column]) -> dict[tuple[str, str], Column]:
    """Whether a field has to be rejected for a reason, never NULL."""
    found = {}
    for name, reasons in REASONS.items():
        if MISSING in reasons:
            found[name, MISSING] = _blank(raw[name])
        if UNREADABLE in reasons:
            found[name, UNREADABLE] = ~_blank(raw[name]) & read[name].isNull()
    return found


def checked_rows(
    df: DataFrame, columns: Mapping[str, str] | None = None, time_format: str = TIME_FORMAT
) -> DataFrame:
    """The energy columns, ``raw`` (the fields as they came, as text) and ``rejects`` (column and reason).

    ``columns`` and ``time_format`` are those of ``to_energy_table``. Times have to be real ones here.
    """
    names = {name: name for name in ENERGY_SCHEMA.names} | dict(columns or {})
    raw = F.struct(*(F.col(names[name]).cast("string").alias(name) for name in ENERGY_SCHEMA.names))
    carried = df.select("*", raw.alias("_raw"))
    read = to_energy_table(carried, columns, time_format, keep=["_raw"])
    # Text in the standard format passes unread above.
    seen = {name: F.col(name) for name in read.columns} | {EVENT_TIME: event_time(F.col(EVENT_TIME))}
    told = _reasons({name: F.col("_raw")[name] for name in ENERGY_SCHEMA.names}, seen)
    why = F.array_compact(
        F.array(
            *(
                F.when(bad, F.struct(F.lit(name).alias("column"), F.lit(reason).alias("reason")))
                for (name, reason), bad in told.items()
            )
        )
    )
    return read.select(*ENERGY_SCHEMA.names, F.col("_raw").alias(_RAW), why.alias(_WHY))


def ingest_checked(
    df: DataFrame,
    path: str,
    columns: Mapping[str, str] | None = None,
    time_format: str = TIME_FORMAT,
) -> IngestReport:
    """Write readable rows and the quarantine below ``path`` in one pass; returns what was counted in it.

    See ``read_accepted`` and ``read_quarantine``. A retried task counts once.
    """
    rows = checked_rows(df, columns, time_format)
    bad = F.size(_WHY) > 0
    seen = Observation(f"ingest-{uuid.uuid4().hex}")
    observed = rows.observe(
        seen,
        F.count(F.lit(1)).alias("rows"),
        F.count_if(bad).alias("rejected"),
        *(F.count_if(_has(*pair)).alias(f"count_{i}") for i, pair in enumerate(_pairs())),
    )
    quality = F.when(bad, F.lit(_REJECTED)).otherwise(F.lit(_ACCEPTED))
    kept = observed.withColumn(_RAW, F.when(bad, F.col(_RAW))).withColumn(_QUALITY, quality)
    kept.write.mode("overwrite").partitionBy(_QUALITY).parquet(path)
    told = seen.get
    counts = {pair: told[f"count_{i}"] for i, pair in enumerate(_pairs())}
    return IngestReport(told["rows"], told["rejected"], counts)


def _has(name: str, reason: str) -> Column:
    return F.exists(_WHY, lambda why: (why["column"] == name) & (why["reason"] == reason))


def _pairs() -> list[tuple[str, str]]:
    return [(name, reason) for name, reasons in REASONS.items() for reason in reasons]


def _part(spark: SparkSession, path: str, quality: str) -> str | None:
    """The folder of one kind of rows, None where there are none."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path, f"{_QUALITY}={quality}")
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return folder.toString() if files.exists(folder) else None


def read_accepted(spark: SparkSession, path: str) -> DataFrame:
    """The energy table of the rows that could be read."""
    folder = _part(spark, path, _ACCEPTED)
    return spark.createDataFrame([], ENERGY_SCHEMA) if folder is None else read_energy(spark, folder)


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """One row per rejected field: ``column``, ``reason``, the ``text`` that stood there, and the row's ``raw`` fields."""
    raw = ", ".join(f"{name}: string" for name in ENERGY_SCHEMA.names)
    schema = f"{_RAW} struct<{raw}>, {_WHY} array<struct<column: string, reason: string>>"
    folder = _part(spark, path, _REJECTED)
    rows = spark.createDataFrame([], schema) if folder is None else spark.read.schema(schema).parquet(folder)
    fields = F.create_map(
        *(part for name in ENERGY_SCHEMA.names for part in (F.lit(name), F.col(_RAW)[name]))
    )
    rejected = rows.select(F.explode(_WHY).alias("why"), _RAW, fields.alias("fields"))
    text = F.try_element_at("fields", F.col("why.column")).alias("text")
    return rejected.select("why.column", "why.reason", text, _RAW)
