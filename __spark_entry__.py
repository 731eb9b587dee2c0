"""

The energy table is played by two of them. ``lineitem`` stands in for the yearly and monthly
questions (country = return flag, time = ship date, metrics = price and discount), ``events`` for
the hourly one (country = event type, metrics = value and the number in ``props``). All queries
run over whole tables.

Sums of doubles depend on the order in which tasks finish, unless the values are whole numbers. So
the metrics are taken in hundredths, and means compare to the last bit. Only quartiles are rounded
(six decimals): the interpolation formulas differ in the last bit.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmetrics import jobs, plans
from gridmetrics.functions import (
    canonical_country,
    of_country,
    parse_lines,
    time_fields,
    time_text,
    with_event_time,
    with_parts,
)
from gridmetrics.operators import (
    finish_fold,
    five_number,
    fold,
    merge_folds,
    period_means,
    rank_error,
    ranking_board,
    rankings,
    rankings_by,
    row_five_number,
    run_comparison,
    run_means,
    sketched_quartiles,
    to_long,
    value_positions,
    with_positions,
)
from gridmetrics.operators.positions import null_safe_join
from gridmetrics.operators.rank import ranking_orders
from gridmetrics.operators.sketches import SKETCH_SIZE
from gridmetrics.plans.questions import HOURLY_KEYS, YEARLY_KEYS
from gridmetrics.schema import (
    COUNTRY,
    CSV_HEADER,
    EVENT_TIME,
    HOUR,
    METRICS,
    MONTH,
    QUARTILES,
    TOP_K,
    YEAR,
)
from gridmetrics.sinks import (
    FoldStore,
    append_runs,
    key_digests,
    key_json_changes,
    materialised,
    read_runs,
    to_key_json,
    write_csv,
    write_outputs,
)
from gridmetrics.sinks.writers import TIME_OUTPUT
from gridmetrics.sources import (
    ingest_checked,
    read_accepted,
    read_clustered,
    read_countries,
    read_energy,
    read_lines,
    read_quarantine,
    register_energy,
    to_energy_table,
    union_sources,
    write_both_formats,
    write_clustered,
    write_energy,
)
from gridmetrics.workspace import new_folder

try:
    import corpus_pipeline
    from gridmetrics.llm import queries as llm_queries
except ModuleNotFoundError as missing:  # the subpackage, or a library that only it needs, can be absent
    if (missing.name or "").startswith("gridmetrics.") and not missing.name.startswith("gridmetrics.llm"):
        raise
    LLM_QUERIES, LLM_ORACLE_SQL = {}, {}
else:
    LLM_QUERIES = {**llm_queries.QUERIES, "pipeline": corpus_pipeline.run}
    LLM_ORACLE_SQL = {**llm_queries.ORACLE_SQL}
    if corpus_pipeline.ORACLE_SQL is not None:
        LLM_ORACLE_SQL["pipeline"] = corpus_pipeline.ORACLE_SQL

DECIMALS = 6
FLAG_CODES = {"A": "AA", "N": "NN"}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _hundredths(name: str) -> Column:
    return F.rint(F.col(name) * 100)


def _shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias(COUNTRY),
        F.col("l_shipdate").alias(EVENT_TIME),
        _hundredths("l_extendedprice").alias("CarbonDirect"),
        _hundredths("l_discount").alias("CFEpercent"),
    )


def _events(spark: SparkSession, sf_dir: str, *others: str) -> DataFrame:
    return _table(spark, sf_dir, "events").select(
        F.col("event_type").alias(COUNTRY),
        F.col("ts").alias(EVENT_TIME),
        _hundredths("value").alias("CarbonDirect"),
        F.get_json_object("props", "$.k").try_cast("double").alias("CFEpercent"),
        *others,
    )


_STAGED: dict[tuple, str] = {}


def _staged(spark: SparkSession, name: str, sf_dir: str, write: Callable[[str], None]) -> str:
    """A copy that several queries read, written once per application and folder of tables."""
    key = (spark.sparkContext.applicationId, name, sf_dir)
    if key not in _STAGED:
        path = new_folder(spark, name)
        write(path)
        _STAGED[key] = path
    return _STAGED[key]


def _shipment_files(spark: SparkSession, sf_dir: str, fmt: str, by_country: bool = False) -> str:
    """The stand-in energy table, written with text times as the real input comes."""
    table = to_energy_table(_shipments(spark, sf_dir))
    name = f"shipments-{fmt}" + "-by-country" * by_country
    return _staged(spark, name, sf_dir, lambda path: write_energy(table, path, fmt, by_country))


def _quartiles_rounded(summary: DataFrame) -> DataFrame:
    marks = [name for name in summary.columns if name.startswith("perc_")]
    return summary.withColumns({name: F.round(name, DECIMALS) for name in marks})


# Yearly statistics


def yearly_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.yearly_stats(_shipments(spark, sf_dir))


def yearly_stats_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_energy(_shipments(spark, sf_dir), "shipment_data")
    return plans.yearly_stats_sql(spark, "shipment_data")


def yearly_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.yearly_fold(_shipments(spark, sf_dir))


def yearly_fold_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accumulators of an earlier and a later load, combined."""
    rows = with_parts(_shipments(spark, sf_dir), "year")
    early = F.col(EVENT_TIME) < F.lit("1998-07-01").cast("timestamp_ntz")
    rows = rows.withColumn("load", F.when(early, F.lit("earlier")).otherwise(F.lit("later")))
    loads = fold(rows, ["load", *YEARLY_KEYS]).drop("load")
    return finish_fold(merge_folds(loads, keys=YEARLY_KEYS), YEARLY_KEYS)


def yearly_fold_replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loads stored by id; one is sent spoiled and then right, one twice, and all are compacted in between."""
    rows = with_parts(_shipments(spark, sf_dir), "year")
    early = F.col(EVENT_TIME) < F.lit("1996-01-01").cast("timestamp_ntz")
    store = FoldStore.like(rows, new_folder(spark, "loads"), YEARLY_KEYS)
    store.send("earlier", fold(rows, YEARLY_KEYS))
    store.send("later", fold(rows.where(~early), YEARLY_KEYS))
    store.compact()
    store.send("earlier", fold(rows.where(early), YEARLY_KEYS))
    store.send("later", fold(rows.where(~early), YEARLY_KEYS))
    return finish_fold(store.merged(), YEARLY_KEYS)


# Monthly means and rankings


def _monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.monthly_means(of_country(_shipments(spark, sf_dir), "A"))


def monthly_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _monthly(spark, sf_dir)


def monthly_means_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_energy(of_country(_shipments(spark, sf_dir), "A"), "shipment_one")
    return plans.monthly_means_sql(spark, "shipment_one")


def monthly_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.monthly_fold(of_country(_shipments(spark, sf_dir), "A"))


def monthly_timeseries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.monthly_timeseries(_monthly(spark, sf_dir))


def _ranking(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: rankings(_monthly(spark, sf_dir))[name]


def top5_price_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_energy(monthly_means_sql(spark, sf_dir), "shipment_months")
    return plans.rankings_sql(spark, "shipment_months")["carbon_intensity_desc"]


def board(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking_board(_monthly(spark, sf_dir))


def board_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_energy(monthly_means_sql(spark, sf_dir), "shipment_months")
    return plans.ranking_board_sql(spark, "shipment_months")


def ranking_board_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rankings of every country at once."""
    rows = with_parts(_shipments(spark, sf_dir), "year", "month")
    return rankings_by(period_means(rows, [COUNTRY, YEAR, MONTH]), [COUNTRY])


def rankings_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four rankings, written to a folder each and read back."""
    with materialised(monthly_means_sql(spark, sf_dir)) as (monthly, _):
        folder = new_folder(spark, "rankings")
        paths = write_outputs(rankings(monthly), folder, True, ranking_orders())
    schema = (
        f"{YEAR} int, {MONTH} int, avg_carbon_intensity double, avg_cfe_percentage double"
    )
    return union_sources(
        *(
            spark.read.csv(path, schema, header=True).select(F.lit(name).alias("ranking"), "*")
            for name, path in paths.items()
        )
    )


# Day profiles and five-number summaries


def _profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.hourly_profile(_events(spark, sf_dir))


def hourly_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _profile(spark, sf_dir).orderBy(*HOURLY_KEYS)


def hourly_profile_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_energy(_events(spark, sf_dir), "event_data")
    return plans.hourly_profile_sql(spark, "event_data")


def hourly_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.hourly_fold(_events(spark, sf_dir))


def _summary(method: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: _quartiles_rounded(
        plans.hourly_summary(_profile(spark, sf_dir), method=method)
    )


def five_number_sorted_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _quartiles_rounded(
        five_number(plans.hourly_fold(_events(spark, sf_dir)), method="exact")
    )


def five_number_exact_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_energy(_events(spark, sf_dir), "event_data")
    return _quartiles_rounded(plans.hourly_summary_sql(spark, "event_data"))


def row_quartiles_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact quartiles of the measurements themselves, per country and metric."""
    return _quartiles_rounded(row_five_number(_shipments(spark, sf_dir)))


def quartiles_from_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quartiles merged from the stored sketches of a load a year, and whether their ranks keep the bound.

    Only that check reads rows: the share of rows below a quartile, and at most equal to it.
    """
    rows = with_parts(_shipments(spark, sf_dir), "year")
    loads = fold(rows, [YEAR, COUNTRY], sketch_size=SKETCH_SIZE)
    store = FoldStore(spark, new_folder(spark, "sketches"), [COUNTRY], loads.drop(YEAR).schema)
    store.send_many(loads, YEAR)
    summary = sketched_quartiles(store.merged(), [COUNTRY])
    held = null_safe_join(rows, summary, [COUNTRY])
    shares = []
    for metric in METRICS:
        for p in QUARTILES:
            mark, value = F.col(f"perc_{round(100 * p)}_{metric.name}"), F.col(metric.column)
            below, upto = F.avg((value < mark).cast("double")), F.avg((value <= mark).cast("double"))
            kept = (below - rank_error() <= p) & (p <= upto + rank_error())
            shares.append(kept.alias(f"within_{round(100 * p)}_{metric.name}"))
    exact = [f"{stem}_{metric.name}" for metric in METRICS for stem in ("n", "min", "max")]
    return held.groupBy(COUNTRY, *exact).agg(*shares)


def sorted_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every price of a country with its hours, its rank, and whether it stands in the middle of all hours."""
    places = value_positions(_shipments(spark, sf_dir), [COUNTRY], "CarbonDirect")
    first, size = F.col("first_position"), F.col("group_size")
    middle = [F.floor((size - 1) / 2), F.ceil((size - 1) / 2)]
    in_middle = [(first <= at) & (at < first + F.col("n")) for at in middle]
    return places.select(
        COUNTRY,
        F.col("CarbonDirect").alias("price"),
        F.col("n").alias("hours"),
        (first + 1).alias("price_rank"),
        (in_middle[0] | in_middle[1]).alias("in_middle"),
    )


def row_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every shipment with its place by price among those of its return flag."""
    names = ["l_orderkey", "l_linenumber"]
    rows = _table(spark, sf_dir, "lineitem").select(*names, "l_returnflag", "l_extendedprice")
    placed = with_positions(rows, [F.col("l_extendedprice").desc(), *names], ["l_returnflag"])
    return placed.select(*names, "position", "group_size")


def wide_to_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_long(_profile(spark, sf_dir))


# Times, labels, filters


def parse_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times as text, some spoiled: parsed where possible, counted by year, month and hour."""
    events = _table(spark, sf_dir, "events")
    text = time_text(F.col("ts"))
    spoiled = (
        F.when(F.col("event_type") == "error", F.concat(text, F.lit("Z")))
        .when(F.col("event_type") == "view", F.replace(text, F.lit(" "), F.lit("T")))
        .otherwise(text)
    )
    rows = with_event_time(events.select("event_type", spoiled.alias(EVENT_TIME)))
    return (
        with_parts(rows, "year", "month", "hour")
        .groupBy("event_type", YEAR, MONTH, HOUR)
        .agg(F.count("*").alias("events"), F.max(EVENT_TIME).alias("last_time"))
    )


def written_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Year, month and hour as written in the time text, counted."""
    fields = _table(spark, sf_dir, "events").select(time_fields(time_text(F.col("ts"))).alias("f"))
    parts = [F.get("f", F.lit(i)).alias(name) for i, name in ((0, YEAR), (1, MONTH), (3, HOUR))]
    return fields.select(*parts).groupBy(YEAR, MONTH, HOUR).agg(F.count("*").alias("events"))


def country_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = _table(spark, sf_dir, "events").select(
        F.col("event_type").alias(COUNTRY),
        F.col("ts").alias(EVENT_TIME),
        F.col("value").alias("CarbonDirect"),
        F.get_json_object("props", "$.k").try_cast("double").alias("CFEpercent"),
    )
    return of_country(stored, "click")


def canonical_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = _table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias(COUNTRY), F.col("l_extendedprice").alias("CarbonDirect")
    )
    rows = canonical_country(stored, FLAG_CODES)
    return rows.groupBy(COUNTRY).agg(
        F.count("*").alias("hours"), F.max("CarbonDirect").alias("max_carbon_intensity")
    )


# Files


def parse_text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw lines of CSV files, split and cast by column expressions, then folded."""
    lines = read_lines(spark, _shipment_files(spark, sf_dir, "csv"), header=CSV_HEADER)
    rows = with_parts(parse_lines(lines), "year", "month", "hour")
    return fold(rows, [COUNTRY, YEAR, MONTH, HOUR])


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = _shipment_files(spark, sf_dir, "csv")
    return plans.yearly_stats(read_energy(spark, files, "csv"))


def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = _shipment_files(spark, sf_dir, "parquet")
    return plans.yearly_stats(read_energy(spark, files, "parquet"))


def typed_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A copy whose times are parsed once, at ingest."""
    path = new_folder(spark, "shipments-typed")
    write_energy(to_energy_table(_shipments(spark, sf_dir)), path, typed=True)
    return plans.yearly_stats(read_energy(spark, path, typed=True))


def renamed_raw_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as text under other column names, with times in another format, ingested and profiled by hour."""
    rows = to_energy_table(_events(spark, sf_dir))
    raw = rows.select(
        F.col(COUNTRY).alias("zone"),
        F.regexp_replace(EVENT_TIME, r"^(\d+)-(\d+)-(\d+) ", "$3.$2.$1 at ").alias("stamp"),
        F.col("CarbonDirect").cast("string").alias("co2"),
        F.col("CFEpercent").cast("string").alias("share"),
    )
    names = {COUNTRY: "zone", EVENT_TIME: "stamp", "CarbonDirect": "co2", "CFEpercent": "share"}
    return plans.hourly_profile(to_energy_table(raw, names, "dd.MM.yyyy 'at' HH:mm:ss"))


def both_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The input written in both formats; rows and latest time of each copy."""
    raw = to_energy_table(_shipments(spark, sf_dir))
    paths = write_both_formats(raw, new_folder(spark, "both"))
    copies = [
        with_event_time(read_energy(spark, path, fmt)).select(F.lit(fmt).alias("format"), "*")
        for fmt, path in paths.items()
    ]
    return (
        union_sources(*copies)
        .groupBy("format", COUNTRY)
        .agg(F.count("*").alias("hours"), F.max(EVENT_TIME).alias("last_time"))
    )


def country_file_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One folder per country, found and read from their common folder."""
    path = _shipment_files(spark, sf_dir, "csv", by_country=True)
    return plans.yearly_stats(read_countries(spark, path, "csv"))


def monthly_country_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The monthly question for one country, from its folder alone."""
    path = _shipment_files(spark, sf_dir, "csv", by_country=True)
    return plans.monthly_means(with_event_time(read_countries(spark, path, "csv", country="A")))


def country_skip_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The monthly question for one country, from a layout whose row groups a scan can pass over."""
    path = new_folder(spark, "clustered")
    write_clustered(to_energy_table(_shipments(spark, sf_dir)), path)
    return plans.monthly_means(read_clustered(spark, path, country="A"))


def ingest_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spoiled events ingested: rows, and rejected fields by column and reason, as observed and as written."""
    rows = to_energy_table(_events(spark, sf_dir, "event_id"), keep=["event_id"])
    turn = F.col("event_id") % 100
    spoiled = rows.select(
        F.when(turn == 1, F.lit("  ")).otherwise(F.col(COUNTRY)).alias("zone"),
        F.when(turn == 2, F.concat(EVENT_TIME, F.lit("Z")))
        .when(turn == 3, F.lit(None))
        .when(turn == 4, F.lit("2021-02-30 00:00:00"))
        .otherwise(F.col(EVENT_TIME))
        .alias("stamp"),
        F.when(turn.isin(4, 5), F.concat(F.col("CarbonDirect").cast("string"), F.lit(" g")))
        .when(turn == 6, F.lit(""))
        .otherwise(F.col("CarbonDirect").cast("string"))
        .alias("co2"),
        F.when(turn == 7, F.lit("n/a")).otherwise(F.col("CFEpercent").cast("string")).alias("share"),
    )
    names = {COUNTRY: "zone", EVENT_TIME: "stamp", "CarbonDirect": "co2", "CFEpercent": "share"}
    path = new_folder(spark, "ingest")
    report = ingest_checked(spoiled, path, names)
    told = [("observed", *pair, n) for pair, n in report.counts.items() if n]
    told += [("observed", "all", "accepted", report.accepted), ("observed", "all", "rejected", report.rejected)]
    observed = spark.createDataFrame(told, "seen string, field string, reason string, n long")
    fields = read_quarantine(spark, path).select(F.col("column").alias("field"), "reason")
    kept = read_accepted(spark, path).select(F.lit("all").alias("field"), F.lit("accepted").alias("reason"))
    written = union_sources(fields, kept).groupBy("field", "reason").agg(F.count("*").alias("n"))
    return union_sources(observed, written.select(F.lit("written").alias("seen"), "field", "reason", "n"))


def result_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly statistics written as one sorted CSV file under other column names, read back."""
    path = new_folder(spark, "yearly")
    stats = yearly_stats(spark, sf_dir)
    names = ["country", "year", *stats.columns[2:]]
    write_csv(stats, path, single_file=True, order_by=names[:2], column_names=names)
    schema = ", ".join(f"{name} double" for name in names[2:])
    return spark.read.csv(path, f"country string, year int, {schema}", header=True)


def _event_files(spark: SparkSession, sf_dir: str, fmt: str) -> str:
    table = to_energy_table(_events(spark, sf_dir))
    return _staged(spark, f"events-{fmt}", sf_dir, lambda path: write_energy(table, path, fmt))


def yearly_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From CSV lines to the result file, read back."""
    source = _shipment_files(spark, sf_dir, "csv")
    paths = jobs.run(spark, 8, source, new_folder(spark, "yearly-job"))
    columns = yearly_stats(spark, sf_dir).schema
    return spark.read.csv(paths["stats"], columns, header=True)


def monthly_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From CSV files of many countries to the time series of one, read back."""
    source = _shipment_files(spark, sf_dir, "csv")
    paths = jobs.run(spark, 12, source, new_folder(spark, "monthly-job"), country="A")
    columns = _monthly(spark, sf_dir).schema
    reader = spark.read.schema(columns).option("timestampNTZFormat", TIME_OUTPUT)
    return reader.csv(paths["timeseries"], header=True)


def hourly_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From Parquet files to both result files of the hourly question; the summary, read back."""
    source = _event_files(spark, sf_dir, "parquet")
    paths = jobs.run(spark, 4, source, new_folder(spark, "hourly-job"))
    columns = plans.hourly_summary(_profile(spark, sf_dir)).schema
    return _quartiles_rounded(spark.read.csv(paths["summary"], columns, header=True))


def hourly_profile_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From CSV files to the result files of the approximate form; the day profile, read back."""
    source = _event_files(spark, sf_dir, "csv")
    paths = jobs.run(spark, 13, source, new_folder(spark, "profile-job"))
    columns = _profile(spark, sf_dir).schema
    reader = spark.read.schema(columns).option("timestampNTZFormat", TIME_OUTPUT)
    return reader.csv(paths["hourly"], header=True)


def yearly_sql_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The SQL form of the yearly question, from Parquet files to the result file, read back."""
    source = _shipment_files(spark, sf_dir, "parquet")
    paths = jobs.run(spark, 5, source, new_folder(spark, "yearly-sql-job"))
    return spark.read.csv(paths["stats"], yearly_stats(spark, sf_dir).schema, header=True)


def monthly_sql_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The SQL form of the monthly question; the months of the highest price, read back."""
    source = _shipment_files(spark, sf_dir, "parquet")
    paths = jobs.run(spark, 6, source, new_folder(spark, "monthly-sql-job"), country="A")
    columns = top5_price_sql(spark, sf_dir).schema
    return spark.read.csv(paths["carbon_intensity_desc"], columns, header=True)


def hourly_sql_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The SQL form of the hourly question; the summary, read back."""
    source = _event_files(spark, sf_dir, "parquet")
    paths = jobs.run(spark, 7, source, new_folder(spark, "hourly-sql-job"))
    columns = five_number_exact_sql(spark, sf_dir).schema
    return _quartiles_rounded(spark.read.csv(paths["summary"], columns, header=True))


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The longest time of each query, appended as one batch and read back."""
    path = new_folder(spark, "runs")
    longest = _runs(spark, sf_dir).groupBy("query").agg(F.max("tempo_totale").alias("longest"))
    workers, seconds = F.col("query") + 1, F.col("longest") / 7
    append_runs(longest.select("query", workers.alias("workers_number"), seconds.alias("tempo_totale")), path)
    return read_runs(spark, path)


def key_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As decimals, because engines write doubles in different notations."""
    stats = yearly_stats(spark, sf_dir)
    decimals = [F.col(name).cast("decimal(18, 4)").alias(name) for name in stats.columns[2:]]
    return to_key_json(stats.select(*YEARLY_KEYS, *decimals), YEARLY_KEYS, prefix="yearly")


def _export(rows: DataFrame) -> DataFrame:
    stats = plans.yearly_stats(rows)
    decimals = [F.col(name).cast("decimal(18, 4)").alias(name) for name in stats.columns[2:]]
    return to_key_json(stats.select(*YEARLY_KEYS, *decimals), YEARLY_KEYS, prefix="yearly")


def json_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From an export of the years up to 1997 to one of the years from 1994 on, in which 1996 was corrected."""
    rows = _shipments(spark, sf_dir)
    year = F.year(EVENT_TIME)
    before = _export(rows.where(year <= 1997))
    corrected = (year != 1996) | (F.col("CFEpercent") <= 5)
    return key_json_changes(key_digests(before), _export(rows.where((year >= 1994) & corrected)))


# Run times


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events").select(
        (F.col("user_id") % 17 + 1).cast("int").alias("query"),
        (F.col("user_id") % 4 + 1).cast("int").alias("workers_number"),
        _hundredths("value").alias("tempo_totale"),
    )


def run_time_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_means(_runs(spark, sf_dir))


def run_time_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_comparison(_runs(spark, sf_dir))


def entry(spark: SparkSession) -> DataFrame:
    """Yearly statistics at the smallest scale."""
    return yearly_stats(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "yearly_stats": yearly_stats,
        "yearly_stats_sql": yearly_stats_sql,
        "yearly_fold": yearly_fold,
        "yearly_fold_merged": yearly_fold_merged,
        "yearly_fold_replayed": yearly_fold_replayed,
        "monthly_means": monthly_means,
        "monthly_means_sql": monthly_means_sql,
        "monthly_fold": monthly_fold,
        "monthly_timeseries": monthly_timeseries,
        "top5_price": _ranking("carbon_intensity_desc"),
        "bottom5_price": _ranking("carbon_intensity_asc"),
        "top5_discount": _ranking("cfe_percentage_desc"),
        "bottom5_discount": _ranking("cfe_percentage_asc"),
        "top5_price_sql": top5_price_sql,
        "ranking_board": board,
        "ranking_board_sql": board_sql,
        "ranking_board_all": ranking_board_all,
        "rankings_written": rankings_written,
        "hourly_profile": hourly_profile,
        "hourly_profile_sql": hourly_profile_sql,
        "hourly_fold": hourly_fold,
        "five_number_exact": _summary("exact"),
        "five_number_exact_sql": five_number_exact_sql,
        "five_number_sorted_list": five_number_sorted_list,
        "five_number_approx": _summary("approx"),
        "row_quartiles_exact": row_quartiles_exact,
        "quartiles_from_loads": quartiles_from_loads,
        "sorted_positions": sorted_positions,
        "row_positions": row_positions,
        "wide_to_long": wide_to_long,
        "parse_event_time": parse_event_time,
        "time_fields": written_fields,
        "country_filter": country_filter,
        "canonical_labels": canonical_labels,
        "parse_lines": parse_text_lines,
        "csv_roundtrip": csv_roundtrip,
        "parquet_roundtrip": parquet_roundtrip,
        "typed_roundtrip": typed_roundtrip,
        "renamed_raw_table": renamed_raw_table,
        "both_formats": both_formats,
        "country_file_scan": country_file_scan,
        "monthly_country_files": monthly_country_files,
        "country_skip_scan": country_skip_scan,
        "ingest_rejects": ingest_rejects,
        "result_file": result_file,
        "yearly_job": yearly_job,
        "monthly_job": monthly_job,
        "hourly_job": hourly_job,
        "hourly_profile_job": hourly_profile_job,
        "yearly_sql_job": yearly_sql_job,
        "monthly_sql_job": monthly_sql_job,
        "hourly_sql_job": hourly_sql_job,
        "run_log": run_log,
        "key_json": key_json,
        "key_json_changes": json_changes,
        "run_means": run_time_means,
        "run_comparison": run_time_comparison,
        **LLM_QUERIES,
    }


# The same questions in SQL

_SHIPMENTS = """
(SELECT l_returnflag, l_shipdate, round(l_extendedprice * 100) AS price,
        round(l_discount * 100) AS discount
 FROM lineitem)
"""

_YEARLY = f"""
SELECT l_returnflag AS Country, CAST(year(l_shipdate) AS INTEGER) AS record_year,
       avg(price) AS avg_carbon_intensity,
       min(price) AS min_carbon_intensity,
       max(price) AS max_carbon_intensity,
       avg(discount) AS avg_cfe_percentage,
       min(discount) AS min_cfe_percentage,
       max(discount) AS max_cfe_percentage
FROM {_SHIPMENTS}
GROUP BY ALL
"""

_MONTHLY = f"""
SELECT CAST(year(l_shipdate) AS INTEGER) AS record_year,
       CAST(month(l_shipdate) AS INTEGER) AS record_month,
       avg(price) AS avg_carbon_intensity,
       avg(discount) AS avg_cfe_percentage
       {{first}}
FROM {_SHIPMENTS}
WHERE l_returnflag = 'A'
GROUP BY year(l_shipdate), month(l_shipdate)
"""
_MONTHLY_PLAIN = _MONTHLY.format(first="")
_MONTHLY_TIMED = _MONTHLY.format(first=", min(l_shipdate) AS month_timestamp")

_EVENTS = """
SELECT event_type AS Country, date_trunc('second', ts) AS event_time,
       round(value * 100) AS carbon,
       TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS cfe
FROM events
"""

_PROFILE = f"""
SELECT Country, CAST(hour(event_time) AS INTEGER) AS record_hour,
       avg(carbon) AS avg_hour_carbon_intensity, avg(cfe) AS avg_hour_cfe_percentage,
       CAST(min(event_time) AS TIMESTAMP) AS hour_timestamp
FROM ({_EVENTS})
GROUP BY Country, hour(event_time)
"""

_PROFILE_UNTIMED = f"SELECT * EXCLUDE (hour_timestamp) FROM ({_PROFILE})"

_LONG = f"""
SELECT Country, record_hour, 'carbon-intensity' AS data, avg_hour_carbon_intensity AS value
FROM ({_PROFILE})
UNION ALL
SELECT Country, record_hour, 'cfe' AS data, avg_hour_cfe_percentage AS value
FROM ({_PROFILE})
"""

_SUMMARY = """
SELECT Country, data, min(value) AS min,
       round({quantile}(value, 0.25), 6) AS perc_25,
       round({quantile}(value, 0.5), 6) AS perc_50,
       round({quantile}(value, 0.75), 6) AS perc_75,
       max(value) AS max
FROM ({long})
GROUP BY Country, data
"""
_SUMMARY_EXACT = _SUMMARY.format(quantile="quantile_cont", long=_LONG)
_SUMMARY_ELEMENT = _SUMMARY.format(quantile="quantile_disc", long=_LONG)

_RUNS = """
SELECT CAST(user_id % 17 + 1 AS INTEGER) AS query,
       CAST(user_id % 4 + 1 AS INTEGER) AS workers_number,
       round(value * 100) AS t
FROM events
"""


def _ranked(monthly: str, metric: str, way: str) -> str:
    return f"""
SELECT * FROM ({monthly})
ORDER BY avg_{metric} {way} NULLS LAST, record_year, record_month LIMIT 5
"""


def _ranked_all(monthly: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{metric}_{way}' AS ranking, * FROM ({_ranked(monthly, metric, way)})"
        for metric in ("carbon_intensity", "cfe_percentage")
        for way in ("desc", "asc")
    )


# The names of the runs.
_RUN_NAMES = """
    (1, 'Query_1_DF_Parquet'),
    (2, 'Query_2_DF_Parquet'),
    (3, 'Query_3_DF_Approx_Parquet'),
    (4, 'Query_3_DF_Exact_Parquet'),
    (5, 'Query_1_SQL_Parquet'),
    (6, 'Query_2_SQL_Parquet'),
    (7, 'Query_3_SQL_Parquet'),
    (8, 'Query_1_RDD'),
    (9, 'Query_2_RDD'),
    (10, 'Query_3_RDD'),
    (11, 'Query_1_DF_CSV'),
    (12, 'Query_2_DF_CSV'),
    (13, 'Query_3_DF_Approx_CSV'),
    (14, 'Query_3_DF_Exact_CSV'),
    (15, 'Query_1_SQL_CSV'),
    (16, 'Query_2_SQL_CSV'),
    (17, 'Query_3_SQL_CSV')
"""


_CORRECTED = f"(SELECT * FROM {_SHIPMENTS} WHERE year(l_shipdate) <> 1996 OR discount <= 5)"

_LONG_ROWS = f"""
SELECT l_returnflag AS Country, 'carbon-intensity' AS data, price AS value FROM {_SHIPMENTS}
UNION ALL
SELECT l_returnflag AS Country, 'cfe' AS data, discount AS value FROM {_SHIPMENTS}
"""

_MONTHLY_ALL = f"""
SELECT l_returnflag AS Country, CAST(year(l_shipdate) AS INTEGER) AS record_year,
       CAST(month(l_shipdate) AS INTEGER) AS record_month,
       avg(price) AS avg_carbon_intensity, avg(discount) AS avg_cfe_percentage
FROM {_SHIPMENTS}
GROUP BY ALL
"""
_RANKED_BY_COUNTRY = " UNION ALL ".join(
    f"""
SELECT '{metric}_{way}' AS ranking, *, CAST(row_number() OVER (
         PARTITION BY Country ORDER BY avg_{metric} {way} NULLS LAST, record_year, record_month
       ) AS INTEGER) AS place
FROM ({_MONTHLY_ALL}) QUALIFY place <= 5
"""
    for metric in ("carbon_intensity", "cfe_percentage")
    for way in ("desc", "asc")
)

# Which events the query spoils, by the last two digits of their number.
_REJECTS = """
WITH spoiled AS (SELECT event_id % 100 AS turn FROM events),
fields AS (
  SELECT 'Country' AS field, 'missing' AS reason FROM spoiled WHERE turn = 1
  UNION ALL SELECT 'event_time', 'unreadable' FROM spoiled WHERE turn IN (2, 4)
  UNION ALL SELECT 'event_time', 'missing' FROM spoiled WHERE turn = 3
  UNION ALL SELECT 'CarbonDirect', 'unreadable' FROM spoiled WHERE turn IN (4, 5)
  UNION ALL SELECT 'CFEpercent', 'unreadable' FROM spoiled WHERE turn = 7
  UNION ALL SELECT 'all', 'accepted' FROM spoiled WHERE turn NOT IN (1, 2, 3, 4, 5, 7)
),
counted AS (SELECT field, reason, count(*) AS n FROM fields GROUP BY ALL)
SELECT 'written' AS seen, * FROM counted
UNION ALL SELECT 'observed', * FROM counted
UNION ALL SELECT 'observed', 'all', 'rejected', count(*) FROM spoiled WHERE turn IN (1, 2, 3, 4, 5, 7)
"""


def _key_json(yearly: str, only: str = "true") -> str:
    return f"""
SELECT 'yearly:' || Country || ':' || record_year AS key,
       CAST(to_json({{
                     'avg_carbon_intensity': CAST(avg_carbon_intensity AS DECIMAL(18, 4)),
                     'min_carbon_intensity': CAST(min_carbon_intensity AS DECIMAL(18, 4)),
                     'max_carbon_intensity': CAST(max_carbon_intensity AS DECIMAL(18, 4)),
                     'avg_cfe_percentage': CAST(avg_cfe_percentage AS DECIMAL(18, 4)),
                     'min_cfe_percentage': CAST(min_cfe_percentage AS DECIMAL(18, 4)),
                     'max_cfe_percentage': CAST(max_cfe_percentage AS DECIMAL(18, 4))
       }}) AS VARCHAR) AS value
FROM ({yearly}) WHERE {only}
"""


def oracle_sql() -> dict[str, str]:
    return {
        "yearly_stats": _YEARLY,
        "yearly_stats_sql": _YEARLY,
        "yearly_fold": _YEARLY,
        "yearly_fold_merged": _YEARLY,
        "yearly_fold_replayed": _YEARLY,
        "monthly_means": _MONTHLY_TIMED,
        "monthly_means_sql": _MONTHLY_PLAIN,
        "monthly_fold": _MONTHLY_PLAIN,
        "monthly_timeseries": _MONTHLY_TIMED,
        "top5_price": _ranked(_MONTHLY_TIMED, "carbon_intensity", "desc"),
        "bottom5_price": _ranked(_MONTHLY_TIMED, "carbon_intensity", "asc"),
        "top5_discount": _ranked(_MONTHLY_TIMED, "cfe_percentage", "desc"),
        "bottom5_discount": _ranked(_MONTHLY_TIMED, "cfe_percentage", "asc"),
        "top5_price_sql": _ranked(_MONTHLY_PLAIN, "carbon_intensity", "desc"),
        "ranking_board": _ranked_all(_MONTHLY_TIMED),
        "ranking_board_sql": _ranked_all(_MONTHLY_PLAIN),
        "ranking_board_all": _RANKED_BY_COUNTRY,
        "rankings_written": _ranked_all(_MONTHLY_PLAIN),
        "hourly_profile": _PROFILE.replace("date_trunc('second', ts)", "ts"),
        "hourly_profile_sql": _PROFILE_UNTIMED,
        "hourly_fold": _PROFILE_UNTIMED,
        "five_number_exact": _SUMMARY_EXACT,
        "five_number_exact_sql": _SUMMARY_EXACT,
        "five_number_sorted_list": _SUMMARY_EXACT,
        "five_number_approx": _SUMMARY_ELEMENT,
        "row_quartiles_exact": _SUMMARY.format(quantile="quantile_cont", long=_LONG_ROWS),
        "quartiles_from_loads": f"""
SELECT l_returnflag AS Country,
       count(price) AS n_carbon_intensity, min(price) AS min_carbon_intensity,
       max(price) AS max_carbon_intensity,
       count(discount) AS n_cfe_percentage, min(discount) AS min_cfe_percentage,
       max(discount) AS max_cfe_percentage,
       true AS within_25_carbon_intensity, true AS within_50_carbon_intensity,
       true AS within_75_carbon_intensity, true AS within_25_cfe_percentage,
       true AS within_50_cfe_percentage, true AS within_75_cfe_percentage
FROM {_SHIPMENTS} GROUP BY 1
""",
        "sorted_positions": f"""
WITH counted AS (
  SELECT l_returnflag AS Country, price, count(*) AS hours FROM {_SHIPMENTS} GROUP BY ALL
), placed AS (
  SELECT *, CAST(sum(hours) OVER w - hours AS BIGINT) AS first,
         sum(hours) OVER (PARTITION BY Country) AS total
  FROM counted WINDOW w AS (PARTITION BY Country ORDER BY price)
)
SELECT Country, price, hours, first + 1 AS price_rank,
       (first <= (total - 1) // 2 AND (total - 1) // 2 < first + hours)
       OR (first <= total // 2 AND total // 2 < first + hours) AS in_middle
FROM placed
""",
        "row_positions": """
SELECT l_orderkey, l_linenumber, row_number() OVER w - 1 AS position,
       count(*) OVER (PARTITION BY l_returnflag) AS group_size
FROM lineitem
WINDOW w AS (PARTITION BY l_returnflag ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber)
""",
        "wide_to_long": _LONG,
        "parse_event_time": """
WITH texts AS (
  SELECT event_type,
         CASE event_type
           WHEN 'error' THEN strftime(ts, '%Y-%m-%d %H:%M:%S') || 'Z'
           WHEN 'view' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
           ELSE strftime(ts, '%Y-%m-%d %H:%M:%S')
         END AS text
  FROM events
),
times AS (SELECT event_type, try_strptime(text, '%Y-%m-%d %H:%M:%S') AS t FROM texts)
SELECT event_type, CAST(year(t) AS INTEGER) AS record_year,
       CAST(month(t) AS INTEGER) AS record_month, CAST(hour(t) AS INTEGER) AS record_hour,
       count(*) AS events, max(t) AS last_time
FROM times
GROUP BY event_type, year(t), month(t), hour(t)
""",
        "time_fields": """
SELECT CAST(year(ts) AS INTEGER) AS record_year, CAST(month(ts) AS INTEGER) AS record_month,
       CAST(hour(ts) AS INTEGER) AS record_hour, count(*) AS events
FROM events
GROUP BY 1, 2, 3
""",
        "country_filter": """
SELECT event_type AS Country, ts AS event_time, value AS "CarbonDirect",
       TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS "CFEpercent"
FROM events
WHERE event_type = 'click'
""",
        "canonical_labels": f"""
SELECT CASE l_returnflag WHEN 'A' THEN 'AA' WHEN 'N' THEN 'NN' ELSE l_returnflag END AS Country,
       count(*) AS hours, max(l_extendedprice) AS max_carbon_intensity
FROM lineitem
GROUP BY 1
""",
        "parse_lines": f"""
SELECT l_returnflag AS Country, CAST(year(l_shipdate) AS INTEGER) AS record_year,
       CAST(month(l_shipdate) AS INTEGER) AS record_month,
       CAST(hour(l_shipdate) AS INTEGER) AS record_hour,
       sum(price) AS sum_carbon_intensity,
       count(price) AS count_carbon_intensity,
       min(price) AS min_carbon_intensity,
       max(price) AS max_carbon_intensity,
       sum(discount) AS sum_cfe_percentage,
       count(discount) AS count_cfe_percentage,
       min(discount) AS min_cfe_percentage,
       max(discount) AS max_cfe_percentage
FROM {_SHIPMENTS}
GROUP BY 1, 2, 3, 4
""",
        "csv_roundtrip": _YEARLY,
        "parquet_roundtrip": _YEARLY,
        "typed_roundtrip": _YEARLY,
        "renamed_raw_table": _PROFILE,
        "both_formats": f"""
SELECT format, l_returnflag AS Country, count(*) AS hours, max(l_shipdate) AS last_time
FROM {_SHIPMENTS} CROSS JOIN (VALUES ('parquet'), ('csv')) AS formats(format)
GROUP BY format, l_returnflag
""",
        "country_file_scan": _YEARLY,
        "monthly_country_files": _MONTHLY_TIMED,
        "country_skip_scan": _MONTHLY_TIMED,
        "ingest_rejects": _REJECTS,
        "result_file": f"""
SELECT * RENAME (Country AS country, record_year AS year) FROM ({_YEARLY})
""",
        "yearly_job": _YEARLY,
        "monthly_job": _MONTHLY_TIMED,
        "hourly_job": _SUMMARY_EXACT,
        "hourly_profile_job": _PROFILE,
        "yearly_sql_job": _YEARLY,
        "monthly_sql_job": _ranked(_MONTHLY_PLAIN, "carbon_intensity", "desc"),
        "hourly_sql_job": _SUMMARY_EXACT,
        "run_log": f"""
SELECT query, query + 1 AS workers_number, round(max(t) / 7, 6) AS tempo_totale
FROM ({_RUNS}) GROUP BY query
""",
        "key_json": _key_json(_YEARLY),
        "key_json_changes": f"""
SELECT key, CASE WHEN old.value IS NULL THEN 'added' WHEN new.value IS NULL THEN 'dropped'
                 ELSE 'changed' END AS change, new.value AS value
FROM ({_key_json(_YEARLY, "record_year <= 1997")}) AS old
FULL JOIN ({_key_json(_YEARLY.replace(_SHIPMENTS, _CORRECTED), "record_year >= 1994")}) AS new
USING (key)
WHERE old.value IS DISTINCT FROM new.value
""",
        "run_means": f"""
SELECT query, query_name, workers_number, avg(t) AS tempo_totale
FROM ({_RUNS}) LEFT JOIN (VALUES {_RUN_NAMES}) AS names(query, query_name) USING (query)
GROUP BY query, query_name, workers_number
""",
        "run_comparison": f"""
WITH means AS (
  SELECT avg(t) FILTER (query IN (1, 2, 3, 4, 5, 6, 7)) AS parquet_avg,
         avg(t) FILTER (query IN (11, 12, 13, 14, 15, 16, 17)) AS csv_avg,
         avg(t) FILTER (query IN (1, 2, 3, 4, 11, 12, 13, 14)) AS dataframe_avg,
         avg(t) FILTER (query IN (5, 6, 7, 15, 16, 17)) AS sql_avg,
         avg(t) FILTER (query IN (8, 9, 10)) AS lines_avg
  FROM ({_RUNS})
)
SELECT *, (csv_avg - parquet_avg) / parquet_avg * 100 AS csv_over_parquet_percent FROM means
""",
        **LLM_ORACLE_SQL,
    }
