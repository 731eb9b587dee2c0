"""What the physical plans have to look like for the queries to hold at scale."""

import contextlib
import io
import re

import pytest

import __spark_entry__ as contract
from gridmetrics import plans
from gridmetrics.functions import of_country, with_event_time
from gridmetrics.operators import ranking_board, top_k
from gridmetrics.sources import read_energy, register_energy, write_energy

SF_DIR = "/root/testdata/sf0.001"


def _plan(frame, mode="simple"):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        frame.explain(mode)
    return text.getvalue()


def _final_plan(frame):
    frame.collect()
    return _plan(frame).split("== Initial Plan ==")[0]


@pytest.fixture
def stored(spark, energy_frame, tmp_path):
    rows = [
        (country, f"2021-{month:02d}-01 {hour:02d}:00:00", month + hour / 4, 50.0)
        for country in ("IT", "SE")
        for month in range(1, 13)
        for hour in range(24)
    ]
    write_energy(energy_frame(rows), str(tmp_path / "energy"))
    return read_energy(spark, str(tmp_path / "energy"))


def test_country_filter_reaches_the_scan(stored):
    plan = _plan(plans.monthly_means(of_country(stored, "IT")), "formatted")
    assert re.search(r"PushedFilters: \[.*In\(Country, \[IT,Italy\]\)", plan)


def test_scan_reads_only_what_is_used(stored):
    plan = _plan(plans.monthly_means(stored).select("avg_carbon_intensity"), "formatted")
    assert "ReadSchema: struct<event_time:string,CarbonDirect:double>" in plan


def test_stats_are_combined_before_the_shuffle(stored):
    plan = _plan(plans.yearly_stats(stored))
    assert plan.count("FileScan") == 1
    assert plan.count("Exchange hashpartitioning") == 1
    shuffled = plan[plan.index("Exchange hashpartitioning"):]
    assert "partial_avg" in shuffled and "partial_min" in shuffled and "partial_max" in shuffled


@pytest.mark.parametrize("method", ["exact", "approx"])
def test_summary_scans_once(stored, method):
    plan = _plan(plans.hourly_summary(plans.hourly_profile(stored), method=method))
    assert plan.count("FileScan") == 1
    assert plan.count("Exchange hashpartitioning") == 2
    assert plan.count("Expand") == 1


def test_sql_summary_scans_once(spark, stored):
    register_energy(with_event_time(stored), "planned_energy")
    plan = _plan(plans.hourly_summary_sql(spark, "planned_energy"))
    assert plan.count("FileScan") == 1
    assert plan.count("Exchange hashpartitioning") == 2


def test_ranking_keeps_k_rows_per_task(stored):
    plan = _plan(top_k(plans.monthly_means(stored), "avg_carbon_intensity"))
    assert "TakeOrderedAndProject(limit=5" in plan
    assert "rangepartitioning" not in plan


@pytest.mark.parametrize("form", ["dataframe", "sql"])
def test_rankings_share_one_scan(spark, stored, form):
    monthly = plans.monthly_means(stored)
    if form == "sql":
        register_energy(monthly, "planned_months")
        plan = _final_plan(plans.ranking_board_sql(spark, "planned_months"))
    else:
        plan = _final_plan(ranking_board(monthly))
    assert plan.count("FileScan") == 1
    assert plan.count("ReusedExchange") == 3
    assert plan.count("TakeOrderedAndProject") == 4


def test_times_are_parsed_once_per_row(stored):
    plan = _plan(plans.monthly_means(stored))
    assert plan.count("try_cast(event_time") == 1


def test_scan_stays_in_generated_code(stored):
    stage = _final_plan(plans.yearly_stats(stored)).split("Exchange hashpartitioning")[1]
    operators = re.findall(r"(\*\(\d+\) )?(HashAggregate|Project|ColumnarToRow)", stage)
    assert operators and all(code for code, _ in operators)
    assert "Batched: true" in stage


# Queries over tables that they store on the way, or over two tables: their last plan joins small results.
JOINING = {
    "row_quartiles_exact",
    "quartiles_from_loads",
    "sorted_positions",
    "row_positions",
    "yearly_fold_replayed",
    "key_json_changes",
}
SINGLE_SCAN = {
    name
    for name in contract.queries()
    if name not in {"ranking_board", "ranking_board_sql", "ranking_board_all", "ingest_rejects", *JOINING}
    and not name.endswith(("_roundtrip", "_job", "_written", "_file", "_scan", "_formats"))
}


@pytest.mark.parametrize("name", sorted(set(contract.queries()) - set(contract.LLM_QUERIES)))
def test_no_query_leaves_the_jvm_or_joins(spark, name):
    plan = _plan(contract.queries()[name](spark, SF_DIR))
    for operator in ("Python", "Pandas", "Join", "Cartesian", "Exchange SinglePartition", "RDD"):
        if name == "run_comparison" and operator == "Exchange SinglePartition":
            continue  # one row per task meets in one row
        if name in JOINING and operator == "Join":
            continue
        if name == "ingest_rejects" and operator == "RDD":
            continue  # the observed counts, a row a reason
        assert operator not in plan, plan
    if name in SINGLE_SCAN:
        assert len(re.findall(r"FileScan|Scan text", plan)) == 1


def test_rankings_of_all_countries_are_cut_before_the_shuffle(spark):
    plan = _final_plan(contract.ranking_board_all(spark, SF_DIR))
    assert plan.count("FileScan") == 1
    assert plan.count("ReusedExchange") == 3
    partial = re.findall(r"WindowGroupLimit .*, 5, Partial", plan)
    assert len(partial) == 4
    assert len(re.findall(r"WindowGroupLimit .*, 5, Final", plan)) == 4


@pytest.mark.parametrize("name", ["row_quartiles_exact", "quartiles_from_loads"])
def test_no_quantile_keeps_the_values_of_a_group(spark, name, monkeypatch):
    """Each table stored on the way, too, comes from partial aggregates, and no aggregate holds rows."""
    from gridmetrics import workspace
    from gridmetrics.operators import positions, selection

    plans_seen = []

    def seen(df, *_):
        plans_seen.append(_plan(df))
        return workspace.stored(df)

    monkeypatch.setattr(selection, "stored", seen)
    monkeypatch.setattr(positions, "stored", seen)
    plans_seen.append(_plan(contract.queries()[name](spark, SF_DIR)))
    assert any("partial_" in plan for plan in plans_seen)
    for plan in plans_seen:
        assert not re.search(r"collect_(list|set)|percentile\(|SinglePartition", plan), plan
