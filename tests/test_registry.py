"""Every registered query against its SQL on the driver tables, and against the expected counts."""

import os

import pytest

import __spark_entry__ as entry
from pulsegrid.registry.oracles import all_oracles
from pulsegrid.registry.queries import all_queries
from pulsegrid.sources.scratch import cut
from tests.helpers import plan_of
from tools.check import compare, connect

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
needs_data = pytest.mark.skipif(not os.path.isdir(MEDIUM), reason="driver tables not present")

# Only these hand rows to Python; everything else stays in the JVM.
PYTHON = {"score_batches", "score_all_models"}


def test_every_query_has_sql():
    assert set(all_queries()) == set(all_oracles())
    assert set(all_queries()) <= set(entry.queries()) and set(all_oracles()) <= set(entry.oracle_sql())


@needs_data
@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_equals_sql(spark, name):
    df = all_queries()[name](spark, SMALL)
    plan = plan_of(df)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "Python" not in plan or name in PYTHON
    cursor = connect(SMALL).execute(all_oracles()[name])
    assert compare(df.columns, df.collect(), [d[0] for d in cursor.description], cursor.fetchall()) == ""


@needs_data
def test_expected_counts(spark):
    run = {n: cut(all_queries()[n](spark, MEDIUM)) for n in ("ecg_order", "lab_interval_join", "age_delta", "job_hosp_labels")}
    hosp = run["ecg_order"].selectExpr("count(*)", "count(distinct stay_id)", "max(ecg_order)").first()
    assert tuple(hosp) == (1127, 875, 5)
    labs = run["lab_interval_join"].selectExpr("count(*)", "count(valuenum)", "count(distinct study_id)").first()
    assert tuple(labs) == (873, 683, 700)
    assert tuple(run["job_hosp_labels"].selectExpr("count(*)", "sum(icu_expire_flag)", "sum(hospital_expire_flag)").first()) == (533, 215, 85)
    n, mean = run["age_delta"].selectExpr("count(*)", "avg(age_delta)").first()
    assert n == 794 and mean == pytest.approx(-0.011391, abs=1e-6)


@needs_data
def test_mortality_by_decile_values(spark):
    # Expected values at sf0.01: bin, rows, hospital death rate, ICU death rate.
    expected = [
        (0, 80, 0.1625, 0.1125), (1, 79, 0.113924, 0.063291), (2, 81, 0.185185, 0.061728),
        (3, 86, 0.174419, 0.069767), (4, 73, 0.164384, 0.068493), (5, 77, 0.194805, 0.064935),
        (6, 80, 0.15, 0.1), (7, 80, 0.075, 0.05), (8, 79, 0.075949, 0.037975), (9, 79, 0.202532, 0.075949),
    ]
    out = all_queries()["job_age_mortality"](spark, MEDIUM).orderBy("bin").collect()
    got = [(r.bin, r.n, r.hospital_expire_flag_rate, r.icu_mort_rate) for r in out]
    assert got == [pytest.approx(e, abs=1e-6) for e in expected]


@needs_data
def test_entry(spark):
    out = entry.entry(spark)
    assert out.columns[0] == "bin" and 0 < out.count() <= 10
