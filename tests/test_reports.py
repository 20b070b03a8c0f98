from datetime import datetime

import pytest
from helpers import rows
from pyspark.sql import functions as F

from starload.plans.reports import (
    above_mean_groups,
    group_counts,
    mean_of_groups,
    quarterly_counts,
    top_groups,
)

FACT = "id int, hire_datetime timestamp_ntz, department_id int, job_id int"


@pytest.fixture
def departments(spark):
    names = [(1, "Sales"), (2, "Legal"), (3, "Sales"), (4, "Empty")]
    return spark.createDataFrame(names, "id int, department string")


@pytest.fixture
def jobs(spark):
    return spark.createDataFrame([(1, "Engineer"), (2, "Clerk")], "id int, job string")


def fact(spark, *hires):
    return spark.createDataFrame([(i, t, d, j) for i, t, d, j in hires], FACT)


Q1, Q2, Q4 = datetime(2021, 1, 1), datetime(2021, 4, 1), datetime(2021, 12, 31, 23, 59, 59)
OTHER = datetime(2022, 1, 1)


@pytest.fixture(params=["10MB", "-1"])
def any_join(request, spark):
    """Both ways of the report: dimensions that Spark broadcasts, and dimensions too large for that."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", request.param)
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_quarters_merge_equal_names(spark, departments, jobs, any_join):
    data = fact(spark, (1, Q1, 1, 1), (2, Q1, 3, 1), (3, Q4, 3, 1), (4, Q2, 2, 2), (5, OTHER, 2, 2), (None, Q2, 2, 2))
    result = quarterly_counts(data, departments, jobs, 2021)
    assert result.columns == ["department", "job", "Q1", "Q2", "Q3", "Q4"]
    assert [tuple(r) for r in result.collect()] == [("Legal", "Clerk", 0, 2, 0, 0), ("Sales", "Engineer", 2, 0, 0, 1)]


def test_quarters_drop_null_and_orphan_keys(spark, departments, jobs, any_join):
    data = fact(spark, (1, None, 1, 1), (2, Q1, None, 1), (3, Q1, 1, None), (4, Q1, 9, 1), (5, Q1, 1, 9), (6, Q1, 1, 1))
    assert rows(quarterly_counts(data, departments, jobs, 2021)) == [("Sales", "Engineer", 1, 0, 0, 0)]
    assert quarterly_counts(data, departments, jobs, 1999).count() == 0


def test_collation_merges_spellings(spark, jobs, any_join):
    names = spark.createDataFrame([(1, "Sales"), (2, "SALES"), (3, "Sáles")], "id int, department string")
    data = fact(spark, (1, Q1, 1, 1), (2, Q1, 2, 1), (3, Q1, 3, 1))
    assert quarterly_counts(data, names, jobs, 2021).count() == 3
    merged = quarterly_counts(data, names, jobs, 2021, collation="UNICODE_CI_AI").collect()
    assert [r["Q1"] for r in merged] == [3]


def test_groups_are_by_id_and_skip_null_fact_ids(spark, departments, any_join):
    data = fact(spark, (1, Q1, 1, 1), (2, Q1, 3, 1), (None, Q1, 2, 1), (4, OTHER, 4, 1))
    assert rows(group_counts(data, departments, 2021)) == [(1, "Sales", 1), (2, "Legal", 0), (3, "Sales", 1)]


def test_mean_ignores_departments_without_rows(spark, departments):
    data = fact(spark, (1, Q1, 1, 1), (2, Q1, 1, 1), (3, Q1, 2, 1))
    assert mean_of_groups(group_counts(data, departments, 2021)).first()["mean_hired"] == 1.5
    assert rows(above_mean_groups(data, departments, 2021)) == [(1, "Sales", 2)]


def test_no_group_above_when_all_equal(spark, departments, any_join):
    data = fact(spark, (1, Q1, 1, 1), (2, Q1, 2, 1), (3, Q1, 3, 1))
    assert above_mean_groups(data, departments, 2021).count() == 0


def test_order_by_count_then_id(spark, any_join):
    names = spark.createDataFrame([(i, f"d{i}") for i in range(1, 6)], "id int, department string")
    hires = [(n, Q1, d, 1) for n, d in enumerate([5, 5, 5, 2, 2, 2, 3, 3, 3, 3, 1, 4])]
    result = above_mean_groups(fact(spark, *hires), names, 2021)
    assert [tuple(r) for r in result.collect()] == [(3, "d3", 4), (2, "d2", 3), (5, "d5", 3)]
    assert [r["id"] for r in top_groups(fact(spark, *hires), names, 2021, 2).collect()] == [3, 2]


def test_result_does_not_depend_on_partitions(spark, departments, jobs):
    data = fact(spark, *[(i, Q1 if i % 3 else Q4, i % 5, i % 3) for i in range(500)])
    results = {str(rows(quarterly_counts(data.repartition(n), departments, jobs, 2021))) for n in (1, 3, 16)}
    assert len(results) == 1


def test_one_hot_department(spark, departments, jobs, any_join):
    hot = spark.range(20_000).select(
        F.col("id").cast("int"),
        F.lit("2021-05-05").cast("timestamp_ntz").alias("hire_datetime"),
        F.when(F.col("id") % 3 == 0, 2).otherwise(F.col("id") % 4 + 1).cast("int").alias("department_id"),
        F.lit(1).alias("job_id"),
    )
    found = {r["department"]: r["Q2"] for r in quarterly_counts(hot, departments, jobs, 2021).collect()}
    expected: dict[str, int] = {}
    names = {1: "Sales", 2: "Legal", 3: "Sales", 4: "Empty"}
    for i in range(20_000):
        name = names[2 if i % 3 == 0 else i % 4 + 1]
        expected[name] = expected.get(name, 0) + 1
    assert found == expected
