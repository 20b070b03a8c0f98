"""What the optimizer makes of the operators."""

import re

import pytest
from pyspark.sql import functions as F

from catalogue.tables import departments, fact, jobs
from starload.operators.foreign_keys import with_parent_flag
from starload.operators.ids import assign_ids, number_rows
from starload.operators.keys import first_by_key, present_keys
from starload.plans.reports import above_mean_groups, quarterly_counts
from starload.spec import ForeignKey
from starload.warehouse import Warehouse

SF_DIR = "/root/testdata/sf0.01"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def executed(df) -> str:
    df.collect()
    return plan(df).split("Initial Plan")[0]


def test_year_range_and_columns_reach_the_scan(spark):
    text = plan(quarterly_counts(fact(spark, SF_DIR), departments(spark, SF_DIR), jobs(spark, SF_DIR), 1997))
    scan = next(line for line in text.splitlines() if "lineitem.parquet" in line)
    assert "GreaterThanOrEqual(l_shipdate,1997-01-01T00:00)" in scan
    assert "LessThan(l_shipdate,1998" in scan
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint,l_shipdate:timestamp_ntz>" in scan


def test_small_dimensions_cost_one_grouping_shuffle(spark):
    text = executed(quarterly_counts(fact(spark, SF_DIR), departments(spark, SF_DIR), jobs(spark, SF_DIR), 1997))
    assert text.count("BroadcastHashJoin") == 2
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 1


def test_large_dimensions_count_before_the_join(spark, no_broadcast):
    text = executed(quarterly_counts(fact(spark, SF_DIR), departments(spark, SF_DIR), jobs(spark, SF_DIR), 1997))
    below_scan = text[: text.index("lineitem.parquet")]
    assert below_scan.rindex("partial_count") > below_scan.rindex("Join")


def test_groups_are_computed_once(spark):
    text = executed(above_mean_groups(fact(spark, SF_DIR), departments(spark, SF_DIR), 1997))
    assert "ReusedExchange" in text
    assert text.count("lineitem.parquet") == 1


def test_parent_check_never_shuffles_the_rows(spark, no_broadcast):
    """With parents too large to broadcast, only distinct keys are shuffled."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1000")
    flagged = with_parent_flag(
        fact(spark, SF_DIR), ForeignKey("department_id", "departments"), departments(spark, SF_DIR).where("id > 3"), "ok"
    )
    text = executed(flagged)
    assert "BroadcastHashJoin" in text
    assert "Exchange hashpartitioning" not in text
    expected = {r["department_id"]: r["ok"] for r in flagged.select("department_id", "ok").distinct().collect()}
    assert all(ok == (key > 3) for key, ok in expected.items())
    assert len(expected) == 100


def test_year_folders_are_pruned(spark, root):
    warehouse = Warehouse(spark, root)
    warehouse.create()
    rows = spark.range(1000).select(
        F.col("id").cast("int"),
        F.lit("x").alias("name"),
        F.expr("timestamp_ntz'2018-01-01 00:00:00' + make_dt_interval(cast(id * 2 as int))").alias("hire_datetime"),
        F.lit(1).alias("department_id"),
        F.lit(1).alias("job_id"),
    )
    warehouse.publish("hired_employees", warehouse.stage("hired_employees", rows), "b")
    one_year = warehouse.read("hired_employees", 2021)
    assert "PartitionFilters: [isnotnull(hire_datetime_year" in plan(one_year)
    assert set(r["y"] for r in one_year.select(F.year("hire_datetime").alias("y")).distinct().collect()) == {2021}


def test_no_operator_puts_all_rows_in_one_partition(spark, root):
    line = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    order = [c for c in line.columns if c not in ("l_orderkey", "l_linenumber")]
    deduped = first_by_key(line, ["l_orderkey", "l_linenumber"], order)
    numbered = assign_ids(line.select("l_orderkey"), "id", ["l_orderkey"], f"{root}/ids")
    for df in (deduped, numbered):
        assert "SinglePartition" not in plan(df)
        assert "Window" not in plan(df)
    partial = plan(deduped)
    assert "partial_min" in partial[partial.index("Exchange hashpartitioning") :]


def test_numbering_does_not_shuffle_the_rows(spark, root):
    spark.range(1000).write.parquet(f"{root}/n")
    numbered, _ = number_rows(spark.read.parquet(f"{root}/n"), "key")
    text = executed(numbered)
    assert "BroadcastHashJoin" in text
    assert "Exchange hashpartitioning" not in text


def test_numbering_by_shuffle_gives_the_same(spark, root):
    spark.range(1000).repartition(5).write.parquet(f"{root}/n")
    stored = spark.read.parquet(f"{root}/n")
    expected = number_rows(stored, "key")[0].collect()
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert sorted(number_rows(stored, "key")[0].collect()) == sorted(expected)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_lookup_of_stored_keys_skips_files_and_sends_the_small_side(spark, root):
    spark.range(100_000).write.parquet(f"{root}/stored")
    spark.range(99_990, 100_010).write.parquet(f"{root}/incoming")
    present = present_keys(spark.read.parquet(f"{root}/stored"), spark.read.parquet(f"{root}/incoming"), "id")
    text = executed(present)
    scan = next(line for line in text.splitlines() if "PushedFilters: [IsNotNull(id), GreaterThanOrEqual(id,99990)" in line)
    join = text.index("BroadcastHashJoin")
    assert "Exchange hashpartitioning" not in text[join : text.index(scan)]
    assert present.count() == 10


def test_numbering_sends_the_first_keys_and_not_the_rows(spark, root):
    """Whether the rows would fit a broadcast or are too many for one, they stay where they are read."""
    spark.range(1000).repartition(5).write.parquet(f"{root}/n")
    stored = spark.read.parquet(f"{root}/n")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for bytes_ in (threshold, "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", bytes_)
        try:
            text = executed(number_rows(stored, "key")[0])
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        assert "SortMergeJoin" not in text and "Exchange hashpartitioning" not in text
        assert "FileScan" not in text[text.index("BroadcastExchange") :]
