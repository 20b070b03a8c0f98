from datetime import datetime

import pytest
from helpers import rows, stored_star
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starload import Warehouse
from starload.operators.constraints import audit
from starload.operators import foreign_keys
from starload.operators.foreign_keys import orphan_keys, with_parent_flag
from starload.operators.ids import assign_ids, number_rows
from starload.operators.keys import absent_rows, first_by_key, first_positions, key_violations, present_keys
from starload.operators.requests import request_sizes, with_request_status
from starload.session import fresh_dir, shared_dir
from starload.spec import HIRED_EMPLOYEES, ForeignKey

AT = datetime(2021, 5, 5, 1, 2, 3)
DEPARTMENT = ForeignKey("department_id", "departments")


@pytest.fixture(params=["10MB", "-1"])
def any_join(request, spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", request.param)
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_first_by_key(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 3, "b"), (1, 3, "a"), (2, 9, None), (2, 9, None)], "k int, o int, v string")
    assert rows(first_by_key(df, ["k"], ["o"])) == [(1, 3, "a"), (2, 9, None)]
    assert rows(key_violations(df, ["k"])) == [(1, 3), (2, 2)]


def test_first_positions(spark):
    df = spark.createDataFrame([(1, "b", 1), (1, "a", 9), (2, "a", 1), (None, "a", 2)], "k int, f string, n int")
    assert [(r["k"], tuple(r["_first"])) for r in first_positions(df, "k", ["f", "n"]).collect()] == [(1, ("a", 9))]
    assert first_positions(df.where("k = 2"), "k", ["f", "n"]) is None


def test_present_and_absent(spark, any_join):
    stored = spark.createDataFrame([(i,) for i in range(0, 100, 2)], "id int")
    incoming = spark.createDataFrame([(4, "x"), (4, "y"), (5, "z"), (None, "n")], "id int, v string")
    assert rows(present_keys(stored, incoming, "id")) == [(4,)]
    assert rows(absent_rows(incoming, stored, "id")) == [(5, "z"), (None, "n")]


def test_parent_flag(spark, any_join):
    parents = spark.createDataFrame([(1,), (1,), (None,), (2,)], "id int")
    df = spark.createDataFrame([(1, "a"), (3, "b"), (None, "c"), (1, "d")], "department_id int, v string")
    flagged = with_parent_flag(df, DEPARTMENT, parents, "ok")
    assert flagged.columns == ["department_id", "v", "ok"]
    assert rows(flagged) == [(1, "a", True), (1, "d", True), (3, "b", False), (None, "c", False)]
    assert rows(orphan_keys(df, DEPARTMENT, parents)) == [(3, 1)]


def test_audit_counts_every_rule(spark):
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in HIRED_EMPLOYEES.schema])
    df = spark.createDataFrame(
        [(1, "a", AT, 1, 1), (1, "n" * 256, AT, 9, 1), (None, None, None, None, None), (2, "b", AT, 9, 8)], schema
    )
    parents = {"departments": spark.createDataFrame([(1,)], "id int"), "jobs": spark.createDataFrame([(1,)], "id int")}
    assert dict(rows(audit(df, HIRED_EMPLOYEES, parents))) == {
        "not_null:id": 1, "max_length:name": 1, "primary_key:id": 1, "foreign_key:department_id": 2, "foreign_key:job_id": 1,
    }
    assert set(r["violations"] for r in audit(df.limit(0), HIRED_EMPLOYEES, parents).collect()) == {0}


def test_ids_over_many_files_in_task_order(spark, root):
    df = spark.range(3000).select((F.col("id") * 7919 % 3000).alias("v"))
    df.repartitionByRange(12, "v").sortWithinPartitions("v").write.option("maxRecordsPerFile", 100).parquet(f"{root}/n")
    numbered, last = number_rows(spark.read.parquet(f"{root}/n"), "id", 500)
    assert last == 3500
    assert numbered.where(F.col("id") != F.col("v") + 501).count() == 0
    ordered = assign_ids(df, "id", ["v"], f"{root}/o", after=10, dtype=T.IntegerType())
    assert ordered.schema["id"].dataType == T.IntegerType()
    assert ordered.where(F.col("id") != F.col("v") + 11).count() == 0


def test_no_rows_take_no_ids(spark, root):
    spark.range(0).write.parquet(f"{root}/e")
    numbered, last = number_rows(spark.read.parquet(f"{root}/e"), "n", 5)
    assert (numbered.count(), last) == (0, 5)


def test_request_cap(spark, any_join):
    df = spark.createDataFrame([("a", i) for i in range(3)] + [("b", i) for i in range(4)], "request_id string, ordinal int")
    assert rows(request_sizes(df, 3)) == [("a", 3, False), ("b", 4, True)]
    status = {r["request_id"]: r["request_status"] for r in with_request_status(df, 3).collect()}
    assert status == {"a": "OK", "b": "TOO_MANY_ROWS"}


def test_create_is_idempotent_and_tables_are_known_by_name(spark, root):
    warehouse = stored_star(spark, root, hires=[(1, "Ann", AT, 1, 1)])
    warehouse.create()
    warehouse.register_views()
    assert spark.sql(
        "SELECT d.department, COUNT(*) AS n FROM hired_employees h JOIN departments d ON h.department_id = d.id GROUP BY 1"
    ).first()[:] == ("Sales", 1)
    warehouse.drop("jobs")
    with pytest.raises(LookupError):
        warehouse.read("jobs")
    warehouse.drop("jobs")


def test_a_published_batch_is_not_published_again(spark, root):
    warehouse = stored_star(spark, root)
    more = spark.createDataFrame([(3, "Cook")], warehouse.read("jobs").schema)
    assert warehouse.publish("jobs", warehouse.stage("jobs", more), "x") is True
    assert warehouse.publish("jobs", warehouse.stage("jobs", more), "x") is False
    assert warehouse.read("jobs").count() == 3


def test_a_reader_of_the_replaced_version_goes_on(spark, root):
    warehouse = stored_star(spark, root)
    before = warehouse.read("jobs")
    warehouse.replace("jobs", warehouse.stage("jobs", before.where("id = 1")), "r1")
    assert (before.count(), warehouse.read("jobs").count()) == (2, 1)
    warehouse.replace("jobs", warehouse.stage("jobs", before), "r2")
    with pytest.raises(Exception):
        before.count()
    assert len(warehouse.files.names(warehouse.home("jobs"))) == 2


def test_year_folders_hold_nulls_too(spark, root):
    warehouse = stored_star(spark, root, hires=[(1, "a", AT, 1, 1), (2, "b", None, 1, 1), (3, "c", datetime(2020, 1, 1), 1, 1)])
    assert warehouse.read("hired_employees").count() == 3
    assert [r["id"] for r in warehouse.read("hired_employees", 2021).collect()] == [1]


def test_scratch_is_under_the_sessions_shared_folder(spark):
    assert fresh_dir(spark, "x").startswith(shared_dir(spark) + "/starload/x-")


def test_warehouse_of_other_tables(spark, root):
    other = HIRED_EMPLOYEES.widened()
    assert other.schema["id"].dataType == T.LongType()
    assert Warehouse(spark, root, [other]).specs == {"hired_employees": other}


def test_hot_and_null_keys_are_not_shuffled_by_key(spark, no_broadcast, monkeypatch):
    """A third of the rows without key, a third with one orphan key, a tenth with one parent's: no task gathers them."""
    monkeypatch.setattr(foreign_keys, "HOT_ROWS", 200)
    monkeypatch.setattr(foreign_keys, "broadcastable", lambda rows: False)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        key = F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, 7).when(F.col("id") % 10 == 0, 8).otherwise(F.col("id"))
        df = spark.range(6000).select(key.alias("department_id"), F.lit("same").alias("v"))
        parents = spark.range(0, 6000, 2).select((F.col("id") + F.when(F.col("id") == 7, 1).otherwise(0)).alias("id"))
        flagged = with_parent_flag(df, DEPARTMENT, parents, "ok")
        sizes = [r["n"] for r in flagged.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
        found = flagged.collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(found) == 6000 and max(sizes) < 1.25 * 6000 / len(sizes)
    assert all(r["ok"] == (r["department_id"] is not None and r["department_id"] % 2 == 0) for r in found)


def test_small_parents_cost_no_job_of_their_own(spark):
    """Nothing is written before the join, and repeated parents repeat no row."""
    df = spark.createDataFrame([(1, "a"), (3, "b"), (None, "c")], "department_id int, v string")
    flagged = with_parent_flag(df, DEPARTMENT, spark.range(1, 3).select(F.col("id").cast("int")).union(spark.range(1, 2).selectExpr("cast(id as int)")), "ok")
    assert "parquet" not in flagged._jdf.queryExecution().executedPlan().toString().lower()
    assert rows(flagged) == [(1, "a", True), (3, "b", False), (None, "c", False)]
