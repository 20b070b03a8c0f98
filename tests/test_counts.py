"""Report counts kept beside the folders: equal to the recomputed reports whatever happened to the table."""

from datetime import datetime, timedelta

import pytest
from helpers import bodies, hire, request, rows, stored_star

from starload import Warehouse
from starload.operators.partial_counts import KEYED, ROWS, added_counts, partial_counts
from starload.plans import counts, reports
from starload.plans.ingest import ingest_requests
from starload.plans.snapshot import backup, restore
from starload.spec import HIRED_EMPLOYEES

TABLE = "hired_employees"
NOW = datetime(2025, 2, 18, 23, 35, 16)


def hires(first, n, department=lambda k: k % 3, job=lambda k: k % 4):
    """Hires over three years; ids 0 and 3 have no parent, and some fields are null."""
    at = datetime(2020, 6, 1)
    return [
        (k, f"n{k}", None if k % 11 == 0 else at + timedelta(days=17 * k % 900), None if k % 7 == 0 else department(k),
         None if k % 5 == 0 else job(k))
        for k in range(first, first + n)
    ]


def add(spark, warehouse, given, label):
    warehouse.publish(TABLE, warehouse.stage(TABLE, spark.createDataFrame(given, warehouse.read(TABLE).schema)), label)


def assert_as_recomputed(warehouse):
    departments, jobs = warehouse.read("departments"), warehouse.read("jobs")
    for year in (2020, 2021, 2022, 1999):
        fact = warehouse.read(TABLE, year)
        from_counts = counts.stored_quarterly_counts(warehouse, TABLE, "departments", "jobs", year)
        assert from_counts.collect() == reports.quarterly_counts(fact, departments, jobs, year).collect()
        above = counts.stored_above_mean_groups(warehouse, TABLE, "departments", year)
        assert above.collect() == reports.above_mean_groups(fact, departments, year).collect()


def test_reports_follow_the_table(spark, root):
    warehouse = stored_star(spark, root, hires=hires(1, 60))
    assert_as_recomputed(warehouse)  # nothing counted yet
    assert warehouse.keep_counts(TABLE) == 1 and warehouse.keep_counts(TABLE) == 0
    add(spark, warehouse, hires(100, 40), "more")
    assert_as_recomputed(warehouse)  # one of two folders counted
    ingest_requests(warehouse, TABLE, bodies(spark, a=request(hire(), hire(hire_datetime="2021-12-31T23:59:59Z"))))
    assert warehouse.keep_counts(TABLE) == 2
    assert_as_recomputed(warehouse)
    path = backup(warehouse, TABLE, f"{root}/backups", NOW)
    warehouse.join_small(TABLE, 3)
    assert len(warehouse.state(TABLE).folders) == 1 and warehouse.keep_counts(TABLE) == 0
    assert_as_recomputed(warehouse)
    add(spark, warehouse, hires(300, 30), "late")
    warehouse.keep_counts(TABLE)
    warehouse.compact(TABLE)
    assert warehouse.keep_counts(TABLE) == 0
    assert_as_recomputed(warehouse)
    restore(warehouse, TABLE, path)
    assert warehouse.keep_counts(TABLE) == 1
    assert_as_recomputed(warehouse)
    assert sum(r["rows"] for r in counts.rows_by_year(warehouse, TABLE).collect()) == warehouse.read(TABLE).count() == 102


def test_folders_that_are_not_all_counted_are_counted_after_the_join(spark, root):
    warehouse = stored_star(spark, root, hires=hires(1, 20))
    warehouse.keep_counts(TABLE)
    add(spark, warehouse, hires(50, 20), "more")
    warehouse.compact(TABLE)
    assert warehouse.keep_counts(TABLE) == 1
    assert_as_recomputed(warehouse)


def test_a_counted_table_is_not_read_again(spark, root):
    warehouse = stored_star(spark, root, hires=hires(1, 60))
    warehouse.keep_counts(TABLE)
    read = counts.counted(warehouse, TABLE, 2021).inputFiles()
    assert read and all("/counts=" in f for f in read)
    add(spark, warehouse, hires(100, 40), "more")
    facts = [f for f in counts.counted(warehouse, TABLE, 2021).inputFiles() if "/counts=" not in f]
    new = warehouse.state(TABLE).folders[-1]
    assert facts and all(f"batch={new}" in f for f in facts)
    plan = counts.counted(warehouse, TABLE, 2021)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(hire_datetime_year" in plan and "EqualTo(_year,2021)" in plan


def test_counts_leave_with_their_folders(spark, root):
    """They stay for readers in flight until the next rewrite, as the rows do."""
    warehouse = stored_star(spark, root, hires=hires(1, 20))
    add(spark, warehouse, hires(50, 20), "more")
    warehouse.keep_counts(TABLE)
    before = warehouse.state(TABLE)
    warehouse.compact(TABLE)
    assert warehouse.read_counts(TABLE, before, before.folders).count() > 0
    add(spark, warehouse, hires(90, 5), "again")
    warehouse.compact(TABLE)
    state, home = warehouse.state(TABLE), warehouse.home(TABLE)
    assert set(state.counted) <= {*state.folders, *state.retired}
    assert not any(warehouse.files.exists(f"{home}/counts={before.counted[f]}/part={f}") for f in before.folders)


def test_of_two_that_count_a_folder_one_stands(spark, root, monkeypatch):
    warehouse, other = stored_star(spark, root, hires=hires(1, 60)), Warehouse(spark, root)
    real = warehouse._write_counts

    def write(*args):
        made = real(*args)
        assert other.keep_counts(TABLE) == 1
        return made

    monkeypatch.setattr(warehouse, "_write_counts", write)
    assert warehouse.keep_counts(TABLE) == 0
    assert_as_recomputed(warehouse)


@pytest.mark.parametrize("gone", ["drop", "compact"])
def test_a_folder_that_left_meanwhile_gets_no_counts(spark, root, monkeypatch, gone):
    warehouse, other = stored_star(spark, root, hires=hires(1, 20)), Warehouse(spark, root)
    add(spark, warehouse, hires(50, 20), "more")
    real = warehouse._write_counts

    def write(*args):
        made = real(*args)
        getattr(other, gone)(TABLE)
        other.create()
        return made

    monkeypatch.setattr(warehouse, "_write_counts", write)
    assert warehouse.keep_counts(TABLE) == 0
    assert warehouse.state(TABLE).counted == {}
    monkeypatch.undo()
    assert_as_recomputed(warehouse)


def test_tables_without_rows_or_datetime(spark, root):
    warehouse = stored_star(spark, root)
    assert warehouse.keep_counts(TABLE) == 0 and counts.counted(warehouse, TABLE, 2021).count() == 0
    add(spark, warehouse, [], "nothing")
    assert warehouse.keep_counts(TABLE) == len(warehouse.state(TABLE).folders) == 1
    assert set(warehouse.state(TABLE).counted.values()) == {""}
    add(spark, warehouse, hires(1, 5), "some")
    warehouse.keep_counts(TABLE)
    warehouse.compact(TABLE)
    assert warehouse.keep_counts(TABLE) == 0
    assert_as_recomputed(warehouse)
    with pytest.raises(ValueError, match="no datetime"):
        warehouse.keep_counts("jobs")


def test_counts_of_parts_add_up(spark, root):
    warehouse = stored_star(spark, root, hires=hires(1, 90))
    every = warehouse.read(TABLE)
    parts = [partial_counts(every.where(f"id % 3 = {k}"), HIRED_EMPLOYEES) for k in range(3)]
    added = added_counts(parts[0].unionByName(parts[1]).unionByName(parts[2]), HIRED_EMPLOYEES)
    whole = partial_counts(every, HIRED_EMPLOYEES)
    assert rows(added.select(*whole.columns)) == rows(whole)
    nameless = every.selectExpr("if(id % 2 = 0, id, null) AS id", "hire_datetime", "department_id", "job_id")
    totals = partial_counts(nameless, HIRED_EMPLOYEES).selectExpr(f"sum({ROWS})", f"sum({KEYED})").first()
    assert tuple(totals) == (90, 45)


def test_a_hot_group_is_shuffled_as_one_row_a_task(spark, root):
    plan = partial_counts(stored_star(spark, root, hires=hires(1, 9)).read(TABLE), HIRED_EMPLOYEES)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in text[text.index("Exchange hashpartitioning") :]
