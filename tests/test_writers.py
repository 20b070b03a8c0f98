"""Writers at the same time, parents that leave, dropped tables, and the record of a long stream."""

import json
import os
import shutil
from datetime import datetime

import pytest
from helpers import bodies, hire, request, rows, stored_star
from pyspark.sql import functions as F

from starload import Warehouse
from starload.commits import MOST_LEASES, TableState, numbered, with_number
from starload.plans.ingest import REJECTED_ROWS, REQUESTS, ingest_requests
from starload.plans.load import load_history
from starload.plans.snapshot import backup, restore
from starload.warehouse import Batch, LeaseEnded, ParentMoved, TableGone
from test_load import fact_line, history_file

TABLE = "hired_employees"
AT = datetime(2021, 5, 5, 1, 2, 3)
NOW = datetime(2025, 2, 18, 23, 35, 16)


def meanwhile(monkeypatch, warehouse, *actions):
    """Let the actions happen one by one, each before one of the warehouse's next commits of a batch."""
    left, real = list(actions), warehouse.publish_all

    def publish_all(*args):
        if left:
            left.pop(0)()
        return real(*args)

    monkeypatch.setattr(warehouse, "publish_all", publish_all)


def count_stages(monkeypatch, warehouse) -> list:
    calls, real = [], warehouse.stage

    def stage(name, *args, **how):
        calls.append(name)
        return real(name, *args, **how)

    monkeypatch.setattr(warehouse, "stage", stage)
    return calls


# -- key ranges -----------------------------------------------------------------------------------


def test_ranges_do_not_meet_and_gaps_stay(spark, root):
    warehouse = stored_star(spark, root, hires=[(41, "Old", AT, 1, 1)])
    first, second = warehouse.lease(TABLE, 5), warehouse.lease(TABLE, 3)
    assert [(r.first, r.last) for r in (first, second)] == [(42, 46), (47, 49)]
    result = ingest_requests(warehouse, TABLE, bodies(spark, a=request(hire())))
    assert result.accepted.first()["id"] == 50
    assert set(warehouse.state(TABLE).leases) == {first.id, second.id}
    assert warehouse.max_id(TABLE) == 50


def test_a_writer_between_lease_and_commit_costs_no_rewrite(spark, root, monkeypatch):
    warehouse, other = stored_star(spark, root), Warehouse(spark, root)
    calls = count_stages(monkeypatch, warehouse)
    meanwhile(monkeypatch, warehouse, lambda: ingest_requests(other, TABLE, bodies(spark, b=request(*[hire(name="Bob")] * 2))))
    ingest_requests(warehouse, TABLE, bodies(spark, a=request(*[hire()] * 3)))
    assert calls == [TABLE]
    assert [(r["id"], r["name"]) for r in warehouse.read(TABLE).orderBy("id").collect()] == [
        (1, "Ann"), (2, "Ann"), (3, "Ann"), (4, "Bob"), (5, "Bob"),
    ]


def test_a_restore_or_a_load_of_such_keys_ends_the_range(spark, root, monkeypatch):
    warehouse, other = stored_star(spark, root, hires=[(1, "Old", AT, 1, 1)]), Warehouse(spark, root)
    path = backup(warehouse, TABLE, f"{root}/backups", NOW)
    calls = count_stages(monkeypatch, warehouse)

    def take(key):
        rows = spark.createDataFrame([(key, "Taken", AT, 1, 1)], other.read(TABLE).schema)
        other.publish(TABLE, other.stage(TABLE, rows), f"taken {key}")

    meanwhile(monkeypatch, warehouse, lambda: restore(other, TABLE, path), lambda: take(2))
    ingest_requests(warehouse, TABLE, bodies(spark, a=request(hire(), hire())), "late")
    assert len(calls) == 3
    assert sorted((r["id"], r["name"]) for r in warehouse.read(TABLE).collect()) == [(1, "Old"), (2, "Taken"), (4, "Ann"), (5, "Ann")]


def test_ranges_of_dead_writers_do_not_pile_up(spark, root):
    warehouse = stored_star(spark, root)
    first = warehouse.lease(TABLE, 1)
    state = warehouse.state(TABLE)
    many = {f"l{n}": [n, n] for n in range(2, MOST_LEASES + 50)}
    warehouse.commits.change(lambda tables: tables | {TABLE: TableState(**vars(state) | {"leases": state.leases | many})})
    warehouse.lease(TABLE, 1)
    assert len(warehouse.state(TABLE).leases) == MOST_LEASES
    staged = warehouse.stage(TABLE, spark.createDataFrame([(1, "a", AT, 1, 1)], warehouse.read(TABLE).schema))
    with pytest.raises(LeaseEnded):
        warehouse.publish_all({TABLE: Batch(staged, 1, lease=first)}, "late")


# -- parents that leave ---------------------------------------------------------------------------


def test_rows_of_a_parent_that_left_are_refused(spark, root, monkeypatch):
    warehouse, other = stored_star(spark, root), Warehouse(spark, root)
    path = backup(warehouse, "departments", f"{root}/backups", NOW)
    more = spark.createDataFrame([(3, "Lab")], warehouse.read("departments").schema)
    warehouse.publish("departments", warehouse.stage("departments", more), "more")
    meanwhile(monkeypatch, warehouse, lambda: restore(other, "departments", path))
    body = bodies(spark, a=request(hire(), hire(department_id=3), hire(name=""), hire(department_id=2)), b=request(hire(department_id=3)))
    result = ingest_requests(warehouse, TABLE, body, "late")
    assert sorted((r["id"], r["department_id"]) for r in result.accepted.collect()) == [(1, 1), (2, 2)]
    assert sorted((r["request_id"], r["ordinal"], r["reason_code"], r["reason"]) for r in result.rejected.collect()) == [
        ("a", 1, "FOREIGN_KEY", "not found: department_id 3 or job_id 1"), ("a", 2, "MISSING_FIELD", "missing field"),
        ("b", 0, "FOREIGN_KEY", "not found: department_id 3 or job_id 1"),
    ]
    assert {r["request_id"]: (r["inserted"], r["failed"]) for r in result.summary.collect()} == {"a": (2, 2), "b": (0, 1)}
    assert warehouse.files.names(f"{root}/staging") == []


def test_a_parent_that_grew_or_was_rewritten_costs_nothing(spark, root, monkeypatch):
    warehouse, other = stored_star(spark, root), Warehouse(spark, root)
    calls = count_stages(monkeypatch, warehouse)

    def grow():
        more = spark.createDataFrame([(3, "Lab")], other.read("departments").schema)
        other.publish("departments", other.stage("departments", more), "more")

    meanwhile(monkeypatch, warehouse, grow)
    ingest_requests(warehouse, TABLE, bodies(spark, a=request(hire())))
    meanwhile(monkeypatch, warehouse, lambda: other.compact("departments"))
    ingest_requests(warehouse, TABLE, bodies(spark, b=request(hire())))
    assert calls == [TABLE, TABLE] and warehouse.read(TABLE).count() == 2


def test_all_rows_lost_with_a_dropped_parent(spark, root, monkeypatch):
    warehouse, other = stored_star(spark, root), Warehouse(spark, root)
    meanwhile(monkeypatch, warehouse, lambda: other.drop("jobs"))
    result = ingest_requests(warehouse, TABLE, bodies(spark, a=request(hire(), hire())), "late")
    assert (result.accepted.count(), result.rejected.count(), warehouse.read(TABLE).count()) == (0, 2, 0)


def test_a_load_is_refused_when_a_parent_left(spark, root, tmp_path, monkeypatch):
    warehouse, other = stored_star(spark, root), Warehouse(spark, root)
    path = history_file(tmp_path, "h.csv", [fact_line()])
    meanwhile(monkeypatch, warehouse, lambda: other.drop("jobs"))
    with pytest.raises(ParentMoved):
        load_history(warehouse, {TABLE: path})
    other.create()
    assert warehouse.read(TABLE).count() == 0


# -- dropped tables -------------------------------------------------------------------------------


def test_a_dropped_table_takes_no_batch_of_the_old_one(spark, root):
    warehouse, other = stored_star(spark, root), Warehouse(spark, root)
    staged = warehouse.stage("jobs", warehouse.read("jobs").limit(1))
    other.drop("jobs")
    with pytest.raises(TableGone):
        warehouse.publish("jobs", staged, "late", 1)
    other.create()
    with pytest.raises(TableGone):
        warehouse.publish("jobs", staged, "late", 1)
    assert not warehouse.has_batch("jobs", "late") and warehouse.read("jobs").count() == 0


def test_a_drop_leaves_what_was_written_for_the_next_table(spark, root, monkeypatch):
    """The next table is created and filled between the drop's commit and its delete."""
    warehouse, other = stored_star(spark, root), Warehouse(spark, root)
    real = warehouse.files.delete

    def delete(path):
        other.create()
        more = spark.createDataFrame([(9, "New")], other.read("jobs").schema)
        other.publish("jobs", other.stage("jobs", more), "new")
        real(path)

    monkeypatch.setattr(warehouse.files, "delete", delete)
    warehouse.drop("jobs")
    assert rows(other.read("jobs")) == [(9, "New")]


def test_a_folder_that_is_not_there_is_refused(spark, root):
    warehouse = stored_star(spark, root)
    with pytest.raises(TableGone):
        warehouse.publish("jobs", warehouse.new_batch("jobs"), "nothing", 0)


# -- the record of a long stream ------------------------------------------------------------------


def test_intervals():
    taken = []
    for n in (5, 3, 4, 9, 4, 0, 10):
        taken = with_number(taken, n)
    assert taken == [[0, 0], [3, 5], [9, 10]]
    assert numbered("a-b-12") == ("a-b", 12)
    assert [numbered(b)[0] for b in ("a", "a-", "a-01", "a-x", "-1", "a-" + "9" * 30)] == [""] * 6


def test_small_folders_are_joined_with_their_logs(spark, root):
    warehouse = stored_star(spark, root)
    body = bodies(spark, a=request(hire(), hire(name="")))
    for n in range(7):
        ingest_requests(warehouse, TABLE, body, f"s-{n}" if n else "first")
    assert warehouse.join_small(TABLE, 3) == 2
    state = warehouse.state(TABLE)
    assert [f.split("~")[:2] for f in state.folders][:2] == [["s-6", state.folders[0].split("~")[1]], ["tier", "1"]]
    assert state.taken == {"s": [[1, 6]]} and set(state.batches) == {"first", "s-6"}
    assert sorted(r["id"] for r in warehouse.read(TABLE).collect()) == list(range(1, 8))
    log = warehouse.log(TABLE, REJECTED_ROWS)
    assert sorted(r["batch"] for r in log.collect()) == ["first", *[f"s-{n}" for n in range(1, 7)]]
    assert warehouse.log(TABLE, REQUESTS).count() == 7
    replay = ingest_requests(warehouse, TABLE, body, "s-2")
    assert (replay.accepted.count(), replay.rejected.count(), replay.summary.count()) == (0, 1, 1)
    assert warehouse.read(TABLE).count() == 7


def test_a_restore_forgets_the_numbers_since(spark, root):
    warehouse = stored_star(spark, root)
    body = bodies(spark, a=request(hire(), hire(name="")))
    for n in range(3):
        ingest_requests(warehouse, TABLE, body, f"s-{n}")
    path = backup(warehouse, TABLE, f"{root}/backups", NOW)
    for n in range(3, 6):
        ingest_requests(warehouse, TABLE, body, f"s-{n}")
    warehouse.join_small(TABLE, 3)
    restore(warehouse, TABLE, path)
    assert warehouse.state(TABLE).taken["s"] == [[0, 2]]
    assert sorted(r["batch"] for r in warehouse.log(TABLE, REJECTED_ROWS).collect()) == ["s-0", "s-1", "s-2"]
    for n in (2, 4):
        ingest_requests(warehouse, TABLE, body, f"s-{n}")
    assert warehouse.read(TABLE).count() == 4


def test_many_batches_keep_the_record_small(spark, root):
    """Rows are copied files, joined as a stream does; each row is rewritten once per tier."""
    warehouse = stored_star(spark, root)
    one = warehouse.stage(TABLE, spark.createDataFrame([(1, "a", AT, 1, 1)], warehouse.read(TABLE).schema).coalesce(1))
    series = "0123456789abcdef-0123-4567-89ab-0123456789ab"
    rewritten, real, sizes, n_batches = [], warehouse.stage, {}, 150

    def stage(name, rows, path=None, extra=()):
        rewritten.append(rows.count())
        return real(name, rows, path, extra)

    warehouse.stage = stage
    for n in range(n_batches):
        batch = warehouse.new_batch(TABLE, f"{series}-{n}")
        shutil.copytree(one.removeprefix("file:"), batch.removeprefix("file:"))
        assert warehouse.publish(TABLE, batch, f"{series}-{n}", n)
        warehouse.join_small(TABLE, 8)
        version, _ = warehouse.commits.latest()
        sizes[n] = os.path.getsize(warehouse.commits._path(version).removeprefix("file:"))
    state = warehouse.state(TABLE)
    assert state.taken == {series: [[0, n_batches - 1]]} and warehouse.read(TABLE).count() == n_batches
    assert sum(rewritten) <= 2 * n_batches and len(state.folders) < 3 * 8 and len(state.batches) < 8
    assert max(sizes.values()) < 5_000 and max(sizes[n] for n in range(80, 150)) < 1.2 * max(sizes[n] for n in range(80))
    assert warehouse.files.names(f"{root}/commits/0000") == [f"{k:02d}" for k in range(1 + version // 100)]
    assert not warehouse.publish(TABLE, one, f"{series}-50", 1)


def test_versions_are_found_by_listing_the_newest_folder(spark, root):
    commits = stored_star(spark, root).commits
    last, tables = commits.latest()
    for version in (99, 100, 9_999, 10_000, 1_000_001):
        assert commits._files.create_new(commits._path(version), json.dumps({"tables": {}}))
        assert commits.latest()[0] == version


def test_a_join_gives_way_to_a_rewrite(spark, root, monkeypatch):
    warehouse, other = stored_star(spark, root), Warehouse(spark, root)
    for n in range(3):
        ingest_requests(warehouse, TABLE, bodies(spark, a=request(hire())), f"s-{n}")
    real = warehouse.stage

    def stage(*args, **how):
        path = real(*args, **how)
        other.compact(TABLE)
        return path

    monkeypatch.setattr(warehouse, "stage", stage)
    assert warehouse.join_small(TABLE, 3) == 0
    assert warehouse.read(TABLE).count() == 3 and len(warehouse.state(TABLE).folders) == 1
