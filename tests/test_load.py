from datetime import datetime

import pytest
from helpers import history_file, rows, stored_star

import starload.plans.load as load_module
from starload import Warehouse
from starload.plans.load import REJECTED_LINES, load_history
from starload.sources.delimited import read_delimited
from starload.spec import HIRED_EMPLOYEES, JOBS
from starload.warehouse import ConcurrentWrite

AT = datetime(2021, 5, 5, 1, 2, 3)


def fact_line(key="1", name="Ann", at="2021-05-05T01:02:03Z", department="1", job="1") -> str:
    return ",".join([key, name, at, department, job])


def load_fact(spark, root, tmp_path, *lines: str):
    warehouse = stored_star(spark, root)
    report = load_history(warehouse, {"hired_employees": history_file(tmp_path, "in/h.csv", list(lines))})
    return warehouse, report


def reasons(warehouse) -> dict:
    log = warehouse.log("hired_employees", REJECTED_LINES)
    return {r["line"]: r["reason_code"] for r in log.collect()} if log is not None else {}


def test_three_tables(spark, root, tmp_path):
    paths = {
        "hired_employees": history_file(tmp_path, "h.csv", [fact_line(), fact_line("2", department="2", job="2")]),
        "departments": history_file(tmp_path, "d.csv", ["1,Sales", r"2,R\, D"]),
        "jobs": history_file(tmp_path, "j.csv", ["1,Engineer", '2,"Clerk"']),
    }
    warehouse = Warehouse(spark, root)
    report = load_history(warehouse, paths)
    assert rows(warehouse.read("departments")) == [(1, "Sales"), (2, "R, D")]
    assert rows(warehouse.read("jobs")) == [(1, "Engineer"), (2, '"Clerk"')]
    assert rows(warehouse.read("hired_employees")) == [(1, "Ann", AT, 1, 1), (2, "Ann", AT, 2, 2)]
    assert {r["table"]: r["rows"] for r in report.counts} == {"departments": 2, "jobs": 2, "hired_employees": 2}
    assert warehouse.files.names(f"{root}/staging") == []


def test_empty_text_is_null_in_the_fact_only(spark, root, tmp_path):
    warehouse, _ = load_fact(spark, root, tmp_path, "1,,,,", r"2,\N,\N,\N,\N")
    assert rows(warehouse.read("hired_employees")) == [(1, None, None, None, None), (2, None, None, None, None)]
    load_history(warehouse, {"jobs": history_file(tmp_path, "in/j.csv", ["7,", r"8,\N"])})
    assert (7, "") in rows(warehouse.read("jobs"))
    assert [r["reason_code"] for r in warehouse.log("jobs", REJECTED_LINES).collect()] == ["NULL_NOT_ALLOWED"]


def test_short_long_and_broken_lines(spark, root, tmp_path):
    warehouse, report = load_fact(
        spark, root, tmp_path,
        "1,short", fact_line("2") + ",extra,more", "x1,a,2021-01-01,1,1", fact_line("3", department="one"),
        fact_line("4", at="2021-02-30"), fact_line("5", name="n" * 256), fact_line("6", department="9"),
        fact_line("7", job="9"), fact_line("8", name="n" * 255), "",
    )
    assert sorted(r["id"] for r in warehouse.read("hired_employees").collect()) == [1, 2, 8]
    assert reasons(warehouse) == {
        "x1,a,2021-01-01,1,1": "BAD_VALUE",
        fact_line("3", department="one"): "BAD_VALUE",
        fact_line("4", at="2021-02-30"): "BAD_DATETIME",
        fact_line("5", name="n" * 256): "TOO_LONG",
        fact_line("6", department="9"): "FOREIGN_KEY",
        fact_line("7", job="9"): "FOREIGN_KEY",
        "": "BAD_VALUE",
    }
    stored = next(r for r in report.counts if r["reason_code"] is None)
    assert (stored["rows"], stored["lines_with_extra_fields"], stored["largest_key"]) == (3, 1, 8)


def test_line_feed_is_data_and_crlf_ends_the_line(spark, tmp_path):
    path = history_file(tmp_path, "j.csv", ["1,two\nlines", "2,x"])
    assert rows(read_delimited(spark, path, JOBS).select("id", "job")) == [(1, "two\nlines"), (2, "x")]
    other = history_file(tmp_path, "k.csv", ["1;a", "2;b"], "\n")
    assert rows(read_delimited(spark, other, JOBS, ";", "\n").select("id", "job")) == [(1, "a"), (2, "b")]


def test_empty_file(spark, root, tmp_path):
    warehouse, report = load_fact(spark, root, tmp_path)
    assert warehouse.read("hired_employees").count() == 0
    assert report.counts == []


def test_first_valid_line_of_a_key_wins(spark, root, tmp_path):
    warehouse, _ = load_fact(
        spark, root, tmp_path,
        fact_line("1", "bad", at="never"), fact_line("1", "first"), fact_line("1", "second"),
        fact_line("2", "orphan", job="9"), fact_line("2", "good"),
    )
    assert [(r["id"], r["name"]) for r in warehouse.read("hired_employees").orderBy("id").collect()] == [(1, "first"), (2, "good")]


def test_first_wins_over_many_splits(spark, root, tmp_path):
    """Every key twice or more, one key in a third of all lines, files cut into many splits."""
    keys = [k if k % 3 else 0 for n in range(4) for k in range(n * 500, n * 500 + 3000)]
    lines = [f"{key},v{i:06d}{'x' * 40}" for i, key in enumerate(keys)]
    third = len(lines) // 3
    files = [history_file(tmp_path, f"in/{n}.csv", lines[n * third : (n + 1) * third]) for n in range(3)]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        warehouse = Warehouse(spark, root)
        load_history(warehouse, {"jobs": files})
        expected: dict[int, str] = {}
        for line in lines:
            key, value = line.split(",")
            expected.setdefault(int(key), value)
        assert {r["id"]: r["job"] for r in warehouse.read("jobs").collect()} == expected
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_loading_twice_adds_nothing(spark, root, tmp_path):
    path = history_file(tmp_path, "h.csv", [fact_line(), fact_line("2")])
    warehouse = stored_star(spark, root)
    assert load_history(warehouse, {"hired_employees": path}).stored("hired_employees") == 2
    changed = history_file(tmp_path, "h2.csv", [fact_line("2", "changed"), fact_line("3")])
    assert load_history(warehouse, {"hired_employees": [path, changed]}).stored("hired_employees") == 1
    assert [(r["id"], r["name"]) for r in warehouse.read("hired_employees").orderBy("id").collect()] == [
        (1, "Ann"), (2, "Ann"), (3, "Ann"),
    ]


def test_failed_load_publishes_nothing(spark, root, tmp_path, monkeypatch):
    real = load_module._stage_judged

    def fail_on_fact(warehouse, spec, *rest):
        if spec.name == HIRED_EMPLOYEES.name:
            raise RuntimeError("disk full")
        return real(warehouse, spec, *rest)

    monkeypatch.setattr(load_module, "_stage_judged", fail_on_fact)
    warehouse = Warehouse(spark, root)
    paths = {
        "jobs": history_file(tmp_path, "j.csv", ["1,Engineer"]),
        "departments": history_file(tmp_path, "d.csv", ["1,Sales"]),
        "hired_employees": history_file(tmp_path, "h.csv", [fact_line()]),
    }
    with pytest.raises(RuntimeError, match="disk full"):
        load_history(warehouse, paths)
    assert all(warehouse.read(name).count() == 0 for name in warehouse.specs)


def test_a_table_changed_meanwhile_refuses_the_load(spark, root, tmp_path, monkeypatch):
    warehouse = stored_star(spark, root)
    real = load_module._totals

    def meanwhile(warehouse, name, path):
        more = spark.createDataFrame([(7, "Cook")], warehouse.read("jobs").schema)
        warehouse.publish("jobs", warehouse.stage("jobs", more), "other")
        return real(warehouse, name, path)

    monkeypatch.setattr(load_module, "_totals", meanwhile)
    with pytest.raises(ConcurrentWrite):
        load_history(warehouse, {"jobs": history_file(tmp_path, "j.csv", ["7,Baker"])})
    assert (7, "Cook") in rows(warehouse.read("jobs"))


def test_many_unreadable_and_repeated_keys_without_broadcast(spark, root, tmp_path, no_broadcast):
    lines = [fact_line(f"x{i}") for i in range(300)] + [fact_line("5", f"n{i}") for i in range(300)] + [fact_line("6")]
    warehouse = stored_star(spark, root)
    load_history(warehouse, {"hired_employees": history_file(tmp_path, "h.csv", lines)})
    assert sorted((r["id"], r["name"]) for r in warehouse.read("hired_employees").collect()) == [(5, "n0"), (6, "Ann")]
    codes = warehouse.log("hired_employees", REJECTED_LINES).groupBy("reason_code").count().collect()
    assert {r["reason_code"]: r["count"] for r in codes} == {"BAD_VALUE": 300, "DUPLICATE_KEY": 299}


def test_fact_waits_for_its_parents(spark, root):
    warehouse = Warehouse(spark, root)
    waves = load_module._waves(warehouse, {name: "" for name in warehouse.specs})
    assert [sorted(s.name for s in wave) for wave in waves] == [["departments", "jobs"], ["hired_employees"]]


def test_the_callers_list_decides_which_line_is_first(spark, root, tmp_path):
    paths = [history_file(tmp_path, "z.csv", ["1,of z"]), history_file(tmp_path, "a.csv", ["1,of a", "2,more"])]
    warehouse = Warehouse(spark, root)
    load_history(warehouse, {"jobs": paths})
    assert rows(warehouse.read("jobs")) == [(1, "of z"), (2, "more")]
    assert [r["line"] for r in warehouse.log("jobs", REJECTED_LINES).collect()] == ["1,of a"]


ESCAPED = ["1,a\\", "b", "2,plain", "3,\\", "\\\\\\", "\\", "end", "4,pair\\\\", "5,last\\"]
"""As lines of a file: open, its rest, whole, three open ones in a row and their rest, an escaped backslash, open at the end."""


@pytest.mark.parametrize("splits", [1, 3, 18])
def test_escaped_line_ends_over_splits(spark, root, tmp_path, splits):
    lines = [line for k in range(40) for line in ESCAPED[:-1]] + ESCAPED[-1:]
    for i, line in enumerate(lines):
        if line[0].isdigit():
            lines[i] = f"{i},{line.split(',', 1)[1]}"
    paths = [history_file(tmp_path, "in/a.csv", lines), history_file(tmp_path, "in/b.csv", ["900,\\", "x", "901,y"])]
    size = (tmp_path / "in/a.csv").stat().st_size
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(-(-size // splits)))
    try:
        found = read_delimited(spark, paths, JOBS)
        assert found.select("src_file", "src_block").distinct().count() >= splits
        direct = {r["id"]: r["job"] for r in found.collect()}
        warehouse = Warehouse(spark, root)
        load_history(warehouse, {"jobs": paths})
        loaded = {r["id"]: r["job"] for r in warehouse.read("jobs").collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    want = {900: "\r\nx", 901: "y", len(lines) - 1: "last\\"}
    for k in range(0, len(lines) - 1, 8):
        want |= {k: "a\r\nb", k + 2: "plain", k + 3: "\r\n\\\r\n\r\nend", k + 7: "pair\\"}
    assert direct == loaded == want


def test_every_line_open_is_one_record(spark, tmp_path):
    path = history_file(tmp_path, "j.csv", ["1,a\\"] + ["b\\"] * 300 + ["c"])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100")
    try:
        found = read_delimited(spark, path, JOBS).select("id", "job").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [tuple(r) for r in found] == [(1, "a\r\n" + "b\r\n" * 300 + "c")]


def test_other_separators_and_line_ends_with_escapes(spark, tmp_path):
    path = history_file(tmp_path, "k.csv", ["1;a\\", r"b\;c", "2;d"], "\n")
    assert rows(read_delimited(spark, path, JOBS, ";", "\n").select("id", "job")) == [(1, "a\nb;c"), (2, "d")]


@pytest.mark.parametrize("limit", ["10MB", "-1"])
def test_whole_lines_are_shuffled_once(spark, root, tmp_path, limit):
    lines = [f"{k % 900},v{k}" for k in range(1000)]
    warehouse = Warehouse(spark, root)
    warehouse.create()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        run = warehouse.staging("plan")
        records = load_module._records(warehouse, JOBS, history_file(tmp_path, "j.csv", lines), run)
        out = load_module.judged_lines(warehouse, JOBS, records, {}, AT, run)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert out.where("verdict = 'accepted'").count() == 900
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    moved = [line for line in plan.splitlines() if "Exchange" in line and "Broadcast" not in line]
    with_lines = [line for line in moved if "_place" in line or "REBALANCE" in line]
    assert len(with_lines) == 1
