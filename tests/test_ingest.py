import json
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

import pytest
from helpers import bodies, hire, request, rows, stored_star
from pyspark.sql import functions as F

from starload.plans.ingest import REJECTED_ROWS, ingest, ingest_requests
from starload.sources.requests import read_requests, request_rows
from starload.spec import HIRED_EMPLOYEES, STAR
from starload.streaming.ingest_stream import ingest_stream

AT = datetime(2021, 5, 5, 1, 2, 3)
TABLE = "hired_employees"


def summary(result) -> dict:
    return {r["request_id"]: (r["status"], r["inserted"], r["failed"]) for r in result.summary.collect()}


def codes(result) -> dict:
    return {(r["request_id"], r["ordinal"]): r["reason_code"] for r in result.rejected.collect()}


def test_good_and_bad_rows(spark, root):
    warehouse = stored_star(spark, root)
    body = request(
        hire(), hire(name=""), hire(name="  "), hire(department_id=0), hire(job_id=0), hire(hire_datetime=""),
        hire(department_id=8), hire(job_id=8), hire(department_id=8, job_id=8), hire(hire_datetime="2021-02-30"),
        hire(name="n" * 256), hire(name="n" * 255), hire(name="", department_id=8), hire(name="n" * 256, hire_datetime="x"),
    )
    result = ingest_requests(warehouse, TABLE, bodies(spark, a=body))
    assert summary(result) == {"a": ("OK", 3, 11)}
    assert codes(result) == {
        ("a", 1): "MISSING_FIELD", ("a", 3): "MISSING_FIELD", ("a", 4): "MISSING_FIELD", ("a", 5): "MISSING_FIELD",
        ("a", 6): "FOREIGN_KEY", ("a", 7): "FOREIGN_KEY", ("a", 8): "FOREIGN_KEY", ("a", 9): "BAD_DATETIME",
        ("a", 10): "TOO_LONG", ("a", 12): "MISSING_FIELD", ("a", 13): "TOO_LONG",
    }
    assert rows(warehouse.read(TABLE)) == [
        (1, "Ann", AT, 1, 1), (2, "  ", AT, 1, 1), (3, "n" * 255, AT, 1, 1),
    ]


def test_reason_names_both_ids(spark, root):
    result = ingest_requests(stored_star(spark, root), TABLE, bodies(spark, a=request(hire(department_id=8, job_id=2))))
    row = result.rejected.first()
    assert row["reason"] == "not found: department_id 8 or job_id 2"
    assert row["logged_at"] is not None


@pytest.mark.parametrize(
    "body",
    [
        "not json", "", "[]", "7", "{}", '{"registros": 3}', '{"registros": null}', '{"registros": [7]}',
        request({k: v for k, v in hire().items() if k != "job_id"}),
        request(hire(), {**hire(), "name": None}),
        request({**hire(), "name": 5}),
        request({**hire(), "job_id": "one"}),
        request({**hire(), "job_id": 1.5}),
        request({**hire(), "job_id": [1]}),
    ],
)
def test_malformed_request_is_refused_whole(spark, body):
    out = request_rows(bodies(spark, a=body), HIRED_EMPLOYEES).collect()
    assert [(r["ordinal"], r["request_status"]) for r in out] == [(None, "MALFORMED")]


@pytest.mark.parametrize("value, read", [("7", 7), (" 7 ", 7), (2.0, 2), (True, 1), (False, 0), (-3, -3), (10**30, None)])
def test_whole_numbers(spark, value, read):
    out = request_rows(bodies(spark, a=request({**hire(), "job_id": value, "other": [1]})), HIRED_EMPLOYEES).first()
    assert (out["job_id"], out["request_status"]) == (read, "OK")


def test_numbers_beyond_64_bits_refuse_their_row_and_keep_their_text(spark, root):
    warehouse = stored_star(spark, root)
    body = request(hire(), hire(department_id=10**23), hire(job_id=-(10**35)), hire(department_id=" 2 "))
    result = ingest_requests(warehouse, TABLE, bodies(spark, a=body))
    assert summary(result) == {"a": ("OK", 2, 2)}
    assert {r["ordinal"]: r["reason"] for r in result.rejected.collect()} == {
        1: f"not found: department_id {10**23} or job_id 1", 2: f"not found: department_id 1 or job_id {-(10**35)}",
    }
    wide = ingest_requests(warehouse, TABLE, bodies(spark, a=request(hire(department_id=10**60))))
    assert codes(wide) == {("a", 0): "FOREIGN_KEY"}


def test_rows_that_do_not_fit_are_refused_one_by_one(spark, root):
    """No ordinal, numbers with a fraction, as text or as none, and a field the caller does not have."""
    warehouse = stored_star(spark, root)
    schema = "request_id string, ordinal int, name string, hire_datetime string, department_id string, job_id double"
    given = [
        ("a", 0, "Ann", "2021-01-01", "1", 1.0), ("a", 1, "Ann", "2021-01-01", "1.7", 1.0), ("a", 2, "Ann", "2021-01-01", "x", 1.0),
        ("a", 3, "Ann", "2021-01-01", "1", float("nan")), ("a", 4, "Ann", "2021-01-01", "9" * 30, 1.0), ("a", None, "Bob", "2021-01-01", "2", 2.0),
        ("a", None, "", "2021-01-01", "2", 2.0),
    ]
    result = ingest(warehouse, TABLE, spark.createDataFrame(given, schema))
    assert summary(result) == {"a": ("OK", 2, 5)}
    assert codes(result) == {
        ("a", 1): "BAD_VALUE", ("a", 2): "BAD_VALUE", ("a", 3): "BAD_VALUE", ("a", 4): "FOREIGN_KEY", ("a", None): "MISSING_FIELD",
    }
    assert {r["ordinal"]: r["unread"] for r in result.rejected.collect()}[1] == {"department_id": "1.7"}
    assert sorted(r["name"] for r in result.accepted.collect()) == ["Ann", "Bob"]
    lacking = ingest(warehouse, TABLE, spark.createDataFrame(given[:1], schema).drop("job_id"))
    assert codes(lacking) == {("a", 0): "MISSING_FIELD"}


def test_the_callers_rows_are_read_once(spark, root, no_broadcast):
    """Two parents too large to broadcast ask for keys of what was written, not for the input again."""
    warehouse = stored_star(spark, root)
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def watched(text):
        seen.add(1)
        return text

    given = spark.range(100).select(
        F.lit("a").alias("request_id"), F.col("id").cast("int").alias("ordinal"), watched(F.lit("Ann")).alias("name"),
        F.lit("2021-01-01").alias("hire_datetime"), (F.col("id") % 4).alias("department_id"), (F.col("id") % 3).alias("job_id"),
    )
    result = ingest(warehouse, TABLE, given)
    assert result.accepted.count() == sum(1 for i in range(100) if i % 4 in (1, 2) and i % 3 in (1, 2))
    assert seen.value == 100


def test_a_dimensions_numbered_rows_stay_in_the_tasks_that_read_them(spark, root, monkeypatch):
    """Of the rows to store only the even files are shuffled; nothing is sorted by file or sent to every task."""
    warehouse = stored_star(spark, root)
    plans, stage = [], warehouse.stage

    def watched(name, rows, *args, **kwargs):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return stage(name, rows, *args, **kwargs)

    monkeypatch.setattr(warehouse, "stage", watched)
    given = spark.range(500).select(
        F.expr("cast(id div 50 as string) AS request_id"), F.col("id").cast("int").alias("ordinal"), F.lit("Cook").alias("job")
    )
    result = ingest(warehouse, "jobs", given)
    assert sorted(r["id"] for r in result.accepted.collect()) == list(range(3, 503))
    assert len(plans) == 1 and "Sort" not in plans[0]
    assert "FileScan" not in plans[0][plans[0].index("BroadcastExchange") :]


def test_writers_at_the_same_time_give_out_distinct_ids(spark, root):
    warehouse = stored_star(spark, root)
    body = bodies(spark, a=request(*[hire()] * 4))
    with ThreadPoolExecutor(3) as pool:
        results = list(pool.map(lambda n: ingest_requests(warehouse, TABLE, body, f"w{n}"), range(3)))
    assert sorted(r["id"] for r in warehouse.read(TABLE).collect()) == list(range(1, 13))
    assert [r.accepted.count() for r in results] == [4, 4, 4]


def test_a_writer_that_dies_before_its_commit_leaves_the_table(spark, root, monkeypatch):
    warehouse = stored_star(spark, root, hires=[(41, "Old", AT, 1, 1)])

    def die(*args):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(warehouse.commits, "change", die)
        patch.setattr(warehouse, "clear", lambda path: None)  # nor does it tidy up
        with pytest.raises(KeyboardInterrupt):
            ingest_requests(warehouse, TABLE, bodies(spark, a=request(hire(), hire(name=""))), "b1")
    assert len(warehouse.files.names(warehouse.home(TABLE))) == 2
    assert (warehouse.read(TABLE).count(), warehouse.max_id(TABLE), warehouse.log(TABLE, REJECTED_ROWS)) == (1, 41, None)


def test_request_sizes(spark, root):
    """0, 1, 1000 and 1001 rows: too many refuses the whole request, an empty one reports 0 and 0."""
    warehouse = stored_star(spark, root)
    requests = bodies(
        spark, none=request(), one=request(hire()), full=request(*[hire()] * 1000), over=request(*[hire()] * 1001)
    )
    result = ingest_requests(warehouse, TABLE, requests)
    assert summary(result) == {
        "none": ("OK", 0, 0), "one": ("OK", 1, 0), "full": ("OK", 1000, 0), "over": ("TOO_MANY_ROWS", 0, 1001),
    }
    assert warehouse.read(TABLE).count() == 1001
    assert set(codes(result).values()) == {"TOO_MANY_ROWS"}


def test_ids_follow_the_rows_of_a_request_and_the_stored_ids(spark, root):
    warehouse = stored_star(spark, root, hires=[(41, "Old", AT, 1, 1)])
    names = [f"n{i}" for i in range(50)]
    result = ingest_requests(warehouse, TABLE, bodies(spark, a=request(*[hire(name=n) for n in names])))
    assert [(r["id"], r["name"]) for r in result.accepted.orderBy("id").collect()] == list(zip(range(42, 92), names))
    again = ingest_requests(warehouse, TABLE, bodies(spark, a=request(hire(name="next"))))
    assert again.accepted.first()["id"] == 92


def test_same_request_again_is_stored_again_but_a_replay_is_not(spark, root):
    warehouse = stored_star(spark, root)
    body = bodies(spark, a=request(hire(), hire(name="")))
    first = ingest_requests(warehouse, TABLE, body, "b1")
    replay = ingest_requests(warehouse, TABLE, body, "b1")
    assert summary(first) == summary(replay) == {"a": ("OK", 1, 1)}
    assert warehouse.read(TABLE).count() == 1
    ingest_requests(warehouse, TABLE, body, "b2")
    assert warehouse.read(TABLE).count() == 2
    warehouse.compact(TABLE)
    ingest_requests(warehouse, TABLE, body, "b2")
    assert warehouse.read(TABLE).count() == 2
    assert warehouse.log(TABLE, REJECTED_ROWS).count() == 2


def test_replay_after_a_failure_before_publishing(spark, root, monkeypatch):
    warehouse = stored_star(spark, root)
    body = bodies(spark, a=request(hire(), hire(name="")))

    def fail(*args):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(warehouse, "publish_all", fail)
        with pytest.raises(OSError):
            ingest_requests(warehouse, TABLE, body, "b1")
    assert warehouse.read(TABLE).count() == 0
    result = ingest_requests(warehouse, TABLE, body, "b1")
    assert summary(result) == {"a": ("OK", 1, 1)}
    assert warehouse.read(TABLE).count() == 1
    assert warehouse.log(TABLE, REJECTED_ROWS).count() == 1


def test_batch_without_good_rows(spark, root):
    warehouse = stored_star(spark, root)
    result = ingest_requests(warehouse, TABLE, bodies(spark, a=request(hire(name=""))), "b1")
    assert (result.accepted.count(), summary(result)) == (0, {"a": ("OK", 0, 1)})
    assert warehouse.has_batch(TABLE, "b1")
    assert warehouse.max_id(TABLE) == 0


def test_key_beyond_its_type_is_refused(spark, root):
    warehouse = stored_star(spark, root, hires=[(2**31 - 2, "Last", AT, 1, 1)])
    with pytest.raises(OverflowError):
        ingest_requests(warehouse, TABLE, bodies(spark, a=request(hire(), hire())))
    wide = stored_star(spark, root + "-wide", [s.widened() for s in STAR], [(2**31 - 2, "Last", AT, 1, 1)])
    result = ingest_requests(wide, TABLE, bodies(spark, a=request(hire(), hire())))
    assert sorted(r["id"] for r in result.accepted.collect()) == [2**31 - 1, 2**31]


def test_rows_as_dataframe_and_other_tables(spark, root):
    warehouse = stored_star(spark, root)
    incoming = spark.createDataFrame(
        [("a", 0, "Baker"), ("a", 1, ""), ("a", 2, "b" * 256), ("b", 0, "One"), ("b", 1, "Two"), ("b", 2, "Three"), ("b", 3, "Four")],
        "request_id string, ordinal int, job string",
    )
    result = ingest(warehouse, "jobs", incoming, max_rows=3)
    assert summary(result) == {"a": ("OK", 1, 2), "b": ("TOO_MANY_ROWS", 0, 4)}
    assert rows(result.accepted) == [(3, "Baker")]


def test_requests_from_files_have_distinct_ids(spark, tmp_path):
    line = request(hire())
    (tmp_path / "a.json").write_text("\n".join([line] * 3) + "\n")
    (tmp_path / "b.json").write_text(line + "\n")
    read = read_requests(spark, f"file:{tmp_path}")
    assert read.select("request_id").distinct().count() == 4


def test_files_of_one_name_and_blank_lines(spark, tmp_path):
    for day in (1, 2):
        (tmp_path / f"day={day}").mkdir()
        (tmp_path / f"day={day}/req.json").write_text(request(hire(), hire()) + "\n\n")
    read = read_requests(spark, f"file:{tmp_path}")
    assert read.count() == read.select("request_id").distinct().count() == 2


def test_a_replay_reads_nothing_and_leaves_no_scratch(spark, root):
    warehouse = stored_star(spark, root)
    schema = "request_id string, ordinal int, name string, hire_datetime string, department_id bigint, job_id bigint"
    given = spark.createDataFrame([("a", 0, "Ann", "2021-05-05 01:02:03", 1, 1)], schema)
    ingest(warehouse, "hired_employees", given, "one")
    assert ingest(warehouse, "hired_employees", given.where(F.raise_error(F.lit("read")).cast("boolean")), "one").accepted.count() == 1
    assert warehouse.files.names(f"{root}/staging") == []


def test_a_request_over_several_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"registros": [hire(), hire()]}, indent=2))
    read = read_requests(spark, f"file:{tmp_path}", wholetext="true")
    assert [r["request_status"] for r in request_rows(read, HIRED_EMPLOYEES).collect()] == ["OK", "OK"]


def test_one_department_in_most_rows(spark, root):
    """A hot key, and parents both below and above the broadcast threshold."""
    warehouse = stored_star(spark, root)
    incoming = spark.range(6000).select(
        F.expr("cast(id div 500 as string)").alias("request_id"),
        (F.col("id") % 500).cast("int").alias("ordinal"),
        F.lit("n").alias("name"),
        F.lit("2021-01-01").alias("hire_datetime"),
        F.when(F.col("id") % 3 != 0, 1).otherwise(F.col("id") % 7).cast("bigint").alias("department_id"),
        F.lit(2).cast("bigint").alias("job_id"),
    )
    expected = sum(1 for i in range(6000) if (1 if i % 3 else i % 7) in (1, 2))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for threshold in (before, "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            assert ingest(warehouse, TABLE, incoming).accepted.count() == expected
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_stream_of_request_files(spark, root, tmp_path):
    warehouse = stored_star(spark, root)
    inbox, checkpoint = tmp_path / "inbox", f"file:{tmp_path}/checkpoint"
    inbox.mkdir()
    seen = []

    def run():
        ingest_stream(
            warehouse, TABLE, f"file:{inbox}", checkpoint, on_batch=lambda r: seen.append(r.batch_id), maxFilesPerTrigger="1"
        ).awaitTermination()

    for n in range(3):
        (inbox / f"{n}.json").write_text(request(hire(name=f"f{n}"), hire(name="")) + "\n" + request(hire(name="g")) + "\n")
    run()
    assert len(seen) == len(set(seen)) == 3
    assert warehouse.read(TABLE).count() == 6
    (inbox / "late.json").write_text(request(hire(name="late")))
    run()
    run()
    stored = warehouse.read(TABLE).collect()
    assert sorted(r["id"] for r in stored) == list(range(1, 8))
    assert sorted(r["name"] for r in stored) == ["f0", "f1", "f2", "g", "g", "g", "late"]


def test_stream_replays_a_batch_once(spark, root, tmp_path):
    """The micro-batch is stored but its commit is lost; the restarted stream adds nothing."""
    warehouse = stored_star(spark, root)
    inbox, checkpoint = tmp_path / "inbox", tmp_path / "checkpoint"
    inbox.mkdir()
    (inbox / "a.json").write_text(request(hire()))

    def crash(result):
        raise RuntimeError("after publishing")

    with pytest.raises(Exception, match="after publishing"):
        ingest_stream(warehouse, TABLE, f"file:{inbox}", f"file:{checkpoint}", on_batch=crash).awaitTermination()
    assert warehouse.read(TABLE).count() == 1
    ingest_stream(warehouse, TABLE, f"file:{inbox}", f"file:{checkpoint}").awaitTermination()
    assert warehouse.read(TABLE).count() == 1


def test_request_body_is_json_of_the_old_service(spark, root):
    body = json.dumps({"registros": [{"name": "Zoë", "hire_datetime": "2021-11-07T02:48:42Z", "department_id": 2, "job_id": 1}]})
    result = ingest_requests(stored_star(spark, root), TABLE, bodies(spark, a=body))
    assert rows(result.accepted) == [(1, "Zoë", datetime(2021, 11, 7, 2, 48, 42), 2, 1)]
