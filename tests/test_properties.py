"""Rules that hold for any input, against plain Python."""

import json

from helpers import bodies, rows, stored_star
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starload.functions.text import ESCAPES, read_fields
from starload.plans.ingest import ingest_requests
from starload.plans.reports import group_counts, quarterly_counts
from starload.sources.avro import read_avro, write_avro
from starload.spec import JOBS
from pyspark.sql import types as T

few = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

field_text = st.text(st.sampled_from(list(",\\Nnrtb0Za \"é\n")), max_size=12)


def escape(value: str | None) -> str:
    if value is None:
        return r"\N"
    return value.replace("\\", "\\\\").replace(",", "\\,")


@few
@given(st.lists(st.lists(st.one_of(st.none(), field_text), min_size=1, max_size=5), min_size=1, max_size=30))
def test_escaped_fields_come_back(spark, lines):
    """A written line gives its fields back, whatever they hold."""
    data = [(i, ",".join(escape(f) for f in line)) for i, line in enumerate(lines)]
    read = spark.createDataFrame(data, "i int, v string").select("i", read_fields(F.col("v")).alias("f")).collect()
    assert {r["i"]: r["f"] for r in read} == dict(enumerate(lines))


@few
@given(st.lists(st.text(st.sampled_from(list(",\\Nnrtb0Zx")), max_size=14), min_size=1, max_size=30))
def test_any_line_reads_as_a_scan_would(spark, lines):
    def scan(line: str) -> list:
        fields, raw, value, i = [], "", "", 0
        while i <= len(line):
            if i == len(line) or line[i] == ",":
                fields.append(None if raw == r"\N" else value)
                raw, value, i = "", "", i + 1
            elif line[i] == "\\" and i + 1 < len(line):
                raw += line[i : i + 2]
                value += ESCAPES.get(line[i + 1], line[i + 1])
                i += 2
            else:
                raw += line[i]
                value += line[i]
                i += 1
        return fields

    read = spark.createDataFrame(list(enumerate(lines)), "i int, v string").select("i", read_fields(F.col("v")).alias("f"))
    assert {r["i"]: r["f"] for r in read.collect()} == {i: scan(line) for i, line in enumerate(lines)}


record = st.fixed_dictionaries(
    {
        "name": st.sampled_from(["Ann", "", " ", "n" * 256]),
        "hire_datetime": st.sampled_from(["2021-05-05", "2021-02-30", "", "2021-05-05T10:00:00Z"]),
        "department_id": st.integers(-1, 3),
        "job_id": st.integers(0, 3),
    }
)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(record, max_size=6), min_size=1, max_size=6))
def test_accepted_and_rejected_are_the_input(spark, tmp_path_factory, requests):
    warehouse = stored_star(spark, f"file:{tmp_path_factory.mktemp('w')}")
    named = {f"r{i}": json.dumps({"registros": r}) for i, r in enumerate(requests)}
    result = ingest_requests(warehouse, "hired_employees", bodies(spark, **named), max_rows=5)

    def good(r: dict, size: int) -> bool:
        return (
            size <= 5 and r["name"] in ("Ann", " ") and r["hire_datetime"] in ("2021-05-05", "2021-05-05T10:00:00Z")
            and r["department_id"] in (1, 2) and r["job_id"] in (1, 2)
        )

    kept = sum(good(r, len(rs)) for rs in requests for r in rs)
    assert result.accepted.count() == kept
    assert result.rejected.count() == sum(map(len, requests)) - kept
    for r in result.summary.collect():
        rs = requests[int(r["request_id"][1:])]
        assert r["inserted"] == sum(good(x, len(rs)) for x in rs)
        assert r["inserted"] + r["failed"] == len(rs)
    assert sorted(r["id"] for r in result.accepted.collect()) == list(range(1, kept + 1))


@few
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.integers(0, 3), st.integers(0, 800)), max_size=60))
def test_quarters_sum_to_the_joined_rows(spark, hires):
    data = [(i, d, j, n) for i, (d, j, n) in enumerate(hires)]
    fact = spark.createDataFrame(data, "id int, department_id int, job_id int, n int").withColumn(
        "hire_datetime", F.expr("timestamp_ntz'2020-06-01 00:00:00' + make_dt_interval(n)")
    )
    departments = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "id int, department string")
    jobs = spark.createDataFrame([(1, "x"), (2, "y")], "id int, job string")
    report = quarterly_counts(fact, departments, jobs, 2021).collect()
    in_2021 = [(d, j) for d, j, n in hires if 214 <= n < 579]
    assert sum(r["Q1"] + r["Q2"] + r["Q3"] + r["Q4"] for r in report) == sum(d in (1, 2, 3) and j in (1, 2) for d, j in in_2021)
    assert sum(r["hired"] for r in group_counts(fact, departments, 2021).collect()) == sum(d in (1, 2, 3) for d, _ in in_2021)


@few
@given(st.lists(st.tuples(st.integers(-(2**31), 2**31 - 1), st.text(max_size=40)), min_size=1, max_size=40))
def test_avro_gives_back_what_was_written(spark, tmp_path_factory, data):
    folder = f"file:{tmp_path_factory.mktemp('a')}/t"
    clean = [(i, s.encode("utf-8", "ignore").decode()) for i, s in data]
    df = spark.createDataFrame(clean, T.StructType([T.StructField(f.name, f.dataType) for f in JOBS.schema]))
    write_avro(df, folder, "jobs", JOBS.schema)
    assert rows(read_avro(spark, folder, JOBS.schema)) == rows(df)
