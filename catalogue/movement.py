"""Load, ingest, stream, snapshot and restore end to end. Each query works in a fresh warehouse folder."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue.reports import QUARTER_SQL
from catalogue.tables import HIRES_SQL, PARENTS_SQL, hires, nations, solvent_customers, table
from starload.functions.times import datetime_text
from starload.plans.ingest import IngestResult, ingest, ingest_requests
from starload.plans.load import REJECTED_LINES, load_history
from starload.plans.reports import above_mean_groups, quarterly_counts
from starload.plans.snapshot import backup, restore
from starload.session import fresh_dir
from starload.sources.delimited import read_delimited
from starload.spec import DEPARTMENTS, HIRED_EMPLOYEES, STAR
from starload.streaming.ingest_stream import ingest_stream
from starload.warehouse import Warehouse

WIDE_STAR = [spec.widened() for spec in STAR]
HIRE_COLUMNS = ["name", "hire_datetime", "department_id", "job_id"]


def _write_lines(rows: DataFrame, path: str) -> str:
    """A history file: comma, CRLF, empty text for null."""
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in rows.columns]
    rows.select(F.concat_ws(",", *texts)).write.option("lineSep", "\r\n").text(path)
    return path


def _warehouse(spark: SparkSession, label: str) -> Warehouse:
    return Warehouse(spark, fresh_dir(spark, label), WIDE_STAR)


def _with_dimensions(spark: SparkSession, sf: str, label: str) -> Warehouse:
    """Dimensions stored, fact empty."""
    warehouse = _warehouse(spark, label)
    warehouse.create()
    warehouse.publish("departments", warehouse.stage("departments", solvent_customers(spark, sf)), "given")
    jobs = nations(spark, sf).select(F.col("id").cast("bigint").alias("id"), "job")
    warehouse.publish("jobs", warehouse.stage("jobs", jobs), "given")
    return warehouse


# -- history files --------------------------------------------------------------------------------


def csv_load_dim(spark: SparkSession, sf: str) -> DataFrame:
    """Customers through a history file; names get a comma and a backslash, escaped in the file."""
    folder = fresh_dir(spark, "csv")
    names = F.concat("c_name", F.lit("\\, \\\\"), "c_mktsegment")
    path = _write_lines(table(spark, sf, "customer").select("c_custkey", names), folder)
    return read_delimited(spark, path, DEPARTMENTS.widened()).select("id", "department")


def csv_load_fact(spark: SparkSession, sf: str) -> DataFrame:
    """Hires through a history file: ISO datetimes with T and Z, empty names."""
    iso = F.concat(F.replace(datetime_text(F.col("hire_datetime")), F.lit(" "), F.lit("T")), F.lit("Z"))
    rows = hires(spark, sf).select("id", "name", iso, "department_id", "job_id")
    path = _write_lines(rows, fresh_dir(spark, "csv"))
    return read_delimited(spark, path, HIRED_EMPLOYEES.widened()).select("id", *HIRE_COLUMNS)


def _load(spark: SparkSession, sf: str) -> Warehouse:
    """Two hire files: all hires with bad dates and bad ids put in, then the urgent ones once more."""
    folder = fresh_dir(spark, "history")
    rows = hires(spark, sf).select("id", "name", datetime_text(F.col("hire_datetime")).alias("at"), "department_id", "job_id")
    first = rows.withColumn("at", F.when(F.col("id") % 17 == 0, "2021-02-30").otherwise(F.col("at")))
    first = first.withColumn("id", F.when(F.col("id") % 41 == 0, F.concat(F.lit("x"), "id")).otherwise(F.col("id").cast("string")))
    again = rows.where("name = '1-URGENT'").withColumn("name", F.lit("again"))
    paths = {
        "departments": _write_lines(solvent_customers(spark, sf), f"{folder}/departments"),
        "jobs": _write_lines(nations(spark, sf), f"{folder}/jobs"),
        "hired_employees": [_write_lines(first, f"{folder}/hires/a"), _write_lines(again, f"{folder}/hires/b")],
    }
    warehouse = _warehouse(spark, "loaded")
    load_history(warehouse, paths)
    return warehouse


LOADED_SQL = f"""WITH {HIRES_SQL},
{PARENTS_SQL},
lines AS (
  SELECT 1 AS file, *, id % 17 = 0 AS bad_date, id % 41 = 0 AS bad_id FROM hires
  UNION ALL
  SELECT 2, id, 'again', hire_datetime, department_id, job_id, FALSE, FALSE FROM hires
  WHERE name = '1-URGENT'),
checked AS (
  SELECT *, CASE WHEN bad_date THEN 'BAD_DATETIME' WHEN bad_id THEN 'BAD_VALUE'
                 WHEN department_id NOT IN (SELECT id FROM departments) OR job_id NOT IN (SELECT id FROM jobs)
                   THEN 'FOREIGN_KEY' END AS broken FROM lines),
judged AS (
  SELECT *, CASE WHEN broken IS NULL AND ROW_NUMBER() OVER (PARTITION BY id, broken IS NULL ORDER BY file) > 1
                 THEN 'DUPLICATE_KEY' ELSE broken END AS reason_code FROM checked),
stored AS (
  SELECT id, NULLIF(name, '') AS name, hire_datetime, department_id, CAST(job_id AS BIGINT) AS job_id
  FROM judged WHERE reason_code IS NULL)
"""


def history_load(spark: SparkSession, sf: str) -> DataFrame:
    return _load(spark, sf).read("hired_employees")


def history_load_rejects(spark: SparkSession, sf: str) -> DataFrame:
    rejected = _load(spark, sf).log("hired_employees", REJECTED_LINES)
    return rejected.groupBy("reason_code").agg(F.count(F.lit(1)).alias("rows"))


def load_twice(spark: SparkSession, sf: str) -> DataFrame:
    """The second load of the same lines adds nothing."""
    folder = fresh_dir(spark, "history")
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("department"))
    path = _write_lines(customers, folder)
    warehouse = _warehouse(spark, "twice")
    first = load_history(warehouse, {"departments": path})
    second = load_history(warehouse, {"departments": path})
    rows = warehouse.read("departments").agg(F.count(F.lit(1)).alias("rows"), F.max("id").alias("max_id"))
    return rows.withColumn("first_load", F.lit(first.stored("departments")).cast("bigint")).withColumn(
        "second_load", F.lit(second.stored("departments")).cast("bigint")
    )


# -- reports over stored tables -------------------------------------------------------------------


def stored_quarterly_counts(spark: SparkSession, sf: str) -> DataFrame:
    """The report over loaded tables, reading only the folders of its year."""
    warehouse = _load(spark, sf)
    return quarterly_counts(
        warehouse.read("hired_employees", 1997), warehouse.read("departments"), warehouse.read("jobs"), 1997
    )


def stored_above_mean_groups(spark: SparkSession, sf: str) -> DataFrame:
    warehouse = _load(spark, sf)
    return above_mean_groups(warehouse.read("hired_employees", 1997), warehouse.read("departments"), 1997)


# -- requests -------------------------------------------------------------------------------------


def _bodies(spark: SparkSession, sf: str) -> DataFrame:
    """JSON requests of 200 hires; every seventh takes in its successor, and some lack a field.

    A request holds at most 400 rows whatever the table's size, so gathering one is bounded.
    """
    block = F.expr("id div 200")
    request = F.when(block % 7 == 4, block - 1).otherwise(block)
    rows = hires(spark, sf).withColumn("request", request)
    lacking = (F.col("request") % 13 == 5) & (F.col("id") % 200 == 7)
    record = F.struct(
        "name",
        datetime_text(F.col("hire_datetime")).alias("hire_datetime"),
        F.when(~lacking, F.col("department_id")).alias("department_id"),
        F.col("job_id"),
    )
    gathered = rows.groupBy(F.col("request").cast("string").alias("request_id")).agg(
        F.array_sort(F.collect_list(F.struct("id", record.alias("record")))).alias("records")
    )
    body = F.to_json(F.struct(F.col("records.record").alias("registros")))
    return gathered.select("request_id", body.alias("body"))


REQUESTS_SQL = f"""WITH {HIRES_SQL},
{PARENTS_SQL},
requests AS (
  SELECT *, CASE WHEN (id // 200) % 7 = 4 THEN id // 200 - 1 ELSE id // 200 END AS request FROM hires),
marked AS (
  SELECT *, COUNT(*) OVER (PARTITION BY request) > 300 AS refused,
         bool_or(request % 13 = 5 AND id % 200 = 7) OVER (PARTITION BY request) AS malformed FROM requests),
judged AS (
  SELECT *, CASE WHEN malformed THEN 'MALFORMED' WHEN refused THEN 'TOO_MANY_ROWS'
                 WHEN name = '' OR department_id = 0 OR job_id = 0 THEN 'MISSING_FIELD'
                 WHEN department_id NOT IN (SELECT id FROM departments) OR job_id NOT IN (SELECT id FROM jobs)
                   THEN 'FOREIGN_KEY' END AS reason_code FROM marked)
"""
ACCEPTED_SQL = """SELECT name, hire_datetime, department_id, CAST(job_id AS BIGINT) AS job_id
FROM judged WHERE reason_code IS NULL"""


def _ingested(spark: SparkSession, sf: str) -> tuple[Warehouse, IngestResult]:
    warehouse = _with_dimensions(spark, sf, "requests")
    return warehouse, ingest_requests(warehouse, "hired_employees", _bodies(spark, sf), max_rows=300)


def ingested_rows(spark: SparkSession, sf: str) -> DataFrame:
    return _ingested(spark, sf)[1].accepted.select(*HIRE_COLUMNS)


def ingested_requests(spark: SparkSession, sf: str) -> DataFrame:
    return _ingested(spark, sf)[1].summary


def ingested_rejects(spark: SparkSession, sf: str) -> DataFrame:
    rejected = _ingested(spark, sf)[1].rejected
    return rejected.groupBy("request_id", "reason_code").agg(F.count(F.lit(1)).alias("rows"))


def ingested_ids(spark: SparkSession, sf: str) -> DataFrame:
    """The same requests twice and one of the batches replayed: ids go on without gap or repeat."""
    warehouse, _ = _ingested(spark, sf)
    for _ in range(2):
        ingest_requests(warehouse, "hired_employees", _bodies(spark, sf), batch_id="again", max_rows=300)
    return warehouse.read("hired_employees").agg(
        F.count(F.lit(1)).alias("rows"),
        F.countDistinct("id").alias("ids"),
        F.min("id").alias("min_id"),
        F.max("id").alias("max_id"),
    )


def ingested_dimension(spark: SparkSession, sf: str) -> DataFrame:
    """Requests for a dimension: the part names become jobs with fresh ids; empty names are refused."""
    warehouse = _warehouse(spark, "dimension")
    warehouse.create()
    rows = table(spark, sf, "part").select(
        F.expr("cast(p_partkey div 500 as string)").alias("request_id"),
        (F.col("p_partkey") % 500).cast("int").alias("ordinal"),
        F.when(F.col("p_size") > 45, "").otherwise(F.col("p_name")).alias("job"),
    )
    result = ingest(warehouse, "jobs", rows)
    return result.accepted.groupBy("job").agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("id").alias("ids"))


def streamed_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The same requests as files, one request per line, taken in by a stream of several micro-batches."""
    warehouse = _with_dimensions(spark, sf, "stream")
    inbox, checkpoint = fresh_dir(spark, "inbox"), fresh_dir(spark, "offsets")
    files = max(spark.sparkContext.defaultParallelism, 3)
    _bodies(spark, sf).select("body").repartition(files).write.text(inbox)
    query = ingest_stream(warehouse, "hired_employees", inbox, checkpoint, 300, maxFilesPerTrigger=str(files // 3 + 1))
    query.awaitTermination()
    return warehouse.read("hired_employees").select(*HIRE_COLUMNS)


# -- snapshots ------------------------------------------------------------------------------------


def _snapshot_source(spark: SparkSession, sf: str) -> Warehouse:
    warehouse = _warehouse(spark, "snapshot")
    warehouse.create()
    rows = hires(spark, sf).select(
        "id",
        F.when(F.col("id") % 5 != 0, F.concat("name", F.lit(" é\"✓"))).alias("name"),
        F.when(F.col("id") % 6 != 0, F.col("hire_datetime")).alias("hire_datetime"),
        F.when(F.col("id") % 7 != 0, F.col("department_id")).alias("department_id"),
        F.col("job_id").cast("bigint").alias("job_id"),
    )
    warehouse.publish("hired_employees", warehouse.stage("hired_employees", rows), "given")
    return warehouse


SNAPSHOT_SQL = f"""WITH {HIRES_SQL}
SELECT id, CASE WHEN id % 5 <> 0 THEN name || ' é"✓' END AS name,
       CASE WHEN id % 6 <> 0 THEN hire_datetime END AS hire_datetime,
       CASE WHEN id % 7 <> 0 THEN department_id END AS department_id, CAST(job_id AS BIGINT) AS job_id FROM hires"""


def snapshot_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Back up to Avro and restore into another warehouse."""
    source = _snapshot_source(spark, sf)
    path = backup(source, "hired_employees", f"{source.root}/backups", datetime(2025, 1, 2, 3, 4, 5))
    target = _warehouse(spark, "restored")
    target.create()
    restore(target, "hired_employees", path)
    return target.read("hired_employees")


def restore_replaces(spark: SparkSession, sf: str) -> DataFrame:
    """Back up, change the table, restore: the change is gone and new ids follow the restored ones."""
    warehouse = _snapshot_source(spark, sf)
    path = backup(warehouse, "hired_employees", f"{warehouse.root}/backups", datetime(2025, 1, 2, 3, 4, 5))
    extra = warehouse.read("hired_employees").withColumn("id", F.col("id") + 10_000_000).withColumn("name", F.lit("late"))
    warehouse.publish("hired_employees", warehouse.stage("hired_employees", extra), "late")
    restore(warehouse, "hired_employees", path)
    return warehouse.read("hired_employees").withColumn("largest", F.lit(warehouse.max_id("hired_employees")).cast("bigint"))


ENTRIES = {
    "csv_load_dim": (
        csv_load_dim,
        r"SELECT c_custkey AS id, c_name || ', \' || c_mktsegment AS department FROM customer",
    ),
    "csv_load_fact": (
        csv_load_fact,
        f"""WITH {HIRES_SQL}
SELECT id, NULLIF(name, '') AS name, hire_datetime, department_id, CAST(job_id AS BIGINT) AS job_id FROM hires""",
    ),
    "history_load": (history_load, LOADED_SQL + "SELECT * FROM stored"),
    "history_load_rejects": (
        history_load_rejects,
        LOADED_SQL + 'SELECT reason_code, COUNT(*) AS "rows" FROM judged WHERE reason_code IS NOT NULL GROUP BY reason_code',
    ),
    "load_twice": (
        load_twice,
        """SELECT COUNT(*) AS "rows", MAX(c_custkey) AS max_id, COUNT(*) AS first_load, CAST(0 AS BIGINT) AS second_load
FROM customer""",
    ),
    "stored_quarterly_counts": (
        stored_quarterly_counts,
        LOADED_SQL
        + f"""SELECT department, job,
       {QUARTER_SQL}
FROM stored f JOIN departments d ON f.department_id = d.id JOIN jobs j ON f.job_id = j.id
WHERE EXTRACT(year FROM hire_datetime) = 1997 GROUP BY department, job ORDER BY department, job""",
    ),
    "stored_above_mean_groups": (
        stored_above_mean_groups,
        LOADED_SQL
        + """, groups AS (
  SELECT d.id, d.department, COUNT(f.id) AS hired FROM stored f JOIN departments d ON f.department_id = d.id
  WHERE EXTRACT(year FROM hire_datetime) = 1997 GROUP BY d.id, d.department)
SELECT id, department, hired FROM groups WHERE hired > (SELECT AVG(hired) FROM groups) ORDER BY hired DESC, id""",
    ),
    "ingested_rows": (ingested_rows, REQUESTS_SQL + ACCEPTED_SQL),
    "ingested_requests": (
        ingested_requests,
        REQUESTS_SQL
        + """SELECT CAST(request AS VARCHAR) AS request_id,
       CASE WHEN bool_or(malformed) THEN 'MALFORMED' WHEN bool_or(refused) THEN 'TOO_MANY_ROWS' ELSE 'OK' END AS status,
       COUNT(*) FILTER (WHERE reason_code IS NULL) AS inserted,
       COUNT(*) FILTER (WHERE reason_code <> 'MALFORMED') AS failed FROM judged GROUP BY request""",
    ),
    "ingested_rejects": (
        ingested_rejects,
        REQUESTS_SQL
        + """SELECT CAST(request AS VARCHAR) AS request_id, reason_code,
       CASE WHEN reason_code = 'MALFORMED' THEN 1 ELSE COUNT(*) END AS "rows"
FROM judged WHERE reason_code IS NOT NULL GROUP BY request, reason_code""",
    ),
    "ingested_ids": (
        ingested_ids,
        REQUESTS_SQL
        + """SELECT 2 * COUNT(*) AS "rows", 2 * COUNT(*) AS ids, CAST(1 AS BIGINT) AS min_id, 2 * COUNT(*) AS max_id
FROM judged WHERE reason_code IS NULL""",
    ),
    "ingested_dimension": (
        ingested_dimension,
        """SELECT p_name AS job, COUNT(*) AS "rows", COUNT(*) AS ids FROM part WHERE p_size <= 45 GROUP BY p_name""",
    ),
    "streamed_rows": (streamed_rows, REQUESTS_SQL + ACCEPTED_SQL),
    "snapshot_roundtrip": (snapshot_roundtrip, SNAPSHOT_SQL),
    "restore_replaces": (
        restore_replaces,
        f"SELECT *, MAX(id) OVER () AS largest FROM ({SNAPSHOT_SQL})",
    ),
}
