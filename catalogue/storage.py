"""What a warehouse remembers and refuses: replays, failed loads, empty tables, odd requests, folders of files."""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue.movement import (
    REQUESTS_SQL,
    SNAPSHOT_SQL,
    _bodies,
    _snapshot_source,
    _warehouse,
    _with_dimensions,
    _write_lines,
)
from catalogue.tables import HIRES_SQL, PARENTS_SQL, hires, nations, solvent_customers, table
from starload.functions.times import datetime_text
from starload.plans.ingest import ingest_requests
from starload.plans.load import load_history
from starload.plans.snapshot import backup, restore
from starload.session import fresh_dir
from starload.sources.requests import read_requests
from starload.warehouse import Warehouse

NOW = datetime(2025, 1, 2, 3, 4, 5)
TABLE = "hired_employees"


def _sizes(warehouse: Warehouse, at: str) -> DataFrame:
    """Rows of every table, under the name of a moment."""
    parts = [warehouse.read(n).agg(F.count(F.lit(1)).alias("rows")).withColumn("table", F.lit(n)) for n in warehouse.specs]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).select(F.lit(at).alias("at"), "table", "rows")


def _cut(warehouse: Warehouse, at: str) -> DataFrame:
    """The sizes as they are now, whatever is done to the tables later."""
    path = warehouse.staging(at)
    _sizes(warehouse, at).write.parquet(path)
    return warehouse.spark.read.parquet(path)


# -- batch memory ---------------------------------------------------------------------------------


def replay_after_rewrite(spark: SparkSession, sf: str) -> DataFrame:
    """Three batches, the table rewritten twice, then the first and the last batch once more: nothing is stored twice."""
    warehouse = _with_dimensions(spark, sf, "rewritten")
    for batch in ("a", "b"):
        ingest_requests(warehouse, TABLE, _bodies(spark, sf), batch, 300)
    warehouse.compact(TABLE)
    ingest_requests(warehouse, TABLE, _bodies(spark, sf), "c", 300)
    warehouse.compact(TABLE)
    for batch in ("a", "c"):
        ingest_requests(warehouse, TABLE, _bodies(spark, sf), batch, 300)
    return warehouse.read(TABLE).agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("id").alias("ids"), F.max("id").alias("max_id")
    )


def replay_after_restore(spark: SparkSession, sf: str) -> DataFrame:
    """A batch stored after the backup is gone with the restore, so the same batch is stored again; one from before is not."""
    warehouse = _with_dimensions(spark, sf, "replayed")
    ingest_requests(warehouse, TABLE, _bodies(spark, sf), "before", 300)
    path = backup(warehouse, TABLE, f"{warehouse.root}/backups", NOW)
    ingest_requests(warehouse, TABLE, _bodies(spark, sf), "after", 300)
    restore(warehouse, TABLE, path)
    ingest_requests(warehouse, TABLE, _bodies(spark, sf), "before", 300)
    again = ingest_requests(warehouse, TABLE, _bodies(spark, sf), "after", 300)
    rows = warehouse.read(TABLE).agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("id").alias("ids"))
    inserted = again.summary.agg(F.sum("inserted")).first()[0]
    return rows.withColumns({"accepted": F.lit(again.accepted.count()).cast("bigint"), "inserted": F.lit(inserted).cast("bigint")})


# -- tables ---------------------------------------------------------------------------------------


def drop_and_create(spark: SparkSession, sf: str) -> DataFrame:
    """Filled, dropped, created, filled anew: sizes at each moment."""
    warehouse = _with_dimensions(spark, sf, "dropped")
    filled = _cut(warehouse, "filled")
    warehouse.drop("departments")
    warehouse.create()
    dropped = _cut(warehouse, "dropped")
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("department"))
    warehouse.publish("departments", warehouse.stage("departments", customers), "given")
    return filled.unionByName(dropped).unionByName(_cut(warehouse, "again"))


def failed_load(spark: SparkSession, sf: str) -> DataFrame:
    """A load of three tables whose last file is missing shows none of them; with the file it shows all."""
    folder = fresh_dir(spark, "history")
    warehouse = _warehouse(spark, "failed")
    orders = hires(spark, sf).select("id", "name", datetime_text(F.col("hire_datetime")), "department_id", "job_id")
    paths = {
        "departments": _write_lines(solvent_customers(spark, sf), f"{folder}/departments"),
        "jobs": _write_lines(nations(spark, sf), f"{folder}/jobs"),
        TABLE: f"{folder}/hires",
    }
    try:
        load_history(warehouse, paths)
    except AnalysisException:
        failed = _cut(warehouse, "failed")
    _write_lines(orders, f"{folder}/hires")
    load_history(warehouse, paths)
    return failed.unionByName(_cut(warehouse, "loaded"))


def load_list_order(spark: SparkSession, sf: str) -> DataFrame:
    """Of two files the first in the list wins, though its path comes last."""
    folder = fresh_dir(spark, "history")
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("department"))
    first = _write_lines(customers.where("id % 3 = 0"), f"{folder}/z")
    second = _write_lines(customers.withColumn("department", F.upper("department")), f"{folder}/a")
    warehouse = _warehouse(spark, "listed")
    load_history(warehouse, {"departments": [first, second]})
    return warehouse.read("departments")


# -- snapshots ------------------------------------------------------------------------------------


def backup_of_empty(spark: SparkSession, sf: str) -> DataFrame:
    """What backing up says for a filled table and an empty one."""
    warehouse = _with_dimensions(spark, sf, "empty")
    outcomes = [(n, backup(warehouse, n, f"{warehouse.root}/backups", NOW).rsplit("/", 1)[-1]) for n in warehouse.specs]
    return spark.createDataFrame(outcomes, "`table` string, outcome string")


def backup_names(spark: SparkSession, sf: str) -> DataFrame:
    """Two backups a second apart, and the rows that each holds."""
    warehouse = _with_dimensions(spark, sf, "names")
    target = _warehouse(spark, "named")
    target.create()
    times = [datetime(2025, 2, 18, 23, 59, 59), datetime(2025, 2, 19)]
    paths = [backup(warehouse, "departments", f"{warehouse.root}/backups", at) for at in times]
    kept = [(p.rsplit("/", 1)[-1], restore(target, "departments", p).rows) for p in paths]
    return spark.createDataFrame(kept, "name string, rows bigint")


def restore_orphans(spark: SparkSession, sf: str) -> DataFrame:
    """A snapshot restored where parents are missing: rows, and foreign keys without parent."""
    source = _snapshot_source(spark, sf)
    path = backup(source, TABLE, f"{source.root}/backups", NOW)
    report = restore(_with_dimensions(spark, sf, "orphans"), TABLE, path, check_fk=True)
    return spark.createDataFrame([(report.rows, report.orphans)], "rows bigint, orphans bigint")


# -- requests -------------------------------------------------------------------------------------


def odd_requests(spark: SparkSession, sf: str) -> DataFrame:
    """One request per hire whose department id is sent, by rule, beyond 64 bits, as text, with a fraction or as it is."""
    rule = F.col("id") % 7
    sent = (
        F.when(rule == 0, "1" + "0" * 23)
        .when(rule == 1, "-1" + "0" * 35)
        .when(rule == 2, F.concat(F.lit('" '), "department_id", F.lit('"')))
        .when(rule == 3, F.concat("department_id", F.lit(".5")))
        .when(rule == 4, F.concat("department_id", F.lit(".0")))
        .otherwise(F.col("department_id").cast("string"))
    )
    record = F.format_string(
        '{"registros":[{"name":"%s","hire_datetime":"%s","department_id":%s,"job_id":%d}]}',
        "name", datetime_text(F.col("hire_datetime")), sent, F.col("job_id").cast("bigint"),
    )
    requests = hires(spark, sf).select(F.col("id").cast("string").alias("request_id"), record.alias("body"))
    result = ingest_requests(_with_dimensions(spark, sf, "odd"), TABLE, requests)
    return result.rejected.select("request_id", "reason_code", "reason")


def requests_from_folders(spark: SparkSession, sf: str) -> DataFrame:
    """The requests in a folder per day, where files of both days share their names."""
    inbox = fresh_dir(spark, "inbox")
    days = F.col("request_id").cast("bigint") % 2
    _bodies(spark, sf).select("body", days.alias("day")).repartition(3).write.partitionBy("day").text(inbox)
    result = ingest_requests(_with_dimensions(spark, sf, "folders"), TABLE, read_requests(spark, inbox), max_rows=300)
    return result.summary.groupBy("status").agg(
        F.count(F.lit(1)).alias("requests"), F.sum("inserted").alias("inserted"), F.sum("failed").alias("failed")
    )


CUSTOMERS = "SELECT COUNT(*) FROM customer"
SOLVENT = "SELECT COUNT(*) FROM customer WHERE c_acctbal > 0"
NATIONS = "SELECT COUNT(*) FROM nation"


def _sizes_sql(at: str, departments: str, jobs: str, hired: str) -> str:
    sizes = {"departments": departments, "jobs": jobs, TABLE: hired}
    return " UNION ALL ".join(f"SELECT '{at}' AS at, '{n}' AS \"table\", ({q}) AS \"rows\"" for n, q in sizes.items())


ZERO = "SELECT CAST(0 AS BIGINT)"
ACCEPTED = "FROM judged WHERE reason_code IS NULL"

ENTRIES = {
    "replay_after_rewrite": (
        replay_after_rewrite,
        REQUESTS_SQL + f'SELECT 3 * COUNT(*) AS "rows", 3 * COUNT(*) AS ids, 3 * COUNT(*) AS max_id {ACCEPTED}',
    ),
    "replay_after_restore": (
        replay_after_restore,
        REQUESTS_SQL
        + f"""SELECT 2 * COUNT(*) AS "rows", 2 * COUNT(*) AS ids, COUNT(*) AS accepted, COUNT(*) AS inserted {ACCEPTED}""",
    ),
    "drop_and_create": (
        drop_and_create,
        " UNION ALL ".join(
            [
                _sizes_sql("filled", SOLVENT, NATIONS, ZERO),
                _sizes_sql("dropped", ZERO, NATIONS, ZERO),
                _sizes_sql("again", CUSTOMERS, NATIONS, ZERO),
            ]
        ),
    ),
    "failed_load": (
        failed_load,
        f"WITH {HIRES_SQL},\n{PARENTS_SQL}\n"
        + _sizes_sql("failed", ZERO, ZERO, ZERO)
        + " UNION ALL "
        + _sizes_sql(
            "loaded", SOLVENT, NATIONS,
            "SELECT COUNT(*) FROM hires WHERE department_id IN (SELECT id FROM departments) AND job_id IN (SELECT id FROM jobs)",
        ),
    ),
    "load_list_order": (
        load_list_order,
        "SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN c_name ELSE upper(c_name) END AS department FROM customer",
    ),
    "backup_of_empty": (
        backup_of_empty,
        " UNION ALL ".join(
            f"SELECT '{n}' AS \"table\", CASE WHEN ({q}) = 0 THEN 'skipped' ELSE '{n}_backup_20250102_030405.avro' END AS outcome"
            for n, q in {"departments": SOLVENT, "jobs": NATIONS, TABLE: ZERO}.items()
        ),
    ),
    "backup_names": (
        backup_names,
        " UNION ALL ".join(
            f"SELECT 'departments_backup_{at}.avro' AS name, ({SOLVENT}) AS \"rows\"" for at in ("20250218_235959", "20250219_000000")
        ),
    ),
    "restore_orphans": (
        restore_orphans,
        f"""WITH snapshot AS ({SNAPSHOT_SQL}),
{PARENTS_SQL}
SELECT COUNT(*) AS "rows",
       COUNT(*) FILTER (WHERE department_id NOT IN (SELECT id FROM departments))
       + COUNT(*) FILTER (WHERE job_id NOT IN (SELECT id FROM jobs)) AS orphans FROM snapshot""",
    ),
    "odd_requests": (
        odd_requests,
        f"""WITH {HIRES_SQL},
{PARENTS_SQL},
sent AS (
  SELECT *, CASE id % 7 WHEN 0 THEN '1' || repeat('0', 23) WHEN 1 THEN '-1' || repeat('0', 35)
                        ELSE CAST(department_id AS VARCHAR) END AS department FROM hires),
judged AS (
  SELECT *, CASE WHEN id % 7 = 3 THEN 'MALFORMED'
                 WHEN name = '' OR department = '0' OR job_id = 0 THEN 'MISSING_FIELD'
                 WHEN id % 7 < 2 OR department_id NOT IN (SELECT id FROM departments) OR job_id NOT IN (SELECT id FROM jobs)
                   THEN 'FOREIGN_KEY' END AS reason_code FROM sent)
SELECT CAST(id AS VARCHAR) AS request_id, reason_code,
       CASE reason_code WHEN 'FOREIGN_KEY' THEN 'not found: department_id ' || department || ' or job_id ' || job_id
                        WHEN 'MISSING_FIELD' THEN 'missing field' ELSE 'malformed' END AS reason
FROM judged WHERE reason_code IS NOT NULL""",
    ),
    "requests_from_folders": (
        requests_from_folders,
        REQUESTS_SQL
        + """, totals AS (
  SELECT CASE WHEN bool_or(malformed) THEN 'MALFORMED' WHEN bool_or(refused) THEN 'TOO_MANY_ROWS' ELSE 'OK' END AS status,
         COUNT(*) FILTER (WHERE reason_code IS NULL) AS inserted,
         COUNT(*) FILTER (WHERE reason_code <> 'MALFORMED') AS failed FROM judged GROUP BY request)
SELECT status, COUNT(*) AS requests, CAST(SUM(inserted) AS BIGINT) AS inserted, CAST(SUM(failed) AS BIGINT) AS failed
FROM totals GROUP BY status""",
    ),
}
