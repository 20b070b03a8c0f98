"""Several writers at once, parents that leave, snapshots that build on each other, records over several lines."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from datetime import datetime, timedelta

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue.movement import (
    HIRE_COLUMNS,
    REQUESTS_SQL,
    SNAPSHOT_SQL,
    WIDE_STAR,
    _bodies,
    _snapshot_source,
    _warehouse,
    _with_dimensions,
    _write_lines,
)
from catalogue.tables import PARENTS_SQL, solvent_customers, table
from starload.plans.ingest import ingest_requests
from starload.plans.load import load_history
from starload.plans.snapshot import backup, backup_changes, restore
from starload.session import fresh_dir
from starload.warehouse import TableGone, Warehouse

NOW = datetime(2025, 1, 2, 3, 4, 5)
TABLE = "hired_employees"


class Meanwhile(Warehouse):
    """Lets another writer act once, when rows are written and about to be committed."""

    other: Callable[[], object] | None = None

    def publish_all(self, *args) -> bool:
        other, self.other = self.other, None
        if other:
            other()
        return super().publish_all(*args)


def _watched(spark: SparkSession, sf: str, label: str) -> Meanwhile:
    return Meanwhile(spark, _with_dimensions(spark, sf, label).root, WIDE_STAR)


# -- writers at the same time ---------------------------------------------------------------------


def leased_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Three writers take in the same requests at once: ids are distinct, and each batch is written once."""
    warehouse = _with_dimensions(spark, sf, "leases")
    written: list[str] = []

    class Counting(Warehouse):
        def stage(self, name: str, *args, **how) -> str:
            written.append(name)
            return super().stage(name, *args, **how)

    writers = [Counting(spark, warehouse.root, WIDE_STAR) for _ in range(3)]
    bodies = _bodies(spark, sf)
    work = inheritable_thread_target(spark)(lambda n: ingest_requests(writers[n], TABLE, bodies, f"writer-{n}", 300))
    with ThreadPoolExecutor(3) as pool:
        list(pool.map(work, range(3)))
    return warehouse.read(TABLE).agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("id").alias("ids"), F.max("id").alias("max_id"),
        F.lit(len(written)).cast("bigint").alias("written"),
    )


def parent_restored_meanwhile(spark: SparkSession, sf: str) -> DataFrame:
    """While a batch is taken in, the departments go back to those with an even id: rows of the others are refused."""
    warehouse = _warehouse(spark, "moved")
    warehouse.create()
    parents = solvent_customers(spark, sf)
    for part in ("id % 2 = 0", "id % 2 = 1"):
        warehouse.publish("departments", warehouse.stage("departments", parents.where(part)), part[-1])
        if part[-1] == "0":
            path = backup(warehouse, "departments", f"{warehouse.root}/backups", NOW)
    jobs = table(spark, sf, "nation").select(F.col("n_nationkey").cast("bigint").alias("id"), F.col("n_name").alias("job"))
    warehouse.publish("jobs", warehouse.stage("jobs", jobs), "given")
    watched = Meanwhile(spark, warehouse.root, WIDE_STAR)
    watched.other = lambda: restore(warehouse, "departments", path)
    result = ingest_requests(watched, TABLE, _bodies(spark, sf), "late", 300)
    failed = result.rejected.where("reason_code = 'FOREIGN_KEY'").count()
    return result.accepted.select(*HIRE_COLUMNS, F.lit(failed).cast("bigint").alias("without_parent"))


def dropped_meanwhile(spark: SparkSession, sf: str) -> DataFrame:
    """A table dropped and created anew refuses rows written for the old one; sent again, they are stored."""
    warehouse = _watched(spark, sf, "gone")

    def anew() -> None:
        warehouse.drop(TABLE)
        warehouse.create()

    warehouse.other = anew
    outcomes = []
    for _ in range(2):
        try:
            outcome = ingest_requests(warehouse, TABLE, _bodies(spark, sf), "batch", 300).batch_id
        except TableGone:
            outcome = "refused"
        outcomes.append((len(outcomes) + 1, outcome, warehouse.has_batch(TABLE, "batch"), warehouse.read(TABLE).count()))
    return spark.createDataFrame(outcomes, "attempt int, outcome string, taken_in boolean, rows bigint")


# -- references -----------------------------------------------------------------------------------


def children_orphaned(spark: SparkSession, sf: str) -> DataFrame:
    """Departments restored to an older, smaller state: the hires whose department has left, by key."""
    warehouse = _snapshot_source(spark, sf)
    parents = solvent_customers(spark, sf)
    warehouse.publish("departments", warehouse.stage("departments", parents), "some")
    path = backup(warehouse, "departments", f"{warehouse.root}/backups", NOW)
    others = table(spark, sf, "customer").where("c_acctbal <= 0")
    others = others.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("department"))
    warehouse.publish("departments", warehouse.stage("departments", others), "others")
    return restore(warehouse, "departments", path, check_fk=True).orphan_keys


# -- snapshots ------------------------------------------------------------------------------------


def snapshot_chain(spark: SparkSession, sf: str) -> DataFrame:
    """Three backups that each hold what the one before lacks; the last is restored elsewhere."""
    warehouse, target = _warehouse(spark, "chain"), _warehouse(spark, "unchained")
    rows = _snapshot_source(spark, sf).read(TABLE)
    for each in (warehouse, target):
        each.create()
    path, root = None, f"{warehouse.root}/backups"
    for k in range(3):
        warehouse.publish(TABLE, warehouse.stage(TABLE, rows.where(F.col("id") % 3 == k)), f"third-{k}")
        path = backup_changes(warehouse, TABLE, root, path, NOW + timedelta(seconds=k))
    last = spark.read.format("org.apache.spark.sql.avro.AvroFileFormat").load(path).count()
    restore(target, TABLE, path)
    return target.read(TABLE).withColumn("in_last", F.lit(last).cast("bigint"))


def swapped_file(spark: SparkSession, sf: str) -> DataFrame:
    """A snapshot whose rows were replaced by as many others is refused, and the table stays."""
    warehouse = _snapshot_source(spark, sf)
    root = f"{warehouse.root}/backups"
    paths = [backup(warehouse, TABLE, root, NOW)]
    other = _warehouse(spark, "swapped")
    other.create()
    changed = warehouse.read(TABLE).withColumn("job_id", F.when(F.col("id") != 5, F.col("job_id")))
    other.publish(TABLE, other.stage(TABLE, changed), "given")
    paths.append(backup(other, TABLE, f"{other.root}/backups", NOW))
    files = warehouse.files
    for name in files.names(paths[0]):
        if name.endswith(".avro"):
            files.delete(f"{paths[0]}/{name}")
    spark.read.format("org.apache.spark.sql.avro.AvroFileFormat").load(paths[1]).write.mode("append").format(
        "org.apache.spark.sql.avro.AvroFileFormat"
    ).save(paths[0])
    try:
        restore(warehouse, TABLE, paths[0])
        outcome = "restored"
    except ValueError as refusal:
        outcome = str(refusal).rsplit(" holds ", 1)[1]
    return warehouse.read(TABLE).agg(
        F.count(F.lit(1)).alias("rows"), F.count("job_id").alias("job_ids"), F.lit(outcome).alias("outcome")
    )


# -- history files --------------------------------------------------------------------------------


@contextmanager
def _split_at(spark: SparkSession, size: int) -> Iterator[None]:
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def escaped_line_ends(spark: SparkSession, sf: str) -> DataFrame:
    """Names with an escaped line end, with several, and with an escaped backslash at theirs; read in 1, 3 and 18 splits."""
    customers = table(spark, sf, "customer")
    name = (
        F.when(F.col("c_custkey") % 3 == 0, F.concat("c_name", F.lit("\\\r\n"), "c_mktsegment"))
        .when(F.col("c_custkey") % 7 == 1, F.concat("c_name", F.lit("\\\r\n\\\\\\\r\n\\\r\n,more")))
        .when(F.col("c_custkey") % 5 == 2, F.concat("c_name", F.lit("\\\\")))
        .otherwise(F.col("c_name"))
    )
    path = _write_lines(customers.select("c_custkey", name), fresh_dir(spark, "escaped"))
    size = 40 * customers.count()
    found = []
    for splits in (1, 3, 18):
        warehouse = _warehouse(spark, "escaped")
        with _split_at(spark, max(size // splits, 1024)):
            load_history(warehouse, {"departments": path})
        found.append(warehouse.read("departments").withColumn("splits", F.lit(splits)))
    return found[0].unionByName(found[1]).unionByName(found[2])


ACCEPTED = "FROM judged WHERE reason_code IS NULL"

ENTRIES = {
    "leased_ids": (
        leased_ids,
        REQUESTS_SQL
        + f'SELECT 3 * COUNT(*) AS "rows", 3 * COUNT(*) AS ids, 3 * COUNT(*) AS max_id, CAST(3 AS BIGINT) AS written {ACCEPTED}',
    ),
    "parent_restored_meanwhile": (
        parent_restored_meanwhile,
        REQUESTS_SQL
        + """SELECT name, hire_datetime, department_id, CAST(job_id AS BIGINT) AS job_id,
       (SELECT COUNT(*) FROM judged WHERE reason_code = 'FOREIGN_KEY' OR (reason_code IS NULL AND department_id % 2 = 1))
         AS without_parent
FROM judged WHERE reason_code IS NULL AND department_id % 2 = 0""",
    ),
    "dropped_meanwhile": (
        dropped_meanwhile,
        REQUESTS_SQL
        + f"""SELECT 1 AS attempt, 'refused' AS outcome, FALSE AS taken_in, CAST(0 AS BIGINT) AS "rows"
UNION ALL SELECT 2, 'batch', TRUE, COUNT(*) {ACCEPTED}""",
    ),
    "children_orphaned": (
        children_orphaned,
        f"""WITH snapshot AS ({SNAPSHOT_SQL}),
{PARENTS_SQL}
SELECT 'hired_employees' AS child, 'department_id' AS "column", 'departments' AS parent, department_id AS key, COUNT(*) AS "rows"
FROM snapshot WHERE department_id NOT IN (SELECT id FROM departments) GROUP BY department_id""",
    ),
    "snapshot_chain": (
        snapshot_chain,
        f"SELECT *, COUNT(*) FILTER (WHERE id % 3 = 2) OVER () AS in_last FROM ({SNAPSHOT_SQL})",
    ),
    "swapped_file": (
        swapped_file,
        f"""SELECT COUNT(*) AS "rows", COUNT(job_id) AS job_ids, 'other rows than were written' AS outcome FROM ({SNAPSHOT_SQL})""",
    ),
    "escaped_line_ends": (
        escaped_line_ends,
        r"""SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN c_name || chr(13) || chr(10) || c_mktsegment
       WHEN c_custkey % 7 = 1 THEN c_name || chr(13) || chr(10) || '\' || chr(13) || chr(10) || chr(13) || chr(10)
       WHEN c_custkey % 5 = 2 THEN c_name || '\' ELSE c_name END AS department, splits
FROM customer CROSS JOIN (SELECT unnest([1, 3, 18]) AS splits)""",
    ),
}
