"""Reports from counts kept beside the stored folders, after batches, joins, rewrites and restores."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue.movement import SNAPSHOT_SQL, _snapshot_source, _with_dimensions
from catalogue.reports import QUARTER_SQL, YEAR
from catalogue.tables import PARENTS_SQL
from starload.plans import counts
from starload.plans.snapshot import backup, restore
from starload.warehouse import Warehouse

TABLE = "hired_employees"


def _add(warehouse: Warehouse, rows: DataFrame, condition: str) -> None:
    warehouse.publish(TABLE, warehouse.stage(TABLE, rows.where(condition)), condition)


def counted_quarters(spark: SparkSession, sf: str) -> DataFrame:
    """Four folders are counted and joined, a fifth is not counted yet; the report reads only that one's facts."""
    warehouse, rows = _with_dimensions(spark, sf, "counted"), _snapshot_source(spark, sf).read(TABLE)
    for k in range(4):
        _add(warehouse, rows, f"id % 5 = {k}")
    warehouse.keep_counts(TABLE)
    warehouse.join_small(TABLE, 4)
    _add(warehouse, rows, "id % 5 = 4")
    return counts.stored_quarterly_counts(warehouse, TABLE, "departments", "jobs", YEAR)


def counted_after_restore(spark: SparkSession, sf: str) -> DataFrame:
    """Counted rows are undone by a restore, other rows follow, and the table is rewritten as one."""
    warehouse, rows = _with_dimensions(spark, sf, "recounted"), _snapshot_source(spark, sf).read(TABLE)
    _add(warehouse, rows, "id % 3 = 0")
    path = backup(warehouse, TABLE, f"{warehouse.root}/backups", datetime(2025, 1, 2, 3, 4, 5))
    _add(warehouse, rows, "id % 3 = 1")
    warehouse.keep_counts(TABLE)
    restore(warehouse, TABLE, path)
    _add(warehouse, rows, "id % 3 = 2")
    warehouse.keep_counts(TABLE)
    warehouse.compact(TABLE)
    return counts.stored_above_mean_groups(warehouse, TABLE, "departments", YEAR)


def counted_years(spark: SparkSession, sf: str) -> DataFrame:
    """Rows per year, from counts alone; rows without a datetime are counted too."""
    warehouse = _snapshot_source(spark, sf)
    folders = warehouse.keep_counts(TABLE)
    return counts.rows_by_year(warehouse, TABLE).withColumn("folders", F.lit(folders))


STORED_SQL = f"""WITH stored AS ({SNAPSHOT_SQL}),
{PARENTS_SQL}
"""

ENTRIES = {
    "counted_quarters": (
        counted_quarters,
        STORED_SQL
        + f"""SELECT department, job,
       {QUARTER_SQL}
FROM stored f JOIN departments d ON f.department_id = d.id JOIN jobs j ON f.job_id = j.id
WHERE EXTRACT(year FROM hire_datetime) = {YEAR} GROUP BY department, job ORDER BY department, job""",
    ),
    "counted_after_restore": (
        counted_after_restore,
        STORED_SQL.rstrip()
        + f""", groups AS (
  SELECT d.id, d.department, COUNT(f.id) AS hired FROM stored f JOIN departments d ON f.department_id = d.id
  WHERE EXTRACT(year FROM hire_datetime) = {YEAR} AND f.id % 3 <> 1 GROUP BY d.id, d.department)
SELECT id, department, hired FROM groups WHERE hired > (SELECT AVG(hired) FROM groups) ORDER BY hired DESC, id""",
    ),
    "counted_years": (
        counted_years,
        f"""SELECT CAST(EXTRACT(year FROM hire_datetime) AS INTEGER) AS year, COUNT(*) AS "rows", CAST(1 AS INTEGER) AS folders
FROM ({SNAPSHOT_SQL}) GROUP BY 1""",
    ),
}
