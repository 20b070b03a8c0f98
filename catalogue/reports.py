"""The yearly reports and their parts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue.tables import departments, fact, gappy_fact, jobs, solvent_departments, table
from starload.functions.times import in_year
from starload.plans import reports

YEAR = 1997

QUARTER_SQL = ",\n       ".join(
    f"COUNT(CASE WHEN EXTRACT(quarter FROM hire_datetime) = {q} THEN 1 END) AS \"Q{q}\"" for q in (1, 2, 3, 4)
)

FACT_SQL = """fact AS (
  SELECT l_orderkey AS id, l_shipdate AS hire_datetime, l_suppkey AS department_id, l_partkey AS job_id FROM lineitem)"""

GAPPY_SQL = """fact AS (
  SELECT CASE WHEN l_tax > 0.01 THEN l_orderkey END AS id,
         CASE WHEN l_linenumber <> 3 THEN l_shipdate END AS hire_datetime,
         CASE WHEN l_quantity >= 5 THEN l_suppkey END AS department_id,
         CASE WHEN l_discount > 0.005 THEN l_partkey END AS job_id
  FROM lineitem)"""

ALL_DEPARTMENTS_SQL = "departments AS (SELECT s_suppkey AS id, s_name AS department FROM supplier)"
SOLVENT_SQL = "departments AS (SELECT s_suppkey AS id, s_name AS department FROM supplier WHERE s_acctbal > 0)"
JOBS_SQL = "jobs AS (SELECT p_partkey AS id, p_name AS job FROM part)"


def _quarterly_sql(fact_sql: str, departments_sql: str) -> str:
    return f"""WITH {fact_sql},
{departments_sql},
{JOBS_SQL}
SELECT department, job,
       {QUARTER_SQL}
FROM fact f JOIN departments d ON f.department_id = d.id JOIN jobs j ON f.job_id = j.id
WHERE EXTRACT(year FROM hire_datetime) = {YEAR}
GROUP BY department, job ORDER BY department, job"""


COLLATED_SQL = f"""WITH {FACT_SQL},
{ALL_DEPARTMENTS_SQL},
jobs AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 2 = 0 THEN upper(p_name) ELSE p_name END AS job FROM part)
SELECT department, MIN(job) AS job,
       {QUARTER_SQL}
FROM fact f JOIN departments d ON f.department_id = d.id JOIN jobs j ON f.job_id = j.id
WHERE EXTRACT(year FROM hire_datetime) = {YEAR} GROUP BY department, lower(job)"""


def _groups_sql(fact_sql: str, departments_sql: str) -> str:
    return f"""WITH {fact_sql},
{departments_sql},
groups AS (
  SELECT d.id, d.department, COUNT(f.id) AS hired
  FROM fact f JOIN departments d ON f.department_id = d.id
  WHERE EXTRACT(year FROM hire_datetime) = {YEAR} GROUP BY d.id, d.department)
"""


ABOVE_SQL = """SELECT id, department, hired FROM groups
WHERE hired > (SELECT AVG(hired) FROM groups) ORDER BY hired DESC, id"""


def quarterly_counts(spark: SparkSession, sf: str) -> DataFrame:
    return reports.quarterly_counts(fact(spark, sf), departments(spark, sf), jobs(spark, sf), YEAR)


def quarterly_counts_with_gaps(spark: SparkSession, sf: str) -> DataFrame:
    return reports.quarterly_counts(gappy_fact(spark, sf), solvent_departments(spark, sf), jobs(spark, sf), YEAR)


def quarterly_counts_collated(spark: SparkSession, sf: str) -> DataFrame:
    """Every second job is spelled in capitals; the collation merges the spellings and shows the least."""
    spelled = jobs(spark, sf).withColumn("job", F.when(F.col("id") % 2 == 0, F.upper("job")).otherwise(F.col("job")))
    return reports.quarterly_counts(fact(spark, sf), departments(spark, sf), spelled, YEAR, "UNICODE_CI_AI")


def above_mean_groups(spark: SparkSession, sf: str) -> DataFrame:
    return reports.above_mean_groups(fact(spark, sf), departments(spark, sf), YEAR)


def above_mean_groups_with_gaps(spark: SparkSession, sf: str) -> DataFrame:
    return reports.above_mean_groups(gappy_fact(spark, sf), solvent_departments(spark, sf), YEAR)


def group_counts(spark: SparkSession, sf: str) -> DataFrame:
    return reports.group_counts(fact(spark, sf), departments(spark, sf), YEAR)


def mean_of_groups(spark: SparkSession, sf: str) -> DataFrame:
    return reports.mean_of_groups(reports.group_counts(fact(spark, sf), departments(spark, sf), YEAR))


def top_groups(spark: SparkSession, sf: str) -> DataFrame:
    return reports.top_groups(fact(spark, sf), departments(spark, sf), YEAR)


def year_filter(spark: SparkSession, sf: str) -> DataFrame:
    line = table(spark, sf, "lineitem").where(in_year(F.col("l_shipdate"), YEAR))
    return line.select("l_orderkey", "l_linenumber", "l_shipdate", F.quarter("l_shipdate").alias("quarter"))


def star_join(spark: SparkSession, sf: str) -> DataFrame:
    """Every fact row with the names of its parents; null and orphan keys drop out."""
    named_departments = solvent_departments(spark, sf).withColumnRenamed("id", "department_id")
    named_jobs = jobs(spark, sf).withColumnRenamed("id", "job_id")
    joined = gappy_fact(spark, sf).join(named_departments, "department_id").join(named_jobs, "job_id")
    return joined.select("id", "hire_datetime", "department_id", "department", "job_id", "job")


ENTRIES = {
    "quarterly_counts": (quarterly_counts, _quarterly_sql(FACT_SQL, ALL_DEPARTMENTS_SQL)),
    "quarterly_counts_with_gaps": (quarterly_counts_with_gaps, _quarterly_sql(GAPPY_SQL, SOLVENT_SQL)),
    "quarterly_counts_collated": (quarterly_counts_collated, COLLATED_SQL),
    "above_mean_groups": (above_mean_groups, _groups_sql(FACT_SQL, ALL_DEPARTMENTS_SQL) + ABOVE_SQL),
    "above_mean_groups_with_gaps": (above_mean_groups_with_gaps, _groups_sql(GAPPY_SQL, SOLVENT_SQL) + ABOVE_SQL),
    "group_counts": (group_counts, _groups_sql(FACT_SQL, ALL_DEPARTMENTS_SQL) + "SELECT id, department, hired FROM groups"),
    "mean_of_groups": (
        mean_of_groups,
        _groups_sql(FACT_SQL, ALL_DEPARTMENTS_SQL) + "SELECT AVG(hired) AS mean_hired FROM groups",
    ),
    "top_groups": (top_groups, _groups_sql(FACT_SQL, ALL_DEPARTMENTS_SQL) + ABOVE_SQL + " LIMIT 5"),
    "year_filter": (
        year_filter,
        f"""SELECT l_orderkey, l_linenumber, l_shipdate, CAST(EXTRACT(quarter FROM l_shipdate) AS INTEGER) AS quarter
FROM lineitem WHERE EXTRACT(year FROM l_shipdate) = {YEAR}""",
    ),
    "star_join": (
        star_join,
        f"""WITH {GAPPY_SQL},
{SOLVENT_SQL},
{JOBS_SQL}
SELECT f.id, hire_datetime, department_id, department, job_id, job
FROM fact f JOIN departments d ON f.department_id = d.id JOIN jobs j ON f.job_id = j.id""",
    ),
}
