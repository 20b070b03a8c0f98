"""The two yearly reports, over any DataFrames with the declared column names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starload.functions.times import in_year
from starload.operators.partial_counts import KEYED, QUARTER, ROWS
from starload.session import broadcastable

QUARTERS = ("Q1", "Q2", "Q3", "Q4")


def quarterly_counts(
    fact: DataFrame, departments: DataFrame, jobs: DataFrame, year: int, collation: str | None = None
) -> DataFrame:
    """Rows per quarter of ``year`` by department name and job name: ``department, job, Q1..Q4``.

    With dimensions small enough to broadcast, each fact row is named in place and only partial
    counts per pair of names are shuffled. Otherwise counts are taken per pair of ids before the
    joins: the fact again shuffles as partial counts only, whatever share of it one department
    holds, and the joins see one row per pair. Equal names merge in the last aggregation; names that only
    the collation makes equal show their least spelling by bytes.
    """
    dimensions = {"department": _labels(departments, "department"), "job": _labels(jobs, "job")}
    keys = [f"{label}_id" for label in dimensions]
    rows = fact.where(in_year(F.col("hire_datetime"), year)).dropna(subset=keys)
    if all(broadcastable(dimension) for dimension in dimensions.values()):
        counts = _quarter_counts()
    else:
        rows = rows.groupBy(*keys).agg(*_quarter_counts())
        counts = [F.sum(q).alias(q) for q in QUARTERS]
    return _named_quarters(rows, dimensions, counts, collation)


def quarterly_of_counts(
    counts: DataFrame, departments: DataFrame, jobs: DataFrame, collation: str | None = None
) -> DataFrame:
    """``quarterly_counts`` of the rows that one year's ``partial_counts`` were taken from."""
    dimensions = {"department": _labels(departments, "department"), "job": _labels(jobs, "job")}
    keys = [f"{label}_id" for label in dimensions]
    in_quarter = [F.when(F.col(QUARTER) == i, F.col(ROWS)).otherwise(0) for i in range(1, len(QUARTERS) + 1)]
    pairs = counts.dropna(subset=keys).groupBy(*keys).agg(*[F.sum(n).alias(q) for q, n in zip(QUARTERS, in_quarter)])
    return _named_quarters(pairs, dimensions, [F.sum(q).alias(q) for q in QUARTERS], collation)


def _named_quarters(
    rows: DataFrame, dimensions: dict[str, DataFrame], counts: list[Column], collation: str | None
) -> DataFrame:
    for label, dimension in dimensions.items():
        rows = rows.join(dimension, f"{label}_id")
    if not collation:
        return rows.groupBy(*dimensions).agg(*counts).orderBy(*dimensions)
    names = [F.collate(label, collation).alias(f"_{label}") for label in dimensions]
    spellings = [F.min(label).alias(label) for label in dimensions]
    report = rows.groupBy(*names).agg(*spellings, *counts).orderBy(*[f"_{label}" for label in dimensions])
    return report.select(*dimensions, *QUARTERS)


def _quarter_counts() -> list[Column]:
    quarter = F.quarter("hire_datetime")
    return [F.count(F.when(quarter == i, 1)).alias(q) for i, q in enumerate(QUARTERS, 1)]


def group_counts(fact: DataFrame, departments: DataFrame, year: int) -> DataFrame:
    """Fact rows with an id, by department id and name: ``id, department, hired``.

    Counted per id before the join, so the join sees one row per department.
    """
    matched = fact.where(in_year(F.col("hire_datetime"), year)).dropna(subset=["department_id"])
    return _named_groups(matched.groupBy("department_id").agg(F.count("id").alias("hired")), departments)


def _named_groups(per_id: DataFrame, departments: DataFrame) -> DataFrame:
    named = per_id.join(_labels(departments, "department"), "department_id")
    return named.groupBy(F.col("department_id").alias("id"), "department").agg(F.sum("hired").alias("hired"))


def mean_of_groups(groups: DataFrame) -> DataFrame:
    """Mean of ``hired`` over the groups that exist; departments without a row in the year are not groups."""
    return groups.agg(F.avg("hired").alias("mean_hired"))


def above_mean_groups(fact: DataFrame, departments: DataFrame, year: int) -> DataFrame:
    """Departments with more rows than the mean department, largest first, then by id.

    ``hired > mean`` is tested in whole numbers, ``hired * groups > total``, so nothing is rounded.
    The totals are one row by construction, which is what makes the broadcast safe.
    """
    return _above_mean(group_counts(fact, departments, year))


def above_mean_of_counts(counts: DataFrame, departments: DataFrame) -> DataFrame:
    """``above_mean_groups`` of the rows that one year's ``partial_counts`` were taken from."""
    per_id = counts.dropna(subset=["department_id"]).groupBy("department_id").agg(F.sum(KEYED).alias("hired"))
    return _above_mean(_named_groups(per_id, departments))


def _above_mean(groups: DataFrame) -> DataFrame:
    totals = groups.agg(F.sum("hired").alias("_total"), F.count(F.lit(1)).alias("_groups"))
    above = _exact("hired") * _exact("_groups") > F.col("_total")
    return (
        groups.join(F.broadcast(totals), above)
        .select("id", "department", "hired")
        .orderBy(F.desc("hired"), "id")
    )


def top_groups(fact: DataFrame, departments: DataFrame, year: int, n: int = 5) -> DataFrame:
    """The first ``n`` rows of ``above_mean_groups``."""
    return above_mean_groups(fact, departments, year).limit(n)


def _labels(dimension: DataFrame, label: str) -> DataFrame:
    return dimension.select(F.col("id").alias(f"{label}_id"), label)


def _exact(column: str) -> Column:
    """Wide enough that the product of two counts cannot overflow."""
    return F.col(column).cast("decimal(19,0)")
