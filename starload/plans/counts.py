"""Report counts kept beside the folders they were taken from, so that a report reads counts and not facts.

A folder's rows never change, so its counts hold as long as the folder is part of the table: a restore or a rewrite
that drops the folder takes its counts back, and folders that are joined have their counts added.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.operators.partial_counts import ROWS, YEAR, added_counts, counts_schema, partial_counts
from starload.plans.reports import above_mean_of_counts, quarterly_of_counts
from starload.warehouse import Warehouse


def counted(warehouse: Warehouse, table: str, year: int) -> DataFrame:
    """The counts of one year: those kept, and fresh ones of the folders that have none yet.

    All are of one version of the table. Only folders that came in since ``Warehouse.keep_counts`` are read as facts,
    and of those only the year.
    """
    spec, state = warehouse.specs[table], warehouse.state(table)
    known = [f for f in state.folders if f in state.counted]
    new = [f for f in state.folders if f not in state.counted]
    kept = warehouse.read_counts(table, state, known).where(F.col(YEAR) == year).drop("part")
    if new:
        kept = kept.unionByName(partial_counts(warehouse.read_parts(table, state, new, year), spec))
    return added_counts(kept, spec).select(*counts_schema(spec).names)


def stored_quarterly_counts(
    warehouse: Warehouse, table: str, departments: str, jobs: str, year: int, collation: str | None = None
) -> DataFrame:
    """``reports.quarterly_counts`` of stored tables, from their counts."""
    rows = counted(warehouse, table, year)
    return quarterly_of_counts(rows, warehouse.read(departments), warehouse.read(jobs), collation)


def stored_above_mean_groups(warehouse: Warehouse, table: str, departments: str, year: int) -> DataFrame:
    """``reports.above_mean_groups`` of stored tables, from their counts."""
    return above_mean_of_counts(counted(warehouse, table, year), warehouse.read(departments))


def rows_by_year(warehouse: Warehouse, table: str) -> DataFrame:
    """``year, rows`` of the folders that have counts, null for rows without a datetime."""
    state = warehouse.state(table)
    kept = warehouse.read_counts(table, state, [f for f in state.folders if f in state.counted])
    return kept.groupBy(F.col(YEAR).alias("year")).agg(F.sum(ROWS).alias("rows"))
