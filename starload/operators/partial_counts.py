"""Counts per quarter and parent keys that add up: what the yearly reports need of a set of fact rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starload.spec import TableSpec

YEAR, QUARTER, ROWS, KEYED = "_year", "_quarter", "_rows", "_keyed"


def count_keys(spec: TableSpec) -> list[str]:
    """The foreign keys that rows are counted by, besides year and quarter."""
    return list(dict.fromkeys(fk.column for fk in spec.foreign_keys))


def counts_schema(spec: TableSpec) -> T.StructType:
    keys = [T.StructField(k, spec.schema[k].dataType) for k in count_keys(spec)]
    whens = [T.StructField(c, T.IntegerType()) for c in (YEAR, QUARTER)]
    return T.StructType(whens + keys + [T.StructField(c, T.LongType()) for c in (ROWS, KEYED)])


def partial_counts(rows: DataFrame, spec: TableSpec, *by: str) -> DataFrame:
    """Rows, and rows with a key, by quarter and foreign keys, within each value of ``by``.

    A null datetime or foreign key is a group of its own, so the counts add up to all rows. Each task shuffles one
    row per group, whatever share of the rows a group holds.
    """
    at = F.col(spec.year_of)
    keys = [F.year(at).alias(YEAR), F.quarter(at).alias(QUARTER), *count_keys(spec)]
    return rows.groupBy(*by, *keys).agg(F.count(F.lit(1)).alias(ROWS), F.count(spec.key).alias(KEYED))


def added_counts(counts: DataFrame, spec: TableSpec, *by: str) -> DataFrame:
    """The counts of several sets of rows together."""
    return counts.groupBy(*by, YEAR, QUARTER, *count_keys(spec)).agg(F.sum(ROWS).alias(ROWS), F.sum(KEYED).alias(KEYED))
