"""The graph of references between tables, and the rows that a change of a parent leaves without one."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.operators.foreign_keys import orphan_keys
from starload.spec import ForeignKey, TableSpec

ORPHANS = "child string, `column` string, parent string, key bigint, rows bigint"


@dataclass(frozen=True)
class Reference:
    child: str
    key: ForeignKey


def references(specs: Iterable[TableSpec]) -> list[Reference]:
    """All edges from a child to its parent, in the order of the declarations."""
    return [Reference(spec.name, fk) for spec in specs for fk in spec.foreign_keys]


def touching(specs: Iterable[TableSpec], table: str) -> list[Reference]:
    """The edges that a new content of ``table`` can break: its own, and those of the tables that point at it."""
    return [r for r in references(specs) if table in (r.child, r.key.parent)]


def orphans(tables: Mapping[str, DataFrame], edges: Iterable[Reference]) -> DataFrame:
    """One row per key without parent: ``child, column, parent, key, rows``.

    Each edge is one join of the child's distinct keys, counted in every task first, with the parent's keys.
    """
    found = [
        orphan_keys(tables[e.child], e.key, tables[e.key.parent]).select(
            F.lit(e.child).alias("child"), F.lit(e.key.column).alias("column"), F.lit(e.key.parent).alias("parent"),
            F.col(e.key.column).cast("bigint").alias("key"), "rows",
        )
        for e in edges
    ]
    if not found:
        spark = next(iter(tables.values())).sparkSession
        return spark.createDataFrame([], ORPHANS)
    return reduce(DataFrame.unionByName, found)
