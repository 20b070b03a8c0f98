"""Declared tables: columns, types and constraints.

One ``TableSpec`` per table is the single source for load, ingest, snapshot and restore.
Spark's file tables do not enforce keys, NOT NULL or lengths, so the operators check them from here.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import types as T


@dataclass(frozen=True)
class ForeignKey:
    column: str
    parent: str
    parent_key: str = "id"


@dataclass(frozen=True)
class TableSpec:
    """A table with an integer key.

    ``schema`` nullability is the NOT NULL rule. ``empty_is_null`` names the columns whose empty text
    means null when loading delimited files. ``year_of`` names the timestamp column whose year
    partitions the stored table.
    """

    name: str
    schema: T.StructType
    key: str = "id"
    max_length: Mapping[str, int] = field(default_factory=dict)
    foreign_keys: tuple[ForeignKey, ...] = ()
    empty_is_null: tuple[str, ...] = ()
    year_of: str | None = None

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    @property
    def row_fields(self) -> list[T.StructField]:
        """The fields a request supplies: everything but the generated key."""
        return [f for f in self.schema if f.name != self.key]

    @property
    def not_null(self) -> list[str]:
        return [f.name for f in self.schema if not f.nullable]

    @property
    def year_column(self) -> str | None:
        return f"{self.year_of}_year" if self.year_of else None


    def widened(self) -> TableSpec:
        """The same table with 64-bit whole numbers, for more rows than a 32-bit key can name."""
        fields = [
            T.StructField(f.name, T.LongType() if isinstance(f.dataType, T.IntegerType) else f.dataType, f.nullable)
            for f in self.schema
        ]
        return replace(self, schema=T.StructType(fields))


def _dimension(name: str, label: str) -> TableSpec:
    return TableSpec(
        name,
        T.StructType(
            [T.StructField("id", T.IntegerType(), False), T.StructField(label, T.StringType(), False)]
        ),
        max_length={label: 255},
    )


DEPARTMENTS = _dimension("departments", "department")
JOBS = _dimension("jobs", "job")
HIRED_EMPLOYEES = TableSpec(
    "hired_employees",
    T.StructType(
        [
            T.StructField("id", T.IntegerType(), False),
            T.StructField("name", T.StringType()),
            T.StructField("hire_datetime", T.TimestampNTZType()),
            T.StructField("department_id", T.IntegerType()),
            T.StructField("job_id", T.IntegerType()),
        ]
    ),
    max_length={"name": 255},
    foreign_keys=(ForeignKey("department_id", "departments"), ForeignKey("job_id", "jobs")),
    empty_is_null=("name", "hire_datetime", "department_id", "job_id"),
    year_of="hire_datetime",
)

STAR = (JOBS, DEPARTMENTS, HIRED_EMPLOYEES)
"""Load order: parents before the fact that points at them."""
