"""Star-schema loading, validation, reporting and snapshots on Spark."""

from starload.spec import DEPARTMENTS, HIRED_EMPLOYEES, JOBS, STAR, ForeignKey, TableSpec
from starload.warehouse import Warehouse

__all__ = ["DEPARTMENTS", "HIRED_EMPLOYEES", "JOBS", "STAR", "ForeignKey", "TableSpec", "Warehouse"]
