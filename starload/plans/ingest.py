"""Batch ingest: judge request rows, append the good, keep the bad with a reason."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starload.commits import TableState
from starload.functions.times import parse_datetime
from starload.operators.ids import number_rows, rows_per_file
from starload.operators.judge import judge_request_rows, refuse_orphans
from starload.operators.requests import MAX_ROWS, as_request_rows, summarize, with_request_status
from starload.session import written
from starload.sources.requests import request_rows
from starload.spec import TableSpec
from starload.warehouse import Batch, LeaseEnded, ParentMoved, Warehouse

REJECTED_ROWS = "rejected_rows"
REQUESTS = "requests"
TO_NUMBER, EMPTY = "_to_number", "_empty"
"""Kinds that a batch needs on its way only."""
SUMMARY_SCHEMA = "request_id string, status string, inserted bigint, failed bigint"


@dataclass(frozen=True)
class IngestResult:
    """``accepted``: stored rows with ids. ``rejected``: refused rows with reason. ``summary``: per request."""

    batch_id: str
    accepted: DataFrame
    rejected: DataFrame
    summary: DataFrame


def ingest_requests(
    warehouse: Warehouse, table: str, requests: DataFrame, batch_id: str | None = None, max_rows: int = MAX_ROWS
) -> IngestResult:
    """Ingest JSON requests, a DataFrame of ``request_id, body``."""
    spec = warehouse.specs[table]
    return _ingest(warehouse, table, lambda run: written(request_rows(requests, spec, max_rows), "rows", run), batch_id)


def ingest(
    warehouse: Warehouse, table: str, rows: DataFrame, batch_id: str | None = None, max_rows: int = MAX_ROWS
) -> IngestResult:
    """Ingest rows of ``request_id, ordinal`` and the table's request fields; see ``as_request_rows``."""
    given = as_request_rows(rows, warehouse.specs[table])
    return _ingest(
        warehouse, table, lambda run: with_request_status(written(given, "rows", run), max_rows, run), batch_id
    )


def _ingest(
    warehouse: Warehouse, table: str, rows: Callable[[str], DataFrame], batch_id: str | None
) -> IngestResult:
    """Store a batch unless the table holds it already, and hand out what was kept of it.

    ``accepted`` is empty for a replay whose rows have been joined with others by a rewrite of the table.

    ``rows`` gets the run's staging folder, writes there what it reads from the caller, so that this is read
    once, and is not asked for a batch that is there already.
    """
    batch_id = batch_id or f"ingest-{uuid.uuid4().hex}"
    if not warehouse.has_batch(table, batch_id):
        run = warehouse.staging(batch_id)
        try:
            _store(warehouse, table, rows(run), batch_id, run)
        finally:
            warehouse.clear(run)
    return IngestResult(
        batch_id,
        warehouse.read_batch(table, batch_id),
        warehouse.log_batch(table, REJECTED_ROWS, batch_id, judged_schema(warehouse.specs[table])),
        warehouse.log_batch(table, REQUESTS, batch_id, SUMMARY_SCHEMA),
    )


def _store(warehouse: Warehouse, table: str, rows: DataFrame, batch_id: str, run: str) -> None:
    """Judge once into the batch's own folder, split by verdict; ids, rows and summary all come from there.

    One commit makes rows, rejects and summary visible together.
    """
    spec = warehouse.specs[table]
    path = warehouse.new_batch(table, batch_id)
    judged_against = {fk.parent: warehouse.state(fk.parent) for fk in spec.foreign_keys}
    parents = {name: warehouse.read(name, state=state) for name, state in judged_against.items()}
    logged_at = F.lit(datetime.now(timezone.utc).replace(tzinfo=None)).cast("timestamp_ntz")
    judged = judge_request_rows(rows, spec, parents, run).withColumn("logged_at", logged_at)
    verdict = (
        F.when(F.col("reason_code").isNotNull(), REJECTED_ROWS).when(~F.col("is_row"), EMPTY).otherwise(TO_NUMBER)
    )
    try:
        # Sorted by verdict first, the split by folder keeps each request's rows in order of ordinal.
        (
            judged.withColumn("verdict", verdict)
            .sortWithinPartitions("verdict", "request_id", "ordinal")
            .write.partitionBy("verdict")
            .parquet(path)
        )
        read = warehouse.spark.read.schema(judged_schema(spec))
        _summarize(read.option("basePath", path).parquet(path), path)
        to_number = f"{path}/verdict={TO_NUMBER}"
        if warehouse.files.exists(to_number):
            good = read.parquet(to_number).drop("verdict")
            _commit_numbered(warehouse, table, good, path, batch_id, judged_against, run)
        else:
            _tidy(warehouse, path)
            warehouse.publish_all({table: Batch(path, 0)}, batch_id)
    except BaseException:
        warehouse.clear(path)
        raise


def _summarize(judged: DataFrame, path: str) -> None:
    summarize(judged).write.mode("overwrite").parquet(f"{path}/verdict={REQUESTS}")


def _commit_numbered(
    warehouse: Warehouse, table: str, rows: DataFrame, path: str, batch_id: str,
    judged_against: dict[str, TableState], run: str,
) -> None:
    """Number the good rows from a key range of their own, write them and commit.

    The range is reserved first, so writers at the same time do not wait for each other and write their
    rows once. They are written again only if the range ended, as it does when the table is restored
    meanwhile, or if rows of a parent have left that some of them point at; those are then refused.
    """
    spec = warehouse.specs[table]
    key_type = spec.schema[spec.key].dataType
    sizes = rows_per_file(rows)
    lease, staged = None, False
    while True:
        if lease is None:
            lease = warehouse.lease(table, sum(n for _, n in sizes))
            staged = False
        if not staged:
            numbered, last = number_rows(rows, spec.key, lease.first - 1, key_type, sizes)
            warehouse.stage(table, _stored_row(numbered, spec), path)
            staged = True
        try:
            if not warehouse.publish_all({table: Batch(path, last, lease=lease)}, batch_id, judged_against):
                warehouse.clear(path)
        except LeaseEnded:
            lease = None
        except ParentMoved:
            judged_against, lost = _lost_parents(warehouse, spec, rows, run)
            if not lost.isEmpty():
                rows = _without_lost(warehouse, spec, rows, lost, path, run)
                sizes, staged = rows_per_file(rows), False
        else:
            _tidy(warehouse, path)
            return


def _lost_parents(
    warehouse: Warehouse, spec: TableSpec, rows: DataFrame, run: str
) -> tuple[dict[str, TableState], DataFrame]:
    """The parents' states now, and the keys ``_column, _lost`` that ``rows`` point at and that have left.

    Only distinct keys meet the parents. A parent that was dropped and not created again has no keys.
    """
    known = warehouse.tables()
    now = {fk.parent: known[fk.parent] for fk in spec.foreign_keys if fk.parent in known}
    gone = []
    for fk in spec.foreign_keys:
        used = rows.select(F.col(fk.column).cast("bigint").alias("_lost")).where(F.col("_lost").isNotNull()).distinct()
        if fk.parent in now:
            ids = warehouse.read(fk.parent, state=now[fk.parent]).select(F.col(fk.parent_key).cast("bigint").alias("_lost"))
            used = used.join(ids, "_lost", "left_anti")
        gone.append(used.select(F.lit(fk.column).alias("_column"), "_lost"))
    return now, written(reduce(DataFrame.unionByName, gone), "lost-parents", run)


def _without_lost(
    warehouse: Warehouse, spec: TableSpec, rows: DataFrame, lost: DataFrame, path: str, run: str
) -> DataFrame:
    """Move the rows that point at lost parents to the rejected ones; returns the others, written."""
    flagged = rows
    for i, fk in enumerate(spec.foreign_keys):
        keys = lost.where(F.col("_column") == fk.column).select(F.col("_lost").alias(f"_lost_{i}"))
        flagged = flagged.join(keys, F.col(fk.column) == F.col(f"_lost_{i}"), "left")
    marks = [F.col(f"_lost_{i}").isNotNull() for i in range(len(spec.foreign_keys))]
    flagged = written(flagged.withColumn("_orphan", reduce(or_, marks)).select(*rows.columns, "_orphan"), "flagged", run)
    refused = refuse_orphans(flagged.where("_orphan").drop("_orphan"), spec)
    refused.select(*rows.columns).write.mode("append").parquet(f"{path}/verdict={REJECTED_ROWS}")
    left = written(
        flagged.where("not _orphan").drop("_orphan").sortWithinPartitions("request_id", "ordinal"), "still-good", run
    )
    read = warehouse.spark.read.schema(judged_schema(spec))
    kinds = [f"{path}/verdict={k}" for k in (REJECTED_ROWS, EMPTY) if warehouse.files.exists(f"{path}/verdict={k}")]
    _summarize(read.parquet(*kinds).unionByName(left), path)
    return left


def _tidy(warehouse: Warehouse, path: str) -> None:
    """Remove what the batch needed on the way."""
    for kind in (TO_NUMBER, EMPTY):
        warehouse.clear(f"{path}/verdict={kind}")


def judged_schema(spec: TableSpec) -> T.StructType:
    """Columns of a judged request row: datetimes still text, whole numbers as wide as JSON gives them."""
    fields = [T.StructField("request_id", T.StringType()), T.StructField("ordinal", T.IntegerType())]
    for f in spec.row_fields:
        wide = T.LongType() if isinstance(f.dataType, T.IntegralType) else T.StringType()
        fields.append(T.StructField(f.name, wide))
    fields.append(T.StructField("unread", T.MapType(T.StringType(), T.StringType())))
    fields.append(T.StructField("is_row", T.BooleanType()))
    for name in ("request_status", "reason_code", "reason"):
        fields.append(T.StructField(name, T.StringType()))
    return T.StructType(fields + [T.StructField("logged_at", T.TimestampNTZType())])


def _stored_row(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Request types to table types; every value was judged readable."""
    columns = []
    for f in spec.schema:
        value = F.col(f.name)
        if isinstance(f.dataType, T.TimestampNTZType):
            value = parse_datetime(value)
        columns.append(value.cast(f.dataType).alias(f.name))
    return rows.select(*columns)
