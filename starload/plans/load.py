"""Historical load: delimited files into the declared tables."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starload.operators.judge import DUPLICATE_KEY, judge_loaded_rows
from starload.operators.keys import first_positions
from starload.session import broadcastable, written
from starload.sources.delimited import POSITION, mended, read_lines
from starload.spec import TableSpec
from starload.warehouse import ACCEPTED, Batch, Warehouse

REJECTED_LINES = "rejected_lines"


@dataclass(frozen=True)
class LoadReport:
    """``counts``: per table and reason_code (None = stored) the rows, lines_with_extra_fields, largest_key."""

    batch_id: str
    counts: list[Row]

    def stored(self, table: str) -> int:
        return sum(r["rows"] for r in self.counts if r["table"] == table and r["reason_code"] is None)


def load_history(
    warehouse: Warehouse, paths: Mapping[str, str | Sequence[str]], batch_id: str | None = None, **format_options: str
) -> LoadReport:
    """Load every table in ``paths``, parents first; nothing is published until all are staged.

    The first line of a key wins, and a key already stored is skipped, so loading the same files
    again adds nothing. Rows not stored are kept with their reason. One commit shows all tables; it is
    refused with ``ConcurrentWrite`` when another writer has changed one of them since the load began, or when rows
    of a parent that is not loaded may have left.
    """
    batch_id = batch_id or f"load-{uuid.uuid4().hex}"
    logged_at = datetime.now(timezone.utc).replace(tzinfo=None)
    warehouse.create()
    run = warehouse.staging(batch_id)
    before = {name: warehouse.state(name) for name in paths}
    outside = {fk.parent for name in paths for fk in warehouse.specs[name].foreign_keys} - set(paths)
    parents = {name: warehouse.state(name) for name in outside}
    folders = {name: warehouse.new_batch(name, batch_id) for name in paths}
    try:
        staged: dict[str, str] = {}
        for wave in _waves(warehouse, paths):
            with ThreadPoolExecutor(len(wave)) as pool:
                stage = inheritable_thread_target(warehouse.spark)(
                    lambda spec: _stage_judged(
                        warehouse, spec, _records(warehouse, spec, paths[spec.name], run, **format_options),
                        staged, logged_at, run, folders[spec.name],
                    )
                )
                staged |= dict(zip([spec.name for spec in wave], list(pool.map(stage, wave))))
        totals = {name: _totals(warehouse, name, path) for name, path in staged.items()}
        warehouse.publish_all(
            {name: Batch(path, _largest(totals[name]), before[name]) for name, path in staged.items()}, batch_id, parents
        )
    except BaseException:
        for path in folders.values():
            warehouse.clear(path)
        raise
    finally:
        warehouse.clear(run)
    return LoadReport(batch_id, [row for rows in totals.values() for row in rows])


def _waves(warehouse: Warehouse, paths: Mapping[str, str | Sequence[str]]) -> list[list[TableSpec]]:
    """Tables to load, parents in an earlier wave than the tables that point at them.

    The tables of one wave do not depend on each other and are staged at the same time.
    """
    left = {name: spec for name, spec in warehouse.specs.items() if name in paths}
    waves = []
    while left:
        wave = [s for s in left.values() if not any(fk.parent in left and fk.parent != s.name for fk in s.foreign_keys)]
        if not wave:
            raise ValueError(f"foreign keys of {sorted(left)} form a circle")
        waves.append(wave)
        left = {name: spec for name, spec in left.items() if spec not in wave}
    return waves


def _records(
    warehouse: Warehouse, spec: TableSpec, paths: str | Sequence[str], run: str, **format_options: str
) -> DataFrame:
    """The typed records, written, with their text: the files are parsed once and rejected ones keep their text."""
    lines = written(read_lines(warehouse.spark, paths, spec, **format_options), f"{spec.name}-lines", run)
    return mended(lines, spec, scratch=run, **format_options)


def _stage_judged(warehouse: Warehouse, spec: TableSpec, lines: DataFrame, staged: Mapping[str, str],
                  logged_at: datetime, run: str, path: str) -> str:
    """Write the judged rows to ``path``, split into accepted and rejected ones, and return it."""
    folders = ["verdict"] + ([spec.year_column] if spec.year_column else [])
    out = judged_lines(warehouse, spec, lines, staged, logged_at, run)
    out.write.partitionBy(*folders).parquet(path)
    return path


def judged_lines(warehouse: Warehouse, spec: TableSpec, lines: DataFrame, staged: Mapping[str, str],
                 logged_at: datetime, run: str) -> DataFrame:
    """Records with verdict and reason, laid out to be written.

    The parent and key rules read a few columns of ``lines`` and end in one small table of keys, which is joined
    to them. Whole lines are shuffled once: by the rebalance before the write or, where the table of keys is too
    large to broadcast, by that join, whose partitions are then written as they are.
    """
    parents = {fk.parent: _parent_rows(warehouse, fk.parent, staged) for fk in spec.foreign_keys}
    rows = judge_loaded_rows(lines, spec, parents, run)
    repeated = F.lit(False)
    marks = _key_marks(warehouse, spec, rows.where(F.col("reason_code").isNull()), run)
    if marks is not None:
        # A line refused already takes a place of its own and so meets no other on a null or broken key.
        valid = F.col("reason_code").isNull()
        place = F.coalesce(F.when(valid, F.col(spec.key).cast("bigint")), F.xxhash64(*POSITION))
        rows = rows.withColumn("_place", place)
        rows = rows.join(marks, (rows["_place"] == marks["_key"]) & valid, "left")
        later = F.struct(*POSITION) != F.col("_first")
        repeated = F.coalesce(F.col("_present"), F.lit(False)) | F.coalesce(later, F.lit(False))

    code = F.coalesce(F.col("reason_code"), F.when(repeated, F.lit(DUPLICATE_KEY)))
    rejected = F.col("reason_code").isNotNull()
    out = rows.withColumn("reason_code", code).select(
        *spec.columns,
        F.when(rejected, F.col("line")).alias("line"),
        "reason_code",
        F.when(rejected, F.col("src_file")).alias("src_file"),
        F.when(rejected, F.lit(logged_at).cast("timestamp_ntz")).alias("logged_at"),
        (F.col("extra_fields") > 0).alias("has_extra_fields"),
        F.when(rejected, F.lit(REJECTED_LINES)).otherwise(F.lit(ACCEPTED)).alias("verdict"),
    )
    out = warehouse.with_year(spec.name, out)
    if marks is not None and not broadcastable(marks):
        return out
    return out.hint("rebalance", "verdict", *([spec.year_column] if spec.year_column else []))


def _key_marks(warehouse: Warehouse, spec: TableSpec, valid: DataFrame, run: str) -> DataFrame | None:
    """Keys that stand in more than one line or are stored: ``_key, _first, _present``. None when there are none."""
    unset = F.lit(None).cast(T.StructType([valid.schema[c] for c in POSITION]))
    key = F.col(spec.key).cast("bigint").alias("_key")
    parts = []
    firsts = first_positions(valid, spec.key, POSITION, run)
    if firsts is not None:
        parts.append(firsts.select(key, F.col("_first"), F.lit(False).alias("_present")))
    if not warehouse.is_empty(spec.name):
        present = warehouse.present_keys(spec.name, valid, run)
        parts.append(present.select(key, unset.alias("_first"), F.lit(True).alias("_present")))
    if not parts:
        return None
    marks = reduce(DataFrame.unionByName, parts).groupBy("_key")
    return written(marks.agg(F.max("_first").alias("_first"), F.bool_or("_present").alias("_present")), "marks", run)


def _parent_rows(warehouse: Warehouse, parent: str, staged: Mapping[str, str]) -> DataFrame:
    """Stored parent keys plus those this load is about to store."""
    key = warehouse.specs[parent].key
    rows = warehouse.read(parent).select(key)
    if parent in staged:
        rows = rows.unionByName(_judged(warehouse, parent, staged[parent]).where(F.col("verdict") == ACCEPTED).select(key))
    return rows


def _judged(warehouse: Warehouse, name: str, path: str) -> DataFrame:
    spec = warehouse.specs[name]
    columns = ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in spec.schema]
        + ["line string", "reason_code string", "has_extra_fields boolean", "verdict string"]
    )
    return warehouse.spark.read.schema(columns).parquet(path)


def _totals(warehouse: Warehouse, name: str, path: str) -> list[Row]:
    """One row per reason: how many rows, how many lines with extra fields, the largest key."""
    totals = _judged(warehouse, name, path).groupBy("reason_code").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if("has_extra_fields").alias("lines_with_extra_fields"),
        F.max(warehouse.specs[name].key).alias("largest_key"),
    )
    return totals.withColumn("table", F.lit(name)).collect()


def _largest(totals: list[Row]) -> int:
    return max((r["largest_key"] or 0 for r in totals if r["reason_code"] is None), default=0)
