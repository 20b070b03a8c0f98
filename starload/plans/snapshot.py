"""Back up a table to Avro, and replace a table by a backup."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starload.commits import Intervals
from starload.files import Files
from starload.functions.times import datetime_text, parse_datetime, to_seconds
from starload.operators.checksums import added, checksum, limb_sums
from starload.operators.constraints import audit
from starload.operators.references import orphans, touching
from starload.sources.avro import container_files, read_avro, write_avro
from starload.spec import TableSpec
from starload.warehouse import ACCEPTED, Warehouse

SKIPPED = "skipped"
MANIFEST = "_manifest"
CLAIM = "_started"
"""Created first, so that of two backups to one folder only one goes on."""


@dataclass(frozen=True)
class RestoreReport:
    rows: int
    unreadable: dict[str, int]
    """Per datetime column: texts that could not be read and became null."""
    orphans: int | None
    """Rows whose foreign key has no parent, when asked for."""
    orphan_keys: DataFrame | None = None
    """When asked for: ``child, column, parent, key, rows`` per key without parent, in this table and in those
    that point at it."""


def snapshot_schema(spec: TableSpec) -> T.StructType:
    """The table's schema with datetimes as text, which is how a snapshot holds them."""
    return T.StructType(
        [
            T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.TimestampNTZType) else f.dataType, f.nullable)
            for f in spec.schema
        ]
    )


def backup(warehouse: Warehouse, table: str, root: str, now: datetime | None = None) -> str:
    """Write ``<root>/<table>/<table>_backup_<time>.avro/`` and return it, or "skipped" for an empty table.

    A second backup within the same second is refused. The row count and a checksum of the rows, written last,
    mark it as complete; with them go the ids of the batches whose rows it holds.
    """
    state = warehouse.state(table)
    target = _target(root, table, now)
    return write_snapshot(warehouse.read(table, state=state), warehouse.specs[table], target, list(state.batches), state.taken)


def backup_changes(
    warehouse: Warehouse, table: str, root: str, parent: str | None = None, now: datetime | None = None
) -> str:
    """Like ``backup``, but only what the chain that ends in ``parent`` does not hold; without one, a chain begins.

    Batch folders are written once and never changed, so those that the parent's manifest names need no copy.
    Each folder's rows are container files under ``part=<folder>``; the manifest says for every folder of the
    table which snapshot beside this one has it, with its rows and checksum. ``restore`` takes such a snapshot like
    any other, and needs those that it names.
    """
    spec, state = warehouse.specs[table], warehouse.state(table)
    if not state.folders:
        return SKIPPED
    target = _target(root, table, now)
    held: dict[str, dict] = {}
    if parent is not None:
        held = _manifest(warehouse.spark, parent).get("parts")
        if held is None or parent.rsplit("/", 1)[0] != target.rsplit("/", 1)[0]:
            raise ValueError(f"{parent} is not a snapshot of a chain in the folder of {target}")
    files = Files(warehouse.spark)
    if files.exists(target) or not files.create_new(f"{target}/{CLAIM}", spec.name):
        raise FileExistsError(target)
    new = [f for f in state.folders if f not in held]
    parts = {f: held[f] for f in state.folders if f in held}
    try:
        if new:
            rows = warehouse.read_parts(table, state, new)
            kept = rows.withColumns({c: to_seconds(F.col(c)) for c in _times(spec)})
            sums = kept.groupBy("part").agg(F.count(F.lit(1)).alias("rows"), *limb_sums(spec.schema)).collect()
            write_avro(rows.select(*_texts(spec), "part"), target, spec.name, snapshot_schema(spec), ["part"])
            here = target.rsplit("/", 1)[1]
            none = {"at": here, "rows": 0, "checksum": checksum()}
            parts |= {f: none for f in new} | {r["part"]: {"at": here, "rows": r["rows"], "checksum": checksum(r)} for r in sums}
        manifest = {
            "rows": sum(p["rows"] for p in parts.values()), "checksum": added([p["checksum"] for p in parts.values()]),
            "table": spec.name, "batches": list(state.batches), "taken": state.taken, "parts": parts,
        }
        files.create_new(f"{target}/{MANIFEST}", json.dumps(manifest))
    except BaseException:
        files.delete(target)
        raise
    return target


def _target(root: str, table: str, now: datetime | None) -> str:
    stamp = (now or datetime.now()).strftime("%Y%m%d_%H%M%S")
    return f"{root.rstrip('/')}/{table}/{table}_backup_{stamp}.avro"


def write_snapshot(
    rows: DataFrame, spec: TableSpec, target: str, batches: Sequence[str] = (), taken: Mapping[str, Intervals] | None = None
) -> str:
    spark = rows.sparkSession
    files = Files(spark)
    if rows.isEmpty():
        return SKIPPED
    if files.exists(target) or not files.create_new(f"{target}/{CLAIM}", spec.name):
        raise FileExistsError(target)
    try:
        write_avro(rows.select(*_texts(spec)), target, spec.name, snapshot_schema(spec))
        kept = rows.withColumns({c: to_seconds(F.col(c)) for c in _times(spec)})
        sums = kept.agg(F.count(F.lit(1)).alias("rows"), *limb_sums(spec.schema)).first()
        manifest = {
            "rows": sums["rows"], "checksum": checksum(sums), "table": spec.name, "batches": list(batches), "taken": dict(taken or {}),
        }
        files.create_new(f"{target}/{MANIFEST}", json.dumps(manifest))
    except BaseException:
        files.delete(target)
        raise
    return target


def _texts(spec: TableSpec) -> list[Column]:
    """The table's columns as a snapshot holds them."""
    return [_whole_seconds_text(f.name) if isinstance(f.dataType, T.TimestampNTZType) else F.col(f.name) for f in spec.schema]


def _whole_seconds_text(column: str) -> Column:
    """Rounded half up; a year that four digits cannot hold fails the backup rather than the restore."""
    rounded = to_seconds(F.col(column))
    fits = F.year(rounded).between(0, 9999) | rounded.isNull()
    refusal = F.raise_error(F.concat(F.lit(f"{column} cannot be kept in a snapshot: "), rounded.cast("string")))
    return F.when(fits, datetime_text(rounded)).otherwise(refusal.cast("string")).alias(column)


def read_snapshot(spark: SparkSession, spec: TableSpec, path: str) -> DataFrame:
    """Rows with the declared types. Datetime text that cannot be read, such as NaT, is null."""
    return _typed(read_avro(spark, _part_paths(spark, path, _manifest(spark, path)), snapshot_schema(spec)), spec)


def restore(
    warehouse: Warehouse, table: str, path: str, check_fk: bool = False, expected_rows: int | None = None,
    trust_unverified: bool = False,
) -> RestoreReport:
    """Replace the table by a snapshot; on any failure the table stays as it was.

    The rows are staged with the declared types and must keep the declared key, NOT NULL and length
    rules. Foreign keys are not a condition, since parents may be restored later: ``check_fk`` counts the
    table's orphans and lists the keys without parent, those of the tables that point at this one included.

    Avro readers take a file cut short at a block for its end, so the rows are counted against the
    snapshot's manifest, and their checksum, which does not depend on their order, must be the manifest's: a file
    replaced by another of as many rows is found. One without a manifest needs ``expected_rows``, or
    ``trust_unverified`` to take what can be read. The table then counts as taken in the batches that the
    snapshot names, and no others.
    """
    spark, spec = warehouse.spark, warehouse.specs[table]
    manifest = _manifest(spark, path)
    paths = _part_paths(spark, path, manifest)
    expected = manifest.get("rows", expected_rows)
    if expected is None and not trust_unverified:
        raise ValueError(f"{path} has no row count: give expected_rows, or trust_unverified=True to take what is there")
    staged = warehouse.new_batch(table, "restore")
    try:
        raw = read_avro(spark, paths, snapshot_schema(spec))
        warehouse.stage(table, _typed(raw, spec, flag_lost=True), staged, [f"_lost_{c}" for c in _times(spec)])
        rows = spark.read.schema(_staged_schema(spec)).parquet(f"{staged}/verdict={ACCEPTED}")
        lost = [F.count_if(f"_lost_{c}").alias(c) for c in _times(spec)]
        summed = limb_sums(spec.schema) if "checksum" in manifest else []
        totals = rows.agg(F.count(F.lit(1)).alias("_rows"), F.max(spec.key).alias("_largest"), *lost, *summed).first().asDict()
        count, largest = totals["_rows"], totals["_largest"] or 0
        if expected is not None and count != expected:
            raise ValueError(f"{path} holds {count} rows, {expected} were written")
        if summed and checksum(totals) != manifest["checksum"]:
            raise ValueError(f"{path} holds other rows than were written")
        orphaned = _check_rules(warehouse, spec, rows, path, check_fk)
        warehouse.replace(
            table, staged, f"restore-{uuid.uuid4().hex}", largest, manifest.get("batches", ()), manifest.get("taken")
        )
    except BaseException:
        warehouse.clear(staged)
        raise
    keys = orphan_report(warehouse, table) if check_fk else None
    return RestoreReport(count, {c: totals[c] for c in _times(spec)}, orphaned, keys)


def orphan_report(warehouse: Warehouse, table: str) -> DataFrame:
    """Keys without parent, in ``table`` and in the tables that point at it: ``child, column, parent, key, rows``.

    The tables are those of one version.
    """
    known = warehouse.tables()
    edges = [e for e in touching(warehouse.specs.values(), table) if e.child in known and e.key.parent in known]
    names = {n for e in edges for n in (e.child, e.key.parent)} | {table}
    return orphans({n: warehouse.read(n, state=known[n]) for n in names}, edges)


def _part_paths(spark: SparkSession, path: str, manifest: dict) -> str | list[str]:
    """Where the rows of a snapshot are: the snapshot itself, or the folders of its chain."""
    parts = manifest.get("parts")
    if parts is None:
        container_files(spark, path)
        return path
    beside = path.rsplit("/", 1)[0]
    return [f"{beside}/{p['at']}/part={folder}" for folder, p in parts.items() if p["rows"]]


def _check_rules(warehouse: Warehouse, spec: TableSpec, rows: DataFrame, path: str, check_fk: bool) -> int | None:
    """Raise when a rule of the table is broken; returns the number of orphans when asked for."""
    parents = {fk.parent: warehouse.read(fk.parent) for fk in spec.foreign_keys} if check_fk else None
    broken = {r["rule"]: r["violations"] for r in audit(rows, spec, parents).collect() if r["violations"]}
    orphans = sum(broken.pop(f"foreign_key:{fk.column}", 0) for fk in spec.foreign_keys)
    if broken:
        raise ValueError(f"{path} breaks the rules of {spec.name}: {broken}")
    return orphans if check_fk else None


def _times(spec: TableSpec) -> list[str]:
    return [f.name for f in spec.schema if isinstance(f.dataType, T.TimestampNTZType)]


def _typed(raw: DataFrame, spec: TableSpec, flag_lost: bool = False) -> DataFrame:
    """Declared types; with ``flag_lost`` also a flag per datetime whose text could not be read."""
    times = _times(spec)
    values = [
        (parse_datetime(F.col(f.name)) if f.name in times else F.col(f.name).cast(f.dataType)).alias(f.name)
        for f in spec.schema
    ]
    flags = [(F.col(c).isNotNull() & parse_datetime(F.col(c)).isNull()).alias(f"_lost_{c}") for c in times if flag_lost]
    return raw.select(*values, *flags)


def _staged_schema(spec: TableSpec) -> T.StructType:
    flags = [T.StructField(f"_lost_{c}", T.BooleanType()) for c in _times(spec)]
    return T.StructType([T.StructField(f.name, f.dataType) for f in spec.schema] + flags)


def _manifest(spark: SparkSession, path: str) -> dict:
    """Row count and batch ids written beside the snapshot; empty when there is none."""
    files, manifest = Files(spark), f"{path}/{MANIFEST}"
    if files.is_file(manifest):
        return json.loads(files.read_text(manifest))
    if files.names(manifest):  # as a folder of one JSON line, in older snapshots
        return {"rows": spark.read.json(manifest, schema="rows bigint").first()["rows"]}
    return {}
