"""Where the tables live: Parquet folders that are written once, and a commit record that names them.

    <root>/commits/0000/00/00000001.json                               see ``commits``
    <root>/tables/<table>/<home>/batch=<name>/verdict=accepted/[<ts>_year=<y>/]part-*.parquet
    <root>/tables/<table>/<home>/batch=<name>/verdict=<kind>/part-*.parquet   rejected rows, request summaries
    <root>/tables/<table>/<home>/counts=<run>/part=<name>/part-*.parquet      report counts of a batch folder
    <root>/tables/<table>/<home>/filters=<run>/part=<name>/part-*.parquet     key filters of a batch folder
    <root>/tables/<table>/<home>/keys=<run>/part=<name>/slice=<n>/part-*.parquet    its keys, by hash
    <root>/staging/<run>/...                                           removed when the run is over

Executors write a batch where it stays. It becomes visible by one small file that is created only if no
other writer was first, so nothing is copied, moved or seen in part, and any number of writers may work on
a table. A folder that no commit names, as a writer that died leaves it, is never read. Each creation of a table
has a home of its own: what was written for a table that has been dropped since cannot get into its successor.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starload.commits import ACCEPTED, MOST_LEASES, Commits, Intervals, KeyIndex, Tables, TableState, numbered
from starload.files import Files
from starload.operators.keys import present_keys
from starload.operators.membership import PER_SLICE, filter_words, layout, may_hold, placed
from starload.operators.partial_counts import added_counts, counts_schema, partial_counts
from starload.session import written
from starload.spec import STAR, TableSpec

FAN_IN = 16
"""Folders of one tier that are joined to one of the next, so a row is rewritten once per tier."""
BATCH_ID = "_batch"
"""Column of a joined log that says which batch a row came with."""


class ConcurrentWrite(RuntimeError):
    """Another writer changed the table after it was read, so what was made from it cannot be committed."""


class TableGone(ConcurrentWrite):
    """The table was dropped, or dropped and created anew, after the rows were written for it."""


class LeaseEnded(ConcurrentWrite):
    """The key range was given up, because the table was restored or took in keys of that range."""


class ParentMoved(ConcurrentWrite):
    """Rows of a parent may have left since the batch was judged against it."""


@dataclass(frozen=True)
class Lease:
    """Keys ``first`` to ``last``, which no other writer is given."""

    id: str
    first: int
    last: int


@dataclass(frozen=True)
class Batch:
    """A written folder, ready to be committed. ``largest`` is read from its rows when not known.

    ``base``, when given, is the state of the table that the rows rest on; the commit is refused if it moved.
    ``lease`` is the key range that the rows were numbered from; the commit is refused if it ended.
    """

    path: str
    largest: int | None = None
    base: TableState | None = None
    lease: Lease | None = None


class Warehouse:
    def __init__(self, spark: SparkSession, root: str, specs: Iterable[TableSpec] = STAR):
        self.spark = spark
        self.root = root.rstrip("/")
        self.specs = {spec.name: spec for spec in specs}
        self.files = Files(spark)
        self.commits = Commits(self.files, f"{self.root}/commits")

    # -- definition ---------------------------------------------------------------------------

    def create(self) -> None:
        """Create the tables that do not exist yet; existing ones are left alone."""

        def edit(tables: Tables) -> Tables | None:
            absent = {name: TableState(uuid.uuid4().hex) for name in self.specs if name not in tables}
            return tables | absent if absent else None

        self.commits.change(edit)

    def drop(self, name: str) -> None:
        """Remove the table, with its logs and its memory of batches, if it exists.

        Its home is deleted once no commit can name a folder there any more: a writer that has staged rows
        is refused with ``TableGone``, and the home of a table created meanwhile is another one.
        """
        homes: list[str] = []

        def edit(tables: Tables) -> Tables | None:
            homes[:] = [self._home(name, tables[name])] if name in tables else []
            return {n: s for n, s in tables.items() if n != name} if homes else None

        if self.commits.change(edit):
            self.files.delete(homes[0])

    def register_views(self) -> None:
        """Offer every table to SQL as a temporary view of its own name."""
        for name in self.specs:
            self.read(name).createOrReplaceTempView(name)

    # -- reading ------------------------------------------------------------------------------

    def tables(self) -> Tables:
        """All tables in the newest version."""
        return self.commits.latest()[1]

    def state(self, name: str) -> TableState:
        """The table in the newest version."""
        tables = self.tables()
        if name not in tables:
            raise LookupError(f"table {name} does not exist; call create()")
        return tables[name]

    def read(self, name: str, year: int | None = None, state: TableState | None = None) -> DataFrame:
        """The table with its declared columns; ``year`` prunes the folders of a table kept by year.

        ``state`` reads the table as it was in a version seen before.
        """
        spec = self.specs[name]
        state = state or self.state(name)
        stored = self._rows(name, state, state.folders)
        if year is not None and spec.year_column:
            stored = stored.where(F.col(spec.year_column) == year)
        return stored.select(*spec.columns)

    def read_parts(self, name: str, state: TableState, folders: Sequence[str], year: int | None = None) -> DataFrame:
        """The rows of some folders of a state, with the folder as ``part``; ``year`` as in ``read``."""
        spec = self.specs[name]
        stored = self._rows(name, state, folders)
        if year is not None and spec.year_column:
            stored = stored.where(F.col(spec.year_column) == year)
        return stored.select(*spec.columns, F.col("batch").alias("part"))

    def read_counts(self, name: str, state: TableState, folders: Sequence[str]) -> DataFrame:
        """The kept ``partial_counts`` of some folders that have them, with the folder as ``part``."""
        names = [T.StructField(c, T.StringType()) for c in ("counts", "part")]
        schema = T.StructType(counts_schema(self.specs[name]).fields + names)
        paths = [self._counts(name, state, f) for f in folders if state.counted[f]]
        if not paths:
            return self.spark.createDataFrame([], schema).drop("counts")
        return self.spark.read.schema(schema).option("basePath", self._home(name, state)).parquet(*paths).drop("counts")

    def read_batch(self, name: str, batch_id: str) -> DataFrame:
        """The rows of one batch, empty when the table no longer keeps it apart."""
        state = self.state(name)
        folder = state.batches.get(batch_id)
        return self._rows(name, state, [f for f in state.folders if f == folder]).select(*self.specs[name].columns)

    def max_id(self, name: str) -> int:
        """Largest key stored, 0 for an empty table."""
        return self.state(name).largest

    def is_empty(self, name: str) -> bool:
        """Whether no batch makes up the table; answered from the commit record."""
        return not self.state(name).folders

    def has_batch(self, name: str, batch_id: str) -> bool:
        """Whether the table holds what the batch brought, also when its rows have been rewritten since."""
        return self.state(name).holds(batch_id)

    def log(self, name: str, kind: str) -> DataFrame | None:
        """What all batches kept beside their rows, for instance the rejected ones; None when there is nothing."""
        state = self.state(name)
        rows = self._log(name, state, kind, state.parts)
        if rows is not None and any(_tier(f) for f in state.parts):
            rows = rows.where(_held(F.col("batch"), state))  # a joined log may tell of batches that a restore undid
        return rows

    def log_batch(self, name: str, kind: str, batch_id: str, schema: T.StructType | str) -> DataFrame:
        state = self.state(name)
        apart = state.batches.get(batch_id)
        if apart and kind in state.parts.get(apart, ()):
            return self.spark.read.schema(schema).parquet(self._kind(self._batch(name, state, apart), kind))
        empty = self.spark.createDataFrame([], schema)
        joined = self._log(name, state, kind, [f for f in state.parts if _tier(f)]) if state.holds(batch_id) and not apart else None
        return empty if joined is None else joined.where(F.col("batch") == batch_id).select(*empty.columns)

    # -- writing ------------------------------------------------------------------------------

    def staging(self, label: str, run: str | None = None) -> str:
        """A new folder name for intermediate data, under the folder of ``run`` when given."""
        return f"{run or self.root + '/staging'}/{label}-{uuid.uuid4().hex}"

    def clear(self, folder: str) -> None:
        """Remove a run's own folder."""
        self.files.delete(folder)

    def new_batch(self, name: str, label: str = "batch") -> str:
        """A new folder name inside the table; nothing there is read before it is committed."""
        if not re.fullmatch(r"[\w.-]+", label):
            raise ValueError(f"batch id {label!r} cannot name a folder")
        return self._batch(name, self.state(name), f"{label}~{uuid.uuid4().hex}")

    def with_year(self, name: str, rows: DataFrame) -> DataFrame:
        spec = self.specs[name]
        return rows.withColumn(spec.year_column, F.year(spec.year_of)) if spec.year_column else rows

    def stage(self, name: str, rows: DataFrame, path: str | None = None, extra: Sequence[str] = ()) -> str:
        """Write rows of a table to a batch folder and return it. Readers never see ``extra`` columns.

        The rebalance hint gives files of even size: AQE splits a year that holds most rows and
        joins small ones, where a plain partitioned write makes one file per task and year. Rows that an
        earlier attempt left in ``path`` are replaced.
        """
        spec = self.specs[name]
        path = path or self.new_batch(name)
        rows = self.with_year(name, rows.select(*spec.columns, *extra))
        if spec.year_column:
            writer = rows.hint("rebalance", spec.year_column).write.partitionBy(spec.year_column)
        else:
            writer = rows.hint("rebalance").write
        writer.mode("overwrite").parquet(self._kind(path, ACCEPTED))
        return path

    def lease(self, name: str, keys: int) -> Lease:
        """Reserve the next ``keys`` keys by a commit of its own, before any row is numbered.

        Writers at the same time get ranges that do not meet, so none numbers its rows twice. Keys of a
        range that is not used up, or whose writer dies, stay gaps.
        """
        got: list[Lease] = []

        def edit(tables: Tables) -> Tables:
            state = self._known(tables, name)
            first = max(state.largest, state.reserved) + 1
            got[:] = [Lease(uuid.uuid4().hex, first, first + keys - 1)]
            leases = dict(list(state.leases.items())[-(MOST_LEASES - 1) :]) | {got[0].id: [first, got[0].last]}
            return tables | {name: replace(state, leases=leases, reserved=got[0].last)}

        self.commits.change(edit)
        return got[0]

    def publish(self, name: str, staged: str, batch_id: str, largest: int | None = None) -> bool:
        """Make a written folder a batch of the table; False when that batch is already there."""
        return self.publish_all({name: Batch(staged, largest)}, batch_id)

    def publish_all(
        self, batches: Mapping[str, Batch], batch_id: str, judged_against: Mapping[str, TableState] | None = None
    ) -> bool:
        """Add one folder to each of several tables by one commit, or to none of them.

        False when one of the tables has that batch. ``ConcurrentWrite`` when a table is no longer as its
        batch's ``base`` says, ``TableGone`` when it was dropped meanwhile, ``LeaseEnded`` when the batch's key range
        is no longer its own. ``judged_against`` names the states of the parents that the rows were judged by:
        ``ParentMoved`` when rows of one may have left since; parents that only grew do not matter.
        """
        entries = {name: self._entry(name, batch) for name, batch in batches.items()}

        def edit(tables: Tables) -> Tables | None:
            if any(self._known(tables, name).holds(batch_id) for name in batches):
                return None
            for parent, seen in (judged_against or {}).items():
                if parent not in tables or not tables[parent].keeps(seen):
                    raise ParentMoved(f"{parent} was dropped, restored or rewritten by another writer")
            return tables | {name: self._added(name, tables[name], batch, batch_id, entries[name]) for name, batch in batches.items()}

        return self.commits.change(edit)

    def _added(
        self, name: str, state: TableState, batch: Batch, batch_id: str, entry: tuple[str, list[str], int]
    ) -> TableState:
        folder, kinds, largest = entry
        self._at_home(name, state, batch)
        if batch.base is not None and (state.folders, state.largest) != (batch.base.folders, batch.base.largest):
            raise ConcurrentWrite(f"{name} was changed by another writer")
        if batch.lease is None:  # keys from outside: whoever was promised such a key has to take others
            leases = {n: keys for n, keys in state.leases.items() if keys[0] > largest}
        elif batch.lease.id in state.leases:
            leases = {n: keys for n, keys in state.leases.items() if n != batch.lease.id}
        else:
            raise LeaseEnded(f"keys {batch.lease.first} to {batch.lease.last} of {name} were given up")
        state = replace(state, largest=max(state.largest, largest), leases=leases)
        if kinds:
            state = replace(state, parts=state.parts | {folder: kinds})
        return state.with_batch(batch_id, folder if kinds else None)

    def replace(
        self, name: str, staged: str, batch_id: str, largest: int | None = None, batches: Iterable[str] = (),
        taken: Mapping[str, Intervals] | None = None,
    ) -> None:
        """Make a written folder the whole table, which then counts ``batches``, ``taken`` and ``batch_id`` as taken in.

        Key ranges that wait for their rows end: the keys after ``largest`` are given out anew.
        """
        known = list(batches)

        def edit(state: TableState, folder: str, kinds: list[str], top: int) -> TableState:
            remembered = {b: state.batches.get(b) for b in known}
            logs = {f for f in remembered.values() if f} | {f for f in state.parts if _tier(f)}
            parts = {f: [k for k in kinds_ if k != ACCEPTED] for f, kinds_ in state.parts.items() if f in logs}
            parts = {f: left for f, left in parts.items() if left}
            remembered = {b: f if f in parts else None for b, f in remembered.items()}
            remembered = {b: f for b, f in remembered.items() if f or not numbered(b)[0] or not taken}
            after = TableState(state.home, parts | {folder: kinds}, remembered, dict(taken or {}), top)
            return replace(after.with_batch(batch_id, folder), retired=state.folders)

        self._rewrite(name, Batch(staged, largest), edit)

    def compact(self, name: str) -> None:
        """Rewrite a table of many small batches as one. Batches that come in meanwhile are kept beside it."""
        before = self.state(name)
        if len(before.folders) < 2:
            return

        def edit(state: TableState, folder: str, kinds: list[str], top: int) -> TableState:
            if not state.keeps(before):
                raise ConcurrentWrite(f"{name} was rewritten by another writer")
            left = state.without_parts(before.folders, accepted_only=True)
            return replace(
                left, parts={folder: kinds} | left.parts, retired=before.folders, counted=left.counted | counted
            )

        staged = self.stage(name, self.read(name, state=before), self.new_batch(name, "compact"))
        counted = self._add_up(name, before, before.folders, staged)
        self._rewrite(name, Batch(staged, before.largest), edit)

    def join_small(self, name: str, fan_in: int = FAN_IN) -> int:
        """Join ``fan_in`` folders of one tier to one of the next, rows and logs, while there are as many; returns how often.

        New batches are the lowest tier. Each row is written once per tier, so n batches cost n log n and leave
        fewer than ``fan_in`` folders a tier, however long a stream runs. Only the folders joined are
        replaced. When another writer rewrites one of them first, its commit stands and this one gives way.
        """
        joined = 0
        while True:
            state = self.state(name)
            tiers: dict[int, list[str]] = {}
            for folder in state.parts:
                tiers.setdefault(_tier(folder), []).append(folder)
            full = [(tier, folders[:fan_in]) for tier, folders in sorted(tiers.items()) if len(folders) >= fan_in]
            if not full:
                return joined
            tier, run = full[0]
            path = self._batch(name, state, f"tier~{tier + 1}~{uuid.uuid4().hex}")
            rows = [f for f in run if ACCEPTED in state.parts[f]]
            if rows:
                self.stage(name, self._rows(name, state, rows).select(*self.specs[name].columns), path)
            counted = self._add_up(name, state, rows, path)
            for kind in sorted({k for f in run for k in state.parts[f]} - {ACCEPTED}):
                log = self._log(name, state, kind, run).withColumnRenamed("batch", BATCH_ID)
                log.hint("rebalance").write.parquet(self._kind(path, kind))

            def edit(
                now: TableState, folder: str, kinds: list[str], top: int, run: list[str] = run, read: TableState = state,
                counted: dict[str, str] = counted,
            ) -> TableState:
                if any(now.parts.get(f) != read.parts[f] for f in run):
                    raise ConcurrentWrite(f"{name} was rewritten by another writer")
                left = now.without_parts(run)
                return replace(
                    left, parts=left.parts | {folder: kinds}, retired=tuple(run), counted=left.counted | counted
                )

            try:
                self._rewrite(name, Batch(path, 0), edit)
            except ConcurrentWrite:
                self.clear(path)
                for run in filter(None, counted.values()):
                    self.clear(f"{self._home(name, state)}/counts={run}")
                return joined
            joined += 1

    def _rewrite(
        self, name: str, batch: Batch, edit: Callable[[TableState, str, list[str], int], TableState]
    ) -> None:
        """Commit a rewrite. The folders replaced stay for readers in flight until the next rewrite."""
        entry = self._entry(name, batch)
        seen: list[TableState] = []

        def apply(tables: Tables) -> Tables:
            before = self._known(tables, name)
            self._at_home(name, before, batch)
            after = edit(before, *entry)
            used = {*after.folders, *after.retired}
            counted = {f: run for f, run in (before.counted | after.counted).items() if f in used}
            indexed = {f: index for f, index in (before.indexed | after.indexed).items() if f in used}
            seen[:] = [before, replace(after, counted=counted, indexed=indexed)]
            return tables | {name: seen[1]}

        self.commits.change(apply)
        before, after = seen
        for folder in before.retired:
            path = self._batch(name, before, folder)
            self.files.delete(self._kind(path, ACCEPTED) if folder in after.parts else path)
            if before.counted.get(folder):
                self.files.delete(self._counts(name, before, folder))
            if folder in before.indexed:
                self._delete_index(name, before, folder, before.indexed[folder][0])

    # -- counts -------------------------------------------------------------------------------

    def keep_counts(self, name: str) -> int:
        """Count the folders that have no report counts yet, by one job, and commit the counts; returns how many.

        The rows of a counted folder need not be read again by a report. Of writers that count a folder at the same
        time the first one's counts stand. A folder that a rewrite dropped meanwhile gets none.
        """
        spec, state = self.specs[name], self.state(name)
        if not spec.year_of:
            raise ValueError(f"{name} has no datetime to count by")
        new = [f for f in state.folders if f not in state.counted]
        if not new:
            return 0
        made = self._write_counts(name, state, partial_counts(self.read_parts(name, state, new), spec, "part"), new)
        taken: list[str] = []

        def edit(tables: Tables) -> Tables | None:
            now = tables.get(name)
            there = now.folders if now and now.home == state.home else ()
            taken[:] = [f for f in new if f in there and f not in now.counted]
            return tables | {name: replace(now, counted=now.counted | {f: made[f] for f in taken})} if taken else None

        self.commits.change(edit)
        for folder in set(new) - set(taken):
            if made[folder]:
                self.files.delete(f"{self._home(name, state)}/counts={made[folder]}/part={folder}")
        return len(taken)

    def _add_up(self, name: str, state: TableState, folders: Sequence[str], staged: str) -> dict[str, str]:
        """The counts of a folder that holds the rows of others, if all of them are counted."""
        if not folders or not all(f in state.counted for f in folders):
            return {}
        folder = staged.rsplit("/batch=", 1)[1]
        counts = added_counts(self.read_counts(name, state, folders), self.specs[name])
        return self._write_counts(name, state, counts.withColumn("part", F.lit(folder)), [folder])

    def _write_counts(self, name: str, state: TableState, counts: DataFrame, folders: Sequence[str]) -> dict[str, str]:
        run = uuid.uuid4().hex
        path = f"{self._home(name, state)}/counts={run}"
        counts.hint("rebalance", "part").write.partitionBy("part").parquet(path)
        there = set(self.files.names(path))
        return {f: run if f"part={f}" in there else "" for f in folders}

    # -- keys ---------------------------------------------------------------------------------

    def keep_keys(self, name: str, per_slice: int = PER_SLICE) -> int:
        """Index the keys of the folders that have no index yet, and commit that; returns how many.

        ``present_keys`` then asks their filters before it reads a key of theirs. The keys themselves are
        written once more, narrow and in slices by hash, so a "maybe" costs one slice and not a folder of facts. Of writers
        that index a folder at the same time the first one's index stands; joined folders are indexed anew.
        """
        spec, state = self.specs[name], self.state(name)
        new = [f for f in state.folders if f not in state.indexed]
        if not new:
            return 0
        run, home = uuid.uuid4().hex, self._home(name, state)
        keys = self.read_parts(name, state, new).select("part", F.col(spec.key).cast("bigint").alias("key"))
        extent = [F.count(F.lit(1)).alias("keys"), F.min("key").alias("low"), F.max("key").alias("high")]
        made: dict[str, KeyIndex] = {f: ("", 0, 0, 0, 0) for f in new}
        for r in keys.where("key is not null").groupBy("part").agg(*extent).collect():  # a row per folder
            made[r["part"]] = (run, r["low"], r["high"], *layout(r["keys"], per_slice))
        layouts = self.spark.createDataFrame([(f, *index[3:]) for f, index in made.items() if index[0]], "part string, slices int, words int")
        sliced = placed(keys.join(layouts, "part")).select("part", "slice", "key").where("key is not null")
        sliced.hint("rebalance", "part", "slice").write.partitionBy("part", "slice").parquet(f"{home}/keys={run}")
        stored = self.spark.read.schema("key bigint, part string, slice int").parquet(f"{home}/keys={run}")
        words = filter_words(stored.drop("slice").join(layouts, "part"))
        words.hint("rebalance", "part").write.partitionBy("part").parquet(f"{home}/filters={run}")
        taken: list[str] = []

        def edit(tables: Tables) -> Tables | None:
            now = tables.get(name)
            there = now.folders if now and now.home == state.home else ()
            taken[:] = [f for f in new if f in there and f not in now.indexed]
            return tables | {name: replace(now, indexed=now.indexed | {f: made[f] for f in taken})} if taken else None

        self.commits.change(edit)
        for folder in set(new) - set(taken):
            self._delete_index(name, state, folder, made[folder][0])
        return len(taken)

    def present_keys(self, name: str, incoming: DataFrame, scratch: str | None = None) -> DataFrame:
        """Keys of ``incoming`` that the table holds; null is none.

        Folders whose range of keys the incoming ones miss are left out by the commit record. Filters say
        which slices of the other indexed folders may hold one, and only those are read. Folders without index are
        looked up by their files' statistics.
        """
        spec, state = self.specs[name], self.state(name)
        plain = [f for f in state.folders if f not in state.indexed]
        if len(plain) == len(state.folders):
            return present_keys(self.read(name, state=state), incoming, spec.key)
        asked = incoming.select(F.col(spec.key).cast("bigint").alias("key")).where("key is not null").distinct()
        asked = written(asked, "asked-keys", scratch)
        found = []
        if plain:
            rows = self._rows(name, state, plain).select(F.col(spec.key).cast("bigint").alias("key"))
            found.append(present_keys(rows, asked, "key"))
        found.append(self._indexed_keys(name, state, asked, scratch))
        return reduce(DataFrame.unionByName, found).distinct().select(
            F.col("key").cast(spec.schema[spec.key].dataType).alias(spec.key)
        )

    def _indexed_keys(self, name: str, state: TableState, asked: DataFrame, scratch: str | None) -> DataFrame:
        """Those of the distinct ``asked(key)`` that stand in an indexed folder."""
        home = self._home(name, state)
        low, high = asked.agg(F.min("key"), F.max("key")).first()
        near = {
            f: index for f, index in state.indexed.items()
            if low is not None and f in state.folders and index[0] and index[1] <= high and low <= index[2]
        }
        nothing = asked.where(F.lit(False))
        if not near:
            return nothing
        words = self.spark.read.schema("slices int, words int, slice int, word int, mask bigint, filters string, part string")
        words = words.option("basePath", home).parquet(*[f"{home}/filters={index[0]}/part={f}" for f, index in near.items()])
        maybe = written(may_hold(words, asked, [index[3:] for index in near.values()]), "maybe-held", scratch)
        slices = maybe.select("part", "slice").distinct().collect()  # a row per slice of PER_SLICE keys at most
        if not slices:
            return nothing
        keys = self.spark.read.schema("key bigint, keys string, part string, slice int").option("basePath", home).parquet(
            *[f"{home}/keys={near[r['part']][0]}/part={r['part']}/slice={r['slice']}" for r in slices]
        )
        return keys.join(maybe, ["part", "slice", "key"], "left_semi").select("key")

    def _delete_index(self, name: str, state: TableState, folder: str, run: str) -> None:
        if run:
            for kind in ("filters", "keys"):
                self.files.delete(f"{self._home(name, state)}/{kind}={run}/part={folder}")

    def _known(self, tables: Tables, name: str) -> TableState:
        if name not in tables:
            raise TableGone(f"{name} was dropped by another writer")
        return tables[name]

    def _at_home(self, name: str, state: TableState, batch: Batch) -> None:
        if not batch.path.startswith(f"{self._home(name, state)}/"):
            raise TableGone(f"{name} was dropped and created anew after these rows were written")

    def _entry(self, name: str, batch: Batch) -> tuple[str, list[str], int]:
        """Folder, kinds and largest key of a written batch; kinds that begin with ``_`` are its writer's own."""
        if not self.files.exists(batch.path):
            raise TableGone(f"{batch.path} is not there; was {name} dropped?")
        kinds = [n.removeprefix("verdict=") for n in self.files.names(batch.path) if re.match("verdict=[^_]", n)]
        largest = batch.largest
        if largest is None:
            key = self.specs[name].schema[self.specs[name].key]
            keys = self.spark.read.schema(T.StructType([key])).parquet(self._kind(batch.path, ACCEPTED))
            largest = keys.agg(F.max(key.name)).first()[0] or 0
        return batch.path.rsplit("/batch=", 1)[1], kinds, largest

    # -- layout -------------------------------------------------------------------------------

    def home(self, name: str) -> str:
        """The folder that holds all batches of the table."""
        return self._home(name, self.state(name))

    def _home(self, name: str, state: TableState) -> str:
        return f"{self.root}/tables/{name}/{state.home}"

    def _batch(self, name: str, state: TableState, folder: str) -> str:
        return f"{self._home(name, state)}/batch={folder}"

    def _counts(self, name: str, state: TableState, folder: str) -> str:
        return f"{self._home(name, state)}/counts={state.counted[folder]}/part={folder}"

    def _kind(self, batch: str, kind: str) -> str:
        return f"{batch}/verdict={kind}"

    def _rows(self, name: str, state: TableState, folders: Sequence[str]) -> DataFrame:
        spec = self.specs[name]
        fields = [T.StructField(c, T.StringType()) for c in ("batch", "verdict")]
        if spec.year_column:
            fields.append(T.StructField(spec.year_column, T.IntegerType()))
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in spec.schema] + fields)
        if not folders:
            return self.spark.createDataFrame([], schema)
        paths = [self._kind(self._batch(name, state, folder), ACCEPTED) for folder in folders]
        return self.spark.read.schema(schema).option("basePath", self._home(name, state)).parquet(*paths)

    def _log(self, name: str, state: TableState, kind: str, folders: Iterable[str]) -> DataFrame | None:
        """One kind of log of these folders, with the id of the batch each row came with."""
        paths = [self._kind(self._batch(name, state, f), kind) for f in folders if kind in state.parts[f]]
        if not paths:
            return None
        read = self.spark.read.option("basePath", self._home(name, state)).option("mergeSchema", True).parquet(*paths)
        own = F.regexp_extract("batch", "^(.*)~", 1)
        batch = F.coalesce(F.col(BATCH_ID), own) if BATCH_ID in read.columns else own
        return read.withColumn("batch", batch).drop("verdict", BATCH_ID)


def _tier(folder: str) -> int:
    """How often the rows of a folder have been joined; 0 for a batch as it came in."""
    found = re.match(r"tier~(\d+)~", folder)
    return int(found.group(1)) if found else 0


def _held(batch: Column, state: TableState) -> Column:
    """Whether the state counts a batch id as taken in."""
    known = [batch.isin(list(state.batches))] if state.batches else []
    for series, intervals in state.taken.items():
        number = F.when(
            F.substring_index(batch, "-", -1).rlike("^[0-9]{1,18}$") & batch.startswith(f"{series}-"),
            F.substring_index(batch, "-", -1).try_cast("bigint"),
        )
        inside = reduce(or_, [number.between(low, high) for low, high in intervals])
        known.append((F.regexp_replace(batch, "-[0-9]+$", "") == series) & F.coalesce(inside, F.lit(False)))
    return reduce(or_, known, F.lit(False))
