"""Foreign keys: one join per parent table in place of one lookup per row."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starload.session import broadcastable, written
from starload.spec import ForeignKey


HOT_ROWS = 1_000_000
"""Rows of one key that may meet in a task; a key with more is looked up without moving its rows."""


def with_parent_flag(
    rows: DataFrame, fk: ForeignKey, parent: DataFrame, flag: str, scratch: str | None = None
) -> DataFrame:
    """Add ``flag``: whether the parent row exists. Every row is kept; a null key has no parent.

    Parents that Spark can broadcast are joined to the rows as they are. Others meet only the distinct keys of
    ``rows``, which are then evaluated twice and should be stored. The keys left over have no parent; they are
    few as a rule and are joined back by their written size. When Spark cannot broadcast them, those of more
    than ``HOT_ROWS`` rows still are, one for that many rows at most, and only rows of other keys are shuffled by
    key. Rows without key, or of a hot one, keep to themselves, so no task gets more than ``HOT_ROWS`` of a key.
    """
    key = F.col(fk.column)
    ids = parent.select(F.col(fk.parent_key).alias("_key")).where(F.col("_key").isNotNull())
    if broadcastable(ids):
        joined = rows.join(ids.distinct(), rows[fk.column] == F.col("_key"), "left")
        return joined.withColumn(flag, F.col("_key").isNotNull()).drop("_key")

    used = rows.select(key.alias("_key")).where(F.col("_key").isNotNull()).groupBy("_key").agg(F.count(F.lit(1)).alias("_rows"))
    orphans = written(used.join(ids, "_key", "left_anti"), "orphan-keys", scratch)
    if broadcastable(orphans):
        joined = rows.join(orphans.drop("_rows"), rows[fk.column] == F.col("_key"), "left")
        return joined.withColumn(flag, rows[fk.column].isNotNull() & F.col("_key").isNull()).drop("_key")

    hot = F.broadcast(orphans.where(F.col("_rows") > HOT_ROWS).select(F.col("_key").alias("_hot")))
    cold = orphans.where(F.col("_rows") <= HOT_ROWS).select(F.col("_key").cast("string").alias("_cold"))
    busy = F.broadcast(written(used.where(F.col("_rows") > HOT_ROWS).select(F.col("_key").alias("_busy")), "hot-keys", scratch))
    marked = rows.join(hot, rows[fk.column] == F.col("_hot"), "left").join(busy, rows[fk.column] == F.col("_busy"), "left")
    by_key = F.col(fk.column).isNotNull() & F.col("_busy").isNull()
    alone = F.concat(F.lit("-"), F.rand(0).cast("string"))  # no key's text, so such rows are dealt out and match nothing
    placed = marked.withColumn("_place", F.when(by_key, F.col(fk.column).cast("string")).otherwise(alone))
    joined = placed.join(cold, placed["_place"] == F.col("_cold"), "left")
    has = F.col(fk.column).isNotNull() & F.col("_hot").isNull() & F.col("_cold").isNull()
    return joined.select(*rows.columns, has.alias(flag))


def with_parent_flags(
    rows: DataFrame, fks: tuple[ForeignKey, ...], parents: Mapping[str, DataFrame], scratch: str | None = None
) -> DataFrame:
    for fk in fks:
        rows = with_parent_flag(rows, fk, parents[fk.parent], flag_name(fk), scratch)
    return rows


def flag_name(fk: ForeignKey) -> str:
    return f"_has_{fk.column}"


def is_orphan(fk: ForeignKey) -> Column:
    """A key without parent; null passes."""
    return F.col(fk.column).isNotNull() & ~F.col(flag_name(fk))


def orphan_keys(rows: DataFrame, fk: ForeignKey, parent: DataFrame) -> DataFrame:
    """Keys that have no parent, with the number of rows holding each. Counts come before the join."""
    per_key = rows.where(F.col(fk.column).isNotNull()).groupBy(fk.column).agg(F.count(F.lit(1)).alias("rows"))
    ids = parent.select(F.col(fk.parent_key).alias(fk.column))
    return per_key.join(ids, fk.column, "left_anti")
