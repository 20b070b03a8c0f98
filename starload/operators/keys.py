"""Primary keys on plain DataFrames: repeats, first row per key, rows not stored yet.

A key may repeat in any number of rows. Every step below reduces on the map side before it
shuffles, so a hot key reaches its reducer as one row per task and never as its whole group.
"""

from __future__ import annotations

from collections.abc import Sequence
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.session import written


def key_violations(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with the number of rows."""
    return rows.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)


def first_by_key(rows: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the least by ``order`` and then by the remaining columns; null is a key like any other.

    Rows are evaluated once and shuffled once: each task keeps its least row of a key, and those meet.
    """
    rest = [c for c in rows.columns if c not in key and c not in order]
    picked = rows.groupBy(*key).agg(F.min(F.struct(*order, *rest)).alias("_first"))
    return picked.select(*[c if c in key else F.col(f"_first.{c}").alias(c) for c in rows.columns])


def first_positions(
    rows: DataFrame, key: str, position: Sequence[str], scratch: str | None = None
) -> DataFrame | None:
    """For each key in more than one row, the position of its first row, as a struct ``_first``.

    None when no key repeats. Repeats are few in a sane file: the first pass is a plain count over
    the key column alone, and only rows of repeated keys take part in comparing positions.
    """
    repeated = written(key_violations(rows, [key]).select(key), "repeated-keys", scratch)
    if repeated.isEmpty():
        return None
    contenders = rows.select(key, *position).join(repeated, key, "left_semi")
    return contenders.groupBy(key).agg(F.min(F.struct(*position)).alias("_first"))


def present_keys(stored: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Keys of ``incoming`` that are already stored.

    The range of the incoming keys reaches the statistics of the stored files, which skips most of
    a table whose keys grow. The stored side is on the left of a semi join: a small batch is
    broadcast by Spark when its size allows, and the table is then read without a shuffle.
    """
    low, high = incoming.agg(F.min(key), F.max(key)).first()
    in_range = stored.select(key).where(F.col(key).between(low, high))
    return in_range.join(incoming.select(key).distinct(), key, "left_semi").distinct()


def absent_rows(incoming: DataFrame, stored: DataFrame, key: str, scratch: str | None = None) -> DataFrame:
    """Rows of ``incoming`` whose key is not stored; stored rows win."""
    return incoming.join(written(present_keys(stored, incoming, key), "present-keys", scratch), key, "left_anti")
