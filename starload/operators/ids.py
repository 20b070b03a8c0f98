"""Consecutive keys for stored rows, without a window over the whole table."""

from __future__ import annotations

import re
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _task_order(path: str) -> tuple[int, int, str]:
    """Number of the writing task, of the file within it, then the path; other committers' names go by path alone."""
    name = path.rsplit("/", 1)[-1]
    part = re.match(r"part-(\d+)-", name)
    piece = re.search(r"[-.]c(\d+)\.", name)
    return int(part.group(1)) if part else 0, int(piece.group(1)) if piece else 0, path


def rows_per_file(stored: DataFrame) -> list[tuple[str, int]]:
    """Path and number of rows of every Parquet file behind ``stored``, in the order of the tasks that wrote them."""
    file = F.col("_metadata.file_path")
    sizes = stored.groupBy(file.alias("_file")).agg(F.count(F.lit(1)).alias("n")).collect()
    return sorted(((r["_file"], r["n"]) for r in sizes), key=lambda f: _task_order(f[0]))


def number_rows(
    stored: DataFrame, column: str, after: int = 0, dtype: T.DataType | None = None,
    sizes: list[tuple[str, int]] | None = None,
) -> tuple[DataFrame, int]:
    """Rows read straight from Parquet files plus ``column``: after+1, after+2, ... in stored order.

    Also returns the last number given, ``after`` when there is no row.

    A row's place is (file, row in file), which no retry can change. The driver sees one count per
    file, never a row, and turns the counts into the first key of each file. ``sizes`` are those counts, when
    they are known. The first keys go to every task, a row per file: the rows stay where they are read, where
    a join by file would gather and sort those of a whole file in one task.
    """
    dtype = dtype or T.LongType()
    sizes = rows_per_file(stored) if sizes is None else sizes
    total = sum(n for _, n in sizes)
    if isinstance(dtype, T.IntegerType) and after + total > 2**31 - 1:
        raise OverflowError(f"{column} would pass {after + total}, beyond its declared integer type")

    starts = accumulate((n for _, n in sizes), initial=after + 1)
    offsets = stored.sparkSession.createDataFrame(
        [(file, start) for (file, _), start in zip(sizes, starts)], "_file string, _start bigint"
    )
    placed = stored.select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")
    )
    numbered = placed.join(F.broadcast(offsets), "_file").withColumn(column, (F.col("_start") + F.col("_row")).cast(dtype))
    return numbered.drop("_file", "_row", "_start"), after + total


def assign_ids(rows: DataFrame, column: str, order: list[str], path: str, after: int = 0,
               dtype: T.DataType | None = None) -> DataFrame:
    """Number rows by a total order: range-sort them into files at ``path``, then number the files."""
    rows.orderBy(*order).write.parquet(path)
    return number_rows(rows.sparkSession.read.schema(rows.schema).parquet(path), column, after, dtype)[0]
