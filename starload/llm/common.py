"""Pieces that several corpus operators share."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Runs of anything but space, tab and the line breaks up to CR; no words for null."""
    spaced = F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\x0c\r", "     ")
    return F.array_remove(F.split(spaced, " "), "")


def split_words(text: str | bytes | None) -> list[bytes]:
    """The same words in Python, as UTF-8: ``bytes.split`` parts at exactly those six characters."""
    if text is None:
        return []
    return (text if isinstance(text, bytes) else text.encode()).split()


def crc_of_id(doc_id: Column) -> Column:
    """crc32 of the id's decimal text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def column_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


def batches_of(batch: pa.RecordBatch, max_bytes: int, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Parts of a batch holding about ``max_bytes`` of text each; a longer text stands alone."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = filled = 0
    for i, size in enumerate(sizes):
        if i > start and filled + size > max_bytes:
            yield batch.slice(start, i - start)
            start, filled = i, 0
        filled += size
    if start < len(sizes):
        yield batch.slice(start)


COPIES = 100_000
"""Copies of a row that one task makes; more are dealt out first."""


def copied(rows: DataFrame) -> DataFrame:
    """Every row ``n`` times, with ``nth`` from 0. A row of very many copies is cut into runs dealt to several tasks."""
    runs = rows.withColumn("_run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / COPIES))))
    if not rows.where(F.col("n") > COPIES).isEmpty():
        runs = runs.repartition(*[c for c in runs.columns])
    first = F.col("_run") * COPIES
    last = F.least(F.col("n"), first + COPIES) - 1
    return runs.withColumn("nth", F.explode(F.sequence(first, last))).drop("_run", "n")


UPPER_TO_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
NOT_A_LETTER = re.compile(r"[\W\d_]+")
