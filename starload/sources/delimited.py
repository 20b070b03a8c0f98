"""Headerless delimited history files, columns by position."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starload.functions.fields import any_of
from starload.functions.text import null_if_empty, read_fields
from starload.functions.times import parse_datetime
from starload.session import written
from starload.spec import TableSpec

SPLIT = ["src_rank", "src_file", "src_block"]
POSITION = [*SPLIT, "src_line"]
"""Order of the lines over all files: place in the caller's list, file path, split of the file, line within the
split's task."""


def read_delimited(
    spark: SparkSession, paths: str | Sequence[str], spec: TableSpec, separator: str = ",", line_sep: str = "\r\n",
    scratch: str | None = None,
) -> DataFrame:
    """Typed columns of ``spec`` plus ``line``, ``extra_fields``, ``bad_datetime``, ``bad_value`` and the position.

    One row per record: a line end after an odd number of backslashes is data. To find those, the files are
    read once more than the caller does; a load avoids that by writing ``read_lines`` before it calls ``mended``.
    """
    return mended(read_lines(spark, paths, spec, separator, line_sep), spec, separator, line_sep, scratch)


def read_lines(
    spark: SparkSession, paths: str | Sequence[str], spec: TableSpec, separator: str = ",", line_sep: str = "\r\n"
) -> DataFrame:
    """What ``read_delimited`` gives, for every line of the files, and ``is_open``: its end is escaped.

    The text source keeps empty fields, quotes and line feeds inside a field as they are, which the
    csv source does not. A value that cannot be read becomes null and is flagged. Missing fields are
    null; fields beyond the last column are counted and dropped.
    """
    given = [
        spark.read.option("lineSep", line_sep).text(path).select("value", "_metadata", F.lit(rank).alias("src_rank"))
        for rank, path in enumerate([paths] if isinstance(paths, str) else paths)
    ]
    lines = reduce(DataFrame.unionByName, given).select(
        F.col("value").alias("line"),
        "src_rank",
        F.col("_metadata.file_path").alias("src_file"),
        F.col("_metadata.file_block_start").alias("src_block"),
        F.monotonically_increasing_id().alias("src_line"),
    )
    trailing = F.length("line") - F.length(F.rtrim(F.col("line"), F.lit("\\")))
    return _parsed(lines.withColumn("is_open", trailing % 2 == 1), spec, separator)


def mended(
    rows: DataFrame, spec: TableSpec, separator: str = ",", line_sep: str = "\r\n", scratch: str | None = None
) -> DataFrame:
    """Rows of ``read_lines`` with every open line joined to those that go on with its record.

    A record may go on over any number of lines and of splits, which are read apart from each other. Each split
    reports its first and last line; a scan over the splits of a file, not over its rows, says where the line
    after a split's last one is and how many records have begun before. Only open lines and their successors
    are looked at and parsed again; where no line is open, nothing more is done. A line that is open at the
    end of its file is a record of its own. A record stands where its first line does.
    """
    opened = written(rows.where("is_open").select(*POSITION), "open-lines", scratch)
    rows = rows.drop("is_open")
    if opened.isEmpty():
        return rows
    runs = written(_runs(rows, opened), "open-runs", scratch)
    pieces = rows.select(*POSITION, "line").join(runs, POSITION)
    put = F.array_sort(F.collect_list(F.struct("src_block", "src_line", "line")))
    records = pieces.groupBy("src_rank", "src_file", "run").agg(put.alias("pieces"))
    lines = records.select(
        F.array_join("pieces.line", line_sep).alias("line"), "src_rank", "src_file",
        F.col("pieces")[0]["src_block"].alias("src_block"), F.col("pieces")[0]["src_line"].alias("src_line"),
    )
    whole = rows.join(runs.select(*POSITION), POSITION, "left_anti")
    return whole.select(*rows.columns).unionByName(_parsed(lines, spec, separator))


def _runs(rows: DataFrame, opened: DataFrame) -> DataFrame:
    """Position and ``run``, the number of its record within the file, of every open line and every successor."""
    file = W.partitionBy("src_rank", "src_file").orderBy("src_block")
    splits = rows.groupBy(*SPLIT).agg(F.min("src_line").alias("first"), F.max("src_line").alias("last"))
    splits = splits.withColumn("next", F.lead(F.struct("src_block", F.col("first").alias("src_line"))).over(file))
    inside = F.when(F.col("src_line") < F.col("last"), F.struct("src_block", (F.col("src_line") + 1).alias("src_line")))
    after = opened.join(splits, SPLIT).select("src_rank", "src_file", F.coalesce(inside, "next").alias("at"))
    after = after.where(F.col("at").isNotNull()).select("src_rank", "src_file", "at.*", F.lit(0).alias("begins"))
    places = opened.withColumn("begins", F.lit(1)).unionByName(after).groupBy(*POSITION).agg(F.min("begins").alias("begins"))
    local = places.withColumn("begun", F.sum("begins").over(W.partitionBy(*SPLIT).orderBy("src_line")))
    earlier = F.sum("begins").over(file.rowsBetween(W.unboundedPreceding, -1))
    totals = local.groupBy(*SPLIT).agg(F.sum("begins").alias("begins")).select(*SPLIT, F.coalesce(earlier, F.lit(0)).alias("earlier"))
    return local.join(totals, SPLIT).select(*POSITION, (F.col("earlier") + F.col("begun")).alias("run"))


def _parsed(lines: DataFrame, spec: TableSpec, separator: str) -> DataFrame:
    """``lines`` with ``line`` and the position parsed into the columns of ``spec`` and the flags; others stay."""
    more = [c for c in lines.columns if c not in (*POSITION, "line")]
    split = lines.withColumn("fields", read_fields(F.col("line"), separator))
    texts = [_text(i, f.name, spec).alias(f"_t_{f.name}") for i, f in enumerate(spec.schema)]
    extra = F.greatest(F.size("fields") - len(spec.schema), F.lit(0)).alias("extra_fields")
    read = split.select("line", *POSITION, *more, extra, *texts)

    typed = read.select("line", *POSITION, *more, "extra_fields", *read.columns[-len(texts):], *[
        _typed(F.col(f"_t_{f.name}"), f.dataType).alias(f.name) for f in spec.schema
    ])
    lost = {f.name: F.col(f"_t_{f.name}").isNotNull() & F.col(f.name).isNull() for f in spec.schema}
    times = [f.name for f in spec.schema if isinstance(f.dataType, T.TimestampNTZType)]
    return typed.select(
        *spec.columns,
        "line",
        "extra_fields",
        any_of(*[lost[c] for c in times]).alias("bad_datetime"),
        any_of(*[lost[c] for c in spec.columns if c not in times]).alias("bad_value"),
        *POSITION,
        *more,
    )


def _text(index: int, name: str, spec: TableSpec) -> Column:
    text = F.get("fields", F.lit(index))
    return null_if_empty(text) if name in spec.empty_is_null else text


def _typed(text: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        return text
    if isinstance(dtype, T.TimestampNTZType):
        return parse_datetime(text)
    return text.try_cast(dtype)
