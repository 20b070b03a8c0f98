"""Request-level rules: size cap, and the inserted / failed summary."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starload.functions.fields import whole_number
from starload.session import written
from starload.spec import TableSpec

OK = "OK"
TOO_MANY_ROWS = "TOO_MANY_ROWS"
MALFORMED = "MALFORMED"

MAX_ROWS = 1000
"""Fixed value: rows one request may carry."""


UNREAD_TYPE = "map<string,string>"


def texts_by_field(texts: Mapping[str, Column]) -> Column:
    """The texts that are not null, by field, as the column ``unread``."""
    if not texts:
        return F.lit(None).cast(UNREAD_TYPE).alias("unread")
    pairs = [part for name, text in texts.items() for part in (F.lit(name), text)]
    return F.map_filter(F.create_map(*pairs), lambda _, text: text.isNotNull()).alias("unread")


def as_request_rows(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """A caller's rows of ``request_id, ordinal`` and fields as request rows: typed, with ``unread`` and ``is_row``.

    A value that is no whole number where one is asked for becomes null and ``unread`` keeps its text, so the
    row is refused and the job goes on. A field the caller does not have is null, which counts as missing.
    Every row counts as a record, also one without ordinal.
    """
    values, unread = [], {}
    for f in spec.row_fields:
        if f.name not in rows.columns:
            wide = "bigint" if isinstance(f.dataType, T.IntegralType) else "string"
            values.append(F.lit(None).cast(wide).alias(f.name))
        elif not isinstance(f.dataType, T.IntegralType):
            values.append(F.col(f.name).cast("string").alias(f.name))
        elif isinstance(rows.schema[f.name].dataType, (T.IntegralType, T.BooleanType)):
            values.append(F.col(f.name).cast("bigint").alias(f.name))
        else:
            text = F.col(f.name).cast("string")
            values.append(whole_number(text).alias(f.name))
            unread[f.name] = F.when(whole_number(text).isNull(), text)
    return rows.select(
        F.col("request_id").cast("string").alias("request_id"),
        F.col("ordinal").try_cast("int").alias("ordinal"),
        *values,
        texts_by_field(unread),
        F.lit(True).alias("is_row"),
    )


def request_sizes(rows: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """One row per request: its size and whether the whole request is refused."""
    sizes = rows.groupBy("request_id").agg(F.count(F.lit(1)).alias("rows"))
    return sizes.withColumn("refused", F.col("rows") > max_rows)


def with_request_status(rows: DataFrame, max_rows: int = MAX_ROWS, scratch: str | None = None) -> DataFrame:
    """Add ``request_status``. The ids of oversized requests are written first, then joined back."""
    refused = request_sizes(rows, max_rows).where("refused").select(F.col("request_id").alias("_over"))
    over = written(refused, "refused-requests", scratch)
    joined = rows.join(over, rows["request_id"] == over["_over"], "left")
    status = F.when(F.col("_over").isNotNull(), F.lit(TOO_MANY_ROWS)).otherwise(F.lit(OK))
    return joined.withColumn("request_status", status).drop("_over")


def summarize(judged: DataFrame) -> DataFrame:
    """Per request: status and the number of rows inserted and failed. An empty request reports 0 and 0."""
    is_row = F.col("is_row")
    status = F.col("request_status")
    totals = judged.groupBy("request_id").agg(
        F.bool_or(status == MALFORMED).alias("_malformed"),
        F.bool_or(status == TOO_MANY_ROWS).alias("_too_many"),
        F.count_if(is_row & F.col("reason_code").isNull()).alias("inserted"),
        F.count_if(is_row & F.col("reason_code").isNotNull()).alias("failed"),
    )
    named = F.when(F.col("_malformed"), MALFORMED).when(F.col("_too_many"), TOO_MANY_ROWS).otherwise(OK)
    return totals.select("request_id", named.alias("status"), "inserted", "failed")
