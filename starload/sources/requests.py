"""Insert requests as JSON, one request per line: ``{"registros": [{...}, ...]}``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starload.functions.fields import any_of, is_whole_text, whole_number
from starload.operators.requests import MALFORMED, MAX_ROWS, OK, TOO_MANY_ROWS, texts_by_field
from starload.spec import TableSpec

RECORDS_FIELD = "registros"
"""Fixed value: the field of the request that holds its rows."""


def request_lines(lines: DataFrame, whole_files: bool = False) -> DataFrame:
    """Body and place of text lines read from files, batch or stream. A blank line is no request, a blank file is."""
    if not whole_files:
        lines = lines.where(F.trim("value") != "")
    return lines.select(
        F.col("value").alias("body"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )


def with_request_ids(lines: DataFrame) -> DataFrame:
    """``request_id`` and ``body``; the id is the file's path, the split and a number rising with the line.

    Equal bodies stay two requests, as do files of one name in several folders.
    """
    line_no = F.monotonically_increasing_id().bitwiseAND(F.lit(2**33 - 1))
    return lines.select(F.format_string("%s#%d-%d", "file", "block", line_no).alias("request_id"), "body")


def read_requests(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """``options`` go to the text source: ``wholetext="true"`` takes each file as one request."""
    whole_files = options.get("wholetext", "false").lower() == "true"
    return with_request_ids(request_lines(spark.read.format("text").options(**options).load(path), whole_files))


def request_rows(requests: DataFrame, spec: TableSpec, max_rows: int = MAX_ROWS) -> DataFrame:
    """One row per record: ``request_id, ordinal, <fields>, unread, is_row, request_status``.

    Types are judged on the JSON itself: a text field must be JSON text; a whole-number field may
    be a number without fraction, its text, or a boolean. One bad or absent field makes the whole
    request MALFORMED, and such a request yields one row that ``is_row`` tells from a record, as does an
    empty one. A number beyond 64 bits is null, and ``unread`` keeps its text. The size is known from the
    array, so the cap needs no shuffle.
    """
    raw = ", ".join(f"`{f.name}`: variant" for f in spec.row_fields)
    records = F.try_variant_get(F.try_parse_json("body"), f"$.{RECORDS_FIELD}", f"array<struct<{raw}>>")
    malformed = F.exists("records", lambda r: any_of(*[~_well_formed(r[f.name], f) for f in spec.row_fields]))
    status = (
        F.when(F.col("records").isNull() | malformed, MALFORMED)
        .when(F.size("records") > max_rows, TOO_MANY_ROWS)
        .otherwise(OK)
    )
    judged = requests.select("request_id", records.alias("records")).withColumn("request_status", status)
    kept = F.when(F.col("request_status") != MALFORMED, F.col("records"))
    exploded = judged.select("request_id", "request_status", F.posexplode_outer(kept).alias("ordinal", "record"))
    values = {f.name: _value(F.col(f"record.{f.name}"), f) for f in spec.row_fields}
    unread = {
        f.name: F.when(values[f.name].isNull(), _text(F.col(f"record.{f.name}")))
        for f in spec.row_fields
        if isinstance(f.dataType, T.IntegralType)
    }
    return exploded.select(
        "request_id",
        "ordinal",
        *[value.alias(name) for name, value in values.items()],
        texts_by_field(unread),
        F.col("ordinal").isNotNull().alias("is_row"),
        "request_status",
    )


def _kind(value: Column) -> Column:
    return F.schema_of_variant(value)


def _text(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def _well_formed(value: Column, field: T.StructField) -> Column:
    """Whether a field of a record is present and of its type."""
    wanted = "BIGINT" if isinstance(field.dataType, T.IntegralType) else "STRING"
    fits = F.when(_kind(value) == wanted, True)
    if wanted == "BIGINT":
        fits = fits.when(_kind(value) == "BOOLEAN", True).when(is_whole_text(_text(value)), True)
    return fits.otherwise(False)


def _value(value: Column, field: T.StructField) -> Column:
    """The typed value of a well-formed field; a number may be decimal, double or text."""
    if not isinstance(field.dataType, T.IntegralType):
        return _text(value)
    return (
        F.when(_kind(value).isin("BIGINT", "BOOLEAN"), F.try_variant_get(value, "$", "bigint"))
        .otherwise(whole_number(_text(value)))
    )
