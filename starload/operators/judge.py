"""Row rules: which rows may be stored, and the first reason why not."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starload.functions.fields import any_of, first_failure, is_missing, is_whole_text, too_long
from starload.functions.times import parse_datetime
from starload.operators.foreign_keys import is_orphan, with_parent_flags
from starload.operators.requests import OK
from starload.spec import TableSpec

MISSING_FIELD = "MISSING_FIELD"
FOREIGN_KEY = "FOREIGN_KEY"
TOO_LONG = "TOO_LONG"
BAD_DATETIME = "BAD_DATETIME"
BAD_VALUE = "BAD_VALUE"
NULL_NOT_ALLOWED = "NULL_NOT_ALLOWED"
DUPLICATE_KEY = "DUPLICATE_KEY"


def judge_request_rows(
    rows: DataFrame, spec: TableSpec, parents: Mapping[str, DataFrame], scratch: str | None = None
) -> DataFrame:
    """Add ``reason_code`` and ``reason`` to request rows; both null for a row that may be stored.

    A refused request refuses its rows. Then the order is: missing field, foreign keys (one message
    naming all ids), then what the table itself would refuse. Datetimes are still text here. A number that
    could not be read is no missing field: as an id beyond 64 bits it has no parent, else it is a bad value.
    ``rows`` are evaluated more than once, so they should be stored.
    """
    flagged = with_parent_flags(rows, spec.foreign_keys, parents, scratch)
    times = [f.name for f in spec.row_fields if isinstance(f.dataType, T.TimestampNTZType)]
    numbers = [(f.name, f.dataType) for f in spec.row_fields if isinstance(f.dataType, T.IntegralType)]
    code = F.coalesce(
        F.when(F.col("request_status") != OK, F.col("request_status")),
        F.when(F.col("is_row"), first_failure(
            (any_of(*[_sent(f.name).isNull() & is_missing(F.col(f.name), _request_type(f)) for f in spec.row_fields]), MISSING_FIELD),
            (any_of(*[is_orphan(fk) | is_whole_text(_sent(fk.column)) for fk in spec.foreign_keys]), FOREIGN_KEY),
            (any_of(*[too_long(F.col(c), n) for c, n in spec.max_length.items()]), TOO_LONG),
            (any_of(*[parse_datetime(F.col(c)).isNull() for c in times]), BAD_DATETIME),
            (any_of(*[F.col(c).try_cast(t).isNull() for c, t in numbers]), BAD_VALUE),
        )),
    )
    coded = flagged.withColumn("reason_code", code)
    return coded.select(*rows.columns, "reason_code", _reason(spec).alias("reason"))


def refuse_orphans(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Judged rows that turned out to have no parent, with that reason."""
    coded = rows.withColumn("reason_code", F.lit(FOREIGN_KEY))
    return coded.withColumn("reason", _reason(spec))


def _sent(field: str) -> Column:
    """The text of a value that could not be read, null for any other."""
    return F.try_element_at("unread", F.lit(field))


def _request_type(field: T.StructField) -> T.DataType:
    return field.dataType if isinstance(field.dataType, T.IntegralType) else T.StringType()


def _reason(spec: TableSpec) -> Column:
    code = F.col("reason_code")
    ids = [F.format_string(f"{fk.column} %s", F.coalesce(F.col(fk.column).cast("string"), _sent(fk.column))) for fk in spec.foreign_keys]
    text = F.when(code == MISSING_FIELD, F.lit("missing field"))
    if ids:
        text = text.when(code == FOREIGN_KEY, F.concat(F.lit("not found: "), F.concat_ws(" or ", *ids)))
    return text.otherwise(F.lower(F.replace(code, F.lit("_"), F.lit(" "))))


def judge_loaded_rows(
    rows: DataFrame, spec: TableSpec, parents: Mapping[str, DataFrame], scratch: str | None = None
) -> DataFrame:
    """Add ``reason_code`` to rows read from history files, by the rules of the table itself."""
    flagged = with_parent_flags(rows, spec.foreign_keys, parents, scratch)
    code = first_failure(
        (F.col("bad_datetime"), BAD_DATETIME),
        (F.col("bad_value"), BAD_VALUE),
        (any_of(*[F.col(c).isNull() for c in spec.not_null]), NULL_NOT_ALLOWED),
        (any_of(*[too_long(F.col(c), n) for c, n in spec.max_length.items()]), TOO_LONG),
        (any_of(*[is_orphan(fk) for fk in spec.foreign_keys]), FOREIGN_KEY),
    )
    return flagged.select(*rows.columns, code.alias("reason_code"))
