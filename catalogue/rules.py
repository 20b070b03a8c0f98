"""Row, key and request rules as plain DataFrame operators."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue.tables import (
    HIRES_SQL,
    PARENTS_SQL,
    fact,
    hires,
    nations,
    solvent_customers,
    solvent_departments,
    table,
)
from starload.functions.fields import any_of, first_failure, is_missing, nan_to_null, to_nullable_int
from starload.functions.text import null_if_empty
from starload.functions.times import datetime_text, parse_datetime
from starload.operators.constraints import audit
from starload.operators.foreign_keys import flag_name, orphan_keys, with_parent_flag
from starload.operators.ids import assign_ids
from starload.operators.judge import FOREIGN_KEY, MISSING_FIELD, judge_request_rows
from starload.operators.keys import absent_rows, first_by_key
from starload.operators.keys import key_violations as repeated_keys
from starload.operators.requests import as_request_rows, request_sizes, summarize, with_request_status
from starload.session import fresh_dir
from starload.spec import HIRED_EMPLOYEES, ForeignKey, TableSpec

HIRES: TableSpec = HIRED_EMPLOYEES.widened()

SUPPLIER_KEY = ForeignKey("department_id", "departments")


# -- fields ---------------------------------------------------------------------------------------


def null_if_empty_text(spark: SparkSession, sf: str) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_orderstatus"))
    return table(spark, sf, "orders").select("o_orderkey", null_if_empty(status).alias("o_orderstatus"))


def missing_field_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Keys start at 0, and 0 counts as missing."""
    rows = table(spark, sf, "lineitem")
    missing = any_of(*[is_missing(F.col(c), rows.schema[c].dataType) for c in ("l_suppkey", "l_partkey")])
    return rows.where(missing).select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey")


def datetime_text_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Timestamps to text and back; every 7th text is NaT and every 11th no date, which come back null."""
    texts = table(spark, sf, "events").select(
        "event_id",
        F.when(F.col("event_id") % 7 == 0, "NaT")
        .when(F.col("event_id") % 11 == 0, "2021-02-30 00:00:00")
        .otherwise(datetime_text(F.col("ts")))
        .alias("text"),
    )
    return texts.select("event_id", "text", parse_datetime(F.col("text")).alias("ts"))


def datetime_rounding(spark: SparkSession, sf: str) -> DataFrame:
    """Text with microseconds is read to the nearest second."""
    text = F.concat(F.replace(F.col("ts").cast("string"), F.lit(" "), F.lit("T")), F.lit("Z"))
    return table(spark, sf, "events").select("event_id", parse_datetime(text).alias("ts"))


def nullable_numbers(spark: SparkSession, sf: str) -> DataFrame:
    """Event values with NaN put in by rule: as whole numbers, as text and as doubles, null for NaN."""
    value = F.when(F.col("event_id") % 3 == 0, F.lit(float("nan"))).otherwise(F.floor("value").cast("double"))
    whole = to_nullable_int(value)
    return table(spark, sf, "events").select(
        "event_id", whole.alias("whole"), whole.cast("string").alias("text"), nan_to_null(value).alias("value")
    )


# -- foreign keys ---------------------------------------------------------------------------------


def _flagged(spark: SparkSession, sf: str) -> DataFrame:
    parents = solvent_departments(spark, sf)
    return with_parent_flag(fact(spark, sf), SUPPLIER_KEY, parents, flag_name(SUPPLIER_KEY))


def fk_accepted(spark: SparkSession, sf: str) -> DataFrame:
    return _flagged(spark, sf).where(F.col(flag_name(SUPPLIER_KEY))).drop(flag_name(SUPPLIER_KEY))


def fk_rejected(spark: SparkSession, sf: str) -> DataFrame:
    return _flagged(spark, sf).where(~F.col(flag_name(SUPPLIER_KEY))).drop(flag_name(SUPPLIER_KEY))


def fk_audit(spark: SparkSession, sf: str) -> DataFrame:
    return orphan_keys(fact(spark, sf), SUPPLIER_KEY, solvent_departments(spark, sf))


def reject_reasons(spark: SparkSession, sf: str) -> DataFrame:
    """First reason per fact row, counted: missing key first, then no parent."""
    rows = _flagged(spark, sf)
    missing = any_of(*[is_missing(F.col(c), rows.schema[c].dataType) for c in ("department_id", "job_id")])
    code = first_failure((missing, MISSING_FIELD), (~F.col(flag_name(SUPPLIER_KEY)), FOREIGN_KEY))
    return rows.groupBy(code.alias("reason_code")).agg(F.count(F.lit(1)).alias("rows"))


# -- keys -----------------------------------------------------------------------------------------

LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_ORDER = [
    "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
]


def key_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    return first_by_key(table(spark, sf, "lineitem"), LINE_KEY, LINE_ORDER)


def key_violations(spark: SparkSession, sf: str) -> DataFrame:
    return repeated_keys(table(spark, sf, "lineitem"), LINE_KEY)


def append_if_absent(spark: SparkSession, sf: str) -> DataFrame:
    """Orders of status F are stored under a note; all orders come in; the stored ones stay."""
    orders = table(spark, sf, "orders")
    stored = orders.where("o_orderstatus = 'F'").select("o_orderkey", F.lit("stored").alias("note"))
    incoming = orders.select("o_orderkey", F.col("o_orderpriority").alias("note"))
    return stored.unionByName(absent_rows(incoming, stored, "o_orderkey"))


def assigned_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Ids 1001, 1002, ... by date, then key."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return assign_ids(orders, "id", ["o_orderdate", "o_orderkey"], fresh_dir(spark, "ids"), after=1000)


# -- requests -------------------------------------------------------------------------------------


def request_cap(spark: SparkSession, sf: str) -> DataFrame:
    """One request per calendar month, at most 1200 rows each."""
    rows = table(spark, sf, "orders").select(F.month("o_orderdate").alias("request_id"))
    return request_sizes(rows, 1200)


def _requests(spark: SparkSession, sf: str) -> DataFrame:
    """Requests of 200 orders; every seventh takes in its successor and so exceeds a cap of 300."""
    block = F.expr("id div 200")
    request = F.when(block % 7 == 4, block - 1).otherwise(block)
    return hires(spark, sf).select(
        request.cast("string").alias("request_id"),
        (F.col("id") % 200 + F.when(block % 7 == 4, 200).otherwise(0)).cast("int").alias("ordinal"),
        "name",
        F.when(F.col("id") % 19 == 0, "2021-02-30").otherwise(datetime_text(F.col("hire_datetime"))).alias("hire_datetime"),
        "department_id",
        F.col("job_id").cast("bigint").alias("job_id"),
    )


def _judged(spark: SparkSession, sf: str) -> DataFrame:
    rows = with_request_status(as_request_rows(_requests(spark, sf), HIRES), 300)
    spec = replace(HIRES, max_length={"name": 14})
    return judge_request_rows(rows, spec, {"departments": solvent_customers(spark, sf), "jobs": nations(spark, sf)})


JUDGED_SQL = f"""WITH {HIRES_SQL},
{PARENTS_SQL},
requests AS (
  SELECT CASE WHEN (id // 200) % 7 = 4 THEN id // 200 - 1 ELSE id // 200 END AS request,
         id % 200 + CASE WHEN (id // 200) % 7 = 4 THEN 200 ELSE 0 END AS ordinal,
         name, id % 19 = 0 AS bad_date, department_id, job_id FROM hires),
sized AS (SELECT *, COUNT(*) OVER (PARTITION BY request) > 300 AS refused FROM requests),
judged AS (
  SELECT CAST(request AS VARCHAR) AS request_id, CAST(ordinal AS INTEGER) AS ordinal, name, department_id,
         CAST(job_id AS BIGINT) AS job_id, refused,
         CASE WHEN refused THEN 'TOO_MANY_ROWS'
              WHEN name = '' OR department_id = 0 OR job_id = 0 THEN 'MISSING_FIELD'
              WHEN department_id NOT IN (SELECT id FROM departments) OR job_id NOT IN (SELECT id FROM jobs)
                THEN 'FOREIGN_KEY'
              WHEN length(name) > 14 THEN 'TOO_LONG'
              WHEN bad_date THEN 'BAD_DATETIME' END AS reason_code
  FROM sized)
"""


def judged_requests(spark: SparkSession, sf: str) -> DataFrame:
    return _judged(spark, sf).select(
        "request_id", "ordinal", "name", "department_id", "job_id", "reason_code", "reason"
    )


def ingest_summary(spark: SparkSession, sf: str) -> DataFrame:
    return summarize(_judged(spark, sf))


# -- audit ----------------------------------------------------------------------------------------


def constraint_audit(spark: SparkSession, sf: str) -> DataFrame:
    """hires with halved ids, empty names as null and a length limit of 8, against every rule."""
    rows = hires(spark, sf).select(
        F.expr("id div 2").alias("id"),
        null_if_empty(F.col("name")).alias("name"),
        "hire_datetime",
        "department_id",
        F.when(F.col("job_id") < 26, F.col("job_id")).cast("bigint").alias("job_id"),
    )
    fields = [f if f.name != "name" else type(f)(f.name, f.dataType, False) for f in HIRES.schema]
    spec = replace(HIRES, schema=type(HIRES.schema)(fields), max_length={"name": 8})
    return audit(rows, spec, {"departments": solvent_customers(spark, sf), "jobs": nations(spark, sf)})


ENTRIES = {
    "null_if_empty": (
        null_if_empty_text,
        """SELECT o_orderkey, NULLIF(CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderstatus END, '') AS o_orderstatus
FROM orders""",
    ),
    "missing_field_rows": (
        missing_field_rows,
        "SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey FROM lineitem WHERE l_suppkey = 0 OR l_partkey = 0",
    ),
    "datetime_text_roundtrip": (
        datetime_text_roundtrip,
        """WITH texts AS (
  SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 'NaT' WHEN event_id % 11 = 0 THEN '2021-02-30 00:00:00'
                        ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS text FROM events)
SELECT event_id, text, TRY_CAST(text AS TIMESTAMP) AS ts FROM texts""",
    ),
    "datetime_rounding": (
        datetime_rounding,
        "SELECT event_id, date_trunc('second', ts + INTERVAL 500 MILLISECOND) AS ts FROM events",
    ),
    "nullable_numbers": (
        nullable_numbers,
        """WITH rounded AS (SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN floor(value) END AS value FROM events)
SELECT event_id, CAST(value AS INTEGER) AS whole, CAST(CAST(value AS INTEGER) AS VARCHAR) AS text, value FROM rounded""",
    ),
    "fk_accepted": (
        fk_accepted,
        """SELECT l_orderkey AS id, l_shipdate AS hire_datetime, l_suppkey AS department_id, l_partkey AS job_id
FROM lineitem WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)""",
    ),
    "fk_rejected": (
        fk_rejected,
        """SELECT l_orderkey AS id, l_shipdate AS hire_datetime, l_suppkey AS department_id, l_partkey AS job_id
FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)""",
    ),
    "fk_audit": (
        fk_audit,
        """SELECT l_suppkey AS department_id, COUNT(*) AS "rows" FROM lineitem
WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) GROUP BY l_suppkey""",
    ),
    "reject_reasons": (
        reject_reasons,
        """SELECT CASE WHEN l_suppkey = 0 OR l_partkey = 0 THEN 'MISSING_FIELD'
            WHEN l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) THEN 'FOREIGN_KEY'
       END AS reason_code, COUNT(*) AS "rows" FROM lineitem GROUP BY 1""",
    ),
    "key_dedupe": (
        key_dedupe,
        f"""SELECT * EXCLUDE (place) FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY {', '.join(LINE_KEY)} ORDER BY {', '.join(LINE_ORDER)}) AS place
  FROM lineitem) WHERE place = 1""",
    ),
    "key_violations": (
        key_violations,
        """SELECT l_orderkey, l_linenumber, COUNT(*) AS "rows" FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1""",
    ),
    "append_if_absent": (
        append_if_absent,
        "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'stored' ELSE o_orderpriority END AS note FROM orders",
    ),
    "assign_ids": (
        assigned_ids,
        """SELECT o_orderkey, o_orderdate, 1000 + ROW_NUMBER() OVER (ORDER BY o_orderdate, o_orderkey) AS id
FROM orders""",
    ),
    "request_cap": (
        request_cap,
        """SELECT CAST(EXTRACT(month FROM o_orderdate) AS INTEGER) AS request_id, COUNT(*) AS "rows",
       COUNT(*) > 1200 AS refused FROM orders GROUP BY 1""",
    ),
    "judged_requests": (
        judged_requests,
        JUDGED_SQL
        + """SELECT request_id, ordinal, name, department_id, job_id, reason_code,
       CASE reason_code WHEN 'MISSING_FIELD' THEN 'missing field'
            WHEN 'FOREIGN_KEY' THEN 'not found: department_id ' || department_id || ' or job_id ' || job_id
            ELSE lower(replace(reason_code, '_', ' ')) END AS reason FROM judged""",
    ),
    "ingest_summary": (
        ingest_summary,
        JUDGED_SQL
        + """SELECT request_id, CASE WHEN bool_or(refused) THEN 'TOO_MANY_ROWS' ELSE 'OK' END AS status,
       COUNT(*) FILTER (WHERE reason_code IS NULL) AS inserted,
       COUNT(*) FILTER (WHERE reason_code IS NOT NULL) AS failed FROM judged GROUP BY request_id""",
    ),
    "constraint_audit": (
        constraint_audit,
        f"""WITH {HIRES_SQL},
{PARENTS_SQL},
rows_ AS (SELECT id // 2 AS id, NULLIF(name, '') AS name, department_id,
                 CASE WHEN job_id < 26 THEN job_id END AS job_id FROM hires)
SELECT 'not_null:id' AS rule, COUNT(*) FILTER (WHERE id IS NULL) AS violations FROM rows_
UNION ALL SELECT 'not_null:name', COUNT(*) FILTER (WHERE name IS NULL) FROM rows_
UNION ALL SELECT 'max_length:name', COUNT(*) FILTER (WHERE length(name) > 8) FROM rows_
UNION ALL SELECT 'primary_key:id', COUNT(*) - COUNT(DISTINCT id) FROM rows_
UNION ALL SELECT 'foreign_key:department_id', COUNT(*) FROM rows_
  WHERE department_id NOT IN (SELECT id FROM departments)
UNION ALL SELECT 'foreign_key:job_id', COUNT(*) FROM rows_ WHERE job_id NOT IN (SELECT id FROM jobs)""",
    ),
}
