"""The given tables in the roles of the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as the fact: supplier is its department, part its job."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("id"),
        F.col("l_shipdate").alias("hire_datetime"),
        F.col("l_suppkey").alias("department_id"),
        F.col("l_partkey").alias("job_id"),
    )


def departments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("department"))


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("job"))


def gappy_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem with nulls put in by rule: keys, datetimes and ids."""
    line = table(spark, sf_dir, "lineitem")
    return line.select(
        F.when(F.col("l_tax") > 0.01, F.col("l_orderkey")).alias("id"),
        F.when(F.col("l_linenumber") != 3, F.col("l_shipdate")).alias("hire_datetime"),
        F.when(F.col("l_quantity") >= 5, F.col("l_suppkey")).alias("department_id"),
        F.when(F.col("l_discount") > 0.005, F.col("l_partkey")).alias("job_id"),
    )


def solvent_departments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers with a positive balance; the others' fact rows have no parent."""
    supplier = table(spark, sf_dir, "supplier").where("s_acctbal > 0")
    return supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("department"))


def hires(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as hires: customer is the department, nation the job; some names are empty."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_orderpriority")).alias("name"),
        F.expr("o_orderdate + make_dt_interval(0, 0, 0, o_orderkey % 86400)").alias("hire_datetime"),
        F.col("o_custkey").alias("department_id"),
        (F.col("o_orderkey") % 27).cast("int").alias("job_id"),
    )


HIRES_SQL = """hires AS (
  SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderpriority END AS name,
         o_orderdate + to_seconds(o_orderkey % 86400) AS hire_datetime, o_custkey AS department_id, CAST(o_orderkey % 27 AS INTEGER) AS job_id
  FROM orders)"""


def solvent_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").where("c_acctbal > 0")
    return customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("department"))


def nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("job"))


PARENTS_SQL = """departments AS (SELECT c_custkey AS id, c_name AS department FROM customer WHERE c_acctbal > 0),
jobs AS (SELECT n_nationkey AS id, n_name AS job FROM nation)"""
