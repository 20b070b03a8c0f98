"""Keys looked up by the filters that are kept beside the stored folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue.movement import _snapshot_source, _warehouse, _with_dimensions, _write_lines
from catalogue.tables import table
from starload.plans.load import load_history
from starload.session import fresh_dir

TABLE = "hired_employees"


def indexed_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Which part keys and customer keys of the lineitems and orders are order keys; the last folder has no index."""
    warehouse, rows = _with_dimensions(spark, sf, "indexed"), _snapshot_source(spark, sf).read(TABLE)
    for k in range(4):
        warehouse.publish(TABLE, warehouse.stage(TABLE, rows.where(f"pmod(xxhash64(id), 4) = {k}")), f"part-{k}")
        if k == 2:
            warehouse.keep_keys(TABLE, per_slice=4_096)
    asked = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("id"))
    asked = asked.unionByName(table(spark, sf, "orders").select((F.col("o_custkey") * 3).alias("id")))
    return warehouse.present_keys(TABLE, asked)


def indexed_reload(spark: SparkSession, sf: str) -> DataFrame:
    """A file of a third of the stored customers and as many new ones, over folders that hold keys of the whole range."""
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("department"))
    warehouse = _warehouse(spark, "reloaded")
    warehouse.create()
    for k in range(3):
        part = customers.where(f"pmod(xxhash64(id), 3) = {k}")
        warehouse.publish("departments", warehouse.stage("departments", part), f"part-{k}")
    warehouse.keep_keys("departments")
    again = customers.where("id % 3 = 0").select("id", F.lit("again").alias("department"))
    new = again.select(-F.col("id") - 1, F.lit("new"))
    path = _write_lines(again.union(new), fresh_dir(spark, "reload"))
    report = load_history(warehouse, {"departments": path})
    stored = F.lit(report.stored("departments")).cast("bigint").alias("stored")
    names = F.when(F.col("department").isin("again", "new"), F.col("department")).otherwise("kept").alias("kind")
    return warehouse.read("departments").groupBy(names).agg(F.count(F.lit(1)).alias("rows"), F.sum("id").alias("ids")).select(
        "kind", "rows", "ids", stored
    )


ENTRIES = {
    "indexed_lookup": (
        indexed_lookup,
        """SELECT DISTINCT id FROM (SELECT l_partkey AS id FROM lineitem UNION ALL SELECT o_custkey * 3 FROM orders)
WHERE id IN (SELECT o_orderkey FROM orders)""",
    ),
    "indexed_reload": (
        indexed_reload,
        """WITH new AS (SELECT -c_custkey - 1 AS id FROM customer WHERE c_custkey % 3 = 0),
counted AS (SELECT COUNT(*) AS stored FROM new)
SELECT kind, COUNT(*) AS "rows", CAST(SUM(id) AS BIGINT) AS ids, ANY_VALUE(stored) AS stored
FROM (SELECT 'kept' AS kind, c_custkey AS id FROM customer UNION ALL SELECT 'new', id FROM new), counted GROUP BY kind""",
    ),
}
