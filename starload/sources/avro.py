"""Avro container files through Spark's own Avro format.

The short name ``avro`` needs the spark-avro module to be deployed; the format class itself is in the SQL
jar of Spark 4.1, so its full name works without.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from starload.files import Files

FORMAT = "org.apache.spark.sql.avro.AvroFileFormat"


def avro_schema(name: str, schema: T.StructType) -> dict:
    """Record schema of a flat table; nullable columns are unions with null."""

    def kind(field: T.StructField):
        if isinstance(field.dataType, T.StringType):
            plain = "string"
        elif isinstance(field.dataType, T.IntegerType):
            plain = "int"
        elif isinstance(field.dataType, T.LongType):
            plain = "long"
        else:
            raise TypeError(f"no Avro form for {field.name}: {field.dataType.simpleString()}")
        return ["null", plain] if field.nullable else plain

    return {"type": "record", "name": name, "fields": [{"name": f.name, "type": kind(f)} for f in schema]}


def write_avro(
    rows: DataFrame, path: str, name: str, schema: T.StructType, folders_by: Sequence[str] = ()
) -> None:
    """Write ``rows`` as container files with exactly the declared record schema, in folders by other columns."""
    typed = rows.select(*[rows[f.name].cast(f.dataType).alias(f.name) for f in schema], *folders_by)
    writer = typed.write.mode("append").format(FORMAT).option("avroSchema", json.dumps(avro_schema(name, schema)))
    (writer.partitionBy(*folders_by) if folders_by else writer).save(path)


def read_avro(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType) -> DataFrame:
    """Rows of container files or of folders of them; a folder without any is an error."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    if not paths:
        return spark.createDataFrame([], schema)
    for path in paths:
        container_files(spark, path)
    return spark.read.format(FORMAT).load(paths).select(*schema.names)


def container_files(spark: SparkSession, path: str) -> list[str]:
    """The container files at ``path``, a file or a folder; none is an error."""
    files = Files(spark)
    if files.is_file(path):
        return [path]
    found = [f"{path}/{n}" for n in files.names(path) if n.endswith(".avro") and n[0] not in "_."]
    if not found:
        raise FileNotFoundError(f"no .avro file in {path}")
    return found
