import json
import os
from datetime import datetime

import pytest
from helpers import rows, stored_star
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starload.operators.checksums import added, checksum, limb_sums
from starload.plans.snapshot import SKIPPED, backup, backup_changes, orphan_report, read_snapshot, restore, snapshot_schema
from starload.sources.avro import avro_schema, read_avro, write_avro
from starload.spec import DEPARTMENTS, HIRED_EMPLOYEES, JOBS

TABLE = "hired_employees"
NOW = datetime(2025, 2, 18, 23, 35, 16)
AT = datetime(2021, 5, 5, 1, 2, 3)
HIRES = [
    (1, "Ann", AT, 1, 1),
    (2, None, None, None, None),
    (3, "", datetime(2021, 1, 1), 2, 2),
    (4, "Zoë \"✓\" \\ \n\t,\x01", datetime(1999, 12, 31, 23, 59, 59), 1, 2),
    (2**31 - 1, "x" * 255, datetime(2021, 1, 1), 1, 1),
]


def jvm_records(spark, folder: str) -> tuple[list[str], list[str]]:
    """Schema and records of a folder's container files, read by Avro's own Java reader."""
    jvm = spark._jvm
    schemas, records = [], []
    for path in sorted(jvm.java.io.File(folder).listFiles(), key=str):
        if not path.getName().endswith(".avro"):
            continue
        reader = jvm.org.apache.avro.file.DataFileReader(path, jvm.org.apache.avro.generic.GenericDatumReader())
        schemas.append(reader.getSchema().toString())
        while reader.hasNext():
            records.append(reader.next().toString())
        reader.close()
    return schemas, records


def test_backup_and_restore_keep_everything(spark, root):
    warehouse = stored_star(spark, root, hires=HIRES)
    path = backup(warehouse, TABLE, f"{root}/backups", NOW)
    assert path == f"{root}/backups/{TABLE}/{TABLE}_backup_20250218_233516.avro"
    report = restore(warehouse, TABLE, path, check_fk=True)
    assert rows(warehouse.read(TABLE)) == rows(spark.createDataFrame(HIRES, warehouse.read(TABLE).schema))
    assert (report.rows, report.unreadable, report.orphans) == (5, {"hire_datetime": 0}, 0)
    assert warehouse.max_id(TABLE) == 2**31 - 1


def test_files_are_avro_with_the_declared_schema(spark, root):
    warehouse = stored_star(spark, root, hires=HIRES)
    path = backup(warehouse, TABLE, f"{root}/backups", NOW).removeprefix("file:")
    schemas, records = jvm_records(spark, path)
    assert {json.dumps(json.loads(s), sort_keys=True) for s in schemas} == {
        json.dumps(avro_schema(TABLE, snapshot_schema(HIRED_EMPLOYEES)), sort_keys=True)
    }
    fields = {f["name"]: f["type"] for f in json.loads(schemas[0])["fields"]}
    assert fields == {
        "id": "int", "name": ["null", "string"], "hire_datetime": ["null", "string"],
        "department_id": ["null", "int"], "job_id": ["null", "int"],
    }
    by_id = {r["id"]: r for r in map(json.loads, records)}
    assert by_id[2] == {"id": 2, "name": None, "hire_datetime": None, "department_id": None, "job_id": None}
    assert by_id[3]["hire_datetime"] == "2021-01-01 00:00:00"
    assert by_id[4]["name"] == HIRES[3][1]


def test_many_batches_and_wide_numbers(spark, root):
    schema = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("n", T.LongType()), T.StructField("s", T.StringType())])
    data = spark.range(25_000).select(
        (F.col("id") * 368_934_881_474_191 - 2**62).alias("id"),
        F.when(F.col("id") % 3 != 0, F.col("id") - 12_000).alias("n"),
        F.when(F.col("id") % 5 != 0, F.repeat(F.lit("ñ"), (F.col("id") % 300).cast("int"))).alias("s"),
    )
    write_avro(data.repartition(3), f"{root}/wide", "wide", schema)
    back = read_avro(spark, f"{root}/wide", schema)
    assert back.count() == 25_000
    assert back.exceptAll(data).count() == 0
    _, records = jvm_records(spark, f"{root}/wide".removeprefix("file:"))
    assert len(records) == 25_000


def test_null_in_a_required_column_fails_and_leaves_no_file(spark, root):
    schema = T.StructType([T.StructField("id", T.IntegerType(), False)])
    with pytest.raises(Exception):
        write_avro(spark.createDataFrame([(1,), (None,)], "id int"), f"{root}/bad", "bad", schema)
    with pytest.raises(FileNotFoundError):
        read_avro(spark, f"{root}/bad", schema)


def test_unsupported_types_are_refused():
    with pytest.raises(TypeError):
        avro_schema("t", T.StructType([T.StructField("d", T.DecimalType(10, 2))]))


def test_empty_table_is_skipped(spark, root):
    warehouse = stored_star(spark, root)
    assert backup(warehouse, TABLE, f"{root}/backups", NOW) == SKIPPED
    assert not warehouse.files.exists(f"{root}/backups")


def test_second_backup_in_the_same_second_is_refused_and_older_ones_stay(spark, root):
    warehouse = stored_star(spark, root)
    first = backup(warehouse, "jobs", f"{root}/backups", NOW)
    with pytest.raises(FileExistsError):
        backup(warehouse, "jobs", f"{root}/backups", NOW)
    second = backup(warehouse, "jobs", f"{root}/backups", datetime(2025, 2, 18, 23, 35, 17))
    assert rows(read_snapshot(spark, JOBS, first)) == rows(read_snapshot(spark, JOBS, second)) == rows(warehouse.read("jobs"))


def old_snapshot(spark, folder: str, records: list[tuple]) -> str:
    """As the old tool wrote it: one file, datetime text not nullable."""
    schema = T.StructType([T.StructField(f.name, f.dataType, f.nullable and f.name != "hire_datetime") for f in snapshot_schema(HIRED_EMPLOYEES)])
    write_avro(spark.createDataFrame(records, schema).coalesce(1), folder, TABLE, schema)
    return folder


def test_snapshot_of_the_old_tool(spark, root):
    """NaT and date-only texts, no manifest, and the single file named by itself."""
    warehouse = stored_star(spark, root, hires=HIRES[:1])
    folder = old_snapshot(
        spark, f"{root}/old",
        [(1, "a", "NaT", 1, 1), (2, "b", "2021-02-03", None, 2), (3, None, "2021-02-03 04:05:06", 9, 1), (4, "d", "garbage", 1, 8)],
    )
    name = next(n for n in warehouse.files.names(folder) if n.endswith(".avro"))
    report = restore(warehouse, TABLE, f"{folder}/{name}", check_fk=True, trust_unverified=True)
    assert (report.rows, report.unreadable, report.orphans) == (4, {"hire_datetime": 2}, 2)
    assert rows(warehouse.read(TABLE)) == [
        (1, "a", None, 1, 1), (2, "b", datetime(2021, 2, 3), None, 2),
        (3, None, datetime(2021, 2, 3, 4, 5, 6), 9, 1), (4, "d", None, 1, 8),
    ]


def test_restore_replaces_and_ids_go_on_from_it(spark, root):
    warehouse = stored_star(spark, root, hires=HIRES[:1])
    path = backup(warehouse, TABLE, f"{root}/backups", NOW)
    more = spark.createDataFrame([(77, "late", AT, 1, 1)], warehouse.read(TABLE).schema)
    warehouse.publish(TABLE, warehouse.stage(TABLE, more), "late")
    assert warehouse.max_id(TABLE) == 77
    restore(warehouse, TABLE, path)
    assert rows(warehouse.read(TABLE)) == rows(spark.createDataFrame(HIRES[:1], warehouse.read(TABLE).schema))
    assert warehouse.max_id(TABLE) == 1
    assert warehouse.read(TABLE).schema["id"].dataType == T.IntegerType()


@pytest.mark.parametrize(
    "records, rule",
    [
        ([(1, "a", "2021-01-01", 1, 1), (1, "b", "2021-01-01", 1, 1)], "primary_key:id"),
        ([(1, "n" * 256, "2021-01-01", 1, 1)], "max_length:name"),
    ],
)
def test_snapshot_that_breaks_a_rule_leaves_the_table(spark, root, records, rule):
    warehouse = stored_star(spark, root, hires=HIRES[:1])
    with pytest.raises(ValueError, match=rule):
        restore(warehouse, TABLE, old_snapshot(spark, f"{root}/old", records), trust_unverified=True)
    assert warehouse.read(TABLE).count() == 1


def test_damaged_missing_and_incomplete_snapshots_leave_the_table(spark, root, tmp_path):
    warehouse = stored_star(spark, root, hires=HIRES)
    path = backup(warehouse, TABLE, f"{root}/backups", NOW)
    folder = path.removeprefix("file:")
    names = [n for n in warehouse.files.names(path) if n.endswith(".avro")]

    damaged = tmp_path / "damaged.avro"
    damaged.write_bytes(open(f"{folder}/{names[0]}", "rb").read()[:-30])
    with pytest.raises(ValueError, match="no row count"):
        restore(warehouse, TABLE, f"file:{damaged}")
    with pytest.raises(Exception):
        restore(warehouse, TABLE, f"file:{damaged}", trust_unverified=True)
    with pytest.raises(FileNotFoundError):
        restore(warehouse, TABLE, f"{root}/nothing")
    os.rename(f"{folder}/{names[0]}", tmp_path / "elsewhere.avro")
    if len(names) > 1:
        with pytest.raises(ValueError, match="5 were written"):
            restore(warehouse, TABLE, path)
    else:
        with pytest.raises(FileNotFoundError):
            restore(warehouse, TABLE, path)
    assert warehouse.read(TABLE).count() == 5


def test_parents_may_be_restored_after_the_fact(spark, root):
    warehouse = stored_star(spark, root, hires=HIRES)
    paths = {name: backup(warehouse, name, f"{root}/backups", NOW) for name in warehouse.specs}
    for name in warehouse.specs:
        warehouse.drop(name)
    warehouse.create()
    assert restore(warehouse, TABLE, paths[TABLE], check_fk=True).orphans == 8
    for name in (DEPARTMENTS.name, JOBS.name):
        restore(warehouse, name, paths[name])
    assert rows(warehouse.read("departments")) == [(1, "Sales"), (2, "Legal")]


def test_snapshot_cut_at_a_block_is_found_by_the_count(spark, root, tmp_path):
    warehouse = stored_star(spark, root, hires=HIRES[:1])
    many = spark.range(1, 40_001).select(
        F.col("id").cast("int"), F.lit("a longer name of an employee").alias("name"), F.lit(AT).cast("timestamp_ntz").alias("hire_datetime"),
        F.lit(1).alias("department_id"), F.lit(1).alias("job_id"),
    )
    schema = snapshot_schema(HIRED_EMPLOYEES)
    texts = many.withColumn("hire_datetime", F.col("hire_datetime").cast("string"))
    write_avro(texts.coalesce(1), f"{root}/big", TABLE, schema)
    name = next(n for n in warehouse.files.names(f"{root}/big") if n.endswith(".avro"))
    data = open(f"{root}/big/{name}".removeprefix("file:"), "rb").read()
    marker = data[-16:]
    cut = data[: data.rindex(marker, 0, len(data) - 16) + 16]  # ends with the marker of the last but one block
    (tmp_path / "cut.avro").write_bytes(cut)
    path = f"file:{tmp_path}/cut.avro"
    with pytest.raises(ValueError, match="no row count"):
        restore(warehouse, TABLE, path)
    with pytest.raises(ValueError, match="40000 were written"):
        restore(warehouse, TABLE, path, expected_rows=40_000)
    assert warehouse.read(TABLE).count() == 1
    assert restore(warehouse, TABLE, path, trust_unverified=True).rows < 40_000


def test_fractions_round_and_far_years_are_refused(spark, root):
    warehouse = stored_star(spark, root)
    schema = warehouse.read(TABLE).schema
    given = [(1, "a", datetime(2021, 1, 1, 0, 0, 0, 900_000), 1, 1), (2, "b", None, 1, 1)]
    warehouse.publish(TABLE, warehouse.stage(TABLE, spark.createDataFrame(given, schema)), "given")
    restore(warehouse, TABLE, backup(warehouse, TABLE, f"{root}/backups", NOW))
    assert rows(warehouse.read(TABLE))[0][2] == datetime(2021, 1, 1, 0, 0, 1)
    far = spark.createDataFrame(given[:1], schema).withColumn("hire_datetime", F.expr("timestamp_ntz'2021-01-01' + interval '10000' year"))
    warehouse.publish(TABLE, warehouse.stage(TABLE, far), "far")
    with pytest.raises(Exception, match="cannot be kept"):
        backup(warehouse, TABLE, f"{root}/later", NOW)


def test_chain_of_snapshots(spark, root):
    """Each holds what is new; a rewrite of the table makes everything new; any of them restores by itself."""
    warehouse = stored_star(spark, root, hires=HIRES[:2])
    paths, states = [], []

    def save(second):
        paths.append(backup_changes(warehouse, TABLE, f"{root}/backups", paths[-1] if paths else None, NOW.replace(second=second)))
        states.append(rows(warehouse.read(TABLE)))

    def add(batch, given):
        warehouse.publish(TABLE, warehouse.stage(TABLE, spark.createDataFrame(given, warehouse.read(TABLE).schema)), batch)

    save(1)
    add("s-1", HIRES[2:4])
    save(2)
    save(3)
    warehouse.compact(TABLE)
    add("s-2", HIRES[4:])
    save(4)
    parts = [[n for n in warehouse.files.names(p) if n.startswith("part=")] for p in paths]
    assert [len(p) for p in parts] == [1, 1, 0, 2]
    target = stored_star(spark, root + "-other")
    for path, held in reversed(list(zip(paths, states))):
        assert restore(target, TABLE, path).rows == len(held)
        assert rows(target.read(TABLE)) == held == rows(read_snapshot(spark, HIRED_EMPLOYEES, path))
    assert target.state(TABLE).taken == {} and rows(target.read(TABLE)) == states[0]
    flat = backup(warehouse, TABLE, f"{root}/backups", NOW.replace(second=9))
    with pytest.raises(ValueError, match="not a snapshot of a chain"):
        backup_changes(warehouse, TABLE, f"{root}/backups", flat, NOW.replace(second=10))
    assert backup_changes(stored_star(spark, root + "-empty"), TABLE, f"{root}/backups") == SKIPPED


def test_a_part_missing_from_the_chain_leaves_the_table(spark, root):
    warehouse = stored_star(spark, root, hires=HIRES[:2])
    first = backup_changes(warehouse, TABLE, f"{root}/backups", None, NOW)
    more = spark.createDataFrame(HIRES[2:], warehouse.read(TABLE).schema)
    warehouse.publish(TABLE, warehouse.stage(TABLE, more), "more")
    second = backup_changes(warehouse, TABLE, f"{root}/backups", first, NOW.replace(second=17))
    warehouse.files.delete(first)
    with pytest.raises(FileNotFoundError):
        restore(warehouse, TABLE, second)
    assert warehouse.read(TABLE).count() == 5


def test_a_file_swapped_for_one_of_as_many_rows_is_refused(spark, root):
    warehouse = stored_star(spark, root, hires=HIRES)
    path = backup(warehouse, TABLE, f"{root}/backups", NOW)
    other = stored_star(spark, root + "-other", hires=[*HIRES[:2], (4, *HIRES[2][1:]), (3, *HIRES[3][1:]), HIRES[4]])
    swapped = backup(other, TABLE, f"{root}-other/backups", NOW)
    for name in warehouse.files.names(path):
        if name.endswith(".avro"):
            os.unlink(f"{path}/{name}".removeprefix("file:"))
    for name in warehouse.files.names(swapped):
        if name.endswith(".avro"):
            os.link(f"{swapped}/{name}".removeprefix("file:"), f"{path}/{name}".removeprefix("file:"))
    with pytest.raises(ValueError, match="other rows than were written"):
        restore(warehouse, TABLE, path)
    assert rows(warehouse.read(TABLE)) == rows(spark.createDataFrame(HIRES, warehouse.read(TABLE).schema))


def test_checksum_knows_neither_order_nor_splits(spark):
    schema = HIRED_EMPLOYEES.schema
    given = spark.createDataFrame(HIRES * 20, schema)

    def total(df, fields=schema):
        return checksum(df.agg(*limb_sums(fields)).first())

    parts = [r for r in given.groupBy("job_id").agg(*limb_sums(schema)).collect()]
    assert total(given) == total(given.repartition(7)) == total(given.orderBy("id")) == checksum(*parts)
    assert added([checksum(p) for p in parts]) == total(given)
    wide = HIRED_EMPLOYEES.widened().schema
    assert total(given.select([F.col(f.name).cast(f.dataType) for f in wide]), wide) == total(given)
    swapped = given.withColumns({"department_id": F.col("job_id"), "job_id": F.col("department_id")})
    assert len({total(given), total(swapped), total(given.limit(99)), total(given.limit(0))}) == 4
    moved = spark.createDataFrame([(1, None, None, 5, None)], schema), spark.createDataFrame([(1, None, None, None, 5)], schema)
    assert total(moved[0]) != total(moved[1])


def test_restored_parent_lists_its_childrens_orphans(spark, root):
    warehouse = stored_star(spark, root, hires=[*HIRES[:3], (9, "i", AT, 3, 1), (10, "j", AT, 3, 2), (11, "k", AT, 4, 1)])
    path = backup(warehouse, "departments", f"{root}/backups", NOW)
    more = spark.createDataFrame([(3, "Lab")], warehouse.read("departments").schema)
    warehouse.publish("departments", warehouse.stage("departments", more), "more")
    report = restore(warehouse, "departments", path, check_fk=True)
    assert rows(report.orphan_keys) == [(TABLE, "department_id", "departments", 3, 2), (TABLE, "department_id", "departments", 4, 1)]
    assert report.orphans == 0 and restore(warehouse, "departments", path).orphan_keys is None
    warehouse.drop(TABLE)
    assert rows(orphan_report(warehouse, "departments")) == []
