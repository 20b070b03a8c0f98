"""Key filters beside stored folders: no stored key is missed, few keys are read, and indexes follow their folders."""

import random

import pytest
from helpers import history_file
from pyspark.sql import functions as F

from starload import Warehouse
from starload.operators.keys import present_keys
from starload.operators.membership import BITS_PER_KEY, PER_SLICE, filter_words, layout, may_hold
from starload.plans.load import load_history
from starload.plans.snapshot import backup, restore
from starload.spec import STAR

TABLE = "departments"
WIDE = [spec.widened() for spec in STAR]


def warehouse_of(spark, root, folders):
    warehouse = Warehouse(spark, root, WIDE)
    warehouse.create()
    for i, keys in enumerate(folders):
        rows = spark.createDataFrame([(k, f"d{k}") for k in keys], warehouse.read(TABLE).schema)
        warehouse.publish(TABLE, warehouse.stage(TABLE, rows), f"given{i}")
    return warehouse


def asked(spark, keys):
    return spark.createDataFrame([(k,) for k in keys], "id bigint")


def held(warehouse, rows):
    return sorted(r["id"] for r in warehouse.present_keys(TABLE, rows).collect())


def random_folders(folders, keys, seed=7):
    drawn = drawn_keys(folders * keys, seed)
    return [drawn[i::folders] for i in range(folders)]


def drawn_keys(n, seed):
    draw = random.Random(seed)
    return [draw.randrange(-(1 << 62), 1 << 62) for _ in range(n)]


@pytest.mark.parametrize("keys", [0, 1, 5, 6, 1000, PER_SLICE, PER_SLICE + 1, 10**12])
def test_layout_grows_with_the_keys(keys):
    slices, words = layout(keys)
    assert slices & (slices - 1) == 0 and words & (words - 1) == 0
    assert keys <= slices * PER_SLICE < 2 * max(keys, PER_SLICE)
    assert keys * BITS_PER_KEY <= 64 * slices * words <= 4 * max(keys * BITS_PER_KEY, 64)


def test_filters_let_all_held_keys_pass_and_few_others(spark):
    n = 20_000
    slices, words = layout(n, 3_000)
    assert slices == 8
    stored = spark.range(n).select(
        F.lit("a").alias("part"), F.col("id").alias("key"), F.lit(slices).alias("slices"), F.lit(words).alias("words")
    )
    filters = filter_words(stored)
    assert filters.select("slice").distinct().count() == slices and filters.count() <= slices * words
    inside = may_hold(filters, stored.select("key"), [(slices, words)])
    assert inside.select("key").distinct().count() == n
    outside = spark.range(n, 2 * n).select(F.col("id").alias("key"))
    assert may_hold(filters, outside, [(slices, words)]).count() < 0.01 * n


def test_present_keys_agree_with_a_plain_lookup(spark, root):
    folders = random_folders(4, 50) + [[], [0, -1, (1 << 63) - 1, -(1 << 63)]]
    warehouse = warehouse_of(spark, root, folders[:3])
    some = [folders[i][j] for i in range(4) for j in range(0, 50, 7)] + [0, 1, 2, -1, (1 << 63) - 1, -(1 << 63), None, None, 1]

    def check():
        rows = asked(spark, some)
        plain = sorted(r["id"] for r in present_keys(warehouse.read(TABLE), rows, "id").collect())
        assert held(warehouse, rows) == plain

    check()
    assert warehouse.keep_keys(TABLE, per_slice=8) == 3 and warehouse.keep_keys(TABLE) == 0
    check()
    for i in (3, 4, 5):  # one of them holds no rows
        rows = spark.createDataFrame([(k, "x") for k in folders[i]], warehouse.read(TABLE).schema)
        warehouse.publish(TABLE, warehouse.stage(TABLE, rows), f"later{i}")
    check()  # half of the folders are indexed
    assert warehouse.keep_keys(TABLE, per_slice=1) == 3
    check()
    assert held(warehouse, asked(spark, [None])) == held(warehouse, asked(spark, [])) == []
    assert held(warehouse, asked(spark, [5])) == []


def test_a_table_without_rows_can_be_indexed(spark, root):
    warehouse = warehouse_of(spark, root, [])
    assert warehouse.keep_keys(TABLE) == 0 and held(warehouse, asked(spark, [1])) == []
    warehouse.publish(TABLE, warehouse.stage(TABLE, warehouse.read(TABLE)), "nothing")
    assert warehouse.keep_keys(TABLE) == 1 and held(warehouse, asked(spark, [1])) == []


def key_files(frame):
    return [f for f in frame.inputFiles() if "/keys=" in f]


def test_random_keys_read_few_key_files(spark, root):
    """Keys drawn over the whole range: no range of a file or folder leaves any out."""
    folders = random_folders(4, 2_000)
    warehouse = warehouse_of(spark, root, folders)
    warehouse.keep_keys(TABLE, per_slice=32)
    home, (run, *_) = warehouse.home(TABLE), next(iter(warehouse.state(TABLE).indexed.values()))
    stored = len(spark.read.parquet(f"{home}/keys={run}").inputFiles())
    assert stored == 4 * 64
    absent = drawn_keys(60, 99)
    found = warehouse.present_keys(TABLE, asked(spark, [*absent, *folders[2][:3]]))
    read = key_files(found)
    assert sorted(r["id"] for r in found.collect()) == sorted(folders[2][:3])
    assert 1 <= len(read) < 0.05 * stored
    assert not [f for f in found.inputFiles() if "/batch=" in f]  # no row of the table itself is read


def test_folders_whose_range_is_missed_are_not_asked(spark, root):
    warehouse = warehouse_of(spark, root, [range(100), range(1_000, 1_100), range(5_000, 5_100)])
    warehouse.keep_keys(TABLE, per_slice=8)
    found = warehouse.present_keys(TABLE, asked(spark, [1_001, 1_050, 2_000]))
    folder = warehouse.state(TABLE).batches["given1"]
    assert {f.split("/part=")[1].split("/")[0].replace("%7E", "~") for f in key_files(found)} == {folder}
    assert sorted(r["id"] for r in found.collect()) == [1_001, 1_050]


def test_a_load_skips_stored_keys_by_their_filters(spark, root, tmp_path):
    folders = random_folders(3, 30)
    warehouse = warehouse_of(spark, root, folders)
    warehouse.keep_keys(TABLE, per_slice=4)
    lines = [f"{k},again" for k in folders[1]] + ["1,new", "1,newer", "x,broken"]
    report = load_history(warehouse, {TABLE: history_file(tmp_path, "d.csv", lines)})
    assert report.stored(TABLE) == 1
    reasons = {r["reason_code"]: r["rows"] for r in report.counts}
    assert reasons.pop(None) == 1 and reasons.pop("DUPLICATE_KEY") == 31 and list(reasons.values()) == [1]
    assert warehouse.read(TABLE).count() == 91


def test_indexes_follow_joins_rewrites_and_restores(spark, root):
    folders = random_folders(4, 20)
    warehouse = warehouse_of(spark, root, folders)
    every = asked(spark, sum(folders, []))
    warehouse.keep_keys(TABLE)
    path = backup(warehouse, TABLE, f"{root}/backups")
    old = warehouse.state(TABLE).indexed
    warehouse.join_small(TABLE, 4)
    assert held(warehouse, every) == sorted(sum(folders, []))  # the joined folder has no index yet
    assert warehouse.keep_keys(TABLE) == 1
    assert held(warehouse, every) == sorted(sum(folders, []))
    rows = spark.createDataFrame([(1, "late")], warehouse.read(TABLE).schema)
    warehouse.publish(TABLE, warehouse.stage(TABLE, rows), "late")
    warehouse.compact(TABLE)
    assert not set(old) & set(warehouse.state(TABLE).indexed)
    home, (run, *_) = warehouse.home(TABLE), next(iter(old.values()))
    for kind in ("keys", "filters"):  # those of the folders that were joined are gone with them
        assert not [n for n in warehouse.files.names(f"{home}/{kind}={run}") if n.startswith("part=")]
    warehouse.keep_keys(TABLE)
    assert held(warehouse, asked(spark, [1, 2])) == [1]
    restore(warehouse, TABLE, path)
    assert held(warehouse, asked(spark, [1, folders[0][0]])) == [folders[0][0]]
    warehouse.keep_keys(TABLE)
    assert held(warehouse, asked(spark, [1, folders[0][0]])) == [folders[0][0]]


def test_an_index_of_a_folder_that_left_meanwhile_is_not_kept(spark, root):
    warehouse = warehouse_of(spark, root, random_folders(2, 10))
    change, calls = warehouse.commits.change, []

    def after_a_rewrite(edit):
        if not calls:
            calls.append(1)
            Warehouse(spark, root, WIDE).compact(TABLE)
        return change(edit)

    warehouse.commits.change = after_a_rewrite
    assert warehouse.keep_keys(TABLE) == 0
    state = warehouse.state(TABLE)
    assert not state.indexed
    names = warehouse.files.names(warehouse.home(TABLE))
    for kept in (n for n in names if n.startswith(("keys=", "filters="))):
        assert not [n for n in warehouse.files.names(f"{warehouse.home(TABLE)}/{kept}") if n.startswith("part=")]


def test_a_record_without_indexes_is_read(spark, root):
    warehouse = warehouse_of(spark, root, [[1, 2]])
    version, _ = warehouse.commits.latest()
    path = warehouse.commits._path(version)
    text = warehouse.files.read_text(path).replace(', "indexed": {}', "")
    assert "indexed" not in text
    warehouse.files.delete(path)
    assert warehouse.files.create_new(path, text)
    assert held(warehouse, asked(spark, [2, 3])) == [2] and warehouse.keep_keys(TABLE) == 1
