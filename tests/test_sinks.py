"""Stored tables: replacing, replaying, layout, catalog."""

import glob
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from orderlake import schemas
from orderlake.lake import sized_conf
from orderlake.plans.silver import reconciliation, refresh, refresh_reports, silver_current
from orderlake.sinks import tables
from orderlake.sinks.tables import (
    append_bronze,
    create_tables,
    overwrite_silver,
    publish_tables,
)
from orderlake.sources.tables import (
    between_dates,
    read_bronze,
    read_ledger,
    read_quarantine,
    read_silver,
    read_table,
)
from test_silver import START, random_bronze


@pytest.fixture(scope="module")
def bronze(spark):
    return spark.createDataFrame(random_bronze(800), schemas.BRONZE_SCHEMA).repartition(3)


def same(left, right):
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def test_tables_never_written_are_empty(spark, lake):
    for frame, schema in [
        (read_bronze(spark, lake), schemas.BRONZE_SCHEMA),
        (read_silver(spark, lake), schemas.SILVER_SCHEMA),
        (read_quarantine(spark, lake), schemas.QUARANTINE_SCHEMA),
        (read_ledger(spark, lake), schemas.LEDGER_SCHEMA),
    ]:
        assert frame.schema.names == schema.names and frame.isEmpty()


def test_a_failed_read_is_an_error(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "x.parquet").write_text("no parquet")
    with pytest.raises(Exception):
        read_table(spark, str(tmp_path / "t"), schemas.BRONZE_SCHEMA).collect()
    with pytest.raises(Exception, match="nosuchscheme"):
        read_table(spark, "nosuchscheme://x/y", schemas.BRONZE_SCHEMA).collect()


def test_replayed_batch_replaces_itself_only(spark, lake, bronze):
    append_bronze(bronze, lake, "one")
    append_bronze(bronze, lake, "two")
    append_bronze(bronze, lake, "one")
    assert same(read_bronze(spark, lake), bronze.unionByName(bronze))
    assert same(read_bronze(spark, lake, ingest_batch="two"), bronze)


def test_rows_without_order_lie_apart(spark, lake, bronze):
    append_bronze(bronze, lake, "one")
    keyed = read_bronze(spark, lake, keyed=True)
    plan = keyed._jdf.queryExecution().executedPlan().toString()
    assert "keyed" in plan.split("PartitionFilters: [")[1].split("]")[0]
    without = read_bronze(spark, lake, keyed=False)
    assert without.filter("order_id IS NOT NULL AND trim(order_id) != ''").isEmpty()
    assert same(keyed.unionByName(without), bronze)


@pytest.mark.parametrize("session_mode", ["static", "dynamic"])
def test_overwrite_leaves_nothing_of_the_old_table(spark, lake, bronze, session_mode):
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", session_mode)
    try:
        silver = silver_current(bronze, F.lit(START))
        overwrite_silver(silver, lake)
        assert same(read_silver(spark, lake), silver)
        overwrite_silver(silver.filter("order_year = 2020"), lake)
        assert same(read_silver(spark, lake), silver.filter("order_year = 2020"))
        overwrite_silver(silver.limit(0), lake)
        assert read_silver(spark, lake).isEmpty()
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)


def test_layout_and_codec(spark, lake, bronze):
    overwrite_silver(silver_current(bronze), lake)
    folders = {path.rsplit("/", 1)[1] for path in glob.glob(f"{lake.silver}/*=*")}
    assert folders == {"order_year=2019", "order_year=2020", "order_year=__HIVE_DEFAULT_PARTITION__"}
    files = glob.glob(f"{lake.silver}/*/*/*.parquet")
    # Rebalanced: one file per folder for so few rows, not one per task.
    assert len(files) == 3
    assert {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files} == {"SNAPPY"}
    frame = read_silver(spark, lake)
    assert frame.schema.names == schemas.SILVER_SCHEMA.names
    assert [f.dataType for f in frame.schema] == [f.dataType for f in schemas.SILVER_SCHEMA]


def test_date_slice_prunes_year_folders(spark, lake, bronze):
    silver = silver_current(bronze, F.lit(START))
    overwrite_silver(silver, lake)
    found = between_dates(read_silver(spark, lake), "2019-12-31", "2019-12-31")
    assert same(found, silver.filter("order_date = date'2019-12-31'")) and not found.isEmpty()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "order_year" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "order_date" in plan.split("PushedFilters: [")[1].split("]")[0]


def test_refresh_twice_gives_the_same_tables(spark, lake, bronze):
    append_bronze(bronze, lake, "one")
    report = refresh(spark, lake, "first", F.lit(START))
    assert reconciliation(spark, lake, report).first().is_sound
    assert same(read_silver(spark, lake), silver_current(bronze, F.lit(START)))
    kept = [tuple(row) for row in read_silver(spark, lake).collect()]
    again = refresh(spark, lake, "second", F.lit(START))
    assert sorted(map(repr, kept)) == sorted(repr(tuple(r)) for r in read_silver(spark, lake).collect())
    assert report.drop("silver_run_id").first() == again.drop("silver_run_id").first()


def test_refresh_of_an_empty_lake(spark, lake):
    row = refresh(spark, lake, "empty").first()
    assert row.raw_count == row.silver_count == row.quarantine_count == 0


def test_sql_tables(spark, lake, bronze):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS sinks_test LOCATION '{lake.root}/db'")
    create_tables(spark, lake, "sinks_test")
    create_tables(spark, lake, "sinks_test")
    assert spark.sql("SELECT * FROM sinks_test.sales_silver").isEmpty()
    append_bronze(bronze, lake, "one")
    for run in ("a", "b"):
        refresh(spark, lake, run)
        publish_tables(spark, "sinks_test")
        for name, frame in [
            ("sales_bronze", bronze), ("sales_silver", read_silver(spark, lake)),
            ("sales_quarantine", read_quarantine(spark, lake)),
        ]:
            assert spark.table(f"sinks_test.{name}").count() == frame.count() > 0
    duplicates = spark.sql(
        "SELECT order_id, COUNT(*) FROM sinks_test.sales_silver GROUP BY order_id HAVING COUNT(*) > 1"
    )
    assert duplicates.isEmpty()


def test_shuffle_partitions_follow_the_size_of_bronze():
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert [sized_conf(size)[name] for size in (0, 10**12, 10**14)] == ["200", "3726", "100000"]


def test_a_failed_overwrite_leaves_the_old_table(spark, lake):
    from pyspark.errors import PythonException

    path = f"{lake.root}/t"
    tables.overwrite(spark.range(3), path, ["id"])

    def crash(batches):
        yield next(iter(batches))
        raise RuntimeError("lost")

    with pytest.raises(PythonException, match="lost"):
        tables.overwrite(spark.range(9).mapInArrow(crash, "id LONG"), path, ["id"])
    assert spark.read.parquet(path).count() == 3
    tables.overwrite(spark.range(5), path, ["id"])
    assert spark.read.parquet(path).count() == 5 and os.listdir(lake.root) == ["t"]


def test_a_crash_between_the_renames_is_put_right(spark, lake):
    path = f"{lake.root}/t"
    tables.overwrite(spark.range(3), path, ["id"])
    os.rename(path, f"{lake.root}/_old_t")
    tables.restore(spark, path)
    assert spark.read.parquet(path).count() == 3
    os.rename(path, f"{lake.root}/_old_t")
    tables.overwrite(spark.range(4), path, ["id"])
    assert spark.read.parquet(path).count() == 4


def test_older_reports_stay_sound(spark, lake, bronze):
    for number, run_id in enumerate(("first", "second")):
        append_bronze(bronze.limit(400 + number), lake, run_id)
        refresh(spark, lake, run_id)
    rows = reconciliation(spark, lake, refresh_reports(spark, lake)).collect()
    assert [row.is_sound for row in rows] == [True, True]
    some = spark.createDataFrame(read_silver(spark, lake).limit(1).collect(), schemas.SILVER_SCHEMA)
    overwrite_silver(some.withColumn("order_year", F.lit(2020)), lake)
    rows = reconciliation(spark, lake, refresh_reports(spark, lake)).collect()
    assert sorted((row.silver_run_id, row.is_sound) for row in rows) == [("first", True), ("second", False)]


def test_bronze_is_written_without_a_shuffle_in_files_of_bounded_rows(spark, lake, bronze, monkeypatch):
    monkeypatch.setattr(tables, "ROWS_OF_A_FILE", 50)
    seen = []
    original = tables._take_place
    monkeypatch.setattr(tables, "_take_place", lambda *args: seen.append(glob.glob(f"{args[1]}/*/*.parquet")) or original(*args))
    append_bronze(bronze, lake, "one")
    assert same(read_bronze(spark, lake), bronze)
    sizes = [pq.ParquetFile(path).metadata.num_rows for path in glob.glob(f"{lake.bronze}/*/*/*.parquet")]
    assert max(sizes) <= 50 and len(sizes) == len(seen[0]) >= 800 / 50
    overwrite_silver(silver_current(bronze, F.lit(START)), lake)
    assert len(glob.glob(f"{lake.silver}/*/*/*.parquet")) == 3


def test_a_batch_that_is_being_written_is_not_read(spark, lake, bronze, monkeypatch):
    append_bronze(bronze, lake, "one")
    seen = []
    original = tables._take_place
    monkeypatch.setattr(tables, "_take_place", lambda *args: seen.append(read_bronze(spark, lake).count()) or original(*args))
    append_bronze(bronze, lake, "two")
    append_bronze(bronze, lake, "two")
    assert seen == [800, 1600] and read_bronze(spark, lake).count() == 1600
    os.rename(f"{lake.bronze}/ingest_batch=two", tables.aside(f"{lake.bronze}/ingest_batch=two")[1])
    assert read_bronze(spark, lake).count() == 800
    tables.restore(spark, f"{lake.bronze}/ingest_batch=two")
    assert read_bronze(spark, lake).count() == 1600
