"""Refreshes by what is new, and snapshots that change silver and quarantine at once."""

import glob
import os
import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from orderlake import lake as lakes, snapshots
from orderlake.lake import sized_session
from orderlake.operators.latest import latest_per_order
from orderlake.operators.split import quarantine
from orderlake.plans import silver as plan
from orderlake.plans.silver import reconciliation, refresh, refresh_reports, silver_current
from orderlake.schemas import BRONZE_SCHEMA, DATA_COLUMNS
from orderlake.sinks.tables import append_bronze, create_tables, publish_tables, remove_bronze
from orderlake.sources.tables import read_bronze, read_layers, read_quarantine, read_silver
from test_silver import START


def batch(spark, seed, count=300, **fixed):
    """Rows with few times and files, so that orders tie within and over batches."""
    rng = random.Random(seed)
    rows = []
    for _ in range(count):
        row = {name: rng.choice([None, "", "a", "b"]) for name in DATA_COLUMNS}
        row["order_id"] = "hot" if rng.random() < 0.2 else rng.choice([None, "  ", "\t", str(rng.randint(1, 150))])
        row["region"] = rng.choice([None, " ", " Asia "])
        row["order_date"] = rng.choice([None, "1/2/2020", "12/31/2019", "2/30/2020", "5/6/2021", "7/8/2022"])
        row["_ingested_at"] = START + timedelta(days=rng.randint(0, 2))
        row["_source_file"] = rng.choice(["landing/a.zip", "landing/b.zip"])
        row["_checksum_sha256"] = "c"
        row |= fixed
        rows.append(tuple(row[name] for name in BRONZE_SCHEMA.names))
    return spark.createDataFrame(rows, BRONZE_SCHEMA)


def rows_of(frame):
    return sorted(map(repr, (tuple(row) for row in frame.collect())))


def check(spark, lake, report, moment=START):
    """Both tables and the report are what all of bronze gives."""
    bronze = read_bronze(spark, lake)
    assert rows_of(read_silver(spark, lake)) == rows_of(silver_current(bronze, F.lit(moment)))
    assert rows_of(read_quarantine(spark, lake)) == rows_of(quarantine(bronze, F.lit(moment)))
    (row,) = reconciliation(spark, lake, report).collect()
    assert row.is_sound and row.raw_count == bronze.count()


def files(lake):
    found = glob.glob(f"{lake.silver}/**/*.parquet", recursive=True)
    return {os.path.relpath(path, lake.silver) for path in found}


def used_files(spark, lake):
    return {path.split("/silver/")[1] for path in read_silver(spark, lake).inputFiles()}


def test_refreshes_by_batches_equal_one_of_all(spark, lake):
    for number in range(5):
        append_bronze(batch(spark, number), lake, f"b{number}")
        check(spark, lake, refresh(spark, lake, f"r{number}", F.lit(START)))
    now = snapshots.current_snapshot(spark, lake)
    assert (now.number, now.base) == (5, 1)
    assert read_silver(spark, lake).filter("order_year IS NULL").count() > 0
    # Nothing new: the same tables, a report of its own.
    check(spark, lake, refresh(spark, lake, "again", F.lit(START)))
    assert snapshots.current_snapshot(spark, lake) == now
    check(spark, lake, refresh(spark, lake, "all", F.lit(START), rebuild=True))
    assert snapshots.current_snapshot(spark, lake).base == 6
    assert refresh_reports(spark, lake).count() == 7


def test_only_touched_years_are_written(spark, lake):
    append_bronze(batch(spark, 1, 400), lake, "b1")
    refresh(spark, lake, "r1", F.lit(START))
    before = used_files(spark, lake)
    year = lambda paths, y: {p for p in paths if p.startswith(f"order_year={y}/")}
    # One order moves from 2021 to 2022; rows that are older than the stored ones change nothing.
    moved = read_silver(spark, lake).filter("order_year = 2021").first().order_id
    later = batch(spark, 2, 1, order_id=moved, order_date="7/8/2022", _ingested_at=START + timedelta(days=9))
    older = batch(spark, 3, 50, order_id="hot", order_date="1/2/2019", _ingested_at=START - timedelta(days=9))
    append_bronze(later.union(older), lake, "b2")
    check(spark, lake, refresh(spark, lake, "r2", F.lit(START)))
    after = used_files(spark, lake)
    for y in (2019, 2020, "__HIVE_DEFAULT_PARTITION__"):
        assert year(before, y) == year(after, y) != set()
    for y in (2021, 2022):
        assert not year(before, y) & year(after, y)
    # A batch of rows without order key touches no year at all.
    append_bronze(batch(spark, 4, 20, order_id=None), lake, "b3")
    check(spark, lake, refresh(spark, lake, "r3", F.lit(START)))
    assert used_files(spark, lake) == after


def test_a_year_whose_last_order_moves_away_is_gone(spark, lake):
    append_bronze(batch(spark, 1, 1, order_id="1", order_date="5/6/2021"), lake, "b1")
    refresh(spark, lake, "r1", F.lit(START))
    moved = batch(spark, 2, 1, order_id="1", order_date="x", _ingested_at=START + timedelta(days=9))
    append_bronze(moved, lake, "b2")
    check(spark, lake, refresh(spark, lake, "r2", F.lit(START)))
    assert set(snapshots.current_snapshot(spark, lake).years) == {snapshots.NULL_YEAR}


@pytest.mark.parametrize("most", [0, 1000])
def test_ties_are_decided_without_the_new_batch_read_again(spark, lake, monkeypatch, most):
    monkeypatch.setattr(plan, "MOST_SENT", most)
    append_bronze(batch(spark, 1), lake, "b1")
    refresh(spark, lake, "r1", F.lit(START))
    seen = []
    monkeypatch.setattr(plan, "latest_per_order", lambda rows: seen.append(rows.count()) or latest_per_order(rows))
    append_bronze(batch(spark, 2), lake, "b2")
    check(spark, lake, refresh(spark, lake, "r2", F.lit(START)))
    # The second call is that for the ties: rows of the first batch, and one new row of each order.
    old = read_bronze(spark, lake, keyed=True, ingest_batch="b1").count()
    new = read_bronze(spark, lake, keyed=True, ingest_batch="b2").select("order_id").distinct().count()
    assert len(seen) >= 2 and seen[1] <= old + new


def test_orders_that_tie_over_batches_are_decided_by_their_raw_columns(spark, lake):
    for number, country in enumerate(("b", "c", "a")):
        same = {"order_id": "1", "_ingested_at": START, "_source_file": "landing/a.zip", "country": country}
        append_bronze(batch(spark, 5, 1, **same, order_date="5/6/2021"), lake, f"b{number}")
        check(spark, lake, refresh(spark, lake, f"r{number}", F.lit(START)))
    assert [row.country for row in read_silver(spark, lake).collect()] == ["c"]


STEPS = [
    (plan, "quarantine"), (plan, "changed_orders"), (plan, "_touched_years"), (snapshots, "write_years"),
    (snapshots, "write_piece"), (snapshots, "write_batches"), (snapshots, "write_new_text"), (plan, "write_batch_rows"),
    (snapshots, "expire"),
]


KILLS = [(*step, False) for step in STEPS] + [(snapshots, "write_years", True), (snapshots, "write_new_text", True)]


@pytest.mark.parametrize("module, step, after", KILLS, ids=[f"{step}{'-done' * after}" for _, step, after in KILLS])
def test_a_refresh_killed_at_any_step(spark, lake, monkeypatch, module, step, after):
    append_bronze(batch(spark, 1), lake, "b1")
    refresh(spark, lake, "r1", F.lit(START))
    old = [rows_of(frame) for frame in read_layers(spark, lake)]
    append_bronze(batch(spark, 2), lake, "b2")
    new = [
        rows_of(silver_current(read_bronze(spark, lake), F.lit(START))),
        rows_of(quarantine(read_bronze(spark, lake), F.lit(START))),
    ]
    original = getattr(module, step)

    def crash(*args, **kwargs):
        if after:
            original(*args, **kwargs)
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(module, step, crash)
        with pytest.raises(RuntimeError, match="lost"):
            refresh(spark, lake, "r2", F.lit(START))
    assert [rows_of(frame) for frame in read_layers(spark, lake)] in (old, new)
    check(spark, lake, refresh(spark, lake, "r2", F.lit(START)))
    assert [rows_of(frame) for frame in read_layers(spark, lake)] == new
    # What the killed attempt left goes with the old snapshots.
    snapshots.expire(spark, lake, keep=1)
    assert files(lake) == used_files(spark, lake) and not os.path.exists(lake.changes)


def test_a_reader_goes_on_with_its_snapshot(spark, lake):
    append_bronze(batch(spark, 1), lake, "b1")
    refresh(spark, lake, "r1", F.lit(START))
    silver, lost = read_layers(spark, lake)
    before = rows_of(silver), rows_of(lost)
    append_bronze(batch(spark, 2), lake, "b2")
    refresh(spark, lake, "r2", F.lit(START), rebuild=True)
    assert (rows_of(silver), rows_of(lost)) == before
    assert rows_of(read_silver(spark, lake)) != before[0]


def test_a_lost_folder_is_an_error(spark, lake):
    import shutil

    assert read_silver(spark, lake).isEmpty() and read_quarantine(spark, lake).isEmpty()
    for name in ("b1", "b2"):
        append_bronze(batch(spark, 1), lake, name)
    refresh(spark, lake, "r1")
    shutil.rmtree(f"{lake.bronze}/ingest_batch=b1")
    with pytest.raises(FileNotFoundError, match="b1"):
        refresh(spark, lake, "r2")
    shutil.rmtree(lake.quarantine)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_quarantine(spark, lake).collect()
    shutil.rmtree(glob.glob(f"{lake.silver}/order_year=2020")[0])
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_silver(spark, lake).collect()


def test_replaced_and_removed_batches_are_computed_anew(spark, lake):
    for number in range(3):
        append_bronze(batch(spark, number), lake, f"b{number}")
    refresh(spark, lake, "r1", F.lit(START))
    append_bronze(batch(spark, 9), lake, "b1")
    assert snapshots.current_snapshot(spark, lake).stale
    check(spark, lake, refresh(spark, lake, "r2", F.lit(START)))
    assert not snapshots.current_snapshot(spark, lake).stale
    remove_bronze(spark, lake, "b2")
    check(spark, lake, refresh(spark, lake, "r3", F.lit(START)))


def test_two_writers_do_not_take_one_number(spark, lake):
    snapshots.commit(spark, lake, snapshots.Snapshot(1))
    with pytest.raises(FileExistsError):
        snapshots.commit(spark, lake, snapshots.Snapshot(1, pieces=["x"]))
    assert snapshots.current_snapshot(spark, lake) == snapshots.Snapshot(1)


def test_expiry_leaves_what_a_kept_snapshot_names(spark, lake, monkeypatch):
    monkeypatch.setattr(snapshots.expire, "__defaults__", (2,))
    monkeypatch.setattr(snapshots, "MOST_PIECES", 3)
    for number in range(6):
        append_bronze(batch(spark, number, 40), lake, f"b{number}")
        check(spark, lake, refresh(spark, lake, f"r{number}", F.lit(START)))
        assert len(snapshots.numbers(spark, lake)) <= 2
        assert len(snapshots.current_snapshot(spark, lake).pieces) <= 3
    found = snapshots.numbers(spark, lake)
    named = {
        f"order_year={year}/version={version}"
        for number in found
        for year, version in snapshots.read_snapshot(spark, lake, number).years.items()
    }
    assert {path.rsplit("/", 1)[0] for path in files(lake)} == named


def exchanges(frame):
    text = frame._jdf.queryExecution().executedPlan().toString()
    return {part.split("),")[0].split(", ")[-1].split(")")[0] for part in text.split("Exchange hashpartitioning(")[1:]}


def test_shuffles_are_cut_by_size_in_a_session_of_their_own(spark, lake, monkeypatch):
    append_bronze(batch(spark, 1), lake, "b1")
    before = spark.conf.getAll
    seen = {}
    for size in (10**6, 10**12):
        session = sized_session(spark, size)
        assert session.conf.get("spark.sql.session.timeZone") == spark.conf.get("spark.sql.session.timeZone")
        seen[size] = exchanges(silver_current(read_bronze(session, lake, keyed=True)))
    assert seen == {10**6: {spark.conf.get("spark.sql.shuffle.partitions")}, 10**12: {"3726"}}
    sizes = []
    original = plan.sized_session
    monkeypatch.setattr(plan, "sized_session", lambda spark, size: sizes.append(size) or original(spark, size))
    refresh(spark, lake, "r1")
    append_bronze(batch(spark, 2, 1), lake, "b2")
    refresh(spark, lake, "r2")
    assert 0 < sizes[0] and sizes[1] > 0 and spark.conf.getAll == before
    assert lakes.shuffle_partitions(10**15) == 100_000


def test_catalog_is_told_of_what_changed(spark, lake, monkeypatch):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS snapshots_test LOCATION '{lake.root}/db'")
    create_tables(spark, lake, "snapshots_test")
    publish_tables(spark, "snapshots_test")

    def agree():
        for name, frame in (("silver", read_silver(spark, lake)), ("quarantine", read_quarantine(spark, lake)), ("bronze", read_bronze(spark, lake))):
            table = spark.table(f"snapshots_test.sales_{name}").select(*frame.columns)
            assert rows_of(table) == rows_of(frame)

    told = []
    original = type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **k: told.append(text) or original(self, text, *a, **k))
    append_bronze(batch(spark, 0, order_date="1/2/2020"), lake, "b0")
    refresh(spark, lake, "r0")
    publish_tables(spark, "snapshots_test")
    agree()
    for number in range(1, 5):
        append_bronze(batch(spark, number, 30, order_date=f"1/2/{2020 + number}"), lake, f"b{number}")
        refresh(spark, lake, f"r{number}")
        told.clear()
        publish_tables(spark, "snapshots_test")
        publish_tables(spark, "snapshots_test")
        agree()
        assert not any("MSCK" in text or "SHOW PARTITIONS" in text for text in told)
        assert sum("b0" in text for text in told) == 0
    # The snapshot published last is gone: the catalog itself says what it has.
    for number in range(5, 8):
        append_bronze(batch(spark, number, 30), lake, f"b{number}")
        refresh(spark, lake, f"r{number}", rebuild=number == 6)
    snapshots.expire(spark, lake, keep=1)
    publish_tables(spark, "snapshots_test")
    agree()
