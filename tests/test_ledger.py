"""Decisions and state of the ledger, against brute force."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from orderlake.operators import ledger as L
from orderlake.schemas import LEDGER_ATTRIBUTES, LEDGER_SCHEMA

START = datetime(2026, 1, 1)
FILES = "path STRING, landing_key STRING, landed_at TIMESTAMP, size_bytes BIGINT, checksum_sha256 STRING"


def make_files(spark, items):
    rows = [(p, p, START + timedelta(seconds=s), 1, c) for p, s, c in items]
    return spark.createDataFrame(rows, FILES)


def make_state(spark, statuses):
    return spark.createDataFrame(list(statuses.items()), "checksum_sha256 STRING, status STRING")


@pytest.mark.parametrize(
    "status, admission, action",
    [
        (None, "uploaded", "PROCESS"),
        ("uploaded", "skipped_duplicate", "PROCESS"),
        ("processing", "skipped_duplicate", "PROCESS"),
        ("bronze_loaded", "skipped_duplicate", "RECOVERED"),
        ("completed", "skipped_duplicate", "SKIPPED"),
        ("something else", "uploaded", "PROCESS"),
    ],
)
def test_decisions_by_status(spark, status, admission, action):
    files = make_files(spark, [("a", 0, "c1")])
    state = make_state(spark, {"c1": status, "other": "completed"})
    assert L.admit(files, state).first().decision == admission
    assert L.plan_ingest(files, state).first().action == action
    assert L.accepted(files, state).count() == (admission == "uploaded")


def test_copies_in_one_batch(spark):
    files = make_files(
        spark, [("b", 5, "c1"), ("a", 9, "c1"), ("z", 5, "c1"), ("same name", 1, "c2"), ("same name", 2, "c3")]
    )
    state = make_state(spark, {"c3": "bronze_loaded"})
    found = {(r.path, r.checksum_sha256): r.action for r in L.plan_ingest(files, state).collect()}
    assert found == {
        ("b", "c1"): "PROCESS", ("a", "c1"): "SKIPPED", ("z", "c1"): "SKIPPED",
        ("same name", "c2"): "PROCESS", ("same name", "c3"): "RECOVERED",
    }
    first = {(r.path, r.checksum_sha256) for r in L.mark_first_copies(files).collect() if r.is_first_copy}
    assert first == {("b", "c1"), ("same name", "c2"), ("same name", "c3")}


def test_a_content_with_very_many_copies(spark):
    copies = spark.range(50_000).select(
        F.concat(F.lit("f"), "id").alias("path"), F.concat(F.lit("f"), "id").alias("landing_key"),
        F.lit(START).alias("landed_at"), F.lit(1).alias("size_bytes"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("checksum_sha256"),
    )
    counts = L.plan_ingest(copies, make_state(spark, {})).groupBy("action").count().collect()
    hot = (50_000 + 2) // 3
    assert {r.action: r["count"] for r in counts} == {"PROCESS": 50_000 - hot + 1, "SKIPPED": hot - 1}
    plan = L.first_copies(copies)._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Window" not in plan


def events_frame(spark, rows):
    full = [tuple(row.get(name) for name in LEDGER_SCHEMA.names) for row in rows]
    return spark.createDataFrame(full, LEDGER_SCHEMA)


def test_state_merges_and_put_clears(spark):
    c = {"checksum_sha256": "c"}
    steps = [
        c | {"seq": 1, "op": "put", "status": "uploaded", "landing_key": "k", "size_bytes": 5},
        c | {"seq": 2, "op": "set", "status": "processing", "landing_key": "k2"},
        c | {"seq": 3, "op": "set", "status": "completed", "archive_key": "a"},
    ]
    row = L.current_state(events_frame(spark, steps)).first()
    assert (row.status, row.landing_key, row.archive_key, row.size_bytes) == ("completed", "k2", "a", 5)
    again = steps + [c | {"seq": 4, "op": "put", "status": "uploaded", "landing_key": "n"}]
    row = L.current_state(events_frame(spark, again)).first()
    assert (row.status, row.landing_key, row.archive_key, row.size_bytes) == ("uploaded", "n", None, None)


def test_state_against_brute_force(spark):
    rng = random.Random(3)
    rows = []
    for seq in range(3000):
        row = {"seq": seq, "op": "put" if rng.random() < 0.1 else "set"}
        row["checksum_sha256"] = "hot" if rng.random() < 0.4 else f"c{rng.randint(0, 80)}"
        for field in LEDGER_ATTRIBUTES.fields:
            if rng.random() < 0.3:
                number = rng.randint(0, 99)
                row[field.name] = number if field.dataType.simpleString() == "bigint" else f"v{number}"
        rows.append(row)
    items = {}
    for row in rows:
        item = {} if row["op"] == "put" else items.setdefault(row["checksum_sha256"], {})
        item |= {name: row[name] for name in LEDGER_ATTRIBUTES.names if row.get(name) is not None}
        items[row["checksum_sha256"]] = item
    found = L.current_state(events_frame(spark, rows).repartition(7)).collect()
    assert len(found) == len(items)
    for row in found:
        item = items[row.checksum_sha256]
        assert {name: row[name] for name in LEDGER_ATTRIBUTES.names if row[name] is not None} == item


def test_transitions(spark):
    files = make_files(spark, [("landing/a.zip", 0, "c1")]).withColumn("row_count", F.lit(7))
    steps = [
        L.register_uploads(files, F.lit(1), F.lit("t0")),
        L.mark_processing(files, F.lit(2), F.lit("t1")),
        L.mark_bronze_loaded(files, F.lit(3), F.lit("t2")),
        L.mark_completed(files, F.lit(4), F.lit("t3"), F.lit("archive/a"), F.lit("run")),
    ]
    events = steps[0]
    for index, status in enumerate(["uploaded", "processing", "bronze_loaded", "completed"]):
        events = steps[0] if index == 0 else events.unionByName(steps[index])
        assert L.current_state(events).first().status == status
    row = L.current_state(events).first().asDict()
    assert None not in row.values() and row["bronze_row_count"] == 7 and row["size_bytes"] == 1
    listing = L.ledger_listing(L.current_state(events))
    assert listing.first().asDict() == {
        "checksum": "c1", "status": "completed", "landing": "landing/a.zip", "archive": "archive/a", "rows": 7,
    }


def test_unknown_attribute_is_refused(spark):
    with pytest.raises(ValueError, match="not a ledger attribute"):
        L.ledger_events(make_files(spark, []), "set", F.lit(1), colour=F.lit("red"))
