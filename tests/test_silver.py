"""Split, latest row, typing, reports: against brute force on small and skewed inputs."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from orderlake.operators.checks import duplicate_orders, layer_counts
from orderlake.operators.latest import END, ORDERING, latest_per_order, packed_fields, unpacked_field
from orderlake.operators.metrics import load_metrics, refresh_metrics, refresh_report
from orderlake.operators.split import missing_order, quarantine, valid_order
from orderlake.operators.typed import flag_and_impute_region
from orderlake.plans.silver import silver_current
from orderlake.schemas import BRONZE_SCHEMA, DATA_COLUMNS, QUARANTINE_SCHEMA, SILVER_SCHEMA

START = datetime(2026, 1, 1)


def random_bronze(count=3000, hot_share=0.4, seed=1):
    rng = random.Random(seed)
    rows = []
    for _ in range(count):
        row = {name: rng.choice([None, "", "a", "b"]) for name in DATA_COLUMNS}
        row["order_id"] = "hot" if rng.random() < hot_share else rng.choice(
            [None, "", "  ", "\t", " 1", "1", str(rng.randint(1, 300))]
        )
        row["region"] = rng.choice([None, " ", "Asia", " Asia "])
        row["order_date"] = rng.choice([None, "1/2/2020", "12/31/2019", "2/30/2020", "x"])
        row["units_sold"] = rng.choice(["5", "12.7", "n/a", None])
        row["_ingested_at"] = START + timedelta(days=rng.randint(0, 3))
        row["_source_file"] = rng.choice(["landing/a.zip", "landing/b.zip"])
        row["_checksum_sha256"] = "c"
        rows.append(tuple(row[name] for name in BRONZE_SCHEMA.names))
    return rows


@pytest.fixture(scope="module")
def rows():
    return random_bronze()


@pytest.fixture(scope="module")
def bronze(spark, rows):
    return spark.createDataFrame(rows, BRONZE_SCHEMA).repartition(6)


def is_blank(text):
    return text is None or text.strip(" ") == ""


def position(name):
    return BRONZE_SCHEMA.names.index(name)


def test_split_is_lossless(bronze):
    both = missing_order(bronze).unionByName(valid_order(bronze))
    assert both.exceptAll(bronze).isEmpty() and bronze.exceptAll(both).isEmpty()


def test_quarantine(bronze, rows):
    frame = quarantine(bronze, F.lit(START))
    assert frame.schema.names == QUARANTINE_SCHEMA.names
    assert [f.dataType for f in frame.schema] == [f.dataType for f in QUARANTINE_SCHEMA]
    found = frame.collect()
    assert len(found) == sum(is_blank(row[position("order_id")]) for row in rows)
    assert {(r._quarantine_reason, r._quarantined_at) for r in found} == {("missing_order_id", START)}


def test_latest_row_of_each_order(bronze, rows):
    best = {}

    def rank(row):
        """Descending with NULL last is ascending with NULL first, the other way round."""
        return [(row[position(n)] is not None, row[position(n)] or "") for n in ORDERING[1:]]

    for row in rows:
        key = row[position("order_id")]
        if not is_blank(key):
            ranked = (row[position("_ingested_at")], rank(row))
            if key not in best or ranked > best[key][0]:
                best[key] = (ranked, row)
    found = [tuple(row) for row in latest_per_order(valid_order(bronze)).collect()]
    assert sorted(map(repr, found)) == sorted(repr(row) for _, row in best.values())
    assert {" 1", "1", "\t", "hot"} <= {row[position("order_id")] for row in found}


def test_latest_row_does_not_depend_on_the_distribution(bronze):
    one = latest_per_order(valid_order(bronze.coalesce(1)))
    many = latest_per_order(valid_order(bronze.repartition(13)))
    assert one.exceptAll(many).isEmpty() and many.exceptAll(one).isEmpty()


def test_a_hot_order_is_cut_down_before_the_shuffle(bronze):
    plan = latest_per_order(valid_order(bronze))._jdf.queryExecution().executedPlan().toString()
    window, exchange = plan.index("Window "), plan.index("Exchange hashpartitioning(order_id")
    assert plan.count("Exchange hashpartitioning") == 1 and window < exchange
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan[exchange:]


def test_silver_schema_and_flag(bronze):
    frame = silver_current(bronze, F.lit(START))
    assert frame.schema.names == SILVER_SCHEMA.names
    assert [f.dataType for f in frame.schema] == [f.dataType for f in SILVER_SCHEMA]
    wrong = frame.filter(
        ~((F.col("region") == "UNKNOWN") == F.col("region_is_synthetic"))
        | (F.col("region") != F.trim("region"))
        | ~F.col("order_year").eqNullSafe(F.year("order_date"))
    )
    assert wrong.isEmpty()
    assert frame.filter("order_year IS NULL").count() > 0


def test_flag_is_taken_before_the_imputation(spark):
    frame = spark.createDataFrame([(None,), (" ",), ("UNKNOWN",)], "region STRING")
    flags = [tuple(row) for row in flag_and_impute_region(frame).collect()]
    assert flags == [("UNKNOWN", True), ("UNKNOWN", True), ("UNKNOWN", False)]


def test_report_identity_and_the_three_region_counts(bronze, rows):
    silver = silver_current(bronze)
    report = refresh_report(refresh_metrics(bronze), silver).first()
    assert report.raw_count == len(rows) == (
        report.quarantine_count + report.duplicate_count + report.silver_count
    )
    assert report.clean_count == report.raw_count - report.quarantine_count
    blank_region = [is_blank(row[position("region")]) for row in rows]
    valid = [not is_blank(row[position("order_id")]) for row in rows]
    assert report.synthetic_region_count == sum(b and v for b, v in zip(blank_region, valid))
    loads = load_metrics(bronze).collect()
    assert sum(load.missing_region for load in loads) == sum(blank_region)
    assert silver.filter("region_is_synthetic").count() < report.synthetic_region_count
    assert sum(load.missing_order_id for load in loads) == report.quarantine_count


def test_empty_bronze(spark):
    empty = spark.createDataFrame([], BRONZE_SCHEMA)
    report = refresh_report(refresh_metrics(empty), silver_current(empty)).first()
    assert tuple(report) == (0, 0, 0, 0, 0, 0)
    counts = layer_counts(empty, silver_current(empty), quarantine(empty)).collect()
    assert {tuple(row) for row in counts} == {("bronze", 0), ("silver", 0), ("quarantine", 0)}


def test_silver_has_no_duplicate_orders(bronze):
    assert duplicate_orders(silver_current(bronze)).isEmpty()
    hot = duplicate_orders(bronze).filter("order_id = 'hot'").first()
    assert hot.duplicate_count > 1000


def test_packed_fields_sort_and_come_back_as_they_are(spark):
    texts = [None, "", " ", "a", "ab", "b", "é", "日", "\x00", "\x01", "\x02", "\x00a", "\x01\x01", "\x01\x02", "\x00\x01", "\x02\x00"]
    pairs = [(x, y) for x in texts for y in texts]
    frame = spark.createDataFrame(pairs, "x STRING, y STRING").withColumn("p", packed_fields(["x", "y"]))
    fields = F.split("p", END)
    found = frame.select("x", "y", unpacked_field(fields, 0).alias("u"), unpacked_field(fields, 1).alias("v"), "p").collect()
    assert all((row.x, row.y) == (row.u, row.v) for row in found) and len({row.p for row in found}) == len(pairs)
    by_fields = [(row.x, row.y) for row in frame.orderBy("x", "y").collect()]
    assert [(row.x, row.y) for row in frame.orderBy("p").collect()] == by_fields


def test_latest_row_shuffles_its_data_as_one_text(bronze):
    plan = latest_per_order(valid_order(bronze))._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange hashpartitioning(order_id")
    assert "_packed" in plan[exchange:] and "unit_price" not in plan[exchange:].split("Project")[0]
