"""Landing folder, ZIP members, CSV rules, storage events."""

import json

import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from orderlake.operators.bronze import conform_columns
from orderlake.schemas import DATA_COLUMNS, HEADER_MAP
from orderlake.sources.archives import extract_lines, read_headers
from orderlake.sources.csv import header_width, match_headers, read_csv, split_fields
from orderlake.sources.events import landing_keys
from orderlake.sources.landing import describe_files, scan_landing
from zips import HEADER, csv, line, write_zip


def lines_of(spark, lake):
    rows = extract_lines(scan_landing(spark, lake).select("path")).collect()
    return sorted((row.path.rsplit("/", 1)[1], row.line_no, row.line) for row in rows)


def test_landing_scan_takes_zips_of_any_case_at_any_depth(spark, lake):
    for key in ("landing/a.zip", "landing/ingest_date=2026-01-01/b.ZIP", "landing/x/y/c.Zip",
                "landing/d.zip.txt", "other/e.zip"):
        write_zip(lake.root, key, csv())
    found = describe_files(scan_landing(spark, lake), lake).select("landing_key").collect()
    assert sorted(row.landing_key for row in found) == [
        "landing/a.zip", "landing/ingest_date=2026-01-01/b.ZIP", "landing/x/y/c.Zip",
    ]


def test_member_choice(spark, lake):
    write_zip(lake.root, "landing/mac.zip", {"__MACOSX/x.csv": "bad", "d/Sales.CSV": "h\n1"})
    write_zip(lake.root, "landing/two.zip", {"readme.txt": "no", "b.csv": "h\n2", "a.csv": "h\n3"})
    assert lines_of(spark, lake) == [
        ("mac.zip", 0, "h"), ("mac.zip", 1, "1"), ("two.zip", 0, "h"), ("two.zip", 1, "2"),
    ]


def test_zip_without_csv_fails_by_name(spark, lake):
    write_zip(lake.root, "landing/none.zip", {"a.txt": "x"})
    with pytest.raises(PythonException, match="none.zip"):
        lines_of(spark, lake)


def test_lines_end_like_in_sparks_reader(spark, lake, tmp_path):
    text = b"\xef\xbb\xbfh1,h2\r\n\r\n   \n1,a\rb,\xff\n\x0b\n\nlast,\xc3\xa9"
    write_zip(lake.root, "landing/t.zip", text)
    (tmp_path / "t.csv").write_bytes(text)
    ours = [row[2] for row in lines_of(spark, lake)]
    assert ours == ["h1,h2", "1,a", "b,\ufffd", "last,\u00e9"]
    theirs = read_csv(spark, str(tmp_path / "t.csv"))
    assert theirs.columns == ["h1", "h2"]
    assert [",".join(row) for row in theirs.collect()] == ours[1:]


def test_long_members_are_cut_at_line_ends(spark, lake):
    wanted = [f"{i},{'x' * (i % 977)}" for i in range(5000)]
    write_zip(lake.root, "landing/long.zip", "\r\n".join(wanted))
    found = lines_of(spark, lake)
    assert [row[2] for row in sorted(found, key=lambda row: row[1])] == wanted
    assert sorted(row[1] for row in found) == list(range(5000))


def test_headers_of_unusable_zips_are_reported_not_raised(spark, lake):
    write_zip(lake.root, "landing/none.zip", {"a.txt": "x"})
    write_zip(lake.root, "landing/empty.zip", {"a.csv": ""})
    write_zip(lake.root, "landing/good.zip", {"a.csv": "\n h \n1\n", "b.csv": "x"})
    (tmp := open(f"{lake.root}/landing/broken.zip", "wb")).write(b"PK no zip")
    tmp.close()
    rows = read_headers(scan_landing(spark, lake).select("path")).collect()
    found = {row.path.rsplit("/", 1)[1]: row for row in rows}
    assert found["none.zip"].error == "no CSV found inside the ZIP"
    assert found["broken.zip"].error.startswith("unreadable ZIP")
    assert (found["empty.zip"].member, found["empty.zip"].header) == ("a.csv", None)
    assert (found["good.zip"].header, found["good.zip"].csv_members) == (" h ", 2)


CSV_LINES = [
    "Asia,,1,x", '"",UK,"",y', '  ,"a ""q"" b",3,z', "short", "1,2,3,4,5", '"a,b",c\\,d,"e\\"f",g',
    '"open,quote', ",,,", '"a"b,c,d,e', " lead,trail , both ,x", 'x"y,z,1,2', "\\,\\\\,',a",
]


def test_lines_are_split_like_in_sparks_reader(spark, tmp_path):
    (tmp_path / "t.csv").write_text("\n".join(["a,b,c,d"] + CSV_LINES) + "\n")
    theirs = [tuple(row) for row in read_csv(spark, str(tmp_path / "t.csv")).collect()]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(CSV_LINES)], "i INT, line STRING")
    rows = split_fields(frame, "line", 4, "fields").orderBy("i").collect()
    assert [tuple(row.fields) for row in rows] == theirs
    assert theirs[0] == ("Asia", None, "1", "x") and theirs[1] == (None, "UK", None, "y")
    assert theirs[3] == ("short", None, None, None) and theirs[4] == ("1", "2", "3", "4")


def test_headers_are_matched_exactly(spark):
    headers = [
        HEADER,
        "extra,Order ID,Region",
        "region,Order ID",
        "Region,REGION,Order ID",
        '"Region","Order, ID",Country',
        None,
        " Region,Order ID ",
    ]
    frame = spark.createDataFrame([(i, h) for i, h in enumerate(headers)], "i INT, header STRING")
    width = frame.agg(F.max(header_width("header"))).first()[0]
    rows = match_headers(frame, width).orderBy("i").collect()
    order = DATA_COLUMNS.index("order_id")

    def found(row):
        return {DATA_COLUMNS[i]: p for i, p in enumerate(row.positions) if p is not None}

    assert rows[0].positions == list(range(14)) and rows[0].unmatched_headers == []
    assert found(rows[1]) == {"region": 2, "order_id": 1} and rows[1].unmatched_headers == ["extra"]
    assert found(rows[2]) == {"order_id": 1} and rows[2].unmatched_headers == ["region"]
    assert found(rows[3]) == {"order_id": 2} and rows[3].unmatched_headers == ["Region", "REGION"]
    assert found(rows[4]) == {"region": 0, "country": 2}
    assert found(rows[5]) == {}
    assert found(rows[6]) == {} and order == 6


def test_plain_csv_columns_conform(spark, tmp_path):
    (tmp_path / "t.csv").write_text("Order ID,region,More,Country\n7,Asia,x,Japan\n")
    row = conform_columns(read_csv(spark, str(tmp_path))).first()
    assert row.asDict() == dict.fromkeys(DATA_COLUMNS) | {"order_id": "7", "country": "Japan"}


def test_plain_csv_of_two_layouts_is_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,2\n")
    (tmp_path / "b.csv").write_text("b,a\n1,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, str(tmp_path)).collect()


def test_event_shapes(spark):
    detail = {"bucket": {"name": "B"}, "object": {"key": "landing/x%20y.ZIP"}}
    records = [{"eventSource": "aws:s3", "s3": {"object": {"key": "landing/r.zip"}}}]
    events = {
        json.dumps({"landing_key": "landing/a+b.zip"}): "landing/a b.zip",
        json.dumps({"detail": detail}): "landing/x y.ZIP",
        json.dumps({"Records": records}): "landing/r.zip",
        json.dumps({"detail": detail | {"bucket": {"name": "foreign"}}}): None,
        json.dumps({"detail": detail | {"bucket": {"name": "foreign"}}, "Records": records}): "landing/r.zip",
        json.dumps({"landing_key": None, "detail": detail}): None,
        json.dumps({"landing_key": "", "Records": records}): None,
        json.dumps({"Records": [{"eventSource": "other"}] + records}): None,
        json.dumps({"Records": []}): None,
        json.dumps({"landing_key": "landing/n.txt"}): None,
        json.dumps({"landing_key": "other/z.zip"}): None,
        "{}": None,
        "{broken": None,
        "": None,
    }
    frame = spark.createDataFrame([(e,) for e in events], "event STRING")
    found = {row.event: row.landing_key for row in landing_keys(frame, "B").collect()}
    assert found == {event: key for event, key in events.items() if key}


def test_event_key_is_worked_out_once(spark):
    frame = spark.createDataFrame([("{}",)], "event STRING").repartition(1)
    plan = landing_keys(frame, "B")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1 and plan.count("UrlCodec") <= 1


def test_all_bronze_columns_have_a_header():
    assert len(HEADER_MAP) == len(line(1).split(",")) == 14
