"""Column expressions on hand-written edge values."""

import hashlib
import random
from datetime import date, datetime, timezone
from urllib.parse import unquote_plus

import pytest
from pyspark.sql import functions as F

from orderlake.functions.parsing import parse_date, parse_double, parse_int
from orderlake.functions.paths import (
    archive_key,
    basename,
    content_checksum,
    decode_key,
    iso_utc,
    landing_key,
    landing_name,
)
from orderlake.functions.text import imputed_region, is_missing


def values(spark, texts, *columns):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i INT, v STRING")
    rows = frame.select("i", *columns).orderBy("i").collect()
    return [row[1] if len(columns) == 1 else tuple(row[1:]) for row in rows]


INTEGERS = {
    "12.7": 12, ".5": 0, ".": 0, "12.": 12, "+3": 3, "-3.9": -3, "-.5": 0, " 7 ": 7, "\t7": 7,
    "7\n": 7, "2147483647.9": 2147483647, "-2147483648": -2147483648, "": None, "-": None,
    "+": None, "--1": None, "1e3": None, "1d": None, "1.2.3": None, "1.5x": None, "0x1": None,
    "NaN": None, "abc": None, "2147483648": None, "1 2": None, "\uff11": None, "7\u2028": None,
    "7\u0085": None, "\x007\x7f": 7, "\u00a07": None, "00012": 12, "+.": 0, "5L": None, None: None,
}


def test_integers(spark):
    assert values(spark, list(INTEGERS), parse_int("v")) == list(INTEGERS.values())


def test_integers_equal_the_non_ansi_cast(spark):
    rng = random.Random(7)
    alphabet = "0123456789.+- \t\n\x00\x7fed1\u20281"
    texts = list(INTEGERS) + [
        "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 12))) for _ in range(4000)
    ]
    ours = values(spark, texts, parse_int("v"))
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        legacy = values(spark, texts, F.col("v").cast("int"))
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    assert ours == legacy


def test_doubles(spark):
    texts = ["1e3", "1d", " 2.5 ", "Infinity", "1,5", "", "abc", None, "-7"]
    expected = [1000.0, 1.0, 2.5, float("inf"), None, None, None, None, -7.0]
    assert values(spark, texts, parse_double("v")) == expected
    assert str(values(spark, ["NaN"], parse_double("v"))[0]) == "nan"


def test_dates(spark):
    texts = ["1/2/2020", "01/02/2020", "12/31/1999", "2/29/2020", "2/30/2020", "1/2/20",
             " 1/2/2020", "1/2/2020 ", "2020-01-02", "", "12/31/99999", "13/1/2020", None]
    expected = [date(2020, 1, 2), date(2020, 1, 2), date(1999, 12, 31), date(2020, 2, 29)]
    assert values(spark, texts, parse_date("v")) == expected + [None] * 9


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_parsing_does_not_depend_on_ansi_mode(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        assert values(spark, list(INTEGERS), parse_int("v")) == list(INTEGERS.values())
        assert values(spark, ["2/30/2020", "x"], parse_date("v")) == [None, None]
        assert values(spark, ["x"], parse_double("v")) == [None]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_missing_and_region(spark):
    texts = [None, "", "   ", "\t", " Asia ", "x"]
    assert values(spark, texts, is_missing("v")) == [True, True, True, False, False, False]
    assert values(spark, texts, imputed_region("v")) == [
        "UNKNOWN", "UNKNOWN", "UNKNOWN", "\t", "Asia", "x",
    ]


def test_decode_equals_unquote_plus(spark):
    texts = ["landing/a+b.zip", "landing/x%20y.ZIP", "100%", "%zz", "a%4", "%%41", "%+1",
             "caf%C3%A9", "%C3", "plain", "%2B+%2b", ""]
    assert values(spark, texts, decode_key("v")) == [unquote_plus(text) for text in texts]


def test_archive_key(spark):
    checksum = F.lit("0123456789abcdef")
    today = F.lit(datetime(2026, 3, 1, 23, 30, tzinfo=timezone.utc))
    keys = ["landing/ingest_date=2026-01-02/sales.zip", "landing/sales.zip",
            "landing/ingest_date=/s.zip", "landing/my_ingest_date=5/s.zip"]
    assert values(spark, keys, archive_key("v", checksum, today)) == [
        "archive/ingest_date=2026-01-02/0123456789ab_sales.zip",
        "archive/ingest_date=2026-03-01/0123456789ab_sales.zip",
        "archive/ingest_date=/0123456789ab_s.zip",
        "archive/ingest_date=2026-03-01/0123456789ab_s.zip",
    ]
    assert values(spark, keys, basename("v"))[0] == "sales.zip"


def test_times_are_utc_in_any_session_zone(spark):
    moment = F.lit(datetime(2026, 3, 1, 23, 30, 5, tzinfo=timezone.utc))
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert values(spark, ["x"], iso_utc(moment)) == ["2026-03-01T23:30:05.000000+00:00"]
        assert values(spark, ["x"], landing_name(moment)) == [
            "landing/ingest_date=2026-03-01/sales_20260301T233005Z.zip"
        ]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_landing_key(spark):
    paths = ["file:/data/lake/landing/a/b.zip", "s3a://bucket/lake/landing/b.zip", "landing/c.zip"]
    assert values(spark, paths[:1], landing_key("v", "/data/lake")) == ["landing/a/b.zip"]
    assert values(spark, paths[1:2], landing_key("v", "s3://bucket/lake")) == ["landing/b.zip"]
    assert values(spark, paths[2:], landing_key("v", "/data/lake")) == ["landing/c.zip"]


def test_checksum(spark):
    assert values(spark, ["abc"], content_checksum(F.col("v").cast("binary"))) == [
        hashlib.sha256(b"abc").hexdigest()
    ]
