"""Keys and paths of landing and archive files, and time stamps as text."""

from pyspark.sql import Column, functions as F

LANDING_PREFIX = "landing/"
ARCHIVE_PREFIX = "archive/"
ZIP_SUFFIX = ".zip"
# For listing a folder: Spark's glob filter is case-sensitive.
ZIP_GLOB = "*.[zZ][iI][pP]"


def is_landing_zip(key: str | Column) -> Column:
    """Key under the landing prefix that ends in .zip, in upper or lower case."""
    value = F.col(key) if isinstance(key, str) else key
    return value.startswith(LANDING_PREFIX) & F.lower(value).endswith(ZIP_SUFFIX)


def basename(key: str | Column) -> Column:
    return F.element_at(F.split(key, "/"), -1)


def ingest_date(key: str | Column) -> Column:
    """Value of the first path part `ingest_date=...`, NULL if there is none."""
    return F.regexp_extract(key, r"(?:\A|/)ingest_date=([^/]*)", 1)


def has_ingest_date(key: str | Column) -> Column:
    value = F.col(key) if isinstance(key, str) else key
    return value.rlike(r"(?:\A|/)ingest_date=")


def utc_text(moment: Column, pattern: str) -> Column:
    """The moment in UTC as text, whatever the session's time zone."""
    return F.date_format(F.to_utc_timestamp(moment, F.current_timezone()), pattern)


def iso_utc(moment: Column) -> Column:
    return F.concat(utc_text(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))


def landing_name(moment: Column) -> Column:
    """Key under which a file that arrives now is put into the landing folder."""
    return F.concat(
        F.lit(f"{LANDING_PREFIX}ingest_date="),
        utc_text(moment, "yyyy-MM-dd"),
        F.lit("/sales_"),
        utc_text(moment, "yyyyMMdd'T'HHmmss'Z'"),
        F.lit(ZIP_SUFFIX),
    )


def archive_key(key: str | Column, checksum: str | Column, as_of: Column) -> Column:
    """archive/ingest_date=<of the landing key, else today UTC>/<first 12 of checksum>_<file name>."""
    date = F.when(has_ingest_date(key), ingest_date(key)).otherwise(utc_text(as_of, "yyyy-MM-dd"))
    return F.concat(
        F.lit(f"{ARCHIVE_PREFIX}ingest_date="),
        date,
        F.lit("/"),
        F.substring(checksum, 1, 12),
        F.lit("_"),
        basename(key),
    )


def landing_key(path: str | Column, root: str) -> Column:
    """The path below the lake root, `landing/...`. Spark may spell the root differently in the
    path (file:/x for /x), so the root is found by its own path part."""
    value = F.col(path) if isinstance(path, str) else path
    below = root.split("://", 1)[1] if "://" in root else root.removeprefix("file:")
    below = below.rstrip("/") + "/"
    position = F.locate(below + LANDING_PREFIX, value)
    return F.when(position > 0, F.substr(value, position + F.lit(len(below)))).otherwise(value)


def decode_key(key: str | Column) -> Column:
    """URL-decode with `+` as a space. A `%` that starts no valid escape stays as it is."""
    value = F.col(key) if isinstance(key, str) else key
    return F.try_url_decode(F.regexp_replace(value, r"%(?![0-9A-Fa-f]{2})", "%25"))


def content_checksum(content: str | Column) -> Column:
    """SHA-256 of the whole content, in hex."""
    return F.sha2(content, 256)
