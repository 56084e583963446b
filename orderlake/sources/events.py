"""Landing keys out of storage notifications, one JSON text per row, in batch or as a stream."""

from pyspark.sql import Column, DataFrame, functions as F

from orderlake.functions.paths import decode_key, is_landing_zip

_EVENT = (
    "landing_key STRING, `detail-type` STRING, source STRING, "
    "detail STRUCT<bucket: STRUCT<name: STRING>, object: STRUCT<key: STRING>>, "
    "Records ARRAY<STRUCT<eventSource: STRING, eventName: STRING, s3: STRUCT<object: STRUCT<key: STRING>>>>"
)


def event_key(text: Column, parsed: Column, bucket: str) -> Column:
    """The key as it stands in the event, NULL if none of the three shapes gives one.

    A `landing_key` field ends the search even when it is null or empty. The bucket is checked in
    the `detail` shape only, and only the first of `Records` counts. An event that says what happened must be
    about a created object - moving a file out of the landing folder makes events too - and one that names
    its source must come from the object store; events without these fields are taken as they are.
    """
    created = F.coalesce(parsed["detail-type"] == "Object Created", F.lit(True)) & F.coalesce(
        parsed["source"] == "aws.s3", F.lit(True)
    )
    detail_key = parsed["detail"]["object"]["key"]
    record = F.get(parsed["Records"], 0)
    return (
        F.when(
            F.array_contains(F.json_object_keys(text), "landing_key"), parsed["landing_key"]
        )
        .when(
            created & (parsed["detail"]["bucket"]["name"] == bucket) & (detail_key != ""),
            detail_key,
        )
        .when(
            (record["eventSource"] == "aws:s3")
            & F.coalesce(record["eventName"].startswith("ObjectCreated"), F.lit(True)),
            record["s3"]["object"]["key"],
        )
    )


def landing_keys(events: DataFrame, bucket: str, column: str = "event") -> DataFrame:
    """Events -> one `landing_key` per event that announces a landing ZIP, decoded.

    The test sits inside the array that is exploded, not in a filter behind it: Spark would push
    such a filter down and work the key out a second time for it.
    """
    parsed = events.withColumn("_parsed", F.from_json(column, _EVENT))
    key = decode_key(event_key(F.col(column), F.col("_parsed"), bucket))
    wanted = F.filter(F.array(key), is_landing_zip)
    return parsed.select(*events.columns, F.explode(wanted).alias("landing_key"))
