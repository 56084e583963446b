"""Parquet tables of a lake.

The write mode is set on each write and holds whatever the session says: a full overwrite must not
turn into one that keeps the partitions the new rows do not touch.
"""

from dataclasses import replace

from pyspark.sql import DataFrame, functions as F, types as T

from orderlake import schemas, snapshots
from orderlake.files import delete_folder, exists, folder_names, hadoop, write_new_text
from orderlake.functions.text import is_missing
from orderlake.lake import Lake
from orderlake.snapshots import CODEC, Snapshot

# About one target file of raw sales rows.
ROWS_OF_A_FILE = 2_000_000
ROOT_PROPERTY, SNAPSHOT_PROPERTY = "orderlake.root", "orderlake.snapshot"


def overwrite(
    frame: DataFrame, path: str, columns: list[str], partition_by: list[str] | None = None, rebalance: bool = True
) -> None:
    """Replace the whole table at `path` by the named columns of the frame.

    The new table is written beside the old one, under a hidden name, and takes its place when it is
    complete: a write that fails or is running leaves the old table as it was.

    The rows are rebalanced first: Spark then cuts them by size instead of by whatever the last
    shuffle gave, joins small pieces and splits a partition value that is too large for one file. Without
    `rebalance` each task writes its rows as they are, `ROWS_OF_A_FILE` to a file.
    """
    rows = frame.select(*columns)
    if rebalance:
        rows = rows.hint("rebalance", *(partition_by or []))
    writer = (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .option("compression", CODEC)
        .option("maxRecordsPerFile", 0 if rebalance else ROWS_OF_A_FILE)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    new, old = aside(path)
    writer.parquet(new)
    _take_place(frame.sparkSession, new, path, old)


def aside(path: str) -> tuple[str, str]:
    """Where a table lies while it is written, and while it is replaced: names beside it that Spark leaves out. It would
    list one with an equals sign as a partition."""
    folder, _, name = path.rpartition("/")
    name = name.replace("=", "~")
    return f"{folder}/_new_{name}", f"{folder}/_old_{name}"


def _take_place(spark, new: str, path: str, old: str) -> None:
    """Two renames. What a crash between them leaves is put right by the next write or by `restore`."""
    restore(spark, path)
    files, goal = hadoop(spark, path)
    source, before = hadoop(spark, new)[1], hadoop(spark, old)[1]
    if files.exists(goal):
        files.delete(before, True)
        files.rename(goal, before)
    if not files.rename(source, goal):
        raise OSError(f"cannot rename {new} to {path}")
    files.delete(before, True)


def restore(spark, path: str) -> None:
    """Put the old table back if a write was cut off while the new one took its place."""
    files, goal = hadoop(spark, path)
    old = hadoop(spark, aside(path)[1])[1]
    if not files.exists(goal) and files.exists(old):
        files.rename(old, goal)


def append_bronze(bronze: DataFrame, lake: Lake, ingest_batch: str) -> None:
    """Add one batch of rows. A batch written again replaces its own folder only; if silver rests on it, the next
    refresh is a full one.

    Rows with and without an order key lie in folders of their own, so that silver and quarantine
    each read just their rows. They are written by the tasks that read them out of their ZIPs, without a shuffle of
    the raw text. A note says that the batch is not in the ledger yet (`settled`).
    """
    spark = bronze.sparkSession
    if not exists(spark, f"{lake.pending}/{ingest_batch}"):
        write_new_text(spark, f"{lake.pending}/{ingest_batch}", "")
    keyed = bronze.withColumn("keyed", ~is_missing("order_id"))
    if folder_names(spark, f"{lake.bronze}/ingest_batch={ingest_batch}"):
        snapshots.invalidate(spark, lake)
    path = f"{lake.bronze}/ingest_batch={ingest_batch}"
    overwrite(keyed, path, [*schemas.BRONZE_SCHEMA.names, "keyed"], ["keyed"], rebalance=False)


def settled(spark, lake: Lake, ingest_batch: str) -> None:
    """The ledger has taken the batch as loaded."""
    delete_folder(spark, f"{lake.pending}/{ingest_batch}")


def unsettled(spark, lake: Lake) -> list[str]:
    """Batches that were written, or begun, and not taken by the ledger: as many as runs were cut off."""
    return [name for name in folder_names(spark, lake.pending) if not name.startswith("_")]


def remove_bronze(spark, lake: Lake, ingest_batch: str) -> None:
    """Remove a batch that must not count; the next refresh is a full one."""
    snapshots.invalidate(spark, lake)
    delete_folder(spark, f"{lake.bronze}/ingest_batch={ingest_batch}")
    settled(spark, lake, ingest_batch)


def overwrite_quarantine(quarantine: DataFrame, lake: Lake) -> None:
    """Replace the quarantine, and nothing else."""
    spark = quarantine.sparkSession
    now = snapshots.current_snapshot(spark, lake) or Snapshot()
    version = snapshots.new_version(now.number + 1)
    snapshots.write_piece(quarantine, lake, schemas.QUARANTINE_SCHEMA.names, version)
    snapshots.commit(spark, lake, replace(now, number=now.number + 1, pieces=[version], base=None))


def overwrite_silver(silver: DataFrame, lake: Lake) -> None:
    """Replace silver, and nothing else. It lies in one folder per order year; rows without a date in the default
    folder."""
    spark = silver.sparkSession
    now = snapshots.current_snapshot(spark, lake) or Snapshot()
    version = snapshots.new_version(now.number + 1)
    years = snapshots.write_years(silver, lake, schemas.SILVER_SCHEMA.names, version)
    fresh = dict.fromkeys(years, version)
    snapshots.commit(spark, lake, replace(now, number=now.number + 1, years=fresh, base=None))


def write_batch_rows(rows: DataFrame, path: str) -> None:
    """One row per file of a batch - ledger events, a manifest, a report. They are there as a whole or not at all, in
    one file if they are few.

    The rows are shuffled into their files: merging partitions without a shuffle would also put the
    reading of all ZIPs, of which they are the result, into few tasks.
    """
    overwrite(rows, path, rows.columns)


def append_ledger(events: DataFrame, lake: Lake, seq: int) -> None:
    """Add the events of one step of a batch. All carry `seq`, the step's place in the ledger."""
    write_batch_rows(events, f"{lake.ledger}/event_seq={seq}")


def append_ledger_of_many_batches(events: DataFrame, lake: Lake, seq: int) -> None:
    """The same for events whose number no batch bounds. They may become visible in part; that must
    be harmless to the step they record."""
    overwrite(events, f"{lake.ledger}/event_seq={seq}", events.columns)


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def create_tables(spark, lake: Lake, database: str = "default") -> None:
    """SQL tables over the lake's folders, where the catalog has none yet."""
    tables = {
        "sales_bronze": (
            T.StructType(
                schemas.BRONZE_SCHEMA.fields
                + T.StructType.fromDDL("ingest_batch STRING, keyed BOOLEAN").fields
            ),
            lake.bronze,
            "ingest_batch, keyed",
        ),
        "sales_silver": (schemas.SILVER_SCHEMA, lake.silver, "order_year"),
        "sales_quarantine": (
            T.StructType(schemas.QUARANTINE_SCHEMA.fields + T.StructType.fromDDL("version STRING").fields),
            lake.quarantine,
            "version",
        ),
    }
    for name, (schema, path, partitioning) in tables.items():
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{name} ({_ddl(schema)}) USING parquet "
            f"OPTIONS (compression '{CODEC}') PARTITIONED BY ({partitioning}) LOCATION '{path}' "
            f"TBLPROPERTIES ('{ROOT_PROPERTY}' = '{lake.root}')"
        )


def publish_tables(spark, database: str = "default") -> None:
    """Let the SQL tables show the newest snapshot, with the bronze batches it rests on.

    Only what has changed since the snapshot published before is told to the catalog: folders of the years and
    quarantine pieces that differ, and the batches taken in since. Each statement may be repeated, and the
    snapshot's number is noted last. Only a full rebuild has all bronze folders listed.
    """
    properties = {row.key: row.value for row in spark.sql(f"SHOW TBLPROPERTIES {database}.sales_silver").collect()}
    lake = Lake(properties[ROOT_PROPERTY])
    now = snapshots.current_snapshot(spark, lake)
    published = int(properties.get(SNAPSHOT_PROPERTY, 0))
    if now is None or now.number == published:
        return
    kept = published in snapshots.numbers(spark, lake)
    before = snapshots.read_snapshot(spark, lake, published) if kept else Snapshot()

    silver, quarantine, bronze = (f"{database}.sales_{name}" for name in ("silver", "quarantine", "bronze"))
    gone = [f"order_year={_year(y)}" for y in _listed(spark, silver, before.years, kept) if y not in now.years]
    _drop(spark, silver, gone)
    for year, version in now.years.items():
        if before.years.get(year) != version:
            spec, folder = f"order_year={_year(year)}", snapshots.year_folder(lake, year, version)
            spark.sql(f"ALTER TABLE {silver} ADD IF NOT EXISTS PARTITION ({spec}) LOCATION '{folder}'")
            spark.sql(f"ALTER TABLE {silver} PARTITION ({spec}) SET LOCATION '{folder}'")
    gone = [f"version='{v}'" for v in _listed(spark, quarantine, before.pieces, kept) if v not in now.pieces]
    _drop(spark, quarantine, gone)
    _add(spark, quarantine, [f"version='{v}'" for v in now.pieces if v not in before.pieces])

    if kept and before.base is not None and before.base == now.base:
        # As many as were loaded since.
        added = snapshots.read_batches(spark, lake, now, after=before.number).collect()
        folders = {row.ingest_batch: folder_names(spark, f"{lake.bronze}/ingest_batch={row.ingest_batch}") for row in added}
        _add(spark, bronze, [
            f"ingest_batch='{batch}', {folder}" for batch, names in folders.items() for folder in names if folder.startswith("keyed=")
        ])
    else:
        spark.sql(f"MSCK REPAIR TABLE {bronze} SYNC PARTITIONS")
    spark.sql(f"ALTER TABLE {silver} SET TBLPROPERTIES ('{SNAPSHOT_PROPERTY}' = '{now.number}')")
    for name in (silver, quarantine, bronze):
        spark.catalog.refreshTable(name)


def _year(folder: str) -> str:
    return "null" if folder == snapshots.NULL_YEAR else folder


def _listed(spark, table: str, before, kept: bool) -> list[str]:
    """What the catalog has: as published, or as it says if that snapshot is gone."""
    if kept:
        return list(before)
    return [row.partition.partition("=")[2] for row in spark.sql(f"SHOW PARTITIONS {table}").collect()]


def _add(spark, table: str, specs: list[str]) -> None:
    for low in range(0, len(specs), 100):
        parts = " ".join(f"PARTITION ({spec})" for spec in specs[low : low + 100])
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {parts}")


def _drop(spark, table: str, specs: list[str]) -> None:
    for low in range(0, len(specs), 100):
        parts = ", ".join(f"PARTITION ({spec})" for spec in specs[low : low + 100])
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {parts}")
