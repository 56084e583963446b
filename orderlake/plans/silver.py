"""Bronze -> silver, quarantine and the report about both."""

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from orderlake import snapshots
from orderlake.files import bytes_below, delete_folder, folder_names
from orderlake.functions.parsing import parse_date
from orderlake.lake import Lake, sized_session
from orderlake.operators.latest import latest_per_order
from orderlake.operators.metrics import COUNTS, refresh_metrics, report_of_counts
from orderlake.operators.split import quarantine, valid_order
from orderlake.operators.typed import flag_and_impute_region, typed_orders
from orderlake.schemas import QUARANTINE_SCHEMA, REFRESH_REPORT_SCHEMA, SILVER_SCHEMA
from orderlake.sinks.tables import write_batch_rows
from orderlake.snapshots import Snapshot
from orderlake.sources.tables import read_bronze, read_layers, read_table

# Keys of which hashes are sent to all tasks, 8 bytes each.
MOST_SENT = 2_000_000


def silver_current(bronze: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Typed silver rows, one per order. One shuffle, by order key, of pre-pruned rows.

    The raw rows compete; region and types are worked out for the winners only.
    """
    return typed_orders(flag_and_impute_region(latest_per_order(valid_order(bronze))), as_of)


def refresh(
    spark: SparkSession, lake: Lake, silver_run_id: str, as_of: Column | None = None, rebuild: bool = False
) -> DataFrame:
    """Bring quarantine and silver up to the bronze batches that have come since the last refresh; returns the run's
    report row.

    Both tables change with one snapshot. Only years with a row that comes or goes are written again, and only new
    batches are read, but for the keys of silver. The first refresh, one after a batch was replaced or removed, and
    one with `rebuild` read all of bronze. `_transformed_at` is the time of the refresh that made the row current.

    The work runs in a session of its own, whose shuffles are cut by the bytes to be read. Nothing is cached: counts
    come from written tables and stay right when executors are lost on the way.
    """
    moment = F.lit(datetime.now(timezone.utc)) if as_of is None else as_of
    delete_folder(spark, lake.changes)
    now = snapshots.current_snapshot(spark, lake)
    present = bronze_batches(spark, lake)
    if rebuild or now is None or now.base is None or now.stale:
        work = sized_session(spark, bytes_below(spark, lake.bronze))
        now = _rebuild(work, lake, now or Snapshot(), present, moment)
    elif new := _new_batches(spark, lake, now, present):
        sizes = [bytes_below(spark, f"{lake.bronze}/ingest_batch={name}") for name in new]
        work = sized_session(spark, sum(sizes) + bytes_below(spark, lake.silver))
        now = _extend(work, lake, now, new, moment)
    snapshots.expire(spark, lake)
    report = spark.createDataFrame([now.counts], ", ".join(f"{name} BIGINT" for name in COUNTS))
    path = f"{lake.refresh_report}/silver_run_id={silver_run_id}"
    write_batch_rows(report_of_counts(report), path)
    return refresh_reports(spark, lake).filter(F.col("silver_run_id") == silver_run_id)


def bronze_batches(spark: SparkSession, lake: Lake) -> DataFrame:
    """The batches that lie in bronze, by the names of their folders."""
    prefix = "ingest_batch="
    names = [name.removeprefix(prefix) for name in folder_names(spark, lake.bronze) if name.startswith(prefix)]
    return spark.createDataFrame([(name,) for name in names], snapshots.BATCHES)


def _new_batches(spark, lake, now, present) -> list[str]:
    """Batches that the snapshot does not rest on yet, as many as were loaded since."""
    known = snapshots.read_batches(spark, lake, now)
    lost = known.join(present, "ingest_batch", "left_anti").first()
    if lost:
        raise FileNotFoundError(f"bronze batch {lost.ingest_batch}, which silver rests on, is gone")
    return sorted(row.ingest_batch for row in present.join(known, "ingest_batch", "left_anti").collect())


def _counts(metrics: DataFrame) -> dict[str, int]:
    return metrics.first().asDict()


def _rebuild(spark, lake, before, present, moment) -> Snapshot:
    number = before.number + 1
    version = snapshots.new_version(number)
    snapshots.write_batches(present, lake, number, number)
    lost = quarantine(read_bronze(spark, lake, keyed=False), moment)
    snapshots.write_piece(lost, lake, QUARANTINE_SCHEMA.names, version)
    silver = silver_current(read_bronze(spark, lake, keyed=True), moment)
    years = dict.fromkeys(snapshots.write_years(silver, lake, SILVER_SCHEMA.names, version), version)
    counts = _counts(refresh_metrics(read_bronze(spark, lake)))
    counts["silver_count"] = snapshots.read_years(spark, lake, SILVER_SCHEMA, years).count()
    return snapshots.commit(spark, lake, Snapshot(number, years, [version], counts, base=number))


def _extend(spark, lake, before, new, moment) -> Snapshot:
    number = before.number + 1
    version = snapshots.new_version(number)
    added = _counts(refresh_metrics(read_bronze(spark, lake, ingest_batch=new)))
    pieces = before.pieces
    if added["quarantine_count"]:
        lost = quarantine(read_bronze(spark, lake, keyed=False, ingest_batch=new), moment)
        if len(pieces) >= snapshots.MOST_PIECES:
            lost = lost.unionByName(snapshots.read_pieces(spark, lake, QUARANTINE_SCHEMA, pieces))
            pieces = []
        snapshots.write_piece(lost, lake, QUARANTINE_SCHEMA.names, version)
        pieces = [*pieces, version]

    changed = changed_orders(spark, lake, before, new, f"{lake.changes}/{version}")
    fresh = typed_orders(flag_and_impute_region(changed), moment)
    touched = _touched_years(changed)
    stored = {year: old for year, old in before.years.items() if year in touched}
    kept = snapshots.read_years(spark, lake, SILVER_SCHEMA, stored).join(
        changed.select("order_id"), "order_id", "left_anti"
    )
    written = snapshots.write_years(kept.unionByName(fresh), lake, SILVER_SCHEMA.names, version) if touched else []
    years = {year: old for year, old in before.years.items() if year not in touched}
    years |= dict.fromkeys(written, version)

    added["silver_count"] = changed.filter(~F.col("was_known")).count()
    counts = {name: before.counts[name] + added[name] for name in COUNTS}
    snapshots.write_batches(spark.createDataFrame([(name,) for name in new], snapshots.BATCHES), lake, before.base, number)
    done = snapshots.commit(spark, lake, Snapshot(number, years, pieces, counts, before.base))
    delete_folder(spark, lake.changes)
    return done


def changed_orders(spark: SparkSession, lake: Lake, before: Snapshot, new: list[str], path: str) -> DataFrame:
    """The raw rows that the new batches make current, with `was_known` and `old_year` of the row they replace.

    The best new row of each order competes with the stored one by time and file. Of silver only four columns are
    read for that. Where both are the same, the raw columns decide, which silver has not: for such orders, rows of one
    file that came in twice, the best new row competes with the rows of the earlier batches in bronze.
    """
    # Silver has no checksum and no order rests on it: 64 characters that would be shuffled with each row.
    fresh = read_bronze(spark, lake, keyed=True, ingest_batch=new).drop("_checksum_sha256")
    best = latest_per_order(valid_order(fresh))
    stored = snapshots.read_years(spark, lake, SILVER_SCHEMA, before.years).select(
        "order_id",
        F.struct("_ingested_at", "_source_file").alias("old_rank"),
        F.col("order_year").alias("old_year"),
        F.lit(True).alias("known"),
    )
    rank = F.struct("_ingested_at", "_source_file")
    competing = best.join(stored, "order_id", "left").select(
        *best.columns,
        F.coalesce("known", F.lit(False)).alias("was_known"),
        "old_year",
        (F.col("known").isNotNull() & (rank == F.col("old_rank"))).alias("is_tie"),
        (F.col("known").isNull() | (rank >= F.col("old_rank"))).alias("is_ahead"),
    )
    competing.filter("is_ahead").drop("is_ahead").write.option("compression", snapshots.CODEC).parquet(path)
    ahead = spark.read.parquet(path)
    ties = ahead.filter("is_tie")
    if not (n_ties := ties.count()):
        return ahead.drop("is_tie")
    # The best of the new rows against those of the batches before, which are all that silver rests on.
    earlier = read_bronze(spark, lake, keyed=True, with_batch=True).filter(~F.col("ingest_batch").isin(new))
    rivals = valid_order(earlier.drop("ingest_batch", "_checksum_sha256"))
    if n_ties <= MOST_SENT:
        # Hashes of the few keys let nearly all other rows go before the shuffle; the join decides.
        keys = ties.select(F.xxhash64("order_id").alias("key"))
        rivals = rivals.join(F.broadcast(keys), F.xxhash64("order_id") == F.col("key"), "left_semi")
    rivals = rivals.join(ties.select("order_id"), "order_id", "left_semi")
    both = rivals.unionByName(ties.select(*best.columns))
    settled = latest_per_order(both).join(ties.select("order_id", "was_known", "old_year"), "order_id")
    settled.write.option("compression", snapshots.CODEC).parquet(f"{path}-ties")
    return ahead.filter(~F.col("is_tie")).drop("is_tie").unionByName(spark.read.parquet(f"{path}-ties"))


def _touched_years(changed: DataFrame) -> set[str]:
    """Years of the rows that come and of those that go, as their folders are named."""
    new_year = F.struct(F.year(parse_date("order_date")).alias("year"))
    old_year = F.struct(F.col("old_year").alias("year"))
    both = F.when(F.col("was_known"), F.array(new_year, old_year)).otherwise(F.array(new_year))
    # A date of the source has four digits for its year.
    rows = changed.select(F.explode(both).alias("x")).select("x.year").distinct().collect()
    return {snapshots.NULL_YEAR if row.year is None else str(row.year) for row in rows}


def refresh_reports(spark: SparkSession, lake: Lake) -> DataFrame:
    """Reports of all refreshes."""
    return read_table(spark, lake.refresh_report, REFRESH_REPORT_SCHEMA)


def reconciliation(spark: SparkSession, lake: Lake, report: DataFrame) -> DataFrame:
    """The reports' rows with the sizes of the stored tables and whether all counts agree.

    The stored tables are those of the newest refresh: its counts must also be their sizes. Older reports are
    judged by their own counts.
    """
    silver, lost = read_layers(spark, lake)
    stored = lost.agg(F.count("*").alias("stored_quarantine")).crossJoin(
        silver.agg(F.count("*").alias("stored_silver"))
    )
    written = refresh_reports(spark, lake).select(
        "silver_run_id", F.col("_metadata.file_modification_time").alias("written_at")
    )
    newest = written.agg(F.max_by("silver_run_id", "written_at").alias("newest"))
    return report.crossJoin(stored).crossJoin(newest).withColumn(
        "is_sound",
        F.expr(
            "raw_count = quarantine_count + duplicate_count + silver_count AND duplicate_count >= 0"
            " AND (silver_run_id <> coalesce(newest, silver_run_id)"
            " OR stored_quarantine = quarantine_count AND stored_silver = silver_count)"
        ),
    ).drop("newest")
