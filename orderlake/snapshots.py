"""Silver and quarantine as immutable versions, and snapshots that name a consistent pair of them.

    silver/order_year=1995/version=v12-3f9a2c1b/part-...   rows of one year as one refresh wrote them
    quarantine/version=v12-77b0e9d4/part-...               rows that one refresh added
    snapshots/000000000012.json                            the year folders and quarantine folders that count
    snapshots/batches/base=9/by=12/part-...                bronze batches that snapshot 12 took in

Files are never changed. A refresh writes new version folders, which nobody reads yet, and then one snapshot file,
written aside and renamed: with it both tables change at once, and a refresh that is cut off before it has changed
nothing. Years that a refresh does not touch keep their folders. Readers take the newest snapshot when they build
their frame and go on with its folders until those expire.

A snapshot is as long as there are years and quarantine folders (`MOST_PIECES`, then they are folded into one). The
batches it rests on are a table, as their number grows; `base` is the snapshot of the last full rebuild.
"""

import json
import uuid
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from orderlake.lake import Lake
from orderlake.files import delete_folder, exists, folder_names, read_text, write_new_text

CODEC = "snappy"
KEPT = 10
MOST_PIECES = 32
NULL_YEAR = "__HIVE_DEFAULT_PARTITION__"
BATCHES = T.StructType([T.StructField("ingest_batch", T.StringType())])


@dataclass(frozen=True)
class Snapshot:
    """`years`: order year (as its folder is named) -> version. `pieces`: versions of the quarantine. `counts`: what the
    report says. `base` is null, or `stale` true, where the tables do not follow from the batches named: then the next
    refresh is a full one."""

    number: int = 0
    years: dict[str, str] = field(default_factory=dict)
    pieces: list[str] = field(default_factory=list)
    counts: dict[str, int] = field(default_factory=dict)
    base: int | None = None
    stale: bool = False


def year_folder(lake: Lake, year: str, version: str) -> str:
    return f"{lake.silver}/order_year={year}/version={version}"


def piece_folder(lake: Lake, version: str) -> str:
    return f"{lake.quarantine}/version={version}"


def numbers(spark: SparkSession, lake: Lake) -> list[int]:
    names = folder_names(spark, lake.snapshots)
    return sorted(int(name.removesuffix(".json")) for name in names if name.endswith(".json") and name[0] not in "_.")


def read_snapshot(spark: SparkSession, lake: Lake, number: int) -> Snapshot:
    return Snapshot(**json.loads(read_text(spark, f"{lake.snapshots}/{number:012}.json")))


def current_snapshot(spark: SparkSession, lake: Lake) -> Snapshot | None:
    """The newest snapshot; none if none was ever written."""
    found = numbers(spark, lake)
    return read_snapshot(spark, lake, found[-1]) if found else None


def new_version(number: int) -> str:
    """A name no other attempt has, so that what a cut-off one left is never read."""
    return f"v{number}-{uuid.uuid4().hex[:8]}"


def commit(spark: SparkSession, lake: Lake, snapshot: Snapshot) -> Snapshot:
    """Make a snapshot the current one. Fails if another writer has taken its number."""
    write_new_text(spark, f"{lake.snapshots}/{snapshot.number:012}.json", json.dumps(asdict(snapshot)))
    return snapshot


def invalidate(spark: SparkSession, lake: Lake) -> None:
    """Say that bronze rows the current snapshot rests on are about to change: the next refresh is a full one."""
    now = current_snapshot(spark, lake)
    if now and now.base is not None and not now.stale:
        commit(spark, lake, replace(now, number=now.number + 1, stale=True))


# ---- batches that a snapshot rests on -------------------------------------------------------------


def _batches_path(lake: Lake, base: int, number: int) -> str:
    return f"{lake.snapshots}/batches/base={base}/by={number}"


def write_batches(batches: DataFrame, lake: Lake, base: int, number: int) -> None:
    """The batches that snapshot `number` takes in. An attempt that was cut off is replaced."""
    batches.repartition(1).write.mode("overwrite").option("compression", CODEC).parquet(_batches_path(lake, base, number))


def read_batches(spark: SparkSession, lake: Lake, snapshot: Snapshot | None, after: int = 0) -> DataFrame:
    """Batches a snapshot rests on (those that snapshots later than `after` took in). What an attempt without a
    snapshot has left is not among them."""
    if snapshot is None or snapshot.base is None:
        return spark.createDataFrame([], BATCHES)
    root = f"{lake.snapshots}/batches"
    schema = T.StructType(BATCHES.fields + T.StructType.fromDDL("base BIGINT, by BIGINT").fields)
    if after >= snapshot.base:
        # Only the folders asked for are listed.
        known = [number for number in range(after + 1, snapshot.number + 1)]
        paths = [path for number in known if exists(spark, path := _batches_path(lake, snapshot.base, number))]
        if not paths:
            return spark.createDataFrame([], BATCHES)
        found = spark.read.schema(schema).option("basePath", root).parquet(*paths)
    else:
        found = spark.read.schema(schema).option("basePath", root).parquet(f"{root}/base={snapshot.base}")
    return found.filter(F.col("by") <= snapshot.number).select("ingest_batch")


# ---- writing versions ----------------------------------------------------------------------------


def write_years(rows: DataFrame, lake: Lake, columns: list[str], version: str) -> list[str]:
    """Rows as a version of each year among them; returns the years written, as their folders are named."""
    spark = rows.sparkSession
    named = rows.select(*columns).hint("rebalance", "order_year").withColumn("version", F.lit(version))
    named.write.mode("append").option("compression", CODEC).partitionBy("order_year", "version").parquet(lake.silver)
    prefix = "order_year="
    years = [name.removeprefix(prefix) for name in folder_names(spark, lake.silver) if name.startswith(prefix)]
    return [year for year in years if exists(spark, year_folder(lake, year, version))]


def write_piece(rows: DataFrame, lake: Lake, columns: list[str], version: str) -> None:
    rows.select(*columns).hint("rebalance").write.mode("append").option("compression", CODEC).parquet(piece_folder(lake, version))


# ---- reading versions ----------------------------------------------------------------------------


def read_years(spark: SparkSession, lake: Lake, schema: T.StructType, years: dict[str, str]) -> DataFrame:
    """Silver rows of the given versions. A folder that is missing is an error."""
    if not years:
        return spark.createDataFrame([], schema)
    full = T.StructType(schema.fields + [T.StructField("version", T.StringType())])
    paths = [year_folder(lake, year, version) for year, version in years.items()]
    return spark.read.schema(full).option("basePath", lake.silver).parquet(*paths).select(*schema.names)


def read_pieces(spark: SparkSession, lake: Lake, schema: T.StructType, pieces: list[str]) -> DataFrame:
    if not pieces:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[piece_folder(lake, piece) for piece in pieces])


# ---- expiry --------------------------------------------------------------------------------------


def expire(spark: SparkSession, lake: Lake, keep: int = KEPT) -> None:
    """Remove all but the newest `keep` snapshots, then every version and list of batches that none of those names.

    Snapshots go first: a cut-off run leaves files that nobody names, for the next one. Versions of an attempt that
    is under way would count as such; as everywhere, one refresh at a time writes to a lake.
    """
    found = numbers(spark, lake)
    for number in found[:-keep]:
        delete_folder(spark, f"{lake.snapshots}/{number:012}.json")
    kept = [read_snapshot(spark, lake, number) for number in found[-keep:]]
    named = {(year, version) for snapshot in kept for year, version in snapshot.years.items()}
    for folder in folder_names(spark, lake.silver):
        year = folder.removeprefix("order_year=")
        if year != folder:
            for name in folder_names(spark, f"{lake.silver}/{folder}"):
                version = name.removeprefix("version=")
                if version != name and (year, version) not in named:
                    delete_folder(spark, year_folder(lake, year, version))
    pieces = {piece for snapshot in kept for piece in snapshot.pieces}
    for name in folder_names(spark, lake.quarantine):
        if name.startswith("version=") and name.removeprefix("version=") not in pieces:
            delete_folder(spark, f"{lake.quarantine}/{name}")
    bases = {f"base={snapshot.base}" for snapshot in kept}
    for name in folder_names(spark, f"{lake.snapshots}/batches"):
        if name not in bases:
            delete_folder(spark, f"{lake.snapshots}/batches/{name}")
