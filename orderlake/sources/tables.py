"""Reading the lake's tables. A table that was never written is empty; a failed read is an error.

Silver and quarantine are read as the newest snapshot names them: once there is one, a folder of theirs that is
missing is an error.
"""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from orderlake import ledger_store, schemas, snapshots
from orderlake.lake import Lake


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    partitions: str | None = None,
    folder: str | list[str] | None = None,
) -> DataFrame:
    """Parquet table with a declared schema. Fields of `partitions` (DDL) are folder columns. With `folder`,
    one or more paths below the table such as `a=1/b=2`, nothing but those folders is listed."""
    full = schema
    if partitions:
        extra = [f for f in T.StructType.fromDDL(partitions).fields if f.name not in schema.names]
        full = T.StructType(schema.fields + extra)
    try:
        if folder:
            folders = [folder] if isinstance(folder, str) else folder
            paths = [f"{path}/{name}" for name in folders]
            return spark.read.schema(full).option("basePath", path).parquet(*paths)
        return spark.read.schema(full).parquet(path)
    except AnalysisException as failure:
        if failure.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], full)


def read_bronze(
    spark: SparkSession,
    lake: Lake,
    keyed: bool | None = None,
    ingest_batch: str | list[str] | None = None,
    with_batch: bool = False,
) -> DataFrame:
    """The 17 bronze columns, and the batch if asked for. `keyed` and `ingest_batch` (one or several) choose folders,
    not rows: the table is stored apart for rows with and without an order key."""
    batches = [ingest_batch] if isinstance(ingest_batch, str) else ingest_batch
    folder = [f"ingest_batch={name}" for name in batches] if batches else None
    bronze = read_table(
        spark, lake.bronze, schemas.BRONZE_SCHEMA, "ingest_batch STRING, keyed BOOLEAN", folder
    )
    if keyed is not None:
        bronze = bronze.filter(F.col("keyed") == keyed)
    return bronze.select(*schemas.BRONZE_SCHEMA.names, *["ingest_batch"] * with_batch)


def read_silver(spark: SparkSession, lake: Lake) -> DataFrame:
    """The 19 silver columns in contract order (`order_year` is a folder column)."""
    now = snapshots.current_snapshot(spark, lake)
    return snapshots.read_years(spark, lake, schemas.SILVER_SCHEMA, now.years if now else {})


def read_quarantine(spark: SparkSession, lake: Lake) -> DataFrame:
    now = snapshots.current_snapshot(spark, lake)
    return snapshots.read_pieces(spark, lake, schemas.QUARANTINE_SCHEMA, now.pieces if now else [])


def read_layers(spark: SparkSession, lake: Lake) -> tuple[DataFrame, DataFrame]:
    """Silver and quarantine of one and the same snapshot, whatever is written meanwhile."""
    now = snapshots.current_snapshot(spark, lake) or snapshots.Snapshot()
    silver = snapshots.read_years(spark, lake, schemas.SILVER_SCHEMA, now.years)
    return silver, snapshots.read_pieces(spark, lake, schemas.QUARANTINE_SCHEMA, now.pieces)


def read_ledger(spark: SparkSession, lake: Lake) -> DataFrame:
    """Ledger events, not the current state; see operators.ledger.current_state."""
    return ledger_store.all_events(spark, lake).select(*schemas.LEDGER_SCHEMA.names)


def between_dates(silver: DataFrame, first: str, last: str) -> DataFrame:
    """Silver rows ordered within two dates (ISO text, inclusive). The year predicate says nothing
    new, but lets Spark leave out whole year folders."""
    low, high = F.lit(first).cast("date"), F.lit(last).cast("date")
    return silver.filter(
        F.col("order_year").between(F.year(low), F.year(high))
        & F.col("order_date").between(low, high)
    )
