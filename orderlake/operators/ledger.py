"""The ledger: which contents were seen, and how far each of them came.

A file is known by the SHA-256 of its bytes, never by its name. The ledger is an append-only table
of events; an item is what its events say together. Decisions come in two kinds that stay apart:
admission (is an offered file new?) and ingestion (what is left to do for a landed file?).
"""

from pyspark.sql import Column, DataFrame, functions as F

from orderlake.schemas import LEDGER_ATTRIBUTES, LEDGER_SCHEMA

# The states of a ledger item, and the outcomes of the two decisions.
UPLOADED, PROCESSING, BRONZE_LOADED, COMPLETED = (
    "uploaded", "processing", "bronze_loaded", "completed",
)
SKIPPED_DUPLICATE = "skipped_duplicate"
PROCESS, RECOVERED, SKIPPED = "PROCESS", "RECOVERED", "SKIPPED"

FILE_KEY = ["checksum_sha256", "path"]


def first_copies(files: DataFrame) -> DataFrame:
    """Per content the copy that landed first (then lowest path): checksum_sha256, path.

    An aggregate, not a window: copies are combined before the shuffle, so a content of very many
    copies never meets in one task.
    """
    first = F.min(F.struct("landed_at", "path")).alias("first")
    return files.groupBy("checksum_sha256").agg(first).select(
        "checksum_sha256", F.col("first.path").alias("path")
    )


def mark_first_copies(files: DataFrame) -> DataFrame:
    """Files with `is_first_copy`. Paths must be unique among files of one checksum.

    The marks are joined back by path and checksum, which no two files share, and so without skew.
    """
    marks = first_copies(files).withColumn("_first", F.lit(True))
    return files.join(marks, FILE_KEY, "left").withColumn(
        "is_first_copy", F.col("_first").isNotNull()
    ).drop("_first")


def _decide(files: DataFrame, state: DataFrame, name: str, decision: Column, later_copy: str):
    """Decide for the first copy of each content by the ledger; its other copies come too late."""
    known = state.select("checksum_sha256", "status")
    decided = (
        first_copies(files)
        .join(known, "checksum_sha256", "left")
        .select(*FILE_KEY, decision.alias(name))
    )
    return files.join(decided, FILE_KEY, "left").withColumn(
        name, F.coalesce(name, F.lit(later_copy))
    )


def admit(files: DataFrame, state: DataFrame) -> DataFrame:
    """Offered files with `decision`: `skipped_duplicate` if the content is registered in any
    state, `uploaded` otherwise."""
    registered = F.col("status").isin(UPLOADED, PROCESSING, BRONZE_LOADED, COMPLETED)
    decision = F.when(registered, SKIPPED_DUPLICATE).otherwise(UPLOADED)
    return _decide(files, state, "decision", decision, SKIPPED_DUPLICATE)


def plan_ingest(files: DataFrame, state: DataFrame) -> DataFrame:
    """Landed files with `action`: `SKIPPED` if completed, `RECOVERED` if only the steps after the
    bronze load are left, `PROCESS` otherwise (also when an earlier run stopped while processing)."""
    action = (
        F.when(F.col("status") == COMPLETED, SKIPPED)
        .when(F.col("status") == BRONZE_LOADED, RECOVERED)
        .otherwise(PROCESS)
    )
    return _decide(files, state, "action", action, SKIPPED)


def accepted(admitted: DataFrame, state: DataFrame) -> DataFrame:
    """First copies whose content the ledger has no registered state of: what `admit` lets in."""
    registered = state.filter(
        F.col("status").isin(UPLOADED, PROCESSING, BRONZE_LOADED, COMPLETED)
    )
    firsts = first_copies(admitted).join(registered, "checksum_sha256", "left_anti")
    return admitted.join(firsts, FILE_KEY, "left_semi")


def ledger_events(rows: DataFrame, op: str, seq: Column, **attributes: Column) -> DataFrame:
    """Rows with a `checksum_sha256` -> ledger events that put or set the given attributes."""
    unknown = set(attributes) - set(LEDGER_ATTRIBUTES.names)
    if unknown:
        raise ValueError(f"not a ledger attribute: {sorted(unknown)}")
    values = {"seq": seq, "op": F.lit(op), "checksum_sha256": F.col("checksum_sha256")}
    values |= attributes
    return rows.select(
        *[
            values.get(field.name, F.lit(None)).cast(field.dataType).alias(field.name)
            for field in LEDGER_SCHEMA.fields
        ]
    )


def register_uploads(files: DataFrame, seq: Column, uploaded_at: Column) -> DataFrame:
    """Events that put an admitted file's item, replacing whatever the ledger had."""
    return ledger_events(
        files, "put", seq, status=F.lit(UPLOADED), landing_key=F.col("landing_key"),
        uploaded_at=uploaded_at, size_bytes=F.col("size_bytes"),
    )


def mark_processing(files: DataFrame, seq: Column, started_at: Column) -> DataFrame:
    return ledger_events(
        files, "set", seq, status=F.lit(PROCESSING), landing_key=F.col("landing_key"),
        processing_started_at=started_at,
    )


def mark_bronze_loaded(loaded: DataFrame, seq: Column, loaded_at: Column) -> DataFrame:
    return ledger_events(
        loaded, "set", seq, status=F.lit(BRONZE_LOADED), landing_key=F.col("landing_key"),
        bronze_loaded_at=loaded_at, bronze_row_count=F.col("row_count"),
    )


def mark_completed(
    files: DataFrame, seq: Column, completed_at: Column, archive_key: Column, silver_run_id: Column
) -> DataFrame:
    return ledger_events(
        files, "set", seq, status=F.lit(COMPLETED), completed_at=completed_at,
        archive_key=archive_key, silver_run_id=silver_run_id,
    )


def current_state(events: DataFrame, attributes: list[str] | None = None) -> DataFrame:
    """One row per checksum: the last value of every attribute (or of some) since the last put.

    One aggregate without window or join. Of each attribute the last value ever set is kept with
    its `seq`; a put after it has cleared it.
    """
    names = attributes or LEDGER_ATTRIBUTES.names
    last = [
        F.max(F.when(F.col(name).isNotNull(), F.struct("seq", name))).alias(name)
        for name in names
    ]
    last_put = F.max(F.when(F.col("op") == "put", F.col("seq"))).alias("_last_put")
    folded = events.groupBy("checksum_sha256").agg(last_put, *last)
    return folded.select(
        "checksum_sha256",
        *[
            F.when(
                F.col("_last_put").isNull() | (F.col(f"{name}.seq") >= F.col("_last_put")),
                F.col(f"{name}.{name}"),
            ).alias(name)
            for name in names
        ],
    )


def ledger_listing(state: DataFrame) -> DataFrame:
    return state.select(
        F.col("checksum_sha256").alias("checksum"),
        "status",
        F.col("landing_key").alias("landing"),
        F.col("archive_key").alias("archive"),
        F.col("bronze_row_count").alias("rows"),
    )
