"""Offered files -> the landing folder, each content once."""

import sys
import uuid
from datetime import datetime, timezone

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from orderlake.functions.paths import ZIP_SUFFIX, iso_utc, landing_name
from orderlake.lake import Lake
from orderlake.operators import ledger as L
from orderlake.plans.ingest import known_state, next_seq, reused
from orderlake.sinks.tables import append_ledger_of_many_batches
from orderlake.sources.archives import checksum, spread
from orderlake.sources.files import located
from orderlake.sources.landing import scan_landing

cloudpickle.register_pickle_by_value(sys.modules[__name__])

DECISION = T.StructType([T.StructField(n, T.StringType()) for n in ("path", "checksum_sha256", "decision", "landing_key")])


def with_checksums(files: DataFrame) -> DataFrame:
    """Add the SHA-256 of each file at `path`, read in chunks by a task."""
    schema = T.StructType([*files.schema.fields, T.StructField("checksum_sha256", T.StringType())])

    def run(batches):
        for batch in batches:
            sums = []
            for uri in batch.column("path").to_pylist():
                opened, path = located(uri)
                with opened.open_input_file(path) as source:
                    sums.append(checksum(source))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sums, pa.string())], schema.names)

    return spread(files).mapInArrow(run, schema)


def copy_to_landing(files: DataFrame, lake: Lake) -> DataFrame:
    """Copy each file at `path` to its `landing_key`, in tasks, under a temporary name first."""
    root = lake.root

    def run(batches):
        for batch in batches:
            for uri, key in zip(batch.column("path").to_pylist(), batch.column("landing_key").to_pylist()):
                source, origin = located(uri)
                target, goal = located(f"{root}/{key}")
                target.create_dir(goal.rpartition("/")[0])
                with source.open_input_stream(origin) as reader, target.open_output_stream(f"{goal}.part") as writer:
                    while chunk := reader.read(8 << 20):
                        writer.write(chunk)
                target.move(f"{goal}.part", goal)
            yield batch

    return spread(files).mapInArrow(run, files.schema)


def admit_folder(spark: SparkSession, lake: Lake, offered: str, moment: datetime | None = None) -> DataFrame:
    """Decide about every ZIP in the folder `offered`; land what is new and put its item into the ledger.

    Returns `path`, `checksum_sha256`, `decision` and, of admitted files, `landing_key`. The name of a landed
    file is that of its arrival plus the start of its checksum, as many files arrive at one moment. Run again
    after a crash: files are copied to the same names or, if their items were put, not again.
    """
    now = F.lit(moment or datetime.now(timezone.utc))
    listed = scan_landing(spark, lake, offered).select(
        "path", F.col("modificationTime").alias("landed_at"), F.col("length").alias("size_bytes")
    )
    with reused(with_checksums(listed)) as files:
        state = known_state(spark, lake, files)
        plain = F.regexp_replace(landing_name(now), r"\.zip$", "_")
        key = F.concat(plain, F.substring("checksum_sha256", 1, 12), F.lit(ZIP_SUFFIX))
        decided = L.admit(files, state).withColumn(
            "landing_key", F.when(F.col("decision") == L.UPLOADED, key)
        )
        with reused(decided) as decided:
            admitted = decided.filter(F.col("decision") == L.UPLOADED)
            if not admitted.isEmpty():
                seq = next_seq(spark, lake)
                puts = L.register_uploads(copy_to_landing(admitted, lake), F.lit(seq), iso_utc(now))
                append_ledger_of_many_batches(puts, lake, seq)
            # The decisions as they were made: the ledger knows these files from now on.
            path = f"{lake.admissions}/admission={uuid.uuid4().hex}"
            decided.select(*DECISION.names).write.parquet(path)
            return spark.read.schema(DECISION).parquet(path)
