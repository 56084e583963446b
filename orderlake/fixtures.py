"""Inputs for the registered queries and the tests, derived by Spark from the star schema."""

import sys
import tempfile
import uuid
import zipfile
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

from orderlake.functions.paths import LANDING_PREFIX
from orderlake.lake import Lake, tidy_session
from orderlake.schemas import HEADER_MAP

# Tasks get the functions of this module with the job: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Text that a task collects before it hands it on in compressed blocks.
COLLECTED_BYTES = 32 << 20

# Sales-shaped rows with injected defects. The text is valid in Spark and in DuckDB but for the
# date format. Rules: supplier number -> missing or padded region, part number -> missing order
# key, impossible date or bad units.
SALES_SQL = """
select case when l_suppkey%10=3 then null when l_suppkey%10=4 then '  ' when l_suppkey%10=5 then concat(' ',r_name,' ') else r_name end as region,
 n_name as country, p_type as item_type, case when l_returnflag='R' then 'Online' else 'Offline' end as sales_channel,
 substring(o_orderpriority,1,1) as order_priority,
 case when l_partkey%50=7 then '2/30/2020' else {order_date} end as order_date,
 case when l_partkey%40=0 then null when l_partkey%41=0 then '   ' else cast(l_orderkey as varchar(20)) end as order_id,
 {ship_date} as ship_date,
 case when l_partkey%60=1 then 'n/a' when l_partkey%60=2 then '12.7' else cast(cast(l_quantity as int) as varchar(20)) end as units_sold,
 cast(cast(p_retailprice as decimal(18,2)) as varchar(30)) as unit_price,
 cast(cast(p_retailprice as decimal(18,2)) - cast(1 as decimal(18,2)) as varchar(30)) as unit_cost,
 cast(cast(l_extendedprice as decimal(18,2)) as varchar(30)) as total_revenue,
 cast(cast(l_extendedprice as decimal(18,2)) - cast(l_quantity as decimal(18,2)) as varchar(30)) as total_cost,
 cast(cast(l_quantity as decimal(18,2)) as varchar(30)) as total_profit,
 timestamp '2026-01-01 00:00:00' + (l_linenumber * interval '1' hour) as _ingested_at,
 {source_file} as _source_file
from {lineitem} join {orders} on l_orderkey=o_orderkey join {customer} on o_custkey=c_custkey join {nation} on c_nationkey=n_nationkey join {region} on n_regionkey=r_regionkey join {part} on l_partkey=p_partkey
"""

TABLES = ("lineitem", "orders", "customer", "nation", "region", "part")
# Twelve files, as sources with very many rows each.
FEW_FILES = (
    "concat('landing/ingest_date=2026-01-0',cast(1+l_suppkey%3 as varchar(2)),"
    "'/sales_',cast(l_suppkey%4 as varchar(2)),'.zip')"
)
# As many files as the data needs: eight for each thousand parts.
MANY_FILES = (
    "concat('landing/ingest_date=2026-01-0',cast(1+l_orderkey%3 as varchar(2)),"
    "'/sales_',cast(l_partkey-l_partkey%1000 as varchar(20)),'_',"
    "cast(l_orderkey%8 as varchar(2)),'.zip')"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(frame: DataFrame) -> DataFrame:
    """Rows of a table that is stored in fewer pieces than there are cores, over all cores. A table
    in many pieces, as on a cluster, is left as it is."""
    cores = frame.sparkSession.sparkContext.defaultParallelism
    return frame.repartition(cores) if frame.rdd.getNumPartitions() < cores else frame


def sales_sql_duckdb(source_file: str = FEW_FILES) -> str:
    return SALES_SQL.format(
        order_date="strftime(o_orderdate,'%-m/%-d/%Y')",
        ship_date="strftime(l_shipdate,'%-m/%-d/%Y')",
        source_file=source_file,
        **{name: name for name in TABLES},
    )


def sales(spark: SparkSession, sf_dir: str, source_file: str = FEW_FILES) -> DataFrame:
    """Bronze-shaped rows without checksum.

    Spark joins in the order written, and a join of two large tables shuffles all that was joined before. So orders
    get the names of their customer's country first, while there is one narrow row of each, and the rows of
    `lineitem`, the most and the widest, are shuffled by part and by order only.
    """
    frames = {name: table(spark, sf_dir, name) for name in TABLES}
    frames["lineitem"] = spread(frames["lineitem"])
    frames["placed"] = spark.sql(
        "select o_orderkey, o_orderdate, o_orderpriority, n_name, r_name from {orders}"
        " join ({customer} join ({nation} join {region} on n_regionkey=r_regionkey) on c_nationkey=n_nationkey)"
        " on o_custkey=c_custkey",
        **{name: frames.pop(name) for name in ("orders", "customer", "nation", "region")},
    )
    columns, _, _ = SALES_SQL.partition("from {lineitem}")
    joins = "from {lineitem} join {part} on l_partkey=p_partkey join {placed} on l_orderkey=o_orderkey"
    text = (columns + joins).format(
        order_date="date_format(o_orderdate,'M/d/yyyy')",
        ship_date="date_format(l_shipdate,'M/d/yyyy')",
        source_file=source_file,
        **{name: f"{{{name}}}" for name in frames},
    )
    return spark.sql(text, **frames)


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales(spark, sf_dir).withColumn("_checksum_sha256", F.sha2("_source_file", 256))


def stored(rows: DataFrame) -> DataFrame:
    """Rows written once, for a query that reads them several times: each time they would be joined anew."""
    path = f"{scratch_dir(rows.sparkSession)}/rows"
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def scratch_dir(spark: SparkSession) -> str:
    """A new folder for tables a query writes: in the folder the cluster names for checkpoints,
    so that all executors see it; on this machine only where the session names none."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if spark.sparkContext.master.split("[")[0] == "local":
            return tempfile.mkdtemp(prefix="orderlake-")
        shared = spark.conf.get("spark.sql.warehouse.dir")
    if shared.startswith("file:"):
        shared = shared.removeprefix("file:").replace("///", "/", 1)
    return f"{shared.rstrip('/')}/orderlake-{uuid.uuid4().hex}"


def to_csv_lines(rows: DataFrame) -> DataFrame:
    """Bronze-shaped rows -> `_source_file` and the row as a `line` of CSV in source order."""
    keep_spaces = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    return rows.select(
        "_source_file", F.to_csv(F.struct(*HEADER_MAP.values()), keep_spaces).alias("line")
    )


def by_file(lines: DataFrame) -> DataFrame:
    """Lines (`_source_file`, `line`) with all of a file in one partition.

    They are shuffled in blocks of many lines, in order of their files and compressed: about half the bytes of a
    shuffle of rows.
    """
    parts = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def pack(batches):
        held = []

        def flush():
            rows = pa.Table.from_batches(held).sort_by([("part", "ascending"), ("file_hash", "ascending")])
            held.clear()
            runs = pc.run_end_encode(rows.column("part").combine_chunks())
            rows, start = rows.drop_columns(["part", "file_hash"]), 0
            for part, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist()):
                block = pa.BufferOutputStream()
                with pa.ipc.new_stream(block, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                    out.write_table(rows.slice(start, end - start).combine_chunks())
                start = end
                yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "block": [block.getvalue().to_pybytes()]})

        for batch in batches:
            held.append(batch)
            if sum(each.nbytes for each in held) > COLLECTED_BYTES:
                yield from flush()
        if held:
            yield from flush()

    def unpack(batches):
        for batch in batches:
            for block in batch.column("block"):
                yield from pa.ipc.open_stream(block.as_buffer())

    # Names begin alike: their hashes are sorted instead.
    hashed = lines.select("_source_file", "line", F.xxhash64("_source_file").alias("file_hash"))
    dealt = hashed.withColumn("part", F.pmod("file_hash", F.lit(parts)).cast("int"))
    blocks = dealt.mapInArrow(pack, "part INT, block BINARY")
    # The number is given, as adaptive execution would count compressed bytes.
    return blocks.repartition(parts, "part").mapInArrow(unpack, "_source_file STRING, line STRING")


def begin_zip(files, path: str):
    """A new ZIP at `path` and its member, which is to be written; the same texts give the same bytes."""
    archive = zipfile.ZipFile(files.open_output_stream(path), "w")
    # A fixed time stamp.
    info = zipfile.ZipInfo("sales.csv", (2026, 1, 1, 0, 0, 0))
    info.compress_type = zipfile.ZIP_DEFLATED
    info.compress_level = zlib.Z_BEST_SPEED
    return archive, archive.open(info, "w", force_zip64=True)


def end_zip(archive, member) -> None:
    member.close()
    stream = archive.fp
    archive.close()
    stream.close()


def write_zips(lines: DataFrame, root: str) -> DataFrame:
    """Write one ZIP per `_source_file` under `root`, in tasks; returns one row per file.

    A ZIP is written under a temporary name and then renamed, so that a repeated task leaves the
    same file.
    """
    header = ",".join(HEADER_MAP)

    def run(batches):
        files, folder = fs.FileSystem.from_uri(root)
        name = archive = member = None

        def begin(key):
            path = f"{folder}/{key}"
            files.create_dir(path.rpartition("/")[0])
            archive, member = begin_zip(files, f"{path}.part")
            member.write(f"{header}\n".encode())
            return key, archive, member

        def finish():
            end_zip(archive, member)
            files.move(f"{folder}/{name}.part", f"{folder}/{name}")
            return pa.RecordBatch.from_pydict({"landing_key": [name]})

        for batch in batches:
            keys = pc.run_end_encode(batch.column("_source_file"))
            # The lines of a batch lie in one buffer, each with its end: no text is made of them.
            column = batch.column("line")
            _, offsets, data = column.buffers()
            places = np.frombuffer(offsets, np.int32)[column.offset :]
            start = 0
            for key, end in zip(keys.values.to_pylist(), keys.run_ends.to_pylist()):
                if key != name:
                    if member:
                        yield finish()
                    name, archive, member = begin(key)
                member.write(data[places[start] : places[end]])
                start = end
        if member:
            yield finish()

    # Names, and lines of a file, begin alike: their hashes are compared first.
    hashed = by_file(lines).select(
        "*", F.xxhash64("_source_file").alias("file_hash"), F.xxhash64("line").alias("line_hash")
    )
    ordered = hashed.sortWithinPartitions("file_hash", "_source_file", "line_hash", "line")
    ended = ordered.select("_source_file", F.concat("line", F.lit("\n")).alias("line"))
    return ended.mapInArrow(run, "landing_key STRING")


def land_sales(spark: SparkSession, sf_dir: str, root: str) -> int:
    """The sales rows as ZIPs in the landing folder of a lake at `root`; returns their number."""
    rows = sales(tidy_session(spark), sf_dir, MANY_FILES)
    return write_zips(to_csv_lines(rows), root).count()


def in_tasks(keys: DataFrame, root: str, do) -> int:
    """Call `do` with pyarrow's file system, the root in it, and the `landing_key` of each ZIP, in tasks; returns their
    number. All keys are listed before the first call."""

    def run(batches):
        files, folder = fs.FileSystem.from_uri(root)
        for batch in batches:
            for key in batch.column(0).to_pylist():
                do(files, folder, key)
            yield batch

    tasks = 4 * keys.sparkSession.sparkContext.defaultParallelism
    return keys.select("landing_key").repartition(tasks, "landing_key").mapInArrow(run, "landing_key STRING").count()


def double_lines(keys: DataFrame, root: str) -> int:
    """Replace each ZIP of `write_zips` (`landing_key`) under its name by one with each line twice; returns their
    number. The bytes are those that `write_zips` makes of all lines twice.

    The new ZIPs are written beside the old ones, and take their places when all are there: a repeated task doubles
    nothing twice.
    """

    def write(files, folder, key):
        with files.open_input_file(f"{folder}/{key}") as source, zipfile.ZipFile(source) as old:
            with old.open("sales.csv") as lines:
                archive, member = begin_zip(files, f"{folder}/{key}.twice")
                member.write(next(lines))
                for line in lines:
                    member.write(line + line)
                end_zip(archive, member)

    def replace(files, folder, key):
        if files.get_file_info(f"{folder}/{key}.twice").type == fs.FileType.File:
            files.move(f"{folder}/{key}.twice", f"{folder}/{key}")

    in_tasks(keys, root, write)
    return in_tasks(keys, root, replace)


def damage_zips(keys: DataFrame, root: str) -> int:
    """Overwrite 64 bytes in the data of each ZIP (`landing_key`), in tasks; returns their number."""

    def run(batches):
        for batch in batches:
            for key in batch.column(0).to_pylist():
                files, path = fs.FileSystem.from_uri(f"{root}/{key}")
                with files.open_input_file(path) as source:
                    content = bytearray(source.read())
                start = len(content) // 3
                content[start : start + 64] = bytes(64)
                with files.open_output_stream(path) as target:
                    target.write(bytes(content))
            yield batch

    return keys.select("landing_key").mapInArrow(run, "landing_key STRING").count()


def land_copies(keys: DataFrame, lake: Lake) -> int:
    """Let a copy of each landed ZIP (`landing_key`) land under another name; returns their number."""
    again = f"{LANDING_PREFIX}again/"

    def copy(files, folder, key):
        path = f"{folder}/{again}{key.removeprefix(LANDING_PREFIX)}"
        files.create_dir(path.rpartition("/")[0])
        files.copy_file(f"{folder}/{key}", f"{path}.part")
        files.move(f"{path}.part", path)

    return in_tasks(keys.filter(~F.col("landing_key").startswith(again)), lake.root, copy)


def document_files(documents: DataFrame) -> DataFrame:
    """Documents as landed files: the text is the content, a copy of a text a copy of a file."""
    key = F.concat(
        F.lit(f"{LANDING_PREFIX}ingest_date=2026-02-"),
        F.lpad((F.col("doc_id") % 28 + 1).cast("string"), 2, "0"),
        F.lit("/doc_"),
        F.col("doc_id").cast("string"),
        F.lit(".zip"),
    )
    return documents.select(
        "doc_id",
        key.alias("path"),
        key.alias("landing_key"),
        F.timestamp_add("SECOND", (F.col("doc_id") % 100).cast("int"),
                        F.lit("2026-02-01 00:00:00").cast("timestamp")).alias("landed_at"),
        F.octet_length("text").cast("bigint").alias("size_bytes"),
        F.sha2("text", 256).alias("checksum_sha256"),
    )
