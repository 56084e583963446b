"""Tables between the steps of an operator, and what a Python worker keeps between its tasks.

A step that several later ones read, or that ends an iteration, is written as Parquet below the folder
that the cluster names in `spark.checkpoint.dir`: its rows are then fixed, its lineage is cut, and a lost
executor costs nothing of what came before.
"""

import atexit
import os
import shutil
import sys
import tempfile
import types
import uuid

from pyspark.sql import DataFrame, SparkSession, types as T

_own: dict[str, str] = {}


def struct(ddl: str) -> T.StructType:
    """A flat schema from `name type, name type`, without a session."""
    schema = T.StructType()
    for field in ddl.split(", "):
        schema.add(*field.split(" "))
    return schema


def shared_folder(spark: SparkSession) -> str:
    """`spark.checkpoint.dir`. Where it is unset, a temporary folder if all runs on this machine, else a
    folder of the warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if spark.sparkContext.master.split("[")[0] != "local":
        return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    if "local" not in _own:
        _own["local"] = tempfile.mkdtemp(prefix="orderlake-llm-")
        atexit.register(shutil.rmtree, _own["local"], ignore_errors=True)
    return _own["local"]


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stage(frame: DataFrame, name: str) -> DataFrame:
    """Write the frame and read it again."""
    folder = new_folder(frame.sparkSession, name)
    frame.write.option("compression", "zstd").parquet(folder)
    staged = frame.sparkSession.read.schema(frame.schema).parquet(folder)
    staged._scratch_folder = folder
    return staged


def drop(*staged: DataFrame) -> None:
    """Delete staged tables that nothing reads any more."""
    for frame in staged:
        folder = getattr(frame, "_scratch_folder", None)
        if folder:
            spark = frame.sparkSession
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def local_uri(uri: str) -> str:
    """A URI as pyarrow's file systems read it: `file:/x` becomes `file:///x`, `s3a` is `s3`."""
    if uri.startswith("file:") and not uri.startswith("file://"):
        return "file://" + uri.removeprefix("file:")
    if uri.startswith("s3a:"):
        return "s3" + uri.removeprefix("s3a")
    return uri if "://" in uri else "file://" + os.path.abspath(uri)


def worker_cache(key) -> dict:
    """A dictionary that lives as long as the Python worker, so that its tasks share what they looked
    up. Its users bound its size."""
    name = "orderlake_worker_cache"
    module = sys.modules.setdefault(name, types.ModuleType(name))
    return module.__dict__.setdefault("caches", {}).setdefault(key, {})
