"""Names, folders and small texts in a lake, through the file system that Spark itself uses."""

from pyspark.sql import SparkSession


def hadoop(spark: SparkSession, uri: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, uri: str) -> bool:
    files, path = hadoop(spark, uri)
    return files.exists(path)


def folder_names(spark: SparkSession, uri: str) -> list[str]:
    """Names of what lies right below a folder; none if it does not exist."""
    files, path = hadoop(spark, uri)
    return [entry.getPath().getName() for entry in files.listStatus(path)] if files.exists(path) else []


def bytes_below(spark: SparkSession, uri: str) -> int:
    """Bytes of all files below a folder; 0 if it does not exist."""
    files, path = hadoop(spark, uri)
    return files.getContentSummary(path).getLength() if files.exists(path) else 0


def delete_folder(spark: SparkSession, uri: str) -> None:
    """Delete a folder with all below it, or a file, if it is there."""
    files, path = hadoop(spark, uri)
    files.delete(path, True)


def read_text(spark: SparkSession, uri: str) -> str:
    files, path = hadoop(spark, uri)
    stream = files.open(path)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_new_text(spark: SparkSession, uri: str, text: str) -> None:
    """A small file that is there as a whole or not at all; an error if the name is taken."""
    folder, _, name = uri.rpartition("/")
    files, goal = hadoop(spark, uri)
    _, aside = hadoop(spark, f"{folder}/_new_{name}")
    stream = files.create(aside, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if files.exists(goal) or not files.rename(aside, goal):
        raise FileExistsError(f"{uri} is there already")
