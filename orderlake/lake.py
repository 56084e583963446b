"""Where each table of one lake lives, and the Spark settings the jobs are meant to run under."""

from dataclasses import dataclass

# Asked for when a session is built (bench, tests, spark-submit). The operators never change a
# running session, and none of them needs these for right results, only for good file and
# partition sizes.
SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "134217728",
    "spark.sql.files.maxPartitionBytes": "134217728",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.session.timeZone": "UTC",
    # Spares the driver a stack trace for every column expression it builds.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

TARGET_FILE_BYTES = 134217728


INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
# Deletes the files of an action's shuffles when it ends, not when the driver happens to collect its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shuffle_partitions(data_bytes: int, least: int = 200) -> int:
    """Partitions of a shuffle of rows of this size.

    Adaptive execution joins shuffle partitions that turn out small but cannot divide one that is too
    large for a window, so a refresh starts with many: one per two target files, never
    fewer than Spark's default. Beyond 100,000 the number of shuffle blocks would cost more than
    larger partitions, which sort on disk.
    """
    return min(max(least, -(-data_bytes // (2 * TARGET_FILE_BYTES))), max(least, 100_000))


def sized_conf(bronze_bytes: int) -> dict[str, str]:
    """The settings for a session that refreshes a bronze table of this size."""
    return SESSION_CONF | {INITIAL_PARTITIONS: str(shuffle_partitions(bronze_bytes))}


def tidy_session(spark):
    """A session beside the given one, with its settings, that keeps no shuffle files beyond the action that made
    them. The given session stays as it is.

    For steps that end in a written table: without it the shuffles of all steps add up on disk.
    """
    session = spark.newSession()
    there = session.conf.getAll
    for name, value in spark.conf.getAll.items():
        if there.get(name) != value and session.conf.isModifiable(name):
            session.conf.set(name, value)
    session.conf.set(SHUFFLE_CLEANUP, "true")
    return session


def sized_session(spark, data_bytes: int):
    """A tidy session whose shuffles are cut for rows of this size."""
    session = tidy_session(spark)
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    partitions = str(shuffle_partitions(data_bytes, least))
    for name in ("spark.sql.shuffle.partitions", INITIAL_PARTITIONS):
        session.conf.set(name, partitions)
    return session


@dataclass(frozen=True)
class Lake:
    """Folders of one lake. `root` is any URI that Spark can read and write."""

    root: str

    def __post_init__(self):
        object.__setattr__(self, "root", self.root.rstrip("/"))

    @property
    def landing(self):
        return f"{self.root}/landing"

    @property
    def archive(self):
        return f"{self.root}/archive"

    @property
    def bronze(self):
        return f"{self.root}/bronze"

    @property
    def silver(self):
        return f"{self.root}/silver"

    @property
    def quarantine(self):
        return f"{self.root}/quarantine"

    @property
    def snapshots(self):
        return f"{self.root}/snapshots"

    @property
    def changes(self):
        return f"{self.root}/_changes"

    @property
    def ledger(self):
        return f"{self.root}/ledger"

    @property
    def ledger_state(self):
        return f"{self.root}/ledger_state"

    @property
    def pending(self):
        return f"{self.root}/pending"

    @property
    def runs(self):
        return f"{self.root}/_runs"

    @property
    def admissions(self):
        return f"{self.root}/admissions"

    @property
    def failures(self):
        return f"{self.root}/failures"

    @property
    def manifest(self):
        return f"{self.root}/manifest"

    @property
    def load_report(self):
        return f"{self.root}/load_report"

    @property
    def refresh_report(self):
        return f"{self.root}/refresh_report"
