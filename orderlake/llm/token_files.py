"""Token ids as shard files with a minimal perfect hash index.

A shard is two files. `<shard>.ids` holds nothing but ids, two or four bytes each, document after document
in ascending key order, so a trainer can map it into memory. `<shard>.idx` holds, after a header, the keys in
that order and an index from key to place: a minimal perfect hash (a bit per candidate slot on a few levels,
ranks by prefix counts) gives each key a slot of its own, and the slot stores a 32-bit fingerprint of the key,
its offset and its length. A lookup costs the same however large the shard is, and a key that is not there is
turned away by its fingerprint, then by the stored key itself.

Shards are ranges of keys, cut by Spark; the manifest gives each one's range and the number of ids before it.
"""

import uuid

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from orderlake.llm.encode import Encoder, ids_crc32, read_tokenizer, arrow_groups
from orderlake.llm.scratch import local_uri, new_folder, stage, struct

# Documents of one shard, and how many slots a level offers per key.
SHARD_BYTES = 64 << 20
SPREAD = 2
MAGIC = b"OLTOKENS"

MANIFEST = struct(
    "shard integer, name string, n_docs long, n_ids long, first_key long, last_key long"
)


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit mix of integer keys (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15) * np.uint64(seed + 1)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Distinct keys -> 0 .. n-1, one each. Any other key gets some slot or -1.

    On each level the keys that are left are hashed to `SPREAD` slots per key; a slot that one key alone
    hits is marked, the others' keys go on to the next level. A key's number is the count of marks before
    its own.
    """

    def __init__(self, sizes, marks):
        self.sizes, self.marks = [int(s) for s in sizes], marks
        self.base = np.concatenate([[0], np.cumsum(self.sizes)]).astype(np.int64)
        self.ranks = np.concatenate([[0], np.cumsum(marks, dtype=np.int64)])

    @classmethod
    def build(cls, keys: np.ndarray) -> "PerfectHash":
        sizes, levels = [], []
        while len(keys):
            size = max(2, SPREAD * len(keys))
            slot = (mixed(keys, len(sizes)) % np.uint64(size)).astype(np.int64)
            marks = np.bincount(slot, minlength=size) == 1
            keys = keys[~marks[slot]]
            sizes.append(size)
            levels.append(marks)
        return cls(sizes, np.concatenate(levels) if levels else np.zeros(0, bool))

    def find(self, keys: np.ndarray) -> np.ndarray:
        found = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, size in enumerate(self.sizes):
            place = self.base[level] + (mixed(keys[left], level) % np.uint64(size)).astype(np.int64)
            hit = self.marks[place]
            found[left[hit]] = self.ranks[place[hit]]
            left = left[~hit]
        return found


def write_index(keys: np.ndarray, lengths: np.ndarray, nulls: int, width: int) -> bytes:
    """The `.idx` file. The hash finds the first document of each key; the `nulls` documents without a
    key come first and are found by none."""
    indexed = np.concatenate([[True], keys[1:] != keys[:-1]])
    indexed[:nulls] = False
    indexed[nulls : nulls + 1] = True
    starts = np.concatenate([[0], np.cumsum(lengths)])[:-1].astype("<i8")
    own = keys[indexed]
    table = PerfectHash.build(own)
    slot = table.find(own)
    prints, rows = np.zeros(len(own), "<u4"), np.zeros(len(own), "<i8")
    prints[slot] = (mixed(own, 1 << 20) >> np.uint64(32)).astype(np.uint32)
    rows[slot] = np.flatnonzero(indexed)
    head = np.array([width, nulls, len(keys), len(own), len(table.sizes), len(table.marks)], "<i8")
    parts = [head, np.array(table.sizes, "<i8"), np.packbits(table.marks), prints, rows]
    return MAGIC + b"".join(p.tobytes() for p in [*parts, keys.astype("<i8"), starts, lengths.astype("<i8")])


class Shard:
    """One shard, read. `rows` finds keys through the hash; `ids` reads one document's ids."""

    def __init__(self, files: fs.FileSystem, path: str):
        with files.open_input_file(f"{path}.idx") as source:
            raw = source.read()
        if raw[: len(MAGIC)] != MAGIC:
            raise ValueError(f"{path}.idx is no token index")
        at = len(MAGIC)

        def take(kind, count):
            nonlocal at
            part = np.frombuffer(raw, kind, count, at)
            at += part.nbytes
            return part

        width, self.nulls, n, n_keys, levels, bits = take("<i8", 6).tolist()
        sizes = take("<i8", levels)
        marks = np.unpackbits(take(np.uint8, -(-bits // 8)), count=bits).astype(bool)
        self.hash = PerfectHash(sizes, marks)
        self.prints, self.slots = take("<u4", n_keys), take("<i8", n_keys)
        self.keys, self.starts, self.lengths = (take("<i8", n) for _ in range(3))
        self.dtype = np.dtype(f"<u{width}")
        self.files, self.path, self.payload = files, path, None

    def rows(self, keys: np.ndarray) -> np.ndarray:
        """Row of each key in this shard, -1 where it has none."""
        slot = self.hash.find(keys)
        seen = slot >= 0
        known = np.zeros(len(keys), bool)
        known[seen] = self.prints[slot[seen]] == (
            mixed(keys[seen], 1 << 20) >> np.uint64(32)
        ).astype(np.uint32)
        found = np.full(len(keys), -1, np.int64)
        found[known] = self.slots[slot[known]]
        found[known] = np.where(self.keys[found[known]] == keys[known], found[known], -1)
        return found

    def ids(self, row: int) -> np.ndarray:
        if self.payload is None:
            self.payload = self.files.open_input_file(f"{self.path}.ids")
        width = self.dtype.itemsize
        self.payload.seek(int(self.starts[row]) * width)
        return np.frombuffer(self.payload.read(int(self.lengths[row]) * width), self.dtype)

    def close(self) -> None:
        if self.payload is not None:
            self.payload.close()


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int = 2, shards: int | None = None
) -> DataFrame:
    """Encode whole texts, append `end_id`, write shards under `folder`; returns the staged manifest.

    `docs` needs an integer `doc_id` and `text` (null: empty); other columns are not read. Documents of
    equal id lie side by side, ordered by a hash of the text; the index finds the first of them. Those
    without an id come first and are read in order only. No documents: no shard. A shard is written under a temporary name
    and renamed, so a repeated task leaves the same files.
    """
    spark = docs.sparkSession
    content = read_tokenizer(spark, tokenizer)
    uri = local_uri(folder)
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    if shards is None:
        size = keyed.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
        shards = max(1, -(-size // SHARD_BYTES), min(spark.sparkContext.defaultParallelism, size >> 20))
    # Text as a second key lets a range end between two documents of equal id.
    ranged = keyed.repartitionByRange(shards, "doc_id", F.xxhash64("text")).sortWithinPartitions(
        "doc_id", F.xxhash64("text")
    )

    def run(batches):
        from pyspark import TaskContext

        files, root = fs.FileSystem.from_uri(uri)
        number = TaskContext.get().partitionId()
        encoder, keys, lengths = Encoder(content.value), [], []
        name = f"shard-{number:06d}"
        draft = f"{root}/.{name}-{uuid.uuid4().hex}"
        files.create_dir(root)
        out = None
        for batch in batches:
            ids_of, texts = batch.column(0).to_pylist(), batch.column(1)
            for first, last in arrow_groups(texts):
                out = out or files.open_output_stream(f"{draft}.ids")
                end = np.array([end_id], encoder.dtype).tobytes()
                bodies = encoder.encode(texts.slice(first, last - first))
                for key, body in zip(ids_of[first:last], bodies):
                    out.write(body.tobytes() + end)
                    keys.append(key)
                    lengths.append(len(body) + 1)
        if out is None:
            return
        out.close()
        nulls = sum(key is None for key in keys)
        ends = [keys[nulls], keys[-1]] if nulls < len(keys) else [None, None]
        keys = np.array([0] * nulls + keys[nulls:], np.int64)
        lengths = np.array(lengths, np.int64)
        with files.open_output_stream(f"{draft}.idx") as index:
            index.write(write_index(keys, lengths, nulls, encoder.dtype.itemsize))
        for kind in ("ids", "idx"):
            files.move(f"{draft}.{kind}", f"{root}/{name}.{kind}")
        row = [[number], [name], [len(keys)], [int(lengths.sum())], ends[:1], ends[1:]]
        types = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(v, t) for v, t in zip(row, types)], MANIFEST.names
        )

    manifest = stage(ranged.mapInArrow(run, MANIFEST), "token-manifest")
    return with_starts(manifest)


def with_starts(manifest: DataFrame) -> DataFrame:
    """Add `start`, the ids before each shard. One short row per shard meets in one task."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_documents(manifest: DataFrame, folder: str) -> DataFrame:
    """Every document of the files, in key order within a shard, each found through the index:
    `doc_id, start, n_tokens, ids_crc32`. Shards are spread over the tasks."""
    uri = local_uri(folder)
    schema = T.StructType.fromDDL("doc_id long, start long, n_tokens long, ids_crc32 long")

    def run(batches):
        files, root = fs.FileSystem.from_uri(uri)
        for batch in batches:
            for name, start in zip(batch["name"].to_pylist(), batch["start"].to_pylist()):
                shard = Shard(files, f"{root}/{name}")
                nulls, keys = shard.nulls, shard.keys[shard.nulls :]
                # Behind the first document of a key follow the others of that key.
                same = np.concatenate([[0], np.cumsum(keys[1:] != keys[:-1])])[: len(keys)]
                found = shard.rows(keys) + np.arange(len(keys)) - np.searchsorted(same, same)
                rows = np.concatenate([np.arange(nulls), found])
                for low in range(0, len(rows), 4096):
                    some = rows[low : low + 4096]
                    crc = [ids_crc32(shard.ids(row)) for row in some.tolist()]
                    columns = [start + shard.starts[some], shard.lengths[some], crc]
                    columns = [pa.array(c, pa.int64()) for c in columns]
                    key = pa.array(shard.keys[some], pa.int64(), mask=some < nulls)
                    yield pa.RecordBatch.from_arrays([key, *columns], schema.names)
                shard.close()

    shards = max(1, manifest.count())
    return manifest.select("shard", "name", "start").repartition(shards, "shard").mapInArrow(run, schema)


def lookup(keys: DataFrame, manifest: DataFrame, folder: str, column: str = "doc_id") -> DataFrame:
    """Ids of given documents: `doc_id`, `shard`, `ids`; one row per asked key that exists.

    A key is sent to the shards whose range holds it and found there in constant time. The ranges are one
    row per shard; a range join over them is left to Spark.
    """
    uri = local_uri(folder)
    schema = T.StructType.fromDDL("doc_id long, shard int, ids array<int>")
    asked = keys.select(F.col(column).cast("long").alias("doc_id")).filter("doc_id is not null")
    placed = asked.distinct().join(
        manifest.select("shard", "name", "first_key", "last_key"),
        F.col("doc_id").between(F.col("first_key"), F.col("last_key")),
    )

    def run(table: pa.Table) -> pa.Table:
        files, root = fs.FileSystem.from_uri(uri)
        shard = Shard(files, f"{root}/{table['name'][0].as_py()}")
        wanted = table["doc_id"].to_numpy()
        rows = shard.rows(wanted)
        wanted, rows = wanted[rows >= 0], rows[rows >= 0]
        found = [shard.ids(row).astype(np.int32) for row in rows.tolist()]
        shard.close()
        number = table["shard"][0].as_py()
        return pa.table(
            [
                pa.array(wanted, pa.int64()),
                pa.array([number] * len(wanted), pa.int32()),
                pa.array(found, pa.list_(pa.int32())),
            ],
            schema.names,
        )

    found = placed.groupBy("shard").applyInArrow(run, schema)
    # Documents of one id may lie on both sides of a cut: the first shard's counts.
    return found.groupBy("doc_id").agg(F.min_by(F.struct("shard", "ids"), "shard").alias("x")).select(
        "doc_id", "x.shard", "x.ids"
    )


def token_table(spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Write the documents to new files in the shared folder and read every one back."""
    folder = new_folder(spark, "token-files")
    return read_documents(write_token_files(docs, folder, tokenizer, end_id), folder)
