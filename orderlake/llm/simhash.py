"""Near-duplicates by SimHash fingerprints within two bits.

Fingerprints that differ in at most two bits differ in at most two of their eight bytes, so they share at
least six positional bytes. The inverted index is over positional bytes: they are taken in four groups of two
positions, of which two at least are left whole, and a list is the fingerprints with equal bytes in one pair
of groups (six lists per fingerprint, by 32 bits each; lists of one byte would each hold 1/256 of the
corpus). Within a list the shared positional bytes of each pair are tallied over all eight positions, pairs with
six or more are kept, and their bits are compared.

Only distinct fingerprints are indexed, so exact copies cost nothing. A list longer than `LONG_LIST`, as a large
family of near copies makes, is not paired off: its fingerprints are linked through all values one bit away
from them. Two fingerprints have such a value in common just if they are within two bits, so nothing is
missed or added, and the work is 65 rows per fingerprint however long the list is.
"""

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from orderlake.llm.components import connected_components
from orderlake.llm.scratch import stage
from orderlake.llm.words import words

WIDTH = 3
SEED = 42
RADIUS = 2
POSITIONS = 8
LONG_LIST = 32
CHUNK = 1 << 16


def shingle_digests(text: str | None, width: int) -> bytes:
    """XXH64 digests of the space-joined shingles one after another, repeats included."""
    found = words(text)
    if not found:
        return b""
    joined = b" ".join(found)
    if len(found) <= width:
        return xxhash.xxh64_digest(joined, SEED)
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    del found
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[: 1 - width or None].tolist()
    digest = xxhash.xxh64_digest
    return b"".join([digest(joined[a:b], SEED) for a, b in zip(starts, ends[width - 1 :].tolist())])


def fingerprint(text: str | None, width: int = WIDTH) -> bytes:
    """Eight bytes, the highest bit first. A bit is set if over half of the hashes set it."""
    raw = np.frombuffer(shingle_digests(text, width), np.uint8).reshape(-1, POSITIONS)
    totals = np.zeros(64, np.int64)
    # Bits of a bounded number of hashes are spread out at a time, whatever the text's length.
    for low in range(0, len(raw), CHUNK):
        totals += np.unpackbits(raw[low : low + CHUNK], axis=1).sum(axis=0, dtype=np.int32)
    return np.packbits(2 * totals > len(raw)).tobytes()


def with_fingerprint(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """`docs` without its text, with `fp`, the fingerprint as a long."""
    kept = [name for name in docs.columns if name != "text"]
    schema = T.StructType(
        [docs.schema[name] for name in kept] + [T.StructField("fp", T.LongType())]
    )

    def run(batches):
        for batch in batches:
            column = batch.column(batch.schema.get_field_index("text"))
            found = [fingerprint(text.as_py(), width) for text in column]
            fps = np.frombuffer(b"".join(found), ">i8").astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(n)) for n in kept), pa.array(fps)],
                schema.names,
            )

    return docs.mapInArrow(run, schema)


def byte_at(value: Column, position: int) -> Column:
    return F.shiftrightunsigned(value, 8 * (POSITIONS - 1 - position)).bitwiseAND(F.lit(255))


def postings(distinct: DataFrame) -> DataFrame:
    """`fp` -> its lists: `block` (which positions) and `key` (the bytes there)."""
    groups = [(2 * g, 2 * g + 1) for g in range(RADIUS + 2)]
    lists = []
    for number, (a, b) in enumerate(combinations(groups, 2)):
        key = F.lit(0).cast("long")
        for position in (*a, *b):
            key = F.shiftleft(key, 8).bitwiseOR(byte_at(F.col("fp"), position))
        lists.append(F.struct(F.lit(number).alias("block"), key.alias("key")))
    return distinct.select("fp", F.explode(F.array(*lists)).alias("x")).select("fp", "x.*")


def shared_bytes(a: Column, b: Column) -> Column:
    differ = a.bitwiseXOR(b)
    same = [F.when(byte_at(differ, p) == 0, 1).otherwise(0) for p in range(POSITIONS)]
    return sum(same[1:], same[0])


def links(distinct: DataFrame, long_list: int = LONG_LIST) -> DataFrame:
    """Links that give the components of "within two bits" over distinct `fp`: columns `a`, `b`."""
    entries = postings(distinct)
    lengths = entries.groupBy("block", "key").agg(F.count("*").alias("n")).filter("n > 1")
    found = stage(entries.join(lengths, ["block", "key"]), "postings")

    short = found.filter(F.col("n") <= long_list)
    left = short.select("block", "key", F.col("fp").alias("a"))
    right = short.select("block", "key", F.col("fp").alias("b"))
    a, b = F.col("a"), F.col("b")
    pairs = (
        left.join(right, ["block", "key"])
        .filter(a < b)
        .filter(shared_bytes(a, b) >= POSITIONS - RADIUS)
        .filter(F.bit_count(a.bitwiseXOR(b)) <= RADIUS)
        .select("a", "b")
    )

    crowded = found.filter(F.col("n") > long_list).select("fp").distinct()
    one_bit_off = F.transform(
        F.sequence(F.lit(0), F.lit(63)),
        lambda i: F.col("fp").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i)),
    )
    near = crowded.select(
        "fp", F.explode(F.concat(F.array("fp"), one_bit_off)).alias("between")
    )
    first = near.groupBy("between").agg(F.min("fp").alias("a"), F.count("*").alias("n")).filter("n > 1")
    through = near.join(first, "between").filter("fp <> a").select("a", F.col("fp").alias("b"))
    return pairs.union(through).distinct()


def grouped(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """All columns of `docs` but `text`, then `fp`, `component` (one long per group) and `component_id`."""
    own = {"fp", "component", "component_id", "fingerprint"}
    printed = stage(with_fingerprint(docs.drop(*own), width), "fingerprints")
    # The fingerprints of exact copies, however many, come down to one row per task.
    distinct = stage(printed.groupBy("fp").agg(F.min("doc_id").alias("doc_id")), "distinct")
    labels = connected_components(links(distinct.select("fp"))).withColumnRenamed("node", "fp")
    of_print = distinct.join(labels, "fp", "left").select(
        "fp", F.coalesce("component", "fp").alias("component"), "doc_id"
    )
    smallest = of_print.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    resolved = of_print.select("fp", "component").join(smallest, "component")
    return printed.join(resolved, "fp").select(*printed.columns, "component", "component_id")


def near_duplicates(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row per row of `docs`: all columns but `text`, then `fingerprint`, `component_id`.

    `component_id` is the smallest `doc_id` that can be reached over links, null if no row of the group has
    an id. A null text counts as empty: fingerprint zero, linked like any other. Repeated rows are one
    group. `fp`, `component` and the names of the results are this operator's own; such columns of `docs`
    are dropped.
    """
    found = grouped(docs, width)
    kept = [name for name in found.columns if name not in ("fp", "component", "component_id")]
    return found.select(
        *kept, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """`docs` with one row left of each group of near-duplicates: that of the smallest id, and of several
    rows of that id any one. Columns and whole texts stay as they are."""
    # Numbers of rows hold only for rows that are fixed.
    numbered = stage(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    rows = grouped(numbered.select("doc_id", "text", "_row"), width)
    chosen = rows.groupBy("component").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "_row")).alias("x")
    )
    return numbered.join(chosen.select("x._row"), "_row", "left_semi").select(*docs.columns)
