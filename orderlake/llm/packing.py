"""Best-fit packing with certified bin counts.

Documents are encoded, cut into pieces of at most `capacity` ids and packed in two kinds of step:

* Every group of pieces (a salted hash of their key, so of bounded and even size) is packed by best-fit
  decreasing in one task. A lower bound from dual-feasible functions certifies the group: if it needs
  as many bins as the bound says, no packing of these pieces is better.
* Groups with a gap between bins and bound keep their full bins and give up the documents of the others; a
  certified group gives up its poorly filled bins, as the bound rounds up once per group. These documents are
  dealt anew into fewer groups and packed again, until nothing is left, one group is left, or an exchange no
  longer saves a bin.

Only lengths and keys are shuffled. A bin is one sequence.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from orderlake.llm.encode import Encoder, ids_crc32, read_tokenizer, arrow_groups
from orderlake.llm.scratch import drop, stage, struct

CAPACITY = 2048
GROUP_ROWS = 50_000
WELL_FILLED = 0.9
MOST_ROUNDS = 6
# Denominators k of the functions u_k and thresholds of the large-item functions; any set is valid.
ROUNDINGS = tuple(range(1, 21))
THRESHOLDS = 64

PIECES = struct("doc_id long, piece integer, start long, length long, ids_crc32 long, n_ids long")


def encode_pieces(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0, ids: bool = False
) -> DataFrame:
    """One row per piece: `doc_id, piece, start, length, ids_crc32, n_ids`, and with `ids` the
    piece's ids as little-endian 32-bit integers in a binary column.

    A null text is empty: its document is the end id alone. Other columns of `docs` are not read.
    """
    content = read_tokenizer(docs.sparkSession, tokenizer)
    schema = T.StructType(PIECES.fields + [T.StructField("ids", T.BinaryType())] * ids)

    def run(batches):
        encoder = Encoder(content.value)
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1)
            for first, last in arrow_groups(texts):
                rows = []
                bodies = encoder.encode(texts.slice(first, last - first))
                for key, body in zip(keys[first:last], bodies):
                    all_ids = np.append(body, np.array([end_id], body.dtype)).astype("<u4")
                    for number, start in enumerate(range(0, len(all_ids), capacity)):
                        part = all_ids[start : start + capacity]
                        row = (key, number, start, len(part), ids_crc32(part), len(all_ids))
                        rows.append((*row, part.tobytes()) if ids else row)
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, ARROW[: len(columns)])], schema.names
                )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, schema
    )


ARROW = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]


def lower_bound(counts: np.ndarray, capacity: int = CAPACITY) -> int:
    """Bins that any packing needs; counts[n] is the number of items of length n.

    The largest of several bounds, each the summed value of a dual-feasible function: the plain one, the
    rounding functions u_k, and for thresholds e the function that takes items over 1-e for whole, keeps
    those from e on and forgets the smaller ones.
    """
    lengths = np.flatnonzero(counts)
    if not len(lengths):
        return 0
    amounts = counts[lengths]
    best = -(-int(lengths @ amounts) // capacity)
    for k in ROUNDINGS:
        scaled = (k + 1) * lengths
        # u_k in units of 1 / (k * capacity): exact where (k + 1) x is whole, else rounded down.
        value = np.where(scaled % capacity == 0, k * lengths, scaled // capacity * capacity)
        best = max(best, -(-int(value @ amounts) // (k * capacity)))
    halves = lengths[lengths <= capacity // 2]
    for low in np.unique(halves[np.linspace(0, len(halves) - 1, THRESHOLDS).astype(int)]) if len(
        halves
    ) else ():
        value = np.where(lengths > capacity - low, capacity, np.where(lengths < low, 0, lengths))
        best = max(best, -(-int(value @ amounts) // capacity))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int = CAPACITY):
    """Bin and offset of each item, the items given longest first.

    Items of one length go to the fullest open bin that holds them until that bin no longer does; open
    bins are kept by free space, so a step costs a look at the free spaces in use, not at all bins.
    """
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    free: list[list[int]] = [[] for _ in range(capacity + 1)]
    used = np.zeros(capacity + 1, bool)
    opened = 0
    edges = np.flatnonzero(np.diff(lengths, prepend=-1)).tolist() + [len(lengths)]
    for first, last in zip(edges, edges[1:]):
        length, item = int(lengths[first]), first
        while item < last:
            step = int(used[length:].argmax())
            if used[length + step]:
                space = length + step
                target = free[space].pop()
                used[space] = bool(free[space])
            else:
                space, target, opened = capacity, opened, opened + 1
            fits = min(space // length, last - item)
            bins[item : item + fits] = target
            offsets[item : item + fits] = capacity - space + length * np.arange(fits)
            item += fits
            left = space - fits * length
            if left:
                free[left].append(target)
                used[left] = True
    return bins, offsets


def _pack_group(carried: list[str], capacity: int, round_no: int):
    schema_names = [*carried, "bin", "offset", "settled"]

    def run(table: pa.Table) -> pa.Table:
        lengths = table.column("length").to_numpy()
        keys = [table.column(n).combine_chunks().fill_null(-1).to_numpy() for n in ("doc_id", "piece")]
        crc = table.column("ids_crc32").to_numpy()
        order = np.lexsort((crc, keys[1], keys[0], -lengths))
        table, lengths = table.take(pa.array(order)), lengths[order]
        bins, offsets = best_fit_decreasing(lengths, capacity)
        fill = np.bincount(bins, weights=lengths).astype(np.int64)
        gap = len(fill) - lower_bound(np.bincount(lengths, minlength=capacity + 1), capacity)
        # Full bins stay. So do the well filled ones of a certified group; its rest may fit in elsewhere.
        settled = (fill[bins] == capacity) | ((gap <= 0) & (fill[bins] >= WELL_FILLED * capacity))
        group = table.column("bucket")[0].as_py()
        number = (np.int64(round_no) << 56) | (np.int64(group) << 24) | bins
        columns = [table.column(n) for n in carried]
        columns += [pa.array(number), pa.array(offsets), pa.array(settled)]
        return pa.table(columns, schema_names)

    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Add `sequence_id` and `offset` to pieces (`doc_id, piece, ids_crc32, length` and more columns).

    Pieces of equal key are pieces of their own. No pieces: an empty result.
    """
    carried = pieces.columns
    rest, done, before = stage(pieces, "pieces"), [], None
    spent = [rest]
    for round_no in range(MOST_ROUNDS):
        size = rest.agg(F.count("*").alias("n"), F.sum("length").alias("ids")).first()
        groups = max(1, -(-size["n"] // group_rows))
        salted = rest.withColumn(
            "bucket",
            F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.lit(round_no)), F.lit(groups)),
        )
        schema = T.StructType(
            pieces.schema.fields
            + T.StructType.fromDDL("bin long, offset long, settled boolean").fields
        )
        packed = stage(
            salted.groupBy("bucket").applyInArrow(_pack_group(carried, capacity, round_no), schema),
            f"packed{round_no}",
        )
        spent.append(packed)
        count = packed.agg(
            F.countDistinct("bin").alias("all"),
            F.countDistinct(F.when(~F.col("settled"), F.col("bin"))).alias("open"),
        ).first()
        open_bins = count["open"]
        saved_none = before is not None and count["all"] >= before
        last = round_no == MOST_ROUNDS - 1 or groups == 1 or saved_none
        done.append(packed if last else packed.filter("settled"))
        if last or not open_bins:
            break
        before, rest = open_bins, packed.filter(~F.col("settled")).select(*carried)
    result = done[0]
    for more in done[1:]:
        result = result.unionByName(more)
    drop(spent[0])
    return result.select(*carried, F.col("bin").alias("sequence_id"), "offset")


def pack_documents(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0
) -> DataFrame:
    """Packing plan of whole documents: one row per piece, with its sequence and place there.

    `docs` needs `doc_id` and `text`; a null id is kept as null, a null text is empty, repeated rows are
    packed once each, and other columns are ignored whatever their names.
    """
    return pack(encode_pieces(docs, tokenizer, capacity, end_id), capacity)


def packed_sequences(docs: DataFrame, plan: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """The sequences themselves: `sequence_id`, `length`, `ids` (array of ints), `doc_ids` of its pieces in
    order. `doc_id` must name one document each. A sequence is bounded by `capacity`."""
    ids = encode_pieces(docs, tokenizer, capacity, end_id, ids=True).select("doc_id", "piece", "ids")
    parts = plan.select("doc_id", "piece", "sequence_id", "offset").join(ids, ["doc_id", "piece"])
    schema = "sequence_id long, length int, ids array<int>, doc_ids array<long>"

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("offset")
        ids = np.frombuffer(b"".join(table.column("ids").to_pylist()), "<u4").astype(np.int32)
        return pa.table(
            {
                "sequence_id": pa.array([table.column("sequence_id")[0].as_py()], pa.int64()),
                "length": pa.array([len(ids)], pa.int32()),
                "ids": pa.array([ids], pa.list_(pa.int32())),
                "doc_ids": pa.array([table.column("doc_id").to_pylist()], pa.list_(pa.int64())),
            }
        )

    return parts.groupBy("sequence_id").applyInArrow(run, schema)
