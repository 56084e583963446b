"""The highest-scoring documents of each query, exactly, by norm buckets (LEMP).

A document is the vector of its impacts, a query that of its terms' weights, and a score is their inner product.
Vectors are ordered by length over the whole corpus and lie in buckets of similar length. A bucket is left out for a
query if the query's length times the bucket's greatest one is below the lowest score that still counts (Cauchy-
Schwarz). Inside a bucket, coordinates are read from the query's heaviest downward; what is read of a document, and
the lengths of both vectors over the coordinates not yet read, bound its score, and few documents are left after few
coordinates. What is left is scored anew in integers. Bounds are floats with a margin, so no tie is lost.

The longest vectors come first: they are searched in `ROUNDS` groups of falling length, and each group starts with the
lowest scores that the ones before it have set, by which whole row groups need not be read any more.

Queries are taken block by block, at most `BLOCK_CHARS` of text at a time (a longer text is a block); only a block is
ever sent to the driver and the tasks, with its terms and their counts. Documents stay where Spark has put them. A
vector holds only terms that a query of the block has.

Terms, counts and scores follow one integer formula (`weight`, `impact`). Null and empty texts have no terms: such
documents are never found and do not count, such queries have no rows. Repeated rows of documents are found as often
as they are there; equal queries (id and text) count once, different texts of one id are ranked one by one. Equal
scores are in ascending order of `doc_id`, null last. Other columns are not read.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from orderlake.llm.scratch import drop, stage

TOP = 10
BLOCK_CHARS = 4 << 20
BUCKET = 2048
COORDINATES = 8
FEW = 64
# Shares of the documents that are searched first, by falling length.
ROUNDS = (1 / 256, 1 / 16)
MARGIN = 1 + 1e-9

# What is no part of a term becomes a space, A-Z lower case; bytes of other letters stay.
SEPARATORS = [*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
TO_TERMS = bytes(32 if b in SEPARATORS else b + 32 if 65 <= b <= 90 else b for b in range(256))


def terms(text: str | None) -> list[bytes]:
    return text.encode().translate(TO_TERMS).split() if text else []


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def impact(tf: Column, n: Column, documents: int, tokens: int) -> Column:
    """Of a term that occurs `tf` times in a document of `n` terms."""
    m = F.lit(10).cast("long") + F.call_function("div", F.lit(90).cast("long") * n * F.lit(documents).cast("long"), F.lit(tokens).cast("long"))
    tf = tf.cast("long")
    return F.call_function("div", F.lit(1_000_000_000).cast("long") * tf, F.lit(1000).cast("long") * tf + F.lit(8).cast("long") * m)


def query_blocks(queries: DataFrame):
    """Lists of (id, distinct terms), a block at a time."""
    block, size = [], 0
    for row in queries.toLocalIterator():
        found = sorted(set(terms(row["text"])))
        if not found:
            continue
        if block and size + len(row["text"]) > BLOCK_CHARS:
            yield block
            block, size = [], 0
        block.append((row["item_id"], found))
        size += len(row["text"])
    if block:
        yield block


def counted(docs: DataFrame, vocabulary) -> DataFrame:
    """`doc_id`, `n` (all its terms), and the numbers and counts of those of the vocabulary."""
    schema = T.StructType([docs.schema["doc_id"], *T._parse_datatype_string("n long, ids array<int>, counts array<int>")])
    arrow = to_arrow_schema(schema)

    def lists(parts, kind):
        ends = np.cumsum([0] + [len(part) for part in parts]).astype(np.int32)
        flat = np.concatenate(parts) if parts else np.zeros(0)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(np.int32))).cast(kind)

    def run(batches):
        number = vocabulary.value
        for batch in batches:
            sizes, ids, counts = [], [], []
            for text in batch.column(1):
                found = terms(text.as_py())
                sizes.append(len(found))
                known = np.array([k for k in map(number.get, found) if k is not None], np.int64)
                del found
                there, times = np.unique(known, return_counts=True)
                ids.append(there)
                counts.append(times)
            columns = [batch.column(0), pa.array(sizes, pa.int64()), *(lists(x, arrow.field("ids").type) for x in (ids, counts))]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


class Query:
    """Terms of a query from the heaviest to the lightest."""

    def __init__(self, item_id, ids: list[int], weights: list[int]):
        order = sorted(range(len(ids)), key=lambda i: (-weights[i], ids[i]))
        self.item_id = item_id
        self.ids = [ids[i] for i in order]
        self.weights = [weights[i] for i in order]
        squares = np.array([float(w) ** 2 for w in self.weights])
        # Length over the terms from the k-th on.
        self.rest = np.sqrt(np.concatenate([np.cumsum(squares[::-1])[::-1], [0.0]])).tolist()


class Bucket:
    """Vectors of similar length, by document and by coordinate."""

    def __init__(self, doc_ids, norms, ends, ids, impacts, width):
        self.doc_ids, self.norms, self.ends = doc_ids, norms, ends
        self.ids, self.impacts = ids, impacts
        rows = np.repeat(np.arange(len(norms)), np.diff(ends))
        order = np.argsort(ids, kind="stable")
        self.rows, self.values = rows[order], impacts[order].astype(np.float64)
        self.start = np.concatenate([[0], np.cumsum(np.bincount(ids, minlength=width))])

    def survivors(self, query: Query, least: int) -> np.ndarray:
        """Documents whose bound reaches `least`."""
        read, squares = np.zeros(len(self.norms)), np.zeros(len(self.norms))
        lengths = self.norms**2
        for low in range(0, len(query.ids), COORDINATES):
            high = min(low + COORDINATES, len(query.ids))
            for term, w in zip(query.ids[low:high], query.weights[low:high]):
                a, b = self.start[term], self.start[term + 1]
                if a < b:
                    rows, values = self.rows[a:b], self.values[a:b]
                    read[rows] += w * values
                    squares[rows] += values * values
            unread = np.sqrt(np.maximum(lengths * MARGIN - squares, 0))
            alive = np.flatnonzero((read + query.rest[high] * unread) * MARGIN >= least)
            if len(alive) <= FEW:
                break
        return alive

    def scores(self, query: Query, rows: np.ndarray, scratch: np.ndarray) -> np.ndarray:
        """Exact scores of some documents; `scratch` is zeros, one per term, and is left so."""
        scratch[query.ids] = query.weights
        sizes = np.diff(self.ends)[rows]
        ends = np.cumsum(sizes)
        places = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.ends[rows] - (ends - sizes), sizes)
        totals = np.concatenate([[0], np.cumsum(scratch[self.ids[places]] * self.impacts[places])])
        scratch[query.ids] = 0
        return totals[ends] - totals[ends - sizes]


def ranked(found: list[tuple]) -> list[tuple]:
    """(score, doc_id) in order of rank."""
    return sorted(found, key=lambda x: (-x[0], x[1] is None, x[1]))


def search(vectors: DataFrame, block, schema: T.StructType, top: int) -> DataFrame:
    """Vectors by falling length -> the best of each task: `query`, `item_id`, `doc_id`, `score`."""
    arrow = to_arrow_schema(schema)

    def run(batches):
        queries, least, width = block.value
        least = list(least)
        best = [[] for _ in queries]
        active = list(range(len(queries)))
        scratch = np.zeros(width, np.int64)
        for batch in batches:
            for low in range(0, batch.num_rows, BUCKET):
                part = batch.slice(low, BUCKET)
                norms = part.column(1).to_numpy()
                # Lengths fall: who has no chance here has none further on.
                active = [q for q in active if queries[q].rest[0] * norms[0] * MARGIN >= least[q]]
                if not active:
                    continue
                lists = part.column(2)
                ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
                ids, impacts = (part.column(i).flatten().to_numpy().astype(np.int64) for i in (2, 3))
                bucket = Bucket(part.column(0), norms, ends, ids, impacts, width)
                for q in active:
                    rows = bucket.survivors(queries[q], least[q])
                    if not len(rows):
                        continue
                    scores = bucket.scores(queries[q], rows, scratch)
                    if len(scores) > top:
                        # Of equal scores all stay, until their ids are compared.
                        least[q] = max(least[q], int(np.partition(scores, -top)[-top]))
                    good = scores >= least[q]
                    keys = bucket.doc_ids.take(pa.array(rows[good])).to_pylist()
                    best[q] = ranked(best[q] + list(zip(scores[good].tolist(), keys)))[:top]
                    if len(best[q]) == top:
                        least[q] = max(least[q], best[q][-1][0])
        found = [
            {"query": q, "item_id": query.item_id, "doc_id": key, "score": score}
            for q, query in enumerate(queries)
            for score, key in best[q]
        ]
        yield pa.RecordBatch.from_pylist(found, schema=arrow)

    return vectors.select("doc_id", "norm", "ids", "impacts").mapInArrow(run, schema)


def highest(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def rank_block(docs: DataFrame, queries: list[tuple], item_type: T.DataType, top: int, rounds) -> DataFrame:
    """One block of queries against all documents."""
    spark = docs.sparkSession
    vocabulary = {term: k for k, term in enumerate(sorted({t for _, found in queries for t in found}))}
    sent = spark.sparkContext.broadcast(vocabulary)
    counts = stage(counted(docs, sent), "term-counts")
    documents, tokens = counts.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    # As many rows as the block has terms.
    holding = dict(counts.select(F.explode("ids").alias("id")).groupBy("id").count().collect())
    weights = {term: weight(documents, holding.get(k, 0)) for term, k in vocabulary.items()}
    made = [Query(item, [vocabulary[t] for t in found], [weights[t] for t in found]) for item, found in queries]

    impacts = F.transform("counts", lambda tf: impact(tf, F.col("n"), documents, tokens or 1).cast("int"))
    squares = F.aggregate("impacts", F.lit(0.0), lambda total, x: total + x.cast("double") * x)
    vectors = counts.filter(F.size("ids") > 0).withColumn("impacts", impacts)
    vectors = stage(vectors.select("doc_id", "ids", "impacts", F.sqrt(squares).alias("norm")), "vectors")
    drop(counts)

    schema = T.StructType(
        [T.StructField("query", T.IntegerType()), T.StructField("item_id", item_type), docs.schema["doc_id"], T.StructField("score", T.LongType())]
    )
    shares = [1 - share for share in rounds]
    cuts = vectors.agg(F.percentile_approx("norm", F.array(*map(F.lit, shares)))).first()[0] if shares else []
    bounds = [*(cuts or []), None]
    least, found, above = [1] * len(made), None, None
    for bound in bounds:
        group = vectors
        if above is not None:
            group = group.filter(F.col("norm") < above)
        if bound is not None:
            group = group.filter(F.col("norm") >= bound)
        # No query can want anything shorter than this.
        needed = min(low / (query.rest[0] * MARGIN) if query.rest[0] else math.inf for low, query in zip(least, made))
        group = group.filter(F.col("norm") >= needed * (1 - 1e-9))
        above = bound
        # Equal lengths, as of copies, are dealt by a number of the row.
        ordered = group.withColumn("salt", F.monotonically_increasing_id())
        ordered = ordered.repartitionByRange(F.desc("norm"), "salt").sortWithinPartitions(F.desc("norm"))
        block = spark.sparkContext.broadcast((made, least, len(vocabulary)))
        part = stage(search(ordered, block, schema, top), "found")
        found = part if found is None else found.unionByName(part)
        if bound is not None:
            # One number per query of the block.
            lowest = highest(found, top).groupBy("query").agg(F.min("score").alias("low"), F.count("*").alias("n"))
            for row in lowest.filter(F.col("n") == top).collect():
                least[row["query"]] = max(least[row["query"]], row["low"])
    drop(vectors)
    return highest(found, top).select("item_id", "rank", "doc_id", "score")


def rank_documents(docs: DataFrame, queries: DataFrame, top: int = TOP, rounds=ROUNDS) -> DataFrame:
    """`item_id, rank` (from 1), `doc_id, score`: the `top` documents of each query (`item_id, text`) with a score
    above 0."""
    ranked_blocks = None
    item_type = queries.schema["item_id"].dataType
    for block in query_blocks(queries.select("item_id", "text").distinct()):
        part = stage(rank_block(docs, block, item_type, top, rounds), "ranked")
        ranked_blocks = part if ranked_blocks is None else ranked_blocks.unionByName(part)
    if ranked_blocks is None:
        schema = T.StructType([T.StructField("item_id", item_type), T.StructField("rank", T.IntegerType()), docs.schema["doc_id"], T.StructField("score", T.LongType())])
        return docs.sparkSession.createDataFrame([], schema)
    return ranked_blocks


def oracle_sql(top: int = TOP) -> str:
    """The same ranking as one statement, by scoring every document that shares a term."""
    pattern = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    cut = f"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{pattern}')"
    return f"""
with held as (select row_number() over () as r, doc_id, {cut} as found from documents where text is not null),
doc as (select r, doc_id, found, len(found) as n from held where len(found) > 0),
corpus as (select count(*) as big_n, cast(sum(n) as bigint) as big_l from doc),
tf as (select r, term, count(*) as tf from (select r, unnest(found) as term from doc) group by r, term),
df as (select term, count(*) as df from tf group by term),
asked as (select row_number() over () as q, item_id, text from (select distinct item_id, text from benchmark) where text is not null),
terms as (select distinct q, unnest({cut}) as term from asked),
weights as (select q, term, cast(floor(1000 * ln((2 * big_n + 2) / (2 * df + 1))) as bigint) as w from terms join df using (term), corpus),
scored as (
  select q, doc.r, any_value(doc_id) as doc_id,
    cast(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * big_n) // big_l)))) as bigint) as score
  from weights join tf using (term) join doc on doc.r = tf.r, corpus group by q, doc.r
),
placed as (select *, row_number() over (partition by q order by score desc, doc_id asc nulls last) as rank from scored where score > 0)
select item_id, cast(rank as int) as rank, doc_id, score from placed join asked using (q) where rank <= {top}
"""
