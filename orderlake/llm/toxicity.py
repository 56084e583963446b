"""Toxicity by the nearest labelled examples.

Examples and texts are TF-IDF vectors over the terms that speak for the toxic class: words, and beginnings of
longer words, which carry over to forms not seen before. A term that occurs twice, and one that occurs three times,
is a term of its own besides, as a cosine does not tell one mention from many.

A text is scored by its `NEIGHBOURS` nearest examples by exact cosine. The index of examples is inverted and
block-max: examples lie in blocks, similar ones together; for each term and block it holds the largest weight, so
the bounds of all blocks are one sum, and only blocks whose bound beats the worst neighbour so far are looked into.
The neighbours' votes, weighted by closeness and by how many rows an example stands for and joined by a small vote for
the rate of texts without any term, are turned into probabilities by an isotonic fit on the examples' own votes
without themselves. The neighbours are returned as evidence.

Fitted on a sample of at most `EXAMPLES` labelled rows of each class, taken by a hash of their id. A text is read
whole; nothing but its words counts.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from orderlake.llm.encode import arrow_groups
from orderlake.llm.scratch import drop, stage, struct

EXAMPLES = 2_500
MOST_TERMS = 8192
BEGINNING = 5
NEIGHBOURS = 15
BLOCK = 64
CHUNK = 16
THRESHOLD = 0.7
EVIDENCE = 3
REMEMBERED = 100_000


def learnt_from(doc_id: str = "doc_id", parts: int = 3, held: int = 1) -> Column:
    """Whether labels of a document may be used: crc32 of its id as text, modulo `parts`, is not `held`."""
    remainder = F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts
    return F.coalesce(remainder != held, F.lit(True))


def word_codes(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Lower-case runs of letters: distinct words, the code of each word in turn, its text's number."""
    plain = pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(texts, "")), r"[^\pL]+", " ")
    lists = pc.ascii_split_whitespace(plain)
    coded = lists.flatten().dictionary_encode()
    counts = pc.list_value_length(lists).to_numpy()
    return (
        coded.dictionary.to_pylist(),
        coded.indices.to_numpy(),
        np.repeat(np.arange(len(counts)), counts),
    )


def terms_of(word: str) -> tuple[str, ...]:
    """The word, and the beginning of a longer one."""
    return (word, word[:BEGINNING] + "*") if len(word) > BEGINNING else (word,)


def levels(term: str) -> tuple[str, ...]:
    """A term's names: as such, seen twice or more, seen three times or more."""
    return term, f"{term}#2", f"{term}#3"


def base_counts(texts: pa.Array, number_of):
    """Sorted cells of text and base term, with counts. `number_of` numbers a base term, or gives -1."""
    found, codes, rows = word_codes(texts)
    named = [terms_of(word) if word else () for word in found]
    cells = []
    for kind in (0, 1):
        of = np.fromiter((number_of(n[kind]) if len(n) > kind else -1 for n in named), np.int64, len(named))
        term = of[codes] if len(codes) else codes.astype(np.int64)
        cells.append((rows[term >= 0], term[term >= 0]))
    row, term = (np.concatenate(parts) for parts in zip(*cells))
    cell, n = np.unique((row.astype(np.int64) << 32) | term, return_counts=True)
    return cell >> 32, cell & 0xFFFFFFFF, n


def term_counts(texts: pa.Array, terms: dict[str, int]):
    """Non-zero counts of the given terms: arrays of text number, term and count, sorted."""
    bases: dict[str, int] = {}
    for term in terms:
        bases.setdefault(term.split("#")[0], len(bases))
    ids = np.array([[terms.get(name, -1) for name in levels(base)] for base in bases] or [[-1] * 3])
    rows, base, n = base_counts(texts, lambda name: bases.get(name, -1))
    parts = []
    for level in range(3):
        term = ids[base, level]
        here = (n > level) & (term >= 0)
        parts.append((rows[here], term[here], np.where(level == 0, n, 1)[here]))
    rows, term, n = (np.concatenate(part) for part in zip(*parts))
    order = np.lexsort((term, rows))
    return rows[order], term[order], n[order]


def chosen_examples(docs: DataFrame, labels: DataFrame, most: int) -> tuple[DataFrame, dict[int, float]]:
    """Up to `most` labelled documents of each class, `doc_id, text, toxic`, and each class's weight.

    A document with several labels counts as toxic if one of them says so.
    """
    usable = (
        labels.filter(learnt_from() & F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    sizes = {row.toxic: row.n for row in usable.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    order = F.xxhash64("doc_id")
    picked = None
    for label in sorted(sizes):
        part = usable.filter(F.col("toxic") == label).orderBy(order, "doc_id").limit(most)
        picked = part if picked is None else picked.union(part)
    if picked is None:
        return docs.select("doc_id", "text", F.lit(0).alias("toxic")).limit(0), {}
    # At most twice `most` rows of two numbers.
    texts = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    # Copies of a text would make every word of it a telling one.
    once = texts.groupBy(F.sha1(F.coalesce("text", F.lit("")).cast("binary")).alias("key"), "toxic").agg(
        F.min(F.struct("doc_id", "text")).alias("x")
    )
    return once.select("x.doc_id", "x.text", "toxic"), {label: n / min(n, most) for label, n in sizes.items()}


def telling_terms(examples: DataFrame, weights: dict[int, float]) -> list[tuple[str, float]]:
    """Terms that toxic examples hold more often, beyond chance, at most `MOST_TERMS` of them, each with its
    inverse document frequency.

    Kept are log-likelihood ratios that not even one of so many terms would reach by chance.
    """

    def run(batches):
        counts: dict[str, list[int]] = {}
        for batch in batches:
            labels, texts = batch.column(0).to_numpy(), batch.column(1)
            for first, last in arrow_groups(texts):
                number: dict[str, int] = {}
                rows, term, n = base_counts(
                    texts.slice(first, last - first), lambda name: number.setdefault(name, len(number))
                )
                toxic, names = labels[first:last][rows] == 1, list(number)
                for level in range(3):
                    of_class = [
                        np.bincount(term[(n > level) & (toxic == y)], minlength=len(names))
                        for y in (False, True)
                    ]
                    for i in np.flatnonzero(of_class[0] + of_class[1]).tolist():
                        both = counts.setdefault(levels(names[i])[level], [0, 0])
                        both[0] += int(of_class[0][i])
                        both[1] += int(of_class[1][i])
        found = list(counts.values())
        yield pa.RecordBatch.from_arrays(
            [pa.array(counts.keys(), pa.string())]
            + [pa.array([c[k] for c in found], pa.int64()) for k in (0, 1)],
            ["term", "clean", "toxic"],
        )

    per_term = stage(
        examples.select("toxic", "text")
        .mapInArrow(run, struct("term string, clean long, toxic long"))
        .groupBy("term")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")),
        "terms",
    )
    totals = {r.toxic: r.n for r in examples.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n0, n1 = (float(totals.get(label, 0)) for label in (0, 1))
    if not n0 or not n1:
        return []
    df = F.col("clean") + F.col("toxic")

    def part(seen, share):
        return F.when(seen > 0, seen * F.log(seen / share)).otherwise(0.0)

    ratio = 2 * (
        part(F.col("clean"), df * n0 / (n0 + n1))
        + part(F.col("toxic"), df * n1 / (n0 + n1))
        + part(n0 - F.col("clean"), (n0 + n1 - df) * n0 / (n0 + n1))
        + part(n1 - F.col("toxic"), (n0 + n1 - df) * n1 / (n0 + n1))
    )
    enough = 2 * float(np.log(max(1, per_term.count()))) + 2
    chosen = (
        per_term.withColumn("ratio", ratio)
        .filter((F.col("ratio") >= enough) & (F.col("toxic") * n0 > F.col("clean") * n1))
        .orderBy(F.desc("ratio"), "term")
        .limit(MOST_TERMS)
        .collect()
    )
    drop(per_term)
    of_class = [weights.get(label, 0) for label in (0, 1)]
    weighted = n0 * of_class[0] + n1 * of_class[1]
    return [
        (r.term, float(np.log((1 + weighted) / (r.clean * of_class[0] + r.toxic * of_class[1]))) + 1)
        for r in chosen
    ]


def normalised(rows: np.ndarray, terms: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF weights of length one per text."""
    value = (1 + np.log(counts)) * idf[terms]
    norm = np.sqrt(np.bincount(rows, value * value)) if len(rows) else np.zeros(0)
    return value / norm[rows]


class BlockMaxIndex:
    """Sparse unit vectors in blocks, with the largest weight per term and block."""

    def __init__(self, indptr, terms, weights, n_terms):
        self.indptr, self.terms, self.weights = indptr, terms, weights
        self.n, self.n_terms = len(indptr) - 1, n_terms
        self.blocks = -(-self.n // BLOCK)
        rows = self.rows = np.repeat(np.arange(self.n), np.diff(indptr))
        self.edges = indptr[np.minimum(np.arange(self.blocks + 1) * BLOCK, self.n)]
        cell = terms * np.int64(max(1, self.blocks)) + rows // BLOCK
        order = np.lexsort((-weights, cell))
        cells, first = np.unique(cell[order], return_index=True)
        self.block_of, self.peak = cells % max(1, self.blocks), weights[order][first]
        self.lists = np.searchsorted(cells, np.arange(n_terms + 1) * np.int64(max(1, self.blocks)))

    def nearest(self, terms, weights, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k vectors of largest cosine above zero, ties by position, with their cosines."""
        bound = np.zeros(self.blocks)
        for term, weight in zip(terms.tolist(), weights.tolist()):
            a, b = self.lists[term], self.lists[term + 1]
            bound[self.block_of[a:b]] += weight * self.peak[a:b]
        order = np.flatnonzero(bound > 0)
        order = order[np.argsort(-bound[order], kind="stable")]
        query = np.zeros(self.n_terms)
        query[terms] = weights
        ids, scores = np.zeros(0, np.int64), np.zeros(0)
        for low in range(0, len(order), CHUNK):
            some = order[low : low + CHUNK]
            # Rounding must not shut out a block of equal score.
            if len(ids) == k and bound[some[0]] < scores[-1] - 1e-9:
                break
            parts = [slice(self.edges[b], self.edges[b + 1]) for b in some.tolist()]
            value = np.concatenate([query[self.terms[p]] * self.weights[p] for p in parts])
            shift = np.repeat((np.arange(len(some)) - some) * BLOCK, [p.stop - p.start for p in parts])
            local = np.bincount(
                np.concatenate([self.rows[p] for p in parts]) + shift, value, len(some) * BLOCK
            )
            own = (some[:, None] * BLOCK + np.arange(BLOCK)).reshape(-1)
            ids = np.concatenate([ids, own[local > 0]])
            scores = np.concatenate([scores, local[local > 0]])
            best = np.lexsort((ids, -np.round(scores, 9)))[:k]
            ids, scores = ids[best], scores[best]
        return ids, scores


def vote(ids, scores, labels, weights, rate: float) -> float:
    """Share of toxic examples among the neighbours, close and weighty ones counting more, far ones hardly
    more than the rate of texts that have no neighbour."""
    share = weights[ids] * scores / (1.05 - np.minimum(scores, 1))
    return float(((share * labels[ids]).sum() + rate) / (share.sum() + 1))


def isotonic(votes: np.ndarray, labels: np.ndarray, weights: np.ndarray):
    """Votes and the rising probabilities that fit them best; one more case of either class in each step
    keeps them off 0 and 1."""
    order = np.argsort(votes, kind="stable")
    steps: list[list[float]] = []  # toxic weight, weight, first and last vote
    for v, y, w in zip(votes[order], labels[order], weights[order]):
        steps.append([y * w, w, v, v])
        while len(steps) > 1 and (
            steps[-2][3] == steps[-1][2] or steps[-2][0] / steps[-2][1] >= steps[-1][0] / steps[-1][1]
        ):
            a, b = steps.pop(), steps.pop()
            steps.append([a[0] + b[0], a[1] + b[1], b[2], a[3]])
    x = [v for s in steps for v in (s[2], s[3])]
    y = [(s[0] + 0.5) / (s[1] + 1) for s in steps for _ in (0, 1)]
    return np.array(x), np.maximum.accumulate(np.array(y))


def fit(docs: DataFrame, labels: DataFrame, most: int = EXAMPLES) -> dict:
    """The model as plain arrays: terms, index, example ids, calibration. Bounded by `most` and
    `MOST_TERMS`, whatever the size of the tables."""
    examples, class_weight = chosen_examples(docs, labels, most)
    examples = stage(examples, "examples")
    chosen = telling_terms(examples, class_weight)
    terms = {word: i for i, (word, _) in enumerate(chosen)}
    idf = np.array([value for _, value in chosen])

    def run(batches):
        for batch in batches:
            texts = batch.column(2)
            for first, last in arrow_groups(texts):
                rows, term, n = term_counts(texts.slice(first, last - first), terms)
                cuts = np.searchsorted(rows, np.arange(last - first + 1))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first),
                        batch.column(1).slice(first, last - first).cast(pa.int32()),
                        pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(term, pa.int32())),
                        pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(n, pa.int32())),
                    ],
                    ["doc_id", "toxic", "terms", "counts"],
                )

    vectors = (
        examples.select(F.col("doc_id").cast("long"), "toxic", "text")
        .mapInArrow(run, "doc_id long, toxic int, terms array<int>, counts array<int>")
        .toArrow()
    )
    drop(examples)
    lists = vectors["terms"].to_pylist()
    # Similar examples lie side by side: by their terms, rarest first.
    order = sorted(range(len(lists)), key=lambda i: (sorted(lists[i], key=lambda t: (-idf[t], t)), vectors["doc_id"][i].as_py()))
    vectors = vectors.take(pa.array(order, pa.int64()))
    sizes = np.array([len(lists[i]) for i in order], np.int64)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    flat = np.array([t for part in vectors["terms"].to_pylist() for t in part], np.int64)
    counts = np.array([n for part in vectors["counts"].to_pylist() for n in part], np.float64)
    y = vectors["toxic"].to_numpy().astype(float)
    weight = np.array([class_weight.get(int(label), 1.0) for label in y])
    model = {
        "terms": terms,
        "idf": idf,
        "indptr": np.concatenate([[0], np.cumsum(sizes)]),
        "flat": flat,
        "weights": normalised(rows, flat, counts, idf),
        "labels": y,
        "class_weight": weight,
        "ids": vectors["doc_id"].to_numpy(),
    }
    empty = sizes == 0
    model["no_term"] = float(((y * weight)[empty].sum() + 0.5) / (weight[empty].sum() + 1)) if len(y) else 0.5
    index = BlockMaxIndex(model["indptr"], flat, model["weights"], len(idf))
    asked = np.flatnonzero(~empty)
    votes, memo = [], {}
    for i in asked.tolist():
        a, b = model["indptr"][i], model["indptr"][i + 1]
        key = (flat[a:b].tobytes(), model["weights"][a:b].tobytes())
        if key not in memo:
            memo[key] = index.nearest(flat[a:b], model["weights"][a:b], NEIGHBOURS + 1)
        ids, scores = memo[key]
        others = ids != i
        others[NEIGHBOURS:] &= others[:NEIGHBOURS].sum() < NEIGHBOURS
        votes.append(vote(ids[others], scores[others], y, weight, model["no_term"]) if others.any() else model["no_term"])
    model["votes"], model["chances"] = (
        isotonic(np.array(votes), y[asked], weight[asked]) if len(asked) else (np.zeros(1), np.full(1, model["no_term"]))
    )
    return model


def scorer(model: dict):
    """Texts -> score, neighbours' ids and telling words of each."""
    index = BlockMaxIndex(model["indptr"], model["flat"], model["weights"], len(model["idf"]))
    names = list(model["terms"])
    memo: dict = {}

    def one(terms, weights):
        key = terms.tobytes() + weights.tobytes()
        if key not in memo:
            if len(memo) > REMEMBERED:
                memo.clear()
            ids, scores = index.nearest(terms, weights, NEIGHBOURS)
            chance = model["no_term"]
            if len(ids):
                share = vote(ids, scores, model["labels"], model["class_weight"], model["no_term"])
                chance = float(np.interp(share, model["votes"], model["chances"]))
            memo[key] = chance, model["ids"][ids[:EVIDENCE]].tolist(), [names[t] for t in terms.tolist()]
        return memo[key]

    def run(texts: pa.Array):
        rows, terms, counts = term_counts(texts, model["terms"])
        weights = normalised(rows, terms, counts.astype(float), model["idf"])
        found = [(model["no_term"], [], [])] * len(texts)
        cuts = np.flatnonzero(np.diff(rows, prepend=-1)).tolist() + [len(rows)]
        for a, b in zip(cuts, cuts[1:]):
            found[rows[a]] = one(terms[a:b], weights[a:b])
        return found

    return run


def score_toxicity(docs: DataFrame, labels: DataFrame, most: int = EXAMPLES) -> DataFrame:
    """One row per row of `docs`: `doc_id, held_out, score, predicted`, `evidence` (ids of the nearest
    examples) and `terms` (the words that count).

    Null and empty texts have no such word and get the rate of examples without any; so does every text if
    there are no labels (0.5). Repeated rows are scored once each. Other columns are not read.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, most))
    schema = "doc_id long, held_out boolean, score double, predicted int, evidence array<long>, terms array<string>"

    def run(batches):
        scored = scorer(model.value)
        for batch in batches:
            texts = batch.column(2)
            for first, last in arrow_groups(texts):
                size = last - first
                score, near, words = zip(*scored(texts.slice(first, size)))
                score = np.array(score)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, size),
                        batch.column(1).slice(first, size),
                        pa.array(score),
                        pa.array((score >= THRESHOLD).astype(np.int32)),
                        pa.array(near, pa.list_(pa.int64())),
                        pa.array(words, pa.list_(pa.string())),
                    ],
                    ["doc_id", "held_out", "score", "predicted", "evidence", "terms"],
                )

    return docs.select(
        F.col("doc_id").cast("long"), (~learnt_from()).alias("held_out"), "text"
    ).mapInArrow(run, schema)


def without_toxic(docs: DataFrame, labels: DataFrame, most: int = EXAMPLES) -> DataFrame:
    """`docs` without the rows predicted toxic, all columns as they are."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, most))
    place = docs.columns.index("text")

    def run(batches):
        scored = scorer(model.value)
        for batch in batches:
            texts = batch.column(place)
            for first, last in arrow_groups(texts):
                part = batch.slice(first, last - first)
                keep = [score < THRESHOLD for score, _, _ in scored(part.column(place))]
                yield part.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
