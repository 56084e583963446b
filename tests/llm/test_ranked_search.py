"""Operator 11 against the scores of all documents."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from orderlake.llm import queries, ranked_search
from orderlake.llm.ranked_search import rank_documents
from oracle import connect, in_duckdb, in_spark

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def plain(docs, items, top=10):
    """(item_id, rank, doc_id, score) of (doc_id, text) and (item_id, text)."""
    counts = [(key, Counter(terms(text))) for key, text in docs]
    counts = [(key, c, sum(c.values())) for key, c in counts if c]
    total, tokens = len(counts), sum(n for _, _, n in counts)
    holding = Counter(t for _, c, _ in counts for t in c)
    found = []
    for item, text in set(items):
        wanted = {t: math.floor(1000 * math.log((2 * total + 2) / (2 * holding[t] + 1))) for t in terms(text)}
        scored = []
        for key, c, n in counts:
            m = 100 - 90 + 90 * n * total // tokens
            score = sum(w * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t, w in wanted.items() if c[t])
            if score > 0:
                scored.append((score, key))
        scored.sort(key=lambda x: (-x[0], x[1] is None, x[1]))
        found += [(item, rank, key, score) for rank, (score, key) in enumerate(scored[:top], 1)]
    return sorted(found, key=str)


def collected(frame):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in frame.collect()), key=str)


def frames(spark, docs, items):
    return (
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
    )


def made(seed=1, size=700):
    """Texts of very different lengths over a skewed vocabulary, with families of copies."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["Ünï", "日本", "É9"]
    odds = [1 / (i + 1) for i in range(len(vocabulary))]
    docs = []
    for i in range(size):
        words = rng.choices(vocabulary, odds, k=rng.choice([0, 1, 3, 20, 90, 400]))
        docs.append((i, rng.choice([" ", "-", ", "]).join(words)))
    copies = [(1000 + i, docs[7][1] + " w300 w301 w302") for i in range(300)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 5, 30])))) for i in range(25)]
    return docs + copies, [*items, (50, "w300 w301 W302"), (51, "nothing known"), (52, None), (53, ""), (50, "w5")]


def test_equals_all_scores(spark, monkeypatch):
    docs, items = made()
    wanted = plain(docs, items)
    assert collected(rank_documents(*frames(spark, docs, items))) == wanted
    monkeypatch.setattr(ranked_search, "BUCKET", 16)
    monkeypatch.setattr(ranked_search, "COORDINATES", 2)
    monkeypatch.setattr(ranked_search, "FEW", 2)
    assert collected(rank_documents(*frames(spark, docs, items), rounds=(0.01, 0.1, 0.5))) == wanted
    assert collected(rank_documents(*frames(spark, docs, items), rounds=())) == wanted


def test_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(ranked_search, "BLOCK_CHARS", 60)
    docs, items = made(2, 200)
    assert collected(rank_documents(*frames(spark, docs, items), top=3)) == plain(docs, items, 3)


def test_ties_are_in_order_of_id(spark):
    docs = [(k, "same words here") for k in [None, *range(40, 0, -1), 5, 5]] + [(99, "other")]
    found = collected(rank_documents(*frames(spark, docs, [(1, "same")])))
    assert [(rank, key) for _, rank, key, _ in sorted(found, key=lambda x: x[1])] == list(enumerate([1, 2, 3, 4, 5, 5, 5, 6, 7, 8], 1))


def test_odd_texts(odd, none, spark):
    items = [(1, "word1 and2 the Same"), (2, "no-break 日本"), (None, "words text")]
    asked = spark.createDataFrame([(*i, "x", 3) for i in items], "item_id long, text string, doc_id string, rank int")
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    assert collected(rank_documents(odd, asked)) == plain(docs, items)
    assert rank_documents(none, asked).collect() == []
    assert rank_documents(odd, asked.limit(0)).collect() == []
    assert rank_documents(odd, asked).columns == ["item_id", "rank", "doc_id", "score"]


def test_bounds_leave_documents_out(spark):
    """What survives the coordinates is few, and holds all that count."""
    import numpy as np

    rng = np.random.default_rng(4)
    size, width = 500, 60
    values = np.where(rng.random((size, width)) < 0.3, rng.integers(1, 1000, (size, width)), 0)
    rows, ids = np.nonzero(values)
    ends = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=size))])
    norms = np.sqrt((values.astype(float) ** 2).sum(axis=1))
    bucket = ranked_search.Bucket(None, norms, ends, ids, values[rows, ids], width)
    weights = rng.integers(1, 9000, width) ** 2 // 9000
    query = ranked_search.Query(1, list(range(width)), weights.tolist())
    scores = values @ weights
    least = int(np.sort(scores)[-10])
    alive = bucket.survivors(query, least)
    assert set(np.flatnonzero(scores >= least)) <= set(alive) and len(alive) <= 200
    assert bucket.scores(query, alive, np.zeros(width, np.int64)).tolist() == scores[alive].tolist()


def test_query_equals_sql(spark, sf_dir):
    name = "op11_ranked_search"
    rows = queries.QUERIES[name](spark, sf_dir)
    docs = [(r.doc_id, r.text) for r in queries.table(spark, sf_dir, "documents").collect()]
    items = [(r.item_id, r.text) for r in queries.table(spark, sf_dir, "benchmark").collect()]
    assert collected(rows) == plain(docs, items)
    sql = connect(sf_dir).sql(queries.ORACLES[name]).fetchall()
    assert sorted(((a, b, c, d) for a, b, c, d in sql), key=str) == plain(docs, items)
