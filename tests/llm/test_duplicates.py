"""Operators 6 and 7: fingerprints, vectors, components."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from orderlake.llm import embeddings, simhash
from orderlake.llm.components import connected_components


def union_find(nodes, edges):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(3)
    nodes = list(range(-200, 400))
    edges = [(rng.choice(nodes), rng.choice(nodes)) for _ in range(350)]
    edges += [(i, i + 1) for i in range(1000, 1300)] + [(2000, i) for i in range(2001, 2400)] + [(5, 5)]
    rows = spark.createDataFrame(edges + [(None, 3)], "a long, b long")
    found = {r.node: r.component for r in connected_components(rows).collect()}
    wanted = union_find({n for e in edges for n in e}, edges)
    loops = {n for a, b in edges if a == b for n in (a,)} - {n for a, b in edges if a != b for n in (a, b)}
    assert found == {n: c for n, c in wanted.items() if n not in loops}


def plain_fingerprint(text):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall("[^\x20\x09-\x0d]+", lower)
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows):
    keys = [k for k, _ in rows if k is not None]
    prints = np.array([plain_fingerprint(t) for k, t in rows if k is not None], np.uint64)
    edges = [
        (keys[i], keys[j])
        for i in range(len(keys))
        for j in np.flatnonzero(np.bitwise_count(prints ^ prints[i]) <= 2).tolist()
    ]
    return union_find(keys, edges)


@pytest.mark.parametrize("frame", ["odd", "docs"])
def test_simhash_equals_brute_force(request, frame):
    docs = request.getfixturevalue(frame)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    found = simhash.near_duplicates(docs).collect()
    assert len(found) == len(rows)
    wanted = plain_components(rows)
    texts = {}
    for key, text in rows:
        texts.setdefault(key, []).append(f"{plain_fingerprint(text):016x}")
    for row in found:
        assert row.fingerprint in texts[row.doc_id]
        if row.doc_id is not None:
            assert row.component_id == wanted[row.doc_id]


def test_links_of_crowded_lists(spark):
    """A family of near fingerprints, with short lists and with lists taken as crowded, against all pairs."""
    rng = random.Random(5)
    base = rng.getrandbits(64)
    prints = {base}
    for _ in range(300):
        value = base
        for _ in range(rng.randint(0, 6)):
            value ^= 1 << rng.randrange(64)
        prints.add(value)
    prints |= {rng.getrandbits(64) for _ in range(200)} | {0, 1, 3, 7, 2**64 - 1}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "fp long")
    near = [(a, b) for a in signed for b in signed if a < b and bin((a ^ b) & (2**64 - 1)).count("1") <= 2]
    wanted = union_find(signed, near)
    for long_list in (2, 32, 10_000):
        edges = [(r.a, r.b) for r in simhash.links(frame, long_list).collect()]
        assert set(map(lambda e: tuple(sorted(e)), edges)) <= set(near)
        assert union_find(signed, edges) == wanted


def test_one_of_each(odd, docs):
    for frame in (odd, docs):
        left = simhash.one_of_each(frame)
        assert left.columns == frame.columns
        rows = [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]
        groups = plain_components(rows)
        kept = [r.doc_id for r in left.select("doc_id").collect()]
        assert sorted(k for k in kept if k is not None) == sorted(set(groups.values()))
        assert kept.count(None) == sum(k is None for k, _ in rows)


def test_no_documents(none):
    assert simhash.near_duplicates(none).collect() == []
    assert simhash.one_of_each(none).collect() == []


def brute_vectors(rows, cosine=0.9):
    units = []
    for _, v in rows:
        x = None if v is None or None in v or not v else np.array(v, float)
        ok = x is not None and np.isfinite(x).all() and x.any()
        units.append(x / np.linalg.norm(x) if ok else None)
    links = [
        {j for j, v in enumerate(units) if j != i and u is not None and v is not None and len(u) == len(v) and u @ v >= cosine}
        for i, u in enumerate(units)
    ]
    return links


def vectors(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").withColumn("n_links", F.lit("x"))


def check_vectors(spark, rows, least=1.0, **options):
    found = embeddings.near_duplicates(vectors(spark, rows), **options).collect()
    assert len(found) == len(rows)
    links = brute_vectors(rows)
    by_id = {r.vec_id: r for r in found}
    wanted = sum(map(len, links))
    assert sum(r.n_links for r in found) >= least * wanted
    for (key, _), own in zip(rows, links):
        assert by_id[key].n_links <= len(own)
    if least == 1.0:
        index = union_find(range(len(rows)), [(i, j) for i, own in enumerate(links) for j in own])
        smallest = {}
        for i, c in index.items():
            smallest[c] = min(smallest.get(c, rows[i][0]), rows[i][0])
        for i, (key, _) in enumerate(rows):
            assert by_id[key].component_id == smallest[index[i]]
            assert by_id[key].kept == (key == smallest[index[i]])


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, [1.0, 0.0]),
        (8, [1.0, 0.0]), (9, [2.0, 0.1]), (10, [0.0, 1.0]), (11, [-1.0, 0.0]), (12, [1e-30, 0.0]), (13, [1.0, 2.0, 3.0]),
    ]
    check_vectors(spark, rows)
    assert embeddings.near_duplicates(vectors(spark, [])).collect() == []
    assert [r.n_links for r in embeddings.near_duplicates(vectors(spark, rows[:3])).collect()] == [0, 0, 0]
    twice = embeddings.near_duplicates(vectors(spark, [(7, [1.0, 0.0])] * 3 + [(None, [1.0, 0.01])])).collect()
    assert [(r.n_links, r.component_id) for r in twice] == [(3, 7)] * 4


def test_vectors_of_several_lengths(spark):
    """Each length has links of its own; one length occurs once."""
    rng = np.random.default_rng(4)
    rows = []
    for width, number in ((8, 30), (12, 30), (3, 2), (5, 1)):
        for _ in range(number):
            centre = rng.normal(size=width)
            rows += [(centre + 0.02 * rng.normal(size=width)).tolist() for _ in range(2 if number > 1 else 1)]
    check_vectors(spark, [(i, v) for i, v in enumerate(rows)])


def test_given_vectors(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    check_vectors(spark, rows)


def test_families_of_near_copies(spark):
    """Tight and loose families that cross the limit: balls, open pairs and single members all occur."""
    rng = np.random.default_rng(11)
    rows = []
    for spread in (0.01, 0.05, 0.1, 0.2, 0.3, 0.36, 0.42):
        centre = rng.normal(size=24)
        centre /= np.linalg.norm(centre)
        for _ in range(120):
            noise = rng.normal(size=24)
            rows.append((centre + spread * noise / np.linalg.norm(noise)).astype(np.float32))
    rows += list(rng.normal(size=(400, 24)).astype(np.float32))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(rows)]
    check_vectors(spark, rows, least=0.95)


def loose_family(rng, n, width, low, high):
    """Vectors whose pairwise cosines lie about evenly between `low` and `high`."""
    centre = rng.normal(size=width)
    centre /= np.linalg.norm(centre)
    noise = rng.normal(size=(n, width))
    noise -= np.outer(noise @ centre, centre)
    noise /= np.linalg.norm(noise, axis=1)[:, None]
    # A cosine to the centre of c gives pairs of c * c, on average.
    c = np.sqrt(rng.uniform(low, high, size=n))
    return c[:, None] * centre + np.sqrt(1 - c * c)[:, None] * noise


@pytest.mark.parametrize("n, low, high, least", [(6000, 0.93, 0.95, 1.0), (3000, 0.88, 0.97, 0.99), (400, 0.92, 0.96, 0.99)])
def test_loose_families(spark, n, low, high, least):
    """Families too loose for balls, beside as many vectors that are alone."""
    rng = np.random.default_rng(n)
    units = np.vstack([loose_family(rng, n, 64, low, high), rng.normal(size=(n, 64))])
    units = units[rng.permutation(len(units))]
    rows = [(i, v) for i, v in enumerate(units.tolist())]
    found = {r.vec_id: r for r in embeddings.near_duplicates(vectors(spark, rows, "double")).collect()}
    units /= np.linalg.norm(units, axis=1)[:, None]
    linked = units @ units.T >= 0.9
    wanted = linked.sum(axis=1) - 1
    links = np.array([found[i].n_links for i in range(len(rows))])
    assert (links <= wanted).all() and links.sum() >= least * wanted.sum()
    largest = wanted.argmax()
    for i in np.flatnonzero(linked[largest]).tolist():
        assert found[i].component_id == found[largest].component_id


def test_crowds_with_balls_and_neighbours(spark, monkeypatch):
    """Crowds of balls of all radii, near each other, in small blocks: all as by brute force."""
    monkeypatch.setattr(embeddings, "CROWD", 20)
    monkeypatch.setattr(embeddings, "BLOCK", 16)
    rng = np.random.default_rng(4)
    centre = rng.normal(size=16)
    centre /= np.linalg.norm(centre)
    rows = []
    for shift in (0.0, 0.35, 0.5):
        other = centre + shift * np.eye(16)[3]
        for spread in (0.02, 0.2, 0.33):
            noise = rng.normal(size=(50, 16))
            rows += (other + spread * noise / np.linalg.norm(noise, axis=1)[:, None]).tolist()
    rows += rng.normal(size=(100, 16)).tolist()
    check_vectors(spark, [(i, v) for i, v in enumerate(rows)], least=0.98)


def test_edges_that_connect_a_block():
    rng = np.random.default_rng(8)
    for share in (0.0, 0.01, 0.05, 0.5, 1.0):
        whole = rng.random((40, 60)) < share
        pairs = [(i, 100 + j) for i, j in zip(*map(np.ndarray.tolist, np.nonzero(whole)))]
        few = embeddings.chosen_edges(whole, np.arange(40), np.arange(100, 160))
        assert set(few) <= set(pairs) and len(few) <= 160
        nodes = [*range(40), *range(100, 160)]

        def groups(edges):
            index, found = union_find(nodes, edges), {}
            for node, c in index.items():
                found.setdefault(c, set()).add(node)
            return sorted(map(sorted, found.values()))

        assert groups(few) == groups(pairs)
