"""Operators 1, 3, 5, 9 and 10, and the pipeline."""

import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from llm.conftest import ODD
from oracle import connect, in_duckdb, in_spark
from orderlake.llm import class_lm, decontamination, language, licenses, queries, toxicity


def crc(key):
    return zlib.crc32(str(key).encode())


# Decontamination

QUESTION = (
    "Tom has 12 apples and 7 pears in 3 baskets. He gives Mary 5 apples, and Mary eats 2 pears while Tom walks 4 km "
    "to the market. How many apples does Tom still have when Mary comes back after 2 hours?"
)


def found_items(spark, texts, items):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return sorted((r.doc_id, r.item_id) for r in decontamination.contaminated(docs, bench).collect())


def test_reparameterised_question(spark):
    changed = QUESTION.replace("Tom", "Anna").replace("Mary", "Bob").replace("12", "31").replace("km", "miles")
    mixed = QUESTION.replace("Tom", "Anna", 1).replace("Mary", "Bob")
    other = "A quite different text about apples and pears, which shares single words only with the question. " * 3
    texts = [QUESTION, changed, f"Some words before it. {changed} And some behind.", other, None, "", QUESTION.lower()]
    found = found_items(spark, texts, [QUESTION])
    assert [(0, 0), (1, 0), (2, 0)] == [pair for pair in found if pair[0] < 6]
    # Tom is two persons: the slots do not fit together.
    assert found_items(spark, [mixed], [QUESTION]) == []


def test_short_items_and_passages(spark):
    short = "Which planet is the largest?"
    assert found_items(spark, ["He asked: Which planet is the largest? Nobody knew.", "which planet"], [short, None, "", "!!"]) == [(0, 0)]
    passage = " ".join(QUESTION.split()[3:40])
    assert found_items(spark, [passage], [QUESTION]) == [(0, 0)]


def test_copies_in_any_case(spark, sf_dir):
    """Every item is found in each of its copies, whatever their case, and in no copy of another."""
    items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").orderBy("item_id").collect()]
    assert found_items(spark, items, items) == [(i, i) for i in range(len(items))]
    for change in (str.lower, str.upper, str.title):
        texts = [f"Before it. {change(t)} Behind it." for t in items]
        assert found_items(spark, texts, items) == [(i, i) for i in range(len(items))]


def test_runs_share_a_placeholder(spark):
    longer = QUESTION.replace("Tom", "Mary Ann").replace("Mary eats", "Joe eats").replace("gives Mary", "gives Joe")
    longer = longer.replace("when Mary", "when Joe").replace("12", "twenty-five")
    assert found_items(spark, [longer, longer.upper()], [QUESTION]) == [(0, 0), (1, 0)]


def test_one_clash_leaves_windows_word_for_word(spark):
    story = (
        "When Tom came to the village the old miller was out, and nobody in the long street knew where the keys of the "
        "mill were kept or who had seen them last, so he sat down by the water and waited until the evening bells had "
        "rung, and then Tom went home again without a word to anyone in the house."
    )
    clash = story.replace("then Tom", "then Paul")
    half = " ".join(story.split()[:12])
    assert found_items(spark, [story, clash, half], [story]) == [(0, 0), (1, 0)]


def test_slots_against_brute_force(spark):
    """An alignment of the whole item counts if and only if its slots map values to values."""
    rng = random.Random(5)
    names, item = ["Ada", "Ben", "Cleo", "Dora"], "{} sees {} near the old bridge while {} calls {} from behind the tall tower"
    chosen = [[rng.choice(names) for _ in range(4)] for _ in range(60)]
    first = ["Ada", "Ben", "Ada", "Cleo"]
    texts = [item.format(*values) for values in chosen]
    wanted = []
    for i, values in enumerate(chosen):
        consistent = all(values[a] == values[b] for a in range(4) for b in range(4) if first[a] == first[b])
        # Else windows of equal slots are left: spans of eight tokens that hold no changed value.
        at = [0, 2, 8, 10]
        changed = [p for p, old, new in zip(at, first, values) if old != new]
        of = len(item.split()) - 7
        same = [w for w in range(of) if not any(w <= p < w + 8 for p in changed)]
        if consistent or 2 * len(same) >= of:
            wanted.append((i, 0))
    assert 3 < len(wanted) < 57
    assert found_items(spark, texts, [item.format(*first)]) == wanted


def test_given_leaks(spark, sf_dir, docs):
    """Exactly the documents that hold an item word for word."""
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    items = [(r.item_id, r.text) for r in bench.collect()]
    wanted = sorted(
        (r.doc_id, i) for r in docs.collect() for i, t in items if t in r.text
    )
    found = sorted((r.doc_id, r.item_id) for r in decontamination.contaminated(docs, bench).collect())
    assert wanted and found == wanted
    left = decontamination.decontaminate(docs, bench)
    assert left.columns == docs.columns
    assert left.count() == docs.count() - len({d for d, _ in wanted})


def test_odd_texts_and_no_benchmark(spark, odd, none):
    bench = spark.createDataFrame([(1, "The same text twice over, the same text.")], "item_id long, text string")
    assert sorted(r.doc_id for r in decontamination.contaminated(odd, bench).collect()) == [7, 7, 8]
    assert decontamination.decontaminate(odd, bench).count() == len(ODD) - 3
    assert decontamination.decontaminate(odd, bench.limit(0)).count() == len(ODD)
    assert decontamination.contaminated(none, bench).collect() == []


# Toxicity


def brute_nearest(index_rows, query, k):
    scored = [(sum(w * query.get(t, 0) for t, w in row.items()), i) for i, row in enumerate(index_rows)]
    return sorted(((round(s, 9), i) for s, i in scored if s > 0), key=lambda x: (-x[0], x[1]))[:k]


def test_block_max_index_is_exact():
    rng = np.random.default_rng(1)
    rows = []
    for _ in range(700):
        terms = rng.choice(40, size=rng.integers(0, 6), replace=False)
        values = rng.integers(1, 4, size=len(terms)).astype(float)
        norm = np.sqrt((values**2).sum()) if len(terms) else 1
        rows.append(dict(zip(sorted(terms.tolist()), (values / norm).tolist())))
    indptr = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    terms = np.array([t for r in rows for t in r], np.int64)
    weights = np.array([w for r in rows for w in r.values()])
    index = toxicity.BlockMaxIndex(indptr, terms, weights, 40)
    for row in rows[:150]:
        if row:
            ids, scores = index.nearest(np.array(list(row)), np.array(list(row.values())), 9)
            found = [(round(s, 9), i) for i, s in zip(ids.tolist(), scores.tolist())]
            assert found == brute_nearest(rows, row, 9)


def test_toxicity_of_held_out_documents(spark, docs, sf_dir):
    sf = sf_dir.replace("0.001", "0.1")
    docs, labels = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "labels"))
    scored = toxicity.score_toxicity(docs, labels)
    rows = scored.join(labels, "doc_id").filter("held_out").select("score", "predicted", "toxic").collect()
    assert scored.count() == docs.count()
    toxic = [r for r in rows if r.toxic == 1]
    assert sum(r.predicted for r in toxic) >= 0.85 * len(toxic)
    assert sum(r.predicted for r in rows if r.toxic == 0) <= 0.01 * len(rows)


def test_toxicity_of_odd_texts(spark, odd, none):
    words = ["fine", "good", "calm", "kind", "warm"]
    rows = [(100 + i, f"{words[i % 5]} words {'nastyword' if i % 4 == 0 else ''} here", int(i % 4 == 0)) for i in range(120)]
    learnt = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    labels = learnt.select("doc_id", F.lit(1).alias("quality"), "toxic").union(
        spark.createDataFrame([(None, 1, 1), (7, None, None)], "doc_id long, quality int, toxic int")
    )
    more = spark.createDataFrame([(1000, "a nastyword here"), (1001, "a good word")], "doc_id long, text string")
    docs = odd.select("doc_id", "text").union(learnt.select("doc_id", "text")).union(more)
    found = toxicity.score_toxicity(docs, labels).collect()
    assert len(found) == docs.count()
    by_id = {r.doc_id: r for r in found}
    assert by_id[1000].predicted == 1 and by_id[1001].predicted == 0 and by_id[1000].terms and by_id[1000].evidence
    assert by_id[1].score == by_id[2].score == by_id[1001].score
    for row in found:
        assert 0 <= row.score <= 1
        if row.doc_id is not None:
            assert row.held_out == (crc(row.doc_id) % 3 == 1)
    assert [r.score for r in toxicity.score_toxicity(odd, labels.limit(0)).collect()] == [0.5] * len(ODD)
    assert toxicity.score_toxicity(none, labels).collect() == []
    left = toxicity.without_toxic(docs.withColumn("score", F.lit("x")), labels)
    assert left.columns == ["doc_id", "text", "score"]
    assert left.count() == sum(r.predicted == 0 for r in found)


# Language


def test_language_of_held_out_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/documents.parquet")
    found = {r.doc_id: r for r in language.predict_language(docs).collect()}
    rows = docs.collect()
    held = [r for r in rows if found[r.doc_id].held_out]
    assert sum(found[r.doc_id].lang_pred == r.lang for r in held) >= 0.98 * len(held)
    assert all(found[r.doc_id].held_out == (crc(r.doc_id) % 4 == 2) for r in rows)
    left = language.in_known_language(docs)
    assert left.columns == docs.columns and left.count() >= 0.99 * len(rows)


def test_language_of_odd_texts(odd, none, docs):
    both = odd.select("doc_id", "text", F.lit(None).cast("string").alias("lang")).union(docs.select("doc_id", "text", "lang"))
    found = [r for r in language.predict_language(both).collect()]
    assert len(found) == both.count() and all(0 <= r.score <= 1 for r in found)
    one = {r.doc_id: r for r in language.predict_language(odd).collect()}
    assert [one[k].lang_pred for k in (1, 2, 3, 4, 5)] == ["und"] * 4 + ["en"]
    assert one[1].score == 0 and one[5].score == 1
    assert {r.lang_pred for r in language.predict_language(odd.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert language.predict_language(none).collect() == []
    assert language.in_known_language(odd).columns == odd.columns


@pytest.mark.parametrize("codes", ["en fr ru lt ga fi tr hi ta", "en de nl sv fr es it pt ru uk pl cs ar he am mt"])
def test_many_families_stay_in_known_language(spark, codes):
    """Clean text of nine families, and of four families with four languages each."""
    rows = []
    for number, code in enumerate(codes.split()):
        rng = random.Random(number)
        own = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(3, 8))) for _ in range(150)]
        rows += [(1000 * number + i, " ".join(rng.choices(own, k=80)), code) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert language.in_known_language(docs).count() == len(rows)
    found = {r.doc_id: r for r in language.predict_language(docs).collect()}
    assert all(found[k].lang_pred == code and 0.5 < found[k].score <= 1 for k, _, code in rows)


def test_family_comes_first():
    assert language.machines(["de", "en", "es", "fr", "xx"]) == [
        ("family", "germanic", "romance"), ("family", "germanic", "xx"), ("family", "romance", "xx"),
        ("language", "de", "en"), ("language", "es", "fr"),
    ]


# Licences


def test_licenses_equal_sql(spark, sf_dir):
    sf = sf_dir.replace("0.001", "0.01")
    ours = in_spark(queries.QUERIES["op9_license_scan"](spark, sf))
    assert ours[1] and ours == in_duckdb(connect(sf), queries.ORACLES["op9_license_scan"])


def test_licenses_of_odd_texts(spark, odd, none):
    assert licenses.scan_licenses(odd).collect() == []
    assert licenses.scan_licenses(none).collect() == []
    lines = [
        "Words.\nreleased under the  MIT license!\nMore words.",
        "Released\nunder the\nMIT License.",
        "Intro\n\nLicensed under the Apache License,\nVersion 2.0.\n\nEnd",
        "Released under the MIT Licence, maybe, or rather not at all",
        "",
    ]
    rows = spark.createDataFrame([(i, t, "x") for i, t in enumerate(lines)], "doc_id long, text string, license string")
    found = sorted((r.doc_id, r.kind, r.position, r.license) for r in licenses.scan_licenses(rows).collect())
    assert found == [(0, "line", 1, "MIT"), (1, "block", 0, "MIT"), (2, "block", 1, "Apache-2.0"), (2, "text", 0, "Apache-2.0")]
    own = spark.createDataFrame([("one", "word"), ("none", None), ("two", "two words")], "license string, template string")
    text = spark.createDataFrame([(1, "two words"), (2, "two words two words")], "doc_id long, text string")
    assert [(r.doc_id, r.dice) for r in licenses.scan_licenses(text, own).collect()] == [(1, 1.0)]


def best_windows(text, templates, threshold):
    """The best window per licence, by trying all."""

    def bag(words):
        return Counter(zip(words, words[1:]))

    def words_of(text):
        return re.findall(r"[a-z0-9]+", text.lower())

    found, words = {}, words_of(text)
    for name, template in templates:
        wanted = bag(words_of(template))
        m = sum(wanted.values())
        for first in range(len(words) - 1 if m else 0):
            for last in range(first + 1, min(len(words), first + 2 * m + 1)):
                dice = 2 * sum((bag(words[first : last + 1]) & wanted).values()) / (last - first + m)
                if dice >= threshold:
                    found[name] = min(found.get(name, (0, 0)), (-dice, first))
    return sorted((name, first, -minus) for name, (minus, first) in found.items())


def test_licenses_inside_longer_text(spark, odd, none):
    apache = licenses.TEMPLATES["Apache-2.0"][1]
    texts = [
        "Copyright (c) 2020 Foo Bar. Released under the MIT License.",
        f"Some words stand before it, {apache} and others come behind it on the same line.",
        f"Title line\n{licenses.TEMPLATES['MIT'][1]}\nand the next line.",
        "Nothing of the kind, though the License is named and released under the table.",
        "All rights reserved. " * 40,
        None,
        "",
    ]
    rows = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, license long")
    found = {(r.doc_id, r.license): r.dice for r in licenses.embedded_licenses(rows.union(rows.limit(1))).collect()}
    assert found == {(0, "MIT"): 1, (1, "Apache-2.0"): 1, (2, "MIT"): 1, (4, "all-rights-reserved"): 1}
    assert licenses.embedded_licenses(rows.union(rows)).count() == 8
    assert licenses.embedded_licenses(odd).collect() == [] and licenses.embedded_licenses(none).collect() == []


def test_license_windows_against_brute_force(spark):
    rng = random.Random(3)
    templates = [("x", "a b a b c"), ("x", "c d e f a b"), ("y", "b a b a b a"), ("z", "e"), ("w", "a a a a b b")]
    texts = [" ".join(rng.choice("aabbcdef") for _ in range(rng.randrange(0, 60))) for _ in range(150)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    own = spark.createDataFrame(templates, "license string, template string")
    for threshold in (0.8, 0.6):
        found = sorted((r.doc_id, r.license, r.position, r.dice) for r in licenses.embedded_licenses(docs, own, threshold).collect())
        assert found == [(i, *row) for i, text in enumerate(texts) for row in best_windows(text, templates, threshold)]


# Language model


@pytest.mark.parametrize("frame", ["odd", "docs"])
def test_scores_of_the_base_and_the_model(request, frame):
    docs = request.getfixturevalue(frame)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]

    def words(text):
        return re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))

    learnt = [words(t) for k, t in rows if k is None or crc(k) % 10]
    counts = Counter(w for text in learnt for w in text)
    n, v = sum(counts.values()) + len(learnt), len(counts) + 1

    def base(c):
        return math.log10((c + 0.1) / (n + 0.1 * (v + 1)))

    wanted = sorted(
        (-1 if k is None else k, len(words(t)) + 1, sum(counts[w] > 0 for w in words(t)) + 1, n,
         round(sum(base(counts[w]) for w in words(t)) + base(len(learnt)), 4))
        for k, t in rows
    )
    found = class_lm.score_documents(docs).collect()
    assert wanted == sorted(
        (-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in found
    )
    for row in found:
        assert math.isclose(row.perplexity, 10 ** (-row.score / row.n_tokens), rel_tol=1e-9)
    if frame == "docs":
        held = [r for r in found if r.held_out]
        assert held and sum(r.score for r in held) > sum(r.base_score for r in held)


def test_model_sums_to_one(spark, docs):
    """Over every known word and one unknown word per class, after any class."""
    learnt = docs.filter(class_lm.training())
    vocabulary = class_lm.count_words(learnt).cache()
    model = class_lm.fit(vocabulary, learnt, classes=6)
    emitted = np.zeros(6)
    for row in vocabulary.collect():
        c = model.of[model.units.of(bytes(row.word))]
        emitted[c] += (row.n + 0.1) * 10 ** model.emit[c]
    emitted[:5] += 0.1 * 10 ** model.emit[:5]
    emitted[5] += 1  # the end of a text
    assert np.allclose(10**model.moves @ emitted, 1)


def test_exchange_finds_planted_classes():
    rng = np.random.default_rng(2)
    pairs = np.zeros((13, 13))
    state = 0
    for _ in range(6000):
        new = 3 * ((state // 3 + 1) % 4) + rng.integers(3)
        pairs[state, new] += 1
        state = new
    of = class_lm.exchange_clustering(pairs, 5)
    assert all(len(set(of[3 * k : 3 * k + 3])) == 1 for k in range(4)) and len(set(of[:12])) == 4


def test_nothing_to_learn_from(none, odd):
    assert class_lm.score_documents(none).collect() == []
    held = odd.filter("doc_id is not null").withColumn("doc_id", F.lit(10 * 5))
    key = next(k for k in range(100) if crc(k) % 10 == 0)
    found = class_lm.score_documents(held.withColumn("doc_id", F.lit(key).cast("long"))).collect()
    assert {r.train_tokens for r in found} == {0} and {r.n_known for r in found} == {0}


# Pipeline


def test_pipeline_stage_by_stage(spark, sf_dir):
    sf = sf_dir.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    seen = []
    for name, function in corpus_pipeline.STAGES:
        result = function(spark, docs, sf).cache()
        if name != "packing":
            assert result.columns == docs.columns
            assert 0 < result.count() <= docs.count()
            assert result.exceptAll(docs).count() == 0
            docs = result
        seen.append((name, result.count()))
    left = {r.doc_id for r in docs.collect()}
    packed = {r.doc_id for r in result.collect()}
    assert packed == left
    assert [n for n, _ in seen] == ["toxicity", "language", "near duplicates", "decontamination", "packing"]
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf).select("doc_id", "piece", "length").collect())) == sorted(
        map(tuple, result.select("doc_id", "piece", "length").collect())
    )


def test_pipeline_takes_odd_documents(spark, odd, sf_dir):
    docs = odd.select("doc_id", "text", "lang", "source", "n_chars")
    for name, function in corpus_pipeline.STAGES:
        docs = function(spark, docs, sf_dir)
    assert docs.count() > 0
