"""Operators 2, 4 and 8: token ids, counts, packing and files."""

import math
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from orderlake.llm import packing, token_counts as counts, token_files as files
from orderlake.llm.queries import UNIGRAM, WORD_BPE
from orderlake.llm.scratch import new_folder

END = 2


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(WORD_BPE)


def ids(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def crc(values):
    return zlib.crc32(np.array(values, "<u4").tobytes())


def expected_pieces(tokenizer, rows):
    for key, text in rows:
        all_ids = ids(tokenizer, text) + [0]
        for number, start in enumerate(range(0, len(all_ids), 2048)):
            part = all_ids[start : start + 2048]
            yield key, number, start, len(part), crc(part)


def key_of(row):
    return tuple(-1 if v is None else v for v in row)


def check_plan(plan):
    bins = {}
    for row in plan:
        bins.setdefault(row.sequence_id, []).append((row.offset, row.length))
    for parts in bins.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 2048
    return len(bins)


@pytest.mark.parametrize("frame", ["odd", "docs"])
def test_packing_is_whole_and_gapless(request, tokenizer, frame):
    docs = request.getfixturevalue(frame)
    plan = packing.pack_documents(docs, WORD_BPE).collect()
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    found = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in plan]
    assert sorted(found, key=key_of) == sorted(expected_pieces(tokenizer, rows), key=key_of)
    lengths = np.array([r.length for r in plan])
    assert packing.lower_bound(np.bincount(lengths)) <= check_plan(plan)


def test_packing_in_many_groups_exchanges_documents(docs):
    pieces = packing.encode_pieces(docs, WORD_BPE)
    few = check_plan(packing.pack(pieces, group_rows=1_000_000).collect())
    many = packing.pack(pieces, group_rows=10).collect()
    assert len(many) == pieces.count()
    assert few <= check_plan(many) <= few * 1.1


def test_packed_sequences_hold_the_ids(tokenizer, docs):
    plan = packing.pack_documents(docs, WORD_BPE)
    texts = {r.doc_id: r.text for r in docs.collect()}
    sequences = {r.sequence_id: r for r in packing.packed_sequences(docs, plan, WORD_BPE).collect()}
    for row in plan.collect():
        whole = ids(tokenizer, texts[row.doc_id]) + [0]
        sequence = sequences[row.sequence_id]
        assert sequence.ids[row.offset : row.offset + row.length] == whole[row.start : row.start + row.length]
        assert row.doc_id in sequence.doc_ids and sequence.length == len(sequence.ids)


def test_nothing_to_pack(none):
    assert packing.pack_documents(none, WORD_BPE).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=60))
def test_best_fit_and_bound(lengths):
    """Against the plain algorithm, and the bound against what any packing needs."""
    ordered = np.array(sorted(lengths, reverse=True), np.int64)
    if not len(ordered):
        assert packing.lower_bound(np.zeros(41, np.int64), 40) == 0
        return
    bins, offsets = packing.best_fit_decreasing(ordered, 40)
    fill = []
    for length in ordered.tolist():
        fits = [f for f in fill if f + length <= 40]
        best = max(fits, default=None)
        if best is None:
            fill.append(length)
        else:
            fill[fill.index(best)] += length
    assert sorted(np.bincount(bins, ordered).tolist()) == sorted(fill)
    assert packing.lower_bound(np.bincount(ordered, minlength=41), 40) <= len(fill)
    for b in set(bins.tolist()):
        inside = sorted(zip(offsets[bins == b].tolist(), ordered[bins == b].tolist()))
        assert [o for o, _ in inside] == [sum(n for _, n in inside[:i]) for i in range(len(inside))]


@pytest.mark.parametrize("frame", ["odd", "docs"])
def test_files_round_trip(request, tokenizer, frame):
    docs = request.getfixturevalue(frame)
    found = files.token_table(docs.sparkSession, docs, WORD_BPE).collect()
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in found), key=key_of) == sorted(
        ((k, len(i) + 1, crc(i + [END])) for k, i in ((k, ids(tokenizer, t)) for k, t in rows)), key=key_of
    )
    start = 0
    for row in sorted(found, key=lambda r: r.start):
        assert row.start == start
        start += row.n_tokens
    keys = [-1 if r.doc_id is None else r.doc_id for r in sorted(found, key=lambda r: r.start)]
    assert keys == sorted(keys)


def test_no_files(none):
    assert files.token_table(none.sparkSession, none, WORD_BPE).collect() == []


def test_lookup_by_key(spark, tokenizer, docs):
    folder = new_folder(spark, "lookup")
    manifest = files.write_token_files(docs, folder, WORD_BPE, shards=3)
    asked = spark.createDataFrame([(0,), (7,), (7,), (199,), (10**12,), (-5,), (None,)], "doc_id long")
    found = {r.doc_id: r.ids for r in files.lookup(asked, manifest, folder).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert found == {k: ids(tokenizer, texts[k]) + [END] for k in (0, 7, 199)}


@settings(max_examples=100, deadline=None)
@given(st.sets(st.integers(-(2**63), 2**63 - 1), max_size=300))
def test_perfect_hash(keys):
    keys = np.array(sorted(keys), np.int64)
    table = files.PerfectHash.build(keys)
    assert sorted(table.find(keys).tolist()) == list(range(len(keys)))


def brute_count(word, scores, unknown):
    best, tokens = [0.0] + [-math.inf] * len(word), [0] * (len(word) + 1)
    for i in range(1, len(word) + 1):
        for k in range(1, min(i, 20) + 1):
            score = scores.get(word[i - k : i])
            if score is not None and best[i - k] + score >= best[i]:
                best[i], tokens[i] = best[i - k] + score, tokens[i - k] + 1
        if best[i - 1] + unknown > best[i]:
            best[i], tokens[i] = best[i - 1] + unknown, tokens[i - 1] + len(word[i - 1].encode())
    return tokens[-1]


@pytest.mark.parametrize("frame", ["odd", "docs"])
def test_token_counts_equal_plain_segmentation(request, frame):
    docs = request.getfixturevalue(frame)
    pieces, values, _ = counts.read_pieces(UNIGRAM)
    scores, unknown = dict(zip(pieces, values)), min(values) - counts.UNKNOWN_PENALTY
    memo = {}

    def count(word):
        if word not in memo:
            memo[word] = brute_count(counts.MARKER + word, scores, unknown)
        return memo[word]

    expected = []
    for row in docs.select("doc_id", "text").collect():
        words = re.findall("[^\x20\x09-\x0d]+", row.text or "")
        expected.append((row.doc_id, len(words), sum(map(count, words))))
    found = [tuple(r) for r in counts.token_counts(docs, UNIGRAM).collect()]
    assert sorted(found, key=key_of) == sorted(expected, key=key_of)


def test_no_token_counts(none):
    assert counts.token_counts(none, UNIGRAM).collect() == []
