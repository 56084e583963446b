"""Token counts under a unigram vocabulary, by dynamic programming over a trie of pre-tokens.

A pre-token is a word with the word marker before it; a text's count is the sum over its words. The best
segmentation of a pre-token is the one with the highest sum of piece scores. The forward score of a prefix is the
same in every pre-token that begins with it, so the distinct pre-tokens are put into a trie and each node is scored
once, level by level: the score of a node is the best over the pieces that end there of the ancestor's score plus the
piece's. The node where a pre-token ends stores its number of tokens.

A worker builds a trie per stretch of text for the pre-tokens it has not counted yet, and remembers counts of a
bounded number of them. Nothing is shuffled. Pieces and scores come from a vocabulary file; they are not trained here.

Characters that no piece covers count as one token per UTF-8 byte if the vocabulary has byte pieces, else as one
token, with a score below all others.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from orderlake.llm.encode import arrow_groups
from orderlake.llm.scratch import worker_cache

MARKER = "▁"
REMEMBERED = 600_000
UNKNOWN_PENALTY = 10.0


def read_pieces(path: str) -> tuple[list[str], list[float], bool]:
    """Pieces of text and their scores in a sentencepiece file, and whether it has byte pieces.

    The scores of a BPE file are negative merge ranks. Taken as ranks of Zipf's law they give log
    probabilities: -log(rank + 2), so that a frequent piece costs little and every piece something.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, scores, bytes_ = [], [], False
    for number in range(model.get_piece_size()):
        if model.is_byte(number):
            bytes_ = True
        elif not (model.is_control(number) or model.is_unknown(number) or model.is_unused(number)):
            pieces.append(model.id_to_piece(number))
            scores.append(-float(np.log(-model.get_score(number) + 2)))
    return pieces, scores, bytes_


class Pieces:
    """Pieces by length in characters, as sorted hashes."""

    def __init__(self, pieces: list[str], scores: list[float], byte_pieces: bool):
        self.longest = max(map(len, pieces), default=0)
        self.byte_pieces = byte_pieces
        self.unknown = min(scores, default=0.0) - UNKNOWN_PENALTY
        self.tables = []
        for length in range(1, self.longest + 1):
            own = [(p, s) for p, s in zip(pieces, scores) if len(p) == length]
            hashes = _hashes(np.array([[ord(c) for c in p] for p, _ in own], np.uint64).reshape(-1, length))
            order = np.argsort(hashes)
            self.tables.append((hashes[order], np.array([s for _, s in own])[order]))

    def score(self, hashes: np.ndarray, length: int) -> np.ndarray:
        """Scores of the strings with these hashes, -inf where they are no piece."""
        known, scores = self.tables[length - 1]
        if not len(known):
            return np.full(len(hashes), -np.inf)
        at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
        return np.where(known[at] == hashes, scores[at], -np.inf)


MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _mix(codes: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (codes + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(31))


def _hashes(rows: np.ndarray) -> np.ndarray:
    """Hash of each row of characters: a polynomial with the last character last."""
    value = np.zeros(len(rows), np.uint64)
    with np.errstate(over="ignore"):
        for column in rows.T:
            value = value * MULTIPLIER + _mix(column)
    return value


def count_tokens(words: list[str], pieces: Pieces) -> list[int]:
    """Tokens of each word's best segmentation, over one trie of all words.

    Equal scores: the segmentation with the longer last piece wins, at every prefix.
    """
    lengths = np.array([len(w) for w in words], np.int64)
    chars = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.uint64)
    starts = np.cumsum(lengths) - lengths
    # Level by level: a node is a distinct (parent, character); `node` is where each word stands.
    node = np.zeros(len(words), np.int64)
    result = np.zeros(len(words), np.int64)
    # Per level, per node: score, tokens, parent in the level above, hash of its last 0..longest characters.
    levels = [(np.zeros(1), np.zeros(1, np.int64), np.zeros(1, np.int64))]
    suffixes = [np.zeros(1, np.uint64)]
    power = np.ones(pieces.longest + 1, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(1, pieces.longest + 1):
            power[k] = power[k - 1] * MULTIPLIER
    alive = np.flatnonzero(lengths > 0)
    depth = 0
    while len(alive):
        letter = chars[starts[alive] + depth]
        cell = (node[alive].astype(np.uint64) << np.uint64(21)) | letter
        cells, first, place = np.unique(cell, return_index=True, return_inverse=True)
        parent, letter = (cells >> np.uint64(21)).astype(np.int64), cells & np.uint64((1 << 21) - 1)
        node[alive] = place
        depth += 1
        mixed = _mix(letter)
        best = np.full(len(cells), -np.inf)
        tokens = np.zeros(len(cells), np.int64)
        ancestor, hashes, fresh = parent, [], np.zeros(len(cells), np.uint64)
        with np.errstate(over="ignore"):
            # Hash of the last k characters: the parent's last k-1, shifted, and this one.
            for k in range(1, min(depth, pieces.longest) + 1):
                own = mixed if k == 1 else suffixes[k - 2][parent] * MULTIPLIER + mixed
                hashes.append(own)
                score, count, _ = levels[-k]
                value = score[ancestor] + pieces.score(own, k)
                better = value >= best
                better &= value > -np.inf
                best = np.where(better, value, best)
                tokens = np.where(better, count[ancestor] + 1, tokens)
                ancestor = levels[-k][2][ancestor]
        unknown = levels[-1][0][parent] + pieces.unknown
        lone = unknown > best
        if pieces.byte_pieces:
            size = 1 + (letter >= 0x80) + (letter >= 0x800) + (letter >= 0x10000)
        else:
            size = np.ones(len(cells), np.int64)
        best = np.where(lone, unknown, best)
        tokens = np.where(lone, levels[-1][1][parent] + size, tokens)
        levels.append((best, tokens, parent))
        levels = levels[-(pieces.longest + 1) :]
        suffixes = hashes
        ended = lengths[alive] == depth
        result[alive[ended]] = tokens[node[alive[ended]]]
        alive = alive[~ended]
    return result.tolist()


def token_counts(docs: DataFrame, vocabulary: str) -> DataFrame:
    """One row per row of `docs`: `doc_id`, `n_pretokens`, `n_tokens`. A null, empty or blank text has none.
    Repeated rows are counted once each; other columns are not read."""
    spark: SparkSession = docs.sparkSession
    shared = spark.sparkContext.broadcast(read_pieces(vocabulary))

    def run(batches):
        state = worker_cache(("pieces", vocabulary))
        if not state:
            state |= {"pieces": Pieces(*shared.value), "known": {}}
        pieces, known = state["pieces"], state["known"]
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "")
            for first, last in arrow_groups(texts):
                lists = pc.ascii_split_whitespace(texts.slice(first, last - first))
                coded = lists.flatten().dictionary_encode()
                words = coded.dictionary.to_pylist()
                if len(known) > REMEMBERED:
                    known.clear()
                known[""] = 0
                fresh = [word for word in words if word not in known]
                if fresh:
                    known.update(zip(fresh, count_tokens([MARKER + word for word in fresh], pieces)))
                count = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
                codes = coded.indices.to_numpy()
                sums = np.concatenate([[0], np.cumsum(count[codes])]) if len(codes) else np.zeros(1, np.int64)
                real = np.array([word != "" for word in words], np.int64)
                seen = np.concatenate([[0], np.cumsum(real[codes])]) if len(codes) else np.zeros(1, np.int64)
                cuts = lists.offsets.to_numpy() - lists.offsets[0].as_py()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first)]
                    + [pa.array(np.diff(x[cuts]), pa.int64()) for x in (seen, sums)],
                    ["doc_id", "n_pretokens", "n_tokens"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_pretokens long, n_tokens long"
    )
