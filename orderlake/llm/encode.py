"""Token ids of whole texts by a `tokenizers` file, word by word.

The normaliser and pre-tokeniser of the file treat what stands between white space independently, so the
ids of a text are those of its chunks in order, and a worker encodes a chunk once. The file must be one
of that kind: `Encoder` encodes a probe both ways and, if they differ, encodes texts whole.
"""

import re
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

from orderlake.llm.scratch import worker_cache

# White space to every library involved (Arrow splits at the same); other kinds stay inside a chunk and go
# to the tokenizer.
SPACE = re.compile("[ \t\n\r\x0b\x0c]+")
# A full stop or comma between a letter and white space is cut off: tokenizers of the kind meant here do so, and
# there are far fewer different words without such marks.
MARKED = "([a-zß-öø-ÿ])([.,])([ \t\n\r\x0b\x0c])"
# Chunks that a worker remembers, about 200 bytes each.
REMEMBERED = 400_000
PROBE = "It's 2 o'clock,  é. Ende, fin.\nWORD word. <|x|>\tñandú -- a1b2\n"


def read_tokenizer(spark: SparkSession, path: str):
    """The tokenizer file as a broadcast text. Its size is checked: vocabularies are a few MB."""
    if Path(path).stat().st_size > 64 << 20:
        raise ValueError(f"{path} is no tokenizer file: over 64 MB")
    return spark.sparkContext.broadcast(Path(path).read_text(encoding="utf-8"))


class Encoder:
    """Texts -> little-endian ids, two bytes each if the vocabulary allows it, else four."""

    def __init__(self, content: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        key = ("encoder", zlib.crc32(content.encode()))
        self.state = worker_cache(key)
        if not self.state:
            tokenizer = Tokenizer.from_str(content)
            size = tokenizer.get_vocab_size(with_added_tokens=True)
            ends = np.zeros(size, bool)
            for piece, number in tokenizer.get_vocab(with_added_tokens=False).items():
                ends[number] = piece.endswith("</w>")
            self.state |= {
                "tokenizer": tokenizer,
                "ends": ends,
                "dtype": np.dtype("<u2" if size <= 1 << 16 else "<u4"),
                "chunks": {},
            }
        self.tokenizer, self.dtype = self.state["tokenizer"], self.state["dtype"]
        self.chunks = self.state["chunks"]
        chunks = [c for c in SPACE.split(re.sub(MARKED, r"\1 \2\3", PROBE.lower())) if c]
        self.by_chunk = self._ids([PROBE])[0] == b"".join(self._ids(chunks))

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, self.dtype).tobytes() for x in found]

    def _learn(self, chunks: list[str]) -> None:
        """Chunks of letters only are encoded as one text and cut where a piece ends a word."""
        words = [chunk for chunk in chunks if chunk.isalpha()]
        rest = [chunk for chunk in chunks if not chunk.isalpha()]
        ids = np.frombuffer(self._ids([" ".join(words)])[0], self.dtype)
        cuts = np.flatnonzero(self.state["ends"][ids]) + 1
        if len(cuts) == len(words) and len(ids) == (cuts[-1] if len(cuts) else 0):
            raw, edges = ids.tobytes(), [0, *(cuts * self.dtype.itemsize).tolist()]
            self.chunks.update((w, raw[a:b]) for w, a, b in zip(words, edges, edges[1:]))
        else:
            rest = chunks
        self.chunks.update(zip(rest, self._ids(rest)))

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each whole text; a null text has none."""
        texts = pc.fill_null(texts, "")
        # A special token is one only as it is written, and lower-casing could make one.
        if not self.by_chunk or pc.any(pc.match_substring(texts, "<|")).as_py():
            return [np.frombuffer(x, self.dtype) for x in self._ids(texts.to_pylist())]
        lists = pc.ascii_split_whitespace(
            pc.replace_substring_regex(pc.ascii_lower(texts), MARKED, r"\1 \2\3")
        )
        coded = lists.flatten().dictionary_encode()
        chunks, codes = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        if len(self.chunks) > REMEMBERED:
            self.chunks.clear()
        self.chunks[""] = b""  # before leading and after trailing white space
        found = list(map(self.chunks.get, chunks))
        fresh = [i for i, ids in enumerate(found) if ids is None]
        if fresh:
            self._learn([chunks[i] for i in fresh])
            for i in fresh:
                found[i] = self.chunks[chunks[i]]
        pool = np.frombuffer(b"".join(found), self.dtype)
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // self.dtype.itemsize
        starts = np.cumsum(sizes) - sizes
        lengths = sizes[codes]
        ends = np.cumsum(lengths)
        ids = pool[np.repeat(starts[codes] - (ends - lengths), lengths) + np.arange(lengths.sum())]
        words = lists.offsets.to_numpy()
        cuts = np.concatenate([[0], ends])[words - words[0]].tolist()
        return [ids[a:b] for a, b in zip(cuts, cuts[1:])]


def ids_crc32(ids: np.ndarray) -> int:
    """CRC-32 of the ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())


def text_groups(texts: list[str | None], most: int = 4 << 20):
    """Ranges of consecutive texts of at most `most` characters together, a longer text alone."""
    return _ranges((len(text or "") for text in texts), most)


def arrow_groups(texts: pa.Array, most: int = 4 << 20, rows: int = 1 << 30):
    """The same for an Arrow column, by bytes, and of at most `rows` texts."""
    return _ranges(pc.fill_null(pc.binary_length(texts), 0).to_pylist(), most, rows)


def _ranges(lengths, most: int, rows: int = 1 << 30):
    start = size = count = 0
    for i, length in enumerate(lengths):
        if i > start and (size + length > most or i - start == rows):
            yield start, i
            start, size = i, 0
        size += length
        count = i + 1
    if start < count:
        yield start, count
