"""Benchmark passages in documents, also with other numbers, names and units in them.

A text becomes a template: numbers, names and units of measure turn into typed placeholders, other words are
lower-cased. Adjacent numbers, and adjacent names, share one placeholder ("twenty-five" is as good as "25", "Mary Ann"
as "Tom"). What is a name does not hang on the case of the text at hand, so copies in capitals, title case or small
letters have the templates of their originals: a word is a name if the benchmark has it with a capital and never
without one, or if it has a capital and the benchmark lacks it.

Every window of `WINDOW` template tokens with enough plain words is hashed, and windows of documents are hash-joined
with windows of benchmark items; items shorter than a window are windows as a whole. Joined windows that lie at one
distance form an alignment, and there the slots are compared: within it, each value of the item must stand for one
value of the document. So "Tom has 3 pears, Tom eats 2" matches "Ann has 9 pears, Ann eats 5", and not a text in which
the second Tom is Bob. Windows whose slots are all equal are copies word for word and count whatever the rest of their
alignment holds.

The words of the benchmark, and the hashes of its windows, are sent to the tasks as bitmaps, whose size is bounded.
Both sides are read with the same bitmap of words, so what falls on a bit by chance does so in both; what the bitmap of
windows lets through by chance falls out of the join.
"""

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from orderlake.llm.encode import text_groups
from orderlake.llm.scratch import drop, stage, struct

WINDOW = 8
LEAST_PLAIN = 4
LEAST_COVERAGE = 0.5
LEAST_TOKENS = 32
MOST_BITS = 1 << 26
REMEMBERED = 500_000

TOKEN = re.compile(r"\d+(?:[.,]\d+)*|[^\W\d_]+|[%$€£°]")
# Number words and units that count as slots.
NUMBER_WORDS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen "
    "seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand "
    "million billion half twice thrice"
).split()
UNITS = (
    "% $ € £ ° mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms ton "
    "tons ounce ounces pound pounds ml l liter liters litre litres gallon gallons second seconds minute "
    "minutes hour hours day days week weeks month months year years cent cents dollar dollars euro euros "
    "degree degrees percent meter meters metre metres kilometer kilometers watt watts volt volts"
).split()
NUMBER, NAME, UNIT = 1, 2, 3


_NUMBERS, _UNITS = frozenset(NUMBER_WORDS), frozenset(UNITS)


def word_code(word: str) -> int:
    """Hash of a lower-case word, above all kinds."""
    return xxhash.xxh64_intdigest(word) | 4


class Lexicon:
    """Codes of tokens by what the benchmark's words are: two bitmaps, of its plain words and of its names."""

    def __init__(self, plain: np.ndarray, names: np.ndarray):
        self.plain, self.names = memoryview(plain), memoryview(names)
        # Token -> place in the table of codes: small integers are the quickest way into an array.
        self.places: dict[str, int] = {}
        self.table = np.zeros(1024, np.uint64)

    @staticmethod
    def holds(bits: memoryview, code: int) -> bool:
        mask = 64 * len(bits) - 1
        place = code & mask
        if not bits[place >> 6] >> (place & 63) & 1:
            return False
        place = code >> 32 & mask
        return bool(bits[place >> 6] >> (place & 63) & 1)

    def canonical(self, token: str) -> int:
        """Code of a token: its kind if it is a placeholder, else a hash above all kinds."""
        lower = token.lower()
        if token[0].isdigit() or lower in _NUMBERS:
            return NUMBER
        if lower in _UNITS:
            return UNIT
        code = word_code(lower)
        if (token[0].isupper() or self.holds(self.names, code)) and not self.holds(self.plain, code):
            return NAME
        return code

    def codes(self, tokens: list[str]) -> np.ndarray:
        places = self.places
        if len(places) > REMEMBERED:
            places.clear()
        try:
            found = np.fromiter(map(places.__getitem__, tokens), np.int64, len(tokens))
        except KeyError:
            for token in set(tokens).difference(places):
                place = places[token] = len(places)
                if place == len(self.table):
                    self.table = np.concatenate([self.table, np.zeros_like(self.table)])
                self.table[place] = self.canonical(token)
            found = np.fromiter(map(places.__getitem__, tokens), np.int64, len(tokens))
        return self.table[found]


class Template:
    """Tokens of one text and their codes; a run of numbers or of names is one token."""

    def __init__(self, text: str | None, lexicon: Lexicon):
        self.tokens = TOKEN.findall(text) if text else []
        codes = lexicon.codes(self.tokens)
        runs = (codes == NUMBER) | (codes == NAME)
        first = np.ones(len(codes), bool)
        first[1:] = ~(runs[1:] & (codes[1:] == codes[:-1]))
        self.starts = np.append(np.flatnonzero(first), len(codes))
        self.codes = codes[first]

    def windows(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions and hashes of the windows of this width that have enough plain words."""
        n = len(self.codes) - width + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        with np.errstate(over="ignore"):
            value = np.full(n, width, np.uint64)
            for k in range(width):
                value = value * np.uint64(0x9E3779B97F4A7C15) + self.codes[k : k + n]
                value ^= value >> np.uint64(29)
            value *= np.uint64(0xBF58476D1CE4E5B9)
            value ^= value >> np.uint64(32)
        plain = np.cumsum(np.concatenate([[0], self.codes > UNIT]))
        keep = np.flatnonzero(plain[width:] - plain[:n] >= min(LEAST_PLAIN, (width + 1) // 2))
        return keep, value[keep]

    def slots(self, start: int, width: int) -> list[str]:
        """Values in the placeholders of a window, each after its kind."""
        return [
            f"{self.codes[i]}{' '.join(self.tokens[self.starts[i] : self.starts[i + 1]]).lower()}"
            for i in range(start, start + width)
            if self.codes[i] <= UNIT
        ]


def benchmark_words(benchmark: DataFrame) -> DataFrame:
    """Words of the items: `word` (its hash) and `name`, whether it is one. Items with capitals on half of
    their words or more (in capitals, or titles) say nothing about that."""

    def run(batches):
        for batch in batches:
            for text in batch.column(0).to_pylist():
                words = {t for t in TOKEN.findall(text or "") if t[0].isalpha()}
                telling = 2 * sum(w[0].isupper() for w in words) < len(words)
                codes = np.array([word_code(w.lower()) for w in words], np.uint64).view(np.int64)
                kinds = [[telling and w[0].isupper() == capital for w in words] for capital in (True, False)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(codes), *(pa.array(kind, pa.bool_()) for kind in kinds)], ["word", "capital", "small"]
                )

    words = benchmark.select("text").mapInArrow(run, "word long, capital boolean, small boolean").groupBy("word")
    seen = words.agg(F.max("capital").alias("capital"), F.max("small").alias("small"))
    return seen.select("word", (F.col("capital") & ~F.col("small")).alias("name"))


def _windows(key: str, kind: str, lexicon, chosen) -> tuple:
    """The task that turns (key, text) rows into window rows. `lexicon` is a broadcast pair of bitmaps."""
    schema = T.StructType(
        struct(f"{key} {kind}, at integer, width integer, code long, n_tokens integer").fields
        + [T.StructField("slots", T.ArrayType(T.StringType()))]
    )
    arrow = pa.schema(
        [
            (key, {"long": pa.int64(), "string": pa.string()}[kind]),
            ("at", pa.int32()),
            ("width", pa.int32()),
            ("code", pa.int64()),
            ("n_tokens", pa.int32()),
            ("slots", pa.list_(pa.string())),
        ]
    )

    def run(batches):
        words = Lexicon(*lexicon.value)
        pick = chosen()
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for first, last in text_groups(texts):
                rows = []
                for name, text in zip(keys[first:last], texts[first:last]):
                    template = Template(text, words)
                    for width, at, codes in pick(template):
                        n = len(template.codes)
                        rows += [
                            (name, a, width, c, n, template.slots(a, width))
                            for a, c in zip(at.tolist(), codes.view(np.int64).tolist())
                        ]
                if rows:
                    columns = list(zip(*rows))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow
                    )

    return run, schema


def benchmark_windows(benchmark: DataFrame, lexicon) -> DataFrame:
    """Windows of the items: `item_id, at, width, code, n_tokens, slots`. An item shorter than a window is
    one window of its own width; one without words gives none."""

    def chosen():
        def pick(template):
            width = min(WINDOW, len(template.codes))
            return [(width, *template.windows(width))] if width else []

        return pick

    run, schema = _windows("item_id", "long", lexicon, chosen)
    return benchmark.select(F.col("item_id").cast("long"), "text").mapInArrow(run, schema)


def bitmap(codes: DataFrame) -> np.ndarray:
    """Bits at all hashes (`code`). At most `MOST_BITS` bits, so it is small however large the benchmark; the
    tasks combine the bits of a word before they are sent."""
    size = 1 << 16
    n = codes.count()
    while size < min(64 * n, MOST_BITS):
        size *= 2
    bit = F.col("code").bitwiseAND(F.lit(size - 1))
    word = F.shiftright(bit, 6).alias("word")
    value = F.call_function("shiftleft", F.lit(1).cast("long"), bit.bitwiseAND(F.lit(63)).cast("int"))
    rows = codes.groupBy(word).agg(F.bit_or(value).alias("bits")).toPandas()
    bits = np.zeros(size // 64, np.int64)
    bits[rows["word"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64)
    return bits.view(np.uint64)


def lexicon_of(benchmark: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Bitmaps of the benchmark's plain words and of its names, two bits a word."""
    words = stage(benchmark_words(benchmark), "benchmark-words")
    code = F.explode(F.array(F.col("word"), F.shiftrightunsigned("word", 32))).alias("code")
    bits = tuple(bitmap(words.filter(F.col("name") == name).select(code)) for name in (False, True))
    drop(words)
    return bits


def document_windows(docs: DataFrame, key: str, kind: str, lexicon, filter_) -> DataFrame:
    """Windows of whole texts that the bitmap lets through."""

    def chosen():
        bits, widths = filter_.value
        mask = np.uint64(64 * len(bits) - 1)

        def pick(template):
            for width in widths:
                at, codes = template.windows(width)
                place = codes & mask
                hit = (bits[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1)
                hit = hit.astype(bool)
                if hit.any():
                    yield width, at[hit], codes[hit]

        return pick

    run, schema = _windows(key, kind, lexicon, chosen)
    return docs.select(key, "text").mapInArrow(run, schema)


def matches(docs: DataFrame, benchmark: DataFrame, key: str) -> DataFrame:
    """Items found in texts, per distinct `key` (a string column of `docs`): `key, item_id, n_windows,
    coverage, n_changed`.

    An item counts as found if consistent alignments, and windows with equal slots of others, cover
    `LEAST_COVERAGE` of its windows or `LEAST_TOKENS` of its tokens. `n_changed` is the number of slot values that
    differ in a consistent alignment. `item_id` null is an item like others;
    items of equal id count as one.
    """
    spark = docs.sparkSession
    lexicon = spark.sparkContext.broadcast(lexicon_of(benchmark))
    items = stage(benchmark_windows(benchmark, lexicon), "benchmark-windows")
    widths = sorted(row.width for row in items.select("width").distinct().collect())
    filter_ = spark.sparkContext.broadcast((bitmap(items.select("code")), widths))
    found = document_windows(docs, key, "string", lexicon, filter_).withColumnsRenamed(
        {"at": "place", "slots": "values"}
    )
    hits = found.drop("n_tokens").join(items, ["code", "width"])
    pair = F.arrays_zip("slots", "values")
    aligned = (
        hits.withColumn("shift", F.col("place") - F.col("at"))
        .groupBy(key, "item_id", "shift")
        .agg(
            F.collect_set("at").alias("at"),
            F.collect_set(F.when(F.col("slots") == F.col("values"), F.col("at"))).alias("equal"),
            F.max("n_tokens").alias("n_tokens"),
            F.max("width").alias("width"),
            F.array_distinct(F.flatten(F.collect_set(pair))).alias("pairs"),
        )
    )
    values = F.array_distinct(F.transform("pairs", lambda p: p["slots"]))
    changed = F.size(F.filter("pairs", lambda p: p["slots"] != p["values"]))
    sizes = items.groupBy(F.col("item_id").alias("item")).agg(F.countDistinct("at").alias("of"))
    together = (
        aligned.withColumn("consistent", F.size(values) == F.size("pairs"))
        .withColumn("at", F.when(F.col("consistent"), F.col("at")).otherwise(F.col("equal")))
        .withColumn("changed", F.when(F.col("consistent"), changed).otherwise(0))
        .filter(F.size("at") > 0)
        .groupBy(key, "item_id")
        .agg(
            F.size(F.array_distinct(F.flatten(F.collect_set("at")))).alias("n_windows"),
            F.max("width").alias("width"),
            F.min("changed").alias("n_changed"),
        )
    )
    share = F.col("n_windows") / F.col("of")
    return (
        together.join(sizes, F.col("item_id").eqNullSafe(F.col("item")))
        .filter(
            (share >= LEAST_COVERAGE) | (F.col("n_windows") + F.col("width") - 1 >= LEAST_TOKENS)
        )
        .select(key, "item_id", F.col("n_windows").cast("long"), share.alias("coverage"), "n_changed")
    )


def _keyed(docs: DataFrame) -> DataFrame:
    """Add the key of a text: what is found depends on the text alone, so equal texts share it."""
    return docs.withColumn("text_key", F.sha1(F.coalesce("text", F.lit("")).cast("binary")))


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and item found in it: `doc_id, item_id, n_windows, coverage, n_changed`.

    Null and empty texts match nothing. Repeated rows of `docs` give repeated rows. Only `doc_id` and `text`
    are read. An empty benchmark gives no row.
    """
    keyed = _keyed(docs.select("doc_id", "text"))
    found = stage(matches(keyed, benchmark, "text_key"), "contaminated")
    return (
        keyed.select("doc_id", "text_key")
        .join(found, "text_key")
        .select("doc_id", "item_id", "n_windows", "coverage", "n_changed")
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """`docs` without the rows in whose text an item was found."""
    columns = docs.columns
    keyed = _keyed(docs)
    found = stage(matches(keyed, benchmark, "text_key").select("text_key").distinct(), "contaminated")
    return keyed.join(found, "text_key", "left_anti").select(*columns)
