"""Language of a text, decided in two steps.

First the language family, then the language within it. Each step asks one-versus-one linear support vector
machines, whose margins are turned into probabilities and averaged per candidate over its own machines; the score of
a text is the product of both steps, so a sure one is near 1 whatever the number of families and languages. A family
machine sees all languages of two families, so what separates them is learnt from all; a language machine sees two close languages only and spends its weights on what tells those two apart.

Features are hashed byte n-grams of the whole text, in lower case, letters only, as square roots of their shares.

Fitted on a sample of at most `PER_LANGUAGE` documents per language, taken by a hash. Each machine is trained in a
task of its own.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from orderlake.llm.encode import arrow_groups
from orderlake.llm.scratch import drop, stage

PER_LANGUAGE = 400
MOST_LANGUAGES = 200
ORDERS = (2, 3, 4)
SIZE = 1 << 13
EPOCHS = 30
# Texts whose features are in memory together: 32 KB each.
ROWS = 512
PENALTY = 10.0
UNKNOWN = "und"
LEAST_SCORE = 0.3

# Families of languages by ISO 639-1 code. A language that is not listed is its own family.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb yi",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be pl cs sk sl hr sr bs mk bg",
    "baltic": "lt lv",
    "celtic": "ga gd cy br",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz ky tt",
    "indo-aryan": "hi ur bn mr gu pa ne",
    "dravidian": "ta te kn ml",
    "semitic": "ar he am mt",
    "iranian": "fa ku ps tg",
    "sinitic": "zh",
    "malayo-polynesian": "id ms tl jv mg",
}
_FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes.split()}


def family(language: str) -> str:
    return _FAMILY.get(language.lower().replace("_", "-").split("-")[0], language)


def learnt_from(doc_id: str = "doc_id", parts: int = 4, held: int = 2) -> Column:
    """Whether a document may be learnt from: crc32 of its id as text, modulo `parts`, is not `held`."""
    remainder = F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts
    return F.coalesce(remainder != held, F.lit(True))


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """One row of `SIZE` features per text, and whether it has a letter at all."""
    plain = pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(texts, "")), r"[^\pL]+", " ")
    plain = pc.binary_join_element_wise("", plain, "", " ")
    lengths = pc.binary_length(plain).to_numpy()
    has_letter = pc.match_substring_regex(plain, r"\pL").to_numpy(zero_copy_only=False)
    raw = np.frombuffer(b"".join(plain.cast(pa.binary()).to_pylist()), np.uint8).astype(np.uint32)
    edges = np.concatenate([[0], np.cumsum(lengths)]).tolist()
    result = np.zeros((len(texts), SIZE), np.float32)
    hashed = []
    for order in ORDERS:
        code = np.zeros(max(0, len(raw) - order + 1), np.uint32)
        for k in range(order):
            code = (code << np.uint32(8)) | raw[k : k + len(code)]
        code = (code ^ np.uint32(order << 28)) * np.uint32(2654435761)
        hashed.append((code >> np.uint32(32 - SIZE.bit_length() + 1)).astype(np.uint16))
    for row, (a, b) in enumerate(zip(edges, edges[1:])):
        if has_letter[row]:
            for order, code in zip(ORDERS, hashed):
                counts = np.bincount(code[a : max(a, b - order + 1)], minlength=SIZE)
                result[row] += counts / max(1, b - a)
    return np.sqrt(result), has_letter


def train_svm(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of a linear SVM (L2 loss, dual coordinate descent), scaled for the logistic of the margin;
    the last weight is the constant. `y` is +1 or -1; both occur."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)]).astype(np.float64)
    share = np.array([(y == -1).sum(), (y == 1).sum()]) / len(y)
    cost = PENALTY * 0.5 / share[(y > 0).astype(int)]  # both sides weigh the same
    norm = (x * x).sum(axis=1) + 1 / (2 * cost)
    alpha, w = np.zeros(len(y)), np.zeros(x.shape[1])
    random = np.random.default_rng(7)
    for _ in range(EPOCHS):
        for i in random.permutation(len(y)):
            step = (y[i] * (x[i] @ w) - 1 + alpha[i] / (2 * cost[i])) / norm[i]
            new = max(alpha[i] - step, 0)
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * x[i]
                alpha[i] = new
    # Platt's scale, one number: margins of the sample itself are optimistic, hence the weak pull to 1.
    margin, scale = y * (x @ w), 1.0
    for _ in range(50):
        p = 1 / (1 + np.exp(np.clip(scale * margin, -50, 50)))
        scale += 0.5 * ((margin * p).mean() - 0.001 * (scale - 1))
    return w * scale


def machines(languages: list[str]) -> list[tuple[str, str, str]]:
    """(step, one, other): all pairs of families, and all pairs of languages of one family."""
    families = sorted({family(code) for code in languages})
    found = [("family", a, b) for i, a in enumerate(families) for b in families[i + 1 :]]
    for name in families:
        own = [code for code in languages if family(code) == name]
        found += [("language", a, b) for i, a in enumerate(own) for b in own[i + 1 :]]
    return found


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE) -> tuple[list[str], list, np.ndarray]:
    """Languages, machines, and the machines' weights as columns."""
    usable = docs.filter(learnt_from() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = usable.groupBy("lang").agg(F.count("*").alias("n")).orderBy("lang").limit(MOST_LANGUAGES + 1).collect()
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"over {MOST_LANGUAGES} different values of lang")
    languages = [row.lang for row in counts]
    tasks = machines(languages)
    if not tasks:
        return languages, tasks, np.zeros((SIZE + 1, 0))
    # A sample somewhat too large by a threshold on the hash, cut to size by its order.
    order = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 40))
    bar = F.create_map(
        *[x for row in counts for x in (F.lit(row.lang), F.lit(min(1.0, 2.0 * per_language / row.n + 64 / row.n)))]
    )
    ranked = (
        usable.select("lang", "text", order.alias("order"))
        .filter(F.col("order") < bar[F.col("lang")] * (1 << 40))
        .withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("order")))
        .filter(F.col("rank") <= per_language)
        .select("lang", "text")
    )

    def measure(batches):
        for batch in batches:
            texts = batch.column(1)
            for first, last in arrow_groups(texts, 1 << 20, ROWS):
                values, has_letter = features(texts.slice(first, last - first))
                rows = pa.array([row.tobytes() for row in values], pa.binary())
                part = pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), rows], ["lang", "x"])
                yield part.filter(pa.array(has_letter))

    sample = stage(ranked.mapInArrow(measure, "lang string, x binary"), "language-sample")
    takes_part = [
        F.when(
            F.col("lang").isin([c for c in languages if c in (a, b) or step == "family" and family(c) in (a, b)]),
            F.lit(number),
        )
        for number, (step, a, b) in enumerate(tasks)
    ]

    def train(table: pa.Table) -> pa.Table:
        step, one, other = tasks[table["machine"][0].as_py()]
        x = np.frombuffer(b"".join(table["x"].to_pylist()), np.float32).reshape(-1, SIZE)
        names = table["lang"].to_pylist()
        side = np.array([1.0 if (family(n) if step == "family" else n) == one else -1.0 for n in names])
        # The hash join of a group does not keep an order; the result must not depend on it.
        by = np.lexsort((x @ np.arange(SIZE, dtype=np.float32), side))
        w = train_svm(x[by], side[by]) if len(set(side)) == 2 else np.append(np.zeros(SIZE), 9.0 * side[0])
        return pa.table(
            {"machine": [table["machine"][0].as_py()], "w": [w.astype(np.float32).tobytes()]},
            pa.schema([("machine", pa.int32()), ("w", pa.binary())]),
        )

    rows = (
        sample.withColumn("machine", F.explode(F.array_compact(F.array(*takes_part))))
        .groupBy("machine")
        .applyInArrow(train, "machine int, w binary")
        .collect()
    )
    drop(sample)
    weights = np.zeros((SIZE + 1, len(tasks)), np.float32)
    for row in rows:
        weights[:, row.machine] = np.frombuffer(row.w, np.float32)
    return languages, tasks, weights


def predictor(languages, tasks, weights):
    """Texts -> (language, score) of each."""
    families = sorted({family(code) for code in languages})

    def shares(names, step, chance):
        """Mean probability of each name over its own machines: at best one, however many names there are."""
        total = np.zeros((chance.shape[0], len(names)))
        for number, (kind, a, b) in enumerate(tasks):
            if kind == step and a in names and b in names:
                total[:, names.index(a)] += chance[:, number]
                total[:, names.index(b)] += 1 - chance[:, number]
        return total / (len(names) - 1) if len(names) > 1 else np.ones((len(chance), 1))

    def run(texts: pa.Array):
        x, has_letter = features(texts)
        margin = x @ weights[:-1] + weights[-1]
        chance = 1 / (1 + np.exp(-np.clip(margin.astype(np.float64), -50, 50)))
        found = [(UNKNOWN, 0.0)] * len(texts)
        if not languages:
            return found
        of_family = shares(families, "family", chance)
        best = of_family.argmax(axis=1)
        for number, name in enumerate(families):
            rows = np.flatnonzero((best == number) & has_letter)
            own = [code for code in languages if family(code) == name]
            of_language = shares(own, "language", chance[rows])
            for row, pick, part in zip(rows.tolist(), of_language.argmax(axis=1), of_language.max(axis=1)):
                found[row] = own[pick], float(min(1.0, of_family[row, number] * part))
        return found

    return run


def predict_language(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """One row per row of `docs` (`doc_id`, `text`, `lang`): `doc_id, held_out, lang_pred, score`.

    `und` with score 0 if the text is null or has no letter, or if there is nothing to learn from; the one
    language if there is one. `lang` is read of learnt documents only. Repeated rows count and are predicted
    once each. Other columns are not read.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, per_language))

    def run(batches):
        predict = predictor(*model.value)
        for batch in batches:
            texts = batch.column(2)
            for first, last in arrow_groups(texts, 1 << 20, ROWS):
                size = last - first
                names, scores = zip(*predict(texts.slice(first, size)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, size), batch.column(1).slice(first, size), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                    ["doc_id", "held_out", "lang_pred", "score"],
                )

    return docs.select(
        F.col("doc_id").cast("long"), (~learnt_from()).alias("held_out"), "text"
    ).mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def in_known_language(docs: DataFrame, least_score: float = LEAST_SCORE) -> DataFrame:
    """`docs` without the rows that are in no learnt language: those without a letter, and those whose best
    language scores below `least_score`. All columns stay as they are."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs))
    place = docs.columns.index("text")

    def run(batches):
        predict = predictor(*model.value)
        for batch in batches:
            texts = batch.column(place)
            for first, last in arrow_groups(texts, 1 << 20, ROWS):
                part = batch.slice(first, last - first)
                keep = [name != UNKNOWN and score >= least_score for name, score in predict(part.column(place))]
                yield part.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
