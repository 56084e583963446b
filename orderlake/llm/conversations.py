"""Repair of the turn structure of conversations by cheapest edits, with Four-Russians block tables.

A conversation is a word of role initials. It is edited into `(s?(ua)+)?` by keeping a row (0), giving it the role
user or assistant (`REROLE`), deleting it (`DELETE`; blank and duplicate rows must go) or inserting an empty turn
(`INSERT`); a truncated row that stays costs `TRUNCATED` more. The costs from a place to the end, one for each of the
four states of that pattern, differ by less than eight, so less their minimum only a few vectors exist. For every
vector and every block of `BLOCK` symbols a table holds the vector before the block and what is added; a conversation
is read from its end, a block per lookup. Then it is traced from its start: each block is expanded backward into the
vectors between its rows, and of all cheapest edits the least letter is taken (D < I < K < R), which gives the least
string. Expanded blocks are remembered.

Rows are sorted over the cluster by conversation and turn, by ranges, so that a conversation of any size is spread
over tasks. One that lies within a task is solved there. Of the others each chunk of at most `CHUNK_ROWS` rows is
summed up as the effect that it has on every vector and, given a vector, on every state; the effects of all chunks
(some hundred bytes each) are composed per conversation, and the chunks are then traced one by one.

Rows of one turn are in the order of their role, the first 64 characters of their text and a hash of it. A null role
or text counts as one space. Rows without a turn come first; rows without a conversation id are one conversation.
Repeated rows are rows: the first counts, the others are duplicates. An empty table gives no rows. Other columns are
not read.
"""

import hashlib
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from orderlake.llm.scratch import stage, worker_cache

KEEP, INSERT, REROLE, DELETE, TRUNCATED = 0, 3, 3, 4, 3
BLOCK = 4
CHUNK_ROWS = 4096
CHUNK_CHARS = 1 << 22
OUT_CHARS = 1 << 22
REMEMBERED = 500_000

SPACE = " \t\n\x0b\x0c\r"

# States: nothing yet, after s, after u, after a. Symbols: initial (s, u, a, other) x (clean, truncated), then a row
# that must go, then no row at all.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
FURTHER = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)
MUST_GO, NO_ROW = 8, 9
SYMBOLS = 10
FAR = 1 << 20

# A row's code is 4 x initial + fault.
CLEAN, CUT, DUPLICATE, BLANK = range(4)
SYMBOL_OF = np.array([MUST_GO if code % 4 >= DUPLICATE else code // 4 * 2 + code % 4 for code in range(16)], np.int64)


def kept_in(state: int, initial: int) -> int | None:
    """The state after a row that stays as it is, if it may."""
    if initial == 0:
        return AFTER_S if state == START else None
    if initial == 1:
        return AFTER_U if state != AFTER_U else None
    return AFTER_A if initial == 2 and state == AFTER_U else None


def choices(state: int, symbol: int) -> list[tuple[str, int, int]]:
    """What may become of a row: letter, cost, state after it."""
    found = [("D", DELETE, state)]
    if symbol < MUST_GO:
        extra = TRUNCATED * (symbol % 2)
        stays = kept_in(state, symbol // 2)
        if stays is not None:
            found.append(("K", KEEP + extra, stays))
        found.append(("R", REROLE + extra, FURTHER[state]))
    return found


def with_inserts(costs: list[int]) -> tuple[int, ...]:
    for _ in range(3):
        costs = [min(cost, INSERT + costs[FURTHER[state]]) for state, cost in enumerate(costs)]
    return tuple(costs)


def before_row(after: tuple[int, ...], symbol: int) -> tuple[int, ...]:
    """Costs to the end before a row, by those after it."""
    if symbol == NO_ROW:
        return after
    return with_inserts(
        [min(cost + after[then] for _, cost, then in choices(state, symbol)) for state in range(4)]
    )


AT_END = with_inserts([0, FAR, FAR, 0])


class Tables:
    """All normalised vectors, their transitions by symbol and by block, and the moves of states through a block."""

    def __init__(self):
        self.vectors = [AT_END]
        number = {AT_END: 0}
        steps = []
        for vector in self.vectors:  # grows while new vectors are met
            row = []
            for symbol in range(SYMBOLS):
                before = before_row(vector, symbol)
                low = min(before)
                normal = tuple(cost - low for cost in before)
                if normal not in number:
                    number[normal] = len(self.vectors)
                    self.vectors.append(normal)
                row.append((number[normal], low))
            steps.append(row)
        then = np.array([[to for to, _ in row] for row in steps], np.int64)
        added = np.array([[low for _, low in row] for row in steps], np.int64)
        self.steps = steps

        blocks = np.array(list(product(range(SYMBOLS), repeat=BLOCK)), np.int64)
        at = np.repeat(np.arange(len(self.vectors))[:, None], len(blocks), axis=1)
        total = np.zeros_like(at)
        for place in reversed(range(BLOCK)):
            total += added[at, blocks[:, place]]
            at = then[at, blocks[:, place]]
        self.before, self.added = at, total
        self.before_rows, self.added_rows = at.tolist(), total.tolist()
        self.symbols = blocks
        self.expanded: dict[tuple[int, int, int], tuple[str, int]] = {}

    def expand(self, after: int, block: int, state: int) -> tuple[str, int]:
        """The least letters of a block entered in a state, given the vector behind it, and the state at its end."""
        key = (after, block, state)
        found = self.expanded.get(key)
        if found is None:
            symbols = self.symbols[block].tolist()
            vectors = [self.vectors[after]]
            for symbol in reversed(symbols):
                vectors.append(before_row(vectors[-1], symbol))
            letters = []
            for place, symbol in enumerate(symbols):
                if symbol == NO_ROW:
                    continue
                here, behind = vectors[BLOCK - place], vectors[BLOCK - place - 1]
                while True:
                    options = [(letter, then) for letter, cost, then in choices(state, symbol) if cost + behind[then] == here[state]]
                    if INSERT + here[FURTHER[state]] == here[state]:
                        options.append(("I", FURTHER[state]))
                    letter, state = min(options)
                    letters.append(letter)
                    if letter != "I":
                        break
            if len(self.expanded) >= REMEMBERED:
                self.expanded.clear()
            found = self.expanded[key] = "".join(letters), state
        return found

    def blocks_of(self, codes: bytes) -> list[int]:
        """Codes as block numbers; the first block is filled up in front."""
        symbols = SYMBOL_OF[np.frombuffer(codes, np.uint8)]
        short = -len(symbols) % BLOCK
        symbols = np.concatenate([np.full(short, NO_ROW), symbols]).reshape(-1, BLOCK)
        return (symbols @ (SYMBOLS ** np.arange(BLOCK)[::-1])).tolist()

    def backward(self, blocks: list[int], after: int) -> tuple[list[int], int, int]:
        """The vector behind each block, the one before the first, and the cost added."""
        behind, total = [], 0
        for block in reversed(blocks):
            behind.append(after)
            total += self.added_rows[after][block]
            after = self.before_rows[after][block]
        return behind[::-1], after, total

    def trace(self, blocks: list[int], behind: list[int], state: int) -> tuple[str, int]:
        parts = []
        for block, after in zip(blocks, behind):
            letters, state = self.expand(after, block, state)
            parts.append(letters)
        return "".join(parts), state

    def effect(self, codes: bytes) -> bytes:
        """What a chunk does: for each vector behind it the one before it, the cost added, and where it takes each
        state."""
        count = len(self.vectors)
        at, total, behind = np.arange(count), np.zeros(count, np.int64), []
        blocks = self.blocks_of(codes)
        for block in reversed(blocks):
            behind.append(at)
            total += self.added[at, block]
            at = self.before[at, block]
        # Few different vectors are left after a few blocks: each pair of vector and state is moved once.
        states = np.tile(np.arange(4), (count, 1))
        for block, after in zip(blocks, reversed(behind)):
            pairs, where = np.unique(after[:, None] * 4 + states, return_inverse=True)
            moved = np.array([self.expand(int(p) // 4, block, int(p) % 4)[1] for p in pairs])
            states = moved[where].reshape(count, 4)
        return at.astype("<i8").tobytes() + total.astype("<i8").tobytes() + states.astype("<i8").tobytes()

    def read_effect(self, raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        count = len(self.vectors)
        numbers = np.frombuffer(raw, "<i8")
        return numbers[:count], numbers[count : 2 * count], numbers[2 * count :].reshape(count, 4)


def tables() -> Tables:
    """Built once per Python worker: some thousand lookups."""
    kept = worker_cache("conversation-tables")
    if not kept:
        kept["tables"] = Tables()
    return kept["tables"]


def closing(state: int) -> str:
    """Turns inserted behind the last row."""
    letters = ""
    while state in (AFTER_S, AFTER_U):
        letters, state = letters + "I", FURTHER[state]
    return letters


def turns_of(letters: str, roles: list, texts: list, state: int) -> list[dict]:
    """The rows that the letters leave."""
    turns, at = [], 0
    for letter in letters:
        if letter == "D":
            at += 1
            continue
        if letter == "K":
            state = kept_in(state, "sua".find(roles[at][:1]))
            turns.append({"role": roles[at], "text": texts[at]})
            at += 1
            continue
        state = FURTHER[state]
        role = "user" if state == AFTER_U else "assistant"
        turns.append({"role": role, "text": texts[at] if letter == "R" else ""})
        at += letter == "R"
    return turns


def illegal_pairs(codes: bytes) -> int:
    """Adjacent initials that are not su, ua or au."""
    initials = np.frombuffer(codes, np.uint8) // 4
    left, right = initials[:-1], initials[1:]
    fine = ((left == 0) & (right == 1)) | ((left == 1) & (right == 2)) | ((left == 2) & (right == 1))
    return int((~fine).sum())


class Chunk:
    """Rows of one conversation that follow one another in one task."""

    def __init__(self, conv, pending=False):
        self.conv, self.pending, self.dangling = conv, pending, False
        self.codes, self.roles, self.texts, self.chars = bytearray(), [], [], 0
        self.low = self.high = None
        self.turns = 0

    def add(self, code, turn, role, text):
        self.codes.append(code)
        self.roles.append(role)
        gone = code % 4 >= DUPLICATE
        self.texts.append(None if gone else text)
        self.chars += 0 if gone else len(text)
        if turn is not None and turn != self.high:
            self.turns += 1
            self.low = turn if self.low is None else self.low
            self.high = turn

    def full(self) -> bool:
        return len(self.codes) >= CHUNK_ROWS or self.chars >= CHUNK_CHARS or self.pending

    def counts(self) -> dict:
        faults = np.bincount(np.frombuffer(bytes(self.codes), np.uint8) % 4, minlength=4)
        return {
            "blank": int(faults[BLANK]),
            "duplicate": int(faults[DUPLICATE]),
            "truncated": int(faults[CUT]),
            "illegal": illegal_pairs(bytes(self.codes)),
        }

    def solved(self) -> dict:
        """The whole conversation."""
        russian = tables()
        blocks = russian.blocks_of(bytes(self.codes))
        behind, first, total = russian.backward(blocks, 0)
        letters, state = russian.trace(blocks, behind, START)
        letters += closing(state)
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return {
            "conv_id": self.conv,
            "piece": 0,
            "last": True,
            "audit": letters,
            "turns": turns_of(letters, self.roles, self.texts, START),
            "gaps": gaps,
            **self.counts(),
            "cost": total + russian.vectors[first][START],
        }

    def left_open(self, part: int, seq: int) -> dict:
        codes = bytes(self.codes)
        other = bytes([codes[0] // 4 * 4 + DUPLICATE]) if self.pending else b""
        return {
            "conv_id": self.conv,
            **self.counts(),
            "part": part,
            "seq": seq,
            "codes": codes,
            "roles": self.roles,
            "texts": self.texts,
            "pending": self.pending,
            "dangling": self.dangling,
            "low": self.low,
            "high": self.high,
            "distinct_turns": self.turns,
            "effect": tables().effect(codes),
            "as_duplicate": tables().effect(other) if other else None,
        }


RESULT = [
    ("piece", "int"), ("last", "boolean"), ("audit", "string"), ("turns", "array<struct<role:string,text:string>>"),
    ("gaps", "long"), ("blank", "long"), ("duplicate", "long"), ("truncated", "long"), ("illegal", "long"),
    ("cost", "long"),
]
OPEN = [
    ("part", "int"), ("seq", "int"), ("codes", "binary"), ("roles", "array<string>"), ("texts", "array<string>"),
    ("pending", "boolean"), ("dangling", "boolean"), ("low", "long"), ("high", "long"), ("distinct_turns", "long"),
    ("effect", "binary"), ("as_duplicate", "binary"),
]


def fields(conv_id: T.StructField, columns) -> T.StructType:
    ddl = ", ".join(f"{name} {kind}" for name, kind in columns)
    return T.StructType([T.StructField("conv_id", conv_id.dataType), *T._parse_datatype_string(ddl).fields])


def sorted_rows(turns: DataFrame) -> DataFrame:
    """Rows in order of conversation and turn over all partitions.

    A `mark` stands directly before the row that is the first of its role and text in its conversation. The mark comes
    from an aggregate over keys and hashes alone, whatever one text is repeated; it finds its row by the common order,
    without a join. Rows that were dropped (`gone`) stand for their conversation.
    """
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    stripped = F.rtrim(text, F.lit(SPACE))
    fault = F.when(stripped == "", BLANK).when(F.right(stripped, F.lit(1)).isin(".", "!", "?"), CLEAN).otherwise(CUT)
    first = F.substring(role, 1, 1)
    initial = F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)
    rows = turns.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.col("order_role"),
        F.substring("order_text", 1, 64).alias("beginning"),
        F.xxhash64("order_role", "order_text").alias("own"),
        role.alias("role"),
        text.alias("text"),
        (initial * 4 + fault).cast("int").alias("code"),
        "gone",
    )
    order = ["turn", "order_role", "beginning", "own"]
    # Length and two hashes of 64 bits stand for a text.
    marks = (
        rows.filter(~F.col("gone") & (F.col("code") % 4 != BLANK))
        .groupBy("conv_id", "role", F.xxhash64("text").alias("a"), F.xxhash64(F.reverse("text")).alias("b"), F.length("text").alias("n"))
        .agg(F.min(F.struct(*order)).alias("x"))
        .select("conv_id", *(f"x.{name}" for name in order), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"), F.lit(-1).alias("code"))
        .withColumn("gone", F.lit(False))
        .withColumn("salt", F.lit(None).cast("long"))
    )
    # Equal rows are kept apart by their number, so that ranges can part them.
    all_rows = rows.withColumn("salt", F.monotonically_increasing_id()).unionByName(marks)
    keys = ["conv_id", *order, "salt"]
    return all_rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select("conv_id", "turn", "own", "role", "text", "code", "gone")


def chunked(rows: DataFrame) -> DataFrame:
    """Solved conversations, and chunks of those that may go on in another task (`part` is not null)."""
    schema = fields(rows.schema["conv_id"], RESULT + OPEN)

    def run(batches):
        arrow = to_arrow_schema(schema)
        part = TaskContext.get().partitionId()
        out, size, seq = [], 0, 0
        current, first_conv, several, begun = None, True, False, False
        marked = None

        def batch_of(found):
            return pa.RecordBatch.from_pylist(found, schema=arrow)

        def closed(last):
            nonlocal seq
            if last or first_conv or several:
                seq += 1
                return current.left_open(part, seq)
            return current.solved()

        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(7)]
            for conv, turn, own, role, text, code, gone in zip(*columns):
                if current is None or current.conv != conv:
                    if current is not None:
                        out.append(closed(False))
                        size += current.chars
                        first_conv = False
                    current, several = Chunk(conv), False
                if code < 0:
                    marked = (turn, own)
                elif not gone:
                    # The very first row of a task may have its mark at the end of the task before.
                    pending = not begun and code % 4 != BLANK
                    if pending:
                        current.pending = True
                    elif current.full():
                        several = True
                        out.append(closed(False))
                        size += current.chars
                        current = Chunk(conv)
                    if code % 4 != BLANK and not pending and marked != (turn, own):
                        code = code // 4 * 4 + DUPLICATE
                    if code % 4 != BLANK:
                        marked = None
                    current.add(code, turn, role, text)
                begun = True
                if size >= OUT_CHARS or len(out) >= CHUNK_ROWS:
                    yield batch_of(out)
                    out, size = [], 0
        if current is not None:
            current.dangling = marked is not None
            out.append(closed(True))
        if out:
            yield batch_of(out)

    return rows.mapInArrow(run, schema)


def composed(open_chunks: DataFrame) -> DataFrame:
    """How each open chunk is entered: `part, seq`, then the vector behind it, the state before it, what its
    conversation has in all if it is the last. Only effects and counts come together, some hundred bytes a chunk."""

    def run(chunks: pa.Table) -> pa.Table:
        russian = tables()
        rows = chunks.sort_by([("part", "ascending"), ("seq", "ascending")]).to_pylist()
        effects, duplicate, pairs = [], [], 0
        totals = dict.fromkeys(["blank", "duplicate", "truncated", "illegal"], 0)
        low = high = previous = None
        turns, dangling = 0, False
        for row in rows:
            again = row["pending"] and not dangling
            duplicate.append(again)
            effects.append(russian.read_effect(row["as_duplicate"] if again else row["effect"]))
            for name in totals:
                totals[name] += row[name]
            if again:
                totals["duplicate"] += 1
                totals["truncated"] -= row["truncated"]
            if row["n"]:
                if previous is not None:
                    totals["illegal"] += illegal_pairs(bytes([previous, row["first"] // 4 * 4]))
                previous = row["final"] // 4 * 4
            if row["low"] is not None:
                turns += row["distinct_turns"] - (row["low"] == high)
                low = row["low"] if low is None else low
                high = row["high"]
            dangling = row["dangling"]
        after, cost, behind = 0, 0, []
        for before, added, _ in reversed(effects):
            behind.append(after)
            cost += int(added[after])
            after = int(before[after])
        behind.reverse()
        state, entered = START, []
        for vector, (_, _, states) in zip(behind, effects):
            entered.append(state)
            state = int(states[vector, state])
        last = len(rows) - 1
        totals["cost"] = cost + russian.vectors[after][START]
        totals["gaps"] = high - low + 1 - turns if turns else 0
        found = []
        for i, row in enumerate(rows):
            own = {"part": row["part"], "seq": row["seq"], "piece": i, "last": i == last}
            own |= {"again": duplicate[i], "behind": behind[i], "entered": entered[i]}
            found.append(own | (totals if i == last else {}))
        return pa.Table.from_pylist(found, schema=arrow)

    schema = "part int, seq int, piece int, again boolean, behind int, entered int, last boolean, " + ", ".join(f"{name} long" for name in TOTALS)
    light = open_chunks.select(
        "conv_id", "part", "seq", "pending", "dangling", "low", "high", "distinct_turns", "effect", "as_duplicate",
        "blank", "duplicate", "truncated", "illegal", F.octet_length("codes").alias("n"),
        F.conv(F.hex(F.substring("codes", 1, 1)), 16, 10).cast("int").alias("first"),
        F.conv(F.hex(F.substring("codes", -1, 1)), 16, 10).cast("int").alias("final"),
    )
    arrow = to_arrow_schema(T._parse_datatype_string(schema))
    return light.groupBy("conv_id").applyInArrow(run, schema)


TOTALS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def traced(open_chunks: DataFrame) -> DataFrame:
    """Pieces of the conversations that go over several chunks or tasks."""
    schema = fields(open_chunks.schema["conv_id"], RESULT)
    plan = composed(open_chunks)
    joined = open_chunks.select("conv_id", "part", "seq", "codes", "roles", "texts").join(plan, ["part", "seq"])

    def run(batches):
        arrow = to_arrow_schema(schema)
        russian = tables()
        for batch in batches:
            # A chunk is bounded, a batch of ten thousand of them is not: each is written by itself.
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                codes = row["codes"]
                if row["again"]:
                    codes = bytes([codes[0] // 4 * 4 + DUPLICATE]) + codes[1:]
                blocks = russian.blocks_of(codes)
                behind, _, _ = russian.backward(blocks, row["behind"])
                letters, state = russian.trace(blocks, behind, row["entered"])
                if row["last"]:
                    letters += closing(state)
                row["audit"] = letters
                row["turns"] = turns_of(letters, row["roles"], row["texts"], row["entered"])
                yield pa.RecordBatch.from_pylist([{name: row[name] for name in arrow.names}], schema=arrow)

    return joined.mapInArrow(run, schema)


def repair(turns: DataFrame, gone: Column | None = None) -> DataFrame:
    """`turns` (`conv_id, turn, role, text`) -> the repaired conversations.

    One row per piece: `conv_id, piece` (from 0), `last`, `audit` (letters of the edits), `turns` (role and text of
    the rows left), and, in a conversation's last piece, `gaps, blank, duplicate, truncated, illegal, cost`. Nearly all
    conversations are one piece; only such of very many rows, or at the border between two tasks, have more. A
    conversation all of whose rows are `gone` is there with nothing in it.
    """
    turns = turns.withColumn("gone", F.lit(False) if gone is None else gone)
    if "order_role" not in turns.columns:
        turns = turns.withColumn("order_role", F.col("role")).withColumn("order_text", F.col("text"))
    pieces = stage(chunked(sorted_rows(turns)), "conversation-chunks")
    names = ["conv_id", *(name for name, _ in RESULT)]
    return pieces.filter("part is null").select(names).unionByName(traced(pieces.filter("part is not null")).select(names))


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with faults put in by crc32 of `conv_id:turn`, modulo 20: 0 goes, 1 is emptied, 2 loses its `.!?`, 3 comes
    twice, 4 is a user's. Null parts of the key, null roles and null texts are one space."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    case = F.col("case")
    text = F.coalesce("text", space)
    rows = conversations.select("conv_id", "turn", "role", "text").withColumn("case", F.crc32(key.cast("binary")) % 20)
    return rows.select(
        "conv_id",
        "turn",
        F.when(case == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
        F.when(case == 0, "").when(case == 1, "").when(case == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (case == 0).alias("gone"),
        F.coalesce("role", space).alias("order_role"),
        text.alias("order_text"),
        F.explode(F.when(case == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def digests(pieces: DataFrame) -> DataFrame:
    """Repaired pieces -> one row per conversation, with its whole audit and `repaired_sha256`.

    SHA-256 takes its bytes in order, so the pieces of one conversation pass one task, in order and one at a time;
    conversations of one piece, nearly all, are digested where they are.
    """
    names = [*TOTALS, "audit", "repaired_sha256"]
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    whole = (F.col("piece") == 0) & F.col("last")
    single = pieces.filter(whole).withColumn("repaired_sha256", F.sha2(lines, 256)).select("conv_id", *names)
    schema = T.StructType([pieces.schema["conv_id"], *(T.StructField(n, T.LongType()) for n in TOTALS), *(T.StructField(n, T.StringType()) for n in names[-2:])])

    def run(batches):
        arrow = to_arrow_schema(schema)
        digest, audit = hashlib.sha256(), []
        begun = False
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if row["lines"] is not None:
                    digest.update((b"\n" if begun else b"") + row["lines"].encode())
                    begun = True
                audit.append(row["audit"])
                if row["last"]:
                    row["audit"], row["repaired_sha256"] = "".join(audit), digest.hexdigest()
                    yield pa.RecordBatch.from_pylist([{name: row[name] for name in arrow.names}], schema=arrow)
                    digest, audit, begun = hashlib.sha256(), [], False

    several = pieces.filter(~whole).select("conv_id", "piece", "last", "audit", *TOTALS, F.when(F.size("turns") > 0, lines).alias("lines"))
    ordered = several.repartition("conv_id").sortWithinPartitions("conv_id", "piece")
    return single.unionByName(ordered.mapInArrow(run, schema))


def repaired_conversations(conversations: DataFrame) -> DataFrame:
    """Damage, repair and digests: `conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256`, one row per `conv_id` of the table."""
    rows = damaged(conversations)
    return digests(repair(rows, F.col("gone")))
