"""Near-duplicate vectors by cosine, found with a forest of random-projection trees.

Tight groups first: vectors within `HALF` degrees of a centre are all within `2 * HALF` of each other, so they are
linked without being compared, and however large a family of near copies is, it comes down to a few *balls*
(centre, radius, number). Balls are collected in rounds over the leaves of a tree, until they hardly shrink.

Then a forest over the balls: each tree splits by random directions at the median, and whatever lies close to a
split goes to both sides. The upper part of a tree is fitted on a bounded sample; below it Spark groups the balls by
leaf, and each task goes on splitting its own, but for parts so densely linked that a split would only part what
belongs together. Balls of one leaf are compared. Two balls are linked as a whole, or not at all, or, if their radii
leave it open, member by member. Links are verified in double precision; components come from the union of all trees'
links.

A large family that is too loose for balls would be split by every tree. Such *crowds* are found in the sample (a
leader, and what is near it), every ball near a leader is in the crowd of the nearest one, and crowds are compared
with themselves and with crowds near them, all with all, in tasks of a block of balls against another. These
tasks return counts of links and a few edges for the components, not pairs; the forest leaves these pairs out.

Fitted on the sample: directions, medians and leaders. Every vector is indexed. Pairs may be missed, none is wrong;
the measured recall is in the README.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from orderlake.llm.components import connected_components
from orderlake.llm.scratch import stage, struct

COSINE = 0.9
TREES = 12
SPILL = 0.08
LEAF = 256
GROUP = 2048
SAMPLE = 20_000
LEAST_SAMPLED = 32
# A crowd: so many balls by the sample's count, and so many sampled ones.
CROWD = 512
LEAST_IN_CROWD = 8
# Reach of a leader, and of a crowd to others, in angles of a link.
REACH, NEAR = 1.5, 2.5
BLOCK = 2048
# Share of linked pairs from which a part of a leaf is compared as a whole.
DENSE = 0.05
ROUNDS = 6
SLACK = 1e-7


class Splits:
    """The upper part of one tree: a direction and two bounds per node, -1 for no child."""

    def __init__(self, directions, bounds, children):
        self.directions, self.bounds, self.children = directions, bounds, children

    @classmethod
    def fit(cls, sample: np.ndarray, total: int, seed: int, spill: float) -> "Splits":
        random = np.random.default_rng(seed)
        directions, bounds, children = [], [], []
        scale = total / max(1, len(sample))
        queue = [(np.arange(len(sample)), None)]
        while queue:
            rows, parent = queue.pop()
            node = len(directions)
            if parent is not None:
                children[parent[0]][parent[1]] = node
            direction = random.normal(size=sample.shape[1])
            directions.append(direction)
            children.append([-1, -1])
            if len(rows) * scale <= GROUP or len(rows) < LEAST_SAMPLED:
                bounds.append((0.0, 0.0))
                continue
            value = sample[rows] @ direction
            low, high = np.quantile(value, [0.5 - spill, 0.5 + spill])
            bounds.append((low, high))
            sides = rows[value <= high], rows[value >= low if spill else value > high]
            if min(map(len, sides)) == 0 or max(map(len, sides)) == len(rows):
                continue
            queue += [(side, (node, i)) for i, side in enumerate(sides)]
        return cls(np.array(directions), np.array(bounds), np.array(children))

    def leaves(self, units: np.ndarray, spill: float):
        """(leaf, rows) for all leaves that these vectors reach."""
        found, queue = [], [(0, np.arange(len(units)))]
        while queue:
            node, rows = queue.pop()
            if not len(rows):
                continue
            if self.children[node, 0] < 0:
                found.append((node, rows))
                continue
            value = units[rows] @ self.directions[node]
            low, high = self.bounds[node]
            queue.append((self.children[node, 0], rows[value <= high]))
            queue.append((self.children[node, 1], rows[value >= low if spill else value > high]))
        return found


def local_leaves(units: np.ndarray, seed: int, spill: float, dense=lambda rows: False):
    """Rows of each leaf when one group goes on being split until leaves are small, or `dense` says to stop."""
    random = np.random.default_rng(seed)
    queue = [np.arange(len(units))]
    while queue:
        rows = queue.pop()
        if len(rows) <= LEAF or dense(rows):
            yield rows
            continue
        value = units[rows] @ random.normal(size=units.shape[1])
        low, high = np.quantile(value, [0.5 - spill, 0.5 + spill])
        sides = rows[value <= high], rows[value >= low if spill else value > high]
        if min(map(len, sides)) == 0 or max(map(len, sides)) > 0.9 * len(rows):
            # Equal projections: cut by place, so that it ends.
            order = rows[np.argsort(value, kind="stable")]
            sides = order[: len(order) // 2], order[len(order) // 2 :]
        queue += sides


def angle(cosine):
    return np.arccos(np.clip(cosine, -1.0, 1.0))


def gather(units, sizes, radii, ids, half):
    """Balls of one leaf: for each row the row that names its ball, and each ball's centre and radius."""
    name = np.arange(len(units))
    balls = {i: (units[i], radii[i]) for i in range(len(units))}
    close = angle(units @ units.T) <= half
    free = np.ones(len(units), bool)
    for x in np.lexsort((ids, -sizes)).tolist():
        near = np.flatnonzero(close[x] & free)
        if not free[x] or len(near) < 2:
            continue
        centre = sizes[near] @ units[near]
        centre /= np.linalg.norm(centre)
        reach = angle(units[near] @ centre) + radii[near]
        inside = near[reach <= half]
        if x not in inside or len(inside) < 2:
            continue
        free[inside] = False
        name[inside] = x
        for i in inside.tolist():
            balls.pop(i)
        balls[x] = centre, float(reach[reach <= half].max())
    return name, balls


BALL = struct("ball long, n long, radius double, vec_id long, vector binary")


def _to_units(column: pa.Array, width: int) -> np.ndarray:
    raw = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.frombuffer(b"".join(raw.to_pylist()), np.float64).reshape(-1, width)


def unit_rows(vectors: DataFrame) -> DataFrame:
    """`row, vec_id, width, vector`: unit vectors as bytes of doubles, null for those that link with
    nothing (null, zero, or with a null or non-finite component)."""
    schema = struct("vec_id long, width integer, vector binary")

    def run(batches):
        for batch in batches:
            widths, found = [], []
            for values in batch.column(1).to_pylist():
                unit = None
                if values is not None and None not in values and len(values):
                    x = np.array(values, np.float64)
                    largest = np.abs(x).max()
                    if np.isfinite(largest) and largest > 0:
                        x = x / largest  # neither overflow nor underflow in the sum of squares
                        unit = (x / np.linalg.norm(x)).tobytes()
                widths.append(len(values or ()))
                found.append(unit)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(widths, pa.int32()), pa.array(found, pa.binary())],
                schema.names,
            )

    return vectors.select(F.col("vec_id").cast("long"), "embedding").mapInArrow(run, schema)


def forest(balls: DataFrame, width: int, trees: int, spill: float, seed: int):
    """Fit the upper parts and send each ball to its leaves: columns `tree`, `leaf` and the ball's."""
    total = balls.count()
    sample = balls.orderBy(F.xxhash64("ball")).limit(SAMPLE).select("vector").toArrow()["vector"]
    units = _to_units(sample, width)
    fitted = [Splits.fit(units, total, seed + t, spill) for t in range(trees)]
    parts = balls.sparkSession.sparkContext.broadcast(
        [(s.directions, s.bounds, s.children) for s in fitted]
    )
    schema = T.StructType(struct("tree integer, leaf integer").fields + balls.schema.fields)

    def run(batches):
        grown = [Splits(*part) for part in parts.value]
        for batch in batches:
            units = _to_units(batch.column("vector"), width)
            for number, tree in enumerate(grown):
                for leaf, rows in tree.leaves(units, spill):
                    part = batch.take(pa.array(rows))
                    place = [pa.array(np.full(len(rows), x, np.int32)) for x in (number, leaf)]
                    yield pa.RecordBatch.from_arrays([*place, *part.columns], schema.names)

    return balls.mapInArrow(run, schema)


def _arrays(table: pa.Table, width: int):
    """One group's balls in the order of their ids, so that a repeated task does the same."""
    table = table.sort_by("ball")
    units = _to_units(table["vector"], width)
    return units, *(table[n].to_numpy() for n in ("ball", "n", "radius", "vec_id"))


def collect_balls(rows: DataFrame, width: int, cosine: float) -> tuple[DataFrame, DataFrame]:
    """Balls over unit rows, and the ball of each row (`row`, `ball`)."""
    half = np.arccos(cosine) / 2 - 1e-3
    balls = stage(
        rows.select(
            F.col("row").alias("ball"), F.lit(1).cast("long").alias("n"), F.lit(0.0).alias("radius"), "vec_id", "vector"
        ),
        "balls",
    )
    member, before = rows.select("row", F.col("row").alias("ball")), balls.count()
    if half <= 0:
        return balls, member
    for round_no in range(ROUNDS):
        schema = T.StructType(struct("old long").fields + BALL.fields)

        def merge(table: pa.Table) -> pa.Table:
            seed = table["leaf"][0].as_py()
            units, ids, sizes, radii, vec_ids = _arrays(table, width)
            smallest = np.where(np.isnan(vec_ids), np.inf, vec_ids) if vec_ids.dtype.kind == "f" else vec_ids
            old, found = [], []
            for leaf in local_leaves(units, seed, 0.0):
                name, balls = gather(units[leaf], sizes[leaf], radii[leaf], ids[leaf], half)
                for own in balls:
                    members = leaf[name == own]
                    low = smallest[members].min()
                    centre, radius = balls[own]
                    ball = (int(ids[members].min()), int(sizes[members].sum()), float(radius))
                    ball += (None if low == np.inf else int(low), np.asarray(centre).tobytes())
                    # The first row of a ball carries it, the others only its name.
                    for place, member in enumerate(members.tolist()):
                        old.append(int(ids[member]))
                        found.append(ball if not place else (ball[0], None, None, None, None))
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.binary()]
            columns = [pa.array(c, k) for c, k in zip(zip(*found), kinds)]
            return pa.table([pa.array(old, pa.int64()), *columns], schema.names)

        routed = forest(balls, width, 1, 0.0, 1000 + round_no)
        merged = stage(routed.groupBy("tree", "leaf").applyInArrow(merge, schema), f"merged{round_no}")
        balls = merged.filter("n is not null").select(*BALL.names)
        renamed = merged.select(F.col("old").alias("ball"), F.col("ball").alias("new"))
        member = member.join(renamed, "ball").select("row", F.col("new").alias("ball"))
        now = balls.count()
        if now > 0.8 * before:
            break
        before = now
    return balls, stage(member, "members")


def relation(units, radii, others, other_radii, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Which balls are linked as a whole with which others, and which are left open."""
    limit = np.arccos(cosine)
    dots = units @ others.T
    reach = radii[:, None] + other_radii[None, :]
    single = reach == 0
    if single.all():
        return dots >= cosine, np.zeros(dots.shape, bool)
    apart = angle(dots)
    whole = np.where(single, dots >= cosine, apart + reach <= limit - SLACK)
    return whole, ~whole & ~single & (apart - reach <= limit + SLACK)


def find_leaders(sample: np.ndarray, total: int, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Leaders of the crowds in a sample of `total` balls, and which crowds are near which."""
    least = max(LEAST_IN_CROWD, -(-CROWD * len(sample) // max(1, total)))
    degree = np.zeros(len(sample), np.int64)
    for first in range(0, len(sample), 1024):
        degree[first : first + 1024] = (sample[first : first + 1024] @ sample.T >= cosine).sum(axis=1)
    left = np.flatnonzero(degree >= least)
    left = left[np.argsort(-degree[left], kind="stable")]
    leaders = []
    while len(left):
        near = sample[left] @ sample[left[0]] >= cosine
        # What few are left over near a crowd is within its reach.
        if near.sum() >= max(2, least // 2):
            leaders.append(left[0])
        near[0] = True
        left = left[~near]
    leaders = sample[leaders].reshape(-1, sample.shape[1])
    near = angle(leaders @ leaders.T) <= NEAR * np.arccos(cosine)
    return leaders, near | near.T


def in_crowds(balls: DataFrame, width: int, cosine: float) -> tuple[DataFrame, np.ndarray]:
    """`balls` with `crowd` (-1 for none), and which crowds are near which."""
    total = balls.count()
    sample = balls.orderBy(F.xxhash64("ball")).limit(SAMPLE).select("vector").toArrow()["vector"]
    leaders, near = find_leaders(_to_units(sample, width), total, cosine)
    if not len(leaders):
        return balls.withColumn("crowd", F.lit(-1)), near
    sent = balls.sparkSession.sparkContext.broadcast(leaders)
    bar = np.cos(min(np.pi, REACH * np.arccos(cosine)))
    schema = T.StructType(balls.schema.fields + struct("crowd integer").fields)

    def run(batches):
        for batch in batches:
            units = _to_units(batch.column("vector"), width)
            for first in range(0, len(units), 1024):
                dots = units[first : first + 1024] @ sent.value.T
                crowd = np.where(dots.max(axis=1) >= bar, dots.argmax(axis=1), -1).astype(np.int32)
                part = batch.slice(first, len(crowd))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(crowd)], schema.names)

    # Written, so that a ball is in one crowd for all that follows.
    return stage(balls.mapInArrow(run, schema), "crowds"), near


def compare_crowds(balls: DataFrame, near: np.ndarray, width: int, cosine: float) -> DataFrame:
    """All pairs within crowds and between crowds near each other, a block against a block: `a`, `links` (members of
    other balls linked as a whole with each member), or `a`, `b`, `whole`: an edge for components, or a pair
    left open."""
    schema = struct("a long, b long, whole boolean, links long")
    spark = balls.sparkSession
    sizes = {r.crowd: r.n for r in balls.filter("crowd >= 0").groupBy("crowd").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return spark.createDataFrame([], schema)
    blocks = {crowd: -(-n // BLOCK) for crowd, n in sizes.items()}
    partners = {
        a: [(int(b), blocks[int(b)]) for b in np.flatnonzero(near[a]) if int(b) in blocks] for a in blocks
    }
    key = struct("one integer, block integer, other integer, other_block integer, side integer")
    sent = T.StructType(key.fields + balls.schema.fields)

    def run(batches):
        for batch in batches:
            crowds = batch.column("crowd").to_numpy()
            ids = batch.column("ball").to_numpy()
            for crowd in np.unique(crowds).tolist():
                rows = np.flatnonzero(crowds == crowd)
                own = (ids[rows].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64)
                own %= blocks[crowd]
                for block in np.unique(own).tolist():
                    part = batch.take(pa.array(rows[own == block]))
                    for other, n in partners[crowd]:
                        for other_block in range(n):
                            mine, theirs = (crowd, block), (other, other_block)
                            side = int(mine > theirs)
                            pair = (*theirs, *mine) if side else (*mine, *theirs)
                            place = [pa.array(np.full(part.num_rows, x, np.int32)) for x in (*pair, side)]
                            yield pa.RecordBatch.from_arrays([*place, *part.columns], sent.names)

    def blocks_of(table: pa.Table) -> pa.Table:
        one, block, other, other_block = (table[n][0].as_py() for n in key.names[:4])
        same = (one, block) == (other, other_block)
        side = table["side"].to_numpy()
        sides = [table.filter(pa.array(side == k)) for k in (0, 1)]
        units, ids, sizes, radii, _ = _arrays(sides[0], width)
        facing = (units, ids, sizes, radii) if same else _arrays(sides[1], width)[:4]
        links, facing_links = np.zeros(len(ids), np.int64), np.zeros(len(facing[1]), np.int64)
        edges, opened = [], []
        for first in range(0, len(ids), 512):
            part = slice(first, first + 512)
            whole, open_ = relation(units[part], radii[part], facing[0], facing[3], cosine)
            if same:
                later = np.arange(len(ids))[None, :] > np.arange(len(ids))[part][:, None]
                whole, open_ = whole & later, open_ & later
            links[part] += whole @ facing[2]
            facing_links += sizes[part] @ whole
            i, j = np.nonzero(open_)
            opened += zip(ids[first + i].tolist(), facing[1][j].tolist())
            edges += chosen_edges(whole, ids[part], facing[1])
        counts = {}
        for name, n in [*zip(ids.tolist(), links.tolist()), *zip(facing[1].tolist(), facing_links.tolist())]:
            counts[name] = counts.get(name, 0) + n
        rows = [(a, None, None, n) for a, n in counts.items() if n]
        rows += [(a, b, True, None) for a, b in edges] + [(min(p), max(p), False, None) for p in opened]
        columns = list(zip(*rows)) or [(), (), (), ()]
        kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int64()]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], schema.names)

    routed = balls.filter("crowd >= 0").mapInArrow(run, sent)
    return routed.groupBy(*key.names[:4]).applyInArrow(blocks_of, schema)


def chosen_edges(whole: np.ndarray, ids: np.ndarray, others: np.ndarray) -> list[tuple[int, int]]:
    """Few of the linked pairs (`ids[i]`, `others[j]` where `whole[i, j]`) that connect all they connect."""
    group = np.full(len(others), -1)
    edges = []
    for i in np.flatnonzero(whole.any(axis=1)).tolist():
        row = np.flatnonzero(whole[i])
        seen = np.unique(group[row])
        # One edge to a new member each, and one to each group that the row joins together.
        fresh = row[group[row] < 0]
        joined = seen[seen >= 0]
        firsts = [int(row[np.argmax(group[row] == g)]) for g in joined.tolist()]
        edges += [(int(ids[i]), int(others[j])) for j in [*fresh.tolist(), *firsts]]
        label = int(joined[0]) if len(joined) else i
        group[fresh] = label
        if len(joined) > 1:
            group[np.isin(group, joined)] = label
    return edges


def compare(balls: DataFrame, near: np.ndarray, width: int, cosine: float, trees: int, spill: float) -> DataFrame:
    """Pairs of balls that share a leaf of some tree: `a` < `b`, `whole` (all members linked, else open). Pairs of
    crowds that are near each other are left out."""

    def pairs(table: pa.Table) -> pa.Table:
        seed = 7919 * table["tree"][0].as_py() + table["leaf"][0].as_py()
        units, ids, _, radii, _ = _arrays(table, width)
        crowd = table.sort_by("ball")["crowd"].to_numpy()
        random = np.random.default_rng(seed)

        def left_out(rows, others):
            known = (crowd[rows] >= 0)[:, None] & (crowd[others] >= 0)[None, :]
            return known & near[crowd[rows][:, None], crowd[others][None, :]] if known.any() else known

        def dense(rows):
            some = random.choice(rows, min(len(rows), 128), replace=False)
            linked = (units[some] @ units[rows].T >= cosine) & ~left_out(some, rows)
            return linked.mean() >= DENSE

        found = set()
        for leaf in local_leaves(units, seed, spill, dense):
            for first in range(0, len(leaf), 1024):
                part = leaf[first : first + 1024]
                whole, open_ = relation(units[part], radii[part], units[leaf], radii[leaf], cosine)
                later = np.arange(len(leaf))[None, :] > first + np.arange(len(part))[:, None]
                i, j = np.nonzero((whole | open_) & later & ~left_out(part, leaf))
                found.update(zip(ids[part[i]].tolist(), ids[leaf[j]].tolist(), whole[i, j].tolist()))
        a, b, whole = zip(*found) if found else ((), (), ())
        return pa.table(
            [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(whole, pa.bool_())], ["a", "b", "whole"]
        )

    routed = forest(balls, width, trees, spill, 1)
    return (
        routed.groupBy("tree", "leaf")
        .applyInArrow(pairs, "a long, b long, whole boolean")
        .groupBy("a", "b")
        .agg(F.max("whole").alias("whole"))
    )


def _dots(pairs: DataFrame, left: str, right: str, width: int) -> DataFrame:
    """Add `dot`, the product of two vector columns."""
    kept = [c for c in pairs.columns if c not in (left, right)]
    schema = T.StructType([pairs.schema[c] for c in kept] + [T.StructField("dot", T.DoubleType())])

    def run(batches):
        for batch in batches:
            a, b = (_to_units(batch.column(n), width) for n in (left, right))
            columns = [batch.column(n) for n in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array((a * b).sum(axis=1))], schema.names)

    return pairs.mapInArrow(run, schema)


def open_links(open_pairs: DataFrame, balls: DataFrame, members: DataFrame, rows: DataFrame, width: int, cosine: float) -> DataFrame:
    """Links of the pairs left open, per row: `row, ball, other, links`.

    A member is first held against the other ball as a whole, which settles most; what is still open is
    held against its members.
    """
    limit = float(np.arccos(cosine))
    both = open_pairs.select(F.col("a").alias("ball"), F.col("b").alias("other")).union(
        open_pairs.select(F.col("b").alias("ball"), F.col("a").alias("other"))
    )
    vector_of = members.join(rows.select("row", "vector"), "row")
    other = balls.select(F.col("ball").alias("other"), F.col("vector").alias("centre"), "radius", F.col("n").alias("other_n"))
    against = _dots(
        both.join(vector_of, "ball").join(other, "other").withColumn("own", F.col("vector")), "vector", "centre", width
    )
    apart = F.acos(F.least(F.greatest("dot", F.lit(-1.0)), F.lit(1.0)))
    against = stage(
        against.withColumn(
            "links",
            F.when((F.col("radius") > 0) & (apart + F.col("radius") <= limit - SLACK), F.col("other_n")).when(
                apart - F.col("radius") > limit + SLACK, F.lit(0)
            ),
        ),
        "against",
    )
    unsettled = against.filter("links is null").select("row", "ball", "other", "own")
    facing = vector_of.select(F.col("ball").alias("other"), "vector")
    single = _dots(unsettled.join(facing, "other"), "own", "vector", width).groupBy("row", "ball", "other").agg(
        F.sum(F.when(F.col("dot") >= cosine, 1).otherwise(0)).alias("links")
    )
    settled = against.filter("links > 0").select("row", "ball", "other", "links")
    return settled.union(single.filter("links > 0"))


def near_duplicates(
    vectors: DataFrame, cosine: float = COSINE, trees: int = TREES, spill: float = SPILL
) -> DataFrame:
    """One row per row of `vectors` (`vec_id`, `embedding`: array of float or double): `vec_id`, `n_links`,
    `component_id`, `kept`.

    Vectors that are null, empty or zero or hold null or non-finite components link with nothing. Vectors of each
    length are linked among themselves, one length after another. Repeated rows, also of one id, are vectors of their own, linked
    with each other. A component is named after its smallest id, null if it has none; `kept` is false
    for rows without an id that are not alone. Other columns are not read.
    """
    rows = stage(unit_rows(vectors).withColumn("row", F.monotonically_increasing_id()), "rows")
    widths = rows.filter("vector is not null").groupBy("width").agg(F.count("*").alias("n"))
    # A vector that is the only one of its length has nothing to be linked with.
    several = [row.width for row in widths.filter("n > 1").orderBy("width").collect()]
    alone = [
        F.lit(0).cast("long").alias("n_links"),
        F.col("vec_id").alias("component_id"),
        F.lit(True).alias("kept"),
    ]
    linked = F.col("vector").isNotNull() & F.col("width").isin(several)
    result = rows.filter(~linked).select("vec_id", *alone)
    for width in several:
        valid = rows.filter((F.col("width") == width) & F.col("vector").isNotNull())
        result = result.union(linked_vectors(valid, width, cosine, trees, spill))
    return result


def linked_vectors(valid: DataFrame, width: int, cosine: float, trees: int, spill: float) -> DataFrame:
    """The result for the unit rows of one length."""
    balls, members = collect_balls(valid, width, cosine)
    placed, near = in_crowds(balls, width, cosine)
    crowded = stage(compare_crowds(placed, near, width, cosine), "crowd-links")
    pairs = stage(compare(placed, near, width, cosine, trees, spill), "pairs")

    sizes = balls.select("ball", "n")
    whole = pairs.filter("whole").select(F.col("a").alias("ball"), F.col("b").alias("other"))
    whole = whole.union(whole.select("other", "ball"))
    by_ball = (
        whole.join(sizes.select(F.col("ball").alias("other"), "n"), "other")
        .select("ball", "n")
        .union(crowded.filter("links is not null").select("a", "links"))
        .groupBy("ball")
        .agg(F.sum("n").alias("whole_links"))
    )
    left_open = pairs.filter(~F.col("whole")).select("a", "b").union(crowded.filter("not whole").select("a", "b"))
    opened = stage(open_links(left_open, balls, members, valid, width, cosine), "open-links")
    by_row = opened.groupBy("row").agg(F.sum("links").alias("open_links"))

    edges = pairs.filter("whole").select("a", "b").union(crowded.filter("whole").select("a", "b"))
    edges = edges.union(opened.select("ball", "other"))
    labels = connected_components(edges).withColumnRenamed("node", "ball")
    named = stage(
        balls.select("ball", "n", "vec_id").join(labels, "ball", "left").withColumn(
            "component", F.coalesce("component", "ball")
        ),
        "components",
    )
    smallest = named.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    of_ball = (
        named.join(smallest, "component")
        .join(by_ball, "ball", "left")
        .select("ball", "component_id", (F.col("n") - 1 + F.coalesce("whole_links", F.lit(0))).alias("links"))
    )
    return (
        members.join(valid.select("row", "vec_id"), "row")
        .join(of_ball, "ball")
        .join(by_row, "row", "left")
        .select(
            "vec_id",
            (F.col("links") + F.coalesce("open_links", F.lit(0))).alias("n_links"),
            "component_id",
        )
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.col("n_links") == 0))
    )
