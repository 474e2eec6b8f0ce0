"""Vector code compression: product codes whose codebooks are refined over metric trees built by the anchors hierarchy.

Vectors become integers and are cut into parts. Each block of rows gets a metric tree of balls for each part, once:
anchors are spread over the block (each new one is the point furthest from its anchor and takes over the points that are nearer to it, which
a half of the distance between anchors shows without measuring most of them), merged upwards into a tree by least joint radius, and divided downwards in the same
way: from the middle out. A ball keeps centre, radius, sum and count of its points.

A round walks each tree from its root with the list of codebook entries that can own a point of the ball. Children inherit what is left of
their ball's list; an entry leaves it when another is nearer everywhere in the ball. A ball with one entry left is wholly
owned and gives its kept sum and count; only balls at the bottom with several entries look at points, in whole numbers. So results are
those of comparing each part with each entry.

Trees are rows of a written table, read by each round, so a lost executor costs the blocks it was at. What meets on the driver is the codebooks
and their sums, whose size is bounded by parts x entries.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources import materialize

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
BLOCK, LEAF = 8192, 24
# Components of this size and beyond do not fit the whole numbers that distances are computed in.
TOO_LARGE = 1 << 27


class Codes(NamedTuple):
    """codes: the kept rows' key, label, code (entry numbers, two hex digits a part) and error; codebooks: parts x entries x positions."""

    codes: DataFrame
    codebooks: np.ndarray


# --- trees ------------------------------------------------------------------------------

def _lengths(x: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->i", x, x))


def anchors(points: np.ndarray, most: int) -> list[np.ndarray]:
    """Numbers of the points of each anchor, at most ``most`` of them; fewer where all points lie on anchors."""
    pivots, owner = [0], np.zeros(len(points), np.int64)
    distance = _lengths(points - points[0])
    while len(pivots) < most:
        new = int(distance.argmax())
        if distance[new] == 0:
            break
        gap = _lengths(points[pivots] - points[new])
        # A point nearer to its anchor than half the gap cannot be nearer to the new one.
        near = np.flatnonzero(distance > gap[owner] / 2)
        moved = _lengths(points[near] - points[new])
        taken = moved < distance[near]
        distance[near[taken]], owner[near[taken]] = moved[taken], len(pivots)
        pivots.append(new)
    order = np.argsort(owner, kind="stable")
    return np.split(order, np.cumsum(np.bincount(owner, minlength=len(pivots)))[:-1])


class _Builder:
    """Collects the balls of one tree; a ball is (left, right) or the numbers of its points."""

    def __init__(self, points: np.ndarray):
        self.points = points.astype(np.float64)
        self.left: list[int] = []
        self.right: list[int] = []
        self.members: list[np.ndarray] = []

    def ball(self, members: np.ndarray, left: int = -1, right: int = -1) -> int:
        self.members.append(members)
        self.left.append(left)
        self.right.append(right)
        return len(self.members) - 1

    def grow(self, members: np.ndarray) -> int:
        """The ball of these points with all below it."""
        groups = [members]
        if len(members) > LEAF:
            groups = [members[g] for g in anchors(self.points[members], max(2, int(len(members) ** 0.5)))]
        if len(groups) == 1:
            return self.ball(members)
        return self.merge([self.grow(g) for g in groups])

    def merge(self, balls: list[int]) -> int:
        """One ball over all: the two with the least joint radius become one until one is left."""
        balls = list(balls)
        centre = np.array([self.points[self.members[b]].mean(axis=0) for b in balls])
        radius = np.array([_lengths(self.points[self.members[b]] - c).max() for b, c in zip(balls, centre)])
        joint = (np.sqrt(((centre[:, None] - centre[None]) ** 2).sum(axis=2)) + radius[:, None] + radius) / 2
        np.fill_diagonal(joint, np.inf)
        for _ in range(len(balls) - 1):
            i, j = divmod(int(joint.argmin()), len(balls))
            members = np.concatenate([self.members[balls[i]], self.members[balls[j]]])
            balls[i] = self.ball(members, balls[i], balls[j])
            centre[i] = self.points[members].mean(axis=0)
            radius[i] = _lengths(self.points[members] - centre[i]).max()
            joint[j], joint[:, j] = np.inf, np.inf
            alive = np.isfinite(joint[i])
            joint[i, alive] = joint[alive, i] = (_lengths(centre[alive] - centre[i]) + radius[alive] + radius[i]) / 2
        return balls[i]


def build_tree(points: np.ndarray) -> dict[str, np.ndarray]:
    """Balls of a block of whole-number points, the root last; points in an order in which each ball's stand together."""
    builder = _Builder(points)
    builder.grow(np.arange(len(points)))
    members = builder.members
    order = members[-1]
    place = np.empty(len(points), np.int64)
    place[order] = np.arange(len(points))
    count = np.array([len(m) for m in members])
    sums = np.array([points[m].sum(axis=0) for m in members])
    centre = sums / count[:, None]
    return {
        "points": points[order].astype(np.int32), "order": order.astype(np.int32),
        "start": np.array([place[m[0]] for m in members], np.int32), "count": count.astype(np.int32),
        "left": np.array(builder.left, np.int32), "right": np.array(builder.right, np.int32), "sums": sums,
        "radius": np.array([_lengths(points[m] - c).max() for m, c in zip(members, centre)]),
    }


def owners(tree: dict[str, np.ndarray], entries: np.ndarray) -> tuple[list[tuple[int, int]], np.ndarray, np.ndarray]:
    """(balls wholly owned with their entry, places of the other points, their entries): the nearest entry, ties to the lower number."""
    largest = max(int(np.abs(entries).max()), int(np.abs(tree["points"]).max(initial=0)))
    exact = np.float64 if 4 * entries.shape[1] * largest**2 < 1 << 53 else np.int64
    real = entries.astype(np.float64)
    squares = np.einsum("ij,ij->i", real, real)
    gaps = np.sqrt(np.maximum(0, squares[:, None] + squares - 2 * real @ real.T))
    # Of equal entries only the first can own a point.
    possible = np.zeros(len(entries), bool)
    possible[np.unique(entries, axis=0, return_index=True)[1]] = True

    owned, open_balls, open_lists = [], [], []
    balls, lists = np.array([len(tree["count"]) - 1]), possible[None]
    while len(balls):
        centre = tree["sums"][balls] / tree["count"][balls, None]
        distance = np.einsum("ij,ij->i", centre, centre)[:, None] + squares - 2 * centre @ real.T
        np.maximum(distance, 0, out=distance)
        best = np.where(lists, distance, np.inf).argmin(axis=1)
        row = np.arange(len(balls))
        # An entry is beaten in the whole ball if the plane between it and the best does not reach the ball, beyond what rounding can do.
        margin = 2 * tree["radius"][balls, None] * gaps[best] + 1e-9 * (distance + squares.max()) + 1e-6
        lists = lists & (distance - distance[row, best][:, None] <= margin)
        alone = lists.sum(axis=1) == 1
        owned += zip(balls[alone].tolist(), best[alone].tolist())
        bottom = ~alone & (tree["left"][balls] < 0)
        open_balls += balls[bottom].tolist()
        open_lists.append(lists[bottom])
        inner = ~alone & ~bottom
        lists = np.concatenate([lists[inner]] * 2)
        balls = np.concatenate([tree["left"][balls[inner]], tree["right"][balls[inner]]])
    if not open_balls:
        return owned, np.empty(0, np.int64), np.empty(0, np.int64)
    places = np.concatenate([np.arange(tree["start"][b], tree["start"][b] + tree["count"][b]) for b in open_balls])
    allowed = np.repeat(np.concatenate(open_lists), tree["count"][open_balls], axis=0)
    whole, points = entries.astype(exact), tree["points"][places].astype(exact)
    distance = np.einsum("ij,ij->i", whole, whole) - 2 * points @ whole.T
    top = np.inf if exact is np.float64 else np.iinfo(np.int64).max
    return owned, places, np.where(allowed, distance, top).argmin(axis=1)


def ball_sums(tree: dict[str, np.ndarray], entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(count, sum) of the points that each entry owns."""
    owned, places, chosen = owners(tree, entries)
    counts, sums = np.bincount(chosen, minlength=len(entries)), np.zeros(entries.shape, np.int64)
    np.add.at(sums, chosen, tree["points"][places])
    if owned:
        balls, entry = np.array(owned).T
        np.add.at(counts, entry, tree["count"][balls])
        np.add.at(sums, entry, tree["sums"][balls])
    return counts, sums


def point_codes(tree: dict[str, np.ndarray], entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) of each point, in the order of the block."""
    owned, places, chosen = owners(tree, entries)
    found = np.empty(len(tree["order"]), np.int64)
    found[places] = chosen
    for ball, entry in owned:
        found[tree["start"][ball] : tree["start"][ball] + tree["count"][ball]] = entry
    off = tree["points"].astype(np.int64) - entries[found]
    code, error = np.empty_like(found), np.empty_like(found)
    code[tree["order"]], error[tree["order"]] = found, np.einsum("ij,ij->i", off, off)
    return code, error


# --- jobs -------------------------------------------------------------------------------

def whole_numbers(x: np.ndarray, scale: int = SCALE) -> np.ndarray:
    found = np.floor(x.astype(np.float64) * scale)
    if np.abs(found).max(initial=0) >= TOO_LARGE:
        raise ValueError(f"a component times {scale} must lie below {TOO_LARGE}")
    return found.astype(np.int64)


def _finite(vector: Column) -> Column:
    return vector.isNotNull() & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))


def _block_rows(kept: DataFrame, parts: int, scale: int, label_type: str) -> DataFrame:
    """A row for each block: its keys, labels and trees."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            while batch.num_rows:
                head = batch.slice(0, BLOCK - rows)
                held, rows, batch = [*held, head], rows + head.num_rows, batch.slice(head.num_rows)
                if rows == BLOCK:
                    yield block(pa.Table.from_batches(held))
                    held, rows = [], 0
        if rows:
            yield block(pa.Table.from_batches(held))

    def block(table: pa.Table) -> pa.RecordBatch:
        key, label, vector = (pa.concat_arrays(table.column(c).chunks) for c in ("key", "label", "v"))
        flat = vector.flatten().to_numpy(zero_copy_only=False)
        points, arrays = whole_numbers(flat.reshape(table.num_rows, -1), scale), {}
        for p, part in enumerate(np.split(points, parts, axis=1)):
            arrays |= {f"{p}_{name}": a for name, a in build_tree(part).items()}
        buffer = io.BytesIO()
        np.savez(buffer, **arrays)
        one = pa.array([0, table.num_rows], pa.int32())
        return pa.RecordBatch.from_arrays(
            [pa.ListArray.from_arrays(one, key), pa.ListArray.from_arrays(one, label), pa.array([buffer.getvalue()], pa.binary())],
            ["keys", "labels", "trees"],
        )

    return kept.mapInArrow(run, f"keys array<bigint>, labels array<{label_type}>, trees binary")


def _trees(blob: bytes, parts: int) -> list[dict[str, np.ndarray]]:
    with np.load(io.BytesIO(blob)) as arrays:
        trees = [{} for _ in range(parts)]
        for name in arrays.files:
            part, _, field = name.partition("_")
            trees[int(part)][field] = arrays[name]
    return trees


def _sums(blocks: DataFrame, codebooks: np.ndarray) -> DataFrame:
    """(part, entry, n, s0, s1, ...): what each entry owns. A task gives a row for each entry, whatever it has read."""
    shared = blocks.sparkSession.sparkContext.broadcast(codebooks)
    parts, entries, positions = codebooks.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        counts, sums = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, positions), np.int64)
        for batch in batches:
            for blob in batch.column("trees"):
                for p, tree in enumerate(_trees(blob.as_py(), parts)):
                    n, s = ball_sums(tree, books[p])
                    counts[p] += n
                    sums[p] += s
        part, entry = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(counts[part, entry]), pa.array(list(sums[part, entry]), pa.list_(pa.int64()))],
            ["part", "entry", "n", "sums"],
        )

    found = blocks.select("trees").mapInArrow(run, "part int, entry int, n bigint, sums array<bigint>")
    return found.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(positions)])


def refined(blocks: DataFrame, codebooks: np.ndarray) -> np.ndarray:
    """The codebooks after one round: each entry the floor of the mean of its parts; entries without parts stay."""
    found = codebooks.copy()
    for row in _sums(blocks, codebooks).collect():  # at most parts x entries rows
        found[row["part"], row["entry"]] = np.array(row[3:], np.int64) // row["n"]
    return found


def compress(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str | None = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
) -> Codes | None:
    """Codes of all usable vectors, a row each, and the codebooks; None where no vector is usable.

    Vectors that are null or hold null or non-finite components are left out, as are empty ones and those whose length is not
    the most common one that parts divide (ties: the longer). Codebooks start with the ``entries`` rows of the smallest keys, null keys last and
    equal keys by their vectors; with fewer rows they are smaller. Rows with equal keys have a code each. A null label is a label. entries: 256 at most.
    """
    if not 1 <= entries <= 256:
        raise ValueError("entries must lie between 1 and 256")
    chosen = vectors.select(
        F.col(key).cast("bigint").alias("key"), (F.col(label) if label else F.lit(None).cast("int")).alias("label"),
        F.col(vector).cast("array<double>").alias("v"),
    )
    finite = chosen.filter(_finite(F.col("v")) & (F.size("v") > 0) & (F.size("v") % parts == 0))
    length = finite.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if length is None:
        return None
    kept = finite.filter(F.size("v") == length["d"])
    first = kept.orderBy(F.col("key").asc_nulls_last(), "v").limit(entries).select("v").collect()  # at most 256 rows
    codebooks = np.stack(np.split(whole_numbers(np.array([r["v"] for r in first]), scale), parts, axis=1))
    blocks = materialize(_block_rows(kept, parts, scale, dict(chosen.dtypes)["label"]), "metric-trees")
    for _ in range(rounds):
        codebooks = refined(blocks, codebooks)
    shared = vectors.sparkSession.sparkContext.broadcast(codebooks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                found = [point_codes(t, b) for t, b in zip(_trees(batch.column("trees")[row].as_py(), parts), shared.value)]
                codes, error = np.array([c for c, _ in found], np.uint8).T, sum(e for _, e in found)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("keys")[row].values, batch.column("labels")[row].values,
                     pa.array([c.tobytes().hex() for c in np.ascontiguousarray(codes)]), pa.array(error)],
                    [key, label or "label", "code", "error"],
                )

    fields = f"`{key}` bigint, `{label or 'label'}` {dict(chosen.dtypes)['label']}, code string, error bigint"
    return Codes(blocks.mapInArrow(run, fields), codebooks)
