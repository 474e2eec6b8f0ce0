"""Approximate nearest neighbours by balanced posting lists.

Centroids are fitted on a bounded sample, lists that would be long being split until they are balanced. Every
vector goes to the list of its nearest centroid, and boundary vectors also to the lists of other centroids that are nearly
as near. A query finds its nearest centroids in a graph of them held in memory, prunes lists by the ratio of
their distance to the least one, and its vector is held against the whole lists that remain.

Equal vectors are one point with the least ids that could be asked of it, so a vector that a third of all rows
repeat is compared once. Lists and their queries are dealt out in blocks of bounded size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources import materialize

SAMPLE, LIST_SIZE, MOST_LISTS, FIT_TURNS = 20_000, 150, 4_096, 8
REPLICAS, REPLICA_RATIO = 4, 1.06
PROBES, PROBE_RATIO = 48, 1.35
DEGREE, BEAM = 24, 96
BLOCK = 2_000
_NODE = "node binary, point array<double>"


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return whole.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def usable(vectors: DataFrame, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """(vec_id, node, point): vectors that take part, as doubles; node names equal ones.

    Null, empty or zero vectors and such with null or non-finite components take no part, nor do rows without id.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i, v in zip(batch.column("id").to_pylist(), batch.column("v").to_pylist()):
                if i is not None and v and None not in v:
                    x = np.array(v, np.float64) + 0.0  # -0 becomes 0
                    if np.isfinite(x).all() and x.any():
                        rows.append((i, hashlib.blake2b(x.tobytes(), digest_size=16).digest(), x))
            types = (pa.int64(), pa.binary(), pa.list_(pa.float64()))
            columns = zip(*rows) if rows else ([], [], [])
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], ["vec_id", "node", "point"])

    chosen = vectors.select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    return chosen.mapInArrow(run, f"vec_id bigint, {_NODE}")


def fit_centroids(sample: np.ndarray, lists: int, turns: int = FIT_TURNS, seed: int = 0) -> np.ndarray:
    """Unit centroids of the sample's unit vectors. Lists of over twice the mean size are split, nearly empty ones dropped."""
    rng = np.random.default_rng(seed)
    lists = min(lists, len(sample))
    centroids = sample[rng.choice(len(sample), lists, replace=False)]
    for turn in range(turns):
        nearest = np.concatenate([(part @ centroids.T).argmax(axis=1) for part in np.array_split(sample, max(1, len(sample) // 4096))])
        size = np.bincount(nearest, minlength=len(centroids))
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, sample)
        kept = (size > max(0, len(sample) / len(centroids) / 8)) & (np.abs(sums).sum(axis=1) > 0)
        moved = _unit(sums[kept])
        if turn < turns - 1:
            large = [k for k in np.argsort(-size) if size[k] > 2 * len(sample) / lists][: lists - len(moved)]
            extra = [sample[rng.choice(np.flatnonzero(nearest == k))] for k in large]
            moved = np.vstack([moved, *[e[None] for e in extra]]) if extra else moved
        centroids = moved
    return np.unique(centroids, axis=0)


def centroid_graph(centroids: np.ndarray, degree: int = DEGREE) -> tuple[np.ndarray, np.ndarray]:
    """(neighbours of each centroid, entry points): nearest ones, and a spread of starts."""
    count = len(centroids)
    near = np.empty((count, min(degree, count)), np.int64)
    for part in np.array_split(np.arange(count), max(1, count // 1024)):
        near[part] = np.argsort(-(centroids[part] @ centroids.T), axis=1, kind="stable")[:, : near.shape[1]]
    return near, np.unique(np.linspace(0, count - 1, min(count, 32)).astype(np.int64))


def search_graph(points: np.ndarray, centroids: np.ndarray, near: np.ndarray, entries: np.ndarray, beam: int = BEAM):
    """(centroid numbers, cosines), nearest first, of the beam that best-first search ends with, for all points side by side."""
    count, beam = len(points), min(beam, len(centroids))
    row = np.arange(count)[:, None]
    seen = np.zeros((count, len(centroids)), bool)
    seen[:, entries] = True
    ids = np.tile(entries, (count, 1))
    cos = points @ centroids[entries].T
    done = np.zeros(ids.shape, bool)
    while True:
        order = np.argsort(-cos, axis=1, kind="stable")[:, :beam]
        ids, cos, done = ids[row, order], cos[row, order], done[row, order]
        waiting = ~done & np.isfinite(cos)
        if not waiting.any():
            return ids, cos
        best = waiting.argmax(axis=1)  # rows are sorted, so this is the nearest one that waits
        going = waiting[row[:, 0], best]
        done[row[:, 0], best] = True
        new = near[ids[row[:, 0], best]]
        fresh = ~seen[row, new] & going[:, None]
        seen[row, new] = True
        found = np.where(fresh, np.einsum("ij,ikj->ik", points, centroids[new]), -np.inf)
        ids, cos = np.hstack([ids, new]), np.hstack([cos, found])
        done = np.hstack([done, ~fresh])


def _lists(points: DataFrame, index, most: int, ratio: float, least: int) -> DataFrame:
    """points (node, point, ...) with a row for each list that is near: within ratio of the least distance, least to most of them."""
    shared = points.sparkSession.sparkContext.broadcast(index)
    names = points.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids, near, entries = shared.value
        for whole in batches:
            for start in range(0, whole.num_rows, 512):
                batch = whole.slice(start, 512)
                unit = _unit(_matrix(batch.column("point"), centroids.shape[1]))
                ids, cos = search_graph(unit, centroids, near, entries, max(BEAM, most))
                distance = np.sqrt(np.maximum(0, 2 - 2 * cos))
                chosen = (distance <= distance[:, :1] * ratio + 1e-9) & np.isfinite(cos)
                chosen[:, :least] |= np.isfinite(cos[:, :least])
                chosen[:, most:] = False
                rows, places = np.nonzero(chosen)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(n).take(pa.array(rows)) for n in names), pa.array(ids[rows, places].astype(np.int32))],
                    [*names, "list"],
                )

    fields = ", ".join(f"{n} {t}" for n, t in points.dtypes)
    return points.mapInArrow(run, f"{fields}, list int")


def _scan(members: DataFrame, asked: DataFrame, dim: int, k: int) -> DataFrame:
    """(query, vec_id, score): the k + 1 best ids of each query in each block of its lists."""
    sizes = members.groupBy("list").agg(F.count(F.lit(1)).alias("m")).join(
        asked.groupBy("list").agg(F.count(F.lit(1)).alias("q")), "list"
    ).select("list", F.ceil(F.col("m") / BLOCK).cast("int").alias("m"), F.ceil(F.col("q") / BLOCK).cast("int").alias("q"))
    sizes = materialize(sizes, "list-sizes")  # a row for each list

    def dealt(rows: DataFrame, own: str, other: str) -> DataFrame:
        return rows.join(sizes, "list").withColumn(f"{own}_block", F.pmod(F.xxhash64("node"), F.col(own)).cast("int")).withColumn(
            f"{other}_block", F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        ).drop("m", "q")

    def best(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[bytes, int, float]] = []
        if len(left) and len(right):
            a, b = _matrix(left.column("point"), dim), _matrix(right.column("point"), dim)
            norm_a, norm_b = (np.sqrt(np.einsum("ij,ij->i", x, x)) for x in (a, b))
            ids, own = left.column("ids").to_pylist(), right.column("node").to_pylist()
            for start in range(0, len(b), 256):
                score = (b[start : start + 256] @ a.T) / (norm_b[start : start + 256, None] * norm_a[None, :])
                for r in range(len(score)):
                    cos, top = score[r], k + 1
                    least = np.partition(cos, -top)[-top] if len(cos) > top else -np.inf
                    # Rounding must not part ties, so near ones come along; exact scores follow below.
                    close = np.flatnonzero(cos >= least - 1e-12)
                    exact = np.einsum("j,ij->i", b[start + r], a[close]) / (norm_b[start + r] * norm_a[close])
                    found = sorted((-s, i) for s, c in zip(exact.tolist(), close) for i in ids[c])[:top]
                    out.extend((own[start + r], i, -s) for s, i in found)
        types = (pa.binary(), pa.int64(), pa.float64())
        return pa.table({n: pa.array([x[j] for x in out], t) for j, (n, t) in enumerate(zip(("query", "vec_id", "score"), types))})

    keys = ("list", "m_block", "q_block")
    return dealt(members, "m", "q").groupBy(*keys).cogroup(dealt(asked, "q", "m").groupBy(*keys)).applyInArrow(
        best, "query binary, vec_id bigint, score double"
    )


def search(
    vectors: DataFrame, every: int = 50, k: int = 5, vector: str = "embedding", key: str = "vec_id", sample: int = SAMPLE,
    list_size: int = LIST_SIZE, most_lists: int = MOST_LISTS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each row whose id is divisible by ``every``, nearest first.

    Nearness is the cosine in double precision over the original vectors, ties going to the smaller id; all other rows are
    candidates, and all of them are returned where there are k or fewer. Vectors that take no part (see usable) are
    neither queries nor candidates; so are those whose length is not the most frequent one (the longer of several). Repeated rows
    count once. The index is fitted on at most ``sample`` different vectors and holds every vector.
    """
    rows = materialize(usable(vectors, vector, key).dropDuplicates(["vec_id", "node"]), "vectors")
    length = rows.groupBy(F.size("point").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    dim = length["d"] if length else 1
    rows = rows.filter(F.size("point") == dim)
    # The k + 1 least ids of a point are enough, as a query leaves out one at most.
    least = Window.partitionBy("node").orderBy("vec_id")
    few = rows.withColumn("_n", F.row_number().over(least)).filter(F.col("_n") <= k + 1)
    points = materialize(
        few.groupBy("node").agg(F.first("point").alias("point"), F.sort_array(F.collect_list("vec_id")).alias("ids")), "points"
    )
    count = points.count()
    fitted = points.orderBy(F.xxhash64("node")).limit(sample).select("point").toPandas()["point"]
    if not count:
        return vectors.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    lists = int(min(most_lists, max(1, count // list_size), max(1, len(fitted) // 4)))
    centroids = fit_centroids(_unit(np.stack(fitted.to_list())), lists)
    index = (centroids, *centroid_graph(centroids))

    members = materialize(_lists(points, index, REPLICAS, REPLICA_RATIO, 1), "posting-lists")
    queries = materialize(rows.filter(F.col("vec_id") % every == 0).select("vec_id", "node"), "queries")
    asking = points.select("node", "point").join(queries.select("node").distinct(), "node")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")

    def found_by(asked: DataFrame) -> DataFrame:
        found = _scan(members, asked, dim, k).groupBy("query", "vec_id").agg(F.max("score").alias("score"))
        return materialize(found.withColumn("_n", F.row_number().over(best)).filter(F.col("_n") <= k + 1).drop("_n"), "found")

    found = found_by(materialize(_lists(asking, index, PROBES, PROBE_RATIO, 8), "probes"))
    # Queries whose lists hold too few rows ask all lists.
    enough = found.groupBy("query").count().filter(F.col("count") > k).select(F.col("query").alias("node"))
    short = asking.join(enough, "node", "left_anti")
    if len(centroids) > 8 and not short.isEmpty():
        everywhere = short.withColumn("list", F.explode(F.sequence(F.lit(0), F.lit(len(centroids) - 1))))
        again = found_by(everywhere)
        found = found.join(again.select("query").distinct(), "query", "left_anti").unionByName(again)
    answers = queries.withColumnRenamed("vec_id", "query_id").join(found, F.col("node") == F.col("query")).filter(
        F.col("vec_id") != F.col("query_id")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return answers.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
