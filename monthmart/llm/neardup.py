"""Near duplicates: ProbMinHash signatures, banding, verification, classes.

A document is the set of its different shingles (runs of five words; a shorter text is one shingle), each of weight 1, as
links are told by the Jaccard similarity of sets. ProbMinHash lets each element send points of a Poisson
process of its weight to random components; a component keeps the element of its earliest point, and
an element stops once its next point would come later than every component's. Two documents agree in a component
with the probability of their probability Jaccard similarity, which for equal weights is the Jaccard similarity.

Equal shingle sets are one node. Nodes that agree in all components of a band share a bucket, and a link
is a pair of nodes whose Jaccard similarity, computed from their texts, reaches the threshold. Buckets
are searched without making all their pairs: members are first held against one member of the bucket, and
then only members of different components against each other, until every pair that shares
a bucket is either tested or known to be in one class. Large buckets are held against themselves in blocks of bounded
size, inside the tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources import materialize
from .components import components
from .text import as_signed, matching_rows, mix, row_keys, texts, words_of

WORDS, THRESHOLD = 5, 0.8
BANDS, ROWS = 40, 6
# A pair at the threshold shares no band, or has a smaller share of equal components (of 240), with a probability
# of about 1e-5 each.
LEAST_AGREEMENT = 0.69
# Buckets up to the first size give pairs (so at most 25 for each member), larger ones blocks of the second.
PAIRED_BUCKET, BLOCK = 50, 800
ELEMENTS_PER_STEP = 150_000
WORDS_REMEMBERED = 1_000_000
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_FACTOR = np.uint64(0x100000001B3)

SKETCH_SCHEMA = "doc_id bigint, text_hash bigint, node binary, shingles int, bands array<bigint>, sketch binary"


class _WordHashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > WORDS_REMEMBERED:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


def shingle_hashes(text: str, hashes: dict, words: int = WORDS) -> np.ndarray:
    """Hash of each run of so many words, in order; of the whole text if it has fewer; none without words."""
    found = words_of(text)
    ids = np.fromiter(map(hashes.__getitem__, found), np.uint64, len(found))
    if not len(ids):
        return ids
    width = min(words, len(ids))
    out = np.full(len(ids) - width + 1, width, np.uint64)
    for k in range(width):
        out = mix(out * _FACTOR + ids[k : len(ids) - width + 1 + k])
    return out


def prob_minhash(owner: np.ndarray, element: np.ndarray, weight: np.ndarray, sets: int, size: int) -> np.ndarray:
    """Signatures (sets x size) of weighted sets given as parallel arrays; all sets advance side by side."""
    arrival = np.full(sets * size, np.inf)
    signature = np.zeros(sets * size, np.uint64)
    last = np.full(sets, np.inf)
    time = np.zeros(len(element))
    turn = np.zeros(1, np.uint64)
    while len(element):
        turn += np.uint64(1)
        draw = mix(element + turn * _GOLDEN)
        time = time - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / weight
        going = time < last[owner]
        owner, element, weight, time, draw = (x[going] for x in (owner, element, weight, time, draw))
        slot = owner * size + (mix(draw) % np.uint64(size)).astype(np.int64)
        np.minimum.at(arrival, slot, time)
        first = arrival[slot] == time
        signature[slot[first]] = element[first]
        touched = np.unique(owner)
        last[touched] = arrival.reshape(sets, size)[touched].max(axis=1)
    return signature.reshape(sets, size)


def _sketches(batches: Iterator[pa.RecordBatch], words: int, bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    hashes, size = _WordHashes(), bands * rows
    for batch in batches:
        kept = [np.unique(shingle_hashes(t, hashes, words)) for t in texts(batch)]
        count = np.array([len(s) for s in kept], np.int64)
        nodes = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in kept]
        band_of: list = [None] * len(kept)
        sketch_of: list = [None] * len(kept)
        # Up to three shingles reach 0.8 with an equal set only. Sets of like size go together, as small ones take more turns.
        order = [i for i in np.argsort(count, kind="stable") if count[i] > 3]
        start = 0
        while start < len(order):
            ends = np.cumsum(count[order[start:]])
            group = order[start : start + max(1, int(np.searchsorted(ends, ELEMENTS_PER_STEP)))]
            start += len(group)
            element = np.concatenate([kept[i] for i in group])
            signature = prob_minhash(
                np.repeat(np.arange(len(group)), count[group]), element, np.ones(len(element)), len(group), size
            )
            mixed = mix(signature)
            parts = signature.reshape(len(group), bands, rows)
            band = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(group), bands))
            for k in range(rows):
                band = mix(band * _FACTOR + parts[:, :, k])
            for j, i in enumerate(group):
                band_of[i] = as_signed(band[j])
                sketch_of[i] = (mixed[j] & np.uint64(255)).astype(np.uint8).tobytes()
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"), batch.column("text_hash"), pa.array(nodes, pa.binary()), pa.array(count, pa.int32()),
                pa.array(band_of, pa.list_(pa.int64())), pa.array(sketch_of, pa.binary()),
            ],
            ["doc_id", "text_hash", "node", "shingles", "bands", "sketch"],
        )


def sketches(docs: DataFrame, words: int = WORDS, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """SKETCH_SCHEMA of each row of docs (doc_id, text); node is null for a text without words."""
    return row_keys(docs).mapInArrow(lambda b: _sketches(b, words, bands, rows), SKETCH_SCHEMA)


def _similar(pairs: DataFrame, threshold: float, words: int) -> DataFrame:
    """Pairs (a, b, text_a, text_b) whose Jaccard similarity reaches the threshold: (a, b, similarity)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, kept, kept_set = _WordHashes(), None, None
        for batch in batches:
            out = []
            columns = [batch.column(c).to_pylist() for c in ("a", "b", "text_a", "text_b")]
            for a, b, text_a, text_b in zip(*columns):
                if b != kept:  # rows of one partner come one after another
                    kept, kept_set = b, np.unique(shingle_hashes(text_b or "", hashes, words))
                own = np.unique(shingle_hashes(text_a or "", hashes, words))
                both = len(np.intersect1d(own, kept_set, assume_unique=True))
                similarity = both / max(1, len(own) + len(kept_set) - both)
                if similarity >= threshold:
                    out.append((a, b, similarity))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in out], t) for k, t in enumerate((pa.binary(), pa.binary(), pa.float64()))],
                ["a", "b", "similarity"],
            )

    return pairs.select("a", "b", "text_a", "text_b").mapInArrow(run, "a binary, b binary, similarity double")


def _agreement(a: str, b: str):
    """Share of equal bytes of two sketches, without decoding them: their hexadecimal pairs, one by one."""
    return F.expr(
        f"aggregate(sequence(1, length({a})), 0, (n, i) -> n + if(substring({a}, i, 1) = substring({b}, i, 1), 1, 0)) / length({a})"
    )


class _Search:
    """What the rounds of one search share: node texts, sketches and the pairs already tested."""

    def __init__(self, docs: DataFrame, nodes: DataFrame, members: DataFrame, threshold: float, words: int):
        self.nodes, self.threshold, self.words = nodes, threshold, words
        wanted = members.select("node").distinct().join(nodes.select("node", "doc_id", "text_hash"), "node")
        keyed = row_keys(docs)
        same = keyed["doc_id"].eqNullSafe(wanted["doc_id"]) & (keyed["text_hash"] == wanted["text_hash"])
        texts_of = keyed.join(wanted, same).select(wanted["node"].alias("node"), keyed["text"].alias("text"))
        self.texts = materialize(texts_of.dropDuplicates(["node"]), "node-texts")
        self.tested: DataFrame | None = None

    def links(self, pairs: DataFrame) -> DataFrame:
        """Links among pairs (a, b), tested once whichever way round; written."""
        new = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        if self.tested is not None:
            new = new.join(self.tested, ["a", "b"], "left_anti")
        sized = [
            self.nodes.select(*[F.col(c).alias(f"{c}_{s}") for c in ("node", "shingles", "sketch")]) for s in "ab"
        ]
        least = F.least("shingles_a", "shingles_b") / F.greatest("shingles_a", "shingles_b")
        likely = (
            new.join(sized[0], new["a"] == F.col("node_a")).join(sized[1], F.col("b") == F.col("node_b"))
            .filter((least >= self.threshold) & (_agreement("sketch_a", "sketch_b") >= LEAST_AGREEMENT))
            .select("a", "b")
        )
        likely = materialize(likely, "likely-pairs")
        self.tested = likely if self.tested is None else self.tested.union(likely)
        text_a = self.texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
        text_b = self.texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
        return materialize(_similar(likely.join(text_a, "a").join(text_b, "b"), self.threshold, self.words), "links")


def _shared_buckets(nodes: DataFrame) -> DataFrame:
    """(bucket, node) of buckets with several nodes."""
    rows = nodes.select(F.explode("bands").alias("bucket"), "node")
    several = rows.groupBy("bucket").count().filter("count > 1")
    return materialize(rows.join(several.select("bucket"), "bucket"), "buckets")


def _open_buckets(members: DataFrame, label: DataFrame) -> DataFrame:
    """Members (bucket, node) of buckets in which at least two labels meet, with their label and the members' number."""
    labelled = members.select("bucket", "node").join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))
    mixed = labelled.groupBy("bucket").agg(
        F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("members")
    ).filter("lo != hi")
    return materialize(labelled.join(mixed.select("bucket", "members"), "bucket"), "open-buckets")


def _block_links(table: pa.Table, bands: int, threshold: float, words: int) -> pa.Table:
    """Links between the members of two blocks of a bucket (or of one with itself) that are in different components.

    A pair that shares several buckets is tested in that of its first band. Links found join components at once.
    """
    lo, hi = table.column("lo")[0].as_py(), table.column("hi")[0].as_py()
    node, label, block = (table.column(c).to_pylist() for c in ("node", "label", "block"))
    count = table.column("shingles").to_numpy()
    sketch = np.stack([np.frombuffer(x, np.uint8) for x in table.column("sketch").to_pylist()])
    band = np.array(table.column("bands").to_pylist(), np.int64).reshape(len(node), bands)
    at_band = int(np.flatnonzero(band[0] == table.column("bucket")[0].as_py())[0])
    all_texts, hashes, sets = table.column("text"), _WordHashes(), {}
    parent = {x: x for x in label}

    def root(x: bytes) -> bytes:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    def shingles(k: int) -> np.ndarray:
        if k not in sets:
            sets[k] = np.unique(shingle_hashes(all_texts[k].as_py() or "", hashes, words))
        return sets[k]

    first = [k for k, b in enumerate(block) if b == lo]
    second = np.array([k for k, b in enumerate(block) if b == hi])
    links = []
    for a in first:
        others = second[second > a] if lo == hi else second
        ratio = np.minimum(count[others], count[a]) / np.maximum(count[others], count[a])
        others = others[ratio >= threshold]
        others = others[(sketch[others] == sketch[a]).mean(axis=1) >= LEAST_AGREEMENT]
        if at_band:
            others = others[~(band[others, :at_band] == band[a, :at_band]).any(axis=1)]
        for b in others:
            if root(label[a]) != root(label[b]):
                both = len(np.intersect1d(shingles(a), shingles(b), assume_unique=True))
                similarity = both / (len(sets[a]) + len(sets[b]) - both)
                if similarity >= threshold:
                    links.append((node[a], node[b], similarity))
                    parent[root(label[a])] = root(label[b])
    types = (pa.binary(), pa.binary(), pa.float64())
    return pa.table({n: pa.array([x[k] for x in links], t) for k, (n, t) in enumerate(zip(("a", "b", "similarity"), types))})


def _large_bucket_links(members: DataFrame, search: _Search, bands: int) -> DataFrame:
    """Links between components that meet in large buckets (members: bucket, node, label, members)."""
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    pairs_of_blocks = F.transform(F.sequence(F.lit(0), blocks - 1), lambda k: F.struct(
        F.least("block", k).alias("lo"), F.greatest("block", k).alias("hi")
    ))
    rows = (
        members.withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int"))
        .select("bucket", "node", "label", "block", F.explode(pairs_of_blocks).alias("of"))
        .join(search.nodes.select("node", "shingles", "bands", "sketch"), "node").join(search.texts, "node")
        .select("bucket", "of.lo", "of.hi", "block", "node", "label", "shingles", "bands", "sketch", "text")
    )
    threshold, words = search.threshold, search.words
    found = rows.groupBy("bucket", "lo", "hi").applyInArrow(
        lambda table: _block_links(table, bands, threshold, words), "a binary, b binary, similarity double"
    )
    return materialize(found, "links")


def _stars(members: DataFrame) -> DataFrame:
    """(a, b, shared): members of a bucket against the bucket's member of least hash, where labels differ."""
    order = F.struct(F.xxhash64("node").alias("h"), F.col("node").alias("b"), F.col("label").alias("centre"))
    centre = members.groupBy("bucket").agg(F.min(order).alias("c")).select("bucket", "c.b", "c.centre")
    return (
        members.join(centre, "bucket").filter("label != centre").groupBy(F.col("node").alias("a"), "b")
        .agg(F.count(F.lit(1)).alias("shared"))
    )


def _labels(links: DataFrame) -> DataFrame:
    return materialize(components(links.select("a", "b")).select("node", F.col("component").alias("label")), "labels")


def near_duplicates(
    docs: DataFrame, words: int = WORDS, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, text_hash, class_id, class_size, class_texts, class_key.

    class_id is the least doc_id of the documents that links connect. class_size counts rows and class_texts the
    different shingle sets of the class; class_key names the class where ids are null. A text that is null, empty or without words is in a class of its own: its
    class_id is its doc_id, its class_size 1, its class_key null. Repeated rows and equal texts are in one class. A class whose ids are all
    null has a null class_id. No rows give no rows; other columns of docs are passed over.
    """
    sketched = materialize(sketches(docs, words, bands, rows), "sketches")
    worded = sketched.filter(F.col("node").isNotNull())
    first = F.struct(F.col("doc_id").isNull().alias("void"), "doc_id", "text_hash")
    nodes = materialize(
        worded.groupBy("node").agg(
            F.min(first).alias("f"), F.first("shingles").alias("shingles"), F.first("bands").alias("bands"),
            F.first("sketch").alias("sketch"), F.count(F.lit(1)).alias("copies"),
        ).select("node", "f.doc_id", "f.text_hash", "shingles", "bands", "sketch", "copies"),
        "nodes",
    )
    members = _shared_buckets(nodes)
    search = _Search(docs, nodes, members, threshold, words)

    # First each node with the star centre it meets most often, then with the other centres.
    stars = _stars(members.withColumn("label", F.col("node")))
    closest = stars.groupBy("a").agg(F.max_by("b", F.struct("shared", "b")).alias("b"))
    links = search.links(closest)
    members = _open_buckets(members, _labels(links))
    links = links.union(search.links(_stars(members)))
    # Then whatever still meets in a bucket without being in one class.
    members = _open_buckets(members, _labels(links))
    small = members.filter(F.col("members") <= PAIRED_BUCKET)
    left, right = (small.select("bucket", F.col("node").alias(s), F.col("label").alias(f"label_{s}")) for s in "ab")
    rest = left.join(right, "bucket").filter("a < b AND label_a != label_b").select("a", "b")
    links = links.union(search.links(rest))
    links = links.union(_large_bucket_links(members.filter(F.col("members") > PAIRED_BUCKET), search, bands))
    label = _labels(links)

    placed = nodes.join(label, "node", "left").select(
        "node", F.coalesce("label", "node").alias("label"), "doc_id", "copies"
    )
    classes = placed.groupBy("label").agg(
        F.min("doc_id").alias("class_id"), F.sum("copies").alias("class_size"), F.count(F.lit(1)).alias("class_texts")
    )
    of_node = placed.select("node", "label").join(classes, "label").withColumn("class_key", F.hex("label")).drop("label")
    alone = sketched.filter(F.col("node").isNull()).select(
        "doc_id", "text_hash", F.col("doc_id").alias("class_id"), F.lit(1).cast("bigint").alias("class_size"),
        F.lit(1).cast("bigint").alias("class_texts"), F.lit(None).cast("string").alias("class_key"),
    )
    return worded.select("doc_id", "text_hash", "node").join(of_node, "node").drop("node").unionByName(alone)


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """Rows of docs, one of each class: that with the class's least doc_id. Texts without words all stay."""
    found = materialize(near_duplicates(docs, **options), "classes").filter(F.col("class_key").isNotNull())
    order = F.struct(F.col("doc_id").isNull().alias("void"), "doc_id", "text_hash")
    rows = found.groupBy("class_key", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("copies"))
    least = rows.groupBy("class_key").agg(F.min(order).alias("least"))
    marked = materialize(rows.join(least, "class_key").withColumn("kept", order == F.col("least")), "kept-rows")
    result = matching_rows(docs, marked.filter("NOT kept"), "left_anti")
    repeated = marked.filter("kept AND copies > 1")
    if repeated.isEmpty():
        return result
    # Repeated rows are copies as well: one of those with equal id and text stays.
    once = matching_rows(result, repeated, "left_semi").dropDuplicates(["doc_id", "text"])
    return matching_rows(result, repeated, "left_anti").unionByName(once)
