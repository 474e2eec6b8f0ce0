"""Quality by perplexity under an n-gram model of trusted text.

The model is an interpolated modified Kneser-Ney model of characters (trigrams by default) over an open alphabet:
a key holds the code points themselves, and all characters that trusted text lacks share one more symbol's chance. Counts are taken in the
tasks and summed by n-gram across the cluster; discounts, continuation counts and what contexts leave over come from joins of
the count tables, sharded by n-gram. The different n-grams of all documents, aggregated in the tasks before they are
shuffled, are joined with them, order by order, which gives each its log probability. That table grows with the
text. It goes back to the documents in one of two ways with equal results: up to ``BROADCAST_GRAMS`` rows, which are
counted, it is broadcast and no text moves; beyond, documents are dealt into blocks of bounded size, each block's
different n-grams are joined with the table, and a block meets its own n-grams only.

A document's score is its perplexity per character. Documents beyond a quantile of the trusted
documents of their language are rejected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources import materialize
from .text import matching_rows, texts

ORDER = 3
# A code point takes so many bits of a key, so three of them make a whole number.
BITS = 21
# Rows of (n-gram, log probability) that a broadcast may have: 48 MB.
BROADCAST_GRAMS = 3_000_000
# Characters of a block of documents where the table is not broadcast.
BLOCK_CHARS = 4_000_000
# A document goes if its perplexity is beyond this quantile of the trusted ones times this margin.
QUANTILE, MARGIN = 0.98, 1.15
LEAST_TRUSTED = 50
# A short text says little: its perplexity is taken together with so many characters of usual trusted text.
PRIOR_CHARS = 50
BORDER = 0x110000  # before and after a text; no code point
CHARS_PER_STEP = 2_000_000


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


def _chunks(all_texts: list[str], order: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Texts in steps of bounded size: (codes with order - 1 borders before and one after each text, lengths, first text)."""
    start = 0
    while start < len(all_texts):
        size, end = 0, start
        while end < len(all_texts) and (end == start or size + len(all_texts[end]) <= CHARS_PER_STEP):
            size += len(all_texts[end]) + order
            end += 1
        border = np.full(order - 1, BORDER, np.uint32)
        parts = [x for t in all_texts[start:end] for x in (border, _codes(t), np.full(1, BORDER, np.uint32))]
        yield np.concatenate(parts), np.array([len(t) for t in all_texts[start:end]]), start
        start = end


def _grams(codes: np.ndarray, lengths: np.ndarray, order: int) -> np.ndarray:
    """Key of the n-gram that ends at each character and at the border after it, text by text."""
    key = np.zeros(len(codes) - order + 1, np.int64)
    for k in range(order):
        key = (key << BITS) + codes[k : len(codes) - order + 1 + k]
    sizes = lengths + order  # borders before and one after
    offsets = np.cumsum(sizes) - sizes
    inside = np.repeat(offsets, lengths + 1) + np.arange(int((lengths + 1).sum())) - np.repeat(
        np.cumsum(lengths + 1) - (lengths + 1), lengths + 1
    )
    return key[inside]


def gram_counts(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """(gram, n): counts of all n-grams of the highest order in the texts of docs."""
    if not 1 <= order <= 63 // BITS:
        raise ValueError("a key holds one to three characters")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for codes, lengths, _ in _chunks(texts(batch), order):
                gram, n = np.unique(_grams(codes, lengths, order), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(gram), pa.array(n)], ["gram", "n"])

    return docs.select("text").mapInArrow(run, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))


def _context(gram: str = "gram") -> Column:
    return F.shiftright(gram, BITS)


def _ending(size: int, gram: str = "gram") -> Column:
    """The last size characters of a gram."""
    return F.col(gram) % F.lit(1 << (BITS * size)) if size * BITS < 63 else F.col(gram)


def _discounted(counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(gram, part), the discounted probability of a gram after its context, and (context, gamma), what the context leaves over.

    Discounts for counts of 1, 2 and more come from the numbers of grams with counts 1 to 4, as in modified Kneser-Ney.
    """
    n1, n2, n3, n4 = (F.sum((F.col("n") == k).cast("double")).alias(f"n{k}") for k in (1, 2, 3, 4))
    found = counts.agg(n1, n2, n3, n4).first()
    c1, c2, c3, c4 = (found[k] or 0.0 for k in range(4))
    y = c1 / (c1 + 2 * c2) if c1 else 0.5
    ratio = [(a, b) for a, b in ((c1, c2), (c2, c3), (c3, c4))]
    steps = [min(k, max(0.1, k - (k + 1) * y * b / a)) if a else 0.5 * k for k, (a, b) in enumerate(ratio, 1)]
    discount = F.when(F.col("n") == 1, steps[0]).when(F.col("n") == 2, steps[1]).otherwise(steps[2])
    parts = counts.withColumn("context", _context()).withColumn("discount", discount)
    total = parts.groupBy("context").agg(F.sum("n").alias("total"), F.sum("discount").alias("left"))
    return (
        parts.join(total, "context").select("gram", ((F.col("n") - F.col("discount")) / F.col("total")).alias("part")),
        total.select("context", (F.col("left") / F.col("total")).alias("gamma")),
    )


def kneser_ney(counts: DataFrame, order: int = ORDER) -> list[tuple[DataFrame, DataFrame]]:
    """Tables (gram, part) and (context, gamma) for each order from 1, counts below the highest order being continuations."""
    levels, current = [_discounted(counts)], counts
    for size in range(order - 1, 0, -1):
        # Each different gram of the order above adds one to the gram without its first character.
        current = current.groupBy(_ending(size).alias("gram")).agg(F.count(F.lit(1)).alias("n"))
        current = materialize(current, "continuation-counts")  # asked for several times in each order below
        levels.append(_discounted(current))
    return levels[::-1]


def log_probabilities(wanted: DataFrame, counts: DataFrame, order: int = ORDER) -> DataFrame:
    """(gram, log) for the different grams of wanted: the log probability of the last character after those before it.

    counts (gram, n) are those of trusted text; without any, every character is certain (log 0).
    """
    levels = kneser_ney(counts, order)
    # One more symbol stands for all characters that trusted text lacks.
    symbols = counts.select(_ending(1)).distinct().count() + 1
    lower = None
    # Each order is written before the next one asks for it, so the driver holds the plan of one order at a time.
    for size, (parts, gammas) in enumerate(levels, 1):
        grams = wanted.select(_ending(size).alias("gram")).distinct()
        chance = grams.join(parts, "gram", "left").withColumn("context", _context()).join(gammas, "context", "left")
        if lower is None:
            below = F.lit(1 / symbols)
        else:
            chance, below = chance.withColumn("ending", _ending(size - 1)).join(lower, "ending"), F.col("below")
        chance = chance.select("gram", (F.coalesce("part", F.lit(0.0)) + F.coalesce("gamma", F.lit(1.0)) * below).alias("chance"))
        if size < order:
            lower = materialize(chance.select(F.col("gram").alias("ending"), F.col("chance").alias("below")), "chances")
    return chance.select("gram", F.log("chance").alias("log"))


def text_perplexities(all_texts: list[str], grams: np.ndarray, logs: np.ndarray, order: int) -> np.ndarray:
    """Perplexity per character, the end of a text counting as one; grams are ascending and hold all of the texts."""
    out = np.zeros(len(all_texts))
    for codes, lengths, first in _chunks(all_texts, order):
        # Looking up each different gram once is faster than each place, as sorted keys are found near each other.
        gram, place = np.unique(_grams(codes, lengths, order), return_inverse=True)
        found = logs[np.searchsorted(grams, gram)][place]
        starts = np.cumsum(lengths + 1) - (lengths + 1)
        out[first : first + len(lengths)] = np.add.reduceat(found, starts) / (lengths + 1)
    return np.exp(-out)


def perplexities(docs: DataFrame, counts: DataFrame, order: int = ORDER, broadcast_grams: int = BROADCAST_GRAMS) -> DataFrame:
    """docs without text, with perplexity added, under the model of trusted counts (gram, n); one row per row of docs."""
    # Each order asks for endings of these, so the texts are read once for all.
    wanted = materialize(gram_counts(docs, order).select("gram"), "grams")
    logs = materialize(log_probabilities(wanted, counts, order), "log-probabilities")
    kept = [n for n in docs.columns if n != "text"]
    schema = ", ".join([*(f"`{n}` {t}" for n, t in docs.dtypes if n != "text"), "perplexity double"])

    def scored(rows: pa.RecordBatch | pa.Table, grams: np.ndarray, log: np.ndarray) -> list:
        score = pa.array(text_perplexities(texts(rows), grams, log, order), pa.float64())
        return [*(rows.column(n) for n in kept), score]

    if logs.count() <= broadcast_grams:
        rows = logs.toPandas().sort_values("gram")
        shared = docs.sparkSession.sparkContext.broadcast((rows["gram"].to_numpy(), rows["log"].to_numpy()))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield pa.RecordBatch.from_arrays(scored(batch, *shared.value), [*kept, "perplexity"])

        return docs.mapInArrow(run, schema)

    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = chars // BLOCK_CHARS + 1
    dealt = docs.withColumn("_block", F.pmod(F.xxhash64(*[c for c in docs.columns if c != "text"]), F.lit(blocks)))

    def requests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block, all_texts = batch.column("_block").to_numpy(), np.array(texts(batch), dtype=object)
            for own in np.unique(block):
                for codes, lengths, _ in _chunks(list(all_texts[block == own]), order):
                    gram = np.unique(_grams(codes, lengths, order))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(gram), own)), pa.array(gram)], ["_block", "gram"])

    asked = dealt.select("_block", "text").mapInArrow(requests, "_block bigint, gram bigint").distinct().join(logs, "gram")

    def meet(rows: pa.Table, own: pa.Table) -> pa.Table:
        grams, log = own.column("gram").to_numpy(), own.column("log").to_numpy()
        order_of = np.argsort(grams)
        return pa.table(scored(rows, grams[order_of], log[order_of]), names=[*kept, "perplexity"])

    return dealt.groupBy("_block").cogroup(asked.groupBy("_block")).applyInArrow(meet, schema)


def classify(
    docs: DataFrame, labels: DataFrame, order: int = ORDER, quantile: float = QUANTILE, margin: float = MARGIN,
    least_trusted: int = LEAST_TRUSTED, prior_chars: int = PRIOR_CHARS, broadcast_grams: int = BROADCAST_GRAMS,
) -> DataFrame:
    """One row per row of docs (doc_id, text, lang): doc_id, text_hash, lang, perplexity, score, threshold, accepted.

    Trusted are the documents that labels (doc_id, quality) calls quality 1, all of them; a document that labels names twice is
    trusted if all its labels say so. score is the perplexity with prior_chars characters of the language's mean
    perplexity added. threshold is the quantile of the trusted documents' scores in the language times margin;
    languages with fewer than least_trusted of them, and documents without a language, take mean and threshold of
    all trusted documents. A null or empty text has the perplexity of an end of text and is accepted: nothing speaks against it.
    Without trusted documents all are accepted. Null ids are not trusted; repeated rows count as often as they are there.
    """
    good = labels.groupBy("doc_id").agg(F.min("quality").alias("_q")).filter("_q = 1").select(F.col("doc_id").alias("_id"))
    keyed = docs.select("doc_id", "lang", F.xxhash64("text").alias("text_hash"), F.length("text").alias("chars"), "text")
    # Labels grow with the documents, so they are never broadcast; the text of each document is moved once.
    trusted = keyed.select("doc_id", "text").join(good.hint("merge"), keyed["doc_id"] == good["_id"], "left_semi")
    counts = materialize(gram_counts(trusted, order), "gram-counts")
    scored = materialize(perplexities(keyed, counts, order, broadcast_grams), "perplexities")
    marks = scored.join(good, scored["doc_id"] == good["_id"], "left_semi").filter("chars > 0")

    symbols_read = F.col("chars") + 1
    mean = (F.sum(F.log("perplexity") * symbols_read) / F.sum(symbols_read)).alias("mean")
    overall = marks.agg(mean).first()[0]
    means = materialize(
        marks.groupBy(F.col("lang").alias("_lang")).agg(mean, F.count(F.lit(1)).alias("n"))
        .filter(F.col("_lang").isNotNull() & (F.col("n") >= least_trusted)), "language-means",
    )

    def smoothed(rows: DataFrame) -> DataFrame:
        usual = F.coalesce("mean", F.lit(overall).cast("double"), F.lit(0.0))
        known = F.log("perplexity") * symbols_read
        score = F.exp((known + usual * prior_chars) / (symbols_read + prior_chars))
        return rows.join(means.drop("n"), rows["lang"] == means["_lang"], "left").withColumn("score", score)

    limit = (F.percentile_approx("score", quantile, 10_000) * margin).alias("limit")
    trusted_scores = materialize(smoothed(marks), "trusted-scores")
    limits = trusted_scores.filter(F.col("_lang").isNotNull()).groupBy(F.col("_lang").alias("_of")).agg(limit)
    threshold = F.coalesce("limit", F.lit(trusted_scores.agg(limit).first()[0]).cast("double"))
    empty = F.coalesce(F.col("chars") == 0, F.lit(True))
    accepted = F.coalesce(empty | (F.col("score") <= threshold), F.lit(True))
    return smoothed(scored).join(limits, F.col("_lang") == F.col("_of"), "left").select(
        "doc_id", "text_hash", "lang", "perplexity", "score", threshold.alias("threshold"), accepted.alias("accepted")
    )


def keep_accepted(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Rows of docs that classify accepts; their columns are unchanged."""
    gone = classify(docs, labels, **options).filter("NOT accepted").select("doc_id", "text_hash").distinct()
    return matching_rows(docs, materialize(gone, "rejected"), "left_anti")
