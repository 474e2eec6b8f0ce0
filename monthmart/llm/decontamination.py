"""Benchmark items in documents, found by templates.

Words are put in canonical form: numbers, names and units become typed placeholders, so that an item
whose numbers or names were changed still has the windows of the original. Windows of the items are
hash-joined with windows of the documents, both at every word; an item shorter than a window is one window of its own
length. A window of placeholders only says nothing about an item, so it is met by its own values only. Where a document
meets an item, the share of the item that it covers decides, and its slots are
checked: a value of the item (a number, say) must stand for one value in the document, or in an occurrence, as a document may
hold an item several times with different values.

An occurrence is a group of hits whose place in the document less that in the item differs by less than the item's
length: such differences are cut into steps of that length twice, half a step apart, so that words put in or left out keep a copy
together in one of the two, while copies one after the other fall into different steps.

Everything is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources import materialize
from .lexicon import NAMES, NUMBERS, UNITS
from .text import fold, let, matching_rows, row_keys, word_array

WINDOW = 6
LEAST_SHARE = 0.5
NUMBER_SLOT, NAME_SLOT, UNIT_SLOT = "<num>", "<name>", "<unit>"
# A capital word within a sentence counts as a name; a character of the private area, put before it, carries that over.
NAME_MARK = "\ue000"
# The capital comes first, so that the search looks behind at capitals only.
_MID_SENTENCE_NAME = r"([A-Z])(?<=[a-z,] [A-Z])(?=[a-z])"
_LISTED = (*NUMBERS, *NAMES, *UNITS)


def marked_words(text: Column) -> Column:
    """Words of a text in lower case; a word with a capital within a sentence starts with NAME_MARK."""
    return word_array(fold(F.regexp_replace(text, _MID_SENTENCE_NAME, NAME_MARK + "$1")))


def _listed(word: Column) -> Column:
    return F.when(word.isin(*NUMBERS), NUMBER_SLOT).when(word.isin(*NAMES), NAME_SLOT).otherwise(UNIT_SLOT)


def canonical(word: Column) -> Column:
    """Placeholder of a word, or the word. Lists come before capitals, so that lower-cased copies agree."""
    bare = F.ltrim(word, F.lit(NAME_MARK))
    return (
        F.when(word.isin(*_LISTED), _listed(word))
        .when((word < ":") & word.rlike(r"^[0-9]+(st|nd|rd|th)?$"), NUMBER_SLOT)
        .when(word.startswith(NAME_MARK), F.when(bare.isin(*_LISTED), _listed(bare)).otherwise(NAME_SLOT))
        .otherwise(word)
    )


def _starts(words: Column, width: Column) -> Column:
    none = F.array().cast("array<int>")
    return F.when(F.size(words) >= width, F.sequence(F.lit(0), F.size(words) - width, F.lit(1))).otherwise(none)


def _window_hash(words: Column, form: Column, slots: Column, at: Column, width: Column) -> Column:
    """Hash of the canonical words of a window; of its own words where all are placeholders. slots says which words are."""
    own = F.get(slots, at) & F.forall(F.slice(slots, at + 1, width), lambda s: s)
    plain = F.transform(F.slice(words, at + 1, width), lambda w: F.ltrim(w, F.lit(NAME_MARK)))
    return F.when(own, F.xxhash64(plain, F.lit(True))).otherwise(F.xxhash64(F.slice(form, at + 1, width)))


def _hashes(words: Column, widths: list[Column]) -> Column:
    """Hash of a window of each width at every word."""
    def of(form: Column) -> Column:
        return let(F.zip_with(words, form, lambda w, f: w != f), lambda slots: F.concat(*[F.transform(
            _starts(form, width), lambda at: _window_hash(words, form, slots, at, width)
        ) for width in widths]))

    return let(F.transform(words, canonical), of)


def _slots(frame: DataFrame, widths: list[Column], value: str, place: str) -> DataFrame:
    """All windows of frame (..., words): the hash of each, the words that are placeholders in it, in order, and its place."""

    def windows(words: Column) -> Column:
        hashes = _hashes(words, widths)
        held = F.concat(*[F.transform(_starts(words, width), lambda at: F.filter(
            F.slice(words, at + 1, width), lambda w: canonical(w) != w
        )) for width in widths])
        places = F.concat(*[_starts(words, width) for width in widths])
        return F.arrays_zip(hashes.alias("window_hash"), held.alias(value), places.alias(place))

    keys = [c for c in frame.columns if c != "words"]
    exploded = frame.select(*keys, F.explode(let(F.col("words"), windows)).alias("w"))
    return exploded.select(*keys, "w.window_hash", f"w.{value}", f"w.{place}")


def _scopes() -> Column:
    """Where a hit counts: in the whole document, and in its step of either cut. (scope, step, bucket)"""
    shift, size = F.col("doc_place") - F.col("item_place"), F.col("size")

    def scope(number: int, step: Column, bucket: Column) -> Column:
        return F.struct(F.lit(number).alias("scope"), step.cast("int").alias("step"), bucket.cast("bigint").alias("bucket"))

    return F.array(scope(0, F.lit(0), F.lit(0)), scope(1, size, F.floor(shift / size)),
                   scope(2, size, F.floor((shift + F.floor(size / 2)) / size)))


def leaks(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, least_share: float = LEAST_SHARE
) -> DataFrame:
    """One row per document and item it holds: doc_id, text_hash, item_id, item_windows, found_windows, share,
    slots, consistent.

    docs (doc_id, text), benchmark (item_id, text); other columns are passed over. share is the part of the item's
    windows that the document, or the occurrence with the most of them, has, at least least_share. slots counts the different placeholder values of the item
    in them, consistent says that each stands for one value, as it does in a copy and in a question
    with new parameters; what is not consistent is reported only where its plain words cover the share.
    Null and empty texts hold nothing. An item of fewer than ``window`` words is one window; if all its words are
    placeholders, it is met by its own values only. Repeated rows of docs give one pair, repeated items one pair for each item_id. A null
    doc_id or item_id stands for itself.
    """
    words, width = F.col("words"), F.least(F.size("words"), F.lit(window))
    items = materialize(
        benchmark.select("item_id", marked_words(F.col("text")).alias("words")).filter(F.size("words") > 0).distinct()
        .withColumn("size", F.size("words")), "items",
    )
    # As many as the window has words, at most.
    widths = [F.lit(r["width"]) for r in items.select(width.alias("width")).distinct().orderBy("width").collect()] or [F.lit(window)]
    item_windows = materialize(_slots(items, [width], "item_values", "item_place"), "item-windows")
    anchors = materialize(item_windows.select("window_hash").distinct(), "item-window-hashes")

    keyed = row_keys(docs)
    hashes = let(marked_words(F.col("text")), lambda words: _hashes(words, widths))
    met = keyed.select("doc_id", "text_hash", F.explode(hashes).alias("window_hash")).join(anchors, "window_hash", "left_semi")
    held = materialize(met.select("doc_id", "text_hash").distinct(), "documents-that-meet-items")
    again = matching_rows(docs.select("doc_id", "text"), held, "left_semi", few=True).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_hash"),
        marked_words(F.col("text")).alias("words"),
    )
    doc_windows = _slots(again, widths, "doc_values", "doc_place")

    pairs = ["doc_id", "text_hash", "item_id"]
    within = [*pairs, "scope", "step", "bucket"]
    # A window that an item, a document or an occurrence repeats is taken once with the same values.
    met_items = doc_windows.join(item_windows, "window_hash")
    hits = materialize(
        met_items.select(*pairs, "window_hash", "item_values", "doc_values", F.inline(_scopes())).distinct(), "window-hits",
    )
    found = hits.groupBy(*within).agg(
        F.count_distinct("window_hash").alias("found_windows"),
        F.count_distinct(F.when(F.col("doc_values") == F.col("item_values"), F.col("window_hash"))).alias("plain_windows"),
    )
    values = hits.filter(F.size("item_values") > 0).select(
        *within, F.explode(F.arrays_zip("item_values", "doc_values")).alias("v")
    ).select(*within, F.ltrim("v.item_values", F.lit(NAME_MARK)).alias("i"), F.ltrim("v.doc_values", F.lit(NAME_MARK)).alias("d"))
    slots = values.distinct().groupBy(*within).agg(
        F.count_distinct("i").alias("slots"), (F.count(F.lit(1)) == F.count_distinct("i")).alias("consistent")
    )
    sizes = item_windows.groupBy("item_id").agg(F.count_distinct("window_hash").alias("item_windows"))
    item = F.coalesce(F.col("item_id").cast("string"), F.lit(""))
    found, sizes = (f.withColumn("_item", item).withColumn("_no_item", F.col("item_id").isNull()) for f in (found, sizes))
    slots = slots.select(*[F.col(c).alias(f"_s_{c}") for c in within], "slots", "consistent")
    same = found["doc_id"].eqNullSafe(F.col("_s_doc_id")) & found["item_id"].eqNullSafe(F.col("_s_item_id"))
    for name in ("text_hash", "scope", "step", "bucket"):
        same = same & (found[name] == F.col(f"_s_{name}"))
    joined = found.join(sizes.drop("item_id"), ["_item", "_no_item"]).join(slots, same, "left")
    consistent = F.coalesce("consistent", F.lit(True))
    told = F.when(consistent, F.col("found_windows")).otherwise(F.col("plain_windows")) / F.col("item_windows") >= least_share
    best = joined.filter(told).groupBy(*pairs, "item_windows").agg(F.max(F.struct(
        "found_windows", consistent.alias("consistent"), F.coalesce("slots", F.lit(0)).cast("bigint").alias("slots"))).alias("b"))
    return best.select(
        *pairs, "item_windows", "b.found_windows", (F.col("b.found_windows") / F.col("item_windows")).alias("share"), "b.slots", "b.consistent",
    )


def drop_leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Rows of docs that hold no item; their columns are unchanged."""
    found = leaks(docs, benchmark, **options).select("doc_id", "text_hash").distinct()
    return matching_rows(docs, materialize(found, "leaks"), "left_anti")
