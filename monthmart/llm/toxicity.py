"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

Features are rates and counts of a text alone: densities of a fixed and of a learned lexicon, lexicon words near a
second person, capitals, punctuation and obfuscated spellings. The learned lexicon takes the words that toxic training rows
use far more often than others. Lexicon, trees and calibration are fitted on different training rows, so that none of
them sees scores that are too good; each takes a sample of at most ``FIT_ROWS`` rows. Features and scores cover all rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources import materialize
from .text import matching_rows, row_keys, texts, words_of

FIT_ROWS = 20_000
LEXICON_SIZE, LEAST_SUPPORT, LEAST_LOG_ODDS = 2_000, 3, 2.0
LEAST_ROWS = 8  # of either label, to fit trees at all
TREES, DEPTH = 30, 4
NEAR = 4  # words between a lexicon word and a second person

# Plain insults in four languages.
INSULTS = frozenset((
    "idiot idiots moron morons stupid scum trash loser losers clown pathetic worthless disgusting dumb dumbass fool imbecile "
    "cretin jerk bastard bitch asshole shit crap freak creep pig ugly filthy vermin garbage retard coward liar "
    "dumm dumme dummkopf trottel vollidiot arschloch abschaum versager widerlich erbaermlich erbärmlich nutzlos schwein depp "
    "stupide imbécile crétin connard connasse salaud ordure minable pathétique inutile dégoûtant abruti débile "
    "idiota estúpido estúpida imbécil tonto tonta basura escoria perdedor payaso patético asqueroso inútil cabrón"
).split())
# Words for the second person in four languages.
SECOND_PERSON = frozenset((
    "you your yours yourself yourselves u ur du dich dir dein deine deinen deiner ihr euch euer eure "
    "tu toi ton tes vous votre vos tú ti tus usted ustedes vosotros vuestro vuestra"
).split())
# Signs that stand for letters.
LOOKALIKE = str.maketrans("013457@$!", "oieastasi")
_ODD = re.compile(r"[A-Za-z0-9@$*][A-Za-z0-9@$!*._\-]*[A-Za-z0-9@$*]")
_ODD_SIGNS = re.compile(r"[0-9@$!*._\-]")
_SHOUT = re.compile(r"[A-Z]{3,}")

FEATURES = (
    "log_words", "insult_rate", "log_insults", "learned_rate", "log_learned", "learned_weight", "strongest",
    "near_person", "person_rate", "capital_rate", "shout_rate", "exclaim_rate", "punctuation_rate", "digit_rate",
    "obfuscated_rate", "odd_sign_rate",
)


def _is_hidden(found: str, learned: dict[str, float]) -> bool:
    """True for a lexicon word in an obfuscated spelling: signs for letters, signs between letters, * for any letter."""
    lower = found.lower()
    if found.isalpha() or lower.strip("*") in INSULTS:
        return False
    bare = re.sub(r"[._\-]", "", lower.translate(LOOKALIKE))
    if "*" not in bare:
        return bare in INSULTS or bare in learned
    if len(bare) - bare.count("*") < 2 or not any(c.isalpha() for c in lower):
        return False
    like = re.compile(re.escape(bare).replace(r"\*", "."))
    return any(len(w) == len(bare) and like.fullmatch(w) for known in (INSULTS, learned) for w in known)


def features(text: str, learned: dict[str, float]) -> list[float]:
    """FEATURES of a text; all 0 for one without words or characters."""
    words = words_of(text.lower())
    n = max(1, len(words))
    size = np.bincount(np.frombuffer(text.encode("utf-8", "replace"), np.uint8), minlength=256)
    length, capitals, letters = max(1, int(size.sum())), int(size[65:91].sum()), int(size[97:123].sum())
    exclaims, digits, odd = int(size[33] + size[63]), int(size[48:58].sum()), int(size[36] + size[42] + size[64])
    punctuation = int(size[33:48].sum() + size[58:65].sum() + size[91:97].sum() + size[123:127].sum())
    insults = sum(w in INSULTS for w in words)
    weights = [learned[w] for w in words if w in learned]
    near = persons = 0
    if insults or weights:
        places = [i for i, w in enumerate(words) if w in SECOND_PERSON]
        persons = len(places)
        if places:
            at = np.array(places)
            hits = np.array([i for i, w in enumerate(words) if w in INSULTS or w in learned])
            k = np.searchsorted(at, hits)
            before, after = at[np.maximum(k - 1, 0)], at[np.minimum(k, len(at) - 1)]
            near = int((np.minimum(abs(hits - before), abs(after - hits)) <= NEAR).sum())
    hidden = 0
    if digits or odd or _ODD_SIGNS.search(text):
        hidden = sum(_is_hidden(found, learned) for found in _ODD.findall(text))
    shouts = sum(map(len, _SHOUT.findall(text))) if capitals > 2 else 0
    return [
        math.log1p(len(words)), insults / n, math.log1p(insults), len(weights) / n, math.log1p(len(weights)),
        sum(weights) / n, max(weights, default=0.0), near / n, persons / n, capitals / max(1, capitals + letters),
        shouts / length, exclaims / length, punctuation / length, digits / length, hidden / n, odd / length,
    ]


def _with_features(docs: DataFrame, learned: dict[str, float]) -> DataFrame:
    """docs (doc_id, text_hash, text) with features instead of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features(t, learned) for t in texts(batch)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(rows, pa.list_(pa.float64()))],
                ["doc_id", "text_hash", "features"],
            )

    return docs.mapInArrow(run, "doc_id bigint, text_hash bigint, features array<double>")


def is_held_out(doc_id: Column) -> Column:
    """True for the fifth of the ids that no label is learned from; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _sample(labels: DataFrame, low: int, high: int) -> DataFrame:
    """(_id, toxic) of training labels whose hash falls in a tenth from low up to high: FIT_ROWS of them at most.

    Hashes decide, so that the sample does not depend on the order of rows. Contradicting labels of an id count as toxic.
    """
    part = F.pmod(F.xxhash64("doc_id"), F.lit(10))
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~is_held_out(F.col("doc_id")))
    return (
        usable.filter((part >= low) & (part < high)).groupBy(F.col("doc_id").cast("bigint").alias("_id"))
        .agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("_id", F.lit(1)), "_id").limit(FIT_ROWS)
    )


def learn_lexicon(rows: DataFrame) -> dict[str, float]:
    """Log odds of the words that toxic rows (text, toxic) hold most clearly more often than the others, LEXICON_SIZE at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            word, label = [], []
            for t, toxic in zip(texts(batch), batch.column("toxic").to_pylist()):
                own = set(words_of(t.lower()))
                word.extend(own)
                label.extend([toxic] * len(own))
            yield pa.RecordBatch.from_arrays([pa.array(word, pa.string()), pa.array(label, pa.int32())], ["word", "toxic"])

    rows = rows.select("text", F.col("toxic").cast("int").alias("toxic"))
    sizes = rows.agg(F.sum("toxic"), F.count(F.lit(1))).first()
    toxic, clean = sizes[0] or 0, sizes[1] - (sizes[0] or 0)
    if not toxic or not clean:
        return {}
    counts = rows.mapInArrow(run, "word string, toxic int").groupBy("word").agg(
        F.sum("toxic").alias("t"), (F.count(F.lit(1)) - F.sum("toxic")).alias("c")
    )
    odds = F.log(((F.col("t") + 0.5) / (toxic + 1)) / ((F.col("c") + 0.5) / (clean + 1)))
    best = counts.filter(F.col("t") >= LEAST_SUPPORT).withColumn("odds", odds).filter(F.col("odds") >= LEAST_LOG_ODDS)
    return {r["word"]: r["odds"] for r in best.orderBy(F.desc("odds"), F.desc("t"), "word").limit(LEXICON_SIZE).collect()}


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, text_hash, held_out, score (0 to 1), predicted.

    labels (doc_id, toxic) are learned from outside the held-out ids only, and nothing but the text makes a score. A null
    or empty text has the features of no words and is scored like others. Too few labels of either kind
    to fit trees leave the fixed lexicon: the score is h / (h + 1) for h insults in a hundred words. Rows are scored each, repeated or not.
    """
    keyed = row_keys(docs)
    # Samples have FIT_ROWS rows at most, so they are broadcast whatever the size of docs.
    parts = [F.broadcast(_sample(labels, *tenths)) for tenths in ((0, 5), (5, 8), (8, 10))]
    learned = learn_lexicon(keyed.join(parts[0], keyed["doc_id"] == parts[0]["_id"]).select("text", "toxic"))
    seen = materialize(_with_features(keyed, learned), "toxicity-features")
    train, calibrate = (
        materialize(seen.join(p, seen["doc_id"] == p["_id"]).select(
            "toxic", array_to_vector("features").alias("vector")
        ), "toxicity-sample").withColumn("label", F.col("toxic").cast("double"))
        for p in parts[1:]
    )
    sizes = [{r["label"]: r["count"] for r in part.groupBy("label").count().collect()} for part in (train, calibrate)]
    vectors = seen.withColumn("vector", array_to_vector("features"))
    held = is_held_out(F.col("doc_id")).alias("held_out")
    if min(s.get(k, 0) for s in sizes for k in (0.0, 1.0)) < LEAST_ROWS:
        hits = F.col("features")[FEATURES.index("insult_rate")] * 100
        final = seen.withColumn("score", hits / (hits + 1))
    else:
        trees = GBTClassifier(featuresCol="vector", labelCol="label", maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, seed=7)
        model = trees.fit(train)

        def raw(frame: DataFrame) -> DataFrame:
            return model.transform(frame).withColumn("raw", vector_to_array("probability")[1])

        isotonic = IsotonicRegression(featuresCol="raw", labelCol="label", predictionCol="calibrated")
        final = isotonic.fit(raw(calibrate).select("raw", "label")).transform(
            raw(vectors).select("doc_id", "text_hash", "raw")
        ).withColumn("score", F.greatest(F.lit(0.0), F.least(F.lit(1.0), "calibrated")))
    return final.select("doc_id", "text_hash", held, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of docs that are not predicted toxic; their columns are unchanged."""
    gone = score(docs, labels).filter("predicted = 1").select("doc_id", "text_hash").distinct()
    return matching_rows(docs, materialize(gone, "toxic"), "left_anti")
