"""Words and plain helpers that several operators share."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: a word is a run of digits, ASCII letters (lower case by then) and characters beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_FIND = re.compile(WORD)
_FOLD = str.maketrans(UPPER, LOWER)
_M64 = (1 << 64) - 1


def fold(text: Column) -> Column:
    """Text in lower case; null gives the empty text.

    Words (WORD) start and end where they do with only A-Z lowered, as letters beyond ASCII stay beyond it, but for the
    Kelvin sign, which becomes k, and the dotted capital I, which becomes i and a mark; both stay in their word.
    """
    return F.lower(F.coalesce(text, F.lit("")))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once however often body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def word_array(folded: Column) -> Column:
    """Words of a folded text. Splitting at what lies between them takes a third of the time of matching them."""
    return F.array_remove(F.split(folded, BETWEEN), "")


def row_keys(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, text) of docs: what names a row in the operators' tables."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")


def matching_rows(docs: DataFrame, keys: DataFrame, how: str, few: bool = False) -> DataFrame:
    """Semi or anti join of docs with keys (doc_id, text_hash), by columns that clash with none of docs.

    Keys that grow with the documents are merged with them at any size. Where they are few, Spark chooses by their size.
    """
    own, other, mine = (f"_{uuid.uuid4().hex}" for _ in range(3))
    hashed = docs.withColumn(mine, F.xxhash64("text"))
    named = keys.select(F.col("doc_id").alias(own), F.col("text_hash").alias(other)).distinct()
    same = hashed["doc_id"].cast("bigint").eqNullSafe(named[own]) & (hashed[mine] == named[other])
    return hashed.join(named if few else named.hint("merge"), same, how).select(*docs.columns)


def words_of(text: str | None) -> list[str]:
    """Words of a text, A-Z in lower case; null has none."""
    return _FIND.findall(text.translate(_FOLD) if text and not text.isascii() else (text or "").lower())


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser over an array of unsigned 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def as_signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """Texts of a batch; null is the empty text."""
    return [t or "" for t in batch.column(name).to_pylist()]
