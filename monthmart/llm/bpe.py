"""Byte-level BPE: the ids of texts and the bytes of ids, exactly as merging by rank gives them, in time linear in the text.

A text is cut by the vocabulary's pattern and each piece is encoded by itself. The bytes of a piece, as Latin-1 characters,
run through an Aho-Corasick automaton of all tokens. From the left, the longest token that starts at a place is tried first,
then its prefixes that are tokens. A token may follow another only if the two are compatible: if merging their joined bytes by
rank ends with the same two. A sequence in which all neighbours are compatible is what merging the whole piece gives, as
the first merge across one of its borders would also happen if the two tokens at that border stood alone. Each place has one such sequence
at most that leads to it, so a place from which nothing goes on is closed for good, and the search is linear.
Answers are remembered per pair of tokens and per short piece, both within stated bounds.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Callable, Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# What a task remembers: entries at most, and the characters of a piece that is worth remembering. What is beyond is computed anew.
PIECES, PAIRS, SHORT = 400_000, 400_000, 32
LONG_TEXT = 1_000_000
IDS_PER_BATCH = 1_000_000
DECODED_AT_ONCE = 256


def read_ranks(path: str) -> bytes:
    """The vocabulary file: a line for each token with its bytes in base 64 and its rank. Read once, on the driver."""
    with open(path, "rb") as file:
        return file.read()


def parse_ranks(file: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file.splitlines()) if token}


class Encoder:
    """Ids of texts by the ranks of a vocabulary that holds each single byte."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import ahocorasick
        import regex

        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("the vocabulary must hold each single byte")
        self.ranks = ranks
        self.token_of = {rank: token for token, rank in ranks.items()}
        self.find = regex.compile(pattern)
        self.automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.automaton.add_word(token.decode("latin-1"), rank)
        self.automaton.make_automaton()
        self.sizes = {rank: len(token) for token, rank in ranks.items()}
        self.histories: dict[int, list[tuple[int, bytes, bytes]] | None] = {}
        self.shorter = Remembered(self.longest_prefix)
        self.compatible = Remembered(self.stay_apart, PAIRS)
        self.pieces = Remembered(self.encode_piece, PIECES, lambda piece: len(piece) <= SHORT)

    def history(self, token: int) -> list[tuple[int, bytes, bytes]] | None:
        """(rank, first part, last part) after each merge of the token's bytes, from the single bytes on; None if they do not end as it."""
        if token not in self.histories:
            data = self.token_of[token]
            parts = [data[i : i + 1] for i in range(len(data))]
            steps = [(-1, parts[0], parts[-1])]
            while len(parts) > 1:
                found = [(self.ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.ranks]
                if not found:
                    break
                rank, i = min(found)
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
                steps.append((rank, parts[0], parts[-1]))
            self.histories[token] = steps if len(parts) == 1 else None
        return self.histories[token]

    def stay_apart(self, pair: tuple[int, int]) -> bool:
        """Whether merging the joined bytes of two tokens ends with the same two.

        Both sides merge on by rank, the left one first on ties; they stay apart if the border never has the least rank.
        """
        left, right = pair
        a, b = self.history(left), self.history(right)
        if a is None or b is None:
            return False
        i = j = 0
        while True:
            border = self.ranks.get(a[i][2] + b[j][1])
            in_left = a[i + 1][0] if i + 1 < len(a) else None
            in_right = b[j + 1][0] if j + 1 < len(b) else None
            if in_left is None and in_right is None:
                return border is None
            if in_right is None or (in_left is not None and in_left <= in_right):
                if border is not None and border < in_left:
                    return False
                i += 1
            else:
                if border is not None and border <= in_right:
                    return False
                j += 1

    def longest_prefix(self, token: int) -> int | None:
        """The longest token that is a proper prefix of this one."""
        data = self.token_of[token]
        cuts = (data[:n] for n in range(len(data) - 1, 0, -1))
        return next((self.ranks[c] for c in cuts if c in self.ranks), None)

    def encode_piece(self, piece: str) -> tuple[int, ...]:
        data = piece.encode()
        if data in self.ranks:  # a piece that is a token stays whole, whatever its merges
            return (self.ranks[data],)
        text, sizes, shorter, compatible = data.decode("latin-1"), self.sizes, self.shorter, self.compatible
        ids: list[int] = []
        closed: set[int] = set()
        # Goes on by itself from the end of a longest token; after a shorter one it starts anew.
        found = self.automaton.iter_long(text)
        at, token, goes_on = 0, next(found)[1], True
        while True:
            if token is None:  # no token fits here
                closed.add(at)
                token = ids.pop()
                at -= sizes[token]
            else:
                end = at + sizes[token]
                if end not in closed and (compatible[ids[-1], token] if ids else self.history(token)):
                    ids.append(token)
                    if end == len(text):
                        return tuple(ids)
                    at = end
                    if not goes_on:
                        found, goes_on = self.automaton.iter_long(text, at), True
                    token = next(found)[1]
                    continue
            token, goes_on = shorter[token], False

    def encode(self, text: str) -> array:
        """Ids of a text. A long text is cut as it is read, so its pieces are never held together."""
        found = self.find.findall(text) if len(text) < LONG_TEXT else (m[0] for m in self.find.finditer(text))
        return array("i", chain.from_iterable(map(self.pieces.__getitem__, found)))


class Remembered(dict):
    """Answers of a function; those worth it are kept until there are ``most`` of them, then all are forgotten."""

    def __init__(self, answer: Callable, most: int | None = None, worth: Callable[..., bool] = lambda question: True):
        super().__init__()
        self.answer, self.most, self.worth = answer, most, worth

    def __missing__(self, question):
        answer = self.answer(question)
        if self.worth(question):
            if self.most and len(self) >= self.most:
                self.clear()
            self[question] = answer
        return answer


def _lists(values: array, offsets: array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()))


def encode(docs: DataFrame, ranks: bytes, pattern: str) -> DataFrame:
    """(doc_id, ids): the ids of every whole text of docs (doc_id, text), without special tokens; ranks is the vocabulary file.

    A null or empty text has no ids. Rows with equal doc_id are encoded each; no rows give no rows; other columns play no part. What marks a special
    token is ordinary text.
    """
    # A vocabulary file is a megabyte or so, whatever the documents are. The encoder made of it stays with the Python worker.
    shared = docs.sparkSession.sparkContext.broadcast({"file": ranks})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        if held.get("pattern") != pattern:
            held.update(pattern=pattern, encoder=Encoder(parse_ranks(held["file"]), pattern))
        encoder = held["encoder"]
        for batch in batches:
            keys, texts, first = batch.column("doc_id"), batch.column("text"), 0
            values, offsets = array("i"), array("i", [0])
            for row in range(batch.num_rows):
                values.extend(encoder.encode(texts[row].as_py() or ""))
                offsets.append(len(values))
                if len(values) >= IDS_PER_BATCH or row == batch.num_rows - 1:
                    yield pa.RecordBatch.from_arrays([keys.slice(first, row + 1 - first), _lists(values, offsets)], ["doc_id", "ids"])
                    values, offsets, first = array("i"), array("i", [0]), row + 1

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, "doc_id bigint, ids array<int>")


def decode(encoded: DataFrame, ranks: bytes) -> DataFrame:
    """Adds decoded, the joined bytes of the tokens of ids; bytes, as ids need not spell whole characters.

    Null ids, and ids of which one is null or not in the vocabulary, give null; no ids give no bytes.
    """
    shared = encoded.sparkSession.sparkContext.broadcast({"file": ranks})
    names = encoded.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        if "token_of" not in held:
            held["token_of"] = {rank: token for token, rank in parse_ranks(held["file"]).items()}
        token_of = held["token_of"].get
        for whole in batches:
            for start in range(0, whole.num_rows, DECODED_AT_ONCE):
                batch = whole.slice(start, DECODED_AT_ONCE)
                ids, decoded, at = batch.column("ids"), [], 0
                flat = ids.flatten()
                tokens = list(map(token_of, flat.to_pylist() if flat.null_count else flat.to_numpy().tolist()))
                for size in ids.value_lengths().to_pylist():
                    try:
                        decoded.append(None if size is None else b"".join(tokens[at : at + size]))
                    except TypeError:  # one of them is no token
                        decoded.append(None)
                    at += size or 0
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(decoded, pa.binary())], [*names, "decoded"])

    fields = ", ".join(f"`{n}` {t}" for n, t in encoded.dtypes)
    return encoded.mapInArrow(run, f"{fields}, decoded binary")
