"""Best-fit packing of token pieces into sequences of a fixed length, by bin completion.

What a packing needs to know of a piece is its length, and there are at most ``capacity``
different lengths. So tasks cut documents into pieces and count lengths; a plan for the
counted lengths is found by bin completion; and tasks deal the pieces of each length to
the places that the plan has for it. The plan has a size bound (a row for each length of each
pattern), however many pieces there are.

Bin completion: the largest piece left opens a sequence, and the search branches over the undominated
fillings of its rest, those of least waste first. A filling is dominated if a piece that is left
could take the place of some of its pieces that together are no longer, or of nothing. Best-fit decreasing gives the first
incumbent and completes partial packings to further ones. A branch ends where its sequences and the L2 bound of what is
left reach the incumbent, or where a filling wastes more than a better packing may. Fillings are tried in the
order of limited discrepancy: first the best ones everywhere, each as often as the counts allow, then packings
that depart from that once, twice and so on. So a plan is never worse than best fit.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources import materialize
from .text import texts

CAPACITY = 2048
# Work of the search for a packing, in lengths looked at; a branch counts as STEP of them.
WORK, STEP = 2_000_000, 200
ROWS_PER_SALT = 50_000

PIECE_SCHEMA = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
_ARROW_PIECES = pa.schema([
    ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
])


def bpe_encoder(path: str) -> Callable[[list[str]], list[list[int]]]:
    """Encoder for the vocabulary file of the tokenizers library.

    Its ranks are handed to tiktoken, which gives the same ids about four times as fast; a text that
    spells a special token goes to the library itself. Byte-level BPE with the usual split only.
    """
    import json

    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as file:
        model = json.load(file)
    special = {t["content"] for t in model.get("added_tokens", [])}
    # The library writes the 256 bytes as printable characters: printable ones stand for themselves.
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    odd = [b for b in range(256) if b not in set(plain)]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(odd)}
    ranks = {bytes(byte_of[c] for c in token): i for token, i in model["model"]["vocab"].items() if token not in special}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    whole = Tokenizer.from_file(path)

    def encode(batch: list[str]) -> list[list[int]]:
        return [
            whole.encode(t, add_special_tokens=False).ids if any(s in t for s in special) else fast.encode_ordinary(t)
            for t in batch
        ]

    return encode


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of n ids: full ones, but for the first."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """Pieces of all documents (PIECE_SCHEMA). A null or empty text has the end id alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = bpe_encoder(tokenizer_path)
        for batch in batches:
            rows = []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encode(texts(batch))):
                data = np.array([*ids, end_id], dtype="<u4")
                for k, (start, length) in enumerate(cut(len(data), capacity)):
                    rows.append((doc_id, k, start, length, zlib.crc32(data[start : start + length].tobytes())))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), f.type) for c, f in zip(zip(*rows) if rows else [()] * 5, _ARROW_PIECES)], schema=_ARROW_PIECES
            )

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, PIECE_SCHEMA)


Pattern = tuple[tuple[int, int], ...]  # (length, pieces of it), longest first


def best_fit(left: dict[int, int], capacity: int = CAPACITY) -> list[tuple[Pattern, int]]:
    """Best-fit decreasing over counted lengths: (pattern, sequences). Each length splits one group of like sequences at most."""
    groups: dict[int, list[tuple[Pattern, int]]] = {}
    rooms: list[int] = []

    def add(room: int, pattern: Pattern, times: int) -> None:
        if times:
            if room not in groups:
                insort(rooms, room)
            groups.setdefault(room, []).append((pattern, times))

    for size in sorted((s for s, n in left.items() if n), reverse=True):
        n = left[size]
        while n:
            i = bisect_left(rooms, size)
            if i == len(rooms):
                room, pattern, times = capacity, (), n
            else:
                room = rooms[i]
                pattern, times = groups[room].pop()
                if not groups[room]:
                    del groups[room], rooms[i]
            # The tightest sequence stays the tightest while it holds another piece, so it is filled before the next.
            each = room // size
            full = min(times, n // each)
            add(room - each * size, (*pattern, (size, each)), full)
            n -= full * each
            if full < times:
                if n:
                    add(room - n * size, (*pattern, (size, n)), 1)
                    full, n = full + 1, 0
                if pattern:
                    add(room, pattern, times - full)
    return [group for own in groups.values() for group in own]


def l2_bound(left: np.ndarray, capacity: int = CAPACITY) -> int:
    """Sequences that any packing needs, by the L2 bound; left counts the pieces of each length from 0 to capacity.

    For each k up to half the capacity: pieces above the half need a sequence each, those above capacity - k
    let no piece of k or more join them, and what pieces from k to the half need beyond the room of the others comes on top.
    """
    half = capacity // 2
    number, total = np.cumsum(left), np.cumsum(left * np.arange(capacity + 1))
    k = np.arange(half + 1)
    alone = number[capacity] - number[half]
    open_number, open_total = number[capacity - k] - number[half], total[capacity - k] - total[half]
    small = total[half] - np.where(k > 0, total[k - 1], 0)
    return int(alone + max(0, np.max(-((open_number * capacity - open_total - small) // capacity))))


def _dominated(filling: Pattern, waste: int, available: int) -> bool:
    """Whether an available length (a bit each) could replace pieces of the filling that are together no longer, or be added."""
    if (available >> 1) & ((1 << waste) - 1):
        return True
    none, single, several = 1, 0, 0
    for size, n in filling:
        if (available >> (size + 1)) & ((1 << waste) - 1):
            return True
        for _ in range(n):
            several |= (several | single) << size
            single |= none << size
    width = 1
    while width <= waste:
        step = min(width, waste + 1 - width)
        several |= several << step
        width += step
    return bool(several & available)


def fillings(room: int, left: dict[int, int], work: list[int] | None = None) -> Iterator[tuple[int, Pattern]]:
    """(waste, filling) of the undominated fillings of room from the lengths with so many of each left, least waste first.

    Sums within reach are bits of whole numbers, so the search meets no dead end. work[0] is lowered by the lengths and fillings looked at.
    """
    lengths = sorted(s for s, n in left.items() if n and s <= room)
    mask = (1 << (room + 1)) - 1
    reach = [1]
    for size in lengths:
        sums, n, part = reach[-1], min(left[size], room // size), 1
        while n:
            part = min(part, n)
            sums |= (sums << (size * part)) & mask
            n, part = n - part, part * 2
        reach.append(sums)
    if work is not None:
        work[0] -= len(lengths)

    def parts(target: int, top: int) -> Iterator[Pattern]:
        if target == 0:
            yield ()
            return
        for i in range(top - 1, -1, -1):
            if not reach[i + 1] >> target & 1:
                return
            size = lengths[i]
            for n in range(min(left[size], target // size), 0, -1):
                if reach[i] >> (target - n * size) & 1:
                    for rest in parts(target - n * size, i):
                        yield ((size, n), *rest)

    every = sum(1 << size for size in lengths)
    for waste in range(room + 1):
        if reach[-1] >> (room - waste) & 1:
            for filling in parts(room - waste, len(lengths)):
                if work is not None:
                    work[0] -= 10 + sum(n for _, n in filling)
                    if work[0] < 0:
                        return
                used_up = sum(1 << size for size, n in filling if n == left[size])
                if not _dominated(filling, waste, every & ~used_up):
                    yield waste, filling


def plan(counts: dict[int, int], capacity: int = CAPACITY, work: int = WORK) -> list[tuple[dict[int, int], int]]:
    """(pieces of each length in a sequence, number of such sequences), for all counted lengths; as few as were found.

    The search ends when it is exhausted, when the incumbent meets the L2 bound of all pieces (both prove it the best), or when
    so much work is done: lengths looked at, the pieces of fillings
    looked at and ten for each of them, and STEP for each branch. The first descent is always finished. What
    is returned then is the incumbent, no worse than best-fit decreasing.
    """
    left = {size: n for size, n in sorted(counts.items()) if n > 0}
    if any(not 0 < size <= capacity for size in left):
        raise ValueError("lengths must lie between 1 and the capacity")
    number = np.zeros(capacity + 1, np.int64)
    for size, n in left.items():
        number[size] = n
    area = np.arange(capacity + 1)
    bound = l2_bound(number, capacity)
    best = best_fit(left, capacity)
    fewest = sum(times for _, times in best)
    budget = [work]

    def apply(pattern: Pattern, times: int) -> None:
        for size, n in pattern:
            left[size] -= n * times
            number[size] -= n * times

    def options(used: int, allowed: int, first: bool) -> Iterator[tuple[int, Pattern, int]]:
        """(discrepancy, pattern, sequences) for the largest piece left; a filling is used as often as it can be, then once.

        The one that follows those within the allowed discrepancy has no pattern, as it is not looked for.
        """
        largest = int(np.flatnonzero(number)[-1])
        left[largest] -= 1
        offered = fillings(capacity - largest, left, None if first else budget)
        total, cost = int((number * area).sum()), 0
        while True:
            waste, filling = next(offered, (None, ()))
            left[largest] += 1
            # A packing better than the incumbent has this much room beside its pieces.
            if waste is None or waste > (fewest - 1 - used) * capacity - total:
                return
            merged = dict([(largest, 1)])
            for size, n in filling:
                merged[size] = merged.get(size, 0) + n
            pattern = tuple(merged.items())
            most = min(left[size] // n for size, n in pattern)
            yield cost, pattern, most
            if most > 1:
                yield cost + 1, pattern, 1
            cost += 1
            if cost > allowed:
                yield cost, (), 0
                return
            left[largest] -= 1

    def descend(allowance: int) -> bool:
        """Whether packings of more discrepancy than allowed were left out."""
        nonlocal best, fewest
        cut, path, used = False, [], 0
        stack = [(options(0, allowance, not allowance), allowance)]
        while stack:
            offered, allowed = stack[-1]
            cost, pattern, times = next(offered, (None, (), 0))
            if cost is None or cost > allowed:
                cut |= cost is not None
                stack.pop()
                if path:
                    apply(path[-1][0], -path[-1][1])
                    used -= path.pop()[1]
                continue
            apply(pattern, times)
            path.append((pattern, times))
            used += times
            if allowance:
                budget[0] -= STEP
            lower = used + l2_bound(number, capacity)
            if lower < fewest and (len(path) % 16 == 1 or np.count_nonzero(number) <= 64):
                rest = best_fit(left, capacity)
                if used + sum(n for _, n in rest) < fewest:
                    best, fewest = [*path, *rest], used + sum(n for _, n in rest)
            if budget[0] < 0 or fewest <= bound:
                return False
            if lower < fewest and number.any():
                stack.append((options(used, allowed - cost, not allowance), allowed - cost))
            else:
                apply(pattern, -times)
                path.pop()
                used -= times
        return cut

    start, wave = (dict(left), number.copy()), 0
    while fewest > bound and budget[0] >= 0 and descend(wave):
        wave += 1
        left.update(start[0])
        number[:] = start[1]
    return [(dict(pattern), times) for pattern, times in best]


def _places(patterns: list[tuple[dict[int, int], int]]) -> dict[str, np.ndarray]:
    """For each length, runs of ranks with their sequences and offsets, sorted by length and first rank."""
    runs, taken, sequence = [], Counter(), 0
    for pattern, times in patterns:
        offset = 0
        for size in sorted(pattern, reverse=True):
            runs.append((size, taken[size], sequence, pattern[size], offset))
            taken[size] += pattern[size] * times
            offset += size * pattern[size]
        sequence += times
    names = ("length", "rank", "sequence", "each", "offset")
    return dict(zip(names, np.array(sorted(runs), dtype=np.int64).reshape(-1, 5).T))


def ranked(cut_pieces: DataFrame, lengths: DataFrame) -> DataFrame:
    """Adds rank, 0 to n-1 among the pieces of one length.

    A length that many pieces share is ranked in parts of about ROWS_PER_SALT; the parts start where those before them end.
    lengths (length, n) has a row for each length, so it is small by its kind.
    """
    order = ["doc_id", "piece", "start", "ids_crc32"]
    parts = F.greatest(F.lit(1), (F.col("n") / ROWS_PER_SALT).cast("int"))
    salted = cut_pieces.join(F.broadcast(lengths), "length").withColumn("_salt", F.pmod(F.xxhash64(*order), parts))
    inside = Window.partitionBy("length", "_salt").orderBy(*order)
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = salted.groupBy("length", "_salt").count().select(
        "length", "_salt", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start")
    )
    numbered = salted.withColumn("_inside", F.row_number().over(inside) - 1)
    return numbered.join(starts, ["length", "_salt"]).select(
        *cut_pieces.columns, (F.col("_start") + F.col("_inside")).alias("rank")
    )


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, work: int = WORK) -> DataFrame:
    """One row per piece of docs (doc_id, text): PIECE_SCHEMA plus sequence_id and offset, which is gapless from 0.

    A document longer than capacity is cut into full pieces, the first of which may be shorter; all others stay whole.
    Null and empty texts have one id and are packed; rows with equal doc_id are packed each; no rows give no rows.
    work bounds the search for fewer sequences (see plan); all pieces are packed whatever it is.
    """
    cut_pieces = materialize(pieces(docs, tokenizer_path, capacity), "pieces")
    lengths = materialize(cut_pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")), "piece-lengths")
    # At most `capacity` rows.
    places = _places(plan({r["length"]: r["n"] for r in lengths.collect()}, capacity, work))
    # Ranks of one length stay below 2 ** 50.
    starts = (places["length"] << 50) + places["rank"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            run = np.searchsorted(starts, (size.astype(np.int64) << 50) + rank, side="right") - 1
            inside = rank - places["rank"][run]
            sequence = places["sequence"][run] + inside // places["each"][run]
            offset = places["offset"][run] + inside % places["each"][run] * size
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in _ARROW_PIECES.names), pa.array(sequence), pa.array(offset)],
                [*_ARROW_PIECES.names, "sequence_id", "offset"],
            )

    return ranked(cut_pieces, lengths).mapInArrow(place, f"{PIECE_SCHEMA}, sequence_id bigint, offset bigint")
