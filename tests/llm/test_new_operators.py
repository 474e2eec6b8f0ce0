"""Vector codes, byte-level BPE and spelling variants against plain versions, with nulls, ties, repeats and clashing names."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from monthmart.llm import bpe, codes, queries, spelling

# --- vector codes -----------------------------------------------------------------------

VECTORS = "vec_id bigint, embedding array<double>, label int, code string, error string, part int"


def vector_table(spark, rows):
    return spark.createDataFrame([(i, v, l, "c", "e", 0) for i, v, l in rows], VECTORS)


def plain_codes(rows, entries=256, rounds=4, parts=4):
    """The contract, a part at a time in whole numbers: {row: (code, error)}, codebooks"""
    kept = [(i, [math.floor(1024 * x) for x in v], l) for i, v, l in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    cut = [np.array([v for _, v, _ in kept]).reshape(len(kept), parts, -1)[:, p] for p in range(parts)]
    order = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, kept[k][1]))[:entries]
    books, found = [], []
    for points in cut:
        book = points[order].copy()
        for turn in range(rounds + 1):
            distance = ((points[:, None].astype(np.int64) - book[None]) ** 2).sum(axis=2)
            chosen = distance.argmin(axis=1)
            if turn < rounds:
                book = np.array([points[chosen == e].sum(axis=0) // max(1, (chosen == e).sum()) if (chosen == e).any() else book[e] for e in range(len(book))])
        books.append(book)
        found.append((chosen, distance.min(axis=1)))
    codes_ = ["".join(f"{c[k]:02x}" for c, _ in found) for k in range(len(kept))]
    errors = [int(sum(d[k] for _, d in found)) for k in range(len(kept))]
    by_label = Counter()
    for (_, _, label), error in zip(kept, errors):
        by_label[label] += error
    digest = hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()
    return sorted(((i, c, e, by_label[l], digest) for (i, _, l), c, e in zip(kept, codes_, errors)), key=str)


def clustered(seed, n, dim=16, spread=0.2):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(12, dim))
    return [[float(x) for x in middles[k % 12] + rng.normal(size=dim) * spread] for k in range(n)]


@pytest.mark.parametrize("n, spread", [(5, 0.2), (300, 0.0), (700, 0.05), (900, 1.0)])
def test_vector_codes_equal_a_plain_version(spark, n, spread):
    rows = [(k * 7 % n, v, k % 3 if k % 5 else None) for k, v in enumerate(clustered(n, n, spread=spread))]
    rows += [(3, rows[0][1], 9)] * 40 + [(None, rows[-1][1], 1), (n, None, 1), (n, [], 1), (n, [math.nan] * 16, 1), (n, [1.0, None] * 8, 1),
                                         (n, [math.inf] + [0.0] * 15, 1), (n + 1, [0.0] * 16, 2), (n + 2, [-0.0] * 16, 2)]
    found = sorted((tuple(r) for r in queries.vector_codes(vector_table(spark, rows).repartition(3)).collect()), key=str)
    assert found == plain_codes(rows)


def test_trees_own_balls_and_keep_sums():
    points = np.floor(np.array(clustered(1, 3000, 8, 0.02)) * 1024).astype(np.int64)
    tree = codes.build_tree(points)
    assert (np.sort(tree["order"]) == np.arange(3000)).all() and (tree["sums"][-1] == points.sum(axis=0)).all()
    inner = np.flatnonzero(tree["left"] >= 0)
    assert (tree["sums"][inner] == tree["sums"][tree["left"][inner]] + tree["sums"][tree["right"][inner]]).all()
    entries = points[:12]
    owned, places, _ = codes.owners(tree, entries)
    # Well apart clusters are owned as wholes: few points are looked at.
    assert sum(int(tree["count"][b]) for b, _ in owned) + len(places) == 3000 and len(places) < 300
    distance = ((points[:, None] - entries[None]) ** 2).sum(axis=2)
    code, error = codes.point_codes(tree, entries)
    assert (code == distance.argmin(axis=1)).all() and (error == distance.min(axis=1)).all()
    counts, sums = codes.ball_sums(tree, entries)
    assert (counts == np.bincount(code, minlength=12)).all() and (sums == [points[code == e].sum(axis=0) for e in range(12)]).all()


def test_large_components_stay_exact_and_too_large_ones_are_refused(spark):
    points = (np.random.default_rng(0).integers(-(1 << 26), 1 << 26, (200, 4)) // 3)
    entries = np.concatenate([points[:20], points[:20] + 1])
    code, error = codes.point_codes(codes.build_tree(points), entries)
    distance = ((points[:, None] - entries[None]) ** 2).sum(axis=2)
    assert (code == distance.argmin(axis=1)).all() and (error == distance.min(axis=1)).all()
    with pytest.raises(Exception, match="must lie below"):
        queries.vector_codes(vector_table(spark, [(1, [1e9] * 4, 0)])).collect()


def test_no_usable_vector_gives_no_codes(spark):
    rows = [(1, None, 1), (2, [1.0, None, 2.0, 3.0], 1), (3, [], 1)]
    found = queries.vector_codes(vector_table(spark, rows))
    assert found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"] and found.count() == 0
    assert queries.vector_codes(vector_table(spark, rows).limit(0)).count() == 0


def test_other_lengths_are_left_out(spark):
    rows = [(k, [float(k)] * 8, 0) for k in range(4)] + [(9, [1.0] * 12, 0), (10, [1.0] * 7, 0)]
    assert sorted(r.vec_id for r in queries.vector_codes(vector_table(spark, rows)).collect()) == [0, 1, 2, 3]


# --- byte-level BPE ---------------------------------------------------------------------

@pytest.fixture(scope="module")
def vocabulary():
    import public_tokenizers

    return bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library(vocabulary):
    import tiktoken

    return tiktoken.Encoding("library", pat_str=vocabulary[1], mergeable_ranks=bpe.parse_ranks(vocabulary[0]), special_tokens={})


ODD = ["", " ", "   ", "\n\n \t", "it's we'll", "<|endoftext|>", "\x00�﻿", "é", "👍🏽👨‍👩‍👧", "ｆｕｌｌ", "日本語" * 50, "a" * 3000, "aaab" * 400,
       "Ü" * 500 + "ß", "1234567890" * 30, "....,,,," * 40, "x" * 33 + " " * 40 + "y"]


def test_ids_are_those_of_the_library(vocabulary, library):
    encoder, rng = bpe.Encoder(bpe.parse_ranks(vocabulary[0]), vocabulary[1]), random.Random(5)
    alphabets = ["abcdefghij ", "aeiouth ", "ação éü ß", "漢字仮名交じり文", "привет мир ", "\x00\x01\n\t  \r", "🤣👍🏽 a", "1234567890.,", "'s't're", "ab"]
    made = ["".join(rng.choice(rng.choice(alphabets)) for _ in range(rng.randrange(80))) for _ in range(3000)]
    for text in ODD + made:
        assert list(encoder.encode(text)) == library.encode_ordinary(text), text


def merged(piece, ranks):
    """Merging by rank as it is defined: the least rank first, the leftmost among equals."""
    parts = [bytes([b]) for b in piece]
    if piece in ranks:
        return [ranks[piece]]
    while True:
        found = [(ranks[a + b], k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not found:
            return [ranks[p] for p in parts]
        k = min(found)[1]
        parts[k : k + 2] = [parts[k] + parts[k + 1]]


def test_vocabularies_whose_merges_are_out_of_order():
    """Ranks in any order, so that tokens may need larger ones before them, or be reached by no merge at all."""
    rng = random.Random(3)
    for _ in range(60):
        tokens = [bytes([b]) for b in range(256)]
        tokens += {"".join(rng.choice("abc") for _ in range(rng.randrange(2, 6))).encode() for _ in range(rng.randrange(3, 25))}
        order = rng.sample(range(len(tokens)), len(tokens))
        ranks = dict(zip(tokens, order))
        encoder = bpe.Encoder(ranks, r"[\s\S]+")
        for _ in range(40):
            text = "".join(rng.choice("abc") for _ in range(rng.randrange(1, 25)))
            assert list(encoder.encode(text)) == merged(text.encode(), ranks)


def test_what_is_remembered_stays_bounded(vocabulary, library, monkeypatch):
    monkeypatch.setattr(bpe, "PIECES", 50)
    monkeypatch.setattr(bpe, "PAIRS", 40)
    monkeypatch.setattr(bpe, "LONG_TEXT", 100)
    encoder = bpe.Encoder(bpe.parse_ranks(vocabulary[0]), vocabulary[1])
    text = " ".join(hashlib.md5(bytes([k % 256, k // 256])).hexdigest() for k in range(600))
    assert list(encoder.encode(text)) == library.encode_ordinary(text)
    assert len(encoder.pieces) <= 50 and len(encoder.compatible) <= 40


def test_digests_of_whole_documents(spark, library, monkeypatch):
    texts = [None, *ODD, "word " * 30_000, None]
    table = spark.createDataFrame([(k % 17 if k else None, t, "i", "d") for k, t in enumerate(texts)], "doc_id bigint, text string, ids string, decoded string")
    found = sorted((tuple(r) for r in queries.byte_bpe(table).collect()), key=str)
    ids = [library.encode_ordinary(t or "") for t in texts]
    expected = [(k % 17 if k else None, len(i), hashlib.sha256(",".join(map(str, i)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
                for k, (t, i) in enumerate(zip(texts, ids))]
    assert found == sorted(expected, key=str)
    assert queries.byte_bpe(table.limit(0)).count() == 0


def test_ids_beyond_the_vocabulary_decode_to_null(spark, vocabulary):
    table = spark.createDataFrame([(1, [0, None]), (2, [99_999_999]), (3, None), (4, []), (5, [-1])], "doc_id bigint, ids array<int>")
    assert {r.doc_id: r.decoded for r in bpe.decode(table, vocabulary[0]).collect()} == {1: None, 2: None, 3: None, 4: b"", 5: None}


def test_a_vocabulary_needs_each_byte():
    with pytest.raises(ValueError):
        bpe.Encoder({b"a": 0}, ".")


# --- spelling ---------------------------------------------------------------------------

TEXTS = "doc_id bigint, text string, word string, n string, _id string"
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def text_table(spark, rows):
    return spark.createDataFrame([(i, t, "w", "n", "x") for i, t in rows], TEXTS)


def plain_words(rows):
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(FOLD)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            found[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run] += 1
    return {w: n for w, n in found.items() if len(w) >= 5 and n >= 3}


def an_edit_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(a) + 1 == len(b) and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain_variants(words):
    near = defaultdict(list)
    for a in words:
        near[a] = [b for b in words if an_edit_apart(a, b)]
    form = {}
    for a, others in near.items():
        best = min(others, key=lambda b: (-words[b], b), default=None)
        form[a] = best if best is not None and words[best] >= 2 * words[a] else None
    found = []
    for a in words:
        root = a
        while form[root] is not None:
            root = form[root]
        found.append((a, form[a], root, words[a], len(near[a]), words.get(form[a])))
    return sorted(found)


def rows_of(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


@pytest.mark.parametrize("alphabet, lengths, count", [("ab", (1, 9), 500), ("aé", (4, 8), 300), ("abcÿ÷", (5, 7), 900), ("a", (1, 14), 14)])
def test_variants_equal_a_plain_version(spark, alphabet, lengths, count):
    rng = random.Random(count)
    words = {"".join(rng.choice(alphabet) for _ in range(rng.randint(*lengths))): rng.choice([3, 4, 6, 7, 12, 13, 25, 60, 150]) for _ in range(count)}
    table = spark.createDataFrame(list(words.items()), "word string, n bigint")
    assert rows_of(spelling.variants(table)) == plain_variants(words)


def test_long_chains_of_forms_end_at_one_root(spark):
    words = {"a" * (5 + k): 3 << k for k in range(40)}
    found = rows_of(spelling.variants(spark.createDataFrame(list(words.items()), "word string, n bigint")))
    assert found == plain_variants(words) and {r[2] for r in found} == {"a" * 44}


def test_words_of_documents(spark):
    rng = random.Random(2)
    stems = ["Maison", "grüßen", "straße", "ÉCOLE", "hôtel", "theory", "Thoery", "theary", "kettle", "nettle", "settle", "x÷yzzz", "naïve"]
    rows = [(k if k % 9 else None, " ".join(rng.choice(stems) for _ in range(60)) + ", 4 l'été_Wörter—end") for k in range(1, 400)]
    rows += [(1, None), (2, ""), (3, "..."), (4, "kettle " * 50_000), (4, "kettle " * 50_000)]
    # A null id has no checksum, so its runs stay as they are.
    expected = Counter(plain_words([r for r in rows if r[0] is not None]))
    unchanged = Counter(w.translate(FOLD) for i, t in rows if i is None for w in re.findall("[A-Za-zÀ-ÿ]+", t))
    expected.update(unchanged)
    table = text_table(spark, rows)
    words = {r.word: r.n for r in spelling.word_counts(table, queries.one_deleted).collect()}
    full = Counter()
    for i, t in rows:
        if i is not None:
            for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
                run = run.translate(FOLD)
                h = zlib.crc32(f"{i}:{run}".encode())
                full[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run] += 1
    full.update(unchanged)
    assert words == {w: n for w, n in full.items() if len(w) >= 5 and n >= 3}
    assert rows_of(spelling.variants(spelling.word_counts(table, queries.one_deleted))) == plain_variants(words)


def test_pairs_come_once_and_have_no_cross_join(spark):
    words = spark.createDataFrame([(w, 1) for w in ("aaaa", "aaaaa", "aaaab", "abaaa", "baaaa", "a", "b", "ab")], "word string, n bigint")
    found = [(r.a, r.b) for r in spelling.near_pairs(words).collect()]
    listed = [r.word for r in words.collect()]
    assert sorted(found) == sorted((a, b) for a in listed for b in listed if an_edit_apart(a, b) and (len(a), a) < (len(b), b))
    plan = spelling.near_pairs(words)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("CartesianProduct|NestedLoopJoin|Python", plan)


def test_no_words_no_variants(spark):
    assert spelling.variants(spelling.word_counts(text_table(spark, []))).count() == 0
    assert spelling.variants(spelling.word_counts(text_table(spark, [(1, None), (2, "ab ab ab")]))).count() == 0
    with pytest.raises(ValueError):
        spelling.variants(spark.createDataFrame([], "word string, n bigint"), 1)


@pytest.mark.parametrize("name", ["op11_vector_codes", "op13_spelling"])
def test_sql_gives_the_same(spark, sf_dir, name):
    import duckdb

    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    df = queries.QUERIES[name](spark, sf_dir)
    columns = ", ".join(df.columns)
    expected = con.execute(f"SELECT {columns} FROM ({queries.ORACLE[name]})").fetchall()
    assert expected and sorted(map(tuple, df.collect()), key=str) == sorted(expected, key=str)
