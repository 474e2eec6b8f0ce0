"""Small tables with nulls, ties, repeats and clashing names against plain versions of each operator."""

import json
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from monthmart.llm import (
    chat, components, decontamination, extraction, licenses, nearest, neardup, packing, quality, sharding, toxicity,
)
from monthmart.llm.license_rules import BASE, rules
from monthmart.llm.queries import TOOLS, tokenizer_path, tool_log

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint, bands string, _id string, label string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def docs(spark, *texts, ids=None, langs=None):
    ids = list(range(len(texts))) if ids is None else ids
    langs = langs or ["en"] * len(texts)
    return spark.createDataFrame([(i, t, l, "s", len(t or ""), "b", "x", "y") for i, t, l in zip(ids, texts, langs)], DOC)


def words(text):
    return WORD.findall((text or "").lower())


def prose(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join("".join(rng.choice(list("abcdefghiklmnoprstuvw"), rng.integers(2, 7))) for _ in range(n))


# --- licences ---------------------------------------------------------------------------

def plain_scan(text):
    found = words(text)
    line, score, labels, base = " " + " ".join(found) + " ", 0.0, set(), []
    for label, _, phrase in BASE:
        parts = phrase.split()
        base += [(k, label) for k in range(len(found)) if found[k : k + len(parts)] == parts]
    hits = [(m.start(), m.end(), r, l, c) for r, (l, c, k, p) in enumerate(rules()) if k in line for m in re.finditer(p, line)]
    kept = [h for h in hits if not any(e[2] < h[2] and e[0] <= h[0] and e[1] >= h[1] for e in hits)]
    labels = {l for _, l in base}
    score = max([0.0, *(h[4] for h in kept), *([0.9] if base else [])])
    places = [k for k, _ in base]
    return (len(found), len(base), min(places, default=None), max(places, default=None), ",".join(sorted(labels)),
            ",".join(sorted(labels | {h[3] for h in kept})), score)


LICENSED = [
    None, "", "...", "MIT License", "mit-license; MIT   LICENSE\nmit license", "the mit licenses",
    "Licensed under the Apache License, Version 2.0.", "This is GNU General Public License, version 3 or any later version",
    "CC BY-NC 4.0 and CC-BY 4.0, all rights reserved. Creative Commons Attribution-ShareAlike 3.0 Unported",
    "SPDX-License-Identifier: GPL-2.0-or-later", "Öffentlich: BSD 3-Clause licence; " + "word " * 3000 + "Mozilla Public License 2.0",
    "gnu general public license " * 200, "Copyright (c) 2020, proprietary and confidential.",
]


def test_licences(spark):
    found = {r.doc_id: tuple(r)[1:8] for r in licenses.scan(docs(spark, *LICENSED)).collect()}
    assert found == {i: plain_scan(t) for i, t in enumerate(LICENSED)}
    assert found[8][5] == "all-rights-reserved,cc-by,cc-by-4.0,cc-by-nc-4.0,cc-by-sa-3.0"
    assert len(rules()) > 300 and licenses.scan(docs(spark, "x").limit(0)).count() == 0


def test_licence_scan_runs_no_python(spark):
    plan = licenses.scan(docs(spark, "x"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


# --- near duplicates --------------------------------------------------------------------

def plain_classes(texts, threshold=0.8):
    def shingles(t):
        w = words(t)
        n = min(5, len(w))
        return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if w else set()

    sets = [shingles(t) for t in texts]
    label = list(range(len(texts)))
    for _ in texts:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a and b and len(a & b) / len(a | b) >= threshold:
                    label[i] = label[j] = min(label[i], label[j])
    return label


def near_texts():
    base = prose(1, 120).split()
    rng = np.random.default_rng(2)
    texts = [" ".join(base), " ".join(base).upper() + "!", None, "", "...", "short text", "Short  text.", "one two three four five"]
    for k in range(60):
        copy = list(base)
        for at in rng.integers(0, 120, k % 5 + 1):
            copy[at] = f"changed{k}x{at}"
        texts.append(" ".join(copy))
    texts += [prose(k, 90) for k in range(20, 30)] + [prose(20, 90)] * 3
    return texts


@pytest.mark.parametrize("paired, block", [(50, 800), (2, 8), (0, 5)])
def test_near_duplicates(spark, monkeypatch, paired, block):
    monkeypatch.setattr(neardup, "PAIRED_BUCKET", paired)
    monkeypatch.setattr(neardup, "BLOCK", block)
    texts = near_texts()
    rows = neardup.near_duplicates(docs(spark, *texts)).collect()
    expected = plain_classes(texts)
    assert {r.doc_id: r.class_id for r in rows} == dict(enumerate(expected)) and len(rows) == len(texts)
    sizes = Counter(expected)
    assert all(r.class_size == sizes[r.class_id] for r in rows)


def test_one_of_each_class_stays(spark):
    texts = near_texts()
    table = docs(spark, *texts)
    kept = neardup.keep_one(table.union(table))
    assert kept.columns == table.columns
    expected = plain_classes(texts)
    found = Counter(r.doc_id for r in kept.collect())
    wordless = {i for i, t in enumerate(texts) if not words(t)}
    assert set(found) == set(expected) and all(n == (2 if i in wordless else 1) for i, n in found.items())
    nameless = neardup.keep_one(docs(spark, "a b c d e f", "a b c d e f", "g h i j k l", ids=[None] * 3))
    assert sorted(r.text for r in nameless.collect()) == ["a b c d e f", "g h i j k l"]
    assert neardup.near_duplicates(docs(spark, "x").limit(0)).count() == 0


def test_signatures_estimate_probability_jaccard():
    rng = np.random.default_rng(0)
    a = dict(zip(range(100), rng.uniform(1, 4, 100)))
    b = dict(zip(range(40, 140), rng.uniform(1, 4, 100)))
    exact = sum(1 / sum(max(a.get(e, 0) / a[d], b.get(e, 0) / b[d]) for e in a.keys() | b.keys()) for d in a.keys() & b.keys())
    element = neardup.mix(np.array([*a, *b], np.uint64) + np.uint64(1))
    signature = neardup.prob_minhash(np.repeat([0, 1], 100), element, np.array([*a.values(), *b.values()]), 2, 4096)
    assert abs((signature[0] == signature[1]).mean() - exact) < 0.03


def test_components(spark):
    rng = np.random.default_rng(3)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 60, (40, 2))] + [(k, k + 1) for k in range(100, 140)] + [(5, 5)]
    label = {}
    for a, b in links:
        for x in (a, b):
            label.setdefault(x, x)
    for _ in label:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    found = components.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert {r.node: r.component for r in found} == {x: label[x] for x in linked} and len(found) == len(linked)


def plans_written(monkeypatch, module, work):
    """(name, number of joins) of each table that module writes on the way, as work runs."""
    seen, write = [], module.materialize

    def watched(df, name):
        seen.append((name, len(re.findall(r"\bJoin \w+", df._jdf.queryExecution().optimizedPlan().toString()))))
        return write(df, name)

    monkeypatch.setattr(module, "materialize", watched)
    work()
    return seen


def test_a_plan_of_components_holds_one_join(spark, monkeypatch):
    links = [(f"{k:03d}".encode(), f"{k + 1:03d}".encode()) for k in range(9)] + [(b"000", b"001"), (b"x", None), (b"y", b"y")]
    found = []
    seen = plans_written(monkeypatch, components, lambda: found.extend(
        components.components(spark.createDataFrame(links, "a binary, b binary")).collect()))
    assert sorted((bytes(r.node), bytes(r.component)) for r in found) == [(f"{k:03d}".encode(), b"000") for k in range(10)]
    assert seen and max(joins for _, joins in seen) == 1


def test_a_plan_of_the_quality_model_holds_one_order(spark, monkeypatch):
    table = docs(spark, *[prose(k, 20) for k in range(4)])
    counts = quality.gram_counts(table)
    seen = plans_written(monkeypatch, quality, lambda: quality.perplexities(table, counts))
    # The counts with their totals, both with the wanted grams, and the order below.
    assert dict(seen)["log-probabilities"] == 4


# --- extraction -------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style></head><body><header>Site</header><nav><a>Home</a></nav>
<div class="cookie-notice">We use cookies</div><script>var a="</p>";</script><article><header><h1>Head &amp; line</h1></header>
<p>First <b>bold</b> &eacute;&nbsp;text<br>goes on<p>Second &#8211; part</p><div class="ad">Buy</div><form>Name <input></form>
<ul><li>one<li>two</ul><section id="comments"><p>Reader says</p></section><aside>See also</aside></article><footer>(c)</footer></body></html>"""
PAGES = [
    (1, "http://a.example/1", PAGE, "x"), (1, "http://a.example/1", PAGE, "x"), (2, None, None, "x"), (3, "", "", "x"),
    (4, "http://b.example/1", "just text", "x"), (5, "http://b.example/2", "<p>unclosed <b>and <i>nested", "x"),
    (6, "http://b.example/3", "<div class='sidebar'>s</div><div><p>kept</p></div>", "x"),
    *[(10 + k, f"http://c.example/{k}", f"<body><div class=top><p>Same line</p><p>Other line</p></div><div><p>{prose(k, 9)}</p></div>", "x")
      for k in range(5)],
]


def test_extraction(spark):
    table = spark.createDataFrame(PAGES, "page_id bigint, url string, html string, template_texts string")
    rows = extraction.extract(table).collect()
    found = {r.page_id: r.text for r in rows}
    assert len(rows) == len(PAGES) and all(r.n_chars == len(r.text) for r in rows)
    assert found[1] == "Head & line\n\nFirst bold é text goes on\n\nSecond – part\n\none\n\ntwo"
    assert (found[2], found[3], found[4], found[5], found[6]) == ("", "", "just text", "unclosed and nested", "kept")
    # What five pages of a host share is its template.
    assert all(found[10 + k] == prose(k, 9) for k in range(5))
    assert extraction.extract(table.limit(0)).count() == 0


def test_template_nests(spark):
    table = spark.createDataFrame(PAGES, "page_id bigint, url string, html string, template_texts string")
    tokens = extraction.templates(table).filter("host = 'c.example'").collect()
    assert len({r.vector for r in tokens if r.is_text}) == 1 and all(r.pages == 5 for r in tokens)
    classes = {r.token: r.vector for r in tokens}
    assert all(classes.get(r.around, r.around_vector) == r.around_vector for r in tokens)


# --- packing and sharding ---------------------------------------------------------------

def test_packing(spark):
    from tokenizers import Tokenizer

    texts = [None, "", "x", prose(1, 3000), prose(2, 9000), "<|endoftext|> a", "äöü €", *[prose(k, 30 + 7 * (k % 60)) for k in range(150)]]
    ids = [*range(len(texts) - 1), 0]
    rows = packing.pack(docs(spark, *texts, ids=ids), tokenizer_path()).collect()
    whole = Tokenizer.from_file(tokenizer_path())
    expected = Counter()
    total = 0
    for i, t in zip(ids, texts):
        data = np.array([*whole.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        total += len(data)
        first = len(data) % 2048 or min(len(data), 2048)
        cuts = [0, *range(first, len(data) + 1, 2048)] if len(data) > 2048 else [0, len(data)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            expected[i, k, a, b - a, zlib.crc32(data[a:b].tobytes())] += 1
    assert Counter(tuple(r)[:5] for r in rows) == expected
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for own in places.values():
        own.sort()
        assert own[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(own, own[1:])) and sum(n for _, n in own) <= 2048
    assert len(places) <= math.ceil(total / 2048) + 1
    assert packing.pack(docs(spark, "x").limit(0), tokenizer_path()).count() == 0


def checked_plan(counts, capacity, **options):
    found = packing.plan(counts, capacity, **options)
    assert sum((Counter({k: n * t for k, n in p.items()}) for p, t in found), Counter()) == Counter(counts)
    assert all(sum(k * n for k, n in p.items()) <= capacity for p, _ in found)
    return sum(t for _, t in found)


def plain_best_fit(counts, capacity):
    rooms = []
    for size in sorted(Counter(counts).elements(), reverse=True):
        fitting = [i for i, room in enumerate(rooms) if room >= size]
        if fitting:
            rooms[min(fitting, key=rooms.__getitem__)] -= size
        else:
            rooms.append(capacity - size)
    return len(rooms)


@pytest.mark.parametrize("seed", range(30))
def test_plan_of_few_pieces_is_the_best(seed):
    rng = np.random.default_rng(seed)
    low = int(rng.integers(1, 7))
    counts = Counter(int(x) for x in rng.integers(low, 21, 13))
    left = sorted(counts.elements(), reverse=True)
    seen = set()

    def fits(at, rooms):
        """Exhaustive: whether the pieces from at on go into the rooms."""
        if at == len(left):
            return True
        if (at, rooms) in seen:
            return False
        seen.add((at, rooms))
        return any(
            fits(at + 1, tuple(sorted((*rooms[:k], room - left[at], *rooms[k + 1:]))))
            for k, room in enumerate(rooms) if room >= left[at] and room not in rooms[:k]
        )

    best = 1
    while not fits(0, (20,) * best):
        best += 1
        seen.clear()
    assert checked_plan(counts, 20) == best


@pytest.mark.parametrize("seed", range(6))
def test_plan_is_no_worse_than_best_fit(seed):
    rng = np.random.default_rng(seed)
    few = Counter(int(x) for x in rng.choice([341, 400, 683, 684, 700, 1024, 1025], 250))
    many = Counter(int(x) for x in rng.integers(1, 600, 1500))
    assert checked_plan(few, 2048) < plain_best_fit(few, 2048)
    assert checked_plan(many, 2048) == math.ceil(sum(k * n for k, n in many.items()) / 2048)
    for counts in (few, many):
        assert sum(t for _, t in packing.best_fit(counts)) == plain_best_fit(counts, 2048)
        number = np.zeros(2049, np.int64)
        number[list(counts)] = list(counts.values())
        assert packing.l2_bound(number) <= checked_plan(counts, 2048, work=0) <= plain_best_fit(counts, 2048)


def test_plan_of_billions_and_of_nothing():
    billions = {1025: 3 * 10**9, 1023: 2 * 10**9, 512: 10**9, 1: 7}
    assert checked_plan(billions, 2048) == 3 * 10**9
    assert packing.plan({}) == [] and packing.plan({5: 0}) == []
    with pytest.raises(ValueError):
        packing.plan({2049: 1})


def test_fillings_are_undominated():
    found = list(packing.fillings(10, {7: 1, 5: 2, 4: 1, 3: 2, 2: 1}))
    # 5+5 gives way to nothing; 4+3+3 has 7 in place of 4+3, and 5+3+2 has 5 in place of 3+2.
    assert found == [(0, ((7, 1), (3, 1))), (0, ((5, 2),))]


@pytest.mark.parametrize("rows", [1, 2, 3, 5, 16, 17, 1000, 4097])
def test_permutation(rows):
    places = sharding.permuted(np.arange(rows), rows, seed=5)
    assert sorted(places) == list(range(rows))
    assert sharding.shard_and_slot(rows - 1, rows, 16, 5) == (places[-1] % 16, places[-1] // 16)


def test_sharding(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(sharding, "ROWS_PER_BUCKET", 20)
    table = docs(spark, *[f"t{k % 90}" for k in range(200)], ids=[k % 90 if k % 7 else None for k in range(200)])
    keys = {"doc_id": F.col("doc_id"), "size": F.length("text")}
    rows = sharding.shard(table.repartition(3), keys).collect()
    assert [tuple(r) for r in sorted(rows, key=lambda r: r.row_number)] == [
        tuple(r) for r in sorted(sharding.shard(table, keys).collect(), key=lambda r: r.row_number)]
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        assert (r.shard, r.slot) == sharding.shard_and_slot(r.row_number, 200, 16)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert {len(s) for s in slots.values()} <= {12, 13} and len(rows) == 200
    assert sharding.shard(table.limit(0), keys).count() == 0


# --- chats ------------------------------------------------------------------------------

SCHEMAS = [("find", ["q"], {"q": "string", "n": "integer", "x": "number"})]


def call(*calls, content=None):
    return json.dumps({"content": content, "tool_calls": [{"id": i, "name": n, "arguments": a} for i, n, a in calls]})


def result(i, content="r"):
    return json.dumps({"tool_call_id": i, "content": content})


def chats(spark, *rows):
    table = spark.createDataFrame([(*r, "p", "q") for r in rows], "conv_id bigint, turn bigint, role string, text string, place string, at string")
    found = chat.format_chats(table, spark.createDataFrame(SCHEMAS, chat.SCHEMAS_SCHEMA)).collect()
    assert len(found) == len(rows)
    for r in found:
        assert json.dumps(json.loads(r.json), sort_keys=True, separators=(",", ":"), ensure_ascii=False) == r.json
    return sorted(found, key=lambda r: (r.conv_id is None, r.conv_id or 0, r.place))


def test_calls_are_linked_ordered_and_checked(spark):
    found = chats(
        spark, (1, 0, "user", 'say "x"\n\t\\ é\x01'),
        (1, 1, "assistant", call(("a", "find", {"q": "$b", "n": 2}))), (1, 2, "tool", result("a")),
        (1, 3, "assistant", call(("b", "find", {"n": "two"}), content="hm")), (1, 4, "tool", result("b")),
        (1, 5, "tool", result("zz")), (2, 0, "assistant", call(("a", "other", {}))), (2, 1, None, None),
        (None, 0, "user", "x"), (3, 0, "assistant", call(("m", "find", {"q": "$n"}), ("n", "find", {"q": "$m"}))),
        (1, 0, "user", 'say "x"\n\t\\ é\x01'),
    )
    first = [(r.turn, r.call_ids, r.linked, r.problem) for r in found if r.conv_id == 1]
    assert first == [
        (0, None, None, None), (0, None, None, None), (3, ["b"], True, "missing q"), (1, ["a"], True, None), (2, ["a"], True, None),
        (4, ["b"], True, None), (5, ["zz"], False, "no call")]
    assert [r.place for r in found if r.conv_id == 1] == list(range(7))
    assert [(r.linked, r.problem) for r in found if r.conv_id == 2] == [(False, "unknown tool"), (None, None)]
    assert [r.problem for r in found if r.conv_id == 3] == ["cycle"]
    arguments = json.loads(next(r.json for r in found if r.turn == 1 and r.conv_id == 1))["tool_calls"][0]["arguments"]
    assert arguments == {"n": 2, "q": "$b"}


def test_chats_of_the_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/conversations.parquet")
    log = tool_log(table)
    found = chat.format_chats(log, spark.createDataFrame(TOOLS, chat.SCHEMAS_SCHEMA)).collect()
    assert len(found) == log.count()
    assert {r.problem for r in found} == {None, "cycle", "missing length", "type of length"} and {r.linked for r in found} == {None, True, False}
    places = {(r.conv_id, r.role, i): r.place for r in found for i in r.call_ids or ()}
    cyclic = {(r.conv_id, i) for r in found if r.problem == "cycle" for i in r.call_ids}
    moved = 0
    for r in found:
        if r.role == "assistant":
            (one,) = json.loads(r.json)["tool_calls"]
            assert one["arguments"]["code"] == one["id"][1:] and one["arguments"]["meta"]["z"][0] == one["arguments"]["turn"]
            key, other = (r.conv_id, one["id"]), one["arguments"].get("after", "")[1:]
            if (r.conv_id, "assistant", other) in places and key not in cyclic:
                assert r.place > places[r.conv_id, "assistant", other]
                moved += int(other[1:]) > one["arguments"]["turn"]
            assert key in cyclic or places.get((r.conv_id, "tool", one["id"]), 1 << 40) > r.place
    assert moved and cyclic


TYPED = [
    ({"q": "5"}, None), ({"q": "true"}, None), ({"q": "[draft] a]"}, None), ({"q": "{x}"}, None), ({"q": "null"}, None), ({"q": ""}, None),
    ({"b": 1, "a": [2, 1, {"z": None, "y": {"d": 1, "c": "\u00e9\n\\\""}}], "q": "x"}, None),
    ({"q": 5}, "type of q"), ({"q": True}, "type of q"), ({"q": None}, "missing q"), ({"q": ["x"]}, "type of q"), ({"q": "$a"}, None),
    ({"n": 2.5, "q": "x"}, None), ({"n": 3, "q": "x"}, None), ({"n": "3", "q": "x"}, "type of n"), ([1, "2"], "no object"), ("text", "no object"),
]


def test_arguments_keep_their_types(spark):
    schemas = spark.createDataFrame([("t", ["q"], {"q": "string", "n": "number"})], chat.SCHEMAS_SCHEMA)
    rows = [(k, 0, "assistant", json.dumps({"tool_calls": [{"name": "t", "id": f"i{k}", "arguments": a}], "content": [k, {"b": 1, "a": None}]}))
            for k, (a, _) in enumerate(TYPED)]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    for r in chat.format_chats(table, schemas).collect():
        arguments, problem = TYPED[r.conv_id]
        expected = {"content": [r.conv_id, {"b": 1, "a": None}], "role": "assistant", "tool_calls": [{"arguments": arguments, "id": f"i{r.conv_id}", "name": "t"}]}
        assert r.json == json.dumps(expected, sort_keys=True, separators=(",", ":"), ensure_ascii=False) and r.problem == problem


def test_references_are_ordered_in_linear_time():
    long = {f"c{k}": [f"c{k + 1}", f"c{k + 1}"] if k < 200_000 else [] for k in range(200_001)}
    order = chat.reference_order(long, {c: k for k, c in enumerate(long)})
    assert order["c0"] == (400_000, False) and order["c200000"] == (None, False)
    rng = np.random.default_rng(5)
    for _ in range(200):
        n = int(rng.integers(1, 9))
        refs = {str(k): [str(x) for x in np.flatnonzero(rng.random(n) < 0.25)] for k in range(n)}
        ahead = {c: int(rng.integers(0, 50)) for c in refs}
        reach = {c: set(o) for c, o in refs.items()}
        for _ in refs:
            reach = {c: o | {x for y in o for x in reach[y]} for c, o in reach.items()}
        order = chat.reference_order(refs, ahead)
        assert {c for c, (_, cyclic) in order.items() if cyclic} == {c for c in refs if c in reach[c]}
        for c, (due, cyclic) in order.items():
            ends = [max(ahead[o], order[o][0] or ahead[o]) + 1 for o in refs[c]]
            assert due == (None if cyclic or not ends else max(ends))


# --- quality ----------------------------------------------------------------------------

def plain_kneser_ney(texts, order, base):
    """Chances by the formulas, level by level, over symbol tuples."""
    counts = Counter()
    for t in texts:
        line = [0] * (order - 1) + t + [0]
        counts.update(tuple(line[k : k + order]) for k in range(len(line) - order + 1))
    levels = [counts]
    for _ in range(order - 1):
        levels.append(Counter(g[1:] for g in levels[-1]))
    chance = {(): 1 / base}

    def lookup(gram, tables):
        if not tables:
            return 1 / base
        table = tables[0]
        n = Counter(table.values())
        y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5
        step = [min(k, max(0.1, k - (k + 1) * y * n[k + 1] / n[k])) if n[k] else 0.5 * k for k in (1, 2, 3)]
        own = {g: c for g, c in table.items() if g[:-1] == gram[:-1]}
        if not own:
            return lookup(gram[1:], tables[1:])
        total = sum(own.values())
        count = own.get(gram, 0)
        left = sum(step[min(c, 3) - 1] for c in own.values())
        return (max(0, count - step[min(count, 3) - 1]) if count else 0) / total + left / total * lookup(gram[1:], tables[1:])

    del chance
    return lambda gram: lookup(gram, levels)


def test_kneser_ney(spark):
    texts = ["abracadabra", "abba", "cab", "", "aaaa bbbb", "мама мыла раму", "漢字仮名交じり文 漢字", "αβγ αβγ 🤣"]
    unseen = ["zebra", "мир", "漢文", "🤣🤣", ""]
    table = docs(spark, *texts, *unseen)
    counts = quality.gram_counts(docs(spark, *texts), 3)
    number = {c: k for k, c in enumerate(sorted(set("".join(texts))), 2)}
    symbols = [[number.get(c, 1) for c in t] for t in texts + unseen]
    many = len(number) + 2
    plain = plain_kneser_ney(symbols[:len(texts)], 3, many)
    for a in range(0, many, 5):
        for b in range(0, many, 3):
            assert abs(sum(plain((a, b, c)) for c in range(many)) - 1) < 1e-9
    expected = []
    for own in symbols:
        line = [0, 0, *own, 0]
        logs = [math.log(plain(tuple(line[k : k + 3]))) for k in range(len(own) + 1)]
        expected.append(math.exp(-sum(logs) / len(logs)))
    for limit in (10**6, 0):  # broadcast, blocks
        rows = quality.perplexities(table.select("doc_id", "text"), counts, broadcast_grams=limit).collect()
        assert len(rows) == len(expected) and all(abs(r.perplexity / expected[r.doc_id] - 1) < 1e-9 for r in rows)


def test_classify_by_blocks_equals_broadcast(spark, monkeypatch):
    monkeypatch.setattr(quality, "BLOCK_CHARS", 500)
    table = docs(spark, *[prose(k, 40) for k in range(40)], "привет мир " * 9, None, "", "x" * 5000, ids=[*range(42), 3, None])
    labels = spark.createDataFrame([(k, int(k % 3 > 0)) for k in range(44)], "doc_id bigint, quality int")
    one, two = (
        sorted(quality.classify(table, labels, least_trusted=5, broadcast_grams=n).collect(), key=str) for n in (10**6, 0)
    )
    assert len(one) == 44 and [tuple(r)[:3] + (r.accepted,) for r in one] == [tuple(r)[:3] + (r.accepted,) for r in two]
    assert np.allclose([r.perplexity for r in one], [r.perplexity for r in two])


def test_quality_rejects_noise(spark):
    clean = [prose(k, 60) for k in range(80)]
    noise = ["#$%^ &*@! " * 30, "ZQ!! XJ!! " * 40]
    table = docs(spark, *clean, *noise, None, "", *noise[:1], langs=["en"] * 40 + ["de"] * 43 + [None, "xx"])
    labels = spark.createDataFrame([*((k, 1) for k in range(80)), (80, 0), (80, 1), (None, 1)], "doc_id bigint, quality int")
    rows = {r.doc_id: r for r in quality.classify(table, labels, quantile=1.0, least_trusted=10).collect()}
    assert len(rows) == 85 and {i for i, r in rows.items() if not r.accepted} == {80, 81, 84}
    kept = quality.keep_accepted(table, labels, quantile=1.0, least_trusted=10)
    assert kept.columns == table.columns and kept.count() == 82
    assert quality.keep_accepted(table, labels.limit(0)).count() == 85
    assert quality.classify(table.limit(0), labels).count() == 0


# --- nearest ----------------------------------------------------------------------------

def plain_nearest(rows, every, k):
    known = {i: np.array(v, float) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    out = {}
    for q in (i for i in known if i % every == 0):
        scores = sorted((-float(known[q] @ v / math.sqrt((known[q] @ known[q]) * (v @ v))), i) for i, v in known.items() if i != q)
        out[q] = scores[:k]
    return out


def test_nearest(spark):
    rng = np.random.default_rng(0)
    rows = [(k, [float(np.float32(x)) for x in rng.normal(size=8)]) for k in range(300)]
    rows += [(300 + k, rows[0][1]) for k in range(40)]
    rows += [(400, None), (402, []), (404, [0.0] * 8), (406, [1.0, float("nan")] + [0.0] * 6), (408, [None] + [1.0] * 7),
             (410, [float("inf")] + [0.0] * 7), (412, [1.0, 2.0]), (None, rows[1][1]), rows[5]]
    table = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], "vec_id bigint, embedding array<float>, node string, list string")
    found = defaultdict(dict)
    for r in nearest.search(table, every=10, k=5, list_size=20).collect():
        found[r.query_id][r.rank] = (r.vec_id, r.score)
    expected = plain_nearest([r for r in rows if r[0] != 412], 10, 5)
    assert set(found) == set(expected) and all(sorted(f) == [1, 2, 3, 4, 5] for f in found.values())
    hits = sum(len({i for i, _ in found[q].values()} & {i for _, i in e}) for q, e in expected.items())
    assert hits / sum(map(len, expected.values())) >= 0.9
    assert [found[300][k][0] for k in range(1, 6)] == [0, 301, 302, 303, 304]
    for q, e in expected.items():
        own = {i: -s for s, i in plain_nearest([r for r in rows if r[0] != 412], q or 10**9, 10**6).get(q, e)}
        assert all(abs(s - own[i]) < 1e-9 for i, s in found[q].values() if i in own)


def test_nearest_of_few(spark):
    table = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0])], "vec_id bigint, embedding array<double>")
    assert [tuple(r)[:3] for r in nearest.search(table).collect()] == [(0, 1, 2), (0, 2, 1)]
    assert nearest.search(table.limit(0)).count() == 0 and nearest.search(table.limit(1)).count() == 0


# --- toxicity ---------------------------------------------------------------------------

def test_toxicity(spark):
    rng = np.random.default_rng(1)
    texts = []
    for k in range(600):
        own = prose(k + 5000, 40).split()
        if k % 4 == 0:
            for _ in range(4):
                own.insert(int(rng.integers(0, 40)), str(rng.choice(["idiot", "moron", "zorgh", "zorgh"])))
        texts.append(" ".join(own))
    table = docs(spark, *texts, None, "", "x" * 20000)
    labels = spark.createDataFrame([*((k, int(k % 4 == 0)) for k in range(600)), (None, 1), (3, None)], "doc_id bigint, toxic int")
    rows = {r.doc_id: r for r in toxicity.score(table, labels).collect()}
    assert len(rows) == 603 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows.values())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in rows.items())
    held = [(i % 4 == 0, r.predicted) for i, r in rows.items() if r.held_out and i < 600]
    assert sum(a == b for a, b in held) / len(held) > 0.95
    # A label of a held-out row changes nothing.
    kept = labels.filter(~toxicity.is_held_out(labels["doc_id"]))
    assert {r.doc_id: r.score for r in toxicity.score(table, kept).collect()} == {i: r.score for i, r in rows.items()}
    stay = toxicity.drop_toxic(table, labels)
    assert stay.columns == table.columns and stay.count() == sum(not r.predicted for r in rows.values())


def test_toxicity_without_labels(spark):
    table = docs(spark, "you idiot", "fine words", None)
    found = {r.doc_id: r.predicted for r in toxicity.score(table, spark.createDataFrame([], "doc_id bigint, toxic int")).collect()}
    assert found == {0: 1, 1: 0, 2: 0}
    assert toxicity.features("", {}) == [0.0] * len(toxicity.FEATURES)
    assert toxicity.features("1d10t", {})[toxicity.FEATURES.index("obfuscated_rate")] == 1.0


# --- decontamination --------------------------------------------------------------------

def test_leaks(spark):
    question = "Tom has 5 apples and buys 12 more apples at 3 dollars each so how much does Tom pay for all the apples"
    changed = "Anna has 8 apples and buys 90 more apples at 7 euros each so how much does Anna pay for all the apples"
    broken = "Anna has 8 apples and buys 90 more apples at 7 euros each so how much does Peter pay for all the apples"
    items = [(1, question), (2, prose(900, 40)), (3, "too short an item"), (4, None), (None, prose(901, 30)), (2, prose(900, 40))]
    long = prose(1, 4000)
    texts = [
        question.upper(), f"{long} {changed}. {long}", broken, f"x {prose(900, 40)} y {prose(901, 30)}", prose(902, 200), None, "",
        " ".join(prose(900, 40).split()[:12]), " ".join(prose(900, 40).split()[:30]),
    ]
    table = docs(spark, *texts, *texts[:1], ids=[*range(len(texts)), 0])
    bench = spark.createDataFrame([(i, t, "w") for i, t in items], "item_id bigint, text string, words string")
    rows = decontamination.leaks(table, bench).collect()
    found = {(r.doc_id, r.item_id): r for r in rows}
    assert set(found) == {(0, 1), (1, 1), (3, 2), (3, None), (8, 2)} and len(rows) == 5
    assert found[3, 2].share == 1.0 and found[1, 1].consistent and found[1, 1].slots >= 4 and 0.5 < found[8, 2].share < 1
    kept = decontamination.drop_leaks(table, bench)
    assert kept.columns == table.columns and sorted(r.doc_id for r in kept.collect()) == [2, 4, 5, 6, 7]
    assert decontamination.leaks(table, bench.limit(0)).count() == 0
    plan = decontamination.leaks(table, bench)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
