"""Cases in which an operator once did less than its whole job."""

import re

from monthmart.llm import chat, decontamination, extraction, licenses, neardup, toxicity
from monthmart.llm.license_rules import rules

from test_text_operators import call, chats, docs, plain_classes, prose


# --- extraction -------------------------------------------------------------------------

def extracted(spark, *rows):
    table = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "page_id bigint, url string, html string")
    return {r.page_id: r.text for r in extraction.extract(table).collect()}


def test_template_reaches_into_articles(spark):
    pages = [
        (f"http://d.example/{k}", f"<body><article><h1>{prose(k, 4)}</h1><p>{prose(k + 50, 20)}</p>"
         f"<div class='note-7'><p>Read more of this at our desk</p></div></article></body>") for k in range(6)
    ]
    copied = "<body><article><p>one article</p><p>crawled often</p></article></body>"
    pages += [("http://e.example/a", copied)] * 5 + [("http://e.example/b", "<body><article><p>another</p></article></body>")]
    found = extracted(spark, *pages)
    assert [found[k] for k in range(6)] == [f"{prose(k, 4)}\n\n{prose(k + 50, 20)}" for k in range(6)]
    assert [found[k] for k in range(6, 12)] == ["one article\n\ncrawled often"] * 5 + ["another"]


def test_class_marks_end_at_articles_and_count_as_whole_names():
    def text(html):
        return extraction.main_text(html, set())

    for name in ("content-sidebar-wrap", "has-sidebar", "no-sidebar", "layout-with-menu", "sidebar", "banner"):
        assert text(f"<div class='{name}'><article><p>told</p></article></div>") == "told"
    for name in ("share-price", "search-results", "related-work", "social-policy", "alert", "notice"):
        assert text(f"<main><div class='{name}'><p>told</p></div></main>") == "told"
    for name in ("share", "share-buttons", "ad ad-300", "related-posts", "comments", "cookie-notice"):
        assert text(f"<main><p>told</p><div class='{name}'><p>not</p></div></main>") == "told"
    for tag in ("nav", "aside", "form", "div hidden", "div id='comments'"):
        assert text(f"<p>told</p><{tag}><article class='x'><p>not</p></article></{tag.split()[0]}>") == ""


# --- chats ------------------------------------------------------------------------------

def test_long_chains_are_ordered_and_only_cycles_are_cyclic(spark):
    rows = [(1, k, "assistant", call((f"c{k}", "find", {"q": f"$c{k + 1}"} if k < 99 else {"q": "x"}))) for k in range(100)]
    rows += [(3, k, "assistant", call((f"c{k}", "find", {"q": f"$c{k + 1}"} if k < 9_999 else {"q": "x"}))) for k in range(10_000)]
    rows += [(2, 0, "assistant", call(("m", "find", {"q": "$n"}))), (2, 1, "assistant", call(("n", "find", {"q": "$m"}))),
             (2, 2, "assistant", call(("o", "find", {"q": "$m"}))), (2, 3, "assistant", call(("s", "find", {"q": "$s"})))]
    found = chats(spark, *rows)
    for conv, n in ((1, 100), (3, 10_000)):
        assert [(r.turn, r.problem) for r in found if r.conv_id == conv] == [(k, None) for k in range(n - 1, -1, -1)]
    assert [(r.turn, r.problem) for r in found if r.conv_id == 2] == [(0, "cycle"), (1, "cycle"), (2, None), (3, "cycle")]


# --- toxicity ---------------------------------------------------------------------------

def test_every_obfuscated_spelling_counts():
    at = toxicity.FEATURES.index("obfuscated_rate")
    for text in ("i.d.i.o.t", "s-t-u-p-i-d", "mo_ron", "id!ot", "st*pid", "1d10t", "$tup1d", "cr*tin", "*diot", "st**id"):
        assert toxicity.features(text, {})[at] > 0, text
        assert toxicity.features(f"{text} 7", {})[at] > 0, text
    assert toxicity.features("zo*gh", {"zorgh": 3.0})[at] > 0
    for text in ("idiot", "idiot!", "*idiot*", "*****", "2*3", "well-known", "st*ne"):
        assert toxicity.features(text, {})[at] == 0, text


# --- licences ---------------------------------------------------------------------------

def shortest_texts(parsed):
    """A text of each alternative of a parsed pattern, optional parts left out."""
    found = [""]
    for op, value in parsed:
        name = str(op)
        if name == "LITERAL":
            own = [chr(value)]
        elif name == "IN":
            own = [chr(value[0][1] if str(value[0][0]) == "LITERAL" else value[0][1][0])]
        elif name == "BRANCH":
            own = [t for branch in value[1] for t in shortest_texts(branch)]
        elif name == "SUBPATTERN":
            own = shortest_texts(value[3])
        elif name.endswith("REPEAT"):
            own = [t * value[0] for t in shortest_texts(value[2])]
        else:
            assert name in ("ASSERT", "ASSERT_NOT"), name
            own = [""]
        found = [a + b for a in found for b in own]
    return found


def test_every_alternative_of_a_rule_holds_its_keyword():
    for label, _, keyword, pattern in rules():
        assert all(keyword in t for t in shortest_texts(re._parser.parse(pattern))), (label, keyword, pattern)


def test_titles_without_their_short_names(spark):
    texts = ["Do What The Fuck You Want To Public License", "the PSF license", "Public Domain Dedication and License"]
    found = {r.doc_id: r.labels for r in licenses.scan(docs(spark, *texts)).collect()}
    assert found[0] == "wtfpl" and found[1] == "psf" and "pddl" in found[2].split(",")



# --- near duplicates --------------------------------------------------------------------

def test_repeat_counts_do_not_part_near_duplicates(spark):
    texts = []
    for k in range(6):
        line = prose(300 + k, 104).split()
        more = prose(400 + k, 10).split()
        # 24 words again and again: 20 of the shared shingles often, few new ones.
        texts += [" ".join(line), " ".join(line + more + line[:24] * 50)]
    found = {r.doc_id: r.class_id for r in neardup.near_duplicates(docs(spark, *texts)).collect()}
    assert found == dict(enumerate(plain_classes(texts)))
    assert all(found[k] == found[k + 1] for k in range(0, 12, 2))
    # Equal sets have one sketch, whatever the counts.
    rows = neardup.sketches(docs(spark, "a b c d e f g h i a b c d e f g h i", "a b c d e f g h i " * 9)).collect()
    assert rows[0].node == rows[1].node and rows[0].bands == rows[1].bands


# --- decontamination --------------------------------------------------------------------

def test_every_offset_and_short_items_are_met(spark):
    item, nine = prose(500, 15).split(), prose(501, 9).split()
    items = [(1, " ".join(item)), (2, " ".join(nine)), (3, "zorgel mepsil kunta"), (4, "42")]
    inserted, changed = [*item[:8], "zzz", *item[8:]], [*nine[:8], "zzz"]
    texts = [" ".join(["w"] * k + own + ["w"] * 9) for own in (inserted, changed) for k in range(4)]
    texts += ["so zorgel mepsil kunta it is", "it is 42 then", "it is 43 then", "zorgel mepsil"]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    found = {(r.doc_id, r.item_id): r.share for r in decontamination.leaks(docs(spark, *texts), bench).collect()}
    assert found == {**{(k, 1): 0.5 for k in range(4)}, **{(k, 2): 0.75 for k in range(4, 8)}, (8, 3): 1.0, (9, 4): 1.0}


# --- decontamination --------------------------------------------------------------------

QUESTION = "Tom has 5 apples and buys 12 more apples at 3 dollars each so how much does Tom pay for all the apples"


def asked(name, a, b, c, unit="dollars", again=None):
    return (f"{name} has {a} apples and buys {b} more apples at {c} {unit} each so how much does {again or name} pay for all the apples")


def leaked(spark, texts, items):
    table = docs(spark, *texts)
    bench = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    return {(r.doc_id, r.item_id): r for r in decontamination.leaks(table, bench).collect()}


def test_each_occurrence_has_values_of_its_own(spark):
    mixed = asked("Anna", 8, 90, 7, "euros", again="Peter")
    texts = [
        f"{prose(1, 300)} and {asked('Anna', 8, 90, 7, 'euros')} then {prose(2, 50)} so {asked('Paul', 4, 6, 9)} {prose(3, 200)}",
        f"and {asked('Anna', 8, 90, 7)} {asked('Paul', 4, 6, 9)} {asked('Maria', 1, 2, 3)}", mixed, f"{mixed} {mixed}",
        asked("Anna", 8, 90, 7).replace("more apples", "more very red apples"),
        f"{asked('Anna', 8, 90, 7)} {prose(4, 30)} buys 4 more apples at 9 dollars each so how",
    ]
    found = leaked(spark, texts, [QUESTION])
    assert set(found) == {(0, 0), (1, 0), (4, 0), (5, 0)}
    assert all(r.consistent and r.share >= 0.5 for r in found.values()) and found[0, 0].share == 1.0


def test_windows_of_placeholders_are_met_by_their_own_values(spark):
    numbers = " ".join(str(k * 7 % 100) for k in range(3000))
    found = leaked(spark, [numbers, "9 8 7 6 5 4", "1 2 3", "3 2 1", f"x {numbers}"], ["1 2 3 4 5 6 7 8 9 10", "1 2 3", "7 14 21 28 35 42 49 56"])
    assert set(found) == {(0, 2), (2, 1), (4, 2)}


def plain_leaks(text, item, window=6):
    """The definition, hit by hit: best (windows, consistent, slots) of the whole text and of each step of both cuts."""
    def form(w):
        low = w.lower()
        for listed, mark in ((decontamination.NUMBERS, "<num>"), (decontamination.NAMES, "<name>"), (decontamination.UNITS, "<unit>")):
            if low in listed:
                return mark
        return "<num>" if re.fullmatch("[0-9]+(st|nd|rd|th)?", low) else low

    def windows(words, width):
        for at in range(len(words) - width + 1):
            part, own = words[at : at + width], [form(w) for w in words[at : at + width]]
            slots = tuple(w for w, f in zip(part, own) if w != f)
            yield at, (tuple(part), True) if len(slots) == width else (tuple(own), False), slots

    words, theirs = text.split(), item.split()
    width, size = min(window, len(theirs)), len(theirs)
    mine = list(windows(words, width))
    in_item = list(windows(theirs, width))
    total, scopes = len({h for _, h, _ in in_item}), {}
    for at, h, values in mine:
        for place, other, item_values in in_item:
            if h == other:
                for key in ((0, 0), (1, (at - place) // size), (2, (at - place + size // 2) // size)):
                    scopes.setdefault(key, []).append((h, item_values, values))
    best = None
    for hits in scopes.values():
        pairs = {(i, d) for _, a, b in hits for i, d in zip(a, b)}
        consistent = len(pairs) == len({i for i, _ in pairs})
        count = len({h for h, a, b in hits if consistent or a == b})
        if count >= 0.5 * total:
            best = max(best or (0, False, 0), (len({h for h, _, _ in hits}), consistent, len({i for i, _ in pairs})))
    return best and (total, *best)


def test_leaks_equal_a_plain_version(spark):
    import random

    rng = random.Random(8)
    names = sorted(decontamination.NAMES)[:3]
    vocabulary = ["has", "and", "buys", "then", "so", "how", "1", "2", "3", "4", *names, sorted(decontamination.UNITS)[0]]
    items = [" ".join(rng.choice(vocabulary) for _ in range(n)) for n in (2, 5, 8, 12, 20, 30)]
    texts = []
    for _ in range(60):
        parts = []
        for _ in range(rng.randrange(1, 4)):
            words = rng.choice(items).split()
            words = [rng.choice("1234") if w.isdigit() and rng.random() < 0.4 else w for w in words]
            if rng.random() < 0.5:
                words.insert(rng.randrange(len(words)), rng.choice(vocabulary))
            parts += words + [rng.choice(vocabulary) for _ in range(rng.randrange(6))]
        texts.append(" ".join(parts))
    found = leaked(spark, texts, items)
    expected = {(d, i): plain_leaks(t, x) for d, t in enumerate(texts) for i, x in enumerate(items)}
    assert {k: (r.item_windows, r.found_windows, r.consistent, r.slots) for k, r in found.items()} == {k: v for k, v in expected.items() if v}
