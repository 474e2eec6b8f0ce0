"""Headings as a page shows them, and loads that may be repeated."""

import os
from html.parser import HTMLParser

import pytest

from monthmart.sources import append_once, bulk_load, headings, loaded_rows, write_load


def titles(spark, *pages, level=4):
    rows = spark.createDataFrame(list(enumerate(pages)), "id int, html string")
    found = {k: [] for k in range(len(pages))}
    for r in headings(rows, "id", level=level).orderBy("id", "pos").collect():
        assert r.pos == len(found[r.id])
        found[r.id].append(r.titulo)
    return list(found.values())


PAGES = [
    (None, []), ("", []), ("<p>no heading</p>", []),
    ("<h4>a</h4><H4 class=x>b</H4 >", ["a", "b"]),
    ("<!-- <h4>old</h4> --><h4>new</h4>", ["new"]),
    ("<!-- <h4>never closed", []),
    ("<script>x = '<h4>js</h4>' </script><h4>shown</h4>", ["shown"]),
    ("<SCRIPT type=a>1 < 2; '</scriptx>' <h4>js</h4></Script ><h4>shown</h4>", ["shown"]),
    ("<style><h4>css</h4></style><textarea><h4>typed</h4></textarea><title><h4>t</h4></title>", []),
    ("<script><h4>never closed", []),
    ("<scripted><h4>shown</h4>", ["shown"]),
    ("<h4 title='a>b'>x</h4>", ["x"]), ('<h4 title="a>b" id=c>x</h4>', ["x"]), ("<h4 title = 'a>b' >x</h4>", ["x"]),
    ("<h4 don't>x</h4><p won't>y</p>", ["x"]), ("<h4 a=b'c>x</h4>", ["x"]),
    ("<img alt='</h4><h4>'><h4>x<img alt=\"<h4>\"></h4>", ["x"]),
    ("<h4>O&apos;Neil &amp; co &lt;b&gt; &#65;&#x42; &unknown; &nbsp;</h4>", ["O'Neil & co <b> AB &unknown;"]),
    ("<h4>one<br>two<br/>\n\t three<b>four</b></h4>", ["one two threefour"]),
    ("<h4>1 < 2 <3</h4>", ["1 < 2 <3"]),
    ("<h4>a<!-- </h4> -->b</h4>", ["ab"]), ("<h4>a<script>'</h4>'</script>b</h4>", ["ab"]),
    ("<h4>a</h3>b", ["a"]), ("<h4>a<h4>b</h4>", ["a", "b"]), ("<h4>open to the end", ["open to the end"]), ("<h4></h4>", [""]),
    ("<h40>x</h40><h4x>y</h4x><h4/>z", ["z"]), ("<h3>x</h3><h4>y</h4>", ["y"]),
    ("<!doctype html><?xml <h4> ?><h4>x</h4>", ["x"]), ("</ h4><h4>x</h4>", ["x"]), ("<h4>a\x01b\x02c</h4>", ["abc"]),
    ("<h4 title='never closed><h4>x</h4>", []),
]


def test_headings_as_a_page_shows_them(spark):
    assert titles(spark, *[html for html, _ in PAGES]) == [expected for _, expected in PAGES]


class Shown(HTMLParser):
    def __init__(self, level):
        super().__init__()
        self.name, self.open, self.found = f"h{level}", False, []

    def handle_starttag(self, tag, attrs):
        if tag == self.name:
            self.open = True
            self.found.append("")
        elif tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
            self.open = False
        elif tag == "br":
            self.handle_data(" ")

    def handle_endtag(self, tag):
        if tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
            self.open = False

    def handle_data(self, data):
        if self.open:
            self.found[-1] += data


def test_headings_of_whole_pages_are_those_of_a_parser(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    found = {}
    for r in headings(pages, "page_id", level=2).orderBy("page_id", "pos").collect():
        found.setdefault(r.page_id, []).append(r.titulo)
    for row in pages.collect():
        parser = Shown(2)
        parser.feed(row.html or "")
        parser.close()
        assert found.get(row.page_id, []) == [" ".join(t.split()) for t in parser.found]


def test_long_pages_and_long_attributes(spark):
    many = "<h4>t</h4>" * 20_000 + "<p " + "a='>' " * 3_000 + ">" + "<h4 x=\"" + "y" * 500_000 + "\">last</h4>"
    found = titles(spark, many)[0]
    assert len(found) == 20_001 and found[-1] == "last"


ROWS = "id int, v string"


def rows(spark, *values):
    return spark.createDataFrame([(k, v) for k, v in enumerate(values)], ROWS)


def there(spark, path):
    return sorted((r.carga, r.v) for r in loaded_rows(spark, path, ROWS).collect())


def test_a_load_counts_once(spark, tmp_path):
    path = str(tmp_path / "t")
    assert there(spark, path) == []
    assert append_once(rows(spark, "a", "b"), path, "load.1", ["id", "v"])
    assert not append_once(rows(spark, "a", "b"), path, "load.1", ["id", "v"])
    # Killed after its rows: they do not count, and the next try replaces them.
    write_load(rows(spark, "x", "y", "z"), path, "2", ["id", "v"])
    assert there(spark, path) == [("load.1", "a"), ("load.1", "b")]
    assert append_once(rows(spark, "c"), path, "2", ["id", "v"])
    assert there(spark, path) == [("2", "c"), ("load.1", "a"), ("load.1", "b")]
    # A load without rows is a load.
    assert append_once(rows(spark, "c").limit(0), path, "3", ["id", "v"]) and not append_once(rows(spark, "c"), path, "3", ["id", "v"])
    assert len(there(spark, path)) == 3
    with pytest.raises(ValueError):
        append_once(rows(spark, "c"), path, "../4", ["id", "v"])


def test_a_truncating_load_computes_its_input_once(spark, tmp_path):
    path, calls = str(tmp_path / "t"), spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            calls.add(batch.num_rows)
            yield batch

    bulk_load(rows(spark, "a", "b", "c").mapInArrow(count, ROWS), path, ["id", "v"])
    bulk_load(rows(spark, "d", "e").mapInArrow(count, ROWS), path, ["id", "v"])
    bulk_load(rows(spark, "d").limit(0).mapInArrow(count, ROWS), path, ["id", "v"])
    assert calls.value == 5 and sorted(r.v for r in spark.read.parquet(path).collect()) == ["d", "e"]
    assert os.listdir(tmp_path) == ["t"]
    bulk_load(rows(spark, "f"), path, ["id", "v"], truncate=False)
    assert spark.read.parquet(path).count() == 3
