"""Licence scan: ordered signature rules, gated by keywords, resolved by priority and containment.

A text is brought to words with one space between them. Texts without any keyword go no further; in the others,
each keyword that is there brings its rules. Findings are intervals of the text; one that lies
within the interval of an earlier rule is suppressed. A text stays in its row all the way, so nothing is
shuffled, and everything is built-in expressions.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .license_rules import BASE, rules
from .text import fold, let, word_array

_RULE = "struct<rank:int,label:string,confidence:double,pattern:string>"
_FINDING = "array<struct<start:int,end:int,rank:int,label:string,confidence:double>>"


def _groups() -> list[tuple[str, list[tuple[int, str, float, str]]]]:
    """Rules by keyword, with their rank in the order of all rules."""
    groups = defaultdict(list)
    for rank, (label, confidence, keyword, pattern) in enumerate(rules()):
        groups[keyword].append((rank, label, confidence, pattern))
    return sorted(groups.items())


def _rule_groups() -> Column:
    """array<struct<keyword, rules>> as a constant."""
    fields = ("rank", "label", "confidence", "pattern")
    return F.array(*[
        F.struct(F.lit(k).alias("keyword"), F.array(*[
            F.struct(*[F.lit(v).alias(n) for n, v in zip(fields, rule)]).cast(_RULE) for rule in group
        ]).alias("rules")) for k, group in _groups()
    ])


def _starts(text: Column, pattern: Column) -> Column:
    """array<struct<start, end>> of the places of a pattern, from the pieces between them; offsets in characters from 0."""
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    gaps = F.transform(F.split(text, pattern), F.length)
    lengths = F.transform(found, F.length)
    ends = F.aggregate(
        F.arrays_zip(F.slice(gaps, 1, F.size(lengths)).alias("gap"), lengths.alias("size")),
        F.array().cast("array<struct<start:int,end:int>>"),
        lambda done, x: F.concat(done, F.array(let(
            F.coalesce(F.try_element_at(done, F.lit(-1))["end"], F.lit(0)) + x["gap"],
            lambda start: F.struct(start.alias("start"), (start + x["size"]).alias("end")),
        ))),
    )
    return F.when(F.size(found) > 0, ends).otherwise(F.array().cast("array<struct<start:int,end:int>>"))


def _findings(text: Column) -> Column:
    """Findings of the rules whose keyword the text holds."""
    tried = F.flatten(F.transform(F.filter(_rule_groups(), lambda g: F.contains(text, g["keyword"])), lambda g: g["rules"]))
    return F.flatten(F.transform(tried, lambda r: F.transform(
        _starts(text, r["pattern"]),
        lambda at: F.struct(
            at["start"].alias("start"), at["end"].alias("end"), r["rank"].alias("rank"), r["label"].alias("label"),
            r["confidence"].alias("confidence"),
        ),
    ))).cast(_FINDING)


def _resolved(findings: Column) -> Column:
    return F.filter(findings, lambda d: ~F.exists(findings, lambda e: (
        (e["rank"] < d["rank"]) & (e["start"] <= d["start"]) & (e["end"] >= d["end"])
    )))


def _base(text: Column) -> Column:
    """Places of the base phrases: array<struct<word, label>>."""
    def places(label: str, phrase: str) -> Column:
        return F.transform(_starts(text, F.lit(f" {phrase}(?= )")), lambda at: F.struct(
            F.regexp_count(F.substring(text, F.lit(1), at["start"]), F.lit(" ")).cast("bigint").alias("word"), F.lit(label).alias("label")
        ))

    return F.concat(*[places(label, phrase) for label, _, phrase in BASE])


def scan(docs: DataFrame) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, findings.

    n_base counts the places of the base phrases, first_word and last_word are their smallest and largest
    word number from 0, null without any. labels joins the base labels and those of the rules that are not suppressed,
    distinct and sorted. score is the confidence of the surest finding, 0 without any. findings holds
    (start, end, rank, label, confidence) of what is left, offsets counting characters of the words with single spaces between them.
    A null or empty text has no words and no labels. Rows are scanned each, repeated or not; other columns are passed over.
    """
    keywords = sorted({k for _, _, k, _ in rules()} | {k for _, k, _ in BASE})
    some = F.lit(False)
    for keyword in keywords:
        some = some | F.contains(F.col("folded"), F.lit(keyword))
    # The words of every text are counted, but only texts with a keyword are written out again.
    worded = docs.select("doc_id", fold(F.col("text")).alias("folded")).select(
        "doc_id", let(word_array(F.col("folded")), lambda words: F.struct(
            F.size(words).cast("bigint").alias("n"),
            F.when(some, F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" "))).alias("text"),
        )).alias("w"),
    )
    text = F.col("w")["text"]
    found = worded.select("doc_id", F.col("w")["n"].alias("n_words"), F.when(
        text.isNotNull(), let(text, lambda t: F.struct(
            _base(t).alias("base"), let(_findings(t), _resolved).alias("rules")
        )),
    ).alias("f"))
    empty_base = F.array().cast("array<struct<word:bigint,label:string>>")
    base, rest = F.coalesce(F.col("f")["base"], empty_base), F.coalesce(F.col("f")["rules"], F.array().cast(_FINDING))

    def joined(labels: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    base_labels = F.transform(base, lambda b: b["label"])
    surest = F.coalesce(F.array_max(F.transform(rest, lambda r: r["confidence"])), F.lit(0.0))
    return found.select(
        "doc_id", "n_words", F.size(base).cast("bigint").alias("n_base"),
        F.array_min(F.transform(base, lambda b: b["word"])).alias("first_word"),
        F.array_max(F.transform(base, lambda b: b["word"])).alias("last_word"),
        joined(base_labels).alias("base_labels"),
        joined(F.concat(base_labels, F.transform(rest, lambda r: r["label"]))).alias("labels"),
        F.when(F.size(base) > 0, F.greatest(surest, F.lit(0.9))).otherwise(surest).alias("score"), rest.alias("findings"),
    )
