"""Chat formatting with linked tool calls.

A tool call stands in an assistant's message as JSON, {"tool_calls": [{"id", "name", "arguments"}]}, and its result is
a message of role tool, {"tool_call_id", "content"}. Results are hash-joined to calls by conversation and identifier. A string
argument "$id" refers to the result of another call. Messages keep their turns, except that a call follows all
calls that it refers to and a result follows its call. Arguments are checked against the schema of the
tool, and every message is written as canonical JSON: keys sorted at every depth, no spaces, one line. JSON is read as variants, so values keep
their types: "5" stays a string, 5 a number.

A conversation is not gathered: each message is a row with its place, so a conversation of any length is spread over tasks. Only the
identifiers of calls that references connect meet in a task, where they are ordered in time linear in the references.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources import materialize
from .components import components

# A turn leaves room for this many messages that are moved behind it.
ROOM = 1 << 20
SCHEMAS_SCHEMA = "name string, required array<string>, types map<string,string>"


def quoted(text: Column) -> Column:
    """A JSON string: quotes, backslashes and control characters escaped, all else as it is."""
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for sign, escaped in (('"', '\\"'), ("\b", "\\b"), ("\f", "\\f"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        out = F.replace(out, F.lit(sign), F.lit(escaped))
    for code in (*range(8), 11, *range(14, 32)):
        out = F.replace(out, F.lit(chr(code)), F.lit(f"\\u{code:04x}"))
    return F.concat(F.lit('"'), out, F.lit('"'))


def _object(fields: dict[str, Column]) -> Column:
    """JSON object of fields that are JSON already, keys sorted, null fields left out."""
    parts = [F.concat(F.lit(f'"{name}":'), value) for name, value in sorted(fields.items())]
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def _part(parsed: str, path: str, kind: str = "variant") -> Column:
    """What a parsed JSON column has at a path; null if it has none or of another kind."""
    return F.expr(f"try_variant_get({parsed}, '{path}', '{kind}')")


def _kind(value: Column) -> Column:
    """JSON type of a variant; "reference" for a string that names another call."""
    schema = F.schema_of_variant(value)
    return (
        F.when(schema == "VOID", "null").when(schema == "BOOLEAN", "boolean").when(schema.startswith("OBJECT"), "object")
        .when(schema.startswith("ARRAY"), "array").when(schema.rlike(r"^(BIGINT|DECIMAL\([0-9]+,0\))$"), "integer")
        .when(schema.rlike("^(DECIMAL|DOUBLE|FLOAT)"), "number")
        .when(value.cast("string").startswith("$"), "reference").otherwise("string")
    )


def calls_of(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, seq, call_id, name, arguments, kinds, refs): tool calls of the assistant's messages.

    arguments is canonical JSON, kinds the types of the arguments by name, null if they are no object, refs the calls they refer to.
    """
    mine = messages.filter((F.col("role") == "assistant") & F.contains(F.coalesce("text", F.lit("")), F.lit('"tool_calls"')))
    parsed = mine.select("conv_id", "turn", F.try_parse_json("text").alias("_v"))
    rows = parsed.select("conv_id", "turn", F.posexplode(_part("_v", "$.tool_calls", "array<variant>")).alias("seq", "_c"))
    rows = rows.select("conv_id", "turn", "seq", _part("_c", "$.id", "string").alias("call_id"), _part("_c", "$.name", "string").alias("name"),
                       _part("_c", "$.arguments").alias("_a"))
    named = rows.withColumn("_m", _part("_a", "$", "map<string,variant>"))
    kinds = F.transform_values("_m", lambda k, v: _kind(v))
    refs = F.transform(F.filter(F.map_values("_m"), lambda v: _kind(v) == "reference"), lambda v: v.cast("string"))
    return named.select(
        "conv_id", "turn", "seq", "call_id", "name", F.to_json("_a").alias("arguments"), kinds.alias("kinds"),
        F.array_distinct(F.transform(refs, lambda r: F.substring(r, F.lit(2), F.length(r)))).alias("refs"),
    )


def validated(calls: DataFrame, schemas: DataFrame) -> DataFrame:
    """calls with problem: null, "unknown tool", "no object", "missing <argument>" or "type of <argument>", the first in the order of names.

    A reference to another call fits any type, an integer fits number, a null argument is missing where it is required and fits any type elsewhere, and arguments
    that the schema does not name are no problem.
    """
    known = schemas.select(F.col("name").alias("_tool"), "required", "types")
    joined = calls.join(known, F.col("name") == F.col("_tool"), "left")
    given = F.map_filter(F.coalesce("kinds", F.create_map().cast("map<string,string>")), lambda k, v: v != "null")
    missing = F.array_sort(F.filter(F.coalesce("required", F.array().cast("array<string>")), lambda a: given[a].isNull()))
    wrong = F.filter(F.array_sort(F.map_keys(given)), lambda a: (
        F.col("types")[a].isNotNull() & (given[a] != "reference") & (given[a] != F.col("types")[a])
        & ~((F.col("types")[a] == "number") & (given[a] == "integer"))
    ))
    problem = (
        F.when(F.col("_tool").isNull(), "unknown tool")
        .when(F.col("kinds").isNull() & (F.col("arguments") != "null"), "no object")
        .when(F.size(missing) > 0, F.concat(F.lit("missing "), F.try_element_at(missing, F.lit(1))))
        .when(F.size(wrong) > 0, F.concat(F.lit("type of "), F.try_element_at(wrong, F.lit(1))))
    )
    return joined.withColumn("problem", problem).drop("_tool", "required", "types")


def reference_order(refs: dict[str, list[str]], ahead: dict[str, int]) -> dict[str, tuple[int | None, bool]]:
    """{call: (first place behind all calls it refers to, whether it lies on a cycle)} of calls and what they refer to.

    Strongly connected parts in the order in which they come out, each after all that it refers to; time and memory are linear in calls
    and references. A call on a cycle keeps its place, ahead, and what refers to it follows that.
    """
    number: dict[str, int] = {}
    low: dict[str, int] = {}
    last: dict[str, int] = {}
    found: dict[str, tuple[int | None, bool]] = {}
    open_calls: list[str] = []
    for root in refs:
        if root in number:
            continue
        number[root] = low[root] = len(number)
        open_calls.append(root)
        work = [(root, iter(refs[root]))]
        while work:
            call, rest = work[-1]
            for other in rest:
                if other not in number:
                    number[other] = low[other] = len(number)
                    open_calls.append(other)
                    work.append((other, iter(refs[other])))
                    break
                if other not in found:
                    low[call] = min(low[call], number[other])
            else:
                work.pop()
                if work:
                    low[work[-1][0]] = min(low[work[-1][0]], low[call])
                if low[call] == number[call]:
                    part = [open_calls.pop()]
                    while part[-1] != call:
                        part.append(open_calls.pop())
                    cyclic = len(part) > 1 or call in refs[call]
                    for member in part:
                        due = None if cyclic else max((last[o] + 1 for o in refs[member]), default=None)
                        last[member] = max(ahead[member], due or ahead[member])
                        found[member] = (due, cyclic)
    return found


_ORDERED = pa.schema([("conv_id", pa.int64()), ("call_id", pa.string()), ("due", pa.int64()), ("cyclic", pa.bool_())])


def _ordered_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Orders the parts one after another, as they come sorted; a part is held until its last row."""
    key, refs, ahead, conv = None, {}, {}, None

    def done() -> pa.RecordBatch:
        order = reference_order(refs, ahead)
        columns = [[conv] * len(order), list(order), [d for d, _ in order.values()], [c for _, c in order.values()]]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ORDERED)], schema=_ORDERED)

    for batch in batches:
        for row in batch.to_pylist():
            if row["part"] != key:
                if refs:
                    yield done()
                key, refs, ahead, conv = row["part"], {}, {}, row["conv_id"]
            refs[row["call_id"]], ahead[row["call_id"]] = row["refs"], row["ahead"]
    if refs:
        yield done()


def ordered(calls: DataFrame) -> DataFrame:
    """calls with place, a number after that of every call it refers to, and cyclic for calls on a cycle of references.

    A call starts at turn * ROOM + seq and moves behind what it refers to. A call on a cycle keeps its own turn and is called
    cyclic; calls that refer to it follow it. Only conversations in which a call refers to a later one are looked at. Their calls are ordered
    in tasks by the parts that references connect, a row of identifiers for each call, so neither the length of a conversation nor that of a
    chain multiplies rows.
    """
    start = (F.col("turn") * ROOM + F.col("seq")).alias("place")
    state = materialize(calls.select("conv_id", "call_id", "turn", "seq", start).filter(F.col("call_id").isNotNull()), "call-places")
    needs = calls.select("conv_id", F.col("call_id").alias("a"), F.explode("refs").alias("b")).distinct()
    ahead = state.groupBy("conv_id", F.col("call_id").alias("b")).agg(F.max("place").alias("ahead"))
    own = state.groupBy("conv_id", F.col("call_id").alias("a")).agg(F.min("place").alias("own"))
    edges = materialize(needs.join(ahead, ["conv_id", "b"]).join(own, ["conv_id", "a"]), "call-references")
    late = edges.filter("ahead >= own").select("conv_id").distinct()
    if late.isEmpty():
        return state.withColumn("cyclic", F.lit(False))
    edges = materialize(edges.join(late, "conv_id", "left_semi").select("conv_id", "a", "b"), "call-references")

    def node(call: str) -> Column:
        return F.concat(F.col("conv_id").cast("string"), F.lit(":"), F.col(call))

    parts = components(edges.select(node("a").alias("a"), node("b").alias("b")))
    refs = edges.groupBy("conv_id", F.col("a").alias("call_id")).agg(F.collect_set("b").alias("refs"))  # the arguments of one call
    nodes = edges.select("conv_id", F.col("a").alias("call_id")).union(edges.select("conv_id", "b")).distinct()
    rows = nodes.join(refs, ["conv_id", "call_id"], "left").join(ahead.withColumnRenamed("b", "call_id"), ["conv_id", "call_id"]).withColumn(
        "node", node("call_id")).join(parts, "node", "left")
    rows = rows.select(F.coalesce("component", "node").alias("part"), "conv_id", "call_id",
                       F.coalesce("refs", F.array().cast("array<string>")).alias("refs"), "ahead")
    found = rows.repartition("part").sortWithinPartitions("part").mapInArrow(_ordered_parts, "conv_id bigint, call_id string, due bigint, cyclic boolean")
    return state.join(found, ["conv_id", "call_id"], "left").select(
        "conv_id", "call_id", "turn", "seq", F.greatest("place", "due").alias("place"), F.coalesce("cyclic", F.lit(False)).alias("cyclic")
    )


def format_chats(messages: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row per row of messages (conv_id, turn, role, text): conv_id, turn, role, place, call_ids, linked, problem, json.

    place numbers the messages of a conversation in their new order, ties going by turn, role and text. call_ids are the calls a message
    makes or answers; linked is true for a call message if all its calls have a result and for a result if its
    call is there (identifiers are unique in a conversation; of repeated ones the least turn counts), null for other messages. problem is the
    first problem of a message: of its calls' arguments (see validated), "cycle", or "no call". json is
    canonical; contents that are no strings keep their types as well. Null ids, turns, roles and texts are kept: a null text gives a null content, a message with a null conversation links to
    nothing. A text that is no valid JSON, or names a key twice, is plain content. Repeated messages are kept; no rows give no rows.
    """
    rows = messages.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), "role", "text")
    calls = materialize(validated(calls_of(rows), schemas), "calls")
    places = ordered(calls)
    tools = rows.filter(F.col("role") == "tool").select("conv_id", F.try_parse_json("text").alias("_v"))
    answers = tools.select("conv_id", _part("_v", "$.tool_call_id", "string").alias("call_id"))
    answered = answers.filter(F.col("call_id").isNotNull()).select("conv_id", "call_id").distinct().withColumn("answered", F.lit(True))
    first = places.groupBy("conv_id", "call_id").agg(F.min(F.struct("turn", "place", "cyclic")).alias("f")).select("conv_id", "call_id", "f.place", "f.cyclic")

    described = calls.join(places.select("conv_id", "call_id", "turn", "seq", "place", "cyclic").distinct(), ["conv_id", "call_id", "turn", "seq"], "left")
    described = described.join(answered, ["conv_id", "call_id"], "left")
    fault = F.coalesce(F.when(F.col("cyclic"), "cycle"), F.col("problem"))
    call_json = _object({
        "arguments": F.coalesce("arguments", F.lit("{}")), "id": quoted(F.col("call_id")), "name": quoted(F.col("name")),
    })
    by_message = described.groupBy("conv_id", "turn").agg(
        F.max(F.coalesce("place", F.col("turn") * ROOM + F.col("seq"))).alias("call_place"),
        F.sort_array(F.collect_set(F.struct("seq", F.col("call_id").alias("id"), call_json.alias("json")))).alias("made"),
        F.min(F.struct(fault.isNull().alias("fine"), "seq", fault.alias("fault")))["fault"].alias("fault"),
        F.min(F.coalesce("answered", F.lit(False))).alias("all_answered"),
    ).withColumnsRenamed({"conv_id": "_conv", "turn": "_turn"})
    makes = (F.col("role") == "assistant") & F.col("made").isNotNull()
    read = rows.withColumn("_v", F.when(F.col("role").isin("assistant", "tool"), F.try_parse_json("text")))
    read = read.select(
        "conv_id", "turn", "role", "text", F.to_json(_part("_v", "$.content")).alias("_content"),
        F.when(F.col("role") == "tool", _part("_v", "$.tool_call_id", "string")).alias("own_call"),
    )
    joined = read.join(
        by_message, (F.col("conv_id") == F.col("_conv")) & (F.col("turn") == F.col("_turn")), "left"
    ).join(
        first.withColumnsRenamed({"conv_id": "_c", "call_id": "_id", "place": "its_place", "cyclic": "its_cycle"}),
        (F.col("conv_id") == F.col("_c")) & (F.col("own_call") == F.col("_id")), "left",
    )
    content = F.when(makes | F.col("own_call").isNotNull(), F.col("_content")).otherwise(quoted(F.col("text")))
    fields = {
        "content": F.coalesce(content, F.lit("null")), "role": F.coalesce(quoted(F.col("role")), F.lit("null")),
        "tool_call_id": quoted(F.col("own_call")),
        "tool_calls": F.when(makes, F.concat(F.lit("["), F.array_join(F.transform("made", lambda m: m["json"]), ","), F.lit("]"))),
    }
    at = F.when(makes, F.col("call_place")).when(
        F.col("its_place").isNotNull(), F.greatest(F.col("turn") * ROOM, F.col("its_place") + 1)
    ).otherwise(F.col("turn") * ROOM)
    final = joined.select(
        "conv_id", "turn", "role", "text", at.alias("at"),
        F.when(makes, F.transform("made", lambda m: m["id"])).when(F.col("own_call").isNotNull(), F.array("own_call")).alias("call_ids"),
        F.when(makes, F.col("all_answered")).when(F.col("own_call").isNotNull(), F.col("_id").isNotNull()).alias("linked"),
        F.when(makes, F.col("fault")).when(F.col("own_call").isNotNull() & F.col("_id").isNull(), "no call").alias("problem"),
        _object(fields).alias("json"),
    )
    return numbered(final).select("conv_id", "turn", "role", "place", "call_ids", "linked", "problem", "json")


def numbered(rows: DataFrame, turns_per_part: int = 1_000) -> DataFrame:
    """rows (conv_id, at, ...) with place, their number from 0 in their conversation; a long conversation is numbered in parts.

    A part holds the rows of some turns, and parts start where those before them end.
    """
    parted = materialize(rows.withColumn("_part", F.floor(F.col("at") / ROOM / turns_per_part)), "chat-rows")
    inside = Window.partitionBy("conv_id", "_part").orderBy("at", "turn", "role", "text")
    before = Window.partitionBy("conv_id").orderBy(F.col("_part").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    starts = parted.groupBy("conv_id", "_part").count().select(
        F.col("conv_id").alias("_c"), F.col("_part").alias("_p"), F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start")
    )
    placed = parted.withColumn("_n", F.row_number().over(inside) - 1)
    return placed.join(starts, F.col("conv_id").eqNullSafe(F.col("_c")) & F.col("_part").eqNullSafe(F.col("_p"))).withColumn(
        "place", (F.col("_start") + F.col("_n")).cast("bigint")
    ).drop("_c", "_p", "_start", "_n", "_part")
