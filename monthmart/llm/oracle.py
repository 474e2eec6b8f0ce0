"""SQL for the queries that SQL can express, over the same tables. Written over word lists and text windows, without hashes."""

from __future__ import annotations

from . import codes
from .chat import ROOM
from .decontamination import LEAST_SHARE, NAME_MARK, WINDOW
from .lexicon import NAMES, NUMBERS, UNITS
from .text import BETWEEN, LOWER, UPPER


def _in(word: str, listed: list[str]) -> str:
    return f"{word} IN ({', '.join(repr(x) for x in listed)})"


def _words(text: str) -> str:
    mark = f"'([a-z,] )([A-Z])([a-z])', '\\1{NAME_MARK}\\2\\3', 'g'"
    # Twice, as a match takes the letter before the next one.
    marked = f"regexp_replace(regexp_replace(coalesce({text}, ''), {mark}), {mark})"
    return f"list_filter(string_split_regex(lower({marked}), '{BETWEEN}'), lambda t: t <> '')"


def _canonical(word: str) -> str:
    listed = f"WHEN {_in('{w}', NUMBERS)} THEN '<num>' WHEN {_in('{w}', NAMES)} THEN '<name>' WHEN {_in('{w}', UNITS)} THEN '<unit>'"
    bare = f"ltrim({word}, '{NAME_MARK}')"
    return (
        f"CASE {listed.replace('{w}', word)} WHEN regexp_full_match({word}, '[0-9]+(st|nd|rd|th)?') THEN '<num>' "
        f"WHEN starts_with({word}, '{NAME_MARK}') THEN CASE {listed.replace('{w}', bare)} ELSE '<name>' END ELSE {word} END"
    )


# Windows of n words of words w with canonical forms c: h is told by the words themselves where all are placeholders.
_WINDOWS = f"""SELECT {{keys}}, k, list_transform(held, lambda j: w[j]) AS {{name}}, CASE WHEN len(held) = n
      THEN 'own ' || array_to_string(list_transform(w[k:k + n - 1], lambda t: ltrim(t, '{NAME_MARK}')), ' ')
      ELSE array_to_string(c[k:k + n - 1], ' ') END AS h
  FROM (SELECT *, list_filter(range(k, k + n), lambda j: c[j] <> w[j]) AS held FROM (
    SELECT *, unnest(range(1, len(w) - n + 2)) AS k FROM {{source}}))"""

# --- vector codes: the rounds written out, distances as whole numbers in doubles -----------------------

_PARTS, _ENTRIES, _ROUNDS, _SCALE = codes.PARTS, codes.ENTRIES, codes.ROUNDS, codes.SCALE


def _assigned(entries: str) -> str:
    distance = "list_inner_product(x, x) + list_inner_product(e, e) - 2 * list_inner_product(x, e)"
    return f"SELECT r, p, x, min({distance}) AS d, arg_min(i, ({distance}) * {_ENTRIES} + i) AS i FROM part JOIN {entries} USING (p) GROUP BY r, p, x"


def _moved(assigned: str, entries: str) -> str:
    return f"""SELECT p, i, coalesce(m, e) AS e FROM {entries} LEFT JOIN (
    SELECT p, i, list(floor(s / n) ORDER BY k) AS m FROM (
      SELECT p, i, k, sum(y) AS s, count(*) AS n FROM (
        SELECT p, i, unnest(x) AS y, generate_subscripts(x, 1) AS k FROM {assigned}) GROUP BY ALL) GROUP BY p, i) USING (p, i)"""


_VECTOR_ROUNDS = "".join(
    f"  a{t} AS MATERIALIZED ({_assigned(f'e{t}')}),\n  e{t + 1} AS MATERIALIZED ({_moved(f'a{t}', f'e{t}')}),\n" for t in range(_ROUNDS)
)

# --- spelling -------------------------------------------------------------------------------------------

# One byte of the checksum: eight shifts, each of which folds the polynomial in where a one falls out.
_CRC = """xor(list_reduce(list_concat([4294967295], bytes), lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
    lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295)"""

ORACLE = {
    "op6_chat": f"""
WITH RECURSIVE c AS (SELECT conv_id, turn AS own, (turn // 2) % 4 AS k, turn * 4 + CASE WHEN turn % 3 = 0 THEN 2 ELSE 0 END AS turn,
    text, length(text) AS n, conv_id % 3 <> 0 OR (turn // 2) % 4 <> 1 AS answered,
    turn + CASE (turn // 2) % 4 WHEN 0 THEN 2 WHEN 1 THEN 4 WHEN 2 THEN -2 ELSE CASE WHEN conv_id % 5 = 0 THEN -6 END END AS other
  FROM conversations WHERE role = 'assistant'),
  edge AS (SELECT a.conv_id, a.own AS a, b.own AS b, b.turn * {ROOM} AS start FROM c a JOIN c b ON a.conv_id = b.conv_id AND a.other = b.own),
  reach AS (SELECT conv_id, a, b FROM edge UNION SELECT r.conv_id, r.a, e.b FROM reach r JOIN edge e ON r.conv_id = e.conv_id AND r.b = e.a),
  cyclic AS (SELECT conv_id, a FROM reach WHERE a = b),
  way AS (SELECT conv_id, a, b, start + 1 AS due, 1 AS n FROM edge ANTI JOIN cyclic USING (conv_id, a)
    UNION SELECT w.conv_id, w.a, e.b, e.start + w.n + 1, w.n + 1 FROM way w JOIN edge e ON w.conv_id = e.conv_id AND w.b = e.a
      WHERE NOT EXISTS (SELECT 1 FROM cyclic y WHERE y.conv_id = e.conv_id AND y.a = e.a)),
  placed AS (SELECT c.*, greatest(c.turn * {ROOM}, coalesce((SELECT max(due) FROM way w WHERE w.conv_id = c.conv_id AND w.a = c.own), 0)) AS place,
    EXISTS (SELECT 1 FROM cyclic y WHERE y.conv_id = c.conv_id AND y.a = c.own) AS cyc FROM c),
  m AS (SELECT conv_id, turn * 4 AS turn, role, text, turn * 4 * {ROOM} AS pos, NULL AS call_ids, NULL AS linked, NULL AS problem,
      '{{"content":' || coalesce(CAST(to_json(text) AS VARCHAR), 'null') || ',"role":' || CAST(to_json(role) AS VARCHAR) || '}}' AS json
    FROM conversations WHERE role IS NULL OR role <> 'assistant'
    UNION ALL SELECT conv_id, turn, 'assistant', NULL, place, 'c' || own, answered,
      CASE WHEN cyc THEN 'cycle' WHEN conv_id % 4 = 2 AND k = 3 THEN 'missing length' WHEN conv_id % 4 = 1 AND k = 2 THEN 'type of length' END,
      '{{"content":null,"role":"assistant","tool_calls":[{{"arguments":{{' || CASE WHEN other IS NULL THEN '' ELSE '"after":"$c' || other || '",' END
        || '"code":"' || own || '",' || CASE WHEN conv_id % 4 = 2 AND k = 3 THEN '' WHEN conv_id % 4 = 1 AND k = 2 THEN '"length":"' || n || '",'
          ELSE '"length":' || n || ',' END || '"meta":{{"a":"[draft] a]","z":[' || own || ',{{"x":null,"y":true}}]}},"quote":'
        || CAST(to_json(text[1:16]) AS VARCHAR) || ',"turn":' || own || '}},"id":"c' || own || '","name":"reply"}}]}}' FROM placed
    UNION ALL SELECT conv_id, own * 4 + 1, 'tool', text, greatest((own * 4 + 1) * {ROOM}, place + 1), 'c' || own, true, NULL,
      '{{"content":' || CAST(to_json(text) AS VARCHAR) || ',"role":"tool","tool_call_id":"c' || own || '"}}' FROM placed WHERE answered)
SELECT conv_id, turn, role, row_number() OVER (PARTITION BY conv_id ORDER BY pos, turn, role, text) - 1 AS place,
  CAST(call_ids AS VARCHAR) AS call_ids, CAST(linked AS BOOLEAN) AS linked, CAST(problem AS VARCHAR) AS problem, json FROM m""",
    "op10_decontamination": f"""
WITH item_words AS (SELECT *, len(w) AS size, least(len(w), {WINDOW}) AS n, list_transform(w, lambda t: {_canonical('t')}) AS c
    FROM (SELECT DISTINCT item_id, {_words('text')} AS w FROM benchmark) WHERE len(w) > 0),
  doc_forms AS MATERIALIZED (SELECT *, list_transform(w, lambda t: {_canonical('t')}) AS c
    FROM (SELECT doc_id, text, {_words('text')} AS w FROM (SELECT DISTINCT doc_id, text FROM documents))),
  doc_words AS (SELECT * FROM doc_forms, (SELECT DISTINCT n FROM item_words) WHERE len(w) >= n),
  iw AS ({_WINDOWS.format(keys='item_id, size', name='iv', source='item_words')}),
  dw AS ({_WINDOWS.format(keys='doc_id, text', name='dv', source='doc_words')}),
  met AS (SELECT dw.doc_id, dw.text, item_id, h, iv, dv, size, dw.k - iw.k AS shift FROM dw JOIN iw USING (h)),
  hits AS (SELECT DISTINCT doc_id, text, item_id, h, iv, dv, 0 AS scope, 0 AS step, 0 AS bucket FROM met
    UNION SELECT doc_id, text, item_id, h, iv, dv, 1, size, floor(shift / size) FROM met
    UNION SELECT doc_id, text, item_id, h, iv, dv, 2, size, floor((shift + size // 2) / size) FROM met),
  sizes AS (SELECT item_id, count(DISTINCT h) AS item_windows FROM iw GROUP BY item_id),
  found AS (SELECT doc_id, text, item_id, scope, step, bucket, count(DISTINCT h) AS found_windows,
      count(DISTINCT CASE WHEN dv = iv THEN h END) AS plain FROM hits GROUP BY ALL),
  pairs AS (SELECT DISTINCT doc_id, text, item_id, scope, step, bucket, ltrim(iv[j], '{NAME_MARK}') AS i, ltrim(dv[j], '{NAME_MARK}') AS d
    FROM (SELECT *, unnest(range(1, len(iv) + 1)) AS j FROM hits)),
  slots AS (SELECT doc_id, text, item_id, scope, step, bucket, count(DISTINCT i) AS slots, count(*) = count(DISTINCT i) AS consistent
    FROM pairs GROUP BY ALL),
  told AS (SELECT doc_id, text, item_id, item_windows, found_windows, coalesce(slots, 0) AS slots, coalesce(consistent, true) AS consistent
    FROM found JOIN sizes USING (item_id) LEFT JOIN slots USING (doc_id, text, item_id, scope, step, bucket)
    WHERE CASE WHEN coalesce(consistent, true) THEN found_windows ELSE plain END >= {LEAST_SHARE} * item_windows)
SELECT doc_id, item_id, item_windows, found_windows, CAST(found_windows AS DOUBLE) / item_windows AS share, slots, consistent
FROM told QUALIFY row_number() OVER (PARTITION BY doc_id, text, item_id ORDER BY found_windows DESC, consistent DESC, slots DESC) = 1""",
    "op11_vector_codes": f"""
WITH kept AS (SELECT vec_id, label, row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r,
    list_transform(embedding, lambda y: floor({_SCALE} * CAST(y AS DOUBLE))) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda y: y IS NULL OR NOT isfinite(y))) = 0),
  part AS MATERIALIZED (SELECT r, p, v[p * len(v) // {_PARTS} + 1:(p + 1) * len(v) // {_PARTS}] AS x
    FROM kept, range({_PARTS}) AS t(p)),
  e0 AS MATERIALIZED (SELECT p, r - 1 AS i, x AS e FROM part WHERE r <= {_ENTRIES}),
{_VECTOR_ROUNDS}  last AS MATERIALIZED ({_assigned(f'e{_ROUNDS}')}),
  coded AS (SELECT r, string_agg(printf('%02x', i), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM last GROUP BY r),
  books AS (SELECT sha256(string_agg(array_to_string(list_transform(e, lambda y: CAST(CAST(y AS BIGINT) AS VARCHAR)), ','), ',' ORDER BY p, i)) AS b
    FROM e{_ROUNDS})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, b AS codebooks_sha256
FROM kept JOIN coded USING (r), books""",
    "op13_spelling": f"""
WITH RECURSIVE runs AS MATERIALIZED (SELECT doc_id, w, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[a-zÀ-ÿ]+')) AS w FROM documents) GROUP BY ALL),
  summed AS MATERIALIZED (SELECT w, n, {_CRC} AS h FROM (
    SELECT w, n, list_transform(range(1, octet_length(encode(key)) + 1), lambda j: CAST('0x' || substr(hex(encode(key)), 2 * j - 1, 2) AS BIGINT)) AS bytes
    FROM (SELECT w, n, doc_id || ':' || w AS key FROM runs))),
  words AS MATERIALIZED (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % 97 = 0 THEN substr(w, 1, CAST(h % length(w) AS INT)) || substr(w, CAST(h % length(w) AS INT) + 2) ELSE w END AS word, n FROM summed)
    WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
  cut AS MATERIALIZED (SELECT word, n, j, substr(word, 1, j - 1) || substr(word, j + 1) AS rest
    FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS j FROM words)),
  near AS MATERIALIZED (
    SELECT a.word, b.word AS other, b.n FROM cut a JOIN cut b ON a.rest = b.rest AND a.j = b.j AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
    UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word),
  best AS (SELECT word, count(*) AS n_near, max(n) AS most FROM near GROUP BY word),
  formed AS MATERIALIZED (SELECT words.word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 2 * words.n THEN most END AS form_n,
      (SELECT min(other) FROM near WHERE near.word = words.word AND near.n = most AND most >= 2 * words.n) AS form
    FROM words LEFT JOIN best ON best.word = words.word),
  chain AS (SELECT word, form AS tip FROM formed WHERE form IS NOT NULL
    UNION ALL SELECT chain.word, formed.form FROM chain JOIN formed ON formed.word = chain.tip WHERE formed.form IS NOT NULL)
SELECT formed.word, form, coalesce(root, formed.word) AS root, n, n_near, form_n FROM formed LEFT JOIN (
  SELECT word, tip AS root FROM chain WHERE tip IN (SELECT word FROM formed WHERE form IS NULL)) r ON r.word = formed.word""",
}
