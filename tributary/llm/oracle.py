"""The registered queries of this package as DuckDB SQL, where SQL can express them."""

from __future__ import annotations

WORDS = r"regexp_extract_all(text, '[^\x20\x09-\x0D]+')"



def _mixing() -> str:
    """The tree is filled level by level, as in the operator."""
    levels = ["domain", "lang", "source"]
    weights = {
        "domain": "CASE domain WHEN 'web' THEN 2 WHEN 'reference' THEN 3 ELSE 1 END",
        "lang": "CASE WHEN domain = 'web' AND lang = 'en' THEN 4 WHEN domain = 'reference' AND lang = 'es' THEN 5 ELSE 1 END",
        "source": "1",
    }
    steps, given = [], "(SELECT floor(sum(tokens) * 0.9)::BIGINT AS given FROM leaves)"
    for depth, level in enumerate(levels, 1):
        path, parent = ", ".join(levels[:depth]), ", ".join(levels[: depth - 1])
        group = f"PARTITION BY {parent} " if parent else ""
        joined = f"JOIN {given} USING ({parent})" if parent else f"CROSS JOIN {given}"
        steps.append(f"""
children{depth} AS (
  SELECT {path}, capacity, {weights[level]} AS weight, given
  FROM (SELECT {path}, sum(tokens * 2)::BIGINT AS capacity FROM leaves GROUP BY {path}) {joined}),
levels{depth} AS (
  SELECT *, (given - coalesce(sum(capacity) OVER ({group}ORDER BY capacity / weight, {level}
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / sum(weight) OVER ({group}ORDER BY capacity / weight, {level} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM children{depth}),
budgets{depth} AS (
  SELECT {path}, least(capacity, greatest(floor(max(level) OVER ({group}) * weight)::BIGINT, 0)) AS given FROM levels{depth})""")
        given = f"budgets{depth}"
    return rf"""
WITH numbered AS (SELECT *, TRY_CAST(regexp_extract(source, '^src([0-9]+)$', 1) AS INT) AS number FROM documents),
counted AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    CASE WHEN number = 0 THEN 'web' WHEN number < 10 THEN 'reference' ELSE 'forum' END AS domain,
    coalesce(len({WORDS}), 0)::BIGINT AS n_tokens
  FROM numbered),
leaves AS (
  SELECT domain, lang, source, sum(n_tokens)::BIGINT AS tokens FROM counted
  GROUP BY domain, lang, source HAVING sum(n_tokens) > 0),{",".join(steps)},
plan AS (SELECT domain, lang, source, given // tokens AS whole, given % tokens AS rest FROM leaves JOIN budgets3 USING (domain, lang, source)),
keyed AS (SELECT *, md5('7:' || (whole + 1) || ':' || doc_id) AS key FROM counted JOIN plan USING (domain, lang, source)),
summed AS (
  SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY key ROWS UNBOUNDED PRECEDING) AS reached FROM keyed)
SELECT doc_id, domain, lang, source, n_tokens, (whole + CASE WHEN reached <= rest THEN 1 ELSE 0 END)::BIGINT AS copies
FROM summed WHERE whole + CASE WHEN reached <= rest THEN 1 ELSE 0 END > 0"""


def _repair() -> str:
    """Row by row, the least (cost, audit) of each state of the pattern, with its text."""

    def way(source: str, cost: str, edit: str, turn: str | None, first: bool = False) -> str:
        """A way one edit longer; ``first`` says that no turn stands before it."""
        text = f"{source}.text" if turn is None else turn if first else f"{source}.text || chr(10) || {turn}"
        return f"{{'cost': {source}.cost + {cost}, 'audit': {source}.audit || '{edit}', 'text': {text}}}"

    def least(*ways: tuple[str, str]) -> str:
        """The least of those ways whose source exists and whose condition holds."""
        listed = ", ".join(f"CASE WHEN {condition} THEN {way} END" for condition, way in ways)
        return f"list_sort(list_filter([{listed}], lambda x: x IS NOT NULL))[1]"

    def there(source: str, condition: str = "true") -> str:
        return f"{source} IS NOT NULL AND {condition}"

    def closed(a: str, b: str, c: str, d: str, name: str, rest: str) -> str:
        """Ways after inserted turns: first into a user turn, then into an assistant turn."""
        after_user = least(
            (there(c), c),
            (there(a), way(a, "5", "I", "'user:'", True)),
            (there(b), way(b, "5", "I", "'user:'")),
            (there(d), way(d, "5", "I", "'user:'")),
        )
        half = f"SELECT {rest}, {a} AS e0, {b} AS e1, {after_user} AS e2, {d} AS e3 FROM {name}"
        then = least((there("e3"), "e3"), (there("e2"), way("e2", "5", "I", "'assistant:'")))
        return f"SELECT * EXCLUDE (e3), {then} AS e3 FROM ({half})"

    extra = "CASE WHEN fault = 3 THEN 5 ELSE 0 END"
    paid = f"1 + {extra}"
    own, user, assistant = "role || ':' || body", "'user:' || body", "'assistant:' || body"
    live, gone = "fault IN (0, 3)", "2"
    moved = {
        "s0": least((there("e0"), way("e0", gone, "D", None))),
        "s1": least(
            (there("e1"), way("e1", gone, "D", None)),
            (there("e0", f"{live} AND initial = 's'"), way("e0", extra, "K", own, True)),
        ),
        "s2": least(
            (there("e2"), way("e2", gone, "D", None)),
            (there("e0", f"{live} AND initial = 'u'"), way("e0", extra, "K", own, True)),
            (there("e0", live), way("e0", paid, "R", user, True)),
            *[(there(e, f"{live} AND initial = 'u'"), way(e, extra, "K", own)) for e in ("e1", "e3")],
            *[(there(e, live), way(e, paid, "R", user)) for e in ("e1", "e3")],
        ),
        "s3": least(
            (there("e3"), way("e3", gone, "D", None)),
            (there("e2", f"{live} AND initial = 'a'"), way("e2", extra, "K", own)),
            (there("e2", live), way("e2", paid, "R", assistant)),
        ),
    }
    ways = ", ".join(f"{value} AS {name}" for name, value in moved.items())
    kind = "STRUCT(cost BIGINT, audit VARCHAR, text VARCHAR)"
    return rf"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
checks AS (
  SELECT name, xor(list_reduce([4294967295::BIGINT] || [ascii(c)::BIGINT FOR c IN string_split(name, '')],
    lambda crc, byte: list_reduce([xor(crc, byte)] || [0::BIGINT FOR k IN range(8)],
      lambda v, z: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::BIGINT) ELSE v >> 1 END)), 4294967295::BIGINT) % 20 AS kind
  FROM (SELECT DISTINCT name FROM keyed)),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS body,
    unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM keyed JOIN checks USING (name) WHERE kind <> 0),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, body, copy) AS pos,
    row_number() OVER (PARTITION BY conv_id, role, body ORDER BY turn NULLS FIRST, copy) AS again,
    regexp_extract(body, '([^ 	-
])[ 	-
]*$', 1) AS ending
  FROM damaged),
rows AS (
  SELECT conv_id, turn, pos, role, left(role, 1) AS initial, body,
    CASE WHEN ending = '' THEN 1 WHEN again > 1 THEN 2 WHEN ending NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS earlier
  FROM numbered),
ends AS (SELECT conv_id, max(pos) AS last FROM rows GROUP BY conv_id),
walk AS (
  SELECT conv_id, 0::BIGINT AS pos, {{'cost': 0::BIGINT, 'audit': '', 'text': ''}}::{kind} AS s0,
    NULL::{kind} AS s1, NULL::{kind} AS s2, NULL::{kind} AS s3 FROM ends
  UNION ALL
  SELECT conv_id, pos, {", ".join(f"{s}::{kind} AS {s}" for s in moved)}
  FROM (SELECT conv_id, pos, {ways}
        FROM (SELECT w.*, r.role, r.initial, r.body, r.fault
              FROM ({closed("s0", "s1", "s2", "s3", "walk", "conv_id, pos + 1 AS pos")}) w
              JOIN rows r ON r.pos = w.pos AND r.conv_id IS NOT DISTINCT FROM w.conv_id))),
finished AS ({closed("s0", "s1", "s2", "s3", "(SELECT walk.* FROM walk JOIN ends ON walk.conv_id IS NOT DISTINCT FROM ends.conv_id AND pos = last)", "conv_id")}),
best AS (SELECT conv_id, {least((there("e0"), "e0"), (there("e3"), "e3"))} AS way FROM finished),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank,
    count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
    count(*) FILTER (earlier || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM rows GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(way.cost, 0)::BIGINT AS cost,
  coalesce(way.audit, '') AS audit, sha256(coalesce(way.text, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN counts ON c.conv_id IS NOT DISTINCT FROM counts.conv_id
LEFT JOIN best ON c.conv_id IS NOT DISTINCT FROM best.conv_id"""


QUERIES = {
    "op1_decontaminate": r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM item_windows),
doc_windows AS (
  SELECT doc_id, i, size, array_to_string(w[i : i + size - 1], ' ') AS g
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM docs, sizes WHERE len(w) >= size)),
hits AS (SELECT doc_id, i, d.size, item_id FROM doc_windows d JOIN item_windows t ON d.g = t.g AND d.size = t.size),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hits) GROUP BY doc_id),
listed AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
  sha256(string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR)) AS s FROM hits GROUP BY doc_id)
SELECT doc_id, coalesce(len(w), 0)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, coalesce(s, sha256('')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (doc_id) LEFT JOIN listed USING (doc_id)""",
    "op5_quality_cascade": rf"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
worded AS (SELECT doc_id, text, {WORDS} AS w FROM docs),
lines AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
grams AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM worded)),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM grams) WHERE n > 1),
repeated AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY doc_id),
measured AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    length(regexp_replace(text, '[^!]', '', 'g')) AS marks, coalesce(n_lines, 0) AS n_lines,
    coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM worded LEFT JOIN repeated USING (doc_id) LEFT JOIN lines USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 10 * n_symbols > n_words OR 2 * marks > n_words
    OR 10 * n_dup_lines > 5 * n_lines OR word_chars < 2 * n_words OR word_chars > 20 * n_words) AS kept
FROM measured""",
    "op8_line_dedup": r"""
WITH every AS (
  SELECT doc_id, line_no, lines[line_no + 1] AS line
  FROM (SELECT doc_id, lines, unnest(range(0, len(lines))) AS line_no
        FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents))),
long AS (SELECT *, length(line) AS n FROM every WHERE length(line) >= 1),
firsts AS (SELECT line, n, min(doc_id * 1000000 + line_no) AS place FROM long GROUP BY line, n),
cells AS (
  SELECT line, n, place, s, 0 AS side, left(line, s // 2) AS half FROM (SELECT *, unnest([n, n - 1]) AS s FROM firsts)
  UNION ALL
  SELECT line, n, place, s, 1, right(line, s - s // 2) FROM (SELECT *, unnest([n, n - 1]) AS s FROM firsts)),
near AS (
  SELECT a.line, min(b.place) AS place FROM cells a JOIN cells b
    ON a.s = b.s AND a.side = b.side AND a.half = b.half AND a.line <> b.line
  -- levenshtein counts bytes, an edit is of a character: up to four bytes are looked at by character
  WHERE levenshtein(a.line, b.line) <= 4 AND (levenshtein(a.line, b.line) <= 1 OR len(list_filter(
    range(0, greatest(a.n, b.n)), lambda i: left(a.line, i) = left(b.line, i)
      AND substr(a.line, i + 1 + (a.n >= b.n)::INT) = substr(b.line, i + 1 + (b.n >= a.n)::INT))) > 0)
  GROUP BY a.line),
earliest AS (SELECT line, least(firsts.place, coalesce(near.place, firsts.place)) AS place FROM firsts LEFT JOIN near USING (line)),
gone AS (
  SELECT doc_id, count(*) AS n_removed, string_agg(line_no::VARCHAR, ',' ORDER BY line_no) AS removed
  FROM long JOIN earliest USING (line) WHERE place < doc_id * 1000000 + line_no GROUP BY doc_id)
SELECT doc_id, coalesce(len(string_split(text, chr(10))), 0)::BIGINT AS n_lines,
  coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(removed, '') AS removed
FROM documents LEFT JOIN gone USING (doc_id)""",
    "op9_mixing": _mixing(),
    "op10_substring_dedup": rf"""
WITH worded AS (SELECT doc_id, coalesce({WORDS}, []) AS w FROM documents),
windows AS (SELECT doc_id, i, array_to_string(w[i : i + 12], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM worded WHERE len(w) >= 13)),
firsts AS (SELECT g, min(doc_id) AS first FROM windows GROUP BY g HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT DISTINCT doc_id, p FROM (
  SELECT doc_id, unnest(range(i, i + 13)) AS p FROM windows JOIN firsts USING (g) WHERE first < doc_id)),
each AS (SELECT doc_id, p, w[p] AS word FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM worded)),
kept AS (
  SELECT each.doc_id, string_agg(word, ' ' ORDER BY each.p) FILTER (gone.p IS NULL) AS text, count(gone.p) AS n_removed
  FROM each LEFT JOIN gone ON each.doc_id = gone.doc_id AND each.p = gone.p GROUP BY each.doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
  sha256(coalesce(kept.text, '')) AS kept_sha256
FROM worded LEFT JOIN kept USING (doc_id)""",
    "op11_filter_audit": rf"""
WITH RECURSIVE worded AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS part, coalesce({WORDS}, []) AS w FROM documents),
firsts AS (SELECT text, min(doc_id) AS first FROM worded GROUP BY text),
judged AS (
  SELECT doc_id, part, (CASE WHEN len(w) < 100 THEN 1 ELSE 0 END)
    + (CASE WHEN 100 * list_unique(w) < 80 * len(w) THEN 2 ELSE 0 END)
    + (CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) THEN 4 ELSE 0 END)
    + (CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END)
    + (CASE WHEN doc_id > first THEN 16 ELSE 0 END) AS mask
  FROM worded JOIN firsts USING (text)),
told AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
cells AS (
  SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM judged LEFT JOIN told USING (doc_id) GROUP BY part, mask),
orders AS (
  SELECT '' AS o
  UNION ALL
  SELECT o || f FROM orders, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f) WHERE NOT contains(o, f)),
steps AS (
  SELECT o AS filter_order, step, substr(o, step, 1) AS filter, 1 << (ascii(substr(o, step, 1)) - 65) AS bit,
    list_sum([0] || [1 << (ascii(substr(o, e, 1)) - 65) FOR e IN range(1, step)])::BIGINT AS gone
  FROM (SELECT o, unnest(range(1, 6)) AS step FROM orders WHERE length(o) = 5)),
counted AS (
  SELECT part, filter_order, step, filter,
    sum(CASE WHEN mask & (gone | bit) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN mask & bit > 0 AND mask & gone = 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN mask & bit > 0 AND mask & gone > 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN mask & bit > 0 AND mask & gone = 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN mask & bit > 0 AND mask & gone = 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM cells, steps GROUP BY part, filter_order, step, filter)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
  unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
  (sum(removed) OVER (PARTITION BY part, filter))::BIGINT AS shapley
FROM counted""",
    "op12_suffix_dedup": r"""
WITH docs AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
parts AS (
  SELECT doc_id, base, substr(h, 2 * base + 1, 1598) AS part
  FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 399, 400)) AS base FROM docs WHERE length(h) >= 800)),
starts AS (
  SELECT doc_id, base + i AS i, md5(substr(part, 2 * i + 1, 800)) AS m
  FROM (SELECT doc_id, base, part, unnest(range(0, length(part) // 2 - 399)) AS i FROM parts)),
again AS (SELECT m FROM starts GROUP BY m HAVING count(*) > 1),
hits AS (SELECT doc_id, i FROM starts SEMI JOIN again USING (m)),
marked AS (
  SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 400 THEN 0 ELSE 1 END AS new FROM hits),
grouped AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM marked),
spans AS (SELECT doc_id, span, min(i) AS lo, max(i) + 400 AS hi FROM grouped GROUP BY doc_id, span),
cut AS (
  SELECT doc_id, count(*) AS n_spans, sum(hi - lo) AS n_removed, list(lo ORDER BY lo) AS los, list(hi ORDER BY lo) AS his
  FROM spans GROUP BY doc_id)
SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(CASE WHEN n_spans IS NULL THEN h ELSE array_to_string(
    [substr(h, 2 * (CASE WHEN j = 1 THEN 0 ELSE his[j - 1] END) + 1,
      2 * ((CASE WHEN j > n_spans THEN length(h) // 2 ELSE los[j] END) - (CASE WHEN j = 1 THEN 0 ELSE his[j - 1] END)))
     FOR j IN range(1, n_spans + 2)], '') END)) AS kept_sha256
FROM docs LEFT JOIN cut USING (doc_id)""",
    "op13_conversation_repair": _repair(),
}
