"""DuckDB SQL of the corpus queries that SQL can express."""

from podium.llm import decontamination as d
from podium.llm import url_filter

_URL = "translate(url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _hit(term: str) -> str:
    return f"CAST(regexp_matches(coalesce(u, ''), '(^|[^a-z0-9]){term}([^a-z0-9]|$)') AS INT)"


SQL = {
    "op3_url_filters": f"""
WITH raw AS (
  SELECT page_id, url, {_URL} AS u,
    CASE WHEN url LIKE '%://%' THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
cut AS (
  SELECT page_id, url, u,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
              'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM raw),
hits AS (
  SELECT page_id, url, host, path,
    {" + ".join(_hit(t) for t in url_filter.STRICT)} AS strict_hits,
    {" + ".join(f"{w} * {_hit(t)}" for t, w in url_filter.SOFT.items())} AS soft_weight
  FROM cut),
ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/en/1%' THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/es/%' THEN 'example.org/es/'
    WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/fr/%' THEN 'com/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/de/%' THEN 'com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/%' THEN 'org/' END AS rule
  FROM hits)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
       WHEN strict_hits > 0 OR soft_weight >= 2 THEN 'block' ELSE 'allow' END AS verdict,
  strict_hits, soft_weight
FROM ruled""",
    "op7_quality_rules": r"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS s FROM documents),
w AS (SELECT r, doc_id, s, regexp_extract_all(s, '[^\x20\x09-\x0D]+') AS words,
        list_filter(string_split(s, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
      FROM t),
u AS (SELECT r, unnest(range(1, len(words) - 1)) AS i, words FROM w WHERE len(words) >= 3),
g AS (SELECT r, i, count(*) OVER (PARTITION BY r, words[i], words[i + 1], words[i + 2]) AS n FROM u),
c AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM g WHERE n > 1)
      GROUP BY r),
m AS (
  SELECT w.doc_id, s, words, len(words) AS n_words, len(lines) AS n_lines,
    length(regexp_replace(s, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
    length(regexp_replace(s, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words
  FROM w LEFT JOIN c USING (r)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR word_chars < 2 * n_words OR word_chars > 15 * n_words OR 10 * n_symbols > n_words
    OR 2 * n_dup_lines > n_lines
    OR 10 * length(regexp_replace(s, '[^!]+', '', 'g')) > 3 * n_words
    OR len(regexp_extract_all(s, '(?:\.\.\.|…)[ \t]*(?:\n|$)')) > 0.3 * n_lines
    OR 2 * length(regexp_replace(s, '[^\p{Lu}]+', '', 'g')) > length(regexp_replace(s, '[^\p{L}]+', '', 'g'))
    OR 10 * len(list_filter(words, lambda x: regexp_matches(x, '\p{L}'))) < 7 * n_words
    OR 10 * len(list_distinct(words)) < n_words) AS kept
FROM b""",
    "op9_benchmark_decontamination": rf"""
WITH rows AS (
  SELECT 'd' AS side, doc_id AS id, row_number() OVER () AS r, text FROM documents WHERE text IS NOT NULL
  UNION ALL
  SELECT 'b', item_id, row_number() OVER (), text
  FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE text IS NOT NULL)),
raw AS (SELECT side, id, r, regexp_extract_all(regexp_replace(text, '{d.PUNCTUATION}', '', 'g'),
               '[^\x20\x09-\x0D]+') AS ws FROM rows),
tok AS (
  SELECT side, id, r, unnest(ws) AS w, unnest(range(len(ws))) AS pos FROM raw),
typed AS (
  SELECT side, id, r, pos, lower(w) AS p,
    CASE WHEN regexp_matches(w, '^(?i:{'|'.join(d.UNITS)})$')
          AND regexp_matches(lag(w, 1, '') OVER (PARTITION BY side, r ORDER BY pos), '[0-9]') THEN '#u'
         WHEN regexp_matches(w, '^\p{{Lu}}\p{{Ll}}') THEN '#p'
         WHEN regexp_matches(w, '[0-9]') THEN lower(regexp_extract(w, '^[^0-9]*')) || '#n'
         ELSE lower(w) END AS c
  FROM tok),
seq AS (SELECT * FROM typed),
win AS (
  SELECT side, id, r, pos,
    list(c) OVER x AS template, list(p) OVER x AS plain
  FROM seq WINDOW x AS (PARTITION BY side, r ORDER BY pos ROWS BETWEEN CURRENT ROW AND {d.WINDOW - 1} FOLLOWING)),
bw AS (
  SELECT DISTINCT id AS item_id, pos, template, plain FROM win
  WHERE side = 'b' AND len(template) = {d.WINDOW}
    AND 2 * len(list_filter(template, lambda x: contains(x, '#'))) <= {d.WINDOW}),
bs AS (SELECT *, count(*) OVER (PARTITION BY item_id) AS item_windows FROM bw),
hits AS (
  SELECT w.id AS doc_id, b.item_id, b.item_windows, w.pos - b.pos AS shift, b.pos, b.template,
    b.plain AS asked, w.plain AS found
  FROM win w JOIN bs b ON w.template = b.template WHERE w.side = 'd'),
slots AS (
  SELECT doc_id, item_id, item_windows, shift, pos, unnest(range(1, {d.WINDOW + 1})) AS j, template, asked, found
  FROM hits),
pairs AS (
  SELECT doc_id, item_id, item_windows, shift, pos,
    CASE WHEN contains(template[j], '#') THEN asked[j] END AS a, CASE WHEN contains(template[j], '#') THEN found[j] END AS f
  FROM slots),
checked AS (
  SELECT doc_id, item_id, item_windows, shift, count(DISTINCT pos) AS windows, count(DISTINCT a) AS slots,
    count(DISTINCT CASE WHEN a IS NOT NULL THEN [a, f] END) AS mappings,
    coalesce(max(CAST(a <> f AS INT)), 0) AS changed
  FROM pairs GROUP BY ALL)
SELECT doc_id, item_id, item_windows, max(windows) AS windows, max(slots) AS slots, min(changed) = 0 AS exact
FROM checked WHERE mappings = slots AND windows >= {d.MIN_SHARE} * item_windows GROUP BY ALL""",
}

SQL["op12_phrase_collocations"] = r"""
WITH pieces AS (
  SELECT doc_id, coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL
),
words AS (SELECT doc_id, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
totals AS (SELECT lang, CAST(sum(len(ws)) AS HUGEINT) AS n FROM words GROUP BY lang),
starts AS (SELECT doc_id, lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM words),
grams AS (
  SELECT doc_id, lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase
  FROM starts, (VALUES (1), (2), (3), (4), (5)) sizes(k) WHERE i + k - 1 <= len(ws)
),
counts AS (
  SELECT lang, k, phrase, CAST(count(*) AS HUGEINT) AS a, min(doc_id) AS first_doc
  FROM grams GROUP BY lang, k, phrase HAVING count(*) >= 100
),
cuts AS (
  SELECT c.*, j, array_to_string(string_split(c.phrase, ' ')[1:j], ' ') AS head,
         array_to_string(string_split(c.phrase, ' ')[j + 1:], ' ') AS rest
  FROM counts c, (VALUES (1), (2), (3), (4)) places(j) WHERE j < c.k
),
scored AS (
  SELECT c.lang, c.k, c.phrase, c.a, c.first_doc, c.j, l.a AS l, r.a AS r, t.n,
         (1000 * c.a * t.n) // (l.a * r.a) AS score
  FROM cuts c JOIN totals t ON t.lang = c.lang
  JOIN counts l ON l.lang = c.lang AND l.phrase = c.head
  JOIN counts r ON r.lang = c.lang AND r.phrase = c.rest
),
lowest AS (
  SELECT * FROM scored s
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
),
kept AS (
  SELECT * FROM lowest c WHERE NOT EXISTS (
    SELECT 1 FROM counts o WHERE o.lang = c.lang AND o.k > c.k AND 100 * o.a >= 100 * c.a
      AND contains(' ' || o.phrase || ' ', ' ' || c.phrase || ' '))
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS place FROM kept)
SELECT lang, CAST(place AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
       CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score, CAST(j AS INTEGER) AS cut, first_doc
FROM ranked WHERE place <= 2000
"""

SQL["op11_suffix_array_dedup"] = """
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS hx FROM documents),
windows AS (
  SELECT rid, i, md5(substr(hx, 2 * i + 1, 400)) AS h
  FROM (SELECT rid, hx, unnest(range(0, length(hx) // 2 - 199)) AS i FROM d WHERE length(hx) >= 400)
),
repeated AS (SELECT h FROM windows GROUP BY h HAVING count(*) > 1),
starts AS (SELECT rid, i FROM windows SEMI JOIN repeated USING (h)),
marked AS (
  SELECT rid, i, CASE WHEN i <= lag(i) OVER (PARTITION BY rid ORDER BY i) + 200 THEN 0 ELSE 1 END AS fresh FROM starts
),
runs AS (SELECT rid, i, sum(fresh) OVER (PARTITION BY rid ORDER BY i) AS run FROM marked),
spans AS (SELECT rid, run, min(i) AS lo, max(i) + 200 AS hi FROM runs GROUP BY rid, run),
sums AS (SELECT rid, sum(hi - lo) AS n_removed, count(*) AS n_spans FROM spans GROUP BY rid),
kept AS (
  SELECT rid, lo AS place, substr(hx, 2 * coalesce(lag(hi) OVER (PARTITION BY rid ORDER BY lo), 0) + 1,
                               2 * (lo - coalesce(lag(hi) OVER (PARTITION BY rid ORDER BY lo), 0))) AS part
  FROM spans JOIN d USING (rid)
  UNION ALL
  SELECT rid, length(hx), substr(hx, 2 * coalesce(last_hi, 0) + 1)
  FROM d LEFT JOIN (SELECT rid, max(hi) AS last_hi FROM spans GROUP BY rid) USING (rid)
),
texts AS (SELECT rid, string_agg(part, '' ORDER BY place) AS hx FROM kept GROUP BY rid)
SELECT d.doc_id, CAST(length(d.hx) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(texts.hx)) AS kept_sha256
FROM d JOIN texts USING (rid) LEFT JOIN sums USING (rid)
"""

SQL["op13_spelling_variants"] = """
WITH RECURSIVE crc_table AS (
  SELECT list(v ORDER BY i) AS t
  FROM (SELECT i, list_reduce(list_concat([i], [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, step:
               CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) r(i))
),
runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents)
  WHERE length(run) >= 6 GROUP BY ALL
),
hexed AS (SELECT *, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS hx FROM runs),
hashed AS (
  SELECT run, n, xor(list_reduce(list_concat([4294967295], list_transform(range(0, length(hx) // 2), lambda k:
             CAST('0x' || substr(hx, 2 * k + 1, 2) AS BIGINT))), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM hexed, crc_table
),
words AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n
  FROM hashed
),
vocabulary AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM words WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
),
deleted AS (
  SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM vocabulary)
),
near AS (
  SELECT a.word, b.word AS other FROM deleted a JOIN deleted b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT d.word, v.word FROM deleted d JOIN vocabulary v ON d.rest = v.word
  UNION SELECT v.word, d.word FROM deleted d JOIN vocabulary v ON d.rest = v.word
),
best AS (
  SELECT near.word, other, o.n AS other_n, count(*) OVER (PARTITION BY near.word) AS n_near
  FROM near JOIN vocabulary o ON o.word = other
  QUALIFY row_number() OVER (PARTITION BY near.word ORDER BY o.n DESC, other) = 1
),
forms AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 5 * v.n THEN other END AS form,
         CASE WHEN other_n >= 5 * v.n THEN other_n END AS form_n
  FROM vocabulary v LEFT JOIN best USING (word)
),
chain AS (
  SELECT word, word AS reached FROM forms
  UNION ALL SELECT c.word, f.form FROM chain c JOIN forms f ON f.word = c.reached WHERE f.form IS NOT NULL
)
SELECT forms.word, forms.form, c.reached AS root, forms.n, forms.n_near, forms.form_n
FROM forms JOIN chain c USING (word) JOIN forms last ON last.word = c.reached AND last.form IS NULL
"""
