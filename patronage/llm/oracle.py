"""SQL that gives the same rows on the same tables, for the operators that SQL can express at the size of a check."""

from __future__ import annotations

from patronage.llm import chatformat, divergence, jaccard, spelling

_GAP = r"[ \t\n\x0B\f\r]"
_WORD = r"[^ \t\n\x0B\f\r]+"


def op1() -> str:
    words = ", ".join(f"'{w}'" for w in divergence.WORDS)
    counted = lambda pattern: f"len(regexp_extract_all(t, '{pattern}'))"
    classes = ["[a-z]", "[A-Z]", "[0-9]", _GAP, "[#*$%&|<>]", r"[.,;:!?()\[\]{{}}/@^_`~+=\-''\"\\]".replace("{{", "{").replace("}}", "}")]
    n = len(divergence.CLASSES)

    def distance(p, total, q, whole):
        term = f"0.5 * (CASE WHEN a.v > 0 THEN (a.v / {total}) * log2(2 * (a.v / {total}) / (a.v / {total} + b.v / {whole})) ELSE 0 END + CASE WHEN b.v > 0 THEN (b.v / {whole}) * log2(2 * (b.v / {whole}) / (a.v / {total} + b.v / {whole})) ELSE 0 END)"
        return (f"CASE WHEN {total} > 0 AND {whole} > 0 THEN (SELECT sqrt(greatest(0, sum({term}))) FROM (SELECT unnest({p}) AS v, generate_subscripts({p}, 1) AS i) a "
                f"JOIN (SELECT unnest({q}) AS v, generate_subscripts({q}, 1) AS i) b USING (i)) END")

    return rf"""
WITH texts AS (SELECT row_number() OVER () AS u, doc_id, lang, coalesce(text, '') AS t FROM documents),
lists AS (SELECT *, regexp_extract_all(t, '{_WORD}') AS w,
    list_filter(list_transform(regexp_extract_all(t, '{_WORD}'), lambda x: lower(x)), lambda x: list_contains([{words}], x)) AS known,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0B\f\r]')) AS l FROM texts),
places AS (SELECT u, w, unnest(range(1, len(w) - 1)) AS i FROM lists WHERE len(w) >= 3),
triples AS (SELECT u, i, count(*) OVER (PARTITION BY u, w[i], w[i + 1], w[i + 2]) AS c FROM places),
covered AS (SELECT u, count(DISTINCT i + d) AS n FROM triples, (VALUES (0), (1), (2)) AS o(d) WHERE c > 1 GROUP BY u),
base AS (
  SELECT u, doc_id, lang, len(w)::BIGINT AS n_words, list_sum(list_transform(w, lambda x: length(x)))::BIGINT AS chars_in_words, {counted('[#*$%&|<>]')}::BIGINT AS n_symbols,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words, length(t)::BIGINT AS n_all,
    [{', '.join(counted(c) for c in classes)}] AS seen,
    list_transform([{words}], lambda c: len(list_filter(known, lambda x: x = c))) AS common
  FROM lists LEFT JOIN covered USING (u)),
failed AS (SELECT *, n_words < {divergence.LEAST_WORDS} OR 100 * n_repeat_words > {divergence.REPEATED_PERCENT} * n_words AS base_failed,
    list_append(seen, n_all - list_sum(seen)) AS chars FROM base),
bins AS (SELECT lang, 'c' AS kind, unnest(chars) AS v, generate_subscripts(chars, 1) AS i FROM failed WHERE NOT base_failed
  UNION ALL SELECT lang, 'w', unnest(common), generate_subscripts(common, 1) FROM failed WHERE NOT base_failed),
sums AS (SELECT lang, kind, i, sum(v)::BIGINT AS v FROM bins WHERE lang IN ({', '.join(f"'{x}'" for x in divergence.COMMON)}) GROUP BY lang, kind, i),
refs AS (SELECT lang, list(v ORDER BY i) FILTER (kind = 'c') AS rc, list(v ORDER BY i) FILTER (kind = 'w') AS rw,
    sum(v) FILTER (kind = 'c')::DOUBLE AS mc, sum(v) FILTER (kind = 'w')::DOUBLE AS mw FROM sums GROUP BY lang),
totals AS (SELECT *, list_sum(chars)::DOUBLE AS nc, list_sum(common)::DOUBLE AS nw FROM failed),
pairs AS (SELECT u, CASE WHEN nc >= {divergence.LEAST_CHARS} THEN {distance('chars', 'nc', 'rc', 'mc')} END AS dc,
    CASE WHEN nw >= {divergence.LEAST_COMMON} THEN {distance('common', 'nw', 'rw', 'mw')} END AS dw FROM totals, refs),
fit AS (SELECT u, bool_or(coalesce(dc <= {divergence.MOST_CHAR_DISTANCE}, true) AND coalesce(dw <= {divergence.MOST_WORD_DISTANCE}, true)) AS ok FROM pairs GROUP BY u)
SELECT doc_id, n_words, coalesce(chars_in_words, 0)::BIGINT AS word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND coalesce(ok, true) AS kept
FROM failed LEFT JOIN fit USING (u)"""


def op2(k: int = 5) -> str:
    t = jaccard.THRESHOLD
    window = " || chr(0) || ".join(f"w[i + {j}]" for j in range(k))
    return rf"""
WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS w FROM documents),
shingles AS (SELECT DISTINCT doc_id, {window} AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - {k - 2})) AS i FROM words WHERE len(w) >= {k})
  UNION ALL SELECT doc_id, array_to_string(w, chr(0)) FROM words WHERE len(w) BETWEEN 1 AND {k - 1}),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE {t.denominator} * c >= {t.numerator} * (p.n + q.n - c)),
reach AS (SELECT x, y FROM links UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(m, d.doc_id)) AS component_id
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN (SELECT x AS doc_id, min(y) AS m FROM reach GROUP BY x) USING (doc_id)"""


def op9() -> str:
    said = f"{chatformat.CLOSE}{chatformat.OPEN}assistant ok"
    budget, history, chunk = chatformat.BUDGET, chatformat.HISTORY, chatformat.CHUNK_SPANS
    fixed = len(chatformat.OPEN) + len(chatformat.CLOSE) + 2
    marks = r"""len(regexp_extract_all(text, '<\\*\|')) + len(regexp_extract_all(role, '<\\*\|')) + 2 * len(regexp_extract_all(role, '[%\n]'))"""
    wide = r"strlen(regexp_replace(role || text, '[\x00-\x7F]+', '', 'g'))"
    return rf"""
WITH RECURSIVE rows AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '{said}'), (-1, 1, 'assistant', '{said}')),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
    strlen(role) + strlen(text) + {marks} + {fixed} + 2 * {wide} AS tokens, length(role) + length(text) + {marks} + {fixed} AS chars FROM rows),
summed AS (SELECT *, sum(tokens) OVER (PARTITION BY conv_id ORDER BY i) AS b,
    max(CASE WHEN i = 1 AND role = 'system' THEN tokens ELSE 0 END) OVER (PARTITION BY conv_id) AS st,
    max(CASE WHEN i = 1 AND role = 'system' THEN chars ELSE 0 END) OVER (PARTITION BY conv_id) AS sc FROM numbered),
roomed AS (SELECT conv_id, i, chars, st, sc, b - tokens AS a, greatest(b - tokens, st) AS p, greatest(b, st) AS q,
    CASE WHEN {budget} - st - {history} >= {max(1, budget // 4)} THEN {budget} - st - {history} ELSE greatest({budget} - st, 1) END AS room FROM summed),
chunked AS MATERIALIZED (SELECT *, (p - st) // ({chunk} * room) AS chunk FROM roomed),
walk AS (SELECT conv_id, i, chunk, p AS f FROM chunked WHERE i = 1
  UNION ALL SELECT n.conv_id, n.i, n.chunk, CASE WHEN n.chunk <> w.chunk OR (n.q - w.f > n.room AND n.p > w.f) THEN n.p ELSE w.f END
  FROM walk w JOIN chunked n ON n.conv_id = w.conv_id AND n.i = w.i + 1),
spanned AS (SELECT c.*, w.f FROM chunked c JOIN walk w USING (conv_id, i)),
spans AS (SELECT conv_id, f, max(q) AS stop, max(st) AS st, max(sc) AS sc FROM spanned GROUP BY conv_id, f),
following AS (SELECT s.conv_id, s.f, s.stop, least({history}, greatest({budget} - s.st - (n.stop - n.f), 0)) AS room FROM spans s JOIN spans n ON s.conv_id = n.conv_id AND s.stop = n.f),
again AS (SELECT c.conv_id, sum(chars) AS n FROM spanned c JOIN following g ON c.conv_id = g.conv_id AND c.f = g.f WHERE a >= st AND p >= stop - g.room GROUP BY c.conv_id),
heads AS (SELECT conv_id, sum(CASE WHEN f > st THEN sc ELSE 0 END) AS n FROM spans GROUP BY conv_id),
lengths AS (SELECT conv_id, sum(chars) + any_value(heads.n) + coalesce(any_value(again.n), 0) AS formatted_chars
  FROM numbered JOIN heads USING (conv_id) LEFT JOIN again USING (conv_id) GROUP BY conv_id)
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256, any_value(formatted_chars)::BIGINT AS formatted_chars
FROM numbered JOIN lengths USING (conv_id) GROUP BY conv_id"""


def op13() -> str:
    letters = r"[a-zA-Z\x{C0}-\x{FF}]"
    return rf"""
WITH RECURSIVE crc AS (SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM (SELECT unnest(range(256)) AS i)),
runs AS (SELECT d, run, count(*) AS c FROM (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS d,
    unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{letters}{{{spelling.LEAST_LETTERS},}}')) AS run FROM documents) GROUP BY d, run),
bytes AS (SELECT run, c, flatten(list_transform(regexp_extract_all(d || ':' || run, '.'), lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT]
    ELSE [(unicode(x) >> 6 | 192)::BIGINT, (unicode(x) & 63 | 128)::BIGINT] END)) AS b FROM runs),
summed AS (SELECT run, c, xor(list_reduce(list_prepend(4294967295::BIGINT, b), lambda r, x: xor(r >> 8, t[(xor(r, x) & 255) + 1])), 4294967295::BIGINT) AS h FROM bytes, crc),
cutting AS (SELECT CASE WHEN h % {spelling.DROPPED} = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, c FROM summed),
words AS MATERIALIZED (SELECT word, sum(c)::BIGINT AS n FROM cutting WHERE length(word) >= {spelling.LEAST_LETTERS} GROUP BY word HAVING sum(c) >= {spelling.LEAST_SEEN}),
cuts AS MATERIALIZED (SELECT word, p, substr(word, 1, p - 1) || substr(word, p + 1) AS v FROM (SELECT word, unnest(range(1, length(word) + 1)) AS p FROM words)),
longer AS MATERIALIZED (SELECT DISTINCT cuts.word AS x, words.word AS y FROM cuts JOIN words ON v = words.word),
near AS (SELECT a.word AS x, b.word AS y FROM cuts a JOIN cuts b ON a.v = b.v AND a.p = b.p AND a.word <> b.word UNION ALL SELECT x, y FROM longer UNION ALL SELECT y, x FROM longer),
best AS (SELECT x, count(*) AS n_near, max(n) AS most, arg_min(y, (-n, y)) AS other FROM near JOIN words ON y = word GROUP BY x),
formed AS MATERIALIZED (SELECT word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN most >= {spelling.RATIO} * n THEN other END AS form,
    CASE WHEN most >= {spelling.RATIO} * n THEN most END AS form_n FROM words LEFT JOIN best ON word = x),
walk AS (SELECT word AS w, word AS step FROM formed UNION ALL SELECT w, form FROM walk JOIN formed ON step = word WHERE form IS NOT NULL)
SELECT f.word, f.n, f.n_near, f.form, f.form_n, step AS root FROM formed f JOIN walk ON f.word = w JOIN formed l ON l.word = step WHERE l.form IS NULL"""


ORACLES = {"op1_distribution_divergence": op1(), "op2_ngram_jaccard_join": op2(), "op9_chat_windows": op9(), "op13_spelling_variants": op13()}
