"""SQL for the queries that SQL can express, written from the definitions, not from the method.

Decontamination lays every item over every place of every document that shares a word with it;
repeated windows are grouped as lists of words; conversations are put together with string functions.
Numbers are stated here again; only the list of common words is shared with the code.
"""

from __future__ import annotations

from pedalstrata.llm.divergence import common_words

DECONTAMINATION = r"""
WITH items AS (
  SELECT DISTINCT item_id, w FROM (
    SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM benchmark)
  WHERE len(w) > 0),
item_words AS (
  SELECT item_id, len(w) AS n, unnest(w) AS word, generate_subscripts(w, 1) AS j FROM items),
doc_words AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM (
    SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM documents)),
same AS (
  SELECT doc_id, item_id, n, i - j AS shift, j,
         least(n, 13) AS run,
         least(n, 13) - CASE WHEN n >= 12 THEN 2 WHEN n >= 8 THEN 1 ELSE 0 END AS need
  FROM doc_words JOIN item_words USING (word)),
placed AS (
  SELECT *, count(*) OVER (PARTITION BY doc_id, item_id, shift) AS agreeing FROM same),
-- The need-th agreement from here on lies within one run.
runs AS (
  SELECT *, lead(j, CAST(need - 1 AS INTEGER)) OVER (PARTITION BY doc_id, item_id, shift ORDER BY j) AS last
  FROM placed WHERE agreeing >= need),
hits AS (
  SELECT DISTINCT doc_id, item_id, n, shift, agreeing FROM runs WHERE last - j < run)
SELECT doc_id, item_id, CAST(n AS BIGINT) AS item_words, CAST(agreeing AS BIGINT) AS agreeing_words,
       CAST(shift AS BIGINT) AS first_word
FROM hits
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY agreeing DESC, shift) = 1
"""

CONVERSATIONS = r"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
escaped AS (
  SELECT *, length(replace(role, '\', '\\')) + len(regexp_extract_all(role, '<\||</?s>|\[/?INST\]|<</?SYS>>'))
              + len(regexp_extract_all(role, '\n')) AS role_chars,
         length(replace(text, '\', '\\')) + len(regexp_extract_all(text, '<\||</?s>|\[/?INST\]|<</?SYS>>')) AS text_chars
  FROM given)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(3 + sum(12 + role_chars + 1 + text_chars + 10 + 1) AS BIGINT) AS formatted_chars
FROM escaped GROUP BY conv_id
"""


def _divergence() -> str:
    listed = ", ".join(f"('{w}')" for w in common_words())
    classes = ("upper", "letter", "digit", "space", "symbol", "other")
    counts = ", ".join(f"CAST({c} AS DOUBLE) / n_chars AS p_{c}" for c in classes)
    shares = ", ".join(f"CAST(sum({c}) AS DOUBLE) / sum(n_chars) AS q_{c}" for c in classes)

    def part(p: str, q: str) -> str:
        return (
            f"(CASE WHEN {p} > 0 THEN {p} * log2({p} / (({p} + {q}) / 2)) ELSE 0 END"
            f" + CASE WHEN {q} > 0 THEN {q} * log2({q} / (({p} + {q}) / 2)) ELSE 0 END)"
        )

    by_class = " + ".join(part(f"p_{c}", f"q_{c}") for c in classes)
    return rf"""
WITH texts AS (
  SELECT doc_id, lang, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents),
grams AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS n
  FROM (SELECT doc_id, w, unnest(range(1, CAST(len(w) AS BIGINT) - 1)) AS i FROM texts WHERE len(w) >= 3)),
covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM grams, (VALUES (0), (1), (2)) AS o(k) WHERE n > 1 GROUP BY doc_id),
lines AS (
  SELECT doc_id, list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS l FROM texts),
base AS (
  SELECT doc_id, lang, w, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
         length(t) AS n_chars,
         length(regexp_replace(t, '[^\p{{Lu}}]+', '', 'g')) AS upper,
         length(regexp_replace(t, '[^\p{{L}}]+', '', 'g')) AS letters,
         length(regexp_replace(t, '[^\p{{N}}]+', '', 'g')) AS digit
  FROM texts JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)),
ruled AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         letters - upper AS letter, n_chars - word_chars AS space, n_symbols AS symbol,
         n_chars - letters - digit - (n_chars - word_chars) - n_symbols AS other
  FROM base),
listed(word) AS (VALUES {listed}),
counted AS (
  SELECT doc_id, word, count(*) AS n FROM (SELECT doc_id, unnest(w) AS word FROM ruled) JOIN listed USING (word) GROUP BY ALL),
langs AS (
  SELECT lang, {shares}, sum(n_words) AS words FROM ruled WHERE lang IS NOT NULL AND NOT base_failed GROUP BY lang),
word_refs AS (
  SELECT lang, word, CAST(coalesce(sum(n), 0) AS DOUBLE) / any_value(langs.words) AS q
  FROM langs CROSS JOIN listed LEFT JOIN (SELECT lang, word, n FROM counted JOIN ruled USING (doc_id) WHERE NOT base_failed) USING (lang, word)
  GROUP BY lang, word),
rest AS (SELECT lang, 1 - sum(q) AS q FROM word_refs GROUP BY lang),
by_class AS (
  SELECT doc_id, min(sqrt(greatest(({by_class}) / 2, 0))) AS d
  FROM (SELECT doc_id, {counts} FROM ruled WHERE n_chars >= 200) CROSS JOIN langs GROUP BY doc_id),
word_parts AS (
  SELECT doc_id, lang, sum({part("p", "q")}) AS d, sum(p) AS p FROM (
    SELECT r.doc_id, f.lang, CAST(coalesce(c.n, 0) AS DOUBLE) / r.n_words AS p, f.q
    FROM ruled r CROSS JOIN word_refs f LEFT JOIN counted c ON c.doc_id = r.doc_id AND c.word = f.word
    WHERE r.n_words >= 100) GROUP BY doc_id, lang),
by_word AS (
  SELECT doc_id, min(sqrt(greatest((d + {part("(1 - p)", "q")}) / 2, 0))) AS d
  FROM word_parts JOIN rest USING (lang) GROUP BY doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(by_class.d, 0) <= 0.25 AND coalesce(by_word.d, 0) <= 0.45 AS kept
FROM ruled LEFT JOIN by_class USING (doc_id) LEFT JOIN by_word USING (doc_id)
"""


def _crc32(codes: str) -> str:
    """Unsigned crc32 of a list of byte values."""
    shifted = "list_reduce([xor(state, byte), 1, 2, 3, 4, 5, 6, 7, 8], lambda a, b: xor(a >> 1, (a & 1) * 3988292384))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda state, byte: {shifted}), 4294967295)"


def _codes(text: str) -> str:
    """UTF-8 byte values of a text of ASCII and of letters up to U+00FF."""
    pair = "CASE WHEN ord(c) < 128 THEN [ord(c)::BIGINT] ELSE [195::BIGINT, ord(c)::BIGINT - 64] END"
    return f"flatten(list_transform(string_split({text}, ''), lambda c: {pair}))"


def _merkle() -> str:
    def field(name: str) -> str:
        text = f"CAST({name} AS VARCHAR)"
        return f"coalesce(CAST(strlen({text}) AS VARCHAR) || ':' || {text}, '-')"

    fields = [field(c) for c in ("doc_id", "source", "lang", "n_chars")]
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    leaf, changed = (f"sha256({' || '.join([*fields, field(t)])})" for t in ("text", lowered))
    tampered = f"({_crc32(_codes('CAST(doc_id AS VARCHAR)'))}) % 5 = 0"
    return rf"""
WITH RECURSIVE leaves AS (
  SELECT row_number() OVER () AS id, doc_id, source, {leaf} AS leaf,
         CASE WHEN {tampered} THEN {changed} ELSE {leaf} END AS claimed FROM documents),
-- Nodes of the groups' trees, level by level.
low AS (
  SELECT source, 0 AS level, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY source) AS n, leaf AS node, id FROM leaves
  UNION ALL
  SELECT source, level + 1, pos // 16, (n + 15) // 16, sha256(string_agg(node, '' ORDER BY pos)), NULL
  FROM low WHERE n > 1 GROUP BY source, level, pos // 16, n),
subroots AS (
  SELECT source, level, node, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place, count(*) OVER () AS n
  FROM low WHERE n = 1),
high AS (
  SELECT 0 AS level, place AS pos, n, node FROM subroots
  UNION ALL
  SELECT level + 1, pos // 16, (n + 15) // 16, sha256(string_agg(node, '' ORDER BY pos))
  FROM high WHERE n > 1 GROUP BY level, pos // 16, n),
-- All nodes with the step at which a proof uses them; upper levels follow those of the group.
steps AS (
  SELECT low.source, low.level AS step, pos, node FROM low WHERE n > 1
  UNION ALL
  SELECT s.source, s.level + h.level, h.pos, h.node FROM subroots s JOIN high h ON h.n > 1),
places AS (
  SELECT low.id, low.source, low.level AS step, low.pos FROM low WHERE n > 1 AND level = 0
  UNION ALL
  SELECT low.id, low.source, 0, s.place FROM low JOIN subroots s ON low.source IS NOT DISTINCT FROM s.source
  WHERE low.n = 1 AND low.level = 0 AND s.n > 1),
depth AS (
  SELECT s.source, s.place, s.node AS subroot, s.level AS own, s.level + (SELECT max(level) FROM high) AS steps FROM subroots s),
walk AS (
  SELECT l.id, l.source, 0 AS step,
         CASE WHEN d.own = 0 THEN d.place ELSE low.pos END AS pos, l.claimed AS node, '' AS siblings, d.own, d.place, d.steps
  FROM leaves l JOIN low ON low.id = l.id JOIN depth d ON d.source IS NOT DISTINCT FROM l.source
  UNION ALL
  SELECT w.id, w.source, w.step + 1, CASE WHEN w.step + 1 = w.own THEN w.place ELSE w.pos // 16 END,
         sha256(string_agg(CASE WHEN s.pos = w.pos THEN w.node ELSE s.node END, '' ORDER BY s.pos)),
         w.siblings || coalesce(string_agg(CASE WHEN s.pos <> w.pos THEN s.node END, '' ORDER BY s.pos), ''),
         w.own, w.place, w.steps
  FROM walk w JOIN steps s ON s.source IS NOT DISTINCT FROM w.source AND s.step = w.step AND s.pos // 16 = w.pos // 16
  WHERE w.step < w.steps
  GROUP BY w.id, w.source, w.step, w.pos, w.node, w.siblings, w.own, w.place, w.steps)
SELECT l.doc_id, l.leaf, d.subroot, (SELECT node FROM high WHERE n = 1) AS root, sha256(w.siblings) AS proof_sha256,
       w.node AS folded_root, w.node = (SELECT node FROM high WHERE n = 1) AS verified
FROM walk w JOIN leaves l USING (id) JOIN depth d ON d.source IS NOT DISTINCT FROM l.source
WHERE w.step = w.steps
"""


def _spelling() -> str:
    run = "unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zA-Z\\x{00C0}-\\x{00FF}]+'))"
    return rf"""
WITH RECURSIVE runs AS (
  SELECT doc_id, run, count(*) AS n FROM (SELECT doc_id, {run} AS run FROM documents) WHERE length(run) >= 7 GROUP BY ALL),
hashed AS (
  SELECT run, n, {_crc32(_codes("concat(CAST(doc_id AS VARCHAR), ':', run)"))} AS h FROM runs),
words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n
    FROM hashed) WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
-- Every word without each of its code points.
cut AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
replaced AS (
  SELECT DISTINCT a.word AS one, b.word AS two, b.n FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word),
shorter AS (SELECT DISTINCT c.word AS one, w.word AS two, c.n AS one_n, w.n AS two_n FROM cut c JOIN words w ON w.word = c.rest),
near AS (
  SELECT one, two, n FROM replaced UNION ALL SELECT one, two, two_n FROM shorter UNION ALL SELECT two, one, one_n FROM shorter),
best AS (
  SELECT one, count(*) AS n_near, max(n) AS top, arg_min(two, (-n, encode(two))) AS largest FROM near GROUP BY one),
formed AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN top >= 10 * n THEN largest END AS form,
         CASE WHEN top >= 10 * n THEN top END AS form_n
  FROM words LEFT JOIN best ON word = one),
followed AS (
  SELECT word, word AS root FROM formed
  UNION ALL
  SELECT f.word, g.form FROM followed f JOIN formed g ON g.word = f.root WHERE g.form IS NOT NULL)
SELECT formed.word, form, n, n_near, form_n, root
FROM formed JOIN followed USING (word) JOIN (SELECT word AS last FROM formed WHERE form IS NULL) ON last = root
"""


ORACLE = {
    "op5_decontaminate": DECONTAMINATION,
    "op9_reply_trees": CONVERSATIONS,
    "op10_divergence": _divergence(),
    "op11_spelling": _spelling(),
    "op13_merkle": _merkle(),
}
