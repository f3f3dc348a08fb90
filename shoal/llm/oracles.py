"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

OP1 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(list_slice(w, i, i + least(len(w), 13) - 1), ' ') AS x
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
ns AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS x
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, ns WHERE len(w) >= n)),
hits AS (SELECT doc_id, i, n, item_id FROM dw JOIN bw USING (n, x)),
pos AS (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM hits)),
nh AS (SELECT doc_id, count(*) AS n_hit FROM pos GROUP BY doc_id),
ni AS (SELECT doc_id, count(*) AS n_items, string_agg(k, ',' ORDER BY k) AS items
       FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS k FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN nh USING (doc_id) LEFT JOIN ni USING (doc_id)
"""

OP2 = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
d AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM t),
win AS (SELECT doc_id, i, array_to_string(list_slice(w, i, i + 7), ' ') AS x
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, x) AS k FROM win) WHERE k > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY doc_id),
stutter AS (SELECT doc_id, count(*) AS n FROM (SELECT doc_id, w, unnest(range(1, len(w))) AS i FROM d WHERE len(w) > 1) WHERE w[i] = w[i + 1] GROUP BY doc_id),
top AS (SELECT doc_id, max(k) AS n FROM (SELECT doc_id, x, count(*) AS k FROM (SELECT doc_id, unnest(w) AS x FROM d) GROUP BY doc_id, x) GROUP BY doc_id),
f AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
             len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
             (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, len(l) AS n_lines,
             coalesce(rep.n, 0)::BIGINT AS n_repeat_words, coalesce(stutter.n, 0) AS n_stutter, coalesce(top.n, 0) AS n_top,
             len(list_filter(w, lambda x: ends_with(x, '!!'))) AS n_marks
      FROM d LEFT JOIN rep USING (doc_id) LEFT JOIN stutter USING (doc_id) LEFT JOIN top USING (doc_id)),
g AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > 3 * n_words OR 10 * n_dup_lines > 6 * n_lines
            OR NOT (word_chars BETWEEN 2 * n_words AND 20 * n_words) OR 10 * n_marks > 3 * n_words
            OR 10 * n_stutter > 3 * n_words OR 10 * n_top > 4 * n_words) AS kept
FROM g
"""

OP6 = r"""
WITH l AS (SELECT doc_id, i AS line_no, x FROM (SELECT doc_id, unnest(l) AS x, unnest(range(len(l))) AS i
           FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL))),
s AS (SELECT *, (row_number() OVER (PARTITION BY doc_id ORDER BY line_no))::BIGINT - 1 AS pos FROM l
      WHERE regexp_matches(x, '[^\x20\x09-\x0D]')),
w AS (SELECT doc_id, pos, first_value(doc_id) OVER g AS fd, first_value(pos) OVER g AS fp
      FROM s WINDOW g AS (PARTITION BY x ORDER BY doc_id, pos)),
late AS (SELECT * FROM w WHERE (doc_id, pos) <> (fd, fp)),
gone AS (SELECT DISTINCT doc_id, pos FROM late),
start AS (SELECT a.* FROM late a ANTI JOIN late b ON a.doc_id = b.doc_id AND a.pos = b.pos + 1 AND a.fd = b.fd AND a.fp = b.fp + 1),
lens AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
lcp AS (SELECT t.doc_id, t.pos, min(a.pos - t.pos) FILTER (WHERE b.x IS NULL OR a.x <> b.x) AS cut, max(a.pos - t.pos) + 1 AS whole
        FROM start t JOIN s a ON a.doc_id = t.doc_id AND a.pos >= t.pos
        LEFT JOIN s b ON b.doc_id = t.fd AND b.pos = t.fp + a.pos - t.pos GROUP BY t.doc_id, t.pos),
run AS (SELECT doc_id, max(coalesce(cut, whole)) AS longest_run FROM lcp GROUP BY doc_id),
f AS (SELECT l.doc_id, count(s.pos) AS n_lines, count(gone.pos) AS n_deleted,
             string_agg(l.x, chr(10) ORDER BY l.line_no) FILTER (WHERE gone.pos IS NULL) AS kept
      FROM l LEFT JOIN s USING (doc_id, line_no) LEFT JOIN gone ON gone.doc_id = l.doc_id AND gone.pos = s.pos GROUP BY l.doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(f.kept, '') END AS text, coalesce(n_lines, 0)::BIGINT AS n_lines,
       coalesce(n_deleted, 0)::BIGINT AS n_deleted, coalesce(longest_run, 0)::BIGINT AS longest_run
FROM documents d LEFT JOIN f USING (doc_id) LEFT JOIN run USING (doc_id)
"""

OP12 = r"""
WITH r AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, t, x, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) v(t, x)),
e AS (SELECT *, regexp_replace(text, '([<\[])(\\*(?:/?s>|/?INST\]|/?SYSTEM_PROMPT\]|/?ROLE\]|/TURN\]))', '\1\\\2', 'g') AS body,
             regexp_replace(role, '([<\[])(\\*(?:/?s>|/?INST\]|/?SYSTEM_PROMPT\]|/?ROLE\]|/TURN\]))', '\1\\\2', 'g') AS name FROM r),
f AS (SELECT *, CASE role WHEN 'system' THEN '[SYSTEM_PROMPT]' || body || '[/SYSTEM_PROMPT]' WHEN 'user' THEN '[INST]' || body || '[/INST]'
             WHEN 'assistant' THEN body || '</s>' ELSE '[ROLE]' || name || '[/ROLE]' || body || '[/TURN]' END AS piece FROM e),
g AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS said,
             coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (WHERE role = 'assistant'), '') AS loss,
             sum(length(piece)) AS chars FROM f GROUP BY conv_id)
SELECT conv_id, n_turns::BIGINT AS n_turns, sha256(said) AS turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256,
       (3 + chars)::BIGINT AS formatted_chars FROM g
"""

OP13 = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
                  sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
k AS (SELECT doc_id, text, u, len(u) AS n, ('0x' || h[1:8])::UBIGINT AS h1, ('0x' || h[9:16])::UBIGINT AS h2,
             ('0x' || h[17:24])::UBIGINT AS h3, ('0x' || h[25:32])::UBIGINT AS h4 FROM d),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1))::BIGINT AS a, greatest(h1 % (n + 1), h2 % (n + 1))::BIGINT AS b,
             CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100 THEN 'plain'
                  WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM k),
p AS (SELECT *, array_to_string(list_slice(u, 1, a), '') AS prefix, array_to_string(list_slice(u, a + 1, b), '') AS middle,
             array_to_string(list_slice(u, b + 1, n), '') AS suffix FROM c)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(prefix)::BIGINT END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle)::BIGINT END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(text) AS restored_sha256
FROM p
"""

ORACLES = {"op1_decontaminate": OP1, "op2_quality_rules": OP2, "op6_line_dedup": OP6, "op12_chat_format": OP12, "op13_fill_in_middle": OP13}
