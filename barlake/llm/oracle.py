"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

# every 13-word window with its least doc_id; words under a window that a smaller doc_id has go
SUBSTRINGS = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
words AS (SELECT doc_id, unnest(ws) AS x, generate_subscripts(ws, 1) AS p FROM w),
starts AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w WHERE len(ws) >= 13),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS k FROM starts),
firsts AS (SELECT k, min(doc_id) AS f FROM win GROUP BY k),
gone AS (SELECT DISTINCT win.doc_id, i + o AS p FROM win JOIN firsts USING (k), (SELECT unnest(range(0, 13)) AS o) WHERE f < win.doc_id),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT w.doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)"""

# what formatting must keep; a character that may begin a control string, and a backslash, count twice
CHAT = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length('<|turn|>') + length(role) + 1 + length(text) + length('<|end|>') + 1
    + length(regexp_replace(role || text, '[^<\[\\]', '', 'g')) + length(regexp_replace(role, '[^\n]', '', 'g'))) AS BIGINT)
    AS formatted_chars
FROM c GROUP BY conv_id"""

# every phrase of one to five words counted, scored at its lowest cut
PHRASES = r"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
s AS (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM w, (SELECT unnest(range(1, 6)) AS k) WHERE len(ws) >= k),
f AS (SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase, count(*) AS f FROM s GROUP BY ALL),
n AS (SELECT lang, sum(f)::HUGEINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1 AND f >= 100),
cut AS (SELECT lang, k, phrase, a, ws, unnest(range(1, k)) AS j FROM c),
scored AS (SELECT cut.lang, cut.k, cut.phrase, a, x.f AS l, y.f AS r, n, j, (1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f) AS score
  FROM cut JOIN n ON n.lang = cut.lang
  JOIN f AS x ON x.lang = cut.lang AND x.phrase = array_to_string(ws[1:j], ' ')
  JOIN f AS y ON y.lang = cut.lang AND y.phrase = array_to_string(ws[j + 1:cut.k], ' ')),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
free AS (SELECT * FROM best WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.lang = best.lang AND c.k > best.k AND 100 * c.a >= 100 * best.a
  AND contains(' ' || c.phrase || ' ', ' ' || best.phrase || ' '))),
r AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM free)
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM r WHERE rank <= 2000"""

ORACLE = {"op3_substrings": SUBSTRINGS, "op5_chat": CHAT, "op11_phrases": PHRASES}
