"""SQL counterparts of those queries that SQL can express.

The others score hashed n-grams (1, 7), draw at random (4, 6), mine rules (5), slide a window with
running counts (8) or split sentences (3); their tests compare them with plain Python.
"""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PLAIN = r"[^\x20\x09-\x0D]+"
_NORMAL = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_DECONTAMINATE = rf"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '{_NORMAL}') AS w FROM documents
), items AS (
  SELECT CAST(item_id AS VARCHAR) AS item, w, least(13, len(w)) AS m
  FROM (SELECT item_id, regexp_extract_all({_LOWER}, '{_NORMAL}') AS w FROM benchmark)
  WHERE len(w) > 0
), windows AS (
  SELECT DISTINCT item, m, list_slice(w, i, i + m - 1) AS run
  FROM (SELECT *, unnest(range(1, len(w) - m + 2)) AS i FROM items)
), places AS (
  SELECT doc_id, m, i, list_slice(w, i, i + m - 1) AS run
  FROM (
    SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i
    FROM docs, (SELECT DISTINCT m FROM windows) WHERE len(w) >= m
  )
), found AS (
  SELECT doc_id, item, i, places.m AS m FROM places JOIN windows USING (m, run)
), hits AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM found) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
  FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(list, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)
"""

_CHAT = rf"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'),
         (-7, 1, 'assistant', '\### Assistant: </turn> ok')
), placed AS (
  SELECT *, len(regexp_extract_all(text, '{_PLAIN}')) + 2 AS tokens,
         row_number() OVER o = 1 AND role = 'system' AS is_system,
         16 + length(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'))
            + length(replace(replace(text, '&', '&amp;'), '<', '&lt;')) AS chars
  FROM given WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), summed AS (
  SELECT *, coalesce(sum(CASE WHEN is_system THEN 0 ELSE tokens END) OVER (
    PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM placed
), named AS (
  SELECT *, dense_rank() OVER (PARTITION BY conv_id ORDER BY part) - 1 AS win
  FROM (
    SELECT *, 2 * (start // 512) + CASE
      WHEN is_system OR start % 512 = 0 OR start // 512 = (start + tokens - 1) // 512 THEN 0 ELSE 1
    END AS part FROM summed
  )
), firsts AS (
  SELECT conv_id, win - 1 AS win, min(start) AS next_start
  FROM named WHERE NOT is_system GROUP BY ALL
), systems AS (
  SELECT conv_id, max(chars) AS chars FROM named WHERE is_system GROUP BY ALL
), later AS (
  SELECT conv_id, count(DISTINCT win) AS n FROM named WHERE win > 0 GROUP BY ALL
), sums AS (
  SELECT conv_id, count(*) AS n_turns,
         sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
         coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
         sum(chars) + coalesce(sum(chars) FILTER (
           WHERE NOT is_system AND next_start - start <= 128), 0) AS chars
  FROM named LEFT JOIN firsts USING (conv_id, win) GROUP BY conv_id
)
SELECT sums.conv_id AS conv_id, n_turns, turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
       sha256(loss) AS loss_sha256,
       CAST(sums.chars + coalesce(systems.chars * n, 0) AS BIGINT) AS formatted_chars
FROM sums LEFT JOIN systems USING (conv_id) LEFT JOIN later USING (conv_id)
"""

_NEAR = rf"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '{_PLAIN}') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, list_slice(w, i, i + least(3, len(w)) - 1) AS s
  FROM (SELECT *, unnest(range(1, len(w) - least(3, len(w)) + 2)) AS i FROM docs WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * common >= 85 * (p.n + q.n - common)
), reach AS (
  SELECT a, b FROM links
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), least_id AS (
  SELECT a AS doc_id, min(b) AS b FROM reach GROUP BY a
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(b, doc_id)) AS component_id,
       doc_id <= coalesce(b, doc_id) AS kept
FROM docs LEFT JOIN sizes USING (doc_id) LEFT JOIN least_id USING (doc_id)
"""

_DRAW = "CAST('0x' || substr(sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')), {at}, 8) AS BIGINT)"

_FIM = rf"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
         {_DRAW.format(at=1)} AS h1, {_DRAW.format(at=9)} AS h2,
         {_DRAW.format(at=17)} AS h3, {_DRAW.format(at=25)} AS h4
  FROM documents
), cuts AS (
  SELECT *, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS one,
         greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS two,
         CASE WHEN text = '' OR regexp_matches(text, '<[PSM]>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM units
), parts AS (
  SELECT *, array_to_string(list_slice(u, 1, one), '') AS p,
         array_to_string(list_slice(u, one + 1, two), '') AS m,
         array_to_string(list_slice(u, two + 1, n), '') AS s
  FROM cuts
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""

_COLLOCATIONS = rf"""
WITH pieces AS (
  SELECT row_number() OVER () AS piece, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
  )
), runs AS (
  SELECT lang, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS phrase
  FROM (
    SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
    FROM pieces, (SELECT unnest(range(1, 6)) AS k) WHERE len(w) >= k
  )
), often AS (
  SELECT lang, k, phrase, count(*) AS f FROM runs GROUP BY ALL
), totals AS (
  SELECT lang, sum(f) AS n FROM often WHERE k = 1 GROUP BY lang
), candidates AS (
  SELECT lang, phrase, f AS a, string_split(phrase, ' ') AS w FROM often WHERE k > 1 AND f >= 100
), inside AS (
  SELECT lang, a, unnest([array_to_string(w[:len(w) - 1], ' '), array_to_string(w[2:], ' ')]) AS phrase
  FROM candidates WHERE len(w) > 2
), cuts AS (
  SELECT lang, phrase, a, j, array_to_string(w[:j], ' ') AS one, array_to_string(w[j + 1:], ' ') AS two
  FROM (SELECT *, unnest(range(1, len(w))) AS j FROM candidates)
), scored AS (
  SELECT lang, cuts.phrase, a, j, x.f AS l, y.f AS r, CAST(n AS BIGINT) AS n,
         CAST((CAST(1000 AS HUGEINT) * a * n) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM cuts JOIN totals USING (lang)
  JOIN often x ON x.lang = cuts.lang AND x.phrase = one
  JOIN often y ON y.lang = cuts.lang AND y.phrase = two
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM lowest WHERE NOT EXISTS (
    SELECT 1 FROM inside WHERE inside.lang = lowest.lang AND inside.phrase = lowest.phrase
    AND 100 * inside.a >= 100 * lowest.a
  )
)
SELECT lang, rank, phrase, a, l, r, n, score FROM placed WHERE rank <= 2000
"""

#: CRC-32 of the id as text, a byte and a bit at a time, by its fixed polynomial.
_CRC = """
xor(4294967295, list_reduce(
  list_concat([4294967295], list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), ''), ''),
                                           lambda c: CAST(ascii(c) AS BIGINT))),
  lambda crc, byte: list_reduce(
    list_concat([xor(crc, byte)], [0, 0, 0, 0, 0, 0, 0, 0]),
    lambda a, b: xor(a >> 1, 3988292384 * (a & 1)))
))
"""

_LANGUAGE = rf"""
WITH docs AS (
  SELECT doc_id, lang, {_CRC} % 5 = 0 AS held_out,
         regexp_extract_all(lower(coalesce(text, '')), '\pL+') AS w
  FROM documents
), words AS (
  SELECT doc_id, word, count(*) AS n FROM (SELECT doc_id, unnest(w) AS word FROM docs) GROUP BY ALL
), padded AS (
  SELECT doc_id, n, ' ' || word || ' ' AS word FROM words
), grams AS (
  SELECT doc_id, substr(word, CAST(i AS BIGINT), k) AS gram, sum(n) AS n
  FROM (
    SELECT doc_id, word, n, k, unnest(range(1, length(word) - k + 2)) AS i
    FROM padded, (SELECT unnest([1, 2, 3]) AS k)
  ) WHERE substr(word, CAST(i AS BIGINT), k) <> ' ' GROUP BY ALL
), ranked AS (
  SELECT doc_id, gram, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, length(gram), gram) AS own
  FROM grams QUALIFY own <= 400
), learned AS (
  SELECT lang, gram, sum(n) AS n FROM grams JOIN docs USING (doc_id)
  WHERE NOT held_out AND lang IS NOT NULL GROUP BY lang, gram
), profiles AS (
  SELECT lang, gram, row_number() OVER (PARTITION BY lang ORDER BY n DESC, length(gram), gram) AS rank
  FROM learned QUALIFY rank <= 400
), distances AS (
  SELECT doc_id, langs.lang AS lang, count(*) AS m,
         sum(CASE WHEN rank IS NULL THEN 400 ELSE abs(rank - own) END) AS d
  FROM ranked CROSS JOIN (SELECT DISTINCT lang FROM profiles) langs
  LEFT JOIN profiles ON profiles.lang = langs.lang AND profiles.gram = ranked.gram
  GROUP BY ALL
), answers AS (
  SELECT doc_id, arg_min(lang, (d, lang)) AS lang_pred,
         list_sort(list(CAST(d AS DOUBLE))) AS d, max(m) * 400 AS most
  FROM distances GROUP BY doc_id
)
SELECT doc_id, held_out, coalesce(lang_pred, 'und') AS lang_pred,
       CASE WHEN lang_pred IS NULL OR coalesce(d[2], most) = 0 THEN 0
            ELSE 1 - d[1] / coalesce(d[2], most) END AS score
FROM docs LEFT JOIN answers USING (doc_id)
"""

SQL: dict[str, str] = {
    "op2_decontaminate": _DECONTAMINATE,
    "op9_chat": _CHAT,
    "op10_near_duplicates": _NEAR,
    "op11_fill_in_middle": _FIM,
    "op12_collocations": _COLLOCATIONS,
    "op13_language": _LANGUAGE,
}
