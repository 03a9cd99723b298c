"""The same results in SQL, where SQL can express them."""

from __future__ import annotations

_WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"

MIXING = rf"""
WITH RECURSIVE rows AS (
    SELECT doc_id, source, {_WORDS}::BIGINT AS size,
           md5('11:' || coalesce(doc_id::VARCHAR, '')) AS drawn
    FROM documents
), sources AS (
    SELECT source, sum(size)::BIGINT AS source_size,
           [5, 2, 1][((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::INT] AS weight
    FROM rows GROUP BY source
), levels AS (
    -- clamp whoever is above three epochs, share the rest again, until nobody is
    SELECT 0 AS step, source, source_size, weight, false AS clamped FROM sources
    UNION ALL
    SELECT step + 1, source, source_size, weight, now_clamped FROM (
        SELECT *, clamped OR 3 * source_size <=
               (sum(source_size) OVER (PARTITION BY step) - sum(CASE WHEN clamped THEN 3 * source_size ELSE 0 END) OVER (PARTITION BY step))::DOUBLE
               * weight / sum(CASE WHEN clamped THEN 0 ELSE weight END) OVER (PARTITION BY step)::DOUBLE AS now_clamped
        FROM levels
    ) WHERE step < (SELECT count(*) FROM sources)
), settled AS (
    SELECT * FROM levels WHERE step = (SELECT max(step) FROM levels)
), targets AS (
    SELECT source, source_size, CASE WHEN clamped THEN (3 * source_size)::DOUBLE ELSE
           (sum(source_size) OVER () - sum(CASE WHEN clamped THEN 3 * source_size ELSE 0 END) OVER ())::DOUBLE
           * weight / sum(CASE WHEN clamped THEN 0 ELSE weight END) OVER ()::DOUBLE END AS target
    FROM settled
), placed AS (
    SELECT r.doc_id, r.size, t.source_size, t.target,
           CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS whole,
           coalesce(sum(r.size) OVER (PARTITION BY r.source ORDER BY drawn, doc_id
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM rows r JOIN targets t ON r.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       (size * (whole + (source_size > 0 AND before + size / 2.0 <= target - whole * source_size)::INT))::BIGINT AS taken
FROM placed
"""

SHARDING = """
WITH placed AS (
    SELECT doc_id, source, text, md5('5:' || coalesce(doc_id::VARCHAR, '')) AS drawn FROM documents
), fractions AS (
    SELECT *, (row_number() OVER (PARTITION BY source ORDER BY drawn, doc_id) - 0.5)::DOUBLE
              / count(*) OVER (PARTITION BY source) AS fraction
    FROM placed
), ranked AS (
    SELECT *, row_number() OVER (ORDER BY fraction, drawn, doc_id) - 1 AS r, count(*) OVER () AS n FROM fractions
), bits AS (
    SELECT range::BIGINT AS i FROM range(256)
), steps AS (
    SELECT i, list_reduce(list_prepend(i, [x::BIGINT FOR x IN range(8)]),
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END) AS v
    FROM bits
), crc AS (
    SELECT list(v ORDER BY i) AS steps FROM steps
)
SELECT doc_id, strlen(coalesce(text, '')) + 16 AS size,
       xor(list_reduce(list_prepend(4294967295::BIGINT, [('0x' || x)::BIGINT FOR x IN
           regexp_extract_all(hex(encode(coalesce(text, ''))), '..')]),
           lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])), 4294967295::BIGINT)::BIGINT AS text_crc32,
       'rows' AS law, (r * 40 // n)::INT AS shard,
       r - ((r * 40 // n) * n + 39) // 40 AS slot, NULL::INT AS grown_shard
FROM ranked, crc
"""

_ESCAPED = r"""replace(replace(replace(replace(text, '\', '\\'), '###', '\h'), '</turn>', '\t'), '</part>', '\p')"""

CHAT = rf"""
WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), runs AS (
    SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) IS DISTINCT FROM role AS head FROM rows
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length({_ESCAPED}) + CASE WHEN head THEN length('### : </turn>') + 1
           + CASE WHEN role IN ('system', 'user', 'assistant') THEN length(role)
                  ELSE 1 + length(replace(replace(replace(replace(replace(role, '\', '\\'), '###', '\h'), '</turn>', '\t'), '</part>', '\p'), ':', '\c')) END
           ELSE length('</part>') END)::BIGINT AS formatted_chars
FROM runs GROUP BY conv_id
"""

_FOLDED = """regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"""

CONTAMINATION = f"""
WITH items AS (
    SELECT item_id, {_FOLDED} AS words FROM benchmark
), windows AS (
    SELECT DISTINCT item_id, words[i:i + least(len(words), 10) - 1] AS w, least(len(words), 10) AS k
    FROM (SELECT *, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS i FROM items WHERE len(words) > 0)
), docs AS (
    SELECT row_number() OVER () AS r, doc_id, {_FOLDED} AS words FROM documents
), spots AS (
    SELECT r, k, i, words[i:i + k - 1] AS w
    FROM (SELECT r, words, k, unnest(range(1, len(words) - k + 2)) AS i
          FROM docs JOIN (SELECT DISTINCT k FROM windows) ON len(words) >= k)
), hits AS (
    SELECT DISTINCT s.r, s.i, s.k, w.item_id FROM spots s JOIN windows w ON s.w = w.w
), places AS (
    SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS place FROM hits) GROUP BY r
), found AS (
    SELECT r, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
    FROM (SELECT DISTINCT r, item_id FROM hits) GROUP BY r
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN places USING (r) LEFT JOIN found USING (r)
"""

_SETS = r"""
docs AS (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
    FROM documents
), shingles AS (
    SELECT DISTINCT r, list_aggregate(words[i:i + 2], 'string_agg', ' ') AS s
    FROM (SELECT *, unnest(range(1, greatest(len(words) - 2, 1) + 1)) AS i FROM docs WHERE len(words) > 0)
), sizes AS (
    SELECT r, count(*) AS n FROM shingles GROUP BY r
)"""

JACCARD = rf"""
WITH RECURSIVE {_SETS}, pairs AS (
    SELECT a.r AS a, b.r AS b, count(*) AS common
    FROM shingles a JOIN sizes x ON x.r = a.r JOIN shingles b ON a.s = b.s AND a.r < b.r JOIN sizes y ON y.r = b.r
    WHERE 100 * least(x.n, y.n) >= 90 * greatest(x.n, y.n) GROUP BY a.r, b.r
), links AS (
    SELECT a, b FROM pairs JOIN sizes x ON x.r = a JOIN sizes y ON y.r = b WHERE 100 * common >= 90 * (x.n + y.n - common)
), ways AS (
    SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reached AS (
    SELECT r, r AS other FROM docs UNION SELECT reached.r, ways.b FROM reached JOIN ways ON reached.other = ways.a
)
SELECT d.doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(o.doc_id) AS component_id
FROM reached JOIN docs d ON d.r = reached.r JOIN docs o ON o.r = reached.other LEFT JOIN sizes ON sizes.r = d.r
GROUP BY d.r, d.doc_id
"""

_TERMS = """regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"""

SEARCH = f"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS words FROM documents
), totals AS (
    SELECT count(*) AS n_docs, sum(len(words))::BIGINT AS n_words FROM docs WHERE len(words) > 0
), items AS (
    SELECT row_number() OVER () AS i, item_id, {_TERMS} AS words FROM (SELECT DISTINCT item_id, text FROM benchmark)
), asked AS (
    SELECT i, item_id, term, count(*) AS repeats FROM (SELECT i, item_id, unnest(words) AS term FROM items) GROUP BY ALL
), held AS (
    SELECT r, doc_id, n, term, count(*) AS tf
    FROM (SELECT r, doc_id, len(words)::BIGINT AS n, unnest(words) AS term FROM docs)
    WHERE term IN (SELECT term FROM asked) GROUP BY ALL
), weights AS (
    SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
    FROM held, totals GROUP BY term, n_docs
), scores AS (
    SELECT i, item_id, r, doc_id,
           sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_words))))::BIGINT AS score
    FROM asked JOIN held USING (term) JOIN weights USING (term), totals GROUP BY ALL
)
SELECT item_id, rank::INT AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id, r) AS rank FROM scores WHERE score > 0)
WHERE rank <= 10
"""

REPAIR = r"""
WITH RECURSIVE bits AS (
    SELECT range::BIGINT AS i FROM range(256)
), steps AS (
    SELECT i, list_reduce(list_prepend(i, [x::BIGINT FOR x IN range(8)]),
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END) AS v
    FROM bits
), crc AS (
    SELECT list(v ORDER BY i) AS steps FROM steps
), given AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           xor(list_reduce(list_prepend(4294967295::BIGINT, [('0x' || x)::BIGINT FOR x IN regexp_extract_all(
               hex(encode(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))), '..')]),
               lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])), 4294967295::BIGINT)::BIGINT % 20 AS kind
    FROM conversations, crc
), damaged AS (
    SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
           CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM (SELECT *, unnest(CASE kind WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) FROM given)
), chats AS (
    SELECT row_number() OVER () AS c, conv_id FROM (SELECT DISTINCT conv_id FROM conversations)
), placed AS (
    SELECT c, turn, role, text, left(role, 1) AS initial,
           row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text) AS i
    FROM damaged d JOIN chats ON d.conv_id IS NOT DISTINCT FROM chats.conv_id
), rows AS (
    SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
           WHEN row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 THEN 'duplicate'
           WHEN right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) NOT IN ('.', '!', '?')
           THEN 'truncated' END AS fault,
           lag(initial) OVER (PARTITION BY c ORDER BY i) || initial AS neighbours
    FROM placed
), inserted(state, reached, paid, edits) AS (
    VALUES (0, 0, 0, ''), (1, 1, 0, ''), (2, 2, 0, ''), (3, 3, 0, ''), (0, 2, 3, 'I'), (1, 2, 3, 'I'), (2, 3, 3, 'I'),
           (3, 2, 3, 'I'), (0, 3, 6, 'II'), (1, 3, 6, 'II')
), edits(state, edit, initial, next, cost) AS (
    VALUES (0, 'K', 's', 1, 0), (0, 'K', 'u', 2, 0), (1, 'K', 'u', 2, 0), (3, 'K', 'u', 2, 0), (2, 'K', 'a', 3, 0),
           (0, 'R', NULL, 2, 3), (1, 'R', NULL, 2, 3), (2, 'R', NULL, 3, 3), (3, 'R', NULL, 2, 3),
           (0, 'D', NULL, 0, 4), (1, 'D', NULL, 1, 4), (2, 'D', NULL, 2, 4), (3, 'D', NULL, 3, 4)
), walks AS (
    -- the cost, nine digits wide, and the edits that led to a state after i rows
    SELECT c, 0::BIGINT AS i, 0 AS state, '000000000' AS walk FROM chats
    UNION ALL
    SELECT c, i, next, min(lpad((paid + cost + substr(walk, 1, 9)::INT)::VARCHAR, 9, '0') || substr(walk, 10) || edits)
    FROM (
        SELECT w.c, r.i, e.next, w.walk, n.paid, n.edits || e.edit AS edits,
               e.cost + CASE WHEN e.edit <> 'D' AND r.fault = 'truncated' THEN 3 ELSE 0 END AS cost
        FROM walks w JOIN rows r ON r.c = w.c AND r.i = w.i + 1 JOIN inserted n ON n.state = w.state
        JOIN edits e ON e.state = n.reached AND (e.initial IS NULL OR e.initial = r.initial)
             AND (e.edit = 'D' OR r.fault IS NULL OR r.fault = 'truncated')
    ) GROUP BY c, i, next
), lengths AS (
    SELECT chats.c, count(rows.i) AS n FROM chats LEFT JOIN rows ON rows.c = chats.c GROUP BY chats.c
), ended AS (
    SELECT c, min(lpad((substr(walk, 1, 9)::INT + more)::VARCHAR, 9, '0') || substr(walk, 10) || at_end) AS walk
    FROM walks JOIN lengths USING (c)
    JOIN (VALUES (0, 0, ''), (1, 6, 'II'), (2, 3, 'I'), (3, 0, '')) AS e(state, more, at_end) USING (state)
    WHERE i = n GROUP BY c
), marks AS (
    SELECT c, j, substr(walk, 9 + j, 1) AS edit FROM (SELECT c, walk, unnest(range(1, len(walk) - 8)) AS j FROM ended)
), numbered AS (
    SELECT *, count(*) FILTER (edit <> 'I') OVER w AS i, count(*) FILTER (edit <> 'D') OVER w AS p
    FROM marks WINDOW w AS (PARTITION BY c ORDER BY j)
), left_rows AS (
    SELECT m.c, j, p, edit, r.role, CASE WHEN edit = 'I' THEN '' ELSE r.text END AS text,
           max(CASE WHEN p = 1 AND edit = 'K' AND r.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY m.c) AS has_system
    FROM numbered m LEFT JOIN rows r ON r.c = m.c AND r.i = m.i AND m.edit <> 'I' WHERE edit <> 'D'
), repaired AS (
    SELECT c, string_agg(CASE WHEN edit = 'K' THEN role WHEN (p - has_system) % 2 = 1 THEN 'user' ELSE 'assistant' END
           || ':' || text, chr(10) ORDER BY j) AS whole FROM left_rows GROUP BY c
), faults AS (
    SELECT c, CASE WHEN count(turn) = 0 THEN 0 ELSE max(turn) - min(turn) + 1 - count(DISTINCT turn) END AS gaps,
           count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
           count(*) FILTER (fault = 'truncated') AS truncated,
           count(*) FILTER (neighbours NOT IN ('su', 'ua', 'au')) AS illegal
    FROM rows GROUP BY c
)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, substr(walk, 1, 9)::BIGINT AS cost,
       substr(walk, 10) AS audit, sha256(coalesce(whole, '')) AS repaired_sha256
FROM chats JOIN ended USING (c) LEFT JOIN faults USING (c) LEFT JOIN repaired USING (c)
"""

ORACLES = {
    "op1_mixing": MIXING,
    "op3_decontamination": CONTAMINATION,
    "op5_sharding": SHARDING,
    "op7_jaccard": JACCARD,
    "op8_chat": CHAT,
    "op11_repair": REPAIR,
    "op12_search": SEARCH,
}
