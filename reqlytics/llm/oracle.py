"""The queries' results as SQL for another engine, where SQL can say it."""

CHAT = r"""
WITH added AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), plain AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM added
), sized AS (
  SELECT *,
    length('<|im_start|>') + length('<|im_end|>') + 2 + length(role)
      + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')) AS chars,
    row_number() OVER w AS place, count(*) OVER (PARTITION BY conv_id) AS n
  FROM plain WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), summed AS (
  SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY place) AS upto FROM sized
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(upto) FILTER (role = 'assistant' OR place = n)::BIGINT AS formatted_chars
FROM summed GROUP BY conv_id
"""

DECONTAMINATE = r"""
WITH doc AS (
  SELECT doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), item AS (
  SELECT item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark
), wide AS (
  SELECT DISTINCT item_id, least(10, len(words)) AS size,
    array_to_string(words[place : place + least(10, len(words)) - 1], ' ') AS said
  FROM item, unnest(range(1, len(words) - least(10, len(words)) + 2)) AS t(place) WHERE len(words) > 0
), spot AS (
  SELECT doc_id, place, size, array_to_string(words[place : place + size - 1], ' ') AS said
  FROM doc, (SELECT DISTINCT size FROM wide) AS sizes, unnest(range(1, len(words) - size + 2)) AS t(place)
), hit AS (
  SELECT spot.doc_id, spot.place, spot.size, wide.item_id FROM spot JOIN wide USING (size, said)
), covered AS (
  SELECT doc_id, count(DISTINCT word) AS n_hit
  FROM (SELECT doc_id, unnest(range(place, place + size)) AS word FROM hit) GROUP BY doc_id
), seen AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hit) GROUP BY doc_id
)
SELECT doc.doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN seen USING (doc_id)
"""

TOP_K = r"""
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, x.vec_id, list_inner_product(q.v::DOUBLE[], x.v::DOUBLE[])::BIGINT AS score
  FROM usable q JOIN usable x ON q.vec_id % 50 = 0 AND q.vec_id <> x.vec_id AND len(q.v) = len(x.v)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""

DIVERGENCE = r"""
WITH doc AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS said
  FROM documents
), word AS (
  SELECT row, lang, source, unnest(said) AS term FROM doc
), kept AS (
  SELECT lang, term, count(*) AS all_n FROM word GROUP BY lang, term HAVING count(DISTINCT row) >= 30
), size AS (
  SELECT lang, count(*) AS terms, sum(all_n) AS lang_total FROM kept GROUP BY lang
), counted AS (
  SELECT lang, source, term, count(*) AS n FROM word JOIN kept USING (lang, term) GROUP BY lang, source, term
), total AS (
  SELECT lang, source, sum(n) AS total FROM counted GROUP BY lang, source
), grp AS (
  SELECT lang, source, coalesce(total, 0) AS total
  FROM (SELECT DISTINCT lang, source FROM doc) LEFT JOIN total USING (lang, source)
), shares AS (
  SELECT lang, source, term, coalesce(n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(n, 0) + 5)) // (total + 5 * terms)::HUGEINT AS p,
    1 + (1000000000::HUGEINT * (all_n + 5)) // (lang_total + 5 * terms)::HUGEINT AS q
  FROM grp JOIN kept USING (lang) JOIN size USING (lang) LEFT JOIN counted USING (lang, source, term)
), apart AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), listed AS (
  SELECT lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM grp a JOIN grp b USING (lang) LEFT JOIN apart ON apart.lang = a.lang AND apart.source = a.source AND item = b.source
  WHERE a.source <> b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q)::BIGINT FROM shares WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank FROM listed
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""

COLLOCATIONS = r"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^.,;:!?\x0A-\x0D]+')) AS said
  FROM documents
), cut AS (
  SELECT lang, regexp_extract_all(said, '[^\x20\x09]+') AS words FROM piece
), sized AS (
  SELECT lang, words, unnest([1, 2, 3, 4]) AS size FROM cut WHERE len(words) > 0
), placed AS (
  SELECT lang, size, words, unnest(range(1, len(words) - size + 2)) AS place FROM sized
), gram AS (
  SELECT lang, array_to_string(words[place : place + size - 1], ' ') AS said, count(*) AS f FROM placed GROUP BY 1, 2
), total AS (
  SELECT lang, count(*) AS n FROM placed WHERE size = 1 GROUP BY lang
), candidate AS MATERIALIZED (
  SELECT lang, said, f AS a, string_split(said, ' ') AS ws FROM gram WHERE f >= 30 AND contains(said, ' ')
), split AS (
  SELECT lang, said, a, ws, unnest(range(1, len(ws))) AS k FROM candidate
), sides AS (
  SELECT lang, said, a, k, array_to_string(ws[1 : k], ' ') AS first, array_to_string(ws[k + 1 :], ' ') AS rest FROM split
), halves AS (
  SELECT sides.*, x.f AS l, y.f AS r, (2000000::HUGEINT * a) // (x.f + y.f)::HUGEINT AS score
  FROM sides JOIN gram x ON x.lang = sides.lang AND x.said = first JOIN gram y ON y.lang = sides.lang AND y.said = rest
), scored AS (
  SELECT * FROM halves QUALIFY row_number() OVER (PARTITION BY lang, said ORDER BY score, k) = 1
), inner_sizes AS (
  SELECT lang, a, ws, unnest(range(2, len(ws))) AS size FROM candidate WHERE len(ws) > 2
), inner_places AS (
  SELECT lang, a, ws, size, unnest(range(1, len(ws) - size + 2)) AS place FROM inner_sizes
), covered AS (
  SELECT lang, array_to_string(ws[place : place + size - 1], ' ') AS said, max(a) AS longer FROM inner_places GROUP BY 1, 2
), standing AS (
  SELECT scored.lang, scored.said AS phrase, a, l, r, score
  FROM scored LEFT JOIN covered ON covered.lang = scored.lang AND covered.said = scored.said
  WHERE longer IS NULL OR 100 * longer < 80 * a
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM standing
)
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""

ORACLE = {
    "op13_collocations": COLLOCATIONS,
    "op12_source_divergence": DIVERGENCE,
    "op1_chat_format": CHAT,
    "op9_top_k": TOP_K,
    "op5_decontaminate": DECONTAMINATE,
}
