"""SQL counterparts of the queries that SQL can express.

Of the others, language identification, SimHash, MinHash, edit distances over blocks, the
vector graph, the pattern graph and dependent rounding need hashes or iterations that SQL
lacks; their tests compare them with brute force.
"""

# Fixed values, spelled out: the phrases (k = 2) and statements (k = 3) of the license scan.
_LICENSES = r"""
WITH template(tid, label, k, base, t) AS (VALUES
  (0, 'gpl', 2, true, 'gnu general public license'),
  (1, 'apache', 2, true, 'apache license'),
  (2, 'cc-by', 2, true, 'cc by'),
  (3, 'mit', 2, true, 'mit license'),
  (4, 'gpl-3.0', 3, false, 'this work is licensed under the gnu general public license version 3'),
  (5, 'gpl-notice', 3, false, 'this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation'),
  (6, 'lgpl', 3, false, 'under the terms of the gnu lesser general public license'),
  (7, 'agpl', 3, false, 'under the terms of the gnu affero general public license'),
  (8, 'apache-2.0', 3, false, 'licensed under the apache license version 2 0'),
  (9, 'cc-by-nc-4.0', 3, false, 'licensed under cc by nc 4 0'),
  (10, 'cc-by-4.0', 3, false, 'licensed under a creative commons attribution 4 0 international license'),
  (11, 'mit-notice', 3, false, 'permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files'),
  (12, 'mit-release', 3, false, 'released under the mit license'),
  (13, 'bsd', 3, false, 'redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met'),
  (14, 'mpl-2.0', 3, false, 'this source code form is subject to the terms of the mozilla public license v 2 0'),
  (15, 'isc', 3, false, 'permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted'),
  (16, 'unlicense', 3, false, 'this is free and unencumbered software released into the public domain')),
split AS (SELECT *, string_split(t, ' ') AS tw FROM template),
gram AS (
  SELECT tid, label, k, base, len(tw) - k + 1 AS n, p AS t_pos, array_to_string(tw[p + 1:p + k], ' ') AS g
  FROM (SELECT *, unnest(range(len(tw) - k + 1)) AS p FROM split)),
doc AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
place AS (SELECT r, w, unnest(range(len(w))) AS i FROM doc),
hit AS (
  SELECT r, tid, label, base, n, i - t_pos AS diagonal, t_pos
  FROM place JOIN gram ON gram.k = 2 AND array_to_string(w[i + 1:i + 2], ' ') = g
  UNION ALL
  SELECT r, tid, label, base, n, i - t_pos, t_pos
  FROM place JOIN gram ON gram.k = 3 AND array_to_string(w[i + 1:i + 3], ' ') = g),
diagonal AS (SELECT DISTINCT r, tid, diagonal FROM hit),
opened AS (
  SELECT r, tid, diagonal,
         CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY r, tid ORDER BY diagonal) <= 3 AND tid > 3
              THEN 0 ELSE 1 END AS opens
  FROM diagonal),
span AS (SELECT r, tid, diagonal, sum(opens) OVER (PARTITION BY r, tid ORDER BY diagonal) AS s FROM opened),
found AS (
  SELECT r, tid, label, base, s, min(diagonal) AS start, count(DISTINCT t_pos) / n AS cover
  FROM hit JOIN span USING (r, tid, diagonal) GROUP BY r, tid, label, base, n, s),
verdict AS (
  SELECT r, count(*) FILTER (base AND cover = 1) AS n_base,
         min(start) FILTER (base AND cover = 1) AS first_word, max(start) FILTER (base AND cover = 1) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base AND cover = 1) AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label)
           FILTER ((base AND cover = 1) OR (NOT base AND cover >= 0.6)) AS labels,
         max(cover) AS score
  FROM found GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       coalesce(score, 0.0)::DOUBLE AS score
FROM doc LEFT JOIN verdict USING (r)
"""

# The checksum is computed byte by byte from a table that follows from its polynomial.
_SHARDS = r"""
WITH crc_table AS (
  SELECT string_agg(printf('%08x', c), '' ORDER BY i) AS crc
  FROM (SELECT i, list_reduce(list_prepend(i::UBIGINT, range(8)::UBIGINT[]),
                              lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END) AS c
        FROM range(256) t(i))),
doc AS (
  SELECT doc_id, source, coalesce(text, '') AS t, md5('20|' || coalesce(doc_id::VARCHAR, 'null')) AS h
  FROM documents),
sized AS (
  SELECT doc_id, source, h, strlen(t) + 1 AS size,
         xor(list_reduce(list_prepend(4294967295::UBIGINT,
               list_transform(regexp_extract_all(hex(encode(t)), '..'), lambda x: ('0x' || x)::UBIGINT)),
             lambda c, b: xor(c >> 8, ('0x' || substr(crc, 8 * (xor(c, b) & 255)::BIGINT + 1, 8))::UBIGINT)),
             4294967295::UBIGINT)::BIGINT AS text_crc32
  FROM doc, crc_table),
in_source AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY h, doc_id, text_crc32, size) AS k,
         count(*) OVER (PARTITION BY source) AS n FROM sized),
placed AS (
  SELECT *, row_number() OVER (ORDER BY (k - 0.5::DOUBLE) / n, source NULLS FIRST, h, doc_id, text_crc32, size) - 1 AS p,
         count(*) OVER () AS total FROM in_source)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'rows' AS law, (p * 16 // total)::INTEGER AS shard,
       (p - ((p * 16 // total) * total + 15) // 16)::BIGINT AS slot, NULL::INTEGER AS grown_shard
FROM placed
"""

_RANKED = r"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
size AS (SELECT count(*) FILTER (len(terms) > 0) AS filled, sum(len(terms))::BIGINT AS total FROM doc),
held AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM doc) GROUP BY r, term),
weight AS (
  SELECT term, floor(1000 * ln((2 * filled + 2) / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM held GROUP BY term), size),
item AS (
  SELECT DISTINCT item_id, term FROM (
    SELECT item_id, unnest(regexp_extract_all(
             translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)),
length AS (SELECT r, doc_id, 10 + (90 * len(terms) * filled) // total AS m FROM doc, size WHERE total > 0),
scored AS (
  SELECT item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM item JOIN weight USING (term) JOIN held USING (term) JOIN length USING (r)
  GROUP BY item_id, r, doc_id),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST) AS place
  FROM scored WHERE score > 0)
SELECT item_id, place::INTEGER AS rank, doc_id, score FROM placed WHERE place <= 10
"""

# The cheapest edits by searching forward: a step holds, for each role said last, the least
# cost, the edits and the lines so far; the edits as a string decide between equal costs.
_REPAIR = r"""
WITH RECURSIVE crc_table AS (
  SELECT string_agg(printf('%08x', c), '' ORDER BY i) AS crc
  FROM (SELECT i, list_reduce(list_prepend(i::UBIGINT, range(8)::UBIGINT[]),
                              lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END) AS c
        FROM range(256) t(i))),
faulty AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce(list_prepend(4294967295::UBIGINT,
               list_transform(regexp_extract_all(hex(encode(
                 coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))), '..'),
                 lambda x: ('0x' || x)::UBIGINT)),
             lambda c, b: xor(c >> 8, ('0x' || substr(crc, 8 * (xor(c, b) & 255)::BIGINT + 1, 8))::UBIGINT)),
             4294967295::UBIGINT)::BIGINT % 20 AS fault
  FROM conversations, crc_table),
damaged AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
         CASE fault WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(CASE WHEN fault = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM faulty WHERE fault <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS k,
         substr(role, 1, 1) AS r FROM damaged),
row_of AS (
  SELECT *, chr(10) || role || ':' || text AS line, blank OR duplicate AS goes, truncated::INTEGER AS stays,
         lag(r) OVER (PARTITION BY conv_id ORDER BY i) || r NOT IN ('su', 'ua', 'au') AS illegal
  FROM (SELECT *, NOT has_text AS blank, has_text AND k > 1 AS duplicate, has_text AND k = 1 AND NOT ended AS truncated
        FROM (SELECT *, regexp_matches(text, '[^\x20\x09-\x0D]') AS has_text,
                     regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS ended FROM placed))),
-- n, s, u, a: the least way to have said nothing, or last the system, the user, the assistant.
step AS (
  SELECT conv_id, 0::BIGINT AS i, {'c': 0, 'e': '', 'l': ''} AS n,
         {'c': 1000000000, 'e': '', 'l': ''} AS s, {'c': 1000000000, 'e': '', 'l': ''} AS u, {'c': 1000000000, 'e': '', 'l': ''} AS a
  FROM (SELECT DISTINCT conv_id FROM row_of)
  UNION ALL
  SELECT conv_id, i,
         {'c': n.c + 3, 'e': n.e || 'D', 'l': n.l},
         list_min([{'c': s.c + 3, 'e': s.e || 'D', 'l': s.l},
                   {'c': n.c + stays + CASE WHEN r = 's' THEN bar ELSE 1000000000 END, 'e': n.e || 'K', 'l': n.l || line}]),
         list_min([{'c': v.c + 3, 'e': v.e || 'D', 'l': v.l},
                   {'c': least_u.c + stays + CASE WHEN r = 'u' THEN bar ELSE 1000000000 END, 'e': least_u.e || 'K', 'l': least_u.l || line},
                   {'c': least_u.c + stays + 2 + bar, 'e': least_u.e || 'R', 'l': least_u.l || chr(10) || 'user:' || text}]),
         list_min([{'c': b.c + 3, 'e': b.e || 'D', 'l': b.l},
                   {'c': v.c + stays + CASE WHEN r = 'a' THEN bar ELSE 1000000000 END, 'e': v.e || 'K', 'l': v.l || line},
                   {'c': v.c + stays + 2 + bar, 'e': v.e || 'R', 'l': v.l || chr(10) || 'assistant:' || text}])
  FROM (
    SELECT x.*, list_min([n, s, b]) AS least_u
    FROM (
      SELECT w.*, list_min([a, {'c': v.c + 2, 'e': v.e || 'I', 'l': v.l || chr(10) || 'assistant:'}]) AS b
      FROM (
        SELECT step.*, row_of.i AS at, r, line, text, stays, CASE WHEN goes THEN 1000000000 ELSE 0 END AS bar,
               list_min([u, {'c': n.c + 2, 'e': n.e || 'I', 'l': n.l || chr(10) || 'user:'},
                         {'c': s.c + 2, 'e': s.e || 'I', 'l': s.l || chr(10) || 'user:'},
                         {'c': a.c + 2, 'e': a.e || 'I', 'l': a.l || chr(10) || 'user:'}]) AS v
        FROM step JOIN row_of ON row_of.conv_id IS NOT DISTINCT FROM step.conv_id AND row_of.i = step.i + 1) w) x) y(
      conv_id, before, n, s, u, a, i, r, line, text, stays, bar, v, b, least_u)),
total AS (
  SELECT conv_id, count(*) AS n_rows, count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
         count(*) FILTER (truncated) AS truncated, count(*) FILTER (illegal) AS illegal,
         coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps
  FROM row_of GROUP BY conv_id),
ended AS (
  SELECT t.*, list_min([n, a, {'c': u.c + 2, 'e': u.e || 'I', 'l': u.l || chr(10) || 'assistant:'},
                        {'c': s.c + 4, 'e': s.e || 'II', 'l': s.l || chr(10) || 'user:' || chr(10) || 'assistant:'}]) AS best
  FROM total t JOIN step ON step.conv_id IS NOT DISTINCT FROM t.conv_id AND step.i = t.n_rows)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.c, 0)::BIGINT AS cost,
       coalesce(best.e, '') AS audit, sha256(coalesce(substr(best.l, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
"""

ORACLES: dict[str, str] = {
    "op2_license_scan": _LICENSES,
    "op5_interleaved_sharding": _SHARDS,
    "op12_ranked_search": _RANKED,
    "op13_conversation_repair": _REPAIR,
}
