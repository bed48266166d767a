"""SQL equivalents of those llm queries that plain SQL can state."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce({0}, ''), '[^\x20\x09-\x0D]+')"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_FOLDED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE: dict[str, str] = {
    # Base 32 by hand: the digest's 160 bits, five at a time.
    "op4_warc": """
WITH payloads AS (
  SELECT page_id, url, coalesce(html, '') AS payload,
    array_to_string([
      ['0000', '0001', '0010', '0011', '0100', '0101', '0110', '0111', '1000', '1001',
       '1010', '1011', '1100', '1101', '1110', '1111'][strpos('0123456789abcdef', c)]
      FOR c IN regexp_extract_all(sha1(coalesce(html, '')), '.')], '') AS bits
  FROM pages),
firsts AS (SELECT payload, min(page_id) AS first FROM payloads GROUP BY payload)
SELECT page_id, url, CAST(strlen(payload) AS BIGINT) AS payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1
    + 16 * CAST(substr(bits, 5 * i + 1, 1) AS INT) + 8 * CAST(substr(bits, 5 * i + 2, 1) AS INT)
    + 4 * CAST(substr(bits, 5 * i + 3, 1) AS INT) + 2 * CAST(substr(bits, 5 * i + 4, 1) AS INT)
    + CAST(substr(bits, 5 * i + 5, 1) AS INT), 1) FOR i IN range(32)], '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM payloads JOIN firsts USING (payload)""",
    "op5_maxscore": """
WITH whole AS (
  SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS vec
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum([q.vec[i] * c.vec[i] FOR i IN range(1, len(q.vec) + 1)]) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id AND len(q.vec) = len(c.vec)
  WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
  FROM scored)
WHERE rank <= 10""",
    "op6_jaccard": f"""
WITH RECURSIVE texts AS (SELECT doc_id, {_WORDS.format(_FOLDED)} AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, least(len(w), 1) + 1))) AS i
        FROM texts)),
sizes AS (
  SELECT t.doc_id, count(s) AS n FROM texts t LEFT JOIN shingles g USING (doc_id)
  GROUP BY t.doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * common.n >= 75 * (p.n + q.n - common.n)),
reach AS (
  SELECT doc_id, doc_id AS seen FROM texts
  UNION SELECT r.doc_id, l.y FROM reach r JOIN links l ON l.x = r.seen)
SELECT doc_id, n AS n_shingles, min(seen) AS component_id
FROM sizes JOIN reach USING (doc_id) GROUP BY doc_id, n""",
    "op7_substring": f"""
WITH texts AS (SELECT doc_id, {_WORDS.format("text")} AS w FROM documents),
starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM texts),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS s FROM starts),
repeated AS (
  SELECT doc_id, i FROM windows WHERE s IN (SELECT s FROM windows GROUP BY s HAVING count(*) > 1)),
words AS (
  SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM texts),
marked AS (
  SELECT words.doc_id, words.i, word, max(repeated.i) OVER (
    PARTITION BY words.doc_id ORDER BY words.i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS cover
  FROM words LEFT JOIN repeated ON repeated.doc_id = words.doc_id AND repeated.i = words.i),
kept AS (
  SELECT doc_id, count(*) AS n_words, count(cover) AS n_removed,
    string_agg(word, ' ' ORDER BY i) FILTER (WHERE cover IS NULL) AS rest
  FROM marked GROUP BY doc_id)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
  sha256(coalesce(rest, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (doc_id)""",
    # An item's windows all have one length, so documents are cut into windows of that length.
    "op11_decontamination": f"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(coalesce({_FOLDED}, ''), '{_ALNUM}') AS w FROM documents),
own AS (
  SELECT item_id, regexp_extract_all(coalesce({_FOLDED}, ''), '{_ALNUM}') AS w FROM benchmark),
cut AS (
  SELECT item_id, least(len(w), 10) AS m, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i
  FROM own WHERE len(w) > 0),
items AS (SELECT DISTINCT item_id, m, array_to_string(w[i:i + m - 1], ' ') AS s FROM cut),
lengths AS (SELECT DISTINCT m FROM items),
windows AS (
  SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS s
  FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM texts, lengths)),
hits AS (SELECT doc_id, i, windows.m, item_id FROM windows JOIN items USING (s)),
covered AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + m)) AS place FROM hits) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM texts LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)""",
    "op12_filter_audit": f"""
WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, {_WORDS.format("text")} AS w
  FROM documents),
firsts AS (SELECT t, min(doc_id) AS least FROM texts GROUP BY t),
known AS (
  SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic
  FROM labels GROUP BY doc_id),
judged AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    {{'A': len(w) < 200,
      'B': 100 * len(list_distinct(w)) < 50 * len(w),
      'C': 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t),
      'D': regexp_matches(t, '[#$%&*|]'),
      'E': coalesce(least < doc_id, false)}} AS f
  FROM texts JOIN firsts USING (t) LEFT JOIN known USING (doc_id)),
failed AS (
  SELECT part, good, toxic, concat(CASE WHEN f.A THEN 'A' ELSE '' END, CASE WHEN f.B THEN 'B' ELSE '' END,
    CASE WHEN f.C THEN 'C' ELSE '' END, CASE WHEN f.D THEN 'D' ELSE '' END, CASE WHEN f.E THEN 'E' ELSE '' END) AS letters
  FROM judged),
sets AS (
  SELECT part, letters, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic
  FROM failed GROUP BY part, letters),
letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM letter a JOIN letter b ON b.x <> a.x JOIN letter c ON c.x NOT IN (a.x, b.x)
    JOIN letter d ON d.x NOT IN (a.x, b.x, c.x) JOIN letter e ON e.x NOT IN (a.x, b.x, c.x, d.x)),
steps AS (SELECT filter_order, unnest(range(1, 6)) AS step FROM orders),
at_step AS (
  SELECT part, filter_order, step, filter_order[step] AS filter, n, good, toxic,
    letters <> '' AND regexp_matches(letters, '[' || filter_order[1:step] || ']') AS gone,
    step > 1 AND regexp_matches(letters, '[' || filter_order[1:greatest(step - 1, 1)] || ']') AS gone_before,
    contains(letters, filter_order[step]) AS fails, letters = filter_order[step] AS alone
  FROM sets, steps),
counted AS (
  SELECT part, filter_order, step, filter,
    sum(CASE WHEN gone THEN 0 ELSE n END) AS kept,
    sum(CASE WHEN fails AND NOT gone_before THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN fails AND gone_before THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN alone THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN fails AND NOT gone_before THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN fails AND NOT gone_before THEN toxic ELSE 0 END) AS toxic_lost
  FROM at_step GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INT) AS step, filter, CAST(kept AS BIGINT) AS kept,
  CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley
FROM counted""",
}
