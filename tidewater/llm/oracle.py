"""DuckDB SQL for the operators whose contracts SQL can express: brute force
over all pairs and windows, for tables of the size the SQL check runs on."""

from __future__ import annotations

WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
LOWERED = ("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
           "'abcdefghijklmnopqrstuvwxyz')")

#: Smallest id reachable from each id of ``nodes`` (id) through ``links`` (x, y).
REACHED = """
both_ways AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reached(id, root) AS (
  SELECT id, id FROM nodes
  UNION SELECT b.y, r.root FROM reached r JOIN both_ways b ON b.x = r.id),
least AS (SELECT id, MIN(root) AS component_id FROM reached GROUP BY id)"""

OP2 = f"""
WITH RECURSIVE words AS (SELECT doc_id, {WORDS.format(LOWERED)} AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) < 2 THEN w ELSE list_distinct(list_transform(
           range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS shingles
  FROM words),
members AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM sets),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM members a JOIN members b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * COUNT(*) >= 80 * (a.n + b.n - COUNT(*))),
nodes AS (SELECT doc_id AS id FROM documents),{REACHED}
SELECT doc_id, CAST(len(shingles) AS BIGINT) AS n_shingles, component_id,
       doc_id = component_id AS kept
FROM sets JOIN least ON id = doc_id"""

OP3 = f"""
WITH RECURSIVE vectors AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
    AND len(list_filter(embedding, lambda c: c <> 0)) > 0),
scaled AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS length FROM vectors),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM scaled a JOIN scaled b
    ON a.vec_id < b.vec_id AND len(a.e) = len(b.e)
   AND list_dot_product(a.e, b.e) / (a.length * b.length) >= 0.95),
nodes AS (SELECT vec_id AS id FROM embeddings),{REACHED},
counts AS (SELECT x, COUNT(*) AS n FROM both_ways GROUP BY x)
SELECT v.vec_id, CAST(coalesce(c.n, 0) AS BIGINT) AS n_links, l.component_id,
       v.vec_id = l.component_id AS kept
FROM embeddings v JOIN least l ON l.id = v.vec_id LEFT JOIN counts c ON c.x = v.vec_id"""

OP6 = f"""
WITH words AS (SELECT doc_id, {WORDS.format("coalesce(text, '')")} AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS sequence
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM words WHERE len(w) >= 35) t),
repeated AS (SELECT doc_id, i FROM windows
             QUALIFY COUNT(*) OVER (PARTITION BY sequence) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS place FROM repeated),
places AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS place FROM words),
kept AS (
  SELECT doc_id, COUNT(*) AS n, string_agg(word, ' ' ORDER BY place) AS text
  FROM places ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
       CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)"""

#: Letters of the runs are ASCII or two bytes of UTF-8, the first of them 195.
OP11 = r"""
WITH RECURSIVE steps(i, k, v) AS (
  SELECT range, 0, range FROM range(256)
  UNION ALL
  SELECT i, k + 1, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END
  FROM steps WHERE k < 8),
lookup AS (SELECT list(v ORDER BY i) AS t FROM steps WHERE k = 8),
found AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(
           coalesce(text, ''), '[A-Za-z\x{00C0}-\x{00FF}]+')),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents),
runs AS (SELECT doc_id, run, COUNT(*) AS k FROM found GROUP BY doc_id, run),
summed AS (
  SELECT run, k, xor(4294967295, list_reduce(list_prepend(4294967295, flatten(list_transform(
           string_split(concat(doc_id, ':', run), ''), lambda c:
             CASE WHEN unicode(c) < 128 THEN [unicode(c)] ELSE [195, unicode(c) - 64] END))),
         lambda crc, b: xor(crc // 256, t[xor(crc, b) % 256 + 1]))) AS h
  FROM runs, lookup),
words AS (
  SELECT word, CAST(SUM(k) AS BIGINT) AS n FROM (
    SELECT k, CASE WHEN h % 97 = 0 THEN left(run, h % length(run))
                   || substr(run, h % length(run) + 2) ELSE run END AS word FROM summed) a
  WHERE length(word) >= 5 GROUP BY word HAVING SUM(k) >= 3),
rests AS (
  SELECT word, i, left(word, i) || substr(word, i + 2) AS rest
  FROM (SELECT word, unnest(range(length(word))) AS i FROM words) p),
links AS (
  SELECT a.word AS x, b.word AS y FROM rests a JOIN rests b
    ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT r.word, w.word FROM rests r JOIN words w ON w.word = r.rest
  UNION SELECT w.word, r.word FROM rests r JOIN words w ON w.word = r.rest),
counts AS (SELECT x, COUNT(*) AS n_near FROM links GROUP BY x),
best AS (
  SELECT x, y, w.n FROM links JOIN words w ON w.word = y
  QUALIFY row_number() OVER (PARTITION BY x ORDER BY w.n DESC, y) = 1),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
         CASE WHEN best.n >= 2 * w.n THEN y END AS form,
         CASE WHEN best.n >= 2 * w.n THEN best.n END AS form_n
  FROM words w LEFT JOIN counts ON counts.x = w.word LEFT JOIN best ON best.x = w.word),
chain(word, root) AS (
  SELECT word, word FROM forms
  UNION ALL SELECT c.word, f.form FROM chain c JOIN forms f ON f.word = c.root
  WHERE f.form IS NOT NULL)
SELECT f.word, f.form, c.root, f.n, CAST(f.n_near AS BIGINT) AS n_near, f.form_n
FROM forms f JOIN chain c ON c.word = f.word JOIN forms r ON r.word = c.root
WHERE r.form IS NULL"""

OP12 = """
WITH taking AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
pairs AS (
  SELECT a.id AS anchor_id, r.id AS id, a.label = r.label AS same,
         CAST(list_dot_product(a.v, r.v) AS BIGINT) AS score
  FROM taking a JOIN taking r ON a.id % 50 = 0 AND a.id <> r.id AND len(a.v) = len(r.v)),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id
                               ORDER BY score DESC, id) AS INTEGER) AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.same
 AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id) <= 3"""

ORACLE = {"op2_minhash": OP2, "op3_embeddings": OP3, "op6_substring": OP6, "op11_variants": OP11,
          "op12_negatives": OP12}
