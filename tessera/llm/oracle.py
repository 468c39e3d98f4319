"""DuckDB SQL for the queries of this package that SQL can express."""

from __future__ import annotations

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

#: Windows of 35 words that start at two places or more; the words they cover go.
REPEATS = rf"""
WITH docs AS (SELECT doc_id, {WORDS} AS ws FROM documents),
starts AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS i FROM docs WHERE len(ws) >= 35),
windows AS (SELECT doc_id, i, array_to_string(ws[i:i + 34], ' ') AS run FROM starts),
repeated AS (SELECT run FROM windows GROUP BY run HAVING count(*) > 1),
covered AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p FROM windows JOIN repeated USING (run)),
words AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS p FROM docs),
kept AS (SELECT w.doc_id, count(*) AS n, string_agg(w.w, ' ' ORDER BY w.p) AS text
         FROM words w ANTI JOIN covered c ON w.doc_id = c.doc_id AND w.p = c.p GROUP BY w.doc_id)
SELECT d.doc_id, len(d.ws)::BIGINT AS n_words, (len(d.ws) - coalesce(k.n, 0))::BIGINT AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM docs d LEFT JOIN kept k USING (doc_id)
"""

#: The ten best documents by BM25 for every document whose id is divisible by 20.
SEARCH = rf"""
WITH terms AS (SELECT doc_id, w, count(*) AS n FROM (SELECT doc_id, unnest({WORDS.replace("coalesce(text", "lower(coalesce(text").replace(", '')", ", ''))")}) AS w FROM documents) GROUP BY ALL),
lengths AS (SELECT doc_id, len({WORDS}) AS dl FROM documents),
stats AS (SELECT count(*) AS n_docs, sum(dl) / count(*) AS mean FROM lengths),
idf AS (SELECT w, ln(1 + ((SELECT n_docs FROM stats) - count(*) + 0.5::DOUBLE) / (count(*) + 0.5::DOUBLE)) AS idf FROM terms GROUP BY w),
scored AS (
  SELECT q.doc_id AS query_id, d.doc_id AS id,
         round(sum(q.n * i.idf * d.n * 2.2::DOUBLE / (d.n + 1.2::DOUBLE * (1 - 0.75::DOUBLE + 0.75::DOUBLE * l.dl / (SELECT mean FROM stats)))), 6) AS score
  FROM terms q JOIN terms d USING (w) JOIN idf i USING (w) JOIN lengths l ON l.doc_id = d.doc_id
  WHERE q.doc_id % 20 = 0 GROUP BY ALL)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank, id AS doc_id, score
FROM scored QUALIFY rank <= 10
"""

#: Targets by one common level under the caps; then ranks by random odds over inclusion odds, cut where a source's words are reached.
MIXING = rf"""
WITH m AS (
  SELECT doc_id, source, len({WORDS})::BIGINT AS size,
         ('0x' || substr(md5(concat_ws('|', 'mix', coalesce(doc_id::VARCHAR, ''), coalesce(text, ''))), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0::DOUBLE AS u
  FROM documents),
sizes AS (
  SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w FROM m GROUP BY source),
limits AS (SELECT *, 3 * source_size / w AS lim FROM sizes),
levels AS (
  SELECT *, (sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER b, 0))::DOUBLE / (sum(w) OVER () - coalesce(sum(w) OVER b, 0))::DOUBLE AS level
  FROM limits WINDOW b AS (ORDER BY lim, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
common AS (SELECT level FROM levels WHERE level <= lim ORDER BY lim, level LIMIT 1),
targets AS (SELECT source, source_size, least(3.0::DOUBLE * source_size, (SELECT level FROM common) * w) AS target FROM levels),
due AS (
  SELECT m.*, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN least(3.0::DOUBLE, t.target * 1.0::DOUBLE / t.source_size::DOUBLE) ELSE 0 END AS due
  FROM m JOIN targets t ON m.source IS NOT DISTINCT FROM t.source),
drawn AS (
  SELECT *, floor(due + 1e-9::DOUBLE)::BIGINT AS whole, due - floor(due + 1e-9::DOUBLE) AS p,
         CASE WHEN p > 1e-9::DOUBLE THEN u * (1 - p) / (u * (1 - p) + p * (1 - u)) END AS r FROM due),
wanted AS (SELECT source, any_value(target) - sum(whole * size)::DOUBLE AS wanted FROM drawn GROUP BY source),
classes AS (SELECT source, r, sum(size) AS words FROM drawn WHERE r IS NOT NULL GROUP BY source, r),
running AS (SELECT *, sum(words) OVER (PARTITION BY source ORDER BY r) AS upto FROM classes),
reached AS (
  SELECT c.source, min(c.r) AS cut, arg_min(c.upto - c.words, c.r) AS done FROM running c JOIN wanted w ON c.source IS NOT DISTINCT FROM w.source
  WHERE w.wanted > 0 AND c.upto >= w.wanted GROUP BY c.source),
cuts AS (
  SELECT w.source, coalesce(x.cut, 2.0) AS cut, w.wanted - coalesce(x.done::DOUBLE, w.wanted) AS gap
  FROM wanted w LEFT JOIN reached x ON w.source IS NOT DISTINCT FROM x.source WHERE w.wanted > 0),
fits AS (
  SELECT c.source, arg_min(k.r, struct_pack(off := abs(c.gap - k.words), r := k.r)) AS fit FROM cuts c JOIN classes k ON c.source IS NOT DISTINCT FROM k.source
  WHERE k.r >= c.cut AND abs(c.gap - k.words) < c.gap GROUP BY c.source)
SELECT d.doc_id, d.size, d.source_size, d.target,
       (d.size * (d.whole + CASE WHEN coalesce(d.r < c.cut, false) OR coalesce(d.r = f.fit, false) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM drawn d LEFT JOIN cuts c ON d.source IS NOT DISTINCT FROM c.source LEFT JOIN fits f ON d.source IS NOT DISTINCT FROM f.source
"""


def _field(value: str) -> str:
    return f"coalesce(strlen(({value})::VARCHAR) || ':' || ({value})::VARCHAR, '-')"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(map(_field, ("doc_id", "source", "lang", n_chars, "text"))) + ")"


#: crc32 of a string of digits, eight shifts a byte.
CRC32 = "xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({0}, ''), lambda c: ord(c)::BIGINT)), lambda x, b: list_reduce(list_prepend(xor(x, b), range(8)), lambda y, i: xor(y >> 1, 3988292384 * (y & 1)))), 4294967295)"

#: Levels of the leaves of every lang, levels of their subroots, and every leaf's siblings from the bottom up.
MANIFEST = f"""
WITH RECURSIVE leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS pos FROM (
    SELECT doc_id, lang, {_leaf("n_chars")} AS leaf, {_leaf("CASE WHEN " + CRC32.format("doc_id::VARCHAR") + " % 7 = 0 THEN n_chars + 1 ELSE n_chars END")} AS tried FROM documents)),
nodes AS (
  SELECT lang, 0 AS level, pos, leaf AS digest FROM leaves
  UNION ALL
  SELECT lang, level + 1, pos // 2, sha256(digest || coalesce(next, ''))
  FROM (SELECT *, lead(digest) OVER w AS next, count(*) OVER (PARTITION BY lang) AS m FROM nodes WINDOW w AS (PARTITION BY lang ORDER BY pos)) WHERE pos % 2 = 0 AND m > 1),
subroots AS (SELECT lang, max(level) AS depth, arg_max(digest, level) AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place FROM nodes GROUP BY lang),
upper AS (
  SELECT 0 AS level, place AS pos, subroot AS digest FROM subroots
  UNION ALL
  SELECT level + 1, pos // 2, sha256(digest || coalesce(next, ''))
  FROM (SELECT *, lead(digest) OVER (ORDER BY pos) AS next, count(*) OVER () AS m FROM upper) WHERE pos % 2 = 0 AND m > 1),
top AS (SELECT max(level) AS depth, arg_max(digest, level) AS root FROM upper),
steps AS (
  SELECT l.lang, l.pos, h.level, CASE WHEN (l.pos >> h.level) % 2 = 1 THEN '<' ELSE '>' END || coalesce(n.digest, '') AS sibling
  FROM leaves l JOIN subroots s ON l.lang IS NOT DISTINCT FROM s.lang, LATERAL (SELECT unnest(range(s.depth)) AS level) h
  LEFT JOIN nodes n ON n.lang IS NOT DISTINCT FROM l.lang AND n.level = h.level AND n.pos = xor(l.pos >> h.level, 1)),
low AS (SELECT lang, pos, list(sibling ORDER BY level) AS path FROM steps GROUP BY lang, pos),
high AS (
  SELECT s.lang, list(CASE WHEN (s.place >> h.level) % 2 = 1 THEN '<' ELSE '>' END || coalesce(u.digest, '') ORDER BY h.level) AS path
  FROM subroots s, (SELECT unnest(range(depth)) AS level FROM top) h LEFT JOIN upper u ON u.level = h.level AND u.pos = xor(s.place >> h.level, 1) GROUP BY s.lang),
paths AS (
  SELECT l.*, s.subroot, t.root, list_concat(coalesce(a.path, []), coalesce(b.path, [])) AS path
  FROM leaves l JOIN subroots s ON l.lang IS NOT DISTINCT FROM s.lang, top t
  LEFT JOIN low a ON a.lang IS NOT DISTINCT FROM l.lang AND a.pos = l.pos LEFT JOIN high b ON b.lang IS NOT DISTINCT FROM l.lang),
folded AS (
  SELECT *, list_reduce(list_prepend(tried, path), lambda x, s: sha256(CASE WHEN s[1] = '<' THEN s[2:] || x ELSE x || s[2:] END)) AS folded_root FROM paths)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(path, lambda s: s[2:]), '')) AS proof_sha256, folded_root, folded_root = root AS verified FROM folded
"""

#: Integer products of every anchor with all other rows; positives, windows, negatives.
NEGATIVES = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT::DOUBLE) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND NOT list_bool_or(list_transform(embedding, lambda x: x IS NULL OR NOT isfinite(x)))),
scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, list_inner_product(a.v, r.v)::BIGINT AS score
  FROM rows a JOIN rows r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id),
positives AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, (row_number() OVER w)::INTEGER AS rank, s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM positives p JOIN scored s USING (anchor_id) WHERE NOT s.same AND 80 * positive_score <= 100 * s.score AND s.score <= positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) QUALIFY row_number() OVER w <= 5
"""

#: The first page of every payload of at least 100 bytes is a response, the others revisit it.
WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
f AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha256(html) AS payload_digest, min(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 100 AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND first <> page_id THEN first END AS refers_to FROM f
"""

#: Links of all pairs of a label, and the smallest vector that each one reaches.
EMBEDDINGS = """
WITH RECURSIVE fine AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND NOT list_bool_or(list_transform(embedding, lambda x: x IS NULL OR NOT isfinite(x))) AND list_bool_or(list_transform(embedding, lambda x: x <> 0))),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM fine a JOIN fine b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_inner_product(a.v, b.v) / sqrt(list_inner_product(a.v, a.v)) / sqrt(list_inner_product(b.v, b.v)) >= 0.93),
reach AS (SELECT a AS vec_id, a AS root FROM links UNION SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.vec_id),
roots AS (SELECT vec_id, min(root) AS root FROM reach GROUP BY vec_id),
counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(c.n, 0)::BIGINT AS n_links, coalesce(r.root, e.vec_id) AS component_id, coalesce(r.root, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN roots r USING (vec_id) LEFT JOIN counts c USING (vec_id)
"""

SQL: dict[str, str] = {"op8_embeddings": EMBEDDINGS, "op13_warc": WARC, "op12_negatives": NEGATIVES, "op11_manifest": MANIFEST, "op3_repeats": REPEATS, "op6_search": SEARCH, "op9_mixing": MIXING}
