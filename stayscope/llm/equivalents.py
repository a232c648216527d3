"""The SQL of those queries that SQL can express."""

from __future__ import annotations

SQL: dict[str, str] = {}


def _crc32(text: str) -> str:
    """The CRC-32 of a text of ASCII characters, bit by bit."""
    bit = "CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END"
    byte = f"list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, _: {bit})"
    codes = f"list_transform(string_split({text}, ''), lambda s: CAST(ord(s) AS BIGINT))"
    return f"xor(list_reduce(list_concat([4294967295], {codes}), lambda c, b: {byte}), 4294967295)"

SQL["op2_line_dedup"] = """
WITH lines AS (
  SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS i
  FROM (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: NOT regexp_full_match(x, '[ \\t\\r\\x0b\\x0c]*')) AS l FROM documents)),
pairs AS (
  SELECT doc_id, i, line, lead(line) OVER (PARTITION BY doc_id ORDER BY i) AS following FROM lines),
firsts AS (
  SELECT line, following, min((doc_id, i)) AS place FROM pairs WHERE following IS NOT NULL GROUP BY ALL),
later AS (
  SELECT p.doc_id, p.i FROM pairs p JOIN firsts f ON p.line = f.line AND p.following = f.following WHERE (p.doc_id, p.i) > f.place),
gone AS (SELECT doc_id, i FROM later UNION SELECT doc_id, i + 1 FROM later),
runs AS (
  SELECT doc_id, count(*) AS size FROM (SELECT doc_id, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS run FROM gone)
  GROUP BY doc_id, run),
per_doc AS (SELECT doc_id, sum(size) AS n_removed, count(*) AS n_runs, max(size) AS longest_run FROM runs GROUP BY doc_id),
texts AS (
  SELECT l.doc_id, count(*) AS n_lines, string_agg(line, chr(10) ORDER BY l.i) FILTER (g.i IS NULL) AS kept
  FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.i = g.i GROUP BY l.doc_id)
SELECT d.doc_id, coalesce(t.n_lines, 0) AS n_lines, CAST(coalesce(p.n_removed, 0) AS BIGINT) AS n_removed, coalesce(p.n_runs, 0) AS n_runs,
  coalesce(p.longest_run, 0) AS longest_run, sha256(coalesce(t.kept, '')) AS kept_sha256
FROM documents d LEFT JOIN texts t USING (doc_id) LEFT JOIN per_doc p USING (doc_id)
"""

SQL["op3_url_filter"] = """
WITH rules(verdict, host, path) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
rest AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN url[instr(url, '://') + 3:] ELSE '' END AS rest FROM pages),
split AS (
  SELECT page_id, lower(regexp_extract(rest, '^[^/?#]*')) AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
fits AS (
  SELECT s.page_id, arg_max((r.host || r.path, r.verdict), length(r.host || r.path)) AS fit
  FROM split s JOIN rules r ON (s.host = r.host OR ends_with(s.host, '.' || r.host)) AND starts_with(s.path, r.path) GROUP BY s.page_id)
SELECT s.page_id, s.host, s.path, fit[1] AS rule, coalesce(fit[2], 'allow') AS verdict FROM split s LEFT JOIN fits USING (page_id)
"""

SQL["op4_substring_dedup"] = """
WITH docs AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\t\\n\\r\\x0b\\x0c]+'), lambda x: x <> '') AS w FROM documents),
windows AS (
  SELECT doc_id, s, md5(array_to_string(w[s:s + 34], ' ')) AS h FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS s FROM docs)),
repeated AS (SELECT h FROM windows GROUP BY h HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 35)) AS i FROM windows WHERE h IN (SELECT h FROM repeated)),
per_doc AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM docs),
kept AS (
  SELECT w.doc_id, string_agg(word, ' ' ORDER BY w.i) AS kept FROM words w ANTI JOIN gone g ON w.doc_id = g.doc_id AND w.i = g.i GROUP BY w.doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(p.n, 0) AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM docs d LEFT JOIN per_doc p USING (doc_id) LEFT JOIN kept k USING (doc_id)
"""

SQL["op6_exact_topk"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS vec FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(range(1, len(q.vec) + 1), lambda i: q.vec[i] * c.vec[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND q.vec_id % 100 = 0),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""

SQL["op8_near_dedup"] = """
WITH RECURSIVE docs AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[ \\t\\n\\r\\x0b\\x0c]+'), lambda x: x <> '') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, md5(array_to_string(w[s:s + 4], ' ')) AS h FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS s FROM docs WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared s JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * s.n >= 75 * (x.n + y.n - s.n)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, other) AS (
  SELECT a, a FROM edges UNION SELECT r.doc_id, e.b FROM reach r JOIN edges e ON r.other = e.a),
least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, coalesce(l.component_id, d.doc_id) AS component_id, coalesce(l.component_id, d.doc_id) = d.doc_id AS kept
FROM docs d LEFT JOIN sizes s USING (doc_id) LEFT JOIN least l USING (doc_id)
"""

SQL["op12_merkle"] = f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, source, {" || ".join(f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || {c}, '-')" for c in ("doc_id", "source", "lang", "n_chars"))} AS head, text,
    CASE WHEN {_crc32("CAST(doc_id AS VARCHAR)")} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS changed
  FROM documents),
leaves AS (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf, sha256(head || coalesce(strlen(changed) || ':' || changed, '-')) AS changed
  FROM docs),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY source) AS n FROM leaves),
tree(source, level, place, n, digest) AS (
  SELECT source, 0, place, n, leaf FROM placed
  UNION ALL
  SELECT source, level + 1, place // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY place)) FROM tree WHERE n > 1 GROUP BY source, level, place // 3, n),
subroots AS (
  SELECT source, digest, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place, count(*) OVER () AS n FROM tree WHERE n = 1),
upper(level, place, n, digest) AS (
  SELECT 0, place, n, digest FROM subroots
  UNION ALL
  SELECT level + 1, place // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY place)) FROM upper WHERE n > 1 GROUP BY level, place // 3, n),
own_runs AS (
  SELECT source, level, place // 3 AS run, list(digest ORDER BY place) AS run_digests FROM tree WHERE n > 1 GROUP BY source, level, place // 3),
upper_runs AS (SELECT level, place // 3 AS run, list(digest ORDER BY place) AS run_digests FROM upper WHERE n > 1 GROUP BY level, place // 3),
folds(doc_id, leaf, subroot_place, source, part, level, place, digest, siblings) AS (
  SELECT p.doc_id, p.leaf, s.place, p.source, 0, 0, p.place, p.changed, '' FROM placed p JOIN subroots s ON p.source IS NOT DISTINCT FROM s.source
  UNION ALL
  SELECT f.doc_id, f.leaf, f.subroot_place, f.source, CASE WHEN o.run IS NULL AND f.part = 0 THEN 1 ELSE f.part END,
    CASE WHEN o.run IS NULL AND f.part = 0 THEN 0 ELSE f.level + 1 END,
    CASE WHEN o.run IS NULL AND f.part = 0 THEN f.subroot_place ELSE f.place // 3 END,
    CASE WHEN coalesce(o.run, u.run) IS NULL THEN f.digest ELSE sha256(
      array_to_string(coalesce(o.run_digests, u.run_digests)[1:f.place % 3], '') || f.digest || array_to_string(coalesce(o.run_digests, u.run_digests)[f.place % 3 + 2:], '')) END,
    CASE WHEN coalesce(o.run, u.run) IS NULL THEN f.siblings ELSE f.siblings ||
      array_to_string(coalesce(o.run_digests, u.run_digests)[1:f.place % 3], '') || array_to_string(coalesce(o.run_digests, u.run_digests)[f.place % 3 + 2:], '') END
  FROM folds f LEFT JOIN own_runs o ON f.part = 0 AND f.source IS NOT DISTINCT FROM o.source AND f.level = o.level AND f.place // 3 = o.run
    LEFT JOIN upper_runs u ON f.part = 1 AND f.level = u.level AND f.place // 3 = u.run
  WHERE f.part = 0 OR u.run IS NOT NULL),
root AS (SELECT digest FROM upper WHERE n = 1),
levels AS (SELECT max(level) AS top FROM upper)
SELECT f.doc_id, f.leaf, s.digest AS subroot, r.digest AS root, sha256(f.siblings) AS proof_sha256, f.digest AS folded_root, f.digest = r.digest AS verified
FROM folds f JOIN levels l ON f.part = 1 AND f.level = l.top JOIN subroots s ON f.source IS NOT DISTINCT FROM s.source, root r
"""

SQL["op13_prefix_trie"] = f"""
WITH turns AS (
  SELECT conv_id, turn, octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, '') AS said, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, list({{'code': md5(said), 'bytes': octet_length(encode(text))}} ORDER BY turn NULLS FIRST, md5(said)) AS seq, {_crc32("CAST(conv_id AS VARCHAR)")} % 9 AS h
  FROM turns GROUP BY conv_id),
rebuilt AS (
  SELECT o.conv_id, list_concat(CASE WHEN b.seq IS NULL THEN [] ELSE b.seq[1:o.h] END, o.seq[o.h + 1:]) AS seq
  FROM own o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 5),
prefixes AS (SELECT conv_id, seq, unnest(range(0, len(seq) + 1)) AS depth FROM rebuilt),
keyed AS (
  SELECT conv_id, depth, len(seq) AS size, md5(array_to_string(list_transform(seq[1:depth], lambda t: t.code), '')) AS key,
    CASE WHEN depth > 0 THEN md5(array_to_string(list_transform(seq[1:depth - 1], lambda t: t.code), '')) END AS parent,
    CASE WHEN depth > 0 THEN seq[depth].bytes ELSE 0 END AS bytes
  FROM prefixes),
nodes AS (
  SELECT key, any_value(depth) AS depth, any_value(parent) AS parent, any_value(bytes) AS bytes, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (size = depth), '')) AS ends
  FROM keyed GROUP BY key),
children AS (SELECT parent AS key, count(*) AS n FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
up AS (SELECT DISTINCT k.key, a.key AS ancestor FROM keyed k JOIN keyed a ON a.conv_id = k.conv_id AND a.depth <= k.depth),
subtrees AS (
  SELECT u.ancestor AS key, sum(CASE WHEN c.key IS NULL THEN 1 ELSE 0 END) AS n_leaves, sum((n.n_convs - 1) * n.bytes) AS saved
  FROM up u JOIN nodes n ON u.key = n.key LEFT JOIN children c ON n.key = c.key GROUP BY u.ancestor)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children, CAST(s.n_leaves AS BIGINT) AS n_leaves,
  CAST(s.saved AS BIGINT) AS saved_tokens, n.ends AS ends_sha256
FROM nodes n JOIN subtrees s ON n.key = s.key LEFT JOIN children c ON n.key = c.key LEFT JOIN nodes p ON n.parent = p.key
"""
