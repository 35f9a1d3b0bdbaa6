"""DuckDB SQL for the queries that SQL can express."""

EXACT_DEDUP = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm FROM documents
), r AS (
  SELECT doc_id, norm,
         first_value(doc_id) OVER (PARTITION BY norm ORDER BY length(t) DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY norm) AS group_size
  FROM d
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM r
"""

SUBSTRING_DEDUP = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), runs AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS run
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d)
), least AS (
  SELECT run, min(doc_id) AS first_id FROM runs GROUP BY run
), gone AS (
  SELECT doc_id, list(DISTINCT j) AS js
  FROM (SELECT r.doc_id, unnest(range(r.i, r.i + 13)) AS j FROM runs r JOIN least l USING (run) WHERE l.first_id < r.doc_id)
  GROUP BY doc_id
), words AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS j FROM d
), kept AS (
  SELECT w.doc_id, string_agg(word, ' ' ORDER BY w.j) AS text
  FROM words w LEFT JOIN (SELECT doc_id, unnest(js) AS j FROM gone) g ON g.doc_id = w.doc_id AND g.j = w.j
  WHERE g.j IS NULL GROUP BY w.doc_id
)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(len(gone.js), 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

REVERSED_SEARCH = r"""
WITH folded AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), d AS (
  SELECT doc_id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM folded
), totals AS (
  SELECT count(*) FILTER (len(w) > 0) AS big_n, sum(len(w))::BIGINT AS big_l FROM d
), asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), tf AS (
  SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(w) AS n, unnest(w) AS term FROM d) GROUP BY ALL
), df AS (
  SELECT term, count(*) AS df FROM tf GROUP BY term
), scored AS (
  SELECT item_id, doc_id,
         sum(floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * df + 1)))::BIGINT
             * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * big_n) // big_l)))))::BIGINT AS score
  FROM asked JOIN tf USING (term) JOIN df USING (term), totals GROUP BY item_id, doc_id
), placed AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM scored WHERE score > 0
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM placed WHERE rank <= 10
"""

MERKLE_MANIFEST = r"""
WITH RECURSIVE checksum_table AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i::BIGINT, range(8)),
                          lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v
    FROM range(256) AS r(i))
), d AS (
  SELECT doc_id, coalesce('=' || source, '') AS tree, lang, n_chars, source, text,
         list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
                     lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])) AS crc
  FROM documents, checksum_table
), said AS (
  SELECT doc_id, tree, text, crc,
         coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
           || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head
  FROM d
), leaves AS (
  SELECT doc_id, tree, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         -- the checksum's last bit is inverted at its end
         CASE WHEN crc & 1 = 1 THEN sha256(head || coalesce(strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), ''), '-')) END AS altered
  FROM said
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM leaves
), nodes AS (
  SELECT tree, 0 AS lvl, pos, n, leaf AS h FROM placed
  UNION ALL
  SELECT tree, lvl + 1, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM nodes WHERE n > 1 GROUP BY tree, lvl, pos // 3, n
), sources AS (
  SELECT tree, h AS subroot, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1
), joint AS (
  SELECT 0 AS lvl, pos, n, subroot AS h FROM sources
  UNION ALL
  SELECT lvl + 1, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM joint WHERE n > 1 GROUP BY lvl, pos // 3, n
), all_nodes AS (
  SELECT tree, lvl, pos, h FROM nodes WHERE n > 1 UNION ALL SELECT NULL, lvl, pos, h FROM joint WHERE n > 1
), beside AS (
  SELECT tree, lvl, pos,
         coalesce(string_agg(h, '' ORDER BY pos) OVER (PARTITION BY tree, lvl, pos // 3 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS b,
         coalesce(string_agg(h, '' ORDER BY pos) OVER (PARTITION BY tree, lvl, pos // 3 ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS a
  FROM all_nodes
), low AS (
  SELECT p.doc_id, p.tree, p.leaf, p.pos AS leaf_pos, 0 AS lvl, p.pos, coalesce(p.altered, p.leaf) AS h, '' AS proof FROM placed p
  UNION ALL
  SELECT l.doc_id, l.tree, l.leaf, l.leaf_pos, l.lvl + 1, l.pos // 3, sha256(s.b || l.h || s.a), l.proof || s.b || s.a
  FROM low l JOIN beside s ON s.tree = l.tree AND s.lvl = l.lvl AND s.pos = l.pos
), arrived AS (
  SELECT l.*, s.subroot, s.pos AS source_pos FROM low l JOIN sources s USING (tree)
  WHERE l.lvl = (SELECT max(lvl) FROM nodes n WHERE n.tree = l.tree)
), high AS (
  SELECT doc_id, tree, leaf, leaf_pos, subroot, 0 AS lvl, source_pos AS pos, h, proof FROM arrived
  UNION ALL
  SELECT l.doc_id, l.tree, l.leaf, l.leaf_pos, l.subroot, l.lvl + 1, l.pos // 3, sha256(s.b || l.h || s.a), l.proof || s.b || s.a
  FROM high l JOIN beside s ON s.tree IS NULL AND s.lvl = l.lvl AND s.pos = l.pos
), top AS (
  SELECT h AS root, lvl FROM joint WHERE n = 1
)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, h AS folded_root, h = root AS verified FROM high JOIN top USING (lvl)
"""

ORACLES: dict[str, str] = {
    "op2_substring_dedup": SUBSTRING_DEDUP,
    "op9_exact_dedup": EXACT_DEDUP,
    "op12_merkle_manifest": MERKLE_MANIFEST,
    "op13_reversed_search": REVERSED_SEARCH,
}
