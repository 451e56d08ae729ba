"""DuckDB SQL for the rows of the corpus queries that SQL can express: each compares everything with everything."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"
LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
# A vector takes part if it is not empty and holds only finite numbers.
WHOLE = "len({v}) > 0 AND list_bool_and([x IS NOT NULL AND isfinite(x) for x in {v}])"

ORACLES = {
    "op7_cover_tree": f"""
WITH v AS (
  SELECT vec_id, [floor(64 * x::DOUBLE) for x in embedding] AS e
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND {WHOLE.format(v="embedding")}
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM scored QUALIFY rank <= 20
""",
    "op8_odd_sketch": f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({LOWERED}, '{WORD}') AS words FROM documents
), starts AS (
  SELECT doc_id, words, unnest(range(1, greatest(len(words) - 2, 2))) AS p FROM w WHERE len(words) > 0
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(words[p : p + 3], ' ') AS s FROM starts
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
  SELECT c.a, c.b FROM common c JOIN sizes x ON x.doc_id = c.a JOIN sizes y ON y.doc_id = c.b
  WHERE 100 * c.n >= 80 * (x.n + y.n - c.n)
), reach(a, b) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
), heads AS (
  SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a
)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN heads h ON h.doc_id = d.doc_id LEFT JOIN sizes z ON z.doc_id = d.doc_id
""",
    "op10_cover_dedup": f"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS words FROM documents
), starts AS (
  SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS p FROM w WHERE len(words) >= 50
), windows AS (
  SELECT doc_id, p, md5(array_to_string(words[p : p + 49], ' ')) AS h FROM starts
), firsts AS (
  SELECT h, min(doc_id) AS least FROM windows GROUP BY h
), gone AS (
  SELECT DISTINCT doc_id, p + i AS place
  FROM windows JOIN firsts USING (h), range(0, 50) AS t(i) WHERE least < doc_id
), placed AS (
  SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM w
), marked AS (
  SELECT p.doc_id, p.word, p.place, g.place IS NOT NULL AS removed
  FROM placed p LEFT JOIN gone g ON g.doc_id = p.doc_id AND g.place = p.place
), joined AS (
  SELECT doc_id, count(*) FILTER (removed) AS n_removed, string_agg(word, ' ' ORDER BY place) FILTER (NOT removed) AS kept
  FROM marked GROUP BY doc_id
)
SELECT w.doc_id, len(words)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN joined j ON j.doc_id = w.doc_id
""",
    "op11_collision_join": f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND {WHOLE.format(v="embedding")}
    AND list_bool_or([x <> 0 for x in embedding])
), links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.e) = len(y.e)
  WHERE list_cosine_similarity(x.e, y.e) >= 0.98
), reach(a, b) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
), heads AS (
  SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a
), counts AS (
  SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a
)
SELECT e.vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN heads h ON h.vec_id = e.vec_id LEFT JOIN counts c ON c.vec_id = e.vec_id
""",
    "op12_fill_middle": r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS lines,
    sha256('7:' || doc_id) AS draw FROM documents
), h AS (
  SELECT doc_id, t, lines, len(lines) AS n, ('0x' || draw[1:8])::BIGINT AS h1, ('0x' || draw[9:16])::BIGINT AS h2,
    ('0x' || draw[17:24])::BIGINT AS h3, ('0x' || draw[25:32])::BIGINT AS h4 FROM d
), cut AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS low, greatest(h1 % (n + 1), h2 % (n + 1)) AS high,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain'
      WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM h
), parts AS (
  SELECT *, coalesce(array_to_string(lines[1 : low], ''), '') AS prefix, coalesce(array_to_string(lines[low + 1 : high], ''), '') AS middle,
    coalesce(array_to_string(lines[high + 1 : n], ''), '') AS suffix FROM cut
)
SELECT doc_id, n::BIGINT AS n, form,
  CASE WHEN form <> 'plain' THEN length(prefix) END::BIGINT AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END::BIGINT AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM parts
""",
}
