"""SQL for DuckDB of the queries that SQL can express; the tests hold the others against plain Python."""

from __future__ import annotations



def _crc_table() -> list[int]:
    """The 256 remainders of the CRC-32 that zlib uses, from its polynomial."""
    table = []
    for value in range(256):
        for _ in range(8):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        table.append(value)
    return table


SQL = {
    "op11_jump_shards": f"""WITH RECURSIVE
b AS (SELECT doc_id, coalesce(octet_length(encode(text)), 0) + 16 AS size,
        list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::BIGINT) AS bytes FROM documents),
d AS (SELECT doc_id, CAST(size AS BIGINT) AS size,
        xor(list_reduce(bytes, lambda c, x: xor(c >> 8, ({_crc_table()})[CAST(xor(c, x) & 255 AS INTEGER) + 1]), 4294967295::BIGINT), 4294967295) AS text_crc32
      FROM b),
k AS (SELECT DISTINCT doc_id, ('0x' || md5(coalesce(CAST(doc_id AS VARCHAR), ''))[:16])::HUGEINT AS key0 FROM documents),
j AS (SELECT doc_id, key0 AS key, -1::BIGINT AS b, 0::BIGINT AS j FROM k
      UNION ALL
      SELECT doc_id, key, j, CAST(floor((j + 1) * (2147483648.0::DOUBLE / CAST((key >> 33) + 1 AS DOUBLE))) AS BIGINT)
      FROM (SELECT doc_id, (key * 2862933555777941757 + 1) % 18446744073709551616 AS key, j FROM j WHERE j < 41)),
s AS (SELECT doc_id, max(b) FILTER (b < 40) AS shard, max(b) FILTER (b < 41) AS grown FROM j GROUP BY 1),
p AS (SELECT d.*, s.shard, s.grown FROM d JOIN s ON d.doc_id IS NOT DISTINCT FROM s.doc_id)
SELECT doc_id, size, text_crc32, 'key' AS law, CAST(shard AS INTEGER) AS shard, CAST(grown AS INTEGER) AS grown_shard,
  row_number() OVER (PARTITION BY shard
    ORDER BY md5(concat_ws('|', coalesce(CAST(doc_id AS VARCHAR), ''), size, text_crc32)), doc_id NULLS FIRST, size, text_crc32) - 1 AS slot
FROM p""",
    "op6_metric_range_join": """WITH RECURSIVE
v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
      WHERE vec_id IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
      WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
r AS (SELECT a AS vec_id, a AS root FROM l UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.vec_id),
c AS (SELECT vec_id, min(root) AS component_id FROM r GROUP BY 1),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM l GROUP BY 1)
SELECT m.vec_id, coalesce(n.n_links, 0) AS n_links, coalesce(c.component_id, m.vec_id) AS component_id,
  m.vec_id IS NULL OR coalesce(c.component_id, m.vec_id) = m.vec_id AS kept
FROM embeddings m LEFT JOIN n USING (vec_id) LEFT JOIN c USING (vec_id)""",
    "op9_line_set_join": r"""WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS ln, generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM documents WHERE doc_id IS NOT NULL),
worded AS (SELECT *, list_sort(list_distinct(list_filter(string_split_regex(ln, '[ \t\r\f\v]+'), lambda x: x <> ''))) AS s FROM lines),
sets AS (SELECT s, f, len(s) AS n, row_number() OVER (ORDER BY f) AS id
         FROM (SELECT s, min({'d': doc_id, 'p': pos}) AS f FROM worded WHERE len(s) > 0 GROUP BY s)),
tokens AS (SELECT id, n, unnest(s) AS w FROM sets),
df AS (SELECT w, count(*) AS c FROM tokens GROUP BY 1),
prefix AS (SELECT id, n, w FROM tokens JOIN df USING (w)
           QUALIFY row_number() OVER (PARTITION BY id ORDER BY c, w) <= n - CAST(ceil(0.8 * n - 1e-9) AS BIGINT) + 1),
pairs AS (SELECT DISTINCT a.id AS a, b.id AS b FROM prefix a JOIN prefix b
          ON a.w = b.w AND a.id < b.id AND a.n >= 0.8 * b.n - 1e-9 AND b.n >= 0.8 * a.n - 1e-9),
gone AS (SELECT DISTINCT b AS id FROM pairs JOIN sets x ON x.id = a JOIN sets y ON y.id = b
         WHERE len(list_intersect(x.s, y.s)) >= 0.8 * (x.n + y.n - len(list_intersect(x.s, y.s))) - 1e-9),
kept AS (SELECT f.d AS doc_id, f.p AS pos FROM sets WHERE id NOT IN (SELECT id FROM gone)),
marked AS (SELECT l.doc_id, l.pos, l.ln, k.pos IS NOT NULL OR len(l.s) = 0 AS keep
           FROM worded l LEFT JOIN kept k USING (doc_id, pos)),
t AS (SELECT doc_id, count(*) AS n, count(*) FILTER (NOT keep) AS gone, string_agg(ln, chr(10) ORDER BY pos) FILTER (keep) AS text
      FROM marked GROUP BY 1)
SELECT d.doc_id, CAST(coalesce(t.n, 0) AS INTEGER) AS n_lines, CAST(coalesce(t.gone, 0) AS INTEGER) AS n_removed,
  CASE WHEN d.text IS NULL OR d.doc_id IS NULL THEN d.text ELSE coalesce(t.text, '') END AS text
FROM documents d LEFT JOIN t USING (doc_id)""",
}
