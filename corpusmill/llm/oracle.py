"""DuckDB SQL for the queries that SQL can express on whole tables."""

OP8 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND list_count(embedding) = len(embedding) AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
    CAST(list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""

_WORDS = "list_filter(regexp_split_to_array({}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"

OP2 = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS l
  FROM documents WHERE text IS NOT NULL
), cut AS (
  SELECT doc_id, l, line, {_WORDS.format("line")} AS w FROM lines
), firsts AS (
  SELECT w, min((doc_id, l)) AS place, len(w) AS n FROM cut WHERE len(w) > 0 GROUP BY w
), less AS (
  SELECT place, n, i, w[1:i - 1] || w[i + 1:] AS v FROM firsts, range(1, n + 1) r(i) WHERE n >= 4
), near AS (
  SELECT b.place FROM less a JOIN less b ON a.v = b.v AND a.i = b.i AND a.n = b.n AND a.n >= 5 AND a.place < b.place
  UNION
  SELECT greatest(l.place, f.place) FROM less l JOIN firsts f ON f.w = l.v WHERE f.n >= 5
), kept AS (
  SELECT c.doc_id, c.l, c.line FROM cut c LEFT JOIN firsts f ON f.w = c.w
  WHERE len(c.w) = 0 OR (f.place = (c.doc_id, c.l) AND f.place NOT IN (SELECT place FROM near))
), joined AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY l) AS text, count(*) AS k FROM kept GROUP BY doc_id
)
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(j.text, '') END AS text,
  CAST(coalesce(len(string_split(d.text, chr(10))), 0) AS BIGINT) AS n_lines,
  CAST(coalesce(len(string_split(d.text, chr(10))), 0) - coalesce(j.k, 0) AS BIGINT) AS n_removed
FROM documents d LEFT JOIN joined j ON j.doc_id = d.doc_id
"""

OP6 = f"""
WITH d AS (
  SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents
), p AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d)
), m AS (
  SELECT doc_id, i, min(doc_id) OVER (PARTITION BY k) AS f FROM p
), c AS (
  SELECT doc_id, list(DISTINCT j) AS gone FROM (SELECT doc_id, unnest(range(i, i + 13)) AS j FROM m WHERE f < doc_id) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
  sha256(coalesce(array_to_string(CASE WHEN gone IS NULL THEN w
    ELSE list_filter(w, lambda x, i: NOT list_contains(gone, i)) END, ' '), '')) AS kept_sha256
FROM d LEFT JOIN c ON c.doc_id = d.doc_id
"""

def _field(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR) END"


def _leaf(n_chars: str) -> str:
    return f"sha256({' || '.join(_field(v) for v in ('doc_id', 'source', 'lang', n_chars, 'text'))})"


# a byte of the decimal id enters the register, then eight shifts
_CRC = """xor(4294967295, list_reduce(flatten(list_transform(range(1, len(CAST(doc_id AS VARCHAR)) + 1),
  lambda i: [CAST(ascii(substr(CAST(doc_id AS VARCHAR), CAST(i AS INTEGER), 1)) AS BIGINT), 0, 0, 0, 0, 0, 0, 0])),
  lambda c, b: xor(xor(c, b) >> 1, (xor(c, b) & 1) * 3988292384), CAST(4294967295 AS BIGINT)))"""

OP13 = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, lang, {_leaf('n_chars')} AS leaf,
    CASE WHEN {_CRC} % 7 = 0 THEN {_leaf('(n_chars + 1)')} ELSE {_leaf('n_chars')} END AS tried
  FROM documents
), langs AS (
  SELECT lang, count(*) AS n, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS t, count(*) OVER () AS trees FROM leaves GROUP BY lang
), ranked AS (
  SELECT l.doc_id, g.t, g.n, g.trees, leaf, tried,
    row_number() OVER (PARTITION BY g.t ORDER BY l.doc_id NULLS FIRST, leaf, tried) - 1 AS r
  FROM leaves l JOIN langs g ON l.lang IS NOT DISTINCT FROM g.lang
), up AS (
  SELECT t, 0 AS lvl, r AS i, leaf AS h, n FROM ranked
  UNION ALL
  SELECT t, lvl + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), any_value((n + 1) // 2) FROM up WHERE n > 1 GROUP BY t, lvl, i // 2
), over AS (
  SELECT 0 AS lvl, up.t AS i, h, trees AS n FROM up JOIN langs ON up.t = langs.t WHERE up.n = 1
  UNION ALL
  SELECT lvl + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), any_value((n + 1) // 2) FROM over WHERE n > 1 GROUP BY lvl, i // 2
), steps AS (
  SELECT d.t, d.r, a.lvl, CASE WHEN b.h IS NULL THEN '-' WHEN b.i < a.i THEN 'L' || b.h ELSE 'R' || b.h END AS s
  FROM ranked d JOIN up a ON a.t = d.t AND a.n > 1 AND a.i = d.r >> a.lvl LEFT JOIN up b ON b.t = a.t AND b.lvl = a.lvl AND b.i = xor(a.i, 1)
  UNION ALL
  SELECT d.t, d.r, 100 + a.lvl, CASE WHEN b.h IS NULL THEN '-' WHEN b.i < a.i THEN 'L' || b.h ELSE 'R' || b.h END
  FROM ranked d JOIN over a ON a.n > 1 AND a.i = d.t >> a.lvl LEFT JOIN over b ON b.lvl = a.lvl AND b.i = xor(a.i, 1)
), proofs AS (
  SELECT t, r, list(s ORDER BY lvl) AS s FROM steps GROUP BY t, r
), folded AS (
  SELECT d.doc_id, d.leaf, o.h AS subroot, (SELECT h FROM over WHERE n = 1) AS root, coalesce(s, CAST([] AS VARCHAR[])) AS s, tried
  FROM ranked d JOIN over o ON o.lvl = 0 AND o.i = d.t LEFT JOIN proofs p ON p.t = d.t AND p.r = d.r
), done AS (
  SELECT *, list_reduce(s, lambda h, x: CASE left(x, 1) WHEN 'L' THEN sha256(substr(x, 2) || h) WHEN 'R' THEN sha256(h || substr(x, 2))
    ELSE sha256(h) END, tried) AS folded_root FROM folded
)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(s, lambda x: substr(x, 2)), '')) AS proof_sha256,
  folded_root, folded_root = root AS verified
FROM done
"""

SQL = {"op2_lines": OP2, "op6_superkmers": OP6, "op8_topk": OP8, "op13_merkle": OP13}
