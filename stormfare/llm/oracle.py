"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from stormfare.llm import conversation_trie, embeddings, hard_negatives as negatives, mixing, ngram, quality, warc

WORD = r"[^\x20\x09-\x0D]+"
BLANK = r"[\x20\x09-\x0D]"


def _listed(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def quality_rules() -> str:
    """Windows by unnesting, distances bin by bin."""
    declared = ", ".join(f"('{k}', {_listed(v)})" for k, v in quality.COMMON_WORDS.items())
    return rf"""
WITH docs AS (
  SELECT doc_id, lang, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents
), known(k, listed) AS (VALUES {declared}),
classes AS (
  SELECT doc_id, lang, t, w, len(w) AS n_words,
         length(regexp_replace(t, '\P{{Ll}}+', '', 'g')) AS c1,
         length(regexp_replace(t, '\P{{Lu}}+', '', 'g')) AS c2,
         length(regexp_replace(t, '\P{{Nd}}+', '', 'g')) AS c3,
         length(t) - length(regexp_replace(t, '{BLANK}+', '', 'g')) AS c4,
         length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS c5
  FROM docs
), bins AS (
  SELECT doc_id, lang, w, n_words, [c1, c2, c3, c4, c5, length(t) - c1 - c2 - c3 - c4 - c5] AS c,
         length(t) - c4 AS word_chars, c5 AS n_symbols,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM classes
), counted AS (
  SELECT b.doc_id, b.lang, b.n_words, b.c, k.k,
         list_transform(k.listed, lambda x: len(list_filter(b.w, lambda y: y = x))) AS m
  FROM bins b JOIN known k
    ON k.k = b.lang OR b.lang IS NULL OR b.lang NOT IN (SELECT k FROM known)
), common AS (
  SELECT *, list_append(m, n_words - list_sum(m)) AS h FROM counted
), refs AS (
  SELECT lang AS k, {', '.join(f'sum(c[{i}])::BIGINT AS c{i}' for i in range(1, 7))},
         {', '.join(f'sum(h[{i}])::BIGINT AS h{i}' for i in range(1, 10))}
  FROM common WHERE k = lang GROUP BY lang
), reflists AS (
  SELECT k, [{', '.join(f'c{i}' for i in range(1, 7))}] AS rc, [{', '.join(f'h{i}' for i in range(1, 10))}] AS rh
  FROM refs
), pairs AS (
  SELECT d.doc_id, d.n_words, d.c, d.h, r.rc, r.rh,
         list_sum(d.c) AS nc, list_sum(d.h) AS nh, list_sum(r.rc) AS mc, list_sum(r.rh) AS mh
  FROM common d JOIN reflists r USING (k)
), bits AS (
  SELECT doc_id,
    CASE WHEN nc > 0 AND mc > 0 THEN sqrt(greatest(0, 0.5 * list_sum(list_transform(generate_series(1, 6), lambda i:
      CASE WHEN c[i] > 0 THEN c[i] / nc * log2(2 * (c[i] / nc) / (c[i] / nc + rc[i] / mc)) ELSE 0 END
      + CASE WHEN rc[i] > 0 THEN rc[i] / mc * log2(2 * (rc[i] / mc) / (c[i] / nc + rc[i] / mc)) ELSE 0 END)))) END AS dc,
    CASE WHEN nh > 0 AND mh > 0 THEN sqrt(greatest(0, 0.5 * list_sum(list_transform(generate_series(1, 9), lambda i:
      CASE WHEN h[i] > 0 THEN h[i] / nh * log2(2 * (h[i] / nh) / (h[i] / nh + rh[i] / mh)) ELSE 0 END
      + CASE WHEN rh[i] > 0 THEN rh[i] / mh * log2(2 * (rh[i] / mh) / (h[i] / nh + rh[i] / mh)) ELSE 0 END)))) END AS dh
  FROM pairs
), distances AS (
  SELECT doc_id, coalesce(min(dc), 0) AS dc, coalesce(min(dh), 0) AS dh FROM bits GROUP BY doc_id
), windows AS (
  SELECT doc_id, i, list_slice(w, i, i + 7) AS win
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 7)) AS i FROM docs WHERE len(w) >= 8)
), twice AS (
  SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1
), covered AS (
  SELECT doc_id, sum(least(8, coalesce(nxt - i, 8)))::BIGINT AS n
  FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM twice) GROUP BY doc_id
), base AS (
  SELECT b.doc_id, b.n_words, b.word_chars, b.n_symbols,
         len(b.lines) - len(list_distinct(b.lines)) AS n_dup_lines,
         coalesce(v.n, 0) AS n_repeat_words, b.c[1] + b.c[2] AS letters
  FROM bins b LEFT JOIN covered v USING (doc_id)
), verdict AS (
  SELECT *, n_words < {quality.MIN_BASE_WORDS}
            OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM base
)
SELECT v.doc_id, v.n_words, v.word_chars, v.n_symbols, v.n_dup_lines, v.n_repeat_words, v.base_failed,
       NOT v.base_failed AND NOT (
         v.n_words >= {quality.MIN_WORDS} AND v.letters >= {quality.MIN_LETTERS}
         AND (coalesce(d.dc, 0) > {quality.MAX_CLASS_DISTANCE}
              OR coalesce(d.dh, 0) > {quality.WORD_DISTANCE} + {quality.WORD_DISTANCE_SPREAD} / sqrt(v.n_words))
       ) AS kept
FROM verdict v LEFT JOIN distances d USING (doc_id)
"""


def systematic_mix(seed: int = mixing.SEED) -> str:
    cap = mixing.MAX_COPIES
    return rf"""
WITH docs AS (
  SELECT doc_id, coalesce('=' || source, '~') AS s,
         len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS size FROM documents
), cells AS (
  SELECT *, length(bin(size)) * 16 + (size >> greatest(length(bin(size)) - 4, 0)) AS class,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 4))::INT % {mixing.BUCKETS} AS bucket FROM docs
), sources AS (
  SELECT s, sum(size)::BIGINT AS words, row_number() OVER (ORDER BY s) AS i FROM cells GROUP BY s
), weighted AS (
  SELECT *, [5, 2, 1][(i - 1) % 3 + 1]::BIGINT AS weight FROM sources
), ordered AS (
  SELECT *, sum(words) OVER () - {cap} * coalesce(sum(words) OVER (
              ORDER BY words / weight, s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS remaining,
         sum(weight) OVER (ORDER BY words / weight, s ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
  FROM weighted
), limited AS (
  SELECT *, {cap} * words * weights <= remaining * weight AS is_full FROM ordered
), targets AS (
  SELECT s, words AS source_size,
         CASE WHEN is_full THEN ({cap} * words)::DOUBLE ELSE
           (sum(words) OVER () - sum(CASE WHEN is_full THEN {cap} * words ELSE 0 END) OVER ())::DOUBLE * weight
           / (sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER ())::DOUBLE END AS target,
         ('0x' || substr(md5('{seed}:' || s), 1, 8))::BIGINT::DOUBLE / 4294967296.0::DOUBLE AS u
  FROM limited
), placed AS (
  SELECT c.*, t.source_size, t.target, t.u,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
         row_number() OVER (PARTITION BY c.s ORDER BY class, bucket, size, doc_id) AS k
  FROM cells c JOIN targets t USING (s)
)
SELECT doc_id, size, source_size, target,
       CASE WHEN size > 0 THEN least((floor(u + rate * k) - floor(u + rate * (k - 1)))::BIGINT, {cap}) ELSE 0 END
       * size AS taken
FROM placed
"""


_COMPONENTS = """
reach(a, b) AS (
  SELECT a, b FROM edges UNION SELECT r.a, e.b FROM reach r JOIN edges e ON e.a = r.b
), component AS (SELECT a AS id, min(least(a, b)) AS c FROM reach GROUP BY a)"""


def ngram_groups() -> str:
    """Shared shingles counted for all pairs that share one; links followed to their ends."""
    upper, lower = ngram.UPPER, ngram.LOWER
    return rf"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '{WORD}') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, list_slice(w, i, i + 4) AS s
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 4))) AS i FROM docs WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * k >= {ngram.PERCENT} * (p.n + q.n - k)
), edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
{_COMPONENTS}
SELECT d.doc_id, coalesce(z.n, 0) AS n_shingles, coalesce(c.c, d.doc_id) AS component_id
FROM docs d LEFT JOIN sizes z USING (doc_id) LEFT JOIN component c ON c.id = d.doc_id
"""


def embedding_duplicates() -> str:
    """Every pair of a label by its cosine; links followed to their ends."""
    return f"""
WITH RECURSIVE vectors AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
), unit AS (
  SELECT vec_id, label, list_transform(v, lambda x: x / sqrt(list_sum(list_transform(v, lambda y: y * y)))) AS u
  FROM vectors
  WHERE label IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(v, lambda x: x <> 0)) > 0
), links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM unit x JOIN unit y
    ON x.label = y.label AND x.vec_id < y.vec_id AND len(x.u) = len(y.u)
  WHERE list_dot_product(x.u, y.u) >= {embeddings.MIN_COSINE}
), edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
{_COMPONENTS},
counts AS (SELECT a, count(*) AS n FROM edges GROUP BY a)
SELECT v.vec_id, coalesce(n, 0) AS n_links, coalesce(c.c, v.vec_id) AS component_id,
       coalesce(c.c, v.vec_id) = v.vec_id AS kept
FROM vectors v LEFT JOIN counts ON counts.a = v.vec_id LEFT JOIN component c ON c.id = v.vec_id
"""


def warc_round_trip() -> str:
    return f"""
WITH pages AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), firsts AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM pages
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= {warc.MIN_REVISIT_BYTES} AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= {warc.MIN_REVISIT_BYTES} AND page_id <> first THEN first END AS refers_to
FROM firsts
"""


def url_rules(rules: list[tuple[str, str, str]]) -> str:
    values = ", ".join(f"('{a}', '{h}', '{p}')" for a, h, p in rules)
    split = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    return rf"""
WITH urls AS (
  SELECT page_id, coalesce(translate(regexp_extract(url, '{split}', 1),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '{split}', 2), '') AS path FROM pages
), rules(action, rule_host, rule_path) AS (VALUES {values}),
fitting AS (
  SELECT u.page_id, r.* FROM urls u JOIN rules r
    ON (u.host = r.rule_host OR ends_with(u.host, '.' || r.rule_host)) AND starts_with(u.path, r.rule_path)
), best AS (
  SELECT page_id, rule_host || rule_path AS rule, action FROM fitting
  QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC,
                             length(rule_host) DESC, action DESC) = 1
)
SELECT u.page_id, u.host, u.path, b.rule, coalesce(b.action, 'allow') AS verdict
FROM urls u LEFT JOIN best b USING (page_id)
"""


def hard_negatives() -> str:
    """Every anchor's score with every row, ranked twice."""
    return f"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding::DOUBLE[], lambda x: floor({negatives.SCALE} * x)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS id, list_dot_product(a.q, b.q)::BIGINT AS s
  FROM v a JOIN v b ON a.vec_id % {negatives.ANCHOR_EVERY} = 0 AND b.vec_id <> a.vec_id
), positives AS (
  SELECT anchor_id, id AS positive_id, s AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY s DESC, id) <= {negatives.POSITIVES}
)
SELECT anchor_id, positive_id,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s DESC, id)::INTEGER AS rank,
       id AS negative_id, positive_score, s AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND {negatives.LOWEST_PERCENT} * positive_score <= 100 * s
  AND 100 * s <= {negatives.HIGHEST_PERCENT} * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s DESC, id) <= {negatives.NEGATIVES}
"""


def conversation_prefixes() -> str:
    """Nodes as lists of all their turns; each node joined with all nodes above it."""
    # Reflected CRC-32, eight shifts to a byte; 3988292384 is its polynomial.
    crc = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''),
             lambda x: unicode(x)::BIGINT)), lambda a, b: list_reduce(list_prepend(xor(a, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
             lambda r, z: xor(r >> 1, 3988292384 * (r & 1)))), 4294967295)"""
    return f"""
WITH given AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS p
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT c, c - c % {conversation_trie.BASE_EVERY} AS base, {crc} % {conversation_trie.HEAD_KINDS} AS h
  FROM (SELECT DISTINCT c FROM given)
), rebuilt AS (
  SELECT k.c, 0 AS part, g.p, role, text FROM convs k JOIN given g ON g.c = k.base AND g.p <= k.h
  UNION ALL
  SELECT k.c, 1, g.p, role, text FROM convs k JOIN given g ON g.c = k.c AND g.p > k.h
), placed AS (
  SELECT c, row_number() OVER w AS d, list(struct_pack(role := role, text := text)) OVER w AS path, length(text) AS chars
  FROM rebuilt WINDOW w AS (PARTITION BY c ORDER BY part, p ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), paths AS (
  SELECT c, d, path, chars FROM placed
  UNION ALL SELECT c, 0, [], 0 FROM convs
), lengths AS (SELECT c, max(d) AS n FROM paths GROUP BY c),
nodes AS (
  SELECT path, d, min(c) AS c, count(*) AS n_convs, (count(*) - 1) * min(chars) AS saved,
         sha256(coalesce(string_agg(CASE WHEN d = n THEN c::VARCHAR END, ',' ORDER BY c), '')) AS ends
  FROM paths JOIN lengths USING (c) GROUP BY path, d
), member AS (SELECT p.c, p.d, n.c AS node FROM paths p JOIN nodes n ON n.path = p.path AND n.d = p.d),
parents AS (
  SELECT n.c, n.d, m.node AS parent FROM nodes n JOIN member m ON m.c = n.c AND m.d = n.d - 1
), children AS (SELECT parent AS c, d - 1 AS d, count(*) AS n FROM parents GROUP BY ALL),
measured AS (SELECT n.*, coalesce(k.n, 0) AS n_children FROM nodes n LEFT JOIN children k ON k.c = n.c AND k.d = n.d),
sums AS (
  SELECT m.node AS c, m.d, sum(saved)::BIGINT AS saved, sum((n_children = 0)::INT)::BIGINT AS leaves
  FROM measured u JOIN member m ON m.c = u.c AND m.d <= u.d GROUP BY ALL
)
SELECT m.c AS conv_id, m.d::BIGINT AS depth, p.parent AS parent_conv_id, m.n_convs, m.n_children,
       s.leaves AS n_leaves, s.saved AS saved_tokens, m.ends AS ends_sha256
FROM measured m JOIN sums s ON s.c = m.c AND s.d = m.d LEFT JOIN parents p ON p.c = m.c AND p.d = m.d
"""
