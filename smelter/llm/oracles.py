"""The SQL counterparts, for DuckDB, of the queries that SQL can express."""

from __future__ import annotations

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

JACCARD = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, list_slice(w, i, i + 3) AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY ALL HAVING 100 * count(*) >= 85 * (any_value(x.n) + any_value(y.n) - count(*))),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
lowest AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM documents d JOIN lowest ON a = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id"""

ARCHIVE = """
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS payload, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes FROM pages),
largest AS (SELECT payload, max(page_id) AS holder FROM payloads GROUP BY payload)
SELECT page_id, payload_bytes, sha1(payload) AS payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id <> holder THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> holder THEN holder END AS refers_to
FROM payloads JOIN largest USING (payload)"""

MIX = rf"""
WITH sized AS (SELECT doc_id, source, CAST(len({WORDS}) AS BIGINT) AS size FROM documents),
sums AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, CASE (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight,
    3 * source_size AS cap FROM sums),
levels AS (
  SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0) AS DOUBLE)
    / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS DOUBLE) AS level
  FROM weighed
  WINDOW before AS (ORDER BY CAST(cap AS DOUBLE) / weight, encode(source) NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
final AS (
  SELECT level FROM levels WHERE level * weight <= cap ORDER BY CAST(cap AS DOUBLE) / weight, encode(source) NULLS LAST LIMIT 1),
targets AS (
  SELECT source, source_size,
    CASE WHEN l.level * weight > cap THEN CAST(cap AS DOUBLE) ELSE weight * (SELECT level FROM final) END AS target FROM levels l),
rates AS (
  SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate,
    CAST(CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':mix'), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496 AS drawn
  FROM sized s JOIN targets t ON t.source IS NOT DISTINCT FROM s.source)
SELECT doc_id, size, source_size, target,
  CAST(size * (CAST(floor(rate) AS BIGINT) + CASE WHEN drawn < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM rates"""

TOP_K = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
    CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scores)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10"""

#: No page of the tables names another address, so aliases are trivial variants only.
URLS = r"""
WITH parts AS (
  SELECT page_id, coalesce(url, '') AS url,
    translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path FROM pages),
rules(action, rule, rule_host, rule_path) AS (VALUES ('allow', 'org/', 'org', '/'), ('block', 'example.org/es/', 'example.org', '/es/'),
  ('block', 'example.org/en/1', 'example.org', '/en/1'), ('allow', 'com/fr/', 'com', '/fr/'), ('block', 'com/de/', 'com', '/de/')),
fitting AS (
  SELECT url, arg_max(rule, length(rule)) AS rule, arg_max(action, length(rule)) AS action
  FROM (SELECT DISTINCT url, host, path FROM parts)
  JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY url),
judged AS (
  SELECT page_id, host, path, rule, action,
    CASE WHEN contains(p.url, '://') THEN host || CASE WHEN path = '' THEN '/' ELSE path END || regexp_extract(p.url, '^.*?://[^?#]*(\?[^#]*)', 1, 's')
      ELSE p.url END AS node
  FROM parts p LEFT JOIN fitting f ON f.url = p.url),
reached AS (SELECT node, bool_or(action = 'block') AND NOT coalesce(bool_or(action = 'allow'), false) AS blocked FROM judged GROUP BY node)
SELECT page_id, host, path, rule, coalesce(action, CASE WHEN blocked THEN 'block' ELSE 'allow' END) AS verdict
FROM judged JOIN reached USING (node)"""

LOWERED = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

LINES = f"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
placed AS (
  SELECT doc_id, place, lines[place] AS line, trim(translate(lines[place], {LOWERED}), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS key
  FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS place FROM split)),
repeated AS (
  SELECT key, max(doc_id) AS keeper FROM placed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
judged AS (SELECT doc_id, place, line, coalesce(doc_id <> keeper, false) AS dropped FROM placed LEFT JOIN repeated USING (key))
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE dropped) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id"""

def _merkle(levels: int = 7) -> str:
    """Trees of up to 16**levels leaves, a common table expression per level; trees that have ended are carried along."""

    def leaf(text: str) -> str:
        fields = ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text)
        return "sha256(" + " || ".join(f"CASE WHEN {f} IS NULL THEN '-' ELSE strlen({f}) || ':' || {f} END" for f in fields) + ")"

    parts = [
        f"""leaves AS (
  SELECT doc_id, source, {leaf("text")} AS h, {leaf(f"translate(text, {LOWERED})")} AS lower_h,
    row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS i, count(*) OVER (PARTITION BY source) AS n
  FROM documents)""",
        "s0 AS (SELECT source AS tree, i, n, h FROM leaves)",
    ]

    def grown(name: str) -> None:
        for level in range(levels):
            parts.append(f"""{name}{level + 1} AS (
  SELECT tree, i // 16 AS i, (n + 15) // 16 AS n, sha256(string_agg(h, '' ORDER BY {name}{level}.i)) AS h
  FROM {name}{level} WHERE n > 1 GROUP BY tree, {name}{level}.i // 16, n UNION ALL SELECT * FROM {name}{level} WHERE n = 1)""")

    grown("s")
    parts.append(f"""ranked AS (SELECT tree, h, row_number() OVER (ORDER BY encode(tree) NULLS FIRST) - 1 AS i FROM s{levels})""")
    parts.append("t0 AS (SELECT 'top' AS tree, i, (SELECT count(*) FROM ranked) AS n, h FROM ranked)")
    grown("t")
    parts.append("""p0 AS (
  SELECT doc_id, source AS tree, i, h AS leaf, '' AS proof, CASE WHEN crc % 5 = 0 THEN lower_h ELSE h END AS fold
  FROM leaves JOIN (SELECT doc_id, crc FROM checksums) USING (doc_id))""")

    def folded(name: str, start: int) -> None:
        for k in range(levels):
            parts.append(f"""p{start + k + 1} AS (
  SELECT doc_id, p.tree, p.i // 16 AS i, leaf, proof || coalesce(string_agg(h, '' ORDER BY x.i) FILTER (WHERE x.i <> p.i), '') AS proof,
    CASE WHEN n = 1 THEN fold ELSE sha256(string_agg(CASE WHEN x.i = p.i THEN fold ELSE h END, '' ORDER BY x.i)) END AS fold
  FROM p{start + k} p JOIN {name}{k} x ON x.tree IS NOT DISTINCT FROM p.tree AND x.i // 16 = p.i // 16
  GROUP BY doc_id, p.tree, p.i, leaf, proof, fold, n)""")

    folded("s", 0)
    parts.append(f"""q0 AS (
  SELECT doc_id, 'top' AS tree, ranked.i, leaf, h AS subroot, proof, fold
  FROM p{levels} p JOIN ranked ON ranked.tree IS NOT DISTINCT FROM p.tree)""")
    parts.append(f"p{levels + 1} AS (SELECT doc_id, tree, i, leaf, proof, fold FROM q0)")
    folded("t", levels + 1)
    return f"""WITH {CRC}, {", ".join(parts)}
SELECT doc_id, p.leaf, subroot, h AS root, sha256(p.proof) AS proof_sha256, p.fold AS folded_root, p.fold = h AS verified
FROM p{2 * levels + 1} p JOIN q0 USING (doc_id) CROSS JOIN t{levels}"""


#: DuckDB has no crc32: eight shifts a digit, by the reversed polynomial.
CRC = """RECURSIVE crc(doc_id, rest, step, c) AS (
  SELECT doc_id, CAST(doc_id AS VARCHAR), 8, CAST(4294967295 AS BIGINT) FROM documents WHERE doc_id IS NOT NULL
  UNION ALL
  SELECT doc_id, CASE WHEN step = 8 THEN substr(rest, 2) ELSE rest END, CASE WHEN step = 8 THEN 1 ELSE step + 1 END,
    CASE WHEN fed % 2 = 1 THEN xor(fed // 2, 3988292384) ELSE fed // 2 END
  FROM (SELECT *, CASE WHEN step = 8 THEN xor(c, CAST(ascii(rest) AS BIGINT)) ELSE c END AS fed FROM crc WHERE step < 8 OR rest <> '')),
checksums AS (SELECT doc_id, xor(c, 4294967295) AS crc FROM crc WHERE step = 8 AND rest = '')"""

ORACLES: dict[str, str] = {
    "op1_ngram_jaccard_join": JACCARD,
    "op3_web_archive": ARCHIVE,
    "op4_mixing": MIX,
    "op7_url_filters": URLS,
    "op8_top_k": TOP_K,
    "op11_line_dedup": LINES,
    "op12_merkle_manifest": _merkle(),
}
