"""DuckDB statements for the corpus operators that SQL can express."""

from __future__ import annotations


def crc32(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text, bit by bit; the table is not needed."""
    steps = (
        f"list_concat([4294967295::BIGINT], flatten(list_transform(range(1, length({text}) + 1), "
        f"lambda i: list_concat([ascii(substr({text}, i::INTEGER, 1))::BIGINT], "
        "list_transform(range(8), lambda j: -1::BIGINT)))))"
    )
    step = "CASE WHEN b >= 0 THEN xor(a, b) ELSE xor(a >> 1, 3988292384 * (a & 1)) END"
    return f"xor(list_reduce({steps}, lambda a, b: {step}), 4294967295)"


OP13_TRIE = f"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, turn
  FROM conversations WHERE conv_id IS NOT NULL),
hashed AS (
  SELECT conv_id, turn, md5(length(role)::VARCHAR || ':' || role || text) AS digest,
         len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words
  FROM turns),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) AS pos FROM hashed),
ids AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base, {crc32("conv_id::VARCHAR")} % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM numbered)),
parts AS (
  SELECT i.conv_id, 0 AS part, n.pos, n.digest, n.words FROM ids i JOIN numbered n ON n.conv_id = i.base AND n.pos <= i.h
  UNION ALL
  SELECT i.conv_id, 1, n.pos, n.digest, n.words FROM ids i JOIN numbered n ON n.conv_id = i.conv_id AND n.pos > i.h),
placed AS (
  SELECT conv_id, digest, words, row_number() OVER w AS depth, string_agg(digest, '') OVER w AS path
  FROM parts
  WINDOW w AS (PARTITION BY conv_id ORDER BY part, pos ROWS UNBOUNDED PRECEDING)),
members AS (
  SELECT i.conv_id, coalesce(p.depth, 0) AS depth, coalesce(p.path, '') AS path, coalesce(p.words, 0) AS words,
         coalesce(e.n, 0) AS n_turns
  FROM (SELECT conv_id, depth, path, words FROM placed UNION ALL SELECT conv_id, 0, '', 0 FROM ids) p
  JOIN ids i USING (conv_id) LEFT JOIN (SELECT conv_id, count(*) AS n FROM placed GROUP BY conv_id) e USING (conv_id)),
nodes AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(words) AS words,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n_turns = depth), '')) AS ends_sha256
  FROM members GROUP BY path, depth),
family AS (
  SELECT n.*, p.conv_id AS parent_conv_id,
         (SELECT count(*) FROM nodes k WHERE k.depth = n.depth + 1 AND left(k.path, length(k.path) - 32) = n.path) AS n_children
  FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND left(n.path, length(n.path) - 32) = p.path),
below AS (
  SELECT m.path, sum((f.n_children = 0)::BIGINT) AS n_leaves, sum((f.n_convs - 1) * f.words) AS saved_tokens
  FROM family f JOIN members m ON m.conv_id = f.conv_id AND m.depth <= f.depth
  GROUP BY m.path)
SELECT f.conv_id, f.depth::BIGINT AS depth, f.parent_conv_id, f.n_convs::BIGINT AS n_convs,
       f.n_children::BIGINT AS n_children, b.n_leaves::BIGINT AS n_leaves, b.saved_tokens::BIGINT AS saved_tokens,
       f.ends_sha256
FROM family f JOIN below b USING (path)
"""

_AZ = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_TERMS = (
    f"regexp_extract_all(translate(coalesce(text, ''), '{_AZ}', '{_AZ.lower()}'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)

OP11_RANKED = f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, {_TERMS} AS terms FROM documents),
wanted AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
totals AS (SELECT count(*) FILTER (len(terms) > 0) AS documents, sum(len(terms))::BIGINT AS total FROM docs),
counts AS (
  SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(terms) AS term FROM docs)
  WHERE term IN (SELECT term FROM wanted) GROUP BY rid, term),
weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(documents) + 2) / (2 * count(*) + 1)))::BIGINT AS w
  FROM counts, totals GROUP BY term),
scores AS (
  SELECT q.item_id, d.doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * len(d.terms) * documents) // total))))::BIGINT AS score
  FROM wanted q JOIN counts c USING (term) JOIN weights USING (term) JOIN docs d USING (rid), totals
  GROUP BY q.item_id, d.rid, d.doc_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank
  FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""

OP12_WARC = """
WITH digests AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
firsts AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first
  FROM digests),
named AS (SELECT *, CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to FROM firsts)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to
FROM named
"""


def _either(name: str) -> str:
    """A pattern for ASCII letters in either case."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in name)


def _placed(kind: str, number: int, pattern: str, valid: str) -> str:
    """Matches of a pattern with their spans in characters: gaps and matches before them add up."""
    quoted = pattern.replace("'", "''")
    return f"""
      SELECT doc_id, '{kind}' AS kind, {number} AS k, start, start + length(hit) AS stop
      FROM (
        SELECT doc_id, hits[i] AS hit,
               list_sum(list_transform(gaps[1:i], lambda x: length(x)))
                 + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS start
        FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS i
              FROM (SELECT doc_id, regexp_extract_all(t, '{quoted}') AS hits, regexp_split_to_array(t, '{quoted}') AS gaps
                    FROM texts)))
      WHERE {valid}"""


def _base_spans(matches: list[str], kinds: list[str], order: str) -> str:
    counts = ", ".join(f"count(*) FILTER (kind = '{x}') AS n_{x}" for x in kinds)
    return f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
found AS ({" UNION ALL ".join(matches)}),
joined AS (
  SELECT doc_id, {counts},
         string_agg(kind || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT), ',' ORDER BY {order}) AS spans
  FROM found GROUP BY doc_id)
SELECT doc_id, {", ".join(f"coalesce(n_{x}, 0) AS n_{x}" for x in kinds)}, sha256(coalesce(spans, '')) AS base_sha256
FROM texts LEFT JOIN joined USING (doc_id)
"""


_NAMES = "|".join(_either(x) for x in ("password", "passwd", "secret", "token", "api_?key"))
_ASSIGN = rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""

BASE_SECRETS = _base_spans(
    [
        _placed("assign", 0, _ASSIGN, "length(regexp_extract(hit, '" + _ASSIGN.replace("'", "''") + "', 2)) >= 12"),
        _placed("access", 1, "AKIA[A-Z0-9]+", "length(hit) >= 18"),
        _placed("hex", 2, "[0-9a-f]+", "length(hit) >= 16"),
    ],
    ["assign", "access", "hex"],
    "start, k",
)

_DIGITS = "regexp_replace(hit, '[^0-9]', '', 'g')"
_LUHN = f"""(SELECT sum(CASE WHEN j % 2 = 1 THEN d ELSE 2 * d - CASE WHEN d > 4 THEN 9 ELSE 0 END END) % 10 = 0
             FROM (SELECT j, CAST(substr(reverse({_DIGITS}), CAST(j AS INTEGER), 1) AS INTEGER) AS d
                   FROM (SELECT unnest(range(1, length({_DIGITS}) + 1)) AS j)))"""
BASE_PII = _base_spans(
    [
        _placed("email", 0, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "true"),
        _placed(
            "ip", 1, r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "list_bool_and(list_transform(string_split(hit, '.'), lambda x: CAST(x AS HUGEINT) <= 255))",
        ),
        _placed("card", 2, r"[0-9]([\x20-]?[0-9])+", f"length({_DIGITS}) BETWEEN 13 AND 19 AND {_LUHN}"),
        _placed("phone", 3, r"\+[0-9][\x20().0-9-]+[0-9]", f"length({_DIGITS}) BETWEEN 9 AND 15"),
    ],
    ["email", "ip", "card", "phone"],
    "k, start",
)

BASE_MODEL = f"""
WITH texts AS (
  SELECT doc_id, {crc32("doc_id::VARCHAR")} % 5 = 1 AS held_out,
         regexp_extract_all(translate(coalesce(text, ''), '{_AZ}', '{_AZ.lower()}'), '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents),
tokens AS (
  SELECT doc_id, held_out, unnest(list_append(list_transform(words, lambda w: 'w' || w), 'end')) AS token FROM texts),
counts AS (SELECT token, count(*) AS c FROM tokens WHERE NOT held_out GROUP BY token),
totals AS (SELECT sum(c) AS n, count(*) AS v FROM counts)
SELECT doc_id, any_value(held_out) AS held_out, count(*) AS n_tokens, count(c) AS n_known,
       CAST(any_value(n) AS BIGINT) AS train_tokens,
       round(sum(log10((coalesce(c, 0) + 0.5) / (n + 0.5 * (v + 1)))), 6) AS base_score
FROM tokens LEFT JOIN counts USING (token), totals
GROUP BY doc_id
"""

ORACLES: dict[str, str] = {
    "base_secrets": BASE_SECRETS,
    "base_personal_data": BASE_PII,
    "base_model": BASE_MODEL,
    "op11_ranked_search": OP11_RANKED,
    "op12_warc": OP12_WARC,
    "op13_prefix_trie": OP13_TRIE,
}
