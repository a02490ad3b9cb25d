"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

EXACT_DEDUP = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

_NAMED = (
    "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
    "|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    "[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)"
)
_KINDS = [
    ("assign", _NAMED, "secret", "true", "v BETWEEN 6 AND 1000000000"),
    ("access", "AKIA[A-Z0-9]+", "identifier", "true", "v >= 20"),
    ("hex", "[0-9a-f]{24,}", "secret", "true", "true"),
    ("ident", "AKIA[A-Z0-9]+", "identifier", "false", "v BETWEEN 12 AND 19"),
    (
        "opaque",
        "[A-Za-z0-9+/]{32,}",
        "secret",
        "false",
        "regexp_matches(m, '[0-9]') AND regexp_matches(m, '[a-z]') AND regexp_matches(m, '[A-Z]')",
    ),
    ("shorthex", "[0-9a-f]{12,}", "secret", "false", "v BETWEEN 16 AND 23"),
    ("endpoint", "https?://[A-Za-z0-9.-]+[^\\x00-\\x20\"''<>]*", "endpoint", "false", "v >= 12"),
    ("scope", "\\n[\\x20\\t\\r]*\\n", "scope", "false", "true"),
]


def _secret_scan(reach: int) -> str:
    found = "\nUNION ALL\n".join(
        f"""SELECT doc_id, {place} AS kind, '{name}' AS name, '{role}' AS role, {strong} AS strong,
       e - length(m) AS s, e
FROM (SELECT *, length({"regexp_extract(m, '" + pattern + "', 2)" if name == "assign" else "m"}) AS v,
             sum(length(g) + length(m)) OVER (PARTITION BY doc_id ORDER BY i)::BIGINT AS e
      FROM (SELECT doc_id, unnest(ms) AS m, unnest(gs[:len(ms)]) AS g,
                   generate_subscripts(ms, 1) AS i
            FROM (SELECT doc_id, regexp_extract_all(t, '{pattern}', 0) AS ms,
                         string_split_regex(t, '{pattern}') AS gs
                  FROM docs)))
WHERE {counts}"""
        for place, (name, pattern, role, strong, counts) in enumerate(_KINDS)
    )

    def near(condition: str) -> str:
        """Such a part overlaps this one or stands within reach, by the gap between them."""
        return (
            f"(coalesce(max(CASE WHEN {condition} THEN e END) OVER before >= s - {reach}, false)"
            f" OR coalesce(min(CASE WHEN {condition} THEN s END) OVER behind <= e + {reach}, false))"
        )

    roles = ("identifier", "secret", "endpoint")
    complements = []
    for role in roles:
        one, two = [r for r in roles if r != role]
        firm = near(f"strong AND role IN ('{one}', '{two}')")
        weak = f"{near(f"role = '{one}'")} AND {near(f"role = '{two}'")}"
        complements.append(f"role = '{role}' AND ({firm} OR {weak})")
    linked = " OR ".join(f"({c})" for c in complements)
    return f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
found AS ({found}),
scoped AS (
  SELECT *, sum((role = 'scope')::INT) OVER (PARTITION BY doc_id ORDER BY s) AS scope FROM found),
judged AS (
  SELECT *, {linked} AS linked,
         coalesce(max(e) FILTER (WHERE strong) OVER upto > s, false)
         OR coalesce(min(s) FILTER (WHERE strong) OVER after < e, false) AS covered
  FROM scoped
  WINDOW before AS (PARTITION BY doc_id, scope ORDER BY s
                    RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         behind AS (PARTITION BY doc_id, scope ORDER BY s
                    RANGE BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING),
         upto AS (PARTITION BY doc_id ORDER BY s
                  RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         after AS (PARTITION BY doc_id ORDER BY s
                   RANGE BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
spans AS (SELECT doc_id, strong, s, kind, name, name || ':' || s || ':' || e AS label
          FROM judged WHERE strong OR (linked AND NOT covered))
SELECT d.doc_id,
       count(*) FILTER (WHERE name = 'assign') AS n_assign,
       count(*) FILTER (WHERE name = 'access') AS n_access,
       count(*) FILTER (WHERE name = 'hex') AS n_hex,
       sha256(coalesce(string_agg(label, ',' ORDER BY s, kind) FILTER (WHERE strong), ''))
         AS base_sha256,
       coalesce(string_agg(label, ',' ORDER BY s, kind), '') AS spans
FROM docs d LEFT JOIN spans USING (doc_id)
GROUP BY d.doc_id
"""


SECRET_SCAN = _secret_scan(240)


NEAR_DEDUP = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\\x20\\x09-\\x0D]+') AS ws
  FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN []
           WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
           ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' '))
         END) AS shingles
  FROM words),
sizes AS (SELECT doc_id, len(shingles) AS n FROM sets),
flat AS (SELECT doc_id, unnest(shingles) AS g FROM sets),
shared AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c
  FROM flat a JOIN flat b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT u, v FROM shared JOIN sizes a ON a.doc_id = u JOIN sizes b ON b.doc_id = v
  WHERE 100 * c >= 80 * (a.n + b.n - c)),
reach(u, v) AS (
  SELECT doc_id, doc_id FROM sizes
  UNION SELECT reach.u, links.v FROM reach JOIN links ON links.u = reach.v)
SELECT doc_id, any_value(n)::BIGINT AS n_shingles, min(v) AS component_id, doc_id = min(v) AS kept
FROM sizes JOIN reach ON u = doc_id
GROUP BY doc_id
"""


SUFFIX_DEDUP = """
WITH docs AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n
  FROM documents),
strings AS (
  SELECT doc_id, p, substr(h, (2 * p + 1)::BIGINT, 200) AS g
  FROM (SELECT doc_id, h, unnest(range(0, greatest(n - 99, 0))) AS p FROM docs)),
later AS (
  SELECT doc_id, p FROM strings
  QUALIFY row_number() OVER (PARTITION BY g ORDER BY doc_id, p) > 1),
marked AS (
  SELECT doc_id, p,
         (p > lag(p, 1, -1000000) OVER (PARTITION BY doc_id ORDER BY p) + 100)::INT AS new
  FROM later),
numbered AS (SELECT doc_id, p, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS span FROM marked),
spans AS (SELECT doc_id, min(p) AS a, max(p) + 100 AS b FROM numbered GROUP BY doc_id, span),
gaps AS (
  SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS since FROM spans),
cut AS (
  SELECT doc_id, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans, max(b) AS last,
         string_agg(substr(h, (2 * since + 1)::BIGINT, (2 * (a - since))::BIGINT), '' ORDER BY a) AS kept
  FROM gaps JOIN docs USING (doc_id) GROUP BY doc_id)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed,
       coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept, '') || substr(h, (2 * coalesce(last, 0) + 1)::BIGINT))) AS kept_sha256
FROM docs LEFT JOIN cut USING (doc_id)
"""


def _source_mixing(rounds: int, temper: float, fraction: float) -> str:
    rounds_sql, last = "", "start"
    for number in range(rounds):
        for dimension in ("source", "lang", "topic"):
            now = f"r{number}_{dimension}"
            rounds_sql += f"""
{now} AS (
  SELECT * EXCLUDE (w, total_w), CASE WHEN total_w > 0
         THEN least(w * {dimension}_target / total_w, most) ELSE 0 END AS w
  FROM (SELECT *, sum(w) OVER (PARTITION BY {dimension}) AS total_w FROM {last})),"""
            last = now
    targets = ", ".join(
        f"{d}_x / sum({d}_x / {d}_n) OVER () AS {d}_target" for d in ("source", "lang", "topic")
    )
    powers = ", ".join(
        f"pow(sum(tokens) OVER (PARTITION BY {d}), {temper}) AS {d}_x,"
        f" count(*) OVER (PARTITION BY {d}) AS {d}_n"
        for d in ("source", "lang", "topic")
    )
    return f"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS t, coalesce(source, '') AS source, coalesce(lang, '') AS lang
  FROM documents),
counted AS (
  SELECT *, len(regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+')) AS n_tokens,
         greatest(length(t), 1) AS size,
         length(t) - length(translate(t, '0123456789', '')) AS digits,
         length(t) - length(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '')) AS capitals
  FROM texts),
docs AS (
  SELECT doc_id, source, lang, n_tokens,
         CASE WHEN digits / size > 0.05 THEN 'figures' WHEN capitals / size > 0.3 THEN 'capitals'
              WHEN n_tokens < 100 THEN 'note' WHEN n_tokens < 1000 THEN 'article' ELSE 'long'
         END AS topic,
         ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, t)), 1, 13))::BIGINT / 16.0::DOUBLE ** 13
           AS draw
  FROM counted),
cells AS (SELECT source, lang, topic, sum(n_tokens)::DOUBLE AS tokens FROM docs GROUP BY ALL),
lifted AS (SELECT *, {powers} FROM cells),
start AS (
  SELECT source, lang, topic, tokens, {targets},
         tokens / greatest(sum(tokens) OVER (), 1) AS w,
         tokens / greatest(sum(tokens) OVER (), 1) / {fraction} AS most
  FROM lifted),{rounds_sql}
final AS (
  SELECT source, lang, topic, w, CASE WHEN most > 0 THEN w / most ELSE 0 END AS chance FROM {last})
SELECT doc_id, source, lang, topic, n_tokens, round(w, 6) AS cell_weight,
       round(chance, 6) AS probability, draw < chance AS kept
FROM docs JOIN final USING (source, lang, topic)
"""


SOURCE_MIXING = _source_mixing(10, 0.7, 0.6)


def _field(column: str) -> str:
    text = f"CAST({column} AS VARCHAR)"
    return f"coalesce(strlen({text}) || ':' || {text}, '-')"


def _leaf(text: str) -> str:
    fields = [_field(c) for c in ("doc_id", "source", "lang", "n_chars")]
    return f"sha256({' || '.join([*fields, _field(text)])})"


#: CRC-32 of a number's decimal form, bit by bit.
_CRC = """xor(list_reduce([4294967295::BIGINT] || list_transform(
    string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT),
    lambda crc, c: list_reduce([xor(crc, c)] || [0::BIGINT, 0, 0, 0, 0, 0, 0, 0],
      lambda x, z: xor(x >> 1, 3988292384::BIGINT * (x & 1)))), 4294967295::BIGINT)"""


def _climbed(name: str, start: str) -> str:
    """All levels of the trees in ``start(tree, place, node, size)``."""
    return f"""{name}(level, tree, place, node, size) AS (
  SELECT 0, tree, place, node, size FROM {start}
  UNION ALL
  SELECT any_value(level) + 1, tree, place // 8, sha256(string_agg(node, '' ORDER BY place)),
         any_value((size + 7) // 8)
  FROM {name} WHERE size > 1 GROUP BY tree, place // 8)"""


#: The siblings on each level of a leaf's path, to the left and right, folded into it.
MERKLE_MANIFEST = f"""
WITH RECURSIVE base AS (
  SELECT doc_id, coalesce('=' || lang, '') AS tree, {_leaf("text")} AS node,
         CASE WHEN coalesce({_CRC} % 3 = 0, false)
           THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}
           ELSE {_leaf("text")} END AS again
  FROM documents),
leaves AS (
  SELECT *, row_number() OVER (ORDER BY tree, doc_id NULLS FIRST, node) AS row,
         row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, node) - 1 AS place,
         count(*) OVER (PARTITION BY tree) AS size FROM base),
{_climbed("trees", "leaves")},
tops AS (
  SELECT '' AS tree, tree AS lang, row_number() OVER (ORDER BY tree) - 1 AS place, node,
         count(*) OVER () AS size
  FROM trees WHERE size = 1),
{_climbed("upper", "tops")},
nodes AS (
  SELECT level, 'lang' || tree AS tree, place, node, size FROM trees
  UNION ALL SELECT 1000 + level, 'top', place, node, size FROM upper),
beside AS (
  SELECT a.level, a.tree, a.place,
         coalesce(string_agg(b.node, '' ORDER BY b.place) FILTER (WHERE b.place < a.place), '') AS lhs,
         coalesce(string_agg(b.node, '' ORDER BY b.place) FILTER (WHERE b.place > a.place), '') AS rhs
  FROM nodes a JOIN nodes b
    ON a.level = b.level AND a.tree = b.tree AND a.place // 8 = b.place // 8
  WHERE a.size > 1 GROUP BY ALL),
levels AS (SELECT DISTINCT level, tree FROM nodes WHERE size > 1),
path AS (
  SELECT row, level, levels.tree, place >> (3 * level) AS place
  FROM leaves JOIN levels ON levels.tree = 'lang' || leaves.tree
  UNION ALL
  SELECT row, level, 'top', tops.place >> (3 * (level - 1000))
  FROM leaves JOIN tops ON tops.lang = leaves.tree JOIN levels ON levels.tree = 'top'),
proofs AS (
  SELECT row, string_agg(lhs || rhs, '' ORDER BY level) AS proof,
         list(lhs || '|' || rhs ORDER BY level) AS pairs
  FROM path JOIN beside USING (level, tree, place) GROUP BY row),
proved AS (
  SELECT l.doc_id, l.node AS leaf, tops.node AS subroot,
         (SELECT node FROM upper WHERE size = 1) AS root,
         sha256(coalesce(proof, '')) AS proof_sha256,
         list_reduce([again] || coalesce(pairs, []),
           lambda h, s: sha256(split_part(s, '|', 1) || h || split_part(s, '|', 2))) AS folded_root
  FROM leaves l LEFT JOIN proofs USING (row) JOIN tops ON tops.lang = l.tree)
SELECT *, folded_root = root AS verified FROM proved
"""
