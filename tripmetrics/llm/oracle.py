"""DuckDB SQL for the queries of this package that SQL can express."""

_URL = """
WITH split AS (
    SELECT page_id,
        CASE WHEN url LIKE '%://%' THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
    FROM pages
), parts AS (
    SELECT page_id,
        translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM split
), rules(rule, verdict, rule_host, rule_path) AS (
    VALUES ('org/', 'allow', 'org', '/'), ('example.org/es/', 'block', 'example.org', '/es/'),
        ('example.org/en/1', 'block', 'example.org', '/en/1'), ('com/fr/', 'allow', 'com', '/fr/'),
        ('com/de/', 'block', 'com', '/de/')
), fitting AS (
    SELECT p.page_id, p.host, p.path, r.rule, r.verdict,
        row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.rule) DESC NULLS LAST) AS place
    FROM parts p LEFT JOIN rules r
        ON (p.host = r.rule_host OR p.host LIKE '%.' || r.rule_host) AND starts_with(p.path, r.rule_path)
)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule, coalesce(verdict, 'allow') AS verdict
FROM fitting WHERE place = 1
"""

_DECONTAMINATION = r"""
WITH item_words AS (
    SELECT CAST(item_id AS VARCHAR) AS item_id,
        regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), windows AS (
    SELECT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS window_text
    FROM item_words, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS t(i)
    WHERE len(w) > 0
), doc_words AS (
    SELECT doc_id,
        regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), spots AS (
    SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS window_text
    FROM doc_words, (SELECT DISTINCT n FROM windows), unnest(range(1, len(w) - n + 2)) AS t(i)
), found AS (
    SELECT s.doc_id, s.i, s.n, x.item_id FROM spots s JOIN windows x USING (n, window_text)
), hits AS (
    SELECT doc_id, count(DISTINCT word) AS n_hit
    FROM (SELECT DISTINCT doc_id, i, n FROM found), unnest(range(i, i + n)) AS t(word) GROUP BY doc_id
), items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
    FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_WARC = """
WITH sized AS (
    SELECT page_id, sha1(coalesce(html, '')) AS payload_digest,
        CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes
    FROM pages
), firsts AS (
    SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS response
    FROM sized
)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> response THEN response END AS refers_to
FROM firsts
"""

_CHAT = """
WITH said AS (
    SELECT DISTINCT conv_id, turn, role, text FROM conversations
), turns AS (
    SELECT conv_id, turn, count(*) AS n,
        string_agg(concat(turn, ':', coalesce(length(role), -1), ':', role, coalesce(length(text), -1), ':', text), ''
            ORDER BY role, text) AS packed
    FROM said GROUP BY conv_id, turn
), prefixes AS (
    SELECT conv_id, turn, max(turn) OVER (PARTITION BY conv_id) AS last,
        string_agg(packed, '') OVER (PARTITION BY conv_id ORDER BY turn) AS prefix
    FROM turns
), wholes AS (
    SELECT min(conv_id) AS conv_id, prefix FROM prefixes WHERE turn = last GROUP BY prefix
), kept AS (
    SELECT conv_id FROM wholes WHERE prefix NOT IN (SELECT prefix FROM prefixes WHERE turn < last)
)
SELECT conv_id, CAST(dense_rank() OVER (PARTITION BY conv_id ORDER BY block) - 1 AS INTEGER) AS part, n_rows, rendered
FROM (
    SELECT conv_id, turn // 1024 AS block, count(*) AS n_rows,
        string_agg(concat('<|', replace(role, '<|', '<\\|'), '|>', chr(10), replace(text, '<|', '<\\|'), chr(10), '<|end|>', chr(10)),
            '' ORDER BY turn, role, text) AS rendered
    FROM said SEMI JOIN kept USING (conv_id) GROUP BY conv_id, block
)
"""

_HARD_NEGATIVES = """
WITH vectors AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
    SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS other_id,
        CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
    FROM vectors a JOIN vectors b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positives AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scores WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER best AS INTEGER) AS rank, other_id AS negative_id,
    positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
WINDOW best AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)
QUALIFY rank <= 5
"""

_MIXING = r"""
WITH sized AS (
    SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents
), sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY encode(source) NULLS LAST) AS place
    FROM sized GROUP BY source
), weighed AS (
    SELECT *, 3 * source_size AS cap, ([5, 2, 1])[(place - 1) % 3 + 1] AS weight FROM sources
), filled AS (
    SELECT *, cap <= CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0) AS DOUBLE) * weight
            / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS is_full
    FROM weighed
    WINDOW before AS (ORDER BY CAST(cap AS DOUBLE) / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), leveled AS (
    SELECT *, CASE WHEN is_full THEN CAST(cap AS DOUBLE) ELSE
        CAST(sum(source_size) OVER () - coalesce(sum(cap) FILTER (is_full) OVER (), 0) AS DOUBLE) * weight
            / nullif(sum(weight) OVER () - coalesce(sum(weight) FILTER (is_full) OVER (), 0), 0) END AS target
    FROM filled
), expected AS (
    SELECT source, source_size, target,
        CASE WHEN source_size > 0 THEN least(CAST(floor(target / source_size * 4294967296.0 + 0.5) AS HUGEINT), 12884901888) ELSE 0 END AS copies,
        CAST('0x' || substr(md5('mix:' || coalesce('=' || source, '')), 1, 8) AS HUGEINT) AS shift
    FROM leveled
), ranges AS (
    SELECT doc_id, size, source_size, target, copies, shift + copies * (row_number() OVER (
        PARTITION BY s.source ORDER BY size DESC, doc_id NULLS FIRST) - 1) AS begins
    FROM sized s JOIN expected e ON s.source IS NOT DISTINCT FROM e.source
)
SELECT doc_id, size, source_size, target,
    CAST(size * ((begins + copies) // 4294967296 - begins // 4294967296) AS BIGINT) AS taken,
    CAST((begins + copies) // 4294967296 - begins // 4294967296 AS BIGINT) AS copies
FROM ranges
"""

# Bytes of a number's digits run through CRC-32, bit by bit.
_CRC = """xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(
    string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [CAST(ord(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END))"""


def _field(value: str) -> str:
    return f"coalesce(CAST(strlen(CAST({value} AS VARCHAR)) AS VARCHAR) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(map(_field, ("doc_id", "source", "lang", "n_chars", text))) + ")"


def _merkle(levels: int) -> str:
    """SQL of trees with at most ``levels`` levels, those over groups included. A finished tree stays as it is."""
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    parts = [
        f"""
    rows AS (
        SELECT row_number() OVER () AS id, doc_id, coalesce('v' || lang, '-') AS k, {_leaf('text')} AS leaf,
            CASE WHEN doc_id IS NOT NULL AND {_CRC} % 3 = 0 THEN {_leaf(lower)} ELSE {_leaf('text')} END AS own
        FROM documents
    ), a0 AS (
        SELECT k, leaf AS h, id, row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
            count(*) OVER (PARTITION BY k) AS n FROM rows
    ), f0 AS (SELECT id, k, place, own, '' AS proof FROM rows JOIN a0 USING (id, k))"""
    ]

    def climb(t: str, f: str, level: int) -> None:
        below, above = f"{t}{level}", f"{t}{level + 1}"
        parts.append(f"""{above}p AS (
        SELECT k, place // 8 AS place, any_value(n) AS n, list(h ORDER BY place) AS hs FROM {below} GROUP BY k, place // 8
    ), {above} AS (
        SELECT k, place, (n + 7) // 8 AS n, CASE WHEN n = 1 THEN hs[1] ELSE sha256(array_to_string(hs, '')) END AS h FROM {above}p
    ), {f}{level + 1} AS (
        SELECT id, k, f.place // 8 AS place,
            CASE WHEN n = 1 THEN own ELSE sha256(array_to_string(hs[:f.place % 8] || [own] || hs[f.place % 8 + 2:], '')) END AS own,
            CASE WHEN n = 1 THEN proof ELSE proof || array_to_string(hs[:f.place % 8] || hs[f.place % 8 + 2:], '') END AS proof
        FROM {f}{level} f JOIN {above}p p USING (k) WHERE p.place = f.place // 8
    )""")

    for level in range(levels):
        climb("a", "f", level)
    parts.append(f"""t0 AS (
        SELECT '' AS k, k AS of, h, row_number() OVER (ORDER BY encode(k)) - 1 AS place, count(*) OVER () AS n FROM a{levels}
    ), g0 AS (
        SELECT id, '' AS k, t0.place, own, proof FROM f{levels} f JOIN t0 ON f.k = t0.of
    )""")
    for level in range(levels):
        climb("t", "g", level)
    return "WITH " + ", ".join(parts) + f"""
SELECT doc_id, leaf, s.h AS subroot, t.h AS root, sha256(proof) AS proof_sha256, g.own AS folded_root, g.own = t.h AS verified
FROM rows JOIN g{levels} g USING (id) JOIN a{levels} s ON rows.k = s.k CROSS JOIN t{levels} t
"""


SQL = {
    "op3_url_filter": _URL,
    "op4_decontamination": _DECONTAMINATION,
    "op5_warc": _WARC,
    "op10_chat": _CHAT.replace("\\\\", "\\"),
    "op11_hard_negatives": _HARD_NEGATIVES,
    "op12_mixing": _MIXING,
    "op13_merkle": _merkle(7),
}
