"""DuckDB SQL that gives the rows of the registered queries, where SQL can."""

from __future__ import annotations

from vertexloom.llm.secrets import BASE_RULES, MORE_RULES

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: str) -> str:
    return f"translate({text}, '{UPPER}', '{LOWER}')"


SPACES = r"concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))"

LINE_DEDUP = f"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
    FROM documents
), keyed AS (
    SELECT doc_id, pos, line, {ascii_lower(f"trim(line, {SPACES})")} AS key FROM lines
), shared AS (
    SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10
)
SELECT doc_id, count(*) AS n_lines, count(shared.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (shared.key IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN shared USING (key)
GROUP BY doc_id
"""

WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

DECONTAMINATE = f"""
WITH d AS (
    SELECT doc_id, regexp_extract_all({ascii_lower("coalesce(text, '')")}, '{WORDS}') AS w FROM documents
), b AS (
    SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all({ascii_lower("coalesce(text, '')")}, '{WORDS}') AS w
    FROM benchmark
), starts AS (
    SELECT item, w, least(len(w), 10) AS size, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0
), windows AS (
    SELECT DISTINCT item, size, w[i:i + size - 1] AS piece FROM starts
), sizes AS (
    SELECT DISTINCT size FROM windows
), places AS (
    SELECT doc_id, w, size, unnest(range(1, greatest(len(w) - size + 2, 1))) AS i FROM d, sizes
), hits AS (
    SELECT doc_id, i, p.size, item FROM places p JOIN windows v ON p.size = v.size AND p.w[p.i:p.i + p.size - 1] = v.piece
), words AS (
    SELECT doc_id, count(DISTINCT place) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + size)) AS place FROM hits) GROUP BY doc_id
), items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""



def spans(kind: str, rank: int, pattern: str, group: int, test: str) -> str:
    """Rows of the matches of a pattern in ``documents`` that pass a test of their group."""
    literal = pattern.replace("'", "''")
    return f"""
    SELECT doc_id, '{kind}' AS kind, {rank} AS rank, start, start + length(whole[i]) AS stop
    FROM (
        SELECT doc_id, whole, value, i,
               list_sum(list_transform(between[1:i], lambda x: length(x)))
                   + coalesce(list_sum(list_transform(whole[1:i - 1], lambda x: length(x))), 0) AS start
        FROM (
            SELECT doc_id, regexp_extract_all(text, '{literal}') AS whole,
                   regexp_extract_all(text, '{literal}', {group}) AS value,
                   regexp_split_to_array(text, '{literal}') AS between
            FROM documents WHERE regexp_matches(text, '{literal}')
        ), unnest(range(1, len(whole) + 1)) AS t(i)
    ) WHERE {test}"""


def secret_scan() -> str:
    every = (*BASE_RULES, *MORE_RULES)
    parts = [spans(r.kind, i, r.pattern, r.group, f"length(value[i]) >= {r.least}") for i, r in enumerate(every)]
    counts = [f"count(s.kind) FILTER (s.kind = '{r.kind}') AS n_{r.kind}" for r in BASE_RULES]
    listed = "string_agg(concat(s.kind, ':', s.start, ':', s.stop), ',' ORDER BY s.start, s.rank)"
    base = ", ".join(f"'{r.kind}'" for r in BASE_RULES)
    return f"""
WITH s AS ({" UNION ALL ".join(parts)})
SELECT d.doc_id, {", ".join(counts)},
       sha256(coalesce({listed} FILTER (s.kind IN ({base})), '')) AS base_sha256,
       coalesce({listed} FILTER (s.kind IS NOT NULL), '') AS spans
FROM documents d LEFT JOIN s ON s.doc_id = d.doc_id
GROUP BY d.doc_id
"""


TOP_K = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024.0::DOUBLE * x::DOUBLE)::BIGINT) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
           list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
    WHERE q.vec_id % 100 = 0
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM scored
QUALIFY rank <= 10
"""


# crc32 of the decimal number, bit by bit
CRC = """xor(list_reduce(
    list_prepend(4294967295::UBIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::UBIGINT)),
    lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda s, z: xor(s >> 1, 3988292384::UBIGINT * (s & 1)))
), 4294967295::UBIGINT)"""

PREFIX_TRIE = f"""
WITH c AS (
    SELECT conv_id, list(struct_pack(role := coalesce(role, ''), text := coalesce(text, '')) ORDER BY turn NULLS FIRST) AS turns,
           conv_id - conv_id % 5 AS base, ({CRC} % 9)::BIGINT AS h
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), rebuilt AS (
    SELECT c.conv_id, list_concat(coalesce(b.turns, [])[1:c.h], c.turns[c.h + 1:]) AS seq
    FROM c LEFT JOIN c b ON b.conv_id = c.base
), prefixes AS (
    SELECT conv_id, d, seq[1:d] AS path, len(seq) = d AS ends FROM rebuilt, unnest(range(0, len(seq) + 1)) AS t(d)
), nodes AS MATERIALIZED (
    SELECT path, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
           sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
    FROM prefixes GROUP BY path
), children AS (
    SELECT path[1:depth - 1] AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1
), figures AS (
    SELECT nodes.*, coalesce(children.n, 0) AS n_children,
           (n_convs - 1) * coalesce(strlen(path[-1].text), 0) AS saved
    FROM nodes LEFT JOIN children USING (path)
), below AS (
    SELECT path[1:d] AS path, sum(saved)::BIGINT AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
    FROM figures, unnest(range(0, depth + 1)) AS t(d) GROUP BY 1
)
SELECT f.conv_id, f.depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children, n_leaves, saved_tokens, f.ends_sha256
FROM figures f JOIN below USING (path) LEFT JOIN nodes p ON f.depth > 0 AND p.path = f.path[1:f.depth - 1]
"""


def centroids(clusters: int = 40, rounds: int = 5) -> str:
    """The rounds one after the other; every vector meets every centroid."""
    parts = [f"""
WITH v AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id,
           list_transform(embedding, lambda x: floor(256.0::DOUBLE * x::DOUBLE)::BIGINT) AS v
    FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS MATERIALIZED (
    SELECT (row_number() OVER (ORDER BY sha256(concat('2:', vec_id::VARCHAR))))::INTEGER - 1 AS cluster, v AS c
    FROM v QUALIFY cluster < {clusters}
)"""]
    for i in range(rounds + 1):
        parts.append(f""", a{i} AS MATERIALIZED (
    SELECT r, any_value(vec_id) AS vec_id, any_value(v) AS v, min(struct_pack(d := d, cluster := cluster)) AS best
    FROM (SELECT r, vec_id, v, cluster, list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
          FROM v CROSS JOIN c{i})
    GROUP BY r
)""")
        if i < rounds:
            parts.append(f""", c{i + 1} AS MATERIALIZED (
    SELECT c{i}.cluster, coalesce(m.c, c{i}.c) AS c FROM c{i} LEFT JOIN (
        SELECT cluster, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY place) AS c
        FROM (SELECT best.cluster AS cluster, place, sum(x) AS s, count(*) AS n
              FROM (SELECT best, unnest(v) AS x, unnest(range(64)) AS place FROM a{i}) GROUP BY best.cluster, place)
        GROUP BY cluster
    ) m USING (cluster)
)""")
    return "".join(parts) + f"""
SELECT vec_id, best.cluster AS cluster, best.d AS distance, (sum(best.d) OVER (PARTITION BY best.cluster))::BIGINT AS cluster_inertia,
       (sum(best.d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} ON c{rounds}.cluster = best.cluster
"""


ORACLES = {
    "op3_secret_scan": secret_scan(),
    "op5_line_dedup": LINE_DEDUP,
    "op7_decontaminate": DECONTAMINATE,
    "op8_top_k": TOP_K,
    "op11_prefix_trie": PREFIX_TRIE,
    "op13_centroids": centroids(),
}
