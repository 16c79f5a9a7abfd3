"""DuckDB SQL that answers the queries of ``__spark_entry__`` from the same tables.

Iterations are chained CTEs, one per round, because a round reads the one before twice.
"""

from __future__ import annotations

ITERATIONS = 20
ROUNDS = 5

TRADE = """SELECT 'c' || o_custkey AS src, 's' || l_suppkey AS dst, l_extendedprice AS weight
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
NATION_FLOW = """SELECT sn.n_name AS src, cn.n_name AS dst, l_extendedprice AS weight
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN supplier ON l_suppkey = s_suppkey JOIN nation sn ON s_nationkey = sn.n_nationkey
    JOIN customer ON o_custkey = c_custkey JOIN nation cn ON c_nationkey = cn.n_nationkey"""
PAGE_LINKS = """SELECT url AS src, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS dst,
    CAST(1 AS DOUBLE) AS weight FROM pages"""
USER_ACTIONS = "SELECT 'u' || user_id AS src, event_type AS dst, value AS weight FROM events"

GRAPHS = {"trade": TRADE, "nation_flow": NATION_FLOW, "page_links": PAGE_LINKS, "user_actions": USER_ACTIONS}

BUILDING = """SELECT 'c' || o_custkey AS src, 's' || l_suppkey AS dst, l_extendedprice AS weight
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    WHERE c_mktsegment = 'BUILDING'"""


def undirected(edges: str) -> str:
    return f"""SELECT src, dst, weight FROM ({edges}) UNION ALL SELECT dst, src, weight FROM ({edges})"""


def vertices(edges: str) -> str:
    return f"SELECT src AS id FROM ({edges}) UNION SELECT dst FROM ({edges})"


def _graph_ctes(edges: str) -> str:
    return f"""e AS MATERIALIZED ({edges}),
v AS MATERIALIZED (SELECT src AS id FROM e UNION SELECT dst FROM e),
deg AS MATERIALIZED (SELECT src, count(*) AS d FROM e GROUP BY src)"""


def pagerank_ctes(edges: str, iterations: int = ITERATIONS) -> str:
    """CTEs ending in ``ranked(id, pagerank)``, rounded to 8 digits."""
    steps = [
        _graph_ctes(edges),
        "n AS MATERIALIZED (SELECT CAST(count(*) AS DOUBLE) AS c FROM v)",
        "r0 AS MATERIALIZED (SELECT id, 1 / c AS r FROM v, n)",
    ]
    for k in range(1, iterations + 1):
        p = f"r{k - 1}"
        steps.append(
            f"""r{k} AS MATERIALIZED (
  SELECT v.id, CAST(0.15 AS DOUBLE) / n.c + CAST(0.85 AS DOUBLE) * sinks.m / n.c
         + CAST(0.85 AS DOUBLE) * coalesce(inflow.s, 0) AS r
  FROM v CROSS JOIN n
  CROSS JOIN (SELECT coalesce(sum(r), 0) AS m FROM {p} WHERE id NOT IN (SELECT src FROM deg)) sinks
  LEFT JOIN (SELECT e.dst, sum({p}.r / deg.d) AS s FROM e JOIN deg ON deg.src = e.src
             JOIN {p} ON {p}.id = e.src GROUP BY e.dst) inflow ON inflow.dst = v.id)"""
        )
    steps.append(f"ranked AS MATERIALIZED (SELECT id, round(r, 8) AS pagerank FROM r{iterations})")
    return ",\n".join(steps)


def peer_pressure_ctes(edges: str, vote: str, rounds: int = ROUNDS) -> str:
    """CTEs ending in ``clustered(id, cluster)``."""
    if vote == "unit":
        strength, self_strength, score = "CAST(1 AS HUGEINT)", "CAST(1 AS HUGEINT)", "sum(w)"
    else:
        strength = "CAST(round(1e12 / deg.d) AS HUGEINT)"
        self_strength = "CAST(coalesce(round(1e12 / deg.d), 0) AS HUGEINT)"
        score = "(sum(w) + 500) // 1000"
    steps = [
        _graph_ctes(edges),
        f"""sent AS MATERIALIZED (
  SELECT e.src, e.dst, {strength} AS w FROM e JOIN deg ON deg.src = e.src
  UNION ALL SELECT v.id, v.id, {self_strength} FROM v LEFT JOIN deg ON deg.src = v.id)""",
        "c0 AS MATERIALIZED (SELECT id, id AS cluster FROM v)",
    ]
    for k in range(1, rounds + 1):
        steps.append(
            f"""c{k} AS MATERIALIZED (
  SELECT id, cluster FROM (
    SELECT dst AS id, cluster, row_number() OVER (PARTITION BY dst ORDER BY s DESC, cluster) AS place
    FROM (SELECT sent.dst, p.cluster, {score} AS s FROM sent JOIN c{k - 1} p ON p.id = sent.src GROUP BY 1, 2))
  WHERE place = 1)"""
        )
    steps.append(f"clustered AS MATERIALIZED (SELECT id, cluster FROM c{rounds})")
    return ",\n".join(steps)


def pagerank(edges: str) -> str:
    return f"WITH {pagerank_ctes(edges)} SELECT id, pagerank FROM ranked"


def peer_pressure(edges: str, vote: str) -> str:
    return f"WITH {peer_pressure_ctes(edges, vote)} SELECT id, cluster FROM clustered"


# customer vertices carry segment and balance, supplier vertices only balance
VERTEX_TABLE = f"""SELECT v.id, c_mktsegment AS segment, coalesce(c_acctbal, s_acctbal) AS balance
    FROM ({vertices(TRADE)}) v
    LEFT JOIN customer ON v.id = 'c' || c_custkey
    LEFT JOIN supplier ON v.id = 's' || s_suppkey"""

NEIGHBOURS = f"""SELECT src AS id, 'out' AS direction, dst AS neighbour, count(*) AS edges
    FROM ({TRADE}) GROUP BY ALL
    UNION ALL
    SELECT dst, 'in', src, count(*) FROM ({TRADE}) GROUP BY ALL"""


def _whole_graph(edges: str) -> str:
    return f"""SELECT 'edge' AS kind, src AS a, dst AS b, weight FROM ({edges})
        UNION ALL SELECT 'vertex', id, NULL, NULL FROM ({vertices(edges)})"""


def oracle_sql() -> dict[str, str]:
    sql = {
        "edges_typed_projection": """SELECT CAST(o_custkey AS VARCHAR) AS src, CAST(l_suppkey AS VARCHAR) AS dst,
            CAST(o_custkey AS INTEGER) AS o_custkey, CAST(l_suppkey AS INTEGER) AS l_suppkey,
            l_extendedprice, l_returnflag, l_linenumber
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
        "edges_default_weight": """SELECT 'c' || o_custkey AS src, 's' || l_suppkey AS dst,
            coalesce(CASE WHEN l_returnflag <> 'R' THEN l_extendedprice END, 1) AS weight
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
        "edges_quoted_breaks": """SELECT c_name || chr(10) || '"' || c_mktsegment || '",' || chr(10) AS src, count(*) AS edges,
            count(DISTINCT l_suppkey) AS sellers, max(l_extendedprice) AS largest
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
            GROUP BY c_name, c_mktsegment""",
        "schema_sidecar": """SELECT 0 AS position, 'c_name' AS name, 'String' AS type,
                count(c_name) AS filled FROM customer
            UNION ALL SELECT 1, 'c_nationkey', 'Integer', count(c_nationkey) FROM customer
            UNION ALL SELECT 2, 'c_acctbal', 'Double', count(c_acctbal) FROM customer
            UNION ALL SELECT 3, 'c_mktsegment', 'String', count(c_mktsegment) FROM customer""",
        "vertices_from_edges": f"SELECT id, 'trade-V' AS label FROM ({vertices(TRADE)})",
        "undirected_edges": """SELECT CAST(o_custkey AS VARCHAR) AS src, CAST(l_suppkey AS VARCHAR) AS dst,
                o_custkey, l_suppkey, l_extendedprice FROM lineitem JOIN orders ON l_orderkey = o_orderkey
            UNION ALL SELECT CAST(l_suppkey AS VARCHAR), CAST(o_custkey AS VARCHAR),
                o_custkey, l_suppkey, l_extendedprice FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
        "edges_projection_listed_only": """SELECT CAST(o_custkey AS VARCHAR) AS src, CAST(l_suppkey AS VARCHAR) AS dst,
            l_extendedprice, l_quantity FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
        "graph_counts": " UNION ALL ".join(
            f"""SELECT '{name}' AS graph, (SELECT count(*) FROM ({vertices(edges)})) AS number_of_vertices,
            (SELECT count(*) FROM ({edges})) AS number_of_edges"""
            for name, edges in GRAPHS.items()
        ),
        "add_edges_checked": f"""SELECT src, dst, weight FROM ({BUILDING}) UNION ALL SELECT src, dst, weight FROM ({TRADE})""",
        "add_edges_checked_vertices": f"SELECT id FROM ({vertices(BUILDING)}) UNION SELECT id FROM ({vertices(TRADE)})",
        "add_edges_unchecked": f"""WITH known AS ({vertices(BUILDING)})
            SELECT src, dst, weight FROM ({BUILDING})
            UNION ALL SELECT src, dst, weight FROM ({TRADE})
            WHERE src IN (SELECT id FROM known) AND dst IN (SELECT id FROM known)""",
        "add_vertices_idempotent": f"""{vertices(TRADE)} UNION SELECT 'c' || c_custkey FROM customer
            UNION SELECT 's' || s_suppkey FROM supplier""",
        "clear_vertices_cascade": f"""WITH t AS ({VERTEX_TABLE}), gone AS (SELECT id FROM t WHERE balance < 0)
            SELECT 'edge' AS kind, src AS a, dst AS b FROM ({TRADE})
            WHERE src NOT IN (SELECT id FROM gone) AND dst NOT IN (SELECT id FROM gone)
            UNION ALL SELECT 'vertex', id, NULL FROM t WHERE id NOT IN (SELECT id FROM gone)""",
        "clear_edges": f"SELECT id, CAST(0 AS BIGINT) AS out_degree FROM ({vertices(TRADE)})",
        "out_degrees": f"SELECT src AS id, count(*) AS out_degree FROM ({TRADE}) GROUP BY src",
        "filter_has": f"SELECT id FROM ({VERTEX_TABLE}) WHERE segment = 'BUILDING'",
        "filter_within": f"SELECT id FROM ({VERTEX_TABLE}) WHERE segment IN ('BUILDING', 'MACHINERY')",
        "value_map": f"""SELECT t.id, 'trade-V' AS label, t.segment, t.balance, p.priority FROM ({VERTEX_TABLE}) t
            LEFT JOIN (SELECT 'c' || o_custkey AS id, min(o_orderpriority) AS priority FROM orders GROUP BY 1) p
            ON p.id = t.id""",
        "value_map_entries": f"""SELECT id, 'segment' AS property, segment AS value FROM ({VERTEX_TABLE})
            WHERE segment IS NOT NULL""",
        "pagerank_trade": pagerank(TRADE),
        "pagerank_nation": pagerank(NATION_FLOW),
        "pagerank_links": pagerank(PAGE_LINKS),
        "pagerank_actions": pagerank(undirected(USER_ACTIONS)),
        "pagerank_top": f"""WITH {pagerank_ctes(TRADE)} SELECT id AS name, pagerank FROM ranked
            ORDER BY pagerank DESC, id LIMIT 10""",
        "peer_pressure_unit": peer_pressure(undirected(TRADE), "unit"),
        "peer_pressure_distributed": peer_pressure(undirected(TRADE), "distributed"),
        "peer_pressure_actions": peer_pressure(undirected(USER_ACTIONS), "distributed"),
        "num_clusters": f"""WITH {peer_pressure_ctes(PAGE_LINKS, "unit")}
            SELECT count(DISTINCT cluster) AS number_of_clusters FROM clustered""",
        "export_vertices_csv": f"""SELECT id AS name, balance, segment, count(*) OVER () AS number_of_lines
            FROM ({VERTEX_TABLE})""",
        "export_vertices_dir": f"""SELECT id AS name, segment, CASE WHEN balance >= 0 THEN balance END AS balance
            FROM ({VERTEX_TABLE})""",
        "export_file_size": f"""SELECT count(*) AS number_of_lines,
                sum(strlen(id) + 2 + 1 + coalesce(strlen(segment) + 2, 0) + 1)::BIGINT AS file_size
            FROM ({VERTEX_TABLE})""",
        "merge_properties": VERTEX_TABLE,
        "add_edges_default_weight": f"""SELECT src, dst, weight FROM ({BUILDING})
            UNION ALL SELECT src, dst, 1.0::DOUBLE FROM ({TRADE})""",
        "graphson_roundtrip": _whole_graph(TRADE),
        "graphson_hubs": _whole_graph(USER_ACTIONS),
        "adjacency": NEIGHBOURS,
        "neighbours": NEIGHBOURS,
        "named_graph_store": f"""SELECT 'flows' AS graph, src, dst, weight FROM ({PAGE_LINKS})
            UNION ALL SELECT 'mixed', src, dst, weight FROM ({NATION_FLOW})
            UNION ALL SELECT 'mixed', src, dst, weight FROM ({USER_ACTIONS})""",
        "named_graph_counts": f"""SELECT 'flows' AS graph,
                (SELECT count(*) FROM ({vertices(PAGE_LINKS)})) AS number_of_vertices,
                (SELECT count(*) FROM ({PAGE_LINKS})) AS number_of_edges
            UNION ALL SELECT 'mixed', (SELECT count(*) FROM ({vertices(NATION_FLOW)} UNION {vertices(USER_ACTIONS)})),
                (SELECT count(*) FROM ({NATION_FLOW})) + (SELECT count(*) FROM ({USER_ACTIONS}))""",
        "copy_graph": _whole_graph(NATION_FLOW),
        "split_and_merge": _whole_graph(TRADE),
        "rank_cluster_export": f"""WITH {pagerank_ctes(NATION_FLOW)},
            votes AS ({peer_pressure(NATION_FLOW, "unit")})
            SELECT ranked.id AS name, pagerank, cluster AS "clusterID" FROM ranked JOIN votes ON votes.id = ranked.id""",
        "cluster_files": f"""WITH {peer_pressure_ctes(undirected(TRADE), "unit")}
            SELECT id AS name, cluster AS "clusterID" FROM clustered""",
        "label_propagation_parquet": peer_pressure(undirected(PAGE_LINKS), "distributed"),
        "incremental_maintenance": f"""SELECT 'vertices after clear' AS step, CAST(0 AS BIGINT) AS count
            UNION ALL SELECT 'vertices after insert', (SELECT count(*) FROM customer) + (SELECT count(*) FROM supplier)
            UNION ALL SELECT 'edges after clear', 0
            UNION ALL SELECT 'edges after insert', (SELECT count(*) FROM ({TRADE}))""",
    }
    return sql
